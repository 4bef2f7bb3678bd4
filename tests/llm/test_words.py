import pyarrow as pa
import pytest

from pulsewatch.llm.common import Words
from tests.llm import brute


@pytest.mark.parametrize("start", [0, 2])
def test_words_equal_the_pattern(start):
    texts = ["a b", None, "", " \t à Å\x85b\xa0c\n\x0b\x0cÀ\r", "Éa É　x", "\x1cq", "end", "begin"]
    words = Words(pa.array(texts).slice(start))
    values = words.values.to_pylist()
    got = [[values[k] for k in words.ids[i:j]] for i, j in zip(words.ends, words.ends[1:])]
    assert got == [brute.words(t) for t in texts[start:]]


def test_no_texts():
    for texts in (pa.array([], pa.string()), pa.array([None, ""], pa.string())):
        assert len(Words(texts).ids) == 0 and len(Words(texts).ends) == len(texts) + 1
