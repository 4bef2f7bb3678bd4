import random

import numpy as np
import pytest

from pulsewatch.llm import repeated_spans as R
from pulsewatch.llm.suffix_array import suffix_array
from tests.llm import brute


def test_suffix_array_equals_sorting():
    r = random.Random(3)
    for k in range(1500):
        s = bytes(r.choice(b"ab" if k % 2 else b"abcd") for _ in range(r.randrange(40)))
        assert suffix_array(np.frombuffer(s, np.uint8)) == sorted(range(len(s)), key=lambda i: s[i:])
    for s in (b"a" * 200, b"ab" * 150, b"abaab" * 60, bytes(range(250))[::-1]):
        assert suffix_array(np.frombuffer(s, np.uint8)) == sorted(range(len(s)), key=lambda i: s[i:])


def corpus():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, base = text(60), text(300)
    docs = [text(r.randrange(1, 200)) for _ in range(20)]
    docs += [text(20) + " " + passage + " " + text(25) for _ in range(12)]
    for _ in range(8):
        w = base.split()
        w[r.randrange(len(w))] = "zzz"
        docs.append(" ".join(w))
    docs += [base, base, "x" * 900, "xy" * 300, "ab " * 30 + passage[:150], None, "", "short", "short", passage[:199], docs[0][:100] + "ü" * 250]
    return list(enumerate(docs))


@pytest.mark.parametrize("hot", [2000, 3])
def test_equal_to_a_table_of_all_strings(spark, monkeypatch, hot):
    """With a low limit for hot anchors their windows are counted by digest."""
    monkeypatch.setattr(R, "HOT", hot)
    monkeypatch.setattr(R, "SLICE_BYTES", 4000)
    monkeypatch.setattr(R, "BUCKET_BYTES", 6000)
    docs = corpus()
    df = spark.createDataFrame([(i, t, 1, "y") for i, t in docs], "doc_id long, text string, slice int, TEXT2 string")
    for length in (200, 40):
        got = sorted(tuple(r) for r in R.without_repeats(df, length).collect())
        assert got == sorted(brute.repeated_rows(docs, length))


def test_empty_table_and_repeated_rows(spark):
    assert R.without_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    text = " ".join(str(k) for k in range(200))
    rows = spark.createDataFrame([(None, text), (1, text), (1, text)], "doc_id long, text string")
    got = R.without_repeats(rows, keep_text=True).collect()
    assert {(r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got} == {(len(text), len(text), 1, b"")}


def test_anchors_of_many_texts_at_once_are_those_of_each(monkeypatch):
    texts = [(x or "").encode() for _, x in corpus()] + [b"", b"ab" * 500, bytes(300)]
    monkeypatch.setattr(R, "STEP", 3000)
    for length in (200, 40):
        found = []
        for i, whole, ends in R._steps(texts):
            h, *at = R.anchors(np.frombuffer(whole, np.uint8), ends, length)
            of = np.searchsorted(ends, at[0], "right") - 1
            found += zip((i + of).tolist(), h.tolist(), *((x - ends[of]).tolist() for x in at))
        alone = [(i, *x) for i, t in enumerate(texts)
                 for x in zip(*(y.tolist() for y in R.anchors(np.frombuffer(t, np.uint8), np.array([0, len(t)]), length)))]
        windows = sorted((i, s) for i, _, _, first, last in found for s in range(first, last + 1))
        assert found == alone and windows == [(i, s) for i, t in enumerate(texts) for s in range(len(t) - length + 1)]


def test_many_short_steps_and_texts(spark, monkeypatch):
    monkeypatch.setattr(R, "STEP", 500)
    docs = corpus()
    got = sorted(tuple(r) for r in R.without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == sorted(brute.repeated_rows(docs, 200))
