import random

import pytest

from pulsewatch.llm import jaccard_join as J
from tests.llm import brute


def family(seed, base, copies, change):
    r = random.Random(seed)
    words = [f"w{seed}x{r.randrange(9999)}" for _ in range(base)]
    out = [" ".join(words)]
    for _ in range(copies):
        own = list(words)
        for _ in range(change):
            own[r.randrange(base)] = f"z{r.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def corpus():
    texts = family(1, 120, 20, 2) + family(2, 60, 5, 1) + family(3, 40, 3, 4)
    passage = " ".join(f"p{i}" for i in range(30))
    texts += [passage + " " + " ".join(f"q{k}x{i}" for i in range(20)) for k in range(10)]
    texts += ["", None, "   \n", "One", "one", "One two", "a b c d", "A B\tC\x0bd", texts[0], texts[0], "é É ß", "É É ß"]
    return list(enumerate(texts))


@pytest.mark.parametrize("small", [48, 2])
def test_equal_to_all_pairs(spark, monkeypatch, small):
    """With a tiny limit for lists joined as pairs, the parts of long lists do the same work."""
    monkeypatch.setattr(J, "SMALL_LIST", small)
    monkeypatch.setattr(J, "PART_DOCUMENTS", 6 if small == 2 else 400)
    docs = corpus()
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in docs], "doc_id long, text string, TEXT2 string, slice int")
    got = sorted(tuple(r) for r in J.jaccard_components(df).collect())
    assert got == brute.jaccard_rows(docs)


def test_empty_table_and_repeated_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert J.jaccard_components(none).collect() == []
    rows = spark.createDataFrame([(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (None, None)], "doc_id long, text string")
    got = sorted(((r[0] or 0), r[1], r[2]) for r in J.jaccard_components(rows).collect())
    assert got == [(0, 0, None), (0, 2, 5), (5, 2, 5), (5, 2, 5)]
