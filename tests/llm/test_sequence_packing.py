import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pulsewatch.llm import bin_completion as B
from pulsewatch.llm import sequence_packing as S
from pulsewatch.llm.common import public_file

SCHEMA = "doc_id long, text string, TEXT string, length int, part int"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_file("word_bpe_49k.json"))


def bins(patterns):
    return sum(n for n, _ in patterns)


def items(patterns):
    out = Counter()
    for n, filling in patterns:
        for size, k in filling:
            out[size] += n * k
    return out


def fewest(sizes, capacity):
    """Bins of the best packing, by trying all."""
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= sizes[i]}:
            left = list(rooms)
            left[left.index(room)] -= sizes[i]
            go(i + 1, left)
        go(i + 1, [*rooms, capacity - sizes[i]])

    go(0, [])
    return best[0]


def test_bin_completion_equals_all_packings():
    beaten = 0
    for seed in range(200):
        r = random.Random(seed)
        capacity = r.choice([10, 20, 50, 100])
        low, high = (1, capacity) if seed % 2 else (capacity // 5 + 1, capacity // 2 + 1)
        sizes = [r.randint(low, high) for _ in range(r.randrange(1, 12))]
        found = B.complete(Counter(sizes), capacity)
        assert items(found) == Counter(sizes) and all(sum(s * k for s, k in f) <= capacity for _, f in found)
        assert bins(found) == fewest(sizes, capacity)
        beaten += bins(B.best_fit(Counter(sizes), capacity)) > bins(found)
    assert beaten      # the search is needed


def test_large_counts_stay_near_the_bound():
    r = random.Random(1)
    for sizes, over in ((lambda: max(1, min(2048, int(r.lognormvariate(6.2, 0.9)))), 1.0), (lambda: r.randrange(300, 900), 1.01)):
        counts = Counter(sizes() for _ in range(30_000))
        found = B.complete(counts, 2048)
        assert items(found) == counts
        assert B.least_bins(counts, 2048) <= bins(found) <= over * B.least_bins(counts, 2048) + 1
        assert bins(found) <= bins(B.best_fit(counts, 2048))
    many = {700: 10**12, 600: 10**12, 300: 3 * 10**11, 1: 10**13}
    found = B.complete(many, 2048)
    assert items(found) == many and bins(found) <= bins(B.best_fit(many, 2048))


def test_fillings_are_undominated_and_within_the_waste():
    found = list(B.fillings({5: 1, 3: 2, 2: 2, 1: 1}, 6, 1))
    assert found[0] == (0, ((5, 1), (1, 1)))
    assert all(6 - sum(s * n for s, n in f) == lost <= 1 for lost, f in found)
    assert (0, ((2, 2), (1, 1))) not in found
    assert list(B.fillings({4: 3}, 4, 0)) == [(0, ((4, 1),))] and list(B.fillings({}, 7, 3)) == []
    with pytest.raises(ValueError):
        B.complete({11: 1}, 10)
    assert B.complete({}, 10) == []


def odd_texts():
    r = random.Random(5)
    letters = "aB'sS.(\"é ÉΣσ́İ日9<|>  \t\n\x0b\x1c .,!?🙂ﬁ​"
    out = ["".join(r.choice(letters) for _ in range(r.randrange(0, 60))) for _ in range(300)]
    return out + ["<|endoftext|>", "<|ENDOFTEXT|>", "x,'s.'S 's,'t", "a=\u0338.\u0338b", "a.<|endoftext|>.A", "a <|startoftext|>b <|endoftext|> c", "it's we'll  I'D", "ΑΣ ΑΣΑ", "é ́x"]


def test_ids_equal_the_library(tokenizer, monkeypatch):
    texts = odd_texts()
    for known in (S.KNOWN, 20):
        monkeypatch.setattr(S, "KNOWN", known)
        encoder = S.Encoder(public_file("word_bpe_49k.json"))
        for part in (texts[:100], texts[100:], texts[50:150]):
            flat, size = encoder.encode(pa.array(part))
            assert [x.tolist() for x in np.split(flat, np.cumsum(size)[:-1])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in part]


def documents():
    r = random.Random(6)
    words = ["the", "Quick", "brown-fox", "jumps", "überall", "x9", "don't"]
    rows = [(i, " ".join(r.choice(words) for _ in range(int(r.expovariate(0.02)))), "t", 1, 1) for i in range(300)]
    rows += [(900, None, "t", 1, 1), (901, "", "t", 1, 1), (902, " \n ", "t", 1, 1), (None, "null id", "t", 1, 1), (903, "word " * 3000, "t", 1, 1)]
    return rows + rows[:4] + [(7, rows[7][1], "t", 1, 1)] * 200


@pytest.mark.parametrize("capacity, step", [(128, 1 << 22), (2048, 500)])
def test_pieces_are_packed_whole(spark, tokenizer, monkeypatch, capacity, step):
    monkeypatch.setattr(S, "STEP_BYTES", step)
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    packed = S.packed(df, capacity)
    got = packed.collect()
    ids = {(i, t): [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t, *_ in rows}
    want = Counter((i, k // capacity, k, len(x[k:k + capacity]), zlib.crc32(np.array(x[k:k + capacity], "<u4").tobytes()))
                   for i, t, *_ in rows for x in [ids[i, t]] for k in range(0, len(x), capacity))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    lengths = Counter(r["length"] for r in got)
    assert sorted(by) == list(range(len(by))) and B.least_bins(lengths, capacity) <= len(by) <= B.least_bins(lengths, capacity) * 1.01 + 1
    whole = {r["sequence_id"]: r["ids"] for r in S.sequences(packed).collect()}
    assert len(whole) == len(by) and sum(map(len, whole.values())) == sum(len(ids[i, t]) for i, t, *_ in rows)
    for r in got[:50]:
        assert whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"]


def test_empty_table(spark):
    assert S.packed(spark.createDataFrame([], SCHEMA)).collect() == []
    assert "ids" not in S.packed(spark.createDataFrame([], SCHEMA), keep_ids=False).columns
