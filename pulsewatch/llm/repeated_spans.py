"""Removal of repeated byte strings with suffix arrays.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere else in the corpus. The suffix array is built over
what can be repeated, block by block:

1. Anchors: of the GRAM-byte strings inside a window of ``length`` bytes the one with the least hash (ties: the first) is the
   window's anchor. Equal windows have equal anchors at the same place. An anchor with the windows that it serves is a context.
2. Slices of the corpus ask, packed by hash, which anchors occur twice or more. Only the contexts of those go on, once for each
   slice, to the bucket of their anchor.
3. In a bucket, a context that occurs twice is repeated as a whole. The others of an anchor are cut to what they share with any
   other on the left and on the right; what is left below ``length`` bytes holds no repeated window. The rest of many anchors
   forms blocks; the suffix array of a block brings equal windows together.
4. Anchors with more than HOT occurrences would make too large a block: their windows go to buckets of their own, by digest, once
   for each slice, and are counted there; the same rule, exact too.
5. Slices get the repeated windows of their contexts back and cut them out of their texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import (ANSWERS, ASKS, code_bits, levels_of, log_level, mixed, packed_answers, packed_asks, pick, pieces, slices, text_bytes,
                                   unpacked_answers)
from pulsewatch.llm.suffix_array import suffix_array

GRAM = 50
#: Bytes of text in one slice and for each bucket of contexts, anchors in one bucket, bytes in one block of a suffix array.
SLICE_BYTES, BUCKET_BYTES, BUCKET_ANCHORS, BLOCK_BYTES = 12 << 20, 4 << 20, 4 << 20, 1 << 17
HOT = 2000
#: Bytes of text whose anchors are found in one step, and lower bits of a hash that give way to its place.
STEP, _PLACE = 1 << 16, np.uint64(31)
_BASE = 0x9E3779B97F4A7C15


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as many as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n = 1 << n.bit_length()
            self.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, _BASE, np.uint64))])
            self.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, pow(_BASE, -1, 1 << 64), np.uint64))])
        return self.up, self.down


_POWERS = Powers()


def anchors(raw: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first, last) of each anchor in texts that follow each other: where its gram is, and the first and the last of
    the windows it serves. ``ends``: where each text begins and the last ends. Hashes are compared by their upper bits."""
    size, gram = np.diff(ends) - length + 1, min(GRAM, length)
    if not len(size) or size.max() < 1:
        return (np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3)
    n = len(raw)
    up, down = _POWERS.upto(n + 1)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum((raw + np.uint64(1)) * up[:n], out=total[1:])
    h = mixed((total[gram:] - total[:-gram]) * down[:n - gram + 1])
    # hash and place in one number: the least one of a window has the least hash and is the first with it
    least, span, width = h >> _PLACE << _PLACE | np.arange(len(h), dtype=np.uint64), 1, length - gram + 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[step:], least[:-step])
        span += step
    size = np.maximum(size, 0)
    start = np.arange(size.sum()) + np.repeat(ends[:-1] - (np.cumsum(size) - size), size)
    at = (least[start] & ((np.uint64(1) << _PLACE) - np.uint64(1))).astype(np.int64)
    first = np.nonzero(np.concatenate([[True], at[1:] != at[:-1]]))[0]
    at, first, last = at[first], start[first], start[np.append(first[1:], len(at)) - 1]
    return h[at], at, first, last


def _steps(texts: list[bytes]):
    """(number of the first, texts in a row, where each begins and the last ends): about STEP bytes at a time, one text at least."""
    ends = np.cumsum([0, *map(len, texts)])
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + STEP, "right")) - 1)
        yield i, b"".join(texts[i:j]), ends[i:j + 1] - ends[i]
        i = j


def _texts(table) -> list[bytes]:
    return table.column("text").cast(pa.binary()).to_pylist()


def _code(h: np.ndarray, bits: int) -> np.ndarray:
    return h >> np.uint64(32 - bits)


def _asks(length: int, bits: int):
    def run(batches):
        for batch in pieces(batches, 2000):
            by: dict[int, list] = {}
            slice_of = batch.column("slice").to_numpy()
            for i, whole, ends in _steps(_texts(batch)):
                h, place, _, _ = anchors(np.frombuffer(whole, np.uint8), ends, length)
                mine = slice_of[i + np.searchsorted(ends, place, "right") - 1]
                for s in np.unique(mine).tolist():
                    by.setdefault(s, []).append(_code(h[mine == s], bits))
            yield packed_asks(by, bits)
    return run


def _digest(x: bytes) -> bytes:
    return xxhash.xxh3_128_digest(x)


def _contexts(length: int, bits: int, buckets: int):
    """Contexts of a slice and windows of its hot anchors, packed by bucket, each with its number in the slice."""
    def run(key, docs: pa.Table, answers: pa.Table) -> pa.Table:
        codes, level = unpacked_answers(answers)
        hot = log_level(HOT)
        found: dict[int, dict[bytes, list]] = {}
        windows: dict[int, dict[bytes, int]] = {}
        for _, whole, ends in _steps(_texts(docs)):
            h, place, first, last = anchors(np.frombuffer(whole, np.uint8), ends, length)
            of = levels_of(_code(h, bits), codes, level)
            many = np.nonzero(of)[0]
            for lv, anchor, at, a, b in zip(*(x[many].tolist() for x in (of, h, place, first, last))):
                if lv > hot:
                    for start in range(a, b + 1):
                        d = _digest(whole[start:start + length])
                        inside = windows.setdefault(d[0] | d[1] << 8 | d[2] << 16 | d[3] << 24, {})
                        inside[d] = inside.get(d, 0) + 1
                else:
                    inside = found.setdefault(anchor % buckets, {})
                    body = whole[a:b + length]
                    if body in inside:
                        inside[body][2] += 1
                    else:
                        inside[body] = [anchor, at - a, 1]
        by_bucket: dict[int, dict[bytes, int]] = {}
        for part, inside in windows.items():
            by_bucket.setdefault(part % buckets, {}).update(inside)
        rows = [(b, False, [v[0] - (1 << 63) for v in x.values()], [v[1] for v in x.values()], [v[2] for v in x.values()], list(x)) for b, x in found.items()]
        rows += [(b, True, [], [], list(x.values()), list(x)) for b, x in by_bucket.items()]
        columns = list(zip(*rows)) if rows else [[]] * 6
        s = docs["slice"][0].as_py() if docs.num_rows else 0
        return pa.table([pa.array(columns[0], pa.int32()), pa.array([s] * len(rows), pa.int64()), pa.array(columns[1], pa.bool_()),
                         pa.array(columns[2], pa.list_(pa.int64())), pa.array(columns[3], pa.list_(pa.int32())),
                         pa.array(columns[4], pa.list_(pa.int64())), pa.array(columns[5], pa.list_(pa.binary()))],
                        names=["bucket", "slice", "hot", "anchor", "place", "n", "body"])
    return run


CONTEXTS = "bucket int, slice long, hot boolean, anchor array<long>, place array<int>, n array<long>, body array<binary>"


def _shared(sides: list[bytes]) -> list[int]:
    """For each string the longest beginning that it shares with another one."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    out = [0] * len(sides)
    for i, j in zip(order, order[1:]):
        a, b = sides[i], sides[j]
        low, high = 0, min(len(a), len(b))
        while low < high:
            middle = (low + high + 1) // 2
            if a[:middle] == b[:middle]:
                low = middle
            else:
                high = middle - 1
        out[i], out[j] = max(out[i], low), max(out[j], low)
    return out


class Blocks:
    """Collects parts of contexts and finds their repeated windows by suffix arrays of blocks."""

    def __init__(self, length: int):
        self.length, self.parts, self.size = length, [], 0

    def add(self, bodies: list[bytes], marks: list[np.ndarray], offsets: list[int]) -> None:
        """The parts of one anchor stay in one block. ``marks``: arrays that get a True for each repeated window."""
        if self.size and self.size + sum(map(len, bodies)) > BLOCK_BYTES:
            self.run()
        self.parts += zip(bodies, marks, offsets)
        self.size += sum(map(len, bodies))

    def run(self) -> None:
        if not self.parts:
            return
        whole = b"".join(body + b"\0" for body, _, _ in self.parts)
        ends = np.cumsum([len(body) + 1 for body, _, _ in self.parts])
        text = np.frombuffer(whole, np.uint8).astype(np.int64) + 1
        text[ends - 1] = 0
        order = np.array(suffix_array(text))
        of = np.searchsorted(ends, order, side="right")
        order, of = order[ends[of] - 1 - order >= self.length], of[ends[of] - 1 - order >= self.length]
        starts = order.tolist()
        for k in range(len(starts) - 1):
            a, b = starts[k], starts[k + 1]
            if whole[a:a + self.length] == whole[b:b + self.length]:
                for x, part in ((a, of[k]), (b, of[k + 1])):
                    body, marks, offset = self.parts[part]
                    marks[x - int(ends[part]) + 1 + len(body) + offset] = True
        self.parts, self.size = [], 0


def _decide(length: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        total: dict[bytes, int] = {}
        by_anchor: dict[int, dict[bytes, tuple[int, int]]] = {}
        for row in rows:
            if row["hot"]:
                for d, n in zip(row["body"], row["n"]):
                    total[d] = total.get(d, 0) + n
            else:
                for h, place, n, body in zip(row["anchor"], row["place"], row["n"], row["body"]):
                    inside = by_anchor.setdefault(h, {})
                    inside[body] = place, inside.get(body, (0, 0))[1] + n
        marks: dict[bytes, np.ndarray] = {}
        blocks = Blocks(length)
        for inside in by_anchor.values():
            bodies = list(inside)
            for body in bodies:
                marks[body] = np.full(len(body) - length + 1, inside[body][1] > 1)
            if len(bodies) > 1 and any(n == 1 for _, n in inside.values()):
                gram = min(GRAM, length)
                places = [inside[b][0] for b in bodies]
                left = _shared([b[:p][::-1] for b, p in zip(bodies, places)])
                right = _shared([b[p + gram:] for b, p in zip(bodies, places)])
                cut = [(b[p - x:p + gram + y], marks[b], p - x) for b, p, x, y in zip(bodies, places, left, right) if x + gram + y >= length]
                if len(cut) > 1:
                    blocks.add(*map(list, zip(*cut)))
        blocks.run()
        out = []
        for row in rows:
            if row["hot"]:
                keys = [d for d in row["body"] if total[d] > 1]
                out.append((row["slice"], keys, [b""] * len(keys)))
            else:
                keys = [b for b in row["body"] if marks[b].any()]
                out.append((row["slice"], [_digest(b) for b in keys], [np.packbits(marks[b]).tobytes() for b in keys]))
        return pa.table([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.list_(pa.binary())),
                         pa.array([x[2] for x in out], pa.list_(pa.binary()))], names=["slice", "key", "windows"])
    return run


def _removed(whole: bytes, ends: np.ndarray, length: int, bits: int, codes, level, hot: int, known: dict[bytes, bytes]) -> np.ndarray:
    """Which bytes of texts that follow each other lie in a repeated window."""
    raw = np.frombuffer(whole, np.uint8)
    h, _, first, last = anchors(raw, ends, length)
    of = levels_of(_code(h, bits), codes, level)
    at, starts, sizes, packed = [], [], [], []
    many = np.nonzero(of)[0]
    for lv, a, b in zip(*(x[many].tolist() for x in (of, first, last))):
        if lv > hot:
            at += [s for s in range(a, b + 1) if _digest(whole[s:s + length]) in known]
        elif (found := known.get(_digest(whole[a:b + length]))) is not None:
            starts.append(a)
            sizes.append(b - a + 1)
            packed.append(found)
    # the marks of each context begin a new byte
    marks, sizes = np.unpackbits(np.frombuffer(b"".join(packed), np.uint8)).view(bool), np.array(sizes, np.int64)
    room = -(-sizes // 8) * 8
    inside = np.arange(len(marks)) - np.repeat(np.cumsum(room) - room, room)
    marked = marks & (inside < np.repeat(sizes, room))
    change = np.zeros(len(raw) + 1, np.int64)
    at = np.concatenate([np.array(at, np.int64), (np.repeat(np.array(starts, np.int64), room) + inside)[marked]])
    change[at] += 1
    change[at + length] -= 1
    return np.cumsum(change)[:-1] > 0


def _cut_out(length: int, bits: int, keep_text: bool):
    def run(key, docs: pa.Table, asked: pa.Table) -> pa.Table:
        known = {}
        for keys, windows in zip(asked["key"].to_pylist(), asked["windows"].to_pylist()):
            if keys is not None:
                known.update(zip(keys, windows))
        answers = asked.filter(asked["bucket"].is_valid())
        codes, level = unpacked_answers(answers)
        hot, rows, texts = log_level(HOT), [], []
        for _, whole, ends in _steps(_texts(docs)):
            gone = _removed(whole, ends, length, bits, codes, level, hot, known)
            begins = gone & ~np.concatenate([[False], gone[:-1]])
            begins[ends[:-1][ends[:-1] < len(gone)]] = gone[ends[:-1][ends[:-1] < len(gone)]]
            n_spans, n_gone = (np.diff(np.concatenate([[0], np.cumsum(x)])[ends]).tolist() for x in (begins, gone))
            left, i = np.frombuffer(whole, np.uint8)[~gone].tobytes(), 0
            for size, lost, spans in zip(np.diff(ends).tolist(), n_gone, n_spans):
                kept = left[i:i + size - lost]
                i += size - lost
                rows.append((size, lost, spans, hashlib.sha256(kept).hexdigest()))
                texts.append(kept)
        columns = list(zip(*rows)) if rows else [[]] * 4
        out = [docs["doc_id"], *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))]]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if keep_text:
            out, names = [*out, pa.array(texts, pa.binary())], [*names, "kept"]
        return pa.table(out, names=names)
    return run


def without_repeats(docs: DataFrame, length: int = 200, keep_text: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of all texts as UTF-8 bytes, with ``keep_text`` also the remaining bytes.

    Overlapping repeats count, all occurrences go, the first too; strings are judged on the input and never cross documents.
    A null text is empty; texts shorter than ``length`` keep everything. Repeated rows and equal texts repeat each other, so from
    ``length`` bytes on nothing of them is left. Ids may repeat or be null. Extra columns do not matter; an empty table gives
    an empty result.
    """
    docs = pick(docs, id_column, text_column).toDF("doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    total = text_bytes(docs)
    parts, buckets = slices(total, SLICE_BYTES), slices(total, BUCKET_BYTES)
    bits = code_bits(2 * total // (length - min(GRAM, length) + 2), BUCKET_ANCHORS)
    cut = docs.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts))).repartition(parts, "slice")
    answers = cut.mapInArrow(_asks(length, bits), ASKS).groupBy("bucket").applyInArrow(packed_answers, ANSWERS)
    contexts = cut.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_contexts(length, bits, buckets), CONTEXTS)
    decided = contexts.groupBy("bucket").applyInArrow(_decide(length), "slice long, key array<binary>, windows array<binary>")
    both = answers.withColumns({"key": F.lit(None).cast("array<binary>"), "windows": F.lit(None).cast("array<binary>")}).unionByName(
        decided.withColumns({"bucket": F.lit(None).cast("int"), "code": F.lit(None).cast("binary"), "level": F.lit(None).cast("binary")}))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return cut.groupBy("slice").cogroup(both.groupBy("slice")).applyInArrow(
        _cut_out(length, bits, keep_text), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (
            ", kept binary" if keep_text else "")).withColumnRenamed("doc_id", id_column)
