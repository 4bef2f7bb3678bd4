"""Best-fit packing of tokenised documents into sequences of fixed length.

Texts are cut where no token of the vocabulary crosses, at blanks and between letters and marks, and every distinct stretch is
encoded once and kept. Documents
longer than a sequence are cut; their pieces keep their order. How the pieces go together depends on their lengths only, of which
there are no more than a sequence has places, so the lengths are counted and the counts packed by bin completion
(``bin_completion``). Pieces of one length are numbered across all partitions by running sums, and each number is looked up in the
plan: which sequence, which place.
"""

from __future__ import annotations

import os
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsewatch.llm.bin_completion import Pattern, complete
from pulsewatch.llm.common import Words, bounded, cut_long, pick, public_file, staged

#: Bytes of text encoded at a time; a worker keeps twice so many stretches.
STEP_BYTES, KNOWN = 8 << 20, 600_000
#: The id behind every document.
END = 0
#: No token holds both an ASCII letter or digit (1) and one of these marks (2).
_SIDES = np.zeros(256, np.uint8)
_SIDES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_SIDES[list(b",.;:!?()\"")] = 2


class Encoder:
    """Ids of texts, with a memory of the stretches between blanks: those met since it was last full, and those of the time before."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _stretches(self, values: list[str]) -> list[bytes]:
        if len(self.known) > KNOWN:
            self.older, self.known = self.known, {}
        known, older, fresh = self.known, self.older, []
        found = list(map(known.get, values))
        for k, ids in enumerate(found):
            if ids is None:
                ids = older.get(values[k])
                if ids is None:
                    fresh.append(k)
                else:
                    found[k] = known[values[k]] = ids
        if fresh:
            for k, e in zip(fresh, self.tokenizer.encode_batch_fast([values[k] for k in fresh], add_special_tokens=False)):
                found[k] = known[values[k]] = array("I", e.ids).tobytes()
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        # the vocabulary has lower-case letters only, but for its special tokens
        special = bool(pc.any(pc.match_substring(texts, "<|")).as_py())
        words = Words(texts, lower=not special, sides=_SIDES)
        found = self._stretches(words.values.to_pylist())
        ids, size = np.frombuffer(b"".join(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found)) // 4
        start, size = (np.cumsum(size) - size)[words.ids], size[words.ids]
        ends = np.cumsum(size)
        flat = ids[np.arange(size.sum()) + np.repeat(start - ends + size, size)]
        return flat, np.diff(np.append(0, ends)[words.ends])


_ENCODERS: dict[str, Encoder] = {}


def _documents(encoder: Encoder, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all documents in a row, each with END behind it, and how many each has; a very long text is encoded in parts."""
    if len(texts) == 1 and len(raw := (texts[0].as_py() or "").encode()) > STEP_BYTES:
        parts = [encoder.encode(pa.array([p.decode()], pa.string())) for p in cut_long(raw, STEP_BYTES)]
        flat, size = np.concatenate([f for f, _ in parts]), np.array([sum(int(n[0]) for _, n in parts)])
    else:
        flat, size = encoder.encode(texts)
    out = np.full(len(flat) + len(size), END, np.uint32)
    inside = np.ones(len(out), bool)
    inside[np.cumsum(size + 1) - 1] = False
    out[inside] = flat
    return out, size + 1


def _cut(path: str, capacity: int, keep_ids: bool):
    def run(batches):
        encoder = _ENCODERS.setdefault(path, None) or Encoder(path)
        _ENCODERS[path] = encoder
        seen, part = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in bounded(batches, "text", STEP_BYTES):
            flat, size = _documents(encoder, batch.column("text"))
            number = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), number)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            start = piece * capacity
            length = np.minimum(size[row] - start, capacity)
            ends = np.cumsum(length)
            raw = memoryview(flat.astype("<u4").view(np.uint8))
            crc = [zlib.crc32(raw[4 * (j - n):4 * j]) for j, n in zip(ends.tolist(), length.tolist())]
            # the number of each piece among those of its length in this task
            order = np.argsort(length, kind="stable")
            kind, n = np.unique(length, return_counts=True)
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(seen[kind], n)
            seen[kind] += n
            columns = [batch.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                       pa.array(np.full(len(row), part, np.int32)), pa.array(rank)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
            if keep_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def token_pieces(docs: DataFrame, capacity: int, path: str, keep_ids: bool) -> DataFrame:
    """Pieces of all documents, written once: part and rank tell pieces of one length apart."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, rank long"
    return staged(docs.mapInArrow(_cut(path, capacity, keep_ids), schema + (", ids array<int>" if keep_ids else "")))


def _plan(patterns: list[Pattern]) -> np.ndarray:
    """Rows (length, first, each, sequence, offset), ascending: from the number ``first`` on, ``each`` pieces of this length go into
    every sequence from ``sequence`` on, the first of them to place ``offset``."""
    rows, used, sequence = [], {}, 0
    for bins, filling in patterns:
        offset = 0
        for length, each in filling:
            rows.append((length, used.get(length, 0), each, sequence, offset))
            used[length] = used.get(length, 0) + bins * each
            offset += length * each
        sequence += bins
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _placed(plan):
    def run(batches):
        length, first, each, sequence, offset = plan.value.T
        lengths, begins = np.unique(length, return_index=True)
        stops = np.append(begins[1:], len(length))
        for batch in batches:
            own, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            at = np.empty(len(own), np.int64)
            for k in np.unique(own):
                here = np.nonzero(own == k)[0]
                i = np.searchsorted(lengths, k)
                at[here] = begins[i] + np.searchsorted(first[begins[i]:stops[i]], number[here], "right") - 1
            turn = number - first[at]
            out = batch.drop_columns(["part", "rank", "number"])
            yield (out.append_column("sequence_id", pa.array(sequence[at] + turn // each[at]))
                   .append_column("offset", pa.array(offset[at] + turn % each[at] * own)))
    return run


def packed(docs: DataFrame, capacity: int = 2048, id_column: str = "doc_id", text_column: str = "text", path: str | None = None,
           keep_ids: bool = True) -> DataFrame:
    """(id, piece, start, length, ids_crc32, ids, sequence_id, offset): the pieces of all documents and where they are packed.

    A document is its ids with 0 behind; a null text is an empty one, a single 0. Documents longer than ``capacity`` are cut into
    pieces of that length, the last one may be shorter; others stay whole. ``offset`` has no gaps within a sequence; sequences are
    numbered from 0. ``ids_crc32`` is over the ids as little-endian unsigned 32-bit numbers; ``ids`` is left out without
    ``keep_ids``. Pieces of equal length are interchangeable: which one goes where depends on the table's partitions, the
    number of sequences does not. Repeated rows are packed as often as they occur; null ids stay null; extra columns do not
    matter; an empty table gives an empty result. A text of any length is encoded in parts; a stretch without a blank is one part.
    """
    docs = pick(docs, id_column, text_column).toDF("doc_id", "text")
    pieces = token_pieces(docs, capacity, path or public_file("word_bpe_49k.json"), keep_ids)
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = staged(counts)
    # as many rows as a sequence has places, at most
    patterns = complete({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    numbered = pieces.join(counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), ["length", "part"]).withColumn(
        "number", F.col("rank") + F.col("before"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    plan = docs.sparkSession.sparkContext.broadcast(_plan(patterns))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.select(*names).schema.fields)
    return (numbered.select(*names, "part", "rank", "number").mapInArrow(_placed(plan), f"{kinds}, sequence_id long, offset long")
            .withColumnRenamed("doc_id", id_column))


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, from pieces with their ids. A group is one sequence, so it is bounded."""
    return pieces.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
