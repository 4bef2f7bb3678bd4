"""Helpers shared by the corpus operators: column picking, staging, word splitting and hashing on Arrow batches."""

from __future__ import annotations

import ctypes
import itertools
import math
import os
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewatch.sources.stage import stage_path, staging_scope

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by exact name, so that extra columns (also ``TEXT`` beside ``text``) cannot clash."""
    place: dict[str, int] = {}
    for i, name in enumerate(df.columns):
        place.setdefault(name, i)
    plain = df.toDF(*[f"column_{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"column_{place[n]}").alias(n) for n in names])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Written once to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = stage_path(df.sparkSession, "corpus")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables staged inside are deleted at the end, but for what is staged by the function that it gives."""
    outside = stage_path(spark, "corpus")
    count = itertools.count()

    def keep(df: DataFrame) -> DataFrame:
        path = f"{outside}-{next(count)}"
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    with staging_scope(spark):
        yield keep


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """What a step has used goes back to the system: Python workers are used again, by later steps too, and would keep it."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def remainder(column: Column, mod: int) -> Column:
    """crc32 of the value as text, modulo ``mod``; a null counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % F.lit(mod)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts, for sizing partitions."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def slices(total: int, each: int) -> int:
    return max(1, math.ceil(total / each))


_LOWER, _BLANK = np.arange(256, dtype=np.uint8), np.zeros(256, bool)
_LOWER[65:91] += 32
_AT_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_BLANK[[32, *range(9, 14)]] = True


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins and the last ends; nulls are empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, ends - ends[0]


class Words:
    """Words of some texts: distinct values, and for every word in reading order the index of its value."""

    def __init__(self, texts: pa.Array, lower: bool = True, between: np.ndarray = _BLANK, sides: np.ndarray | None = None):
        """``between`` marks the bytes that separate words; words are also cut where a byte of side 1 and one of side 2 meet."""
        raw, cuts = raw_bytes(texts)
        blank = between[raw]
        solid = ~blank
        begins = solid.copy()
        begins[1:] &= blank[:-1]
        if sides is not None:
            side = sides[raw]
            begins[1:] |= (side[1:] ^ side[:-1]) == 3
        own = cuts[:-1][cuts[:-1] < len(raw)]
        begins[own] = solid[own]
        starts = np.nonzero(begins)[0]
        letters = (_LOWER[raw] if lower else raw)[solid]
        offsets = np.append(np.cumsum(solid)[starts] - 1, len(letters)).astype(np.int64)
        flat = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters))
        coded = flat.dictionary_encode()
        self.values: pa.Array = coded.dictionary
        self.ids: np.ndarray = coded.indices.to_numpy(zero_copy_only=False)
        self.ends: np.ndarray = np.searchsorted(starts, cuts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of every distinct word."""
        values = self.values.cast(pa.large_binary()).to_pylist()
        return np.fromiter((xxhash.xxh3_64_intdigest(v) for v in values), np.uint64, len(values))


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection that spreads 64-bit values (constants of the public splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chained(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each sequence of hashes; ``parts[k]`` holds the k-th element of every sequence."""
    out = np.full(len(parts[0]), len(parts), np.uint64)
    for part in parts:
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + part)
    return out


def shingles(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes, ascending, of all runs of ``size`` words; of the whole text if it is shorter; none without words."""
    if not len(word_hashes):
        return np.empty(0, np.uint64)
    size = min(size, len(word_hashes))
    return np.unique(chained([word_hashes[k:len(word_hashes) - size + 1 + k] for k in range(size)]))


def pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, to bound a task's memory."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def bounded(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Batches with at most ``size`` bytes in a text column, but one row at least, to bound a task's memory."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def cut_long(text: bytes, size: int) -> list[bytes]:
    """Parts of about ``size`` bytes, cut where an ASCII blank begins; a part without blanks is as long as it is."""
    out, start = [], 0
    while len(text) - start > size:
        found = _AT_BLANK.search(text, start + size)
        if not found:
            break
        out.append(text[start:found.start()])
        start = found.start()
    return [*out, text[start:]]


def public_file(name: str) -> str:
    """A public vocabulary file; ``TOKENIZER_DIR`` names another folder."""
    return os.path.join(os.environ.get("TOKENIZER_DIR", "/opt/tokenizers"), name)


def packed_asks(found: dict[int, list[np.ndarray]], bits: int) -> pa.RecordBatch:
    """Rows (bucket, slice, code, n) that ask how often codes occur: for each slice the distinct ones and their number, packed
    by bucket. A code has 32 + ``bits`` bits, the upper ones are its bucket."""
    rows = []
    for s, parts in found.items():
        code, n = np.unique(np.concatenate(parts), return_counts=True)
        cut = np.searchsorted(code, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32))
        low, n = code.astype(np.uint32), np.minimum(n, 65535).astype(np.uint16)
        rows += [(b, s, low[i:j].tobytes(), n[i:j].tobytes()) for b, (i, j) in enumerate(zip(cut, cut[1:])) if j > i]
    columns = zip(*rows) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                                      names=["bucket", "slice", "code", "n"])


def packed_answers(table: pa.Table) -> pa.Table:
    """Answers one bucket's asks: of each slice's codes those that occur twice at least, with their number on a log scale."""
    asked = [np.frombuffer(x, np.uint32) for x in table["code"].to_pylist()]
    counts = [np.frombuffer(x, np.uint16) for x in table["n"].to_pylist()]
    code, place = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.bincount(place, np.concatenate(counts)).astype(np.int64)
    level = log_level(np.maximum(total, 1))
    ends = np.cumsum([0, *map(len, asked)])
    rows = []
    for own, s, i, j in zip(asked, table["slice"].to_pylist(), ends, ends[1:]):
        many = total[place[i:j]] > 1
        rows.append((s, own[many].tobytes(), level[place[i:j]][many].tobytes()))
    return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([table["bucket"][0].as_py()] * len(rows), pa.int32()),
                     pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
                    names=["slice", "bucket", "code", "level"])


ASKS, ANSWERS = "bucket int, slice long, code binary, n binary", "slice long, bucket int, code binary, level binary"


def log_level(n):
    return np.minimum(np.log2(n) * 6, 255).astype(np.uint8)


def unpacked_answers(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ascending codes and their levels."""
    if not answers.num_rows:
        return np.empty(0, np.uint64), np.empty(0, np.uint8)
    code = np.concatenate([(np.uint64(b) << np.uint64(32)) | np.frombuffer(c, np.uint32).astype(np.uint64) for b, c in
                           zip(answers["bucket"].to_pylist(), answers["code"].to_pylist())])
    level = np.frombuffer(b"".join(answers["level"].to_pylist()), np.uint8)
    code, first = np.unique(code, return_index=True)
    return code, level[first]


def levels_of(code: np.ndarray, known: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Levels of codes, 0 for those that have none."""
    if not len(known):
        return np.zeros(len(code), np.uint8)
    at = np.minimum(np.searchsorted(known, code), len(known) - 1)
    return np.where(known[at] == code, level[at], 0).astype(np.uint8)


def code_bits(total: int, each: int) -> int:
    """Bits of the bucket number, for buckets of about ``each`` codes."""
    return min(30, max(0, math.ceil(math.log2(slices(total, each)))))
