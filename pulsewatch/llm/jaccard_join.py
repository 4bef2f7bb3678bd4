"""N-gram Jaccard join by a grouped prefix join.

1. Every document becomes the set of its distinct word shingles. Slices of the corpus send the shingles they hold, packed
   and counted, to buckets; a bucket answers which of them lie in several documents, and in about how many.
2. A document that shares too few shingles to link with anything is done. The others order their shingles by that count,
   rarest first, and keep the prefix that two linked documents must share. Documents with equal sets collapse to one.
3. Documents with equal prefix and size form a group. Groups that meet on a prefix shingle and pass the size filter are
   expanded to member pairs, which are verified on the whole sets.
4. Prefix shingles of very many documents are joined in parts of bounded size, never as rows of pairs: first inside the
   parts, each with some common pivots; then, where several components remain on one shingle, what lies outside the largest
   of them against everything. Pairs of one component need no more check, so no link between components is lost.

The order of the shingles only has to be the same for all documents, so that a bucket may count shingles by 32 bits of
their hash beside the bucket number: a collision changes the order, and never a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import (ANSWERS, ASKS, Words, code_bits, levels_of, mixed, packed_answers, packed_asks, pick, pieces, shingles,
                                   slices, staged, text_bytes, unpacked_answers)
from pulsewatch.llm.components import components

#: Bytes of text in one slice, shingles in one bucket, and documents in one part of a large list.
SLICE_BYTES, BUCKET_SHINGLES, PART_DOCUMENTS = 12 << 20, 4 << 20, 400
#: Lists of up to this many documents are joined as pairs.
SMALL_LIST = 48
PIVOTS = 4


def _sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    words = Words(texts)
    hashes = words.hashes()[words.ids] if len(words.ids) else np.empty(0, np.uint64)
    for start, end in zip(words.ends, words.ends[1:]):
        yield shingles(hashes[start:end], size)


def _code(h: np.ndarray, bits: int) -> np.ndarray:
    """Bucket and 32 more bits of a hash."""
    return h >> np.uint64(32 - bits)


def _asks(size: int, bits: int):
    def run(batches):
        for batch in pieces(batches, 2000):
            of = batch.column("slice").to_numpy()
            by: dict[int, list] = {}
            for s, found in zip(of, _sets(batch.column("text"), size)):
                by.setdefault(int(s), []).append(_code(found, bits))
            yield packed_asks(by, bits)
    return run


def _prefixes(size: int, bits: int, percent: int):
    def run(key, docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return docs.select(["doc_id"]).append_column("n_shingles", pa.array([], pa.int64())).append_column(
                "print", pa.array([], pa.string())).append_column("prefix", pa.array([], pa.list_(pa.int64()))).append_column(
                "shingles", pa.array([], pa.binary()))
        shared, level = unpacked_answers(answers)
        counts, prints, prefixes, sets, seen = [], [], [], [], set()
        texts = docs["text"].combine_chunks()
        for start in range(0, docs.num_rows, 2000):
            for found in _sets(texts.slice(start, 2000), size):
                n = len(found)
                counts.append(n)
                prefix = whole = None
                if not n:
                    prints.append(None)
                else:
                    a, b = mixed(found).sum(dtype=np.uint64), mixed(found ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64)
                    prints.append(f"{int(a):016x}{int(b):016x}")
                    if prints[-1] not in seen and len(shared):
                        seen.add(prints[-1])
                        order = levels_of(_code(found, bits), shared, level)
                        need = -(-percent * n // 100)
                        if np.count_nonzero(order) >= need:
                            kept = np.lexsort((found, order))[:n - need + 1]
                            prefix = found[kept[order[kept] > 0]].view(np.int64)
                            whole = found.tobytes()
                prefixes.append(prefix)
                sets.append(whole)
        return pa.table([docs["doc_id"], pa.array(counts, pa.int64()), pa.array(prints, pa.string()),
                         pa.array(prefixes, pa.list_(pa.int64())), pa.array(sets, pa.binary())],
                        names=["doc_id", "n_shingles", "print", "prefix", "shingles"])
    return run


def _forest(links: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of the given links those that first connect two components."""
    up: dict[int, int] = {}

    def top(x):
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    out = []
    for a, b in links:
        if (x := top(a)) != (y := top(b)):
            up[x] = y
            out.append((a, b))
    return out


def _linked(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Links between documents of one part, rows with ``far`` false, and all its documents, where labels differ.

        Every document marks its shingles once, and one sum over the marks of all the others gives all intersections.
        """
        key = table["node"].to_numpy()
        _, first = np.unique(key, return_index=True)
        table = table.take(pa.array(first))
        key, label, far = table["node"].to_numpy(), table["label"].to_numpy(), table["far"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        size = np.array([len(s) for s in sets])
        values, ids = np.unique(np.concatenate(sets), return_inverse=True)
        starts, mark = np.concatenate([[0], np.cumsum(size)[:-1]]), np.zeros(len(values), np.int32)
        spans = [ids[i:i + n] for i, n in zip(starts, size)]
        links = []
        for k in range(len(key)):
            if far.any() and not far[k]:
                continue
            mark[spans[k]] = 1
            common = np.add.reduceat(mark[ids], starts)
            mark[spans[k]] = 0
            ok = (100 * common >= percent * (size + size[k] - common)) & (label != label[k])
            links += [(int(key[k]), int(key[j])) for j in np.nonzero(ok)[0]]
        links = _forest(links)
        return pa.table([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])
    return run


def jaccard_components(docs: DataFrame, size: int = 4, percent: int = 85, id_column: str = "doc_id",
                       text_column: str = "text") -> DataFrame:
    """(id, n_shingles, component_id): two documents link if 100 * intersection >= percent * union of their shingle sets.

    Words are lower-cased (A to Z only) and split at ASCII white space. A text with fewer words than a shingle has the
    whole sequence as its one shingle. A null, empty or blank text has no shingle and links with nothing: its component is
    itself. Repeated rows and equal texts link with each other; each row gets a row. Ids may repeat or be null; the
    component is the least id that is not null (null if there is none). An empty table gives an empty result.
    """
    docs = pick(docs, id_column, text_column).toDF("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.withColumn("doc_id", F.col("doc_id").cast(id_type))  # ids may be structs, whose fields are nullable in the results
    total = text_bytes(docs)
    parts = slices(total, SLICE_BYTES)
    bits = code_bits(total // 6, BUCKET_SHINGLES)
    cut = docs.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts))).repartition(parts, "slice")
    asks = cut.mapInArrow(_asks(size, bits), ASKS)
    answers = asks.groupBy("bucket").applyInArrow(packed_answers, ANSWERS)
    found = staged(cut.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(
        _prefixes(size, bits, percent), f"doc_id {id_type}, n_shingles long, print string, prefix array<long>, shingles binary"))
    node = F.xxhash64("print").alias("node")
    candidates = found.where("prefix is not null").select(
        node, F.col("n_shingles").alias("n"), "prefix", F.xxhash64("prefix", "n_shingles").alias("grp"), "shingles")
    edges = _links(candidates, percent)
    labels = components(edges)
    prints = found.groupBy("print").agg(F.min("doc_id").alias("low")).where("print is not null").withColumn("node", F.xxhash64("print"))
    lows = prints.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    roots = lows.groupBy("label").agg(F.min("low").alias("component_id"))
    of_print = lows.join(roots, "label").select("print", "component_id")
    return (found.select("doc_id", "n_shingles", "print").join(of_print, "print", "left")
            .select(F.col("doc_id").alias(id_column), "n_shingles",
                    F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def _links(candidates: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between nodes, enough of them to connect what is linked."""
    members = staged(candidates.groupBy("node").agg(F.any_value("grp").alias("grp"), F.any_value("n").alias("n")))
    sets = candidates.groupBy("node").agg(F.any_value("shingles").alias("shingles"))
    groups = members.groupBy("grp", "n").agg(F.count("*").alias("m"))
    tokens = (candidates.select("grp", F.explode("prefix").alias("token")).distinct().join(groups, "grp"))
    lists = tokens.groupBy("token").agg(
        F.sum("m").alias("total"), F.sum(F.xxhash64("grp").cast("decimal(38,0)")).alias("same")).where("total > 1")
    lists = lists.groupBy("total", "same").agg(F.min("token").alias("token")).drop("same")  # one of the equal lists
    posting = staged(tokens.join(lists, "token"))
    # small lists: pairs of groups, then of members
    short = posting.where(F.col("total") <= SMALL_LIST).select("token", "grp", "n")
    right = short.select("token", F.col("grp").alias("grp2"), F.col("n").alias("n2"))
    met = (short.join(right, "token").where((F.col("grp") <= F.col("grp2")) & (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")))
           .select("grp", "grp2").distinct())
    pairs = (met.join(members.select("grp", F.col("node").alias("a")), "grp")
             .join(members.select(F.col("grp").alias("grp2"), F.col("node").alias("b")), "grp2")
             .where("grp != grp2 or a < b").select("a", "b"))
    one, two = sets.toDF("a", "left"), sets.toDF("b", "right")
    checked = pairs.join(one, "a").join(two, "b").mapInArrow(_verify(percent), "a long, b long")
    edges = staged(checked)
    long = posting.where(F.col("total") > SMALL_LIST)
    if long.isEmpty():
        return edges
    in_list = staged(long.select("token", "grp", "total").join(members.select("grp", "node"), "grp").withColumn(
        "part", F.pmod(F.xxhash64("node", "token"), F.ceil(F.col("total") / PART_DOCUMENTS))).drop("grp"))
    # first every document in its longest list, in parts, each with the same few pivots
    best = in_list.groupBy("node").agg(F.max(F.struct("total", "token")).alias("best"))
    own = in_list.join(best, "node").where("token = best.token").drop("best")
    pivots = (own.groupBy("token", "total").agg(*[F.min(F.struct(F.xxhash64("node", F.lit(k)), "node"))["node"].alias(f"p{k}") for k in range(PIVOTS)])
              .select("token", F.explode(F.array(*[f"p{k}" for k in range(PIVOTS)])).alias("node"),
                      F.explode(F.sequence(F.lit(0), F.ceil(F.col("total") / PART_DOCUMENTS) - 1)).alias("part")))
    first = own.select("token", "part", "node").unionByName(pivots.select("token", "part", "node"))
    inside = (first.join(sets, "node").withColumn("label", F.col("node")).withColumn("far", F.lit(False))
              .groupBy("token", "part").applyInArrow(_linked(percent), "a long, b long"))
    edges = staged(edges.unionByName(inside))
    # then what is outside the largest component of a list, against all of the list
    labels = components(edges)
    named = staged(in_list.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    share = named.groupBy("token", "label").agg(F.count("*").alias("k"))
    main = share.groupBy("token").agg(F.max(F.struct("k", "label"))["label"].alias("main"), F.count("*").alias("labels")).where("labels > 1")
    named = named.join(main, "token")
    rest = named.where("label != main")
    # parts of the rest of a list, by the number of its documents
    deal = rest.groupBy("token").agg(F.ceil(F.count("*") / PART_DOCUMENTS).alias("deals"))
    rest = rest.join(deal, "token").withColumn("deal", F.pmod(F.xxhash64("node"), F.col("deals")))
    near = named.join(deal, "token").select("token", "part", "node", "label", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"),
                                            F.lit(False).alias("far"))
    away = rest.select("token", F.explode(F.sequence(F.lit(0), F.ceil(F.col("total") / PART_DOCUMENTS) - 1)).alias("part"), "node", "label",
                       "deal", F.lit(True).alias("far"))
    across = (away.unionByName(near).groupBy("token", "part", "deal", "node").agg(F.any_value("label").alias("label"), F.max("far").alias("far"))
              .join(sets, "node").groupBy("token", "part", "deal").applyInArrow(_linked(percent), "a long, b long"))
    return staged(edges.unionByName(across))


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run
