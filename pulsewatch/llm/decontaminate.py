"""Benchmark decontamination by SimHash over item-sized windows, in DataFrame functions only.

1. A window that is similar enough to an item shares a shingle with it. So windows as long as the item are laid on every
   shingle that a document shares with the benchmark, the two shingles on top of each other: no window that could pass is left out here.
2. Equal windows collapse. Every window and every item gets a SimHash of 128 bits over its weighted shingles.
3. Multi-index search: the fingerprint has BLOCKS blocks. Two fingerprints that differ in at most RADIUS bits differ in at most
   RADIUS // BLOCKS bits on one block at least, so the index of the items holds every block value with up to so many bits
   flipped, and the blocks of the windows are joined with it. All pairs within the radius meet. The radius itself misses some
   pairs at the edge: of simulated pairs with a similarity of 0.80 to 0.83, 36 of 20,000 were beyond it (0.13 to 0.28 % by length).
4. Pairs within the radius are verified by the exact similarity of their weighted shingles: the shingles count as often as they
   occur, times their characters; the sum of the smaller over the sum of the larger weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import pick, staged

SIZE, SIMILARITY = 5, 0.8
BLOCKS, BLOCK_BITS, RADIUS = 8, 16, 31
#: Shingles of the benchmark up to this number (and their bytes) are sent to all tasks; more are joined by a shuffle.
BROADCAST_SHINGLES = 1_000_000


def _words(text: str) -> Column:
    """Words in lower case without punctuation."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\x20\x09-\x0D]+", "")
    return F.array_remove(F.split(plain, r"[\x20\x09-\x0D]+"), "")


def _hashes(words: Column) -> Column:
    """Hashes of all runs of SIZE words; of the whole if it is shorter; none without words."""
    return (F.when(F.size(words) >= SIZE, F.transform(F.sequence(F.lit(0), F.size(words) - SIZE),
                                                      lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SIZE)])))
            .when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.expr("array_repeat(0L, 0)")))


def _weighted(rows: DataFrame, key: str, words: str) -> DataFrame:
    """(key, h, h2, w): the distinct shingles of every row's words with their weights."""
    runs = (F.when(F.size(words) >= SIZE, F.transform(F.sequence(F.lit(1), F.size(words) - SIZE + 1), lambda i: F.slice(F.col(words), i, SIZE)))
            .when(F.size(words) > 0, F.array(F.col(words))))
    shingle = F.concat_ws(" ", "run")
    return (rows.select(key, F.explode_outer(runs).alias("run")).where("run is not null").groupBy(key, shingle.alias("shingle")).agg(F.count("*").alias("n"))
            .select(key, F.xxhash64("shingle").alias("h"), F.xxhash64("shingle", F.lit(2)).alias("h2"),
                    (F.col("n") * F.length("shingle")).alias("w")))


def _fingerprints(weighted: DataFrame, key: str) -> DataFrame:
    """(key, a, b, whole): the two halves of the SimHash and the sum of all weights."""
    def bits(half: str) -> Column:
        return F.expr(f"""aggregate(sequence(0, 63), 0L, (found, k) -> found | CASE WHEN aggregate(shingles, 0L, (t, s) ->
            t + CASE WHEN shiftright(s.{half}, k) & 1L = 1L THEN s.w ELSE -s.w END) > 0 THEN shiftleft(1L, k) ELSE 0L END)""")
    grouped = weighted.groupBy(key).agg(F.collect_list(F.struct("h", "h2", "w")).alias("shingles"), F.sum("w").alias("whole"))
    return grouped.select(key, bits("h").alias("a"), bits("h2").alias("b"), "whole")


def _blocks() -> Column:
    """(block, value) of all blocks of a fingerprint."""
    half = BLOCKS // 2
    return F.explode(F.array(*[F.struct(F.lit(k).alias("block"), F.shiftrightunsigned("a" if k < half else "b", BLOCK_BITS * (k % half))
                                        .bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int").alias("value")) for k in range(BLOCKS)])).alias("at")


def matches(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, doc_key, item_id, start, n_words, similarity): for each document and item that has a similar window, the best one.

    ``doc_key`` is a hash of id and text, start the first word of the window (ties: the first window). Null and empty texts, and
    texts of punctuation only, match nothing. A text or item shorter than a shingle is one shingle, so a short item is found
    where it is the whole text. Repeated rows are one document here, repeated items all match; ids may be null. Extra columns
    do not matter; empty tables give an empty result.
    """
    docs = pick(docs, "doc_id", "text").withColumn("doc_key", F.xxhash64("doc_id", "text"))
    items = pick(items, "item_id", "text")
    items = staged(items.withColumn("item", F.xxhash64("item_id", "text")).groupBy("item").agg(
        F.any_value("item_id").alias("item_id"), F.any_value("text").alias("text")).withColumn("words", _words("text")).drop("text"))
    anchors = staged(items.select(F.size("words").alias("n"), F.posexplode_outer(_hashes(F.col("words"))).alias("q", "h")).where("h is not null").distinct())
    seeds = F.broadcast(anchors) if anchors.count() <= BROADCAST_SHINGLES else anchors
    # explode_outer: Spark turns explode into a filter on the array, which would compute the words anew for every element
    cut = docs.select("doc_key", _words("text").alias("words")).select("doc_key", F.size("words").alias("size"), _hashes(F.col("words")).alias("hashes"))
    starts = F.greatest(F.lit(0), F.least(F.col("p") - F.col("q"), F.col("size") - F.col("n")))
    laid = (cut.select("doc_key", "size", F.posexplode_outer("hashes").alias("p", "h")).join(seeds, "h")
            .select("doc_key", "n", starts.alias("start")).distinct())
    windows = staged(docs.join(laid, "doc_key").withColumn("words", _words("text")).withColumn("window", F.slice("words", F.col("start") + 1, F.col("n")))
                     .select("doc_id", "doc_key", "start", "n", F.md5(F.concat_ws(" ", "window")).alias("content"), "window"))
    contents = staged(_weighted(windows.groupBy("content").agg(F.any_value("window").alias("window")), "content", "window"))
    wanted = staged(_weighted(items, "item", "words"))
    prints, targets = staged(_fingerprints(contents, "content")), staged(_fingerprints(wanted, "item"))
    flips = [x for x in range(1 << BLOCK_BITS) if x.bit_count() <= radius // BLOCKS]
    index = (targets.select("item", F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("whole").alias("whole2"), _blocks())
             .select("item", "a2", "b2", "whole2", F.col("at.block").alias("block"), F.explode(F.transform(
                 F.array(*map(F.lit, flips)), lambda x: x.bitwiseXOR(F.col("at.value")))).alias("value")))
    near = (prints.select("content", "a", "b", "whole", _blocks()).select("content", "a", "b", "whole", "at.block", "at.value")
            .join(index.hint("merge"), ["block", "value"])  # its size is not that of the file it is exploded from
            .where(F.bit_count(F.col("a").bitwiseXOR(F.col("a2"))) + F.bit_count(F.col("b").bitwiseXOR(F.col("b2"))) <= radius)
            .select("content", "item", "whole", "whole2").distinct())
    both = near.join(contents.select("content", "h", "w"), "content").join(wanted.select("item", "h", F.col("w").alias("w2")), ["item", "h"])
    common = both.groupBy("content", "item", "whole", "whole2").agg(F.sum(F.least("w", "w2")).alias("common"))
    similar = common.withColumn("similarity", F.col("common") / (F.col("whole") + F.col("whole2") - F.col("common"))).where(F.col("similarity") >= similarity)
    found = (windows.select("doc_id", "doc_key", "start", "n", "content").join(similar.select("content", "item", "similarity"), "content")
             .groupBy("doc_key", "item").agg(F.any_value("doc_id").alias("doc_id"), F.max(F.struct(
                 "similarity", (-F.col("start")).alias("back"), "n")).alias("best")))
    return found.join(items.select("item", "item_id"), "item").select(
        "doc_id", "doc_key", "item_id", (-F.col("best.back")).alias("start"), F.col("best.n").alias("n_words"), F.col("best.similarity").alias("similarity"))


def decontaminated(docs: DataFrame, items: DataFrame, *columns: str) -> DataFrame:
    """The documents (the named columns) without those that hold an item; null texts stay."""
    rows = pick(docs, *columns).withColumn("doc_key", F.xxhash64("doc_id", "text"))
    return rows.join(matches(docs, items).select("doc_key").distinct(), "doc_key", "left_anti").select(*columns)
