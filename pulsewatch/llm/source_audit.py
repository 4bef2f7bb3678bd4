"""How far the sources of a language use words differently: exact divergences from count-level bitmaps.

Terms are counted by language and source. Every kept term of a language gets a bit in a 64-bit word, terms of like frequency
together. For each source, word and count the terms with just that count are one bitset. Two sources' joint cells (terms with
count c here and d there) are the popcount of the AND of two bitsets, multiplied by f(c, d). Cells with a zero come by complement
from how many terms each source has at each count, so terms that a source lacks are stored nowhere:

    sum f = sum over joint cells of [f(c,d) - f(c,0) - f(0,d) + f(0,0)] + sum_c H(c) [f(c,0) - f(0,0)] + sum_d H'(d) [f(0,d) - f(0,0)] + V f(0,0)

All sums are exact in 64 bits for up to 5e8 kept terms a language and 9e15 occurrences. Work is dealt out by blocks of terms and
tiles of sources; a task holds one block of two tiles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsewatch.llm.common import Words, bounded, cut_long, pick, staged

#: Scale of a probability, as a whole number.
SCALE = 1_000_000_000
#: Terms of a block and sources of a tile, about.
BLOCK, TILE = 1024, 64
#: Bytes of text counted at a time, joint cells looked at in one step, and rows of a table that may be sent to all tasks.
STEP_BYTES, STEP_CELLS, SENT_ROWS = 8 << 20, 1 << 21, 200_000
#: Bytes outside terms: ASCII but letters.
_OUTSIDE = np.zeros(256, bool)
_OUTSIDE[[*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


# ---- counting ---------------------------------------------------------------

def _long_counts(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """Terms of one long text, counted part by part, and how often they occur."""
    parts = []
    for part in cut_long(text, STEP_BYTES):
        words = Words(pa.array([part], pa.binary()).cast(pa.string()), between=_OUTSIDE)
        parts.append(pa.table([words.values, pa.array(np.bincount(words.ids, minlength=len(words.values)))], names=["term", "n"]))
    whole = pa.concat_tables(parts).group_by("term").aggregate([("n", "sum")])
    return whole["term"].combine_chunks(), whole["n_sum"].to_numpy()


def _term_counts(batches):
    """(lang, source, term, n, docs) of some documents: occurrences, and documents that have the term."""
    for batch in bounded(batches, "text", STEP_BYTES):
        if batch.num_rows == 1 and len(text := batch.column("text")[0].as_py().encode()) > STEP_BYTES:
            term, n = _long_counts(text)
            same = [pa.array(batch.column(c).to_pylist() * len(term), pa.string()) for c in ("lang", "source")]
            yield pa.RecordBatch.from_arrays([*same, term.cast(pa.string()), pa.array(n), pa.array(np.ones(len(n), np.int64))],
                                             names=["lang", "source", "term", "n", "docs"])
            continue
        lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        group = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(source.dictionary) + source.indices.to_numpy(zero_copy_only=False)
        words = Words(batch.column("text"), between=_OUTSIDE)
        many = max(1, len(words.values))
        row = np.repeat(np.arange(batch.num_rows), np.diff(words.ends))
        in_text, n = np.unique(row * many + words.ids, return_counts=True)
        key, place = np.unique(group[in_text // many] * many + in_text % many, return_inverse=True)
        group, term = key // many, pa.array(key % many)
        yield pa.RecordBatch.from_arrays(
            [lang.dictionary.take(pa.array(group // len(source.dictionary))).cast(pa.string()), source.dictionary.take(pa.array(group % len(source.dictionary))).cast(pa.string()),
             words.values.take(term).cast(pa.string()), pa.array(np.bincount(place, n, len(key)).astype(np.int64)), pa.array(np.bincount(place, minlength=len(key)))],
            names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """One row for each language, source and term that occurs, from columns lang, source and text without nulls."""
    return (docs.mapInArrow(_term_counts, "lang string, source string, term string, n long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def sendable(df: DataFrame) -> DataFrame:
    """Marked to be sent to all tasks if it is counted to have few rows; else the join shuffles."""
    return F.broadcast(df) if df.limit(SENT_ROWS + 1).count() <= SENT_ROWS else df


def kept_terms(counts: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term, total, block, word, bit): the terms of a language in enough of its documents. Blocks hold terms of one
    frequency class, so a bitset of a rare class has few counts."""
    kept = staged(counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
                  .select("lang", "term", "total", F.floor(F.log2("total")).cast("int").alias("level")))
    sizes = kept.groupBy("lang", "level").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    block = F.concat_ws(".", "level", F.pmod(F.xxhash64("term"), F.col("blocks")))
    number = F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")) - 1
    return (kept.join(sendable(sizes), ["lang", "level"]).withColumn("block", block)
            .select("lang", "term", "total", "block", F.floor(number / 64).cast("int").alias("word"), (number % 64).alias("bit")))


# ---- exact arithmetic -------------------------------------------------------

def _share(n: np.ndarray, base: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (n + 1) / base) by long division in steps of a thousand."""
    rest, out = n + 1, np.zeros(np.broadcast(n, base).shape, np.int64)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, base)
        out = out * 1000 + more
    return out + 1


def _far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def share(n: str, base: str) -> Column:
    """The same for columns; in decimals where the product may not fit in 64 bits."""
    return F.expr(f"1 + CASE WHEN {n} < 9000000000 THEN ({n} + 1) * {SCALE}L div {base} "
                  f"ELSE CAST({n} + 1 AS DECIMAL(20, 0)) * {SCALE} div CAST({base} AS DECIMAL(20, 0)) END")


PAIRS = "lang string, source string, item string, value long"


def _table(lang: str, sources: list[np.ndarray], value: np.ndarray) -> pa.Table:
    """Rows of a matrix of values, without the diagonal."""
    here, there = (pa.array(s, pa.string()) for s in sources)
    i, j = np.nonzero(sources[0][:, None] != sources[1][None, :])
    return pa.table([pa.array([lang] * len(i), pa.string()), here.take(pa.array(i)), there.take(pa.array(j)), pa.array(value[i, j])],
                    names=["lang", "source", "item", "value"])


def _sides(table: pa.Table, *columns: str) -> list[tuple]:
    """For both tiles of a pair the distinct sources, the place of each row's source among them, its base and further columns."""
    out = []
    for side in (True, False):
        rows = table.filter(pc.equal(table["here"], side))
        source, first, place = np.unique(np.array(rows["source"].to_pylist(), object), return_index=True, return_inverse=True)
        base = rows["base"].to_numpy()
        out.append((source, place, base[first], base, *[rows[c].to_numpy() for c in columns]))
    return out


def _joint(table: pa.Table) -> pa.Table:
    """One block's terms that both sources have, for all pairs of one source here and one there."""
    (here, g, g_base, base, word, n, bits), (there, h, h_base, base2, word2, n2, bits2) = _sides(table, "word", "n", "bits")
    value = np.zeros((len(here), len(there)), np.int64)
    p, q, p0, q0 = _share(n, base), _share(n2, base2), _share(np.int64(0), g_base), _share(np.int64(0), h_base)
    order, order2 = np.argsort(word, kind="stable"), np.argsort(word2, kind="stable")
    for w in np.intersect1d(word, word2):
        left, right = (o[np.searchsorted(x[o], w):np.searchsorted(x[o], w, "right")] for o, x in ((order, word), (order2, word2)))
        for part in np.array_split(left, len(left) * len(right) // STEP_CELLS + 1):
            both = bits[part, None] & bits2[None, right]
            x, y = np.nonzero(both)
            cell = np.bitwise_count(both[x, y].view(np.uint64)).astype(np.int64)
            x, y = part[x], right[y]
            a, b, a0, b0 = p[x], q[y], p0[g[x]], q0[h[y]]
            np.add.at(value, (g[x], h[y]), cell * (_far(a, b) - _far(a, b0) - _far(a0, b) + _far(a0, b0)))
    return _table(table["lang"][0].as_py(), [here, there], value)


def _rest(table: pa.Table) -> pa.Table:
    """The cells with a zero, by complement, for all pairs of one source here and one there."""
    (here, g, g_base, base, n, k), (there, h, h_base, base2, n2, k2) = _sides(table, "n", "k")
    terms = table["terms"][0].as_py()
    value = np.zeros((len(here), len(there)), np.int64)
    if terms:
        p0, q0 = _share(np.int64(0), g_base), _share(np.int64(0), h_base)
        none = _far(p0[:, None], q0[None, :])
        p, q = _share(n, base), _share(n2, base2)
        for part in np.array_split(np.arange(len(p)), len(p) * len(there) // STEP_CELLS + 1):
            np.add.at(value, g[part], k[part, None] * (_far(p[part, None], q0[None, :]) - none[g[part]]))
        for part in np.array_split(np.arange(len(q)), len(q) * len(here) // STEP_CELLS + 1):
            np.add.at(value.T, h[part], k2[part, None] * (_far(p0[None, :], q[part, None]) - none.T[h[part]]))
        value += terms * none
    return _table(table["lang"][0].as_py(), [here, there], value)


def _dealt(rows: DataFrame) -> DataFrame:
    """Every row once for each pair of tiles that its own one is part of, on either side."""
    others = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    one = rows.withColumn("other", others)
    sides = F.explode(F.array(F.struct(F.col("tile").alias("i"), F.col("other").alias("j"), F.lit(True).alias("here")),
                              F.struct(F.col("other").alias("i"), F.col("tile").alias("j"), F.lit(False).alias("here"))))
    return one.withColumn("side", sides).select("*", "side.i", "side.j", "side.here").drop("side", "other", "tile", "tiles")


def divergences(docs: DataFrame, least_docs: int = 3, ranks: int = 200, lang_column: str = "lang", source_column: str = "source",
                text_column: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank) of every language and source that occurs.

    Terms are runs of ASCII letters, in lower case, and non-ASCII characters; a language keeps those in at least ``least_docs`` of
    its documents, V of them. A group gives a kept term with n occurrences p = 1 + floor(1e9 (n + 1) / (N + V)), N being all its
    occurrences of kept terms; f = floor((p - q)^2 / q). Part ``pair``: the other sources of the language, q theirs, f summed over
    all kept terms (0 without terms). Part ``term``: the ``ranks`` terms with the largest f among those that the group has and
    uses more than the whole language, whose share is q. Ranks go by value, the largest first, ties by the bytes of the item.

    Null texts, languages and sources are empty ones; a group without terms has a row for each other source. Repeated rows count
    as often as they occur. A text of any length is counted whole. Extra columns do not matter; an empty table gives an empty result.
    """
    docs = pick(docs, lang_column, source_column, text_column).toDF("lang", "source", "text").fillna("", ["lang", "source", "text"])
    counts = staged(term_counts(docs))
    kept = staged(kept_terms(counts, least_docs))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_n"))
    cells = staged(counts.drop("docs").join(kept, ["lang", "term"]))
    seen = docs.groupBy("lang", "source").agg(F.lit(0).alias("none")).drop("none")
    tiles = F.ceil(F.col("sources") / F.lit(TILE)).cast("int")
    groups = staged(seen.join(cells.groupBy("lang", "source").agg(F.sum("n").alias("all_n")), ["lang", "source"], "left")
                    .join(langs, "lang", "left").join(seen.groupBy("lang").agg(F.count("*").alias("sources")), "lang")
                    .select("lang", "source", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("lang_n", F.lit(0)).alias("lang_n"),
                            (F.coalesce("all_n", F.lit(0)) + F.coalesce("terms", F.lit(0))).alias("base"), tiles.alias("tiles"),
                            F.pmod(F.xxhash64("source"), tiles).cast("int").alias("tile")))
    about = sendable(groups)
    # the bitsets: bit by bit into words, combined before the shuffle
    bitmaps = cells.groupBy("lang", "source", "n", "block", "word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    laid = _dealt(bitmaps.join(about.select("lang", "source", "base", "tile", "tiles"), ["lang", "source"]))
    joint = laid.groupBy("lang", "block", "i", "j").applyInArrow(_joint, PAIRS)
    levels = cells.groupBy("lang", "source", "n").agg(F.count("*").alias("k"))
    filled = groups.join(levels, ["lang", "source"], "left").fillna(0, ["n", "k"])
    rest = _dealt(filled.select("lang", "source", "terms", "base", "tile", "tiles", "n", "k")).groupBy("lang", "i", "j").applyInArrow(_rest, PAIRS)
    pairs = joint.unionByName(rest).groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair"))
    used = (cells.join(about.select("lang", "source", "terms", "lang_n", "base"), ["lang", "source"])
            .withColumn("lang_base", F.col("lang_n") + F.col("terms")).withColumns({"p": share("n", "base"), "q": share("total", "lang_base")}).where("p > q")
            .select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"), F.lit("term").alias("part")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ("lang", "source", "part", "item", "value", "rank")
    top = used.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    return top.select(*columns).unionByName(pairs.withColumn("rank", F.row_number().over(order)).select(*columns))


def oracle() -> str:
    """The same in DuckDB, every pair of sources over all kept terms."""
    return r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*)::BIGINT AS total FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*)::BIGINT AS v, sum(total)::BIGINT AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT t.lang, t.source, t.term, count(*)::BIGINT AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
n AS (SELECT g.lang, g.source, coalesce(sum(c), 0)::BIGINT AS n FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
p AS (SELECT n.lang, n.source, kept.term, kept.total, coalesce(c.c, 0) AS c,
             (1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1)) // (n.n + v.v))::HUGEINT AS p
      FROM n JOIN v ON v.lang = n.lang JOIN kept ON kept.lang = n.lang
      LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.term = kept.term),
far AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(far.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
q AS (SELECT p.*, (1 + (1000000000::HUGEINT * (p.total + 1)) // (v.n + v.v))::HUGEINT AS q FROM p JOIN v USING (lang) WHERE c > 0),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM q WHERE p > q)
SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 200"""
