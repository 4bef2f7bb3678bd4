"""Quality rules with a verdict on hosts, in DataFrame functions only.

Every text is measured and held against fixed rules. The failures are summed up by host; the failure rate of a host is shrunk
towards the others' by a beta prior that is fitted to all hosts by the method of moments, so that hosts of a few documents
are not judged by chance. A host is bad if its rate is clearly above the others': if the lower end of what its posterior allows
(95 %, one-sided, normal approximation) is above the mean of all hosts. A document stays if it passes the plain rules; on a bad
host it must also pass the strict form of those on repeated words, symbols and repeated lines. Texts are not judged more strictly
for being short, since that says nothing about a host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import pick, staged

BLANKS, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
WINDOW = 3
#: Standard deviations of the posterior by which a bad host's rate is above the mean: the 95 % quantile of the normal distribution.
CLEARLY = 1.6448536269514722


def _repeat_words(words: Column) -> Column:
    """Words inside windows that occur twice or more: windows are sorted by hash, equal neighbours give the repeated ones,
    and their places, in order, each add the words that the one before has not covered."""
    windows = F.when(F.size(words) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.struct(F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]).alias("h"), i.alias("p"))))
    return F.sort_array(F.coalesce(windows, F.expr("array_repeat(named_struct('h', 0L, 'p', 0), 0)")))


def _covered(places: Column) -> Column:
    return F.aggregate(places, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
                       lambda done, p: F.struct(p.alias("last"), (done["n"] + F.least(F.lit(WINDOW), p - done["last"])).alias("n")), lambda done: done["n"])


def measures(docs: DataFrame) -> DataFrame:
    """The given rows (with a column text) with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words."""
    text = F.coalesce("text", F.lit(""))
    cut = docs.withColumn("text", text).withColumn("words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")).withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda x: F.translate(x, BLANKS, "") != ""))
    sorted_windows = cut.withColumn("windows", _repeat_words(F.col("words")))
    same = lambda x, k, step: F.coalesce(F.get(F.col("windows"), k + step)["h"] == x["h"], F.lit(False))
    places = sorted_windows.withColumn("places", F.sort_array(F.transform(
        F.filter("windows", lambda x, k: same(x, k, -1) | same(x, k, 1)), lambda x: x["p"])))
    return places.withColumns({
        "n_words": F.size("words").cast("long"), "word_chars": F.length(F.translate("text", BLANKS, "")).cast("long"),
        "n_symbols": (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long"), "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"), "n_repeat_words": _covered(F.col("places")).cast("long"),
    }).drop("words", "lines", "windows", "places", "text")


def _failures(short: int, repeat: int, symbols: int, lines: int) -> Column:
    """Shares in percent: of repeated words, of symbols to characters in words, of repeated lines."""
    return ((F.col("n_words") < short) | (100 * F.col("n_repeat_words") > repeat * F.col("n_words"))
            | (100 * F.col("n_symbols") > symbols * F.col("word_chars")) | (100 * F.col("n_dup_lines") > lines * F.col("n_lines")))


def host_verdicts(measured: DataFrame) -> DataFrame:
    """(host, n_docs, n_failed, host_rate, bad_host): observed failures and the shrunk rate of every host, one row per host."""
    hosts = measured.groupBy("host").agg(F.count("*").alias("n_docs"), F.count_if("failed").alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    about = hosts.agg(F.avg(rate), F.var_samp(rate), F.avg(1 / F.col("n_docs"))).first()
    mean, spread = about[0] or 0.0, (about[1] or 0.0) - (about[0] or 0.0) * (1 - (about[0] or 0.0)) * (about[2] or 0.0)
    # with no more spread than chance gives, hosts do not differ: the prior weighs as much as a thousand documents
    weight = min(max(mean * (1 - mean) / spread - 1, 1.0), 1000.0) if spread > 0 else 1000.0
    size = F.col("n_docs") + F.lit(weight)
    shrunk = hosts.withColumn("host_rate", (F.col("n_failed") + F.lit(mean * weight)) / size)
    spread = F.sqrt(F.col("host_rate") * (1 - F.col("host_rate")) / (size + 1))
    return shrunk.withColumn("bad_host", F.col("host_rate") - F.lit(CLEARLY) * spread > F.lit(mean))


def host_rules(docs: DataFrame, id_column: str = "doc_id", host_column: str = "source", text_column: str = "text") -> DataFrame:
    """One row for every document: the id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, host_rate.

    A null text is an empty one and fails (no words). Documents without a host form one host of their own. Repeated rows count and
    appear as often as they occur; ids may repeat or be null. Extra columns do not matter; an empty table gives an empty result.
    """
    docs = pick(docs, id_column, host_column, text_column).toDF("doc_id", "host", "text")
    measured = staged(measures(docs).withColumns({
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "failed": _failures(50, 50, 10, 30), "strictly_failed": _failures(50, 20, 5, 10)}))
    hosts = host_verdicts(measured).select(F.col("host").alias("of_host"), "host_rate", "bad_host")
    return (measured.join(hosts, F.col("host").eqNullSafe(F.col("of_host")))
            .withColumn("kept", ~F.col("base_failed") & ~F.col("failed") & (~F.col("bad_host") | ~F.col("strictly_failed")))
            .select(F.col("doc_id").alias(id_column), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                    F.round("host_rate", 9).alias("host_rate")))


def oracle() -> str:
    """The same in DuckDB: windows and covered places as rows."""
    return r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
windows AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, i + unnest([0, 1, 2]) AS p FROM twice) GROUP BY r),
m AS (
  SELECT d.r, doc_id, source, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM d LEFT JOIN covered ON covered.r = d.r),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * n_lines AS failed,
         n_words < 50 OR 100 * n_repeat_words > 20 * n_words OR 100 * n_symbols > 5 * word_chars OR 100 * n_dup_lines > 10 * n_lines AS strict
  FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (failed) AS k FROM f GROUP BY source),
s AS (SELECT avg(k / n) AS mean, coalesce(var_samp(k / n), 0) - avg(k / n) * (1 - avg(k / n)) * avg(1 / n) AS spread FROM h),
p AS (SELECT mean, CASE WHEN spread > 0 THEN least(greatest(mean * (1 - mean) / spread - 1, 1), 1000) ELSE 1000 END AS weight FROM s),
v AS (SELECT source, (k + mean * weight) / (n + weight) AS rate, n + weight AS size, mean FROM h, p),
w AS (SELECT source, rate, rate - 1.6448536269514722e0 * sqrt(rate * (1 - rate) / (size + 1)) > mean AS bad FROM v)
SELECT f.doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT failed AND NOT (bad AND strict) AS kept, round(rate, 9) AS host_rate
FROM f JOIN w ON f.source IS NOT DISTINCT FROM w.source"""
