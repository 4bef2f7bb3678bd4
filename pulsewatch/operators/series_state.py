"""A daily series as one row: its rows as an array in day order, so that screening, fill and statistics need no further exchange.

``series_state`` is the only shuffle on the series key. All that follows is row-wise: gaps of the calendar, medians, means and
quartiles are expressions on the array. A series has a few rows per day of the window, so its array is bounded; series with more
rows than a limit are told apart beforehand and take the way of ``calendar`` and ``detector`` (equal results).
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hash buckets in which rows are counted to see that no series is oversized.
COUNTED = 4096


def oversized_series(df: DataFrame, key: str, limit: int) -> DataFrame | None:
    """Keys with more than ``limit`` rows, or None.

    Rows are counted in a fixed number of hash buckets first; where no bucket is above the limit, no key is. Keys are counted
    only in the buckets that are. A missing key is a key.
    """
    bucket = F.pmod(F.xxhash64(key, F.col(key).isNull()), F.lit(COUNTED))
    counted = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    full = [r["b"] for r in counted.collect()]      # COUNTED at most
    if not full:
        return None
    rest = df if len(full) == COUNTED else df.where(bucket.isin(full))
    big = rest.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select(key)
    return None if big.isEmpty() else big


def series_rows(df: DataFrame, key: str) -> DataFrame:
    """(key, rows) of all series; one exchange on the key. A missing key is a key.

    Rows are in order of the day and then of the remaining columns, the hash of the attributes last. They are laid by key before they
    are collected: no task builds arrays that another has to take apart again.
    """
    others = sorted((c for c in df.columns if c not in ("day", key)), key=lambda c: c == "attributes_id")
    return df.repartition(key).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("day", *others))).alias("rows"))


def series_state(daily: DataFrame, raw_key: str, cleaned: DataFrame, yesterday: date, required_rows: int) -> DataFrame:
    """(key, rows) of the series fit to be tested; one exchange on the key.

    ``cleaned`` holds the columns of the series' rows; of ``daily``, the same rows with ``__tac`` and ``__unnamed`` beside them, the
    screening rules of ``screening.disqualify`` are worked out in the same aggregation. A series without a name is cleaned to "0"
    and may share this key with a series of that name, so the rules are applied to both apart.
    """
    others = sorted((c for c in cleaned.columns if c not in ("day", raw_key)), key=lambda c: c == "attributes_id")
    recent = [F.lit(yesterday), F.lit(yesterday - timedelta(days=1))]
    since = F.lit(yesterday - timedelta(days=required_rows + 4))

    def unfit(own: Column) -> Column:
        no_row = F.count_if(own & (F.col("day") == recent[0])) == 0
        media = F.sum(F.when(own & F.col("day").isin(*recent), F.bround("__tac", 2)))
        live = F.count_if(own & (F.col("day") >= since))
        return no_row | F.coalesce(media <= 0, F.lit(False)) | live.between(1, required_rows - 1)

    state = daily.groupBy(raw_key).agg(
        F.sort_array(F.collect_list(F.struct("day", *others, "__unnamed"))).alias("rows"),
        unfit(~F.col("__unnamed")).alias("unfit"), unfit(F.col("__unnamed")).alias("unfit_unnamed"))
    kept = F.filter("rows", lambda x: ~F.when(x["__unnamed"], F.col("unfit_unnamed")).otherwise(F.col("unfit")))
    return state.select(raw_key, kept.alias("rows")).where(F.size("rows") > 0)


def calendar_of(*days: DataFrame) -> Column:
    """One row for all tasks, as a scalar: the last day of all frames' ``day``, and the days between the first and the last that
    no row has."""
    seen = days[0]
    for more in days[1:]:
        seen = seen.unionByName(more)
    span = seen.agg(F.min("day").alias("lo"), F.max("day").alias("hi"), F.collect_set("day").alias("days"))
    return span.select(F.struct("hi", F.array_except(F.sequence("lo", "hi"), "days").alias("unseen")).alias("c")).scalar()


def _quantile(ordered: str, probability: float) -> str:
    """Linear interpolation in a sorted array, as ``percentile`` does it."""
    at = f"((size({ordered}) - 1) * {probability}D)"
    low, high = f"{ordered}[CAST(floor({at}) AS INT)]", f"{ordered}[CAST(ceil({at}) AS INT)]"
    return f"IF(floor({at}) = ceil({at}), {low}, (ceil({at}) - {at}) * {low} + ({at} - floor({at})) * {high})"


def filled(state: DataFrame, key: str, metrics: list[str], calendar: Column, beside: tuple[str, ...] = ()) -> DataFrame:
    """The series with the rows that ``calendar.calendar_fill`` adds, by the same rules; columns ``beside`` the rows are kept."""
    columns = [f.name for f in state.schema["rows"].dataType.elementType.fields]
    own = [f"`{c}`" for c in (key, *beside)]
    rows = state.withColumn("c", calendar).selectExpr(
        *own, "rows", "c.unseen AS unseen", "array_except(sequence(rows[0].day, c.hi), rows.day) AS own",
        *[f"sort_array(rows.`{m}`) AS `{m}__sorted`" for m in metrics])
    rows = rows.selectExpr(*own, "rows", "unseen", "array_union(own, unseen) AS gaps", *[f"{_quantile(f'`{m}__sorted`', 0.5)} AS `{m}__median`" for m in metrics])
    values = ", ".join(
        "'day', g" if c == "day" else f"'{c}', IF(array_contains(unseen, g), `{c}__median`, 0D)" if c in metrics else f"'{c}', rows[0].`{c}`" for c in columns)
    return rows.selectExpr(*own, f"concat(rows, transform(gaps, g -> named_struct({values}))) AS rows")


def long_rows(state: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The rows of the series as a daily frame again."""
    return state.select(key, F.explode("rows").alias("r")).select(*[F.col(c) if c == key else F.col(f"r.{c}") for c in columns])


def state_stats(state: DataFrame, key: str, metrics: list[str], yesterday: date, latest: list[str]) -> DataFrame:
    """What ``detector.detector_stats`` finds, and for each column of ``latest`` its greatest value yesterday as ``<name>_yesterday``."""
    rows = state.selectExpr(
        f"`{key}`", "rows", f"filter(rows, x -> x.day = DATE '{yesterday}') AS now", f"filter(rows, x -> x.day = DATE '{yesterday - timedelta(days=1)}') AS before",
        *[f"sort_array(rows.`{m}`) AS `{m}__sorted`" for m in metrics],
        *[f"aggregate(rows.`{m}`, 0D, (s, v) -> s + v) / size(rows) AS `{m}__mean`" for m in metrics])
    per_kpi = ", ".join(
        f"named_struct('kpi', '{m}', 'mean', `{m}__mean`, 'variance', IF(size(rows) > 1, aggregate(rows.`{m}`, 0D, (s, v) -> s + (v - `{m}__mean`) * (v - `{m}__mean`)) "
        f"/ (size(rows) - 1), NULL), 'q1', {_quantile(f'`{m}__sorted`', 0.25)}, 'median', {_quantile(f'`{m}__sorted`', 0.5)}, 'q3', {_quantile(f'`{m}__sorted`', 0.75)}, "
        f"'value', CAST(array_max(now.`{m}`) AS DOUBLE), 'value_before', CAST(array_min(before.`{m}`) AS DOUBLE))" for m in metrics)
    return rows.selectExpr(
        f"`{key}`", "CAST(size(rows) AS BIGINT) AS n_rows", "array_max(rows.day) AS last_day", "CAST(size(now) AS BIGINT) AS n_yesterday",
        *[f"array_max(now.`{c}`) AS `{c}_yesterday`" for c in latest], f"inline(array({per_kpi}))")
