"""Week grids, distinct-source trends, equal-weight shares, baselines, drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import calendar
from tidemark.operators.ordered import packed as packed
from tidemark.operators.ordered import with_place
from tidemark.operators.relational import filled_grid

LOW_VOLUME = 10


def week_grid(rows: DataFrame, day: str, length: int = 7) -> DataFrame:
    """week, start, end, n_days, partial: runs of days anchored at the first day of rows. One aggregate row is spread out by a generator; nothing is collected."""
    span = rows.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    weeks = span.where("first is not null").select("first", "last", F.explode(F.sequence(F.lit(0), calendar.week_index(F.col("last"), F.col("first"), length))).alias("week"))
    start, end = calendar.week_bounds(F.col("week"), F.col("first"), F.col("last"), length)
    weeks = weeks.select("week", start.alias("start"), end.alias("end"))
    return weeks.withColumn("n_days", F.datediff("end", "start") + 1).withColumn("partial", F.col("n_days") < length)


def with_week(rows: DataFrame, day: str, length: int = 7, anchor: DataFrame | None = None) -> DataFrame:
    """rows with the index of their week; the anchor is the first day of rows, or of another table with the column `first`."""
    first = anchor if anchor is not None else rows.agg(F.min(day).alias("first"))
    return rows.crossJoin(F.broadcast(first)).withColumn("week", calendar.week_index(F.col(day), F.col("first"), length)).drop("first")


def distinct_trend(rows: DataFrame, key: str, day: str, source: str, item: str, among: Column | None = None) -> DataFrame:
    """key, week, n_sources, n_items, low_volume, partial for every key and week.

    Sources and items are counted once a week, never summed from days. A filter `among` takes rows out of the
    counts, but not out of the grid.
    """
    weeks = week_grid(rows, day)
    counted = with_week(rows, day) if among is None else with_week(rows, day).where(among)
    counted = counted.groupBy(key, "week").agg(F.countDistinct(source).alias("n_sources"), F.countDistinct(item).alias("n_items"))
    grid = filled_grid(counted, rows.select(key).where(F.col(key).isNotNull()).distinct(), weeks, [key, "week"], "n_sources", "n_items")
    return grid.select(key, "week", "n_sources", "n_items", (F.col("n_items") < LOW_VOLUME).alias("low_volume"), "partial")


def source_shares(rows: DataFrame, week: str, source: str, key: str, item: str) -> DataFrame:
    """Per week and key: share (each source that reported any pair weighs the same; a source without the key counts 0), pooled share, n_named, n_reporting.

    sum(n / pairs of the source and week) over the number of sources that reported in the week.
    """
    cells = rows.groupBy(week, source, key).agg(F.countDistinct(item).alias("n"))
    cells = cells.withColumn("pairs", F.sum("n").over(Window.partitionBy(week, source)))
    totals = cells.groupBy(week).agg(F.countDistinct(source).alias("n_reporting"), F.sum("n").alias("all_pairs"))
    named = cells.groupBy(week, key).agg(F.sum(F.col("n") / F.col("pairs")).alias("weighed"), F.sum("n").alias("n_named"))
    out = named.join(totals, week)
    return out.select(week, key, (100 * F.col("weighed") / F.col("n_reporting")).alias("share"), (100 * F.col("n_named") / F.col("all_pairs")).alias("pooled"), "n_named", "n_reporting")


def strict_change(series: DataFrame, key: str, week: str, value: str, base: int, first_week: int = 0) -> DataFrame:
    """change = value less the mean of the `base` weeks before, on a gapless series; null unless all of them lie from first_week on and the value is there. A missing base value counts 0."""
    w = Window.partitionBy(key).orderBy(week).rowsBetween(-base, -1)
    mean = F.avg(F.coalesce(F.col(value), F.lit(0.0))).over(w)
    return series.withColumn("change", F.when(F.col(week) >= first_week + base, F.col(value) - mean))


def thin_evidence(now: Column, baseline: Column, least: float = 10) -> Column:
    return (now < least) | (F.coalesce(baseline, F.lit(0)) < least)


def same_sign(a: Column, b: Column) -> Column:
    """Both up, both down, or both 0."""
    return F.signum(a) == F.signum(b)


def neighbour_outliers(days: DataFrame, day: str, total: str, window: int = 3, ratio: float = 2.5) -> DataFrame:
    """Days at `ratio` times the median of up to `window` existing days before and as many after. days is one row a day: a calendar's length, so one ordered window."""
    w = Window.orderBy(day)
    around = F.array_sort(F.concat(F.collect_list(total).over(w.rowsBetween(-window, -1)), F.collect_list(total).over(w.rowsBetween(1, window))))
    n = F.size("_around")
    at = lambda k: F.get("_around", k.cast("int"))
    out = days.withColumn("_around", around)
    out = out.withColumn("baseline", F.when(n > 0, (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2)).drop("_around")
    return out.withColumn("flagged", F.coalesce(F.try_divide(F.col(total), F.col("baseline")) >= ratio, F.lit(False)))


def week_change(series: DataFrame, key: str, week: str, value: str) -> DataFrame:
    """Percent change from the week before: null (new) from nothing to something, 0 from nothing to nothing."""
    before = F.lag(value).over(Window.partitionBy(key).orderBy(week))
    out = series.withColumn("before", before)
    pct = F.when((F.col("before") == 0) & (F.col(value) == 0), F.lit(0.0)).when(F.col("before") == 0, F.lit(None)).otherwise(100.0 * (F.col(value) - F.col("before")) / F.col("before"))
    return out.withColumn("pct", pct)


def movers(changes: DataFrame, key: str, change: str, n: int = 4) -> DataFrame:
    """The n strongest rises and falls with their places."""
    rows = changes.where(F.col(change).isNotNull())

    def best(by: Column, side: str) -> DataFrame:
        # n rows are left to be numbered
        place = F.row_number().over(Window.orderBy(by, key)).cast("int")
        return rows.orderBy(by, key).limit(n).select(key, change, F.lit(side).alias("side"), place.alias("place"))

    return best(F.desc(change), "rising").unionByName(best(F.asc(change), "falling"))


def mix_adjusted(days: DataFrame, day: str, kind: str, source: str, items: str, tags: str) -> DataFrame:
    """Per day: actual tags, those expected from each source's rate among days of its kind, and their ratio."""
    base = days.groupBy(kind, source).agg(F.sum(items).alias("_i"), F.sum(tags).alias("_t"))
    expected = days.join(base, [kind, source]).withColumn("_e", F.col(items) * F.try_divide(F.col("_t"), F.col("_i")))
    out = expected.groupBy(day, kind).agg(F.sum(items).alias("items"), F.sum(tags).alias("actual"), F.sum("_e").alias("expected"))
    return out.withColumn("ratio", F.try_divide(F.col("actual"), F.col("expected")))


def leave_one_out(days: DataFrame, group: Sequence[str], value: str, least: int = 3) -> DataFrame:
    """Mean and population deviation of the other rows of the group, null with fewer than `least` of them, and the row's z-score against them."""
    w = Window.partitionBy(*group)
    n, total, square = F.count(value).over(w) - 1, F.sum(value).over(w) - F.col(value), F.sum(F.col(value) * F.col(value)).over(w) - F.col(value) * F.col(value)
    out = days.withColumns({"others": n, "_t": total, "_q": square})
    mean = F.when(F.col("others") >= least, F.col("_t") / F.col("others"))
    out = out.withColumn("mean", mean).withColumn("sd", F.sqrt(F.greatest(F.col("_q") / F.nullif("others", F.lit(0)) - F.col("mean") * F.col("mean"), F.lit(0.0))))
    return out.withColumn("z", F.try_divide(F.col(value) - F.col("mean"), F.nullif("sd", F.lit(0.0)))).drop("_t", "_q")


def drift_alerts(days: DataFrame, series: str, day: str, z: str) -> DataFrame:
    """Below -2 on a day, or below -1.5 on three calendar days in a row."""
    w = Window.partitionBy(series).orderBy(day)
    run = (F.datediff(day, F.lag(day, 2).over(w)) == 2) & (F.max(z).over(w.rowsBetween(-2, 0)) < -1.5)
    return days.withColumn("alert", F.coalesce((F.col(z) < -2) | run, F.lit(False)))


def order_statistics(rows: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """n, total, mean, median (element n // 2), p95 (element int(0.95 n)), max: elements, never interpolated, found by place in each group, however large.

    Equal values are counted first, with partial sums, and only distinct ones are ordered, so a value that most rows have is one row.
    """
    counted = rows.groupBy(*group, value).agg(F.count("*").alias("_k"))
    placed = with_place(counted, [F.col(value).asc_nulls_first()], "_p", group, "_k")
    sums = rows.groupBy(*group).agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"), F.max(value).alias("max"))
    on = None
    for c in group:
        same = F.col(c).eqNullSafe(F.col(f"_of_{c}"))
        on = same if on is None else on & same
    holds = lambda place: (F.col("_p") >= place) & (F.col("_p") - F.col("_k") < place)
    half, late = F.floor(F.col("n") / 2) + 1, F.least(F.floor(0.95 * F.col("n")), F.col("n") - 1) + 1
    picked = placed.select(*[F.col(c).alias(f"_of_{c}") for c in group], F.col(value).alias("_v"), "_p", "_k").join(sums, on).where(holds(half) | holds(late))
    at = lambda place: F.max(F.when(holds(place), F.col("_v")))
    return picked.groupBy(*group, "n", "total", "mean", "max").agg(at(half).alias("median"), at(late).alias("p95")).select(*group, "n", "total", "mean", "median", "p95", "max")
