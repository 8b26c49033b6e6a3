"""Joins, sets and changes to tables as new DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.scratch import written


def pending(queue: DataFrame, done: DataFrame, keys: Sequence[str], *conditions: Column) -> DataFrame:
    """Rows of a queue without a row in done; further conditions are optional."""
    for c in conditions:
        queue = queue.where(c)
    return queue.join(done.select(*keys), list(keys), "left_anti")


def insert_ignore(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """existing and the new rows whose key it lacks; of new rows with one key the first in `order` stays."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*(order or keys)))
    first = new.withColumn("_n", place).where("_n = 1").drop("_n")
    return existing.unionByName(first.join(existing.select(*keys), list(keys), "left_anti"), allowMissingColumns=True)


def merged_counts(existing: DataFrame, increments: DataFrame, keys: Sequence[str], count: str = "count") -> DataFrame:
    """Counters after an upsert that adds."""
    return existing.unionByName(increments).groupBy(*keys).agg(F.sum(count).alias(count))


def delete_cascading(rows: DataFrame, parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows but those that hang on the parents to delete."""
    return rows.join(parents.select(*keys).distinct(), list(keys), "left_anti")


def replaced_unit(existing: DataFrame, unit: DataFrame, keys: Sequence[str]) -> DataFrame:
    """existing with all rows of the unit's keys replaced by the unit's."""
    return delete_cascading(existing, unit, keys).unionByName(unit)


def rebuilt(previous: DataFrame, current: DataFrame, keys: Sequence[str], now: Column) -> DataFrame:
    """current with the creation time of an earlier version kept, and a time of update only where there was one."""
    old = previous.select(*keys, F.col("created_at").alias("_created"))
    joined = current.join(old, list(keys), "left")
    return joined.withColumn("updated_at", F.when(F.col("_created").isNotNull(), now)).withColumn("created_at", F.coalesce("_created", now)).drop("_created")


def added_rows(now: DataFrame, before: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows on keys that an earlier copy has none of."""
    return now.join(before.select(*keys).distinct(), list(keys), "left_anti")


def unlinked(items: DataFrame, *links: DataFrame, key: str) -> DataFrame:
    """Items without any row in all of several bridges."""
    for link in links:
        items = items.join(link.select(key), key, "left_anti")
    return items


def with_flag(items: DataFrame, link: DataFrame, key: str, name: str) -> DataFrame:
    """Whether each item has a row in link."""
    found = link.select(key).distinct().withColumn(name, F.lit(True))
    return items.join(found, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def with_counts(parents: DataFrame, children: DataFrame, key: str, name: str) -> DataFrame:
    """How many children each parent has, 0 included."""
    counted = children.groupBy(key).agg(F.count("*").alias(name))
    return parents.join(counted, key, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))


def _steps(column: Column, kind: T.DataType) -> tuple[Column, int]:
    """A date or whole number as a number from 0 on, and the bits that it has at most."""
    if isinstance(kind, T.DateType):
        return F.datediff(column, F.lit("0001-01-01")).cast("long"), 22
    return column.cast("long") + (1 << 31), 33


def in_intervals(rows: DataFrame, day: str, intervals: DataFrame, start: str, end: str, how: str = "left") -> DataFrame:
    """Rows with the columns of the first interval (by start, end and its other columns) that holds their day, null if none does (how="inner": without such rows). Days are dates or whole numbers.

    Every interval falls into at most two ranges of 2^k days for each k, which begin at multiples of their length, and every day lies in one such range for each k: so the
    range join is an equal join of ranges. Of all intervals that have a range only the first is kept, by a partial aggregate, and only distinct days look ranges up, so nothing grows with the
    number of intervals that overlap.
    """
    low, bits = _steps(F.col("_i")[start], intervals.schema[start].dataType)
    high, _ = _steps(F.col("_i")[end], intervals.schema[end].dataType)
    ranges = f"""array_compact(flatten(transform(sequence(0, {bits}), k -> array(
        if(shiftright(_low + shiftleft(1L, k) - 1, k) < shiftright(_high + 1, k) and shiftright(_low + shiftleft(1L, k) - 1, k) % 2 = 1, struct(k as k, shiftright(_low + shiftleft(1L, k) - 1, k) as at), null),
        if(shiftright(_low + shiftleft(1L, k) - 1, k) < shiftright(_high + 1, k) and shiftright(_high + 1, k) % 2 = 1, struct(k as k, shiftright(_high + 1, k) - 1 as at), null)))))"""
    whole = intervals.select(F.struct(start, end, *[c for c in intervals.columns if c not in (start, end)]).alias("_i")).withColumns({"_low": low, "_high": high})
    firsts = whole.select("_i", F.explode(F.expr(ranges)).alias("_range")).groupBy("_range").agg(F.min("_i").alias("_i"))
    number, _ = _steps(F.col(day), rows.schema[day].dataType)
    days = rows.select(F.col(day).alias("_day"), number.alias("_n")).where("_n is not null").distinct()
    days = days.select("_day", F.explode(F.expr(f"transform(sequence(0, {bits}), k -> struct(k as k, shiftright(_n, k) as at))")).alias("_range"))
    hits = days.join(firsts, "_range").groupBy("_day").agg(F.min("_i").alias("_hit"))
    out = rows.join(hits, F.col(day) == F.col("_day"), how)
    return out.select(*rows.columns, *[F.col("_hit")[c].alias(c) for c in intervals.columns])


def with_default(rows: DataFrame, dictionary: DataFrame, key: str, value: str, default: Column) -> DataFrame:
    """Lookup in a dictionary with a default. Spark broadcasts the dictionary if it is small as measured."""
    return rows.join(dictionary, key, "left").withColumn(value, F.coalesce(value, default))


def first_of_group(rows: DataFrame, group: Sequence[str], order: Sequence[str], *columns: str) -> DataFrame:
    """Each group's first row in an order, with its columns as first_<name>; a partial aggregate, not a sort of whole groups."""
    first = F.min(F.struct(*order, *[c for c in columns if c not in order]))
    names = list(dict.fromkeys([*order, *columns]))
    return rows.groupBy(*group).agg(first.alias("_f")).select(*group, *[F.col(f"_f.{c}").alias(f"first_{c}") for c in names])


def duplicates_of_first(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows with the key of their group's first row, and whether they are it. Null keys are a group like any other."""
    first = first_of_group(rows, group, order)
    first = first.select(*[F.col(c).alias(f"_of_{c}") for c in group], *[f"first_{c}" for c in order])
    on = None
    for c in group:
        same = F.col(c).eqNullSafe(F.col(f"_of_{c}"))
        on = same if on is None else on & same
    out = rows.join(first, on).drop(*[f"_of_{c}" for c in group])
    return out.withColumn("is_first", F.expr(" and ".join(f"{c} <=> first_{c}" for c in order)))


def filled_grid(rows: DataFrame, keys: DataFrame, steps: DataFrame, on: Sequence[str], *counts: str) -> DataFrame:
    """Each key with each step and 0 where it has no row. keys and steps are dimension tables; steps is the smaller one."""
    grid = keys.crossJoin(F.broadcast(steps))
    out = grid.join(rows, list(on), "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in counts})


def greedy_matches(pairs: DataFrame, group: str, left: str, right: str, score: str, least: float = 0.6) -> DataFrame:
    """One-to-one matches within each group, best score first (ties by left, then right), from least on.

    In rounds: a pair that is the best of its left and of its right member is what the greedy rule takes, whatever happens elsewhere, so all of these are taken at
    once, and what they touch is dropped. Each round is two aggregates and joins by (group, member), so a group may have any number of pairs. Random scores take about log(pairs)
    rounds; a chain of pairs, each better than the next, takes as many as it has links. Null members are members like any other.
    """
    of_left, of_right = F.struct(group, left), F.struct(group, right)
    best = F.min(F.struct((-F.col(score)).alias("s"), F.col(left).alias("l"), F.col(right).alias("r")))
    live = written(pairs.select(group, left, right, score).where(F.col(score) >= least))
    taken = []
    while not live.isEmpty():
        of_pair = F.struct("_side", "_best.l", "_best.r", "_best.s")
        a = live.groupBy(of_left.alias("_key")).agg(best.alias("_best")).withColumn("_side", F.col("_key")[group])
        b = live.groupBy(of_right.alias("_key")).agg(best.alias("_best")).withColumn("_side", F.col("_key")[group])
        both = written(a.select(of_pair.alias("_pair")).join(b.select(of_pair.alias("_pair")), "_pair"))
        found = both.select(F.col("_pair._side").alias(group), F.col("_pair.l").alias(left), F.col("_pair.r").alias(right), (-F.col("_pair.s")).alias(score))
        taken.append(found)
        for member in (of_left, of_right):
            live = live.withColumn("_key", member).join(found.select(member.alias("_key")), "_key", "left_anti").drop("_key")
        live = written(live)
    out = live
    for found in taken:
        out = out.unionByName(found)
    return out


def missing_days(first: Column, last: Column, calendar: DataFrame, present: DataFrame, day: str = "day") -> DataFrame:
    """Days from first to last (columns of the one-row calendar) that a table lacks."""
    days = calendar.select(F.explode(F.sequence(first, last)).alias(day))
    return days.join(present.select(day), day, "left_anti")


def merged_groups(a: DataFrame, b: DataFrame, keys: Sequence[str], zeros: Sequence[str]) -> DataFrame:
    """Full outer join of two group results, null keys equal, 0 where a side lacks a group."""
    on = None
    for k in keys:
        same = a[k].eqNullSafe(b[k])
        on = same if on is None else on & same
    joined = a.join(b, on, "full")
    key = [F.coalesce(a[k], b[k]).alias(k) for k in keys]
    rest = [F.coalesce(F.col(c), F.lit(0)).alias(c) if c in zeros else F.col(c) for c in [*a.columns, *b.columns] if c not in keys]
    return joined.select(*key, *rest)
