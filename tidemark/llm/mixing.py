"""Mixing sources to target weights by a time-varying curriculum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.sampling import carried
from tidemark.llm.store import shuffle_width

Schedule = Sequence[tuple[float, float]]
#: Weights of the sources in code point order, repeating; words of the mix as a share of all words; a source's most repeats.
WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2.0
#: Curricula in the same order, repeating: (time, weight) points, linear between them. Steady, coming in late, going out.
SCHEDULES: tuple[Schedule, ...] = (((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.6, 1.0), (1.0, 2.0)), ((0.0, 2.0), (0.4, 1.0), (1.0, 0.5)))
_WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, place (from 0, code point order, null last), target: shares of the mix by weight, none above `most` times its source's size.

    What a full source leaves is shared among the others by weight until none is above: with sources in the order
    of limit / weight, the level at which the rest would stand is found from running sums. One row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    s = sizes.select("source", "source_size", (F.row_number().over(order) - 1).alias("place")).withColumn("w", w).withColumn("cap", F.lit(most) * F.col("source_size"))
    fill = Window.orderBy(F.col("cap") / F.col("w"), "place")
    s = s.withColumns({
        "full_before": F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)),
        "w_left": F.sum("w").over(fill.rowsBetween(0, Window.unboundedFollowing)),
        "total": F.sum("source_size").over(Window.partitionBy()) * F.lit(share),
    })
    s = s.withColumn("level", (F.col("total") - F.coalesce("full_before", F.lit(0.0))) / F.col("w_left"))
    # the level rises with every source that is full below it and falls with the others
    s = s.withColumn("level", F.max("level").over(Window.partitionBy()))
    return s.select("source", "source_size", "place", F.least("cap", F.col("level") * F.col("w")).alias("target"))


def _demand_time(schedules: Sequence[Schedule], place: Column, asked: Column) -> Column:
    """The time at which a source's integrated weight reaches the share `asked` of its whole: the inverse of its cumulative demand."""
    out = F.lit(None).cast("double")
    for k, points in enumerate(schedules):
        areas = [0.0]
        for (x, a), (y, b) in zip(points, points[1:], strict=False):
            areas.append(areas[-1] + (y - x) * (a + b) / 2)
        want = asked * F.lit(areas[-1])
        own = F.lit(float(points[-1][0]))
        for (x, a), (y, b), before, after in reversed(list(zip(points, points[1:], areas, areas[1:], strict=False))):
            rest = want - F.lit(before)
            root = F.sqrt(F.greatest(F.lit(a * a) + F.lit(2 * (b - a) / (y - x)) * rest, F.lit(0.0)))
            own = F.when(want < F.lit(after), F.lit(x) + F.when(rest > 0, 2 * rest / (F.lit(a) + root)).otherwise(0.0)).otherwise(own)
        out = F.when(F.pmod(place, F.lit(len(schedules))) == k, own).otherwise(out)
    return out


def plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, schedules: Sequence[Schedule] = SCHEDULES, whole: bool = False, salt: str = "mix", text: str = "text", doc_id: str = "doc_id", source: str = "source", keep: Sequence[str] = ()) -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, taken, placements (array of turn, position, words) and the columns named in keep, as kept_<name>.

    Within its source a document has a place in the order of md5(salt + doc_id + md5(text)), the same in every run. Passes over
    the source in that order make a line of words; the mix takes the first `target` words of it, so a document is
    taken once for each pass that reaches it, and the last one in part (whole=True: in full if its middle
    is within the target, else not). Placement starts become training positions in [0, 1]: the time at which the
    source's schedule, integrated and scaled to its target, has asked for that many words.

    Where a document's words start is a running sum in two steps: 4096 buckets of the hash per source are summed, and
    only buckets are added up by source; the rows of a bucket are summed apart. A source with a third of all rows
    is thus 4096 tasks' worth of groups. Only source and bucket sums are ordered in one place.

    Null texts have size 0, and rows of size 0 are never taken (whole=True: once, at their place). Null sources are a source of their own, last.
    Repeated rows are documents each; the text's part in the order spreads rows without doc_id, or with one, over all buckets.
    Texts of any length count whole. An empty table gives no rows. Other columns are ignored but for those in keep.
    """
    order = F.md5(F.concat(F.lit(salt), F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit("")), F.coalesce(F.md5(text), F.lit(""))))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), words(F.col(text)).alias("size"), order.alias("_order"), *carried(docs, keep))
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null"))
    rows = rows.withColumn("_key", key)
    rows = rows.withColumn("_bucket", F.conv(F.substring("_order", 1, 3), 16, 10).cast("int"))
    buckets = rows.groupBy("_key", "_bucket").agg(F.sum("size").alias("n"), F.first("source").alias("source"))
    before = F.sum("n").over(Window.partitionBy("_key").orderBy("_bucket")) - F.col("n")
    sources = buckets.groupBy("_key").agg(F.sum("n").alias("source_size"), F.first("source").alias("source"))
    targets = source_targets(sources.select("source", "source_size"), weights, share, most)
    targets = targets.withColumn("_key", key).select("_key", "source_size", "place", "target")
    starts = buckets.select("_key", "_bucket", before.alias("_before")).join(targets, "_key")
    inside = Window.partitionBy("_key", "_bucket").orderBy("_order", "doc_id", "size")
    at = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    rows = rows.withColumn("_at", at).join(starts, ["_key", "_bucket"]).withColumn("_start", F.col("_before") + F.col("_at"))

    def placement(turn: int) -> Column:
        start = F.col("_start") + turn * F.col("source_size")
        if whole:
            n = F.when(start + F.col("size") / 2 <= F.col("target"), F.col("size")) if turn == 0 else F.when((start + F.col("size") / 2 <= F.col("target")) & (F.col("size") > 0), F.col("size"))
        else:
            n = F.least("size", F.floor("target") - start)
            n = F.when(n > 0, n)
        asked = F.least(F.try_divide(start.cast("double"), F.col("target")), F.lit(1.0))
        time = F.coalesce(_demand_time(schedules, F.col("place"), asked), F.lit(0.0))
        return F.when(n.isNotNull(), F.struct(F.lit(turn).alias("turn"), time.alias("position"), n.cast("long").alias("words")))

    turns = int(-(-most // 1))
    placed = F.filter(F.array(*[placement(t) for t in range(turns)]), lambda p: p.isNotNull())
    taken = F.aggregate("placements", F.lit(0).cast("long"), lambda a, p: a + p["words"])
    rows = rows.withColumn("placements", placed)
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "placements", *[f"kept_{c}" for c in keep])


def training_order(planned: DataFrame) -> DataFrame:
    """A row for each placement of plan()'s rows, range-sorted by training position (ties by doc_id and turn): turn, position and words instead of placements."""
    rest = [c for c in planned.columns if c != "placements"]
    placed = planned.select(*rest, F.explode("placements").alias("_p")).select(*rest, "_p.turn", "_p.position", "_p.words")
    return placed.repartitionByRange(shuffle_width(planned.sparkSession), "position", "doc_id", "turn").sortWithinPartitions("position", "doc_id", "turn")
