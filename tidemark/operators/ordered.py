"""Places, neighbours and running folds over whole ordered tables, without ever ordering all rows in one task.

Rows are range-sorted and written once with the number of their range. What passes from a range to the next (its number of
rows, its last row, the state of a fold) is a small table with a row for each range, which alone is ordered in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import written


def ranged(rows: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """rows in ranges of `order`, with the number of each row's range as _range; written, so that every reader sees the same ranges."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(rows.repartitionByRange(width, *order).withColumn("_range", F.spark_partition_id()))


def with_place(rows: DataFrame, order: Sequence[Column | str], name: str = "place", group: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """rows with their place, from 1, in a total order; with `group`, whose columns come first in that order, the place within each group. A row with a weight stands for so many, and its place is that of the last."""
    parts = ranged(rows, [*group, *order])
    each = F.col(weight) if weight else F.lit(1)
    sizes = parts.groupBy("_range", *group).agg(F.sum(each).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", *[F.col(c).alias(f"_of_{c}") for c in group], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("_range", *group).orderBy(*order)
    inside = F.sum(weight).over(own.rowsBetween(Window.unboundedPreceding, 0)) if weight else F.row_number().over(own)
    on = F.col("_range") == F.col("_start_range")
    for c in group:
        on = on & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    placed = parts.withColumn("_inside", inside).join(F.broadcast(starts.withColumnRenamed("_range", "_start_range")) if not group else starts.withColumnRenamed("_range", "_start_range"), on)
    return placed.select(*rows.columns, (F.col("_before") + F.col("_inside")).alias(name))


def with_previous(rows: DataFrame, order: Sequence[str], column: str, name: str = "previous") -> DataFrame:
    """rows with the value that `column` has in the row before, null in the first."""
    parts = ranged(rows, order)
    lasts = parts.groupBy("_range").agg(F.max_by(F.struct(column), F.struct(*order)).alias("_last"))
    carried = lasts.select(F.col("_range").alias("_of"), F.lag("_last").over(Window.orderBy("_range"))[column].alias("_carried"))
    w = Window.partitionBy("_range").orderBy(*order)
    inside = parts.withColumns({"_lag": F.lag(column).over(w), "_at": F.row_number().over(w)})
    value = F.when(F.col("_at") == 1, F.col("_carried")).otherwise(F.col("_lag"))
    return inside.join(F.broadcast(carried), F.col("_range") == F.col("_of")).select(*rows.columns, value.alias(name))


def _breaks(sizes: np.ndarray, budget: float) -> np.ndarray:
    """For a window that begins at each row: the row that begins the next one, or the number of rows."""
    total = np.concatenate([[0.0], np.cumsum(sizes)])
    after = np.searchsorted(total, total[:-1] + budget, "right") - 1
    # rows of no size at a window's start never make the row after them begin another
    some = np.searchsorted(total, total[:-1], "right")
    return np.minimum(np.maximum(np.maximum(after, some), np.arange(1, len(sizes) + 1)), len(sizes))


def _entries(group: str, order: Sequence[str], size: str, budget: float):
    """Of each group's rows in a range: for every row that can be the first to begin a window, by what comes in, how many windows begin from there on and what the last one holds."""

    def run(frames):
        for frame in frames:
            sizes = frame[size].to_numpy(np.float64)
            n, nxt = len(sizes), _breaks(sizes, budget)
            total = np.concatenate([[0.0], np.cumsum(sizes)])
            begun, left = np.ones(n, np.int64), np.zeros(n)
            for k in range(n - 1, -1, -1):
                j = nxt[k]
                begun[k], left[k] = (1 + begun[j], left[j]) if j < n else (1, total[n] - total[k])
            # a window that holds more than the budget ends at the next row, whatever came in
            can = np.arange(min(n, np.searchsorted(total, budget, "right") + 1))
            yield pd.DataFrame({"row": np.arange(len(can) + 1), "before": np.append(total[can], total[n]), "size": np.append(sizes[can], np.inf), "begun": np.append(begun[can], 0), "left": np.append(left[can], total[n])})

    return run


def packed(rows: DataFrame, group: str, order: str, size: str, budget: float) -> DataFrame:
    """group, order, size, window: consecutive windows of a group's rows; a new one begins where the next row would go over the budget. Sizes are not negative.

    A window's fold goes from row to row, but where a range of rows begins its first new window depends only on how much
    the open window holds by then, and what comes after on nothing else. So each range gives a small table of its possible
    first rows (as many as a budget holds) with what each leads to; these are followed from range to range for every group;
    and each range then numbers its own windows.
    """
    parts = ranged(rows.select(group, order, F.coalesce(F.col(size).cast("double"), F.lit(0.0)).alias(size)), [group, order])
    keys = parts.select(F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit("null")).alias("_group"), group, order, size, "_range")

    def chunks(key, frame):
        frame = frame.sort_values(order, kind="stable")
        for out in _entries(group, [order], size, budget)([frame]):
            return out.assign(_group=key[0], _range=key[1])

    table = written(keys.groupBy("_group", "_range").applyInPandas(chunks, "row long, before double, size double, begun long, left double, _group string, _range int"))

    def follow(key, frame):
        held, number, out = 0.0, 0, []
        for at, ways in frame.sort_values(["_range", "row"]).groupby("_range", sort=True):
            out.append((key[0], at, held, number))
            whole = ways[np.isinf(ways["size"])].iloc[0]
            ways = ways[~np.isinf(ways["size"])]
            first = ways[(held + ways["before"] > 0) & (held + ways["before"] + ways["size"] > budget)]
            if len(first):
                held, number = first["left"].iloc[0], number + first["begun"].iloc[0]
            else:
                held += whole["left"]
        return pd.DataFrame(out, columns=["_group", "_range", "held", "number"])

    states = table.groupBy("_group").applyInPandas(follow, "_group string, _range int, held double, number long")

    def number(key, left, right):
        if not len(left):
            return pd.DataFrame({group: [], order: [], size: [], "window": []})
        left = left.sort_values(order, kind="stable")
        sizes = left[size].to_numpy(np.float64)
        held, window = right["held"].iloc[0], int(right["number"].iloc[0])
        total = np.concatenate([[0.0], np.cumsum(sizes)])
        starts = np.zeros(len(sizes), np.int64)
        first = np.flatnonzero((held + total[:-1] > 0) & (held + total[1:] > budget))
        k, nxt = (int(first[0]) if len(first) else len(sizes)), _breaks(sizes, budget)
        while k < len(sizes):
            starts[k] = 1
            k = int(nxt[k])
        return pd.DataFrame({group: left[group], order: left[order], size: sizes, "window": (window + np.cumsum(starts)).astype(np.int32)})

    types = dict(rows.dtypes)
    return keys.groupBy("_group", "_range").cogroup(states.groupBy("_group", "_range")).applyInPandas(number, f"{group} {types[group]}, {order} {types[order]}, {size} double, window int")
