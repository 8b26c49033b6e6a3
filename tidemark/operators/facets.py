"""A facet index: for each value of each facet the ids of its rows as bitmaps, from which filters and counts are answered without the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ids of a bitmap, as Spark's functions cut them.
SPAN = 32768


def facet_index(rows: DataFrame, id: str, facets: Mapping[str, Column]) -> DataFrame:
    """facet, value (as text), bucket, bits: a bitmap for each 32,768 ids that a value has any of. Facets are columns, or arrays of several values; nulls are no values.

    A frequent value is many rows of four kilobytes, each built by partial aggregates, never one list.
    """

    def pairs(name: str, column: Column) -> Column:
        several = dict(rows.select(column.alias("v")).dtypes)["v"].startswith("array")
        return F.transform(column if several else F.array(column), lambda v: F.struct(F.lit(name).alias("facet"), v.cast("string").alias("value")))

    each = rows.select(F.col(id).alias("_id"), F.inline(F.flatten(F.array(*[pairs(name, c) for name, c in facets.items()])))).where("value is not null and _id is not null")
    return each.groupBy("facet", "value", F.bitmap_bucket_number("_id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bits"))


def matching(index: DataFrame, wanted: Mapping[str, Sequence[str] | tuple[str, str]]) -> DataFrame:
    """bucket, bits of the rows that have one of the wanted values in each facet: values of a facet are or-ed, facets and-ed. A tuple is a range from its first to its last value, as texts (dates in ISO form)."""
    some = {name: F.col("value").between(*values) if isinstance(values, tuple) else F.col("value").isin(*values) for name, values in wanted.items()}
    hit = F.lit(False)
    for name, test in some.items():
        hit = hit | ((F.col("facet") == name) & test)
    of_facet = index.where(hit).groupBy("bucket", "facet").agg(F.bitmap_or_agg("bits").alias("bits"))
    return of_facet.groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("_n")).where(F.col("_n") == len(some)).select("bucket", "bits")


def number_of(matches: DataFrame) -> DataFrame:
    """How many rows match: n, without their ids."""
    return matches.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))


def value_counts(index: DataFrame, matches: DataFrame) -> DataFrame:
    """facet, value, n: how many of the matching rows each value has; values with none are left out."""
    both = index.join(matches.select("bucket", F.col("bits").alias("_hits")), "bucket").select("facet", "value", "bucket", F.explode(F.array("bits", "_hits")).alias("bits"))
    joint = both.groupBy("facet", "value", "bucket").agg(F.bitmap_and_agg("bits").alias("bits"))
    return joint.groupBy("facet", "value").agg(F.sum(F.bitmap_count("bits")).alias("n")).where("n > 0")


def ids_of(matches: DataFrame, id: str = "id") -> DataFrame:
    """The ids of matching rows."""
    # bytes that aren't zero, then their bits
    bytes_ = matches.select("bucket", F.explode(F.expr(f"filter(transform(sequence(0, {SPAN // 8 - 1}), i -> struct(i as i, conv(hex(substring(bits, i + 1, 1)), 16, 10) as b)), x -> x.b != '0')")).alias("x"))
    bits = bytes_.select("bucket", F.explode(F.expr("filter(transform(sequence(0, 7), k -> if(shiftright(cast(x.b as int), k) % 2 = 1, 8 * x.i + k, null)), p -> p is not null)")).alias("p"))
    # buckets from 1 on count up from id 1, others down from id 0
    number = F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * SPAN + F.col("p") + 1).otherwise(F.col("bucket") * SPAN - F.col("p"))
    return bits.select(number.cast("long").alias(id))
