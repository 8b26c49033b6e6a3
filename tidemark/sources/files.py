"""Reading and writing: typed scans, JSON, partitioned and single files, append logs, retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calendar import kept_snapshot


def with_list(rows: DataFrame, column: str) -> DataFrame:
    """A column of JSON lists of strings as an array; null if it is none."""
    return rows.withColumn(column, F.from_json(column, "array<string>"))


def validated(rows: DataFrame, column: str, schema: T.StructType, required: Sequence[str]) -> DataFrame:
    """rows with the parsed record, and whether it is an object with all required fields."""
    parsed = rows.withColumn("record", F.from_json(column, schema))
    ok = F.col("record").isNotNull()
    for name in required:
        ok = ok & F.col(f"record.{name}").isNotNull()
    return parsed.withColumn("is_valid", ok)


def evolved(*versions: DataFrame) -> DataFrame:
    """Tables of additive versions of a schema together; columns that a version lacks are null."""
    out = versions[0]
    for v in versions[1:]:
        out = out.unionByName(v, allowMissingColumns=True)
    return out


def write_json(rows: DataFrame, folder: str, *partition: str) -> None:
    """JSON lines, partitioned; nulls are left out and no character is escaped."""
    rows.write.mode("overwrite").partitionBy(*partition).json(folder)


def write_by_language(rows: DataFrame, day: str, key: str, languages: dict[str, Column], folder: str) -> None:
    """One folder for each day and language: the language columns become rows."""
    parts = [rows.select(F.col(day), F.col(key), F.lit(lang).alias("lang"), text.alias("text")) for lang, text in languages.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    write_json(out.where("text is not null"), folder, day, "lang")


def page_copies(pages: DataFrame, document: str, number: str, text: str) -> DataFrame:
    """Each document's text with a line `--- page N ---` before every page, in order. A document is a file of some hundred pages at most."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(number).alias("n"), F.coalesce(F.col(text), F.lit("")).alias("t"))))
    block = lambda x: F.concat(F.lit("--- page "), x["n"].cast("string"), F.lit(" ---\n"), x["t"])
    return pages.groupBy(document).agg(F.array_join(F.transform(listed, block), "\n").alias("copy"))


def append_usage(rows: DataFrame, folder: str, numbers: Sequence[str]) -> None:
    """Appends log rows whose counts are integers; others are skipped."""
    ok = F.lit(True)
    for n in numbers:
        ok = ok & F.col(n).try_cast("long").isNotNull()
    rows.where(ok).withColumns({n: F.col(n).try_cast("long") for n in numbers}).write.mode("append").parquet(folder)


def retained(snapshots: DataFrame, day: str, today: Column) -> DataFrame:
    """Snapshots that the retention rule keeps."""
    newest = snapshots.agg(F.max(day).alias("_newest"))
    return snapshots.crossJoin(F.broadcast(newest)).where(kept_snapshot(F.col(day), today, F.col("_newest"))).drop("_newest")


def skip_list(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Ids of a skip-list file, and its unreadable lines: `#` begins a comment, blank lines don't count."""
    lines = spark.read.text(path).select(F.trim(F.split_part("value", F.lit("#"), F.lit(1))).alias("line")).where("line != ''")
    parsed = lines.withColumn("id", F.col("line").try_cast("long"))
    return parsed.where("id is not null").select("id"), parsed.where("id is null").select("line")


def country_names(spark: SparkSession, languages: Sequence[str] = ("en", "de")) -> dict[str, list[str]]:
    """The names of all countries by their two-letter codes, as the Java runtime knows them in some languages."""
    locale = spark.sparkContext._jvm.java.util.Locale
    out = {}
    for code in locale.getISOCountries():
        country = locale("", code)
        out[code] = list(dict.fromkeys(country.getDisplayCountry(locale(lang)) for lang in languages))
    return out
