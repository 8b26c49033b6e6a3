"""The SQLite source and drifting records."""

import datetime as dt
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import digests, records, sqlite

TYPES = "id long, small int, flag boolean, value double, name string, raw binary, day date, at timestamp"


def some_rows(n):
    random.seed(n)
    at = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=random.randint(-(10**15), 10**15))
    maybe = lambda v: None if random.random() < 0.2 else v
    return [(i, maybe(random.randint(-5, 5)), maybe(random.random() < 0.5), maybe(random.random()), maybe(random.choice(["a%", "b'\"c", "é漢🙂", "", "abc"])), maybe(b"\x00\xff"), maybe(dt.date(1900, 1, 1) + dt.timedelta(random.randint(0, 60000))), maybe(at())) for i in range(n)]


def test_sqlite_folder_round_trip_and_filters(spark, tmp_path, monkeypatch):
    sqlite.register(spark)
    folder, rows = str(tmp_path / "store"), some_rows(500)
    df = spark.createDataFrame(rows, TYPES).repartition(3)
    for half in ("id < 250", "id >= 250"):
        df.where(half).write.format(sqlite.FORMAT).mode("append").option("path", folder).save()
    assert len(list((tmp_path / "store").glob("commit-*"))) == 2 and not list((tmp_path / "store").glob("_*"))
    stored = spark.read.format(sqlite.FORMAT).option("path", folder).load()
    assert stored.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(tuple, stored.collect()), key=lambda r: r[0]) == sorted(map(tuple, df.collect()), key=lambda r: r[0])
    day, at = dt.date, dt.datetime
    tests = [
        ([("small", ">", 2)], "small > 2"), ([("small", "in", [1, 2]), ("flag", "=", True)], "small in (1, 2) and flag"), ([("name", "=", "abc")], "name = 'abc'"), ([("name", "begins", "a")], "name like 'a%'"),
        ([("day", ">=", day(1950, 1, 1)), ("day", "<", day(1990, 1, 1))], "day >= date'1950-01-01' and day < date'1990-01-01'"), ([("at", ">", at(2024, 1, 1))], "at > timestamp'2024-01-01 00:00:00'"),
        ([("name", "is null")], "name is null"), ([("value", ">", 0.5), ("name", "is not null")], "value > 0.5 and name is not null"), ([("small", "!=", 1)], "small != 1"), ([("name", "=", "b'\"c")], "id is not null and name = 'b\\'\"c'"),
    ]
    for test, said in tests:
        assert sorted(r.id for r in sqlite.stored(spark, folder, test).collect()) == sorted(r.id for r in df.where(said).collect()), said
        # conditions on what is loaded are Spark's, however often it is used
        assert sorted(r.id for r in stored.where(said).collect()) == sorted(r.id for r in df.where(said).collect()), said
    with pytest.raises(ValueError, match="operators"):
        sqlite.stored(spark, folder, [("id", "; drop", 1)])


def test_sqlite_files_have_bounded_rows(spark, tmp_path, monkeypatch):
    writer = sqlite.Writer(str(tmp_path), spark.createDataFrame([], "id long").schema)
    monkeypatch.setattr(sqlite, "ROWS", 100)
    monkeypatch.setattr(sqlite, "BATCH", 40)
    import pyarrow as pa

    message = writer.write(iter([pa.RecordBatch.from_arrays([pa.array(range(k * 70, k * 70 + 70))], ["id"]) for k in range(4)]))
    writer.commit([message, None])
    reader = sqlite.SqliteFolder({"path": str(tmp_path)}).reader(spark.createDataFrame([], "id long").schema)
    monkeypatch.setattr(sqlite, "RANGE", 30)
    got = [i for p in reader.partitions() for b in reader.read(p) for i in b.column("id").to_pylist()]
    assert sorted(got) == list(range(280)) and len(message.files) > 2


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    sqlite.register(spark)
    folder = str(tmp_path / "store")
    df = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        df.write.format(sqlite.FORMAT).mode("append").option("path", folder).save()
    assert not list(tmp_path.rglob("*.sqlite"))
    with pytest.raises(Exception, match="no SQLite form"):
        spark.sql("select array(1) as a").write.format(sqlite.FORMAT).mode("append").option("path", folder).save()


def test_drifting_records(spark):
    """Three versions with a changed type in one table, and what fits none of them."""
    said = [
        (1, '{"k": 3, "who": "a"}'), (2, '{"k": "4", "who": "b", "new": true}'), (3, '{"k": 5.0, "who": {"first": "c"}}'), (4, '{"k": "many", "who": "d"}'), (5, '{"who": "e"}'), (6, '{"k": null, "who": "f"}'),
        (7, '{"k": 1'), (8, None), (9, "[1]"), (10, '"text"'), (11, '{"k": 9, "it\'s": 1}'), (12, ""),
    ]
    rows = records.as_variants(spark.createDataFrame(said, "i int, text string"), "text")
    found = {r.i: (r.k, r.reason) for r in records.typed(rows, "text", {"k": "int"}, ["k"]).collect()}
    wanted = {1: (3, None), 2: (4, None), 3: (5, None), 4: (None, "not a int: k"), 5: (None, "missing: k"), 6: (None, "missing: k"), 7: (None, "not JSON"), 8: (None, "not JSON"), 9: (None, "not an object"), 10: (None, "not an object"), 11: (9, None), 12: (None, "not JSON")}
    assert found == wanted
    good, bad = records.parted(records.typed(rows, "text", {"k": "int"}, ["k"]))
    assert good.count() == 4 and bad.count() == 8 and "reason" not in good.columns
    assert [r.v for r in records.typed(rows, "text", {"it's": "int"}).where("i = 11").select(F.col("`it's`").alias("v")).collect()] == [1]
    schema = records.merged_schema(rows.where("i in (1, 2)")).first().schema
    assert schema.startswith("OBJECT<") and "k: VARIANT" in schema and "who: STRING" in schema and "new: BOOLEAN" in schema
    assert json.loads(spark.createDataFrame([(1,)], "a int").select(F.to_json(F.struct("a")).alias("j")).first().j) == {"a": 1}


def test_hashes_of_files_read_in_pieces(spark, tmp_path):
    random.seed(5)
    lines = b"".join(random.randbytes(random.randint(0, 300)).replace(b"\n", b"\r\n") + b"\n" for _ in range(9000))
    some = {
        "lines": lines, "open end": lines + b"x", "marked": b"\xef\xbb\xbf" + lines, "marked, open [1]": b"\xef\xbb\xbf" + lines + b"\r", "feeds": b"\n" * 700_000, "one line": random.randbytes(900_000).replace(b"\n", b""),
        "packed.gz": b"\x1f\x8b no" + lines, "zeros": bytes(600_000), "at a piece": lines[: 1 << 19], "one more": lines[: (1 << 19) + 1], "small": b"\xff\r\n",
    }
    (tmp_path / "in it").mkdir()
    for k, (name, data) in enumerate(some.items()):
        (tmp_path / ("in it" if k % 2 else ".") / name).write_bytes(data)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(300_000))
    try:
        found = digests.file_hashes(spark, str(tmp_path), 1 << 19).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert {r.path.rsplit("/", 1)[1]: r.sha256 for r in found} == {name: hashlib.sha256(data).hexdigest() for name, data in some.items()}
    assert len(found) == len(some)
