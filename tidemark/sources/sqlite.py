"""A data source over folders of SQLite files: read in ranges of rows with tests inside the files, written so that a commit shows all of its files or none.

    sqlite.register(spark)
    rows.write.format("sqlite_folder").mode("append").option("path", folder).save()
    sqlite.stored(spark, folder, [("day", ">=", date(2024, 1, 5)), ("kind", "in", ["view", "click"])])

Tests are given with the read, as bound parameters of SQLite's queries. Spark's own pushdown into such sources isn't used: a loaded DataFrame remembers the filters of its first use for later ones.
"""

from __future__ import annotations

import datetime as dt
import json
import sqlite3
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

FORMAT, TABLE, SUFFIX = "sqlite_folder", "rows", ".sqlite"
#: Rows of a file, of a range that one task reads, and of a batch.
ROWS, RANGE, BATCH = 200_000, 100_000, 10_000
_KINDS = {"bigint": "INTEGER", "int": "INTEGER", "smallint": "INTEGER", "boolean": "INTEGER", "double": "REAL", "float": "REAL", "string": "TEXT", "binary": "BLOB", "date": "INTEGER", "timestamp": "INTEGER"}
_EPOCH, _START = dt.date(1970, 1, 1), dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
_OPERATORS = ("=", "!=", ">", ">=", "<", "<=", "in", "is null", "is not null", "begins")


def register(spark: SparkSession) -> None:
    """Makes the format known to the session."""
    spark.dataSource.register(SqliteFolder)


def stored(spark: SparkSession, folder: str, tests: Sequence[tuple] = ()) -> DataFrame:
    """The rows of a folder that pass all tests (column, operator, value), which SQLite makes: = != > >= < <= in, is null, is not null (without value), begins. Nulls pass only `is null`."""
    register(spark)
    unknown = [t[1] for t in tests if t[1] not in _OPERATORS]
    if unknown:
        raise ValueError(f"no such operators: {unknown}")
    plain = [[t[0], t[1], [_stored(v) for v in t[2]] if t[1] == "in" else _stored(t[2]) if len(t) > 2 else None] for t in tests]
    return spark.read.format(FORMAT).option("path", folder).option("tests", json.dumps(plain)).load()


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


def _stored(value):
    """A value as SQLite holds it: days and microseconds since 1970."""
    if isinstance(value, dt.datetime):
        value = value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)
        return (value - _START) // dt.timedelta(microseconds=1)
    return (value - _EPOCH).days if isinstance(value, dt.date) else int(value) if isinstance(value, bool) else value


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


@dataclass
class Rows(InputPartition):
    file: str
    first: int
    last: int


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class SqliteFolder(DataSource):
    """Options: path. Every folder below it whose name doesn't begin with _ is a commit, of files that each hold a table `rows`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _files(self) -> list[str]:
        system, base = _opened(self.options["path"])
        found = system.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
        return sorted(f.path for f in found if f.path.endswith(SUFFIX) and not any(part.startswith("_") for part in f.path.removeprefix(base).split("/")))

    def schema(self) -> T.StructType:
        files = self._files()
        if not files:
            raise ValueError(f"no file in {self.options['path']}: give a schema")
        with _database(self.options["path"], files[0]) as held:
            return T.StructType([T.StructField(c[1], _spark_type(c[2])) for c in held.execute(f"pragma table_info({TABLE})")])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return Reader(self.options["path"], schema, self._files(), json.loads(self.options.get("tests", "[]")))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("commits are added: use mode append and a new path instead of overwrite")
        return Writer(self.options["path"], schema)


def _spark_type(declared: str) -> T.DataType:
    names = {"bigint": T.LongType, "int": T.IntegerType, "smallint": T.ShortType, "boolean": T.BooleanType, "double": T.DoubleType, "float": T.FloatType, "string": T.StringType, "binary": T.BinaryType, "date": T.DateType, "timestamp": T.TimestampType}
    return names[declared.lower()]()


class _database:
    """A file's database in memory: files are of bounded size, and can lie wherever pyarrow reads."""

    def __init__(self, folder: str, file: str):
        self.system, self.file = _opened(folder)[0], file

    def __enter__(self) -> sqlite3.Connection:
        with self.system.open_input_file(self.file) as f:
            content = f.read()
        self.held = sqlite3.connect(":memory:")
        self.held.deserialize(content)
        return self.held

    def __exit__(self, *_) -> None:
        self.held.close()


class Reader(DataSourceReader):
    def __init__(self, folder: str, schema: T.StructType, files: Sequence[str], tests: Sequence[Sequence] = ()):
        self.folder, self.columns, self.files = folder, schema, files
        self.tests: list[str] = []
        self.values: list = []
        for name, operator, value in tests:
            schema[name]
            column = _quoted(name)
            if operator == "in":
                self.tests.append(f"{column} in ({', '.join('?' * len(value))})")
                self.values += value
            elif operator.startswith("is"):
                self.tests.append(f"{column} {operator}")
            elif operator == "begins":
                self.tests.append(f"substr({column}, 1, ?) = ?")
                self.values += [len(value), value]
            else:
                self.tests.append(f"{column} {operator} ?")
                self.values.append(value)

    def partitions(self) -> Sequence[InputPartition]:
        # a file has ROWS rows at most, so its ranges are known without opening it
        return [Rows(f, first, first + RANGE) for f in self.files for first in range(0, ROWS, RANGE)]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        names, schema = ", ".join(_quoted(c) for c in self.columns.names), to_arrow_schema(self.columns)
        where = " and ".join(["rowid > ? and rowid <= ?", *self.tests])
        with _database(self.folder, partition.file) as held:
            cursor = held.execute(f"select {names} from {TABLE} where {where} order by rowid", [partition.first, partition.last, *self.values])
            while rows := cursor.fetchmany(BATCH):
                columns = [pa.array(values, pa.int32() if pa.types.is_date(f.type) else pa.int64() if pa.types.is_timestamp(f.type) or pa.types.is_boolean(f.type) else f.type) for values, f in zip(zip(*rows, strict=True), schema, strict=True)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class Writer(DataSourceArrowWriter):
    """Tasks write to a folder whose name begins with _, which is renamed as a whole when all are done."""

    def __init__(self, folder: str, schema: T.StructType):
        self.folder, self.columns, self.number = folder, schema, uuid.uuid4().hex
        unknown = [f.name for f in schema if f.dataType.simpleString() not in _KINDS]
        if unknown:
            raise ValueError(f"no SQLite form of the columns {unknown}")

    def _staged(self) -> tuple[fs.FileSystem, str, str]:
        system, base = _opened(self.folder)
        return system, f"{base}/_{self.number}", f"{base}/commit-{self.number}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, staged, _ = self._staged()
        system.create_dir(staged, recursive=True)
        files, held, count = [], None, 0

        def done() -> None:
            held.commit()
            name = f"{staged}/{uuid.uuid4().hex}{SUFFIX}"
            with system.open_output_stream(name) as out:
                out.write(held.serialize())
            held.close()
            files.append(name.rsplit("/", 1)[1])

        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                if held is None:
                    held, count = sqlite3.connect(":memory:"), 0
                    held.execute(f"create table {TABLE} ({', '.join(f'{_quoted(f.name)} {f.dataType.simpleString()}' for f in self.columns)})")
                rows = zip(*([_stored(v) for v in c.to_pylist()] for c in part.columns), strict=True)
                held.executemany(f"insert into {TABLE} values ({', '.join('?' * len(self.columns))})", rows)
                count += part.num_rows
                if count + BATCH > ROWS:
                    done()
                    held = None
        if held is not None:
            done()
        return Written(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, staged, shown = self._staged()
        system.create_dir(staged, recursive=True)
        # files of attempts that were given up are no part of the commit
        kept = {f for m in messages if m for f in m.files}
        for f in system.get_file_info(fs.FileSelector(staged)):
            if f.base_name not in kept:
                system.delete_file(f.path)
        system.move(staged, shown)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, staged, _ = self._staged()
        if system.get_file_info(staged).type != fs.FileType.NotFound:
            system.delete_dir(staged)
