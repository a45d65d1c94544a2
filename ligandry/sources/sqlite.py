"""SQLite tables as a Python data source, split by rowid, with comparisons pushed into the file."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

MAGIC = b"SQLite format 3\x00"
_KINDS = {"INT": "bigint", "CHAR": "string", "TEXT": "string", "CLOB": "string", "BLOB": "binary", "REAL": "double", "FLOA": "double", "DOUB": "double", "NUM": "double", "DEC": "double"}
_SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def verify(path: str) -> None:
    """Raise ValueError unless path is a readable SQLite file with a table: header, connection, catalogue."""
    if not Path(path).is_file() or Path(path).open("rb").read(16) != MAGIC:
        raise ValueError(f"not an SQLite file: {path}")
    try:
        with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as c:
            n = c.execute("SELECT count(*) FROM sqlite_master WHERE type = 'table'").fetchone()[0]
    except sqlite3.DatabaseError as e:
        raise ValueError(f"damaged SQLite file: {path}") from e
    if not n:
        raise ValueError(f"no tables in {path}")


def _quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class _Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class _Reader(DataSourceReader):
    def __init__(self, path: str, table: str, schema: StructType, parts: int):
        self.path, self.table, self.schema, self.parts, self.where = path, table, schema, parts, []

    def pushFilters(self, filters):
        for f in filters:
            if type(f) in _SIGNS and len(f.attribute) == 1:
                self.where.append((f"{_quote(f.attribute[0])} {_SIGNS[type(f)]} ?", f.value))
            elif isinstance(f, IsNotNull) and len(f.attribute) == 1:
                self.where.append((f"{_quote(f.attribute[0])} IS NOT NULL", None))
            else:
                yield f

    def partitions(self):
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as c:
            low, high = c.execute(f"SELECT min(rowid), max(rowid) FROM {_quote(self.table)}").fetchone()
        if low is None:
            return [_Range(0, 0)]
        step = max(1, -(-(high - low + 1) // self.parts))
        return [_Range(a, a + step) for a in range(low, high + 1, step)]

    def read(self, partition) -> Iterator[tuple]:
        columns = ", ".join(_quote(f.name) for f in self.schema.fields)
        rules = ["rowid >= ?", "rowid < ?", *(w for w, _ in self.where)]
        values = [partition.low, partition.high, *(v for w, v in self.where if w.endswith("?"))]
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as c:
            yield from c.execute(f"SELECT {columns} FROM {_quote(self.table)} WHERE {' AND '.join(rules)}", values)


class SQLiteSource(DataSource):
    """Options: path, table, partitions (8)."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as c:
            found = c.execute(f"PRAGMA table_info({_quote(self.options['table'])})").fetchall()
        if not found:
            raise ValueError(f"no table {self.options['table']!r}")
        return ", ".join(f"`{name}` {next((v for k, v in _KINDS.items() if k in kind.upper()), 'string')}" for _, name, kind, *_ in found)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.options["table"], schema, int(self.options.get("partitions", "8")))


def read_table(spark: SparkSession, path: str, table: str, partitions: int = 8) -> DataFrame:
    """A table of an SQLite file. Executors must see the file; on a cluster copy it to Parquet first."""
    verify(path)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SQLiteSource)
    return spark.read.format("sqlite").options(path=path, table=table, partitions=str(partitions)).load()
