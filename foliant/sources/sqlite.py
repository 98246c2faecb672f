"""Tables of a SQLite file, read on the executors by row ranges. The file must lie where all executors can read it."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TYPES = {"INT": T.LongType(), "INTEGER": T.LongType(), "BIGINT": T.LongType(), "REAL": T.DoubleType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType(), "NUMERIC": T.DoubleType()}


def _connect(path: str) -> sqlite3.Connection:
    """A connection that takes the file as unchanging, so a program that has it open does no harm."""
    return sqlite3.connect(f"file:{quote(path)}?mode=ro&immutable=1", uri=True)


def schema_of(path: str, table: str) -> T.StructType:
    with _connect(path) as db:
        columns = db.execute(f'PRAGMA table_info("{table}")').fetchall()
    if not columns:
        raise ValueError(f"no table {table} in {path}")
    return T.StructType([T.StructField(name, TYPES.get((kind or "").upper().split("(")[0], T.StringType())) for _, name, kind, *_ in columns])


def read_table(spark: SparkSession, path: str, table: str, partitions: int = 8) -> DataFrame:
    schema = schema_of(path, table)
    with _connect(path) as db:
        low, high = db.execute(f'SELECT coalesce(min(rowid), 0), coalesce(max(rowid), -1) FROM "{table}"').fetchone()
    step = max(1, -(-(high - low + 1) // partitions))
    ranges = spark.createDataFrame([(a, min(a + step, high + 1)) for a in range(low, high + 1, step)], "a long, b long").repartition(partitions)
    names = [f.name for f in schema]
    columns = ", ".join(f'"{n}"' for n in names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a, b in zip(pdf["a"], pdf["b"]):
                with _connect(path) as db:
                    cursor = db.execute(f'SELECT {columns} FROM "{table}" WHERE rowid >= ? AND rowid < ?', (int(a), int(b)))
                    while rows := cursor.fetchmany(5000):
                        yield pd.DataFrame(rows, columns=names, dtype=object)

    return ranges.mapInPandas(run, schema)


def rows_of(files: DataFrame, table: str, columns: str) -> DataFrame:
    """Rows of one table of many database files given as bytes (path, content), read in memory: path and ``columns``."""
    names = [c.split()[0] for c in columns.split(", ")]
    query = ", ".join(f'"{n}"' for n in names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                db = sqlite3.connect(":memory:")
                try:
                    db.deserialize(content)
                    cursor = db.execute(f'SELECT {query} FROM "{table}"')
                    while rows := cursor.fetchmany(5000):
                        out = pd.DataFrame(rows, columns=names, dtype=object)
                        out.insert(0, "path", path)
                        yield out
                finally:
                    db.close()

    return files.select("path", "content").mapInPandas(run, f"path string, {columns}")
