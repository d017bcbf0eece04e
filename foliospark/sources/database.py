"""Tables of a SQLite file as DataFrames: opened read-only, fetched in batches by ranges of row ids."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

#: Rows that a cursor hands out at once.
BATCH = 4000
AFFINITY = (("INT", LongType()), ("CHAR", StringType()), ("CLOB", StringType()), ("TEXT", StringType()), ("BLOB", BinaryType()), ("REAL", DoubleType()), ("FLOA", DoubleType()), ("DOUB", DoubleType()))


def connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{quote(path)}?mode=ro", uri=True)


def schema_of(path: str, table: str) -> StructType:
    """Columns by the type affinity of their declarations; anything else is text."""
    with connect(path) as db:
        rows = db.execute("SELECT name, upper(type) FROM pragma_table_info(?)", (table,)).fetchall()
    if not rows:
        raise LookupError(f"no table {table!r} in {path}")
    return StructType([StructField(n, next((t for key, t in AFFINITY if key in kind), StringType())) for n, kind in rows])


def read_sqlite(spark: SparkSession, path: str, table: str, partitions: int = 8) -> DataFrame:
    """A table with row ids, split into equal ranges of them; ``path`` must be readable on every executor."""
    schema = schema_of(path, table)
    arrow, name = to_arrow_schema(schema), table.replace('"', '""')
    with connect(path) as db:
        low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{name}"').fetchone()
    if low is None:
        return spark.createDataFrame([], schema)
    step = -(-(high - low + 1) // partitions)
    ranges = spark.createDataFrame([(a, min(a + step, high + 1)) for a in range(low, high + 1, step)], "a long, b long").repartitionByRange(partitions, "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        db = connect(path)
        for batch in batches:
            for a, b in zip(*(c.to_pylist() for c in batch.columns)):
                cursor = db.execute(f'SELECT * FROM "{name}" WHERE rowid >= ? AND rowid < ? ORDER BY rowid', (a, b))
                while rows := cursor.fetchmany(BATCH):
                    columns = [pa.array([cast(v, f.type) for v in c], f.type) for c, f in zip(zip(*rows), arrow)]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        db.close()

    return ranges.mapInArrow(run, schema)


def cast(value, kind: pa.DataType):
    """A stored value in its column's type; SQLite lets any cell hold any type."""
    if value is None:
        return None
    try:
        if pa.types.is_string(kind):
            return value.decode("utf-8", "replace") if isinstance(value, bytes) else str(value)
        if pa.types.is_binary(kind):
            return value if isinstance(value, bytes) else str(value).encode()
        return int(value) if pa.types.is_integer(kind) else float(value)
    except ValueError:
        return None
