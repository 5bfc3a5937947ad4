"""What the operators share: reading tables, stored intermediate results, Arrow passes, word splitting."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from pledgeflow.session import working_folder

#: A-Z lower-cased, all other bytes as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: The same, and every byte below 0x80 that is no digit or letter becomes a space.
_ALNUM = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def encoded(text: str | None) -> bytes:
    """UTF-8 of a text; null counts as empty."""
    return (text or "").encode("utf-8", "surrogatepass")


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space."""
    return encoded(text).translate(LOWER).split()


def alnum_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of digits, letters and non-ASCII characters."""
    return encoded(text).translate(_ALNUM).split()


#: For rows of a megabyte or more. Parquet looks at the size of what it holds after a hundred rows first, and so many such rows
#: are held at once by the task that writes them and by each that reads them.
LARGE_ROWS = {
    "parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "16",
    "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "16",
}
#: Such rows go to Python a few at a time.
FEW_BYTES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def stored(df: DataFrame, name: str, partition_by: str | None = None, large_rows: bool = False) -> DataFrame:
    """``df`` written to the shared working folder and read back; with ``large_rows`` in row groups of 16 MB.

    Cuts the lineage: what follows reads files that survive lost executors.
    """
    spark = df.sparkSession
    folder = working_folder(spark, f"llm-{name}")
    writer = df.write.option("compression", "zstd").options(**(LARGE_ROWS if large_rows else {}))
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def parts(batches: Iterator[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of so many rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


_KEPT: dict[str, tuple[object, object]] = {}


def kept_in_worker(kind: str, key: object, make: Callable[[], Any]) -> Any:
    """An object that a Python worker keeps between its tasks. It keeps one at a time: workers outlive a
    job, and what earlier jobs kept would stay in memory beside it."""
    if _KEPT.get(kind, (None,))[0] != key:
        _KEPT.clear()
        _KEPT[kind] = key, make()
    return _KEPT[kind][1]


_TYPES = {
    "long": LongType(), "int": IntegerType(), "double": DoubleType(), "string": StringType(), "binary": BinaryType(),
    "boolean": BooleanType(),
}


def schema_of(**types: str | list[str]) -> StructType:
    """A schema from names of types; a list of one name is an array of it."""
    return StructType(
        [StructField(n, ArrayType(_TYPES[t[0]]) if isinstance(t, list) else _TYPES[t]) for n, t in types.items()]
    )


Rows = dict[str, list[Any] | pa.Array]


def arrow_pass(df: DataFrame, schema: StructType, start: Callable[[], Callable[[pa.RecordBatch], Rows]]) -> DataFrame:
    """``df`` through a Python function of Arrow batches.

    ``start`` is called once per task and returns the function; that gives one
    list or array per column of ``schema``, each of the same length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = start()
        target = to_arrow_schema(schema)
        for batch in batches:
            yield as_batch(convert(batch), target)

    return df.mapInArrow(run, schema)


def set_aside(df: DataFrame, names: set[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with its own columns of these names renamed, and a function that gives back its columns as they were."""
    own = {c: f"__own_{c}" if c.lower() in names else c for c in df.columns}

    def back(result: DataFrame) -> DataFrame:
        return result.select(*(F.col(f"`{now}`").alias(was) for was, now in own.items()))

    return df.withColumnsRenamed(own), back


def as_batch(rows: Rows, target: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for field in target:
        column = rows[field.name]
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if not isinstance(column, pa.Array):
            column = pa.array(column, field.type)
        arrays.append(column if column.type == field.type else column.cast(field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=target)


def with_columns(
    df: DataFrame,
    added: StructType,
    start: Callable[[], Callable[[pa.RecordBatch], Rows]],
) -> DataFrame:
    """``df`` with the columns of ``added``; a column of the same name is replaced."""
    kept = [f for f in df.schema.fields if f.name.lower() not in {a.name.lower() for a in added.fields}]
    names = [f.name for f in kept]
    schema = StructType(kept + added.fields)

    def begin() -> Callable[[pa.RecordBatch], Rows]:
        convert = start()

        def both(batch: pa.RecordBatch) -> Rows:
            return {n: batch.column(n) for n in names} | convert(batch)

        return both

    return arrow_pass(df, schema, begin)
