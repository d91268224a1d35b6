"""How the corpus operators read DataFrames and keep intermediate results."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import forget, shared_folder, ship
from ..session import materialized as written
from .textcore import Block, blocks

#: Rows in an Arrow batch; with long texts the default of 10,000 would not be bounded enough.
BATCH_ROWS = 250


def small_batches(spark: SparkSession) -> None:
    """Prepare a session for the operators' Python code."""
    ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def arrow_schema(schema: str | StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def per_block(df: DataFrame, schema: str, work: Callable[[Block, pa.RecordBatch], dict], text: str = "text") -> DataFrame:
    """Run `work` over all texts, a block at a time. It gets the block and the rows it stands for, and returns columns of `schema`."""
    small_batches(df.sparkSession)
    out = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(batch.schema.get_field_index(text))):
                columns = work(block, batch.slice(block.first, block.n))
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def documents(df: DataFrame, *more: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns that an operator needs, and no others, so that no other name can clash."""
    return df.select(F.col(id), F.col(text).cast("string").alias(text), *more)


__all__ = ["arrow_schema", "documents", "forget", "per_block", "shared_folder", "small_batches", "table", "written"]
