"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared scratch space and read it
    back: cuts the lineage, fixes row keys, and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = 500


def small_batches(batches, rows: int = BATCH_ROWS):
    """Slices of Arrow batches: what a task holds as Python objects stays small
    beside the batch itself."""
    import pyarrow as pa
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
        pa.default_memory_pool().release_unused()


def as_bytes(column) -> list:
    """UTF-8 bytes (or None) of an Arrow string column, without decoding."""
    import pyarrow as pa
    return column.cast(pa.binary()).to_pylist()


def documents_view(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text, under fixed names, so that further columns of the
    input cannot clash with an operator's own."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
