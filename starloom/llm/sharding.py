"""Balanced contiguous shards by global prefix sums of byte sizes.

Rows are put in order of id by ranges; every range has a total size and count. Prefix
sums over those totals plus a running sum inside each range give each row's place on
the line of all bytes, and that line is cut at equal targets. Only the range
totals, as many rows as there are partitions, meet in one task.

Law ``bytes``: shards differ by at most the size of one document on each side. A null
text has no bytes and the checksum of the empty text. Ties in id are ordered by
checksum, then by place in the input, and so may straddle a cut; a row larger
than a target leaves its neighbours' shards empty; an empty table has no rows.
Only DataFrame functions are used; columns beside id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import documents_view, stage

SHARDS = 8
ORDER = ("doc_id", "text_crc32", "tie")


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot``."""
    slim = stage(documents_view(docs, id_col, text_col).select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("tie")), "sizes")
    ranged = stage(slim.repartitionByRange(*ORDER)
                   .withColumn("part", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding,
                                               Window.unboundedFollowing)
    starts = totals.select(
        "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("part_start"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("part_rank"),
        F.sum("bytes").over(every).alias("total"))
    inside = Window.partitionBy("part").orderBy(*ORDER).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # one row per partition: a bound that does not grow with the rows
    placed = (ranged.withColumns({"upto": F.sum("size").over(inside),
                                  "nth": F.count("*").over(inside)})
              .join(F.broadcast(starts), "part"))
    # twice the middle of the row on the line of bytes, in units of total / shards
    placed = stage(placed.select(
        "doc_id", "size", "text_crc32", (F.col("part_rank") + F.col("nth") - 1).alias("rank"),
        F.expr(f"cast((2 * (part_start + upto) - size) * {shards} div (2 * total) as int)")
        .alias("shard")), "placed")
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return (placed.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("rank") - F.col("first")).alias("slot")))
