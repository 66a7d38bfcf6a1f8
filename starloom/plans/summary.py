"""Arrivals per month, port and gender, kept up by every refresh of a star.

The OLAP question asks for counts per port of the persons with one attribute. A
refresh writes the counts of its own batch; their sums over the live batches are
the counts over all facts, so the question reads no facts. A person's row may change
when a later batch brings a smaller record of the same key (see ``PERSON_ORDER``): then
that person's older arrivals are taken from the old gender and given to the new one,
in rows with negative and positive counts of the same batch. Only facts of the months of
such persons are read for that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUMMARY = "sum_port_gender"
# A person number is unique within its month; an admission number everywhere.
PERSON_KEY = ("year", "month", "cicid")
GROUP = ("year", "month", "port", "gender")


def port_gender_counts(fact: DataFrame, persons: DataFrame) -> DataFrame:
    """``year, month, port, gender, n`` of fact rows and their persons."""
    return (fact.select(*PERSON_KEY, "port").join(persons.select(*PERSON_KEY, "gender"),
                                                  list(PERSON_KEY))
            .groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n")))


def merged_counts(counts: DataFrame) -> DataFrame:
    """Sums over batches; groups that corrections have emptied are left out."""
    return counts.groupBy(*GROUP).agg(F.sum("n").alias("n")).where("n <> 0")


def moved_counts(old_fact: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Corrections for persons whose row a batch has changed: ``before`` and ``after`` are
    their rows without and with the batch, ``old_fact`` the facts of earlier batches."""
    changed = (before.select(*PERSON_KEY, F.col("gender").alias("old"))
               .join(after.select(*PERSON_KEY, F.col("gender").alias("new")), list(PERSON_KEY))
               .where(~F.col("old").eqNullSafe(F.col("new"))))
    rows = old_fact.select(*PERSON_KEY, "port").join(changed, list(PERSON_KEY))
    both = F.explode(F.array(F.struct(F.col("old").alias("gender"), F.lit(-1).alias("n")),
                             F.struct(F.col("new").alias("gender"), F.lit(1).alias("n"))))
    return (rows.select("year", "month", "port", both.alias("x")).select("year", "month", "port", "x.*")
            .groupBy(*GROUP).agg(F.sum("n").alias("n")))
