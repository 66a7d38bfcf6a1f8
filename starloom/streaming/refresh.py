"""Monthly refresh of a star, or of one fact table, with Structured Streaming.

New monthly arrival files land in a source folder; an ``availableNow`` stream picks
up the files that its checkpoint does not know, and every micro-batch goes through the
same steps:

1. *Which files are new.* The files of the batch (resolved path and length, from the
   scan itself) are compared with the ledger of all files that live batches were loaded
   from. Only rows of new files go on, so a month is loaded once, whatever way its
   folder was spelled, whichever stream or build brought it, and however often a
   batch is run again. A file that has changed its length since it was loaded is an error.
2. *Whose rows they are.* The batch gets a number and a range of file numbers that
   nobody else gets (:func:`starloom.sources.commits.claim`); ids are file number and
   place in the file.
3. *Write, then commit.* Rows go to ``batch=<number>`` folders of every table; one
   commit makes all of them live. A run that fails before leaves rows that are never
   read, and its files are still new for the next run.

State (ledger, claims, commits, checkpoints) lies under the fact table in ``_refresh``, which
readers of the table skip, and goes with it when the star is rebuilt. Refreshes and
compactions may run at the same time; of two that load the same file at the same
time the second to commit fails and loads nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..plans.star import (COMMITTED_TABLES, LEDGER, clean_arrivals, clean_columns, coded_persons,
                          fact_immigration, flight_rows, is_clean, ledger_path, load_lookups,
                          merged)
from ..plans.summary import PERSON_KEY, SUMMARY, moved_counts, port_gender_counts
from ..session import scratch_path
from ..sources import commits
from ..sources.files import (PLACE, files_of, numbered_files, with_place, with_row_ids,
                             write_parquet)

LEDGER_SCHEMA = "path string, length long, modified timestamp, file_no long, batch int"


class NewRows(NamedTuple):
    """Rows of files that no live batch was loaded from, with their id."""
    batch: int
    rows: DataFrame
    seen: list[int]     # ledger batches that were compared
    whole: bool         # no file of the scan was known


def _checkpoint(target: str, source: str) -> str:
    name = hashlib.sha256(source.encode()).hexdigest()[:16]
    return f"{commits.state_dir(target)}/checkpoint-{name}"


def loaded_files(spark: SparkSession, target: str, batches: list[int]) -> DataFrame:
    """Files that the given batches of a table were loaded from."""
    if not batches:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    ledger = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path(target))
    return ledger.where(F.col("batch").isin(batches))


def new_rows(df: DataFrame, target: str, found_in: DataFrame | None = None,
             row_id: str = "_id") -> NewRows | None:
    """The rows of ``df`` (a scan :func:`with_place`) that are to be loaded, under a batch number
    of their own, with their files entered in the ledger; None if all files are known. The files
    are those that the rows of ``found_in`` lie in, by default those of ``df``."""
    spark = df.sparkSession
    seen = (commits.latest(spark, target) or {"live": {}})["live"].get(LEDGER, [])
    files = spark.read.parquet(write_parquet(files_of(df if found_in is None else found_in),
                                             scratch_path(spark, "batch-files")))
    known = loaded_files(spark, target, seen)
    changed = (files.join(known.select("path", F.col("length").alias("before")), "path")
               .where("length <> before").take(5))
    if changed:
        raise ValueError("these files have changed since they were loaded: "
                         + ", ".join(r.path for r in changed))
    new = spark.read.parquet(write_parquet(files.join(known, "path", "left_anti"),
                                           scratch_path(spark, "new-files")))
    n = new.count()
    if not n:
        return None
    batch, first = commits.claim(spark, target, n)
    path = write_parquet(numbered_files(new, first), ledger_path(target, batch))
    return NewRows(batch, with_row_ids(df, spark.read.parquet(path), row_id), seen,
                   n == files.count())


def commit_batch(spark: SparkSession, target: str, new: NewRows, tables: Sequence[str]) -> None:
    """Make the batch's rows in ``tables`` and its files live, unless one of the files has
    been loaded by somebody else meanwhile."""
    add = commits.added(new.batch, [*tables, LEDGER])

    def change(state: dict) -> dict:
        later = sorted(set(state["live"].get(LEDGER, [])) - set(new.seen))
        if later:
            twice = loaded_files(spark, target, [new.batch]).join(
                loaded_files(spark, target, later).select("path"), "path", "left_semi").take(5)
            if twice:
                raise RuntimeError("another refresh has loaded these files meanwhile: "
                                   + ", ".join(r.path for r in twice))
        return add(state)
    commits.commit(spark, target, change)


def _append(out: DataFrame, path: str, partition_by: Sequence[str], batch: int) -> None:
    (out.withColumn("batch", F.lit(batch)).write.mode("append")
     .partitionBy(*partition_by, "batch").parquet(path))


def _stream(spark: SparkSession, source: str, schema: T.StructType, max_files: int | None,
            checkpoint: str, write_batch: Callable[[DataFrame], None]) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (with_place(reader.parquet(source)).writeStream
            .foreachBatch(lambda df, _: write_batch(df))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def start_refresh(spark: SparkSession, source: str, target: str,
                  transform: Callable[[DataFrame, int], DataFrame],
                  schema: T.StructType, partition_by: Sequence[str] = ("year", "month"),
                  checkpoint: str | None = None, max_files_per_trigger: int | None = None
                  ) -> StreamingQuery:
    """Start an ``availableNow`` stream from ``source`` files into ``target``.

    ``transform(batch_df, batch)`` turns raw rows (and ``_id``, see module doc) into output
    rows that contain the ``partition_by`` columns. Without ``checkpoint`` it lies in the
    target's state folder. Read the table with :func:`read_refreshed`.
    """
    def write_batch(df: DataFrame) -> None:
        new = new_rows(df, target)
        if new is not None:
            _append(transform(new.rows, new.batch), target, partition_by, new.batch)
            commit_batch(spark, target, new, [_name(target)])
    return _stream(spark, source, schema, max_files_per_trigger,
                   checkpoint or _checkpoint(target, source), write_batch)


def _name(target: str) -> str:
    return target.rstrip("/").rsplit("/", 1)[-1]


def _staged(df: DataFrame) -> DataFrame:
    """The cleaned rows of a scan (``_clean``) and the first row of every file, with their place,
    written once to the scratch folder. Any use of a micro-batch reads all its columns again,
    so its files and its rows are taken in one pass."""
    spark = df.sparkSession
    rows = df.withColumn("_clean", is_clean()).where("_clean OR _row = 0").select(
        "_clean", *PLACE, *[F.when(F.col("_clean"), c).alias(k) for k, c in clean_columns().items()])
    return spark.read.parquet(write_parquet(rows, scratch_path(spark, "refresh-stage")))


def refresh_fact_immigration(spark: SparkSession, arrivals_source: str, fact_dir: str,
                             checkpoint: str | None = None,
                             max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Append new monthly arrival files to the fact table alone (see module doc)."""
    return start_refresh(spark, arrivals_source, fact_dir,
                         lambda rows, _: fact_immigration(clean_arrivals(rows, "_id")),
                         schemas.ARRIVALS_RAW, checkpoint=checkpoint,
                         max_files_per_trigger=max_files_per_trigger)


def _months(persons: DataFrame) -> Column | None:
    """Condition on the first and last month of ``persons``; None without a person that has a
    month. It holds literals, so a scan skips the folders and row groups of other months."""
    place = F.col("year").cast("long") * 12 + F.col("month")
    found = persons.agg(F.min("year"), F.max("year"), F.min(place), F.max(place)).first()
    if any(v is None for v in found):  # `in` a Row asks for a column
        return None
    return F.col("year").between(*found[:2]) & place.between(*found[2:])


def _corrections(spark: SparkSession, root: str, persons: DataFrame
                 ) -> tuple[DataFrame, DataFrame | None]:
    """(persons of the batch as they are with it, count corrections of older facts). Stored rows
    are read in the batch's months only; None if none of its persons is known."""
    state = commits.latest(spark, f"{root}/fact_immigration")
    keys = list(PERSON_KEY)
    stored = commits.live_rows(spark.read.parquet(f"{root}/dim_personal"), state, "dim_personal")
    months = _months(persons)
    if months is None:
        return persons, None
    # months first: they prune files, the keys do the rest
    before = merged(stored.where(months).join(persons.select(*keys), keys, "left_semi"),
                    "dim_personal")
    before = spark.read.parquet(write_parquet(before, scratch_path(spark, "persons-before")))
    months = _months(before)
    if months is None:
        return persons, None
    after = merged(before.unionByName(persons), "dim_personal")
    fact = commits.live_rows(spark.read.parquet(f"{root}/fact_immigration"), state,
                             "fact_immigration")
    return after, moved_counts(fact.where(months), before, after)


def write_arrivals(spark: SparkSession, df: DataFrame, star_dir: str, countries: DataFrame
                   ) -> NewRows | None:
    """Write the new rows of a scan :func:`with_place` of whole files to the tables of a star;
    nothing of it is live before :func:`commit_batch`."""
    root = star_dir.rstrip("/")
    staged = _staged(df)
    new = new_rows(staged.where("_clean").drop("_clean"), f"{root}/fact_immigration",
                   staged.where("_row = 0"), "id")
    if new is None:
        return None
    # without known files only the fact, which has the ids, needs to be joined to the files
    clean = staged.where("_clean") if new.whole else new.rows
    persons = spark.read.parquet(write_parquet(coded_persons(clean, countries),
                                               scratch_path(spark, "refresh-persons")))
    after, moved = _corrections(spark, root, persons)
    counts = port_gender_counts(clean, after)
    if moved is not None:
        counts = counts.unionByName(moved)
    writes = [(fact_immigration(new.rows), f"{root}/fact_immigration", ["year", "month"]),
              (persons, f"{root}/dim_personal", []), (flight_rows(clean), f"{root}/dim_flight", []),
              (counts, f"{root}/{SUMMARY}", [])]
    # independent jobs over the same staged batch: submit them together
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        for f in [pool.submit(_append, *w, new.batch) for w in writes]:
            f.result()
    return new


def refresh_star(spark: SparkSession, arrivals_source: str, star_dir: str,
                 dictionary_path: str | dict[str, DataFrame], checkpoint: str | None = None,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Add new monthly arrival files to a star built with
    ``build_star(..., refreshable=True)``: fact, person and flight tables and the counts
    of :mod:`starloom.plans.summary` (see module doc). Readers resolve one row per key across
    batches, see :func:`starloom.plans.star.read_star`. ``dictionary_path`` may be
    what :func:`starloom.plans.star.load_lookups` gave for the dictionary.
    """
    countries = load_lookups(spark, dictionary_path)["countries"]
    fact_dir = f"{star_dir.rstrip('/')}/fact_immigration"

    def write_batch(df: DataFrame) -> None:
        new = write_arrivals(spark, df, star_dir, countries)
        if new is not None:
            commit_batch(spark, fact_dir, new, COMMITTED_TABLES)
    return _stream(spark, arrivals_source, schemas.ARRIVALS_RAW, max_files_per_trigger,
                   checkpoint or _checkpoint(fact_dir, arrivals_source), write_batch)


def read_refreshed(spark: SparkSession, target: str) -> DataFrame:
    """The live rows of a refreshed table without the bookkeeping ``batch`` column."""
    state = commits.latest(spark, target)
    return commits.live_rows(spark.read.parquet(target), state, _name(target)).drop("batch")
