"""The star schema: staging, fact and dimension tables, and the full build.

Inputs are the monthly arrivals (Parquet), the code dictionary (text),
city demographics (``;`` CSV) and airports (CSV). Original behaviour is kept where
it defines results on valid data; keys are stricter where it does not (README).
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import char_cast, code_label, region_state, sas_day_to_timestamp
from ..operators import (conform, first_by_key, quoted, require_columns,
                         role_lookup, rows_at_group_max, where_equal)
from ..operators.order import clustered_for_write
from ..session import scratch_path
from ..sources import commits
from ..sources import labels as lb
from ..sources.files import (files_of, numbered_files, read_csv_by_name, read_parquet,
                             with_place, with_row_ids, write_bucketed_table, write_parquet)
from .summary import PERSON_KEY, SUMMARY, merged_counts, port_gender_counts

# Arrivals by air have mode 1; these columns must be present.
AIR_MODE = 1
REQUIRED_ARRIVAL_COLUMNS = ("depdate", "i94addr", "fltno", "airline", "visatype",
                            "gender", "i94cit", "i94res")


def is_clean() -> Column:
    """Condition of :func:`clean_arrivals` on a raw row; never NULL."""
    present = [quoted(c).isNotNull() for c in REQUIRED_ARRIVAL_COLUMNS]
    return reduce(lambda a, b: a & b, present, F.col("i94mode").eqNullSafe(F.lit(AIR_MODE)))


def clean_columns() -> dict[str, Column]:
    """Columns of a cleaned arrival, beside ``id``, by name."""
    n = lambda c, t: F.col(c).try_cast(t)  # noqa: E731  lenient narrowing
    return {
        "cicid": n("cicid", "bigint"),
        "year": n("i94yr", "int"),
        "month": n("i94mon", "int"),
        "citizen_country": n("i94cit", "int"),
        "residence_country": n("i94res", "int"),
        "port": F.trim(char_cast("i94port")),  # codes are trimmed like the dictionary's
        "arrival_date": sas_day_to_timestamp("arrdate"),
        "departure_date": sas_day_to_timestamp("depdate"),
        "state_code": F.trim(char_cast("i94addr")),
        "age": n("i94bir", "int"),
        "birth_year": n("biryear", "int"),
        "visa": code_label("i94visa"),
        "gender": char_cast("gender"),
        "adm_num": n("admnum", "bigint"),
        "flight_no": F.col("fltno"),
        "airline": F.col("airline"),
        "visatype": F.col("visatype"),
    }


def clean_arrivals(raw: DataFrame, row_id: str | None = None) -> DataFrame:
    """Air arrivals with all required columns, narrowed and decoded.

    ``id`` is assigned here, once, so that every table written from this staging
    shares it. It is the column ``row_id`` (file number and place in the file, see
    :func:`starloom.sources.files.with_row_ids`: the same in every run over the same
    files) or, for rows that come from no file, unique but neither dense nor stable.
    It is never used as a join key.
    """
    df = require_columns(where_equal(raw, "i94mode", AIR_MODE), REQUIRED_ARRIVAL_COLUMNS)
    return df.select(
        (F.col(row_id) if row_id else F.monotonically_increasing_id()).alias("id"),
        *[c.alias(name) for name, c in clean_columns().items()])


def fact_immigration(clean: DataFrame) -> DataFrame:
    """Fact table: one row per cleaned arrival."""
    return clean.select("id", "cicid", "year", "month", "port", "state_code", "visa",
                        "arrival_date", "departure_date", "adm_num")


PERSON_ORDER = ("age", "birth_year", "gender", "citizen_country", "residence_country")


def person_rows(clean: DataFrame) -> DataFrame:
    """One row per person and month, with country codes. Among differing records
    of one key the smallest in ``PERSON_ORDER`` stays, so the result does not
    depend on how the arrivals were split into loads."""
    return first_by_key(clean.select(*PERSON_KEY, *PERSON_ORDER), PERSON_KEY, PERSON_ORDER)


def name_countries(persons: DataFrame, countries: DataFrame) -> DataFrame:
    """Adds ``citizen_country_name`` and ``residence_country_name``; both codes
    resolve through one lookup."""
    return role_lookup(persons, countries, "country_code", "country_name",
                       {"citizen_country": "citizen_country_name",
                        "residence_country": "residence_country_name"})


def dim_personal(clean: DataFrame, countries: DataFrame, one_row_per_key: bool = False
                 ) -> DataFrame:
    """Person dimension.

    Default: DISTINCT over the attributes (as declared by the original model).
    With ``one_row_per_key``: one row per ``PERSON_KEY``, reduced on codes
    before the country names are joined.
    """
    names = [F.col("citizen_country_name").alias("citizen_country"),
             F.col("residence_country_name").alias("residence_country"),
             "age", "birth_year", "gender"]
    if one_row_per_key:
        return name_countries(person_rows(clean), countries).select(
            "cicid", "year", "month", *names)
    return name_countries(clean, countries).select("cicid", *names).distinct()


def _flight_order() -> list:
    # latest month first, a missing month last, then the smallest flight
    return [-F.coalesce(F.col(c), F.lit(-1)) for c in ("year", "month")] + [
        F.col("flight_no"), F.col("airline"), F.col("visatype")]


def flight_rows(clean: DataFrame) -> DataFrame:
    """One row per admission number, with its month: the latest month's, then
    the smallest flight."""
    return first_by_key(clean.select("adm_num", "year", "month", "flight_no", "airline",
                                     "visatype"), "adm_num", _flight_order())


def dim_flight(clean: DataFrame, one_row_per_key: bool = False) -> DataFrame:
    """Flight dimension; DISTINCT rows, or one row per ``adm_num`` if keyed."""
    cols = ["adm_num", "flight_no", "airline", "visatype"]
    return flight_rows(clean).select(*cols) if one_row_per_key else clean.select(*cols).distinct()


def us_airports(raw: DataFrame, country: str = "US") -> DataFrame:
    """Airports of one country with the state part of the ISO region."""
    return where_equal(raw, "iso_country", country).select(
        F.col("ident").alias("airport_id"), "type", "name", "elevation_ft",
        region_state("iso_region").alias("region"), "municipality", "coordinates")


def majority_rows(demog: DataFrame, keys: Sequence[str] = ("City", "State"),
                  measure: str = "Count", tie_break: str | None = None) -> DataFrame:
    """One row per city (more if tied) holding its largest group, renamed.

    ``keys=("City",)`` reproduces grouping by city name only, which merges
    same-named cities of different states. With ``tie_break`` (e.g.
    ``"Race"``) exactly one row per city is kept: the largest ``measure``,
    ties resolved by the smallest ``tie_break`` value.
    """
    if tie_break:
        # same rows as the tie-keeping form (no NULL key or measure), then
        # ascending (-measure, tie_break): largest measure, smallest tie value
        present = reduce(lambda a, b: a & b,
                         [quoted(c).isNotNull() for c in (*keys, measure)])
        top = first_by_key(demog.where(present), list(keys),
                           [-quoted(measure), quoted(tie_break)])
    else:
        top = rows_at_group_max(demog, list(keys), measure)
    return top.select(
        F.upper("City").alias("city"), F.upper("State").alias("state"),
        quoted("Median Age").alias("median_age"),
        quoted("Male Population").alias("male_population"),
        quoted("Female Population").alias("female_population"),
        quoted("Total Population").alias("total_population"),
        quoted("Number of Veterans").alias("veteran_population"),
        quoted("Foreign-born").alias("foreign_population"),
        quoted("Average Household Size").alias("avg_household_size"),
        quoted("State Code").alias("state_code"),
        F.col("Race").alias("race"))


def _with_port_codes(cities: DataFrame, ports: DataFrame) -> DataFrame:
    lk = ports.select(F.col("port_code").alias("city_code"), F.col("city").alias("port_city"),
                      F.col("state_code").alias("port_state"))
    return conform(cities, lk, {"city": "port_city", "state_code": "port_state"})


def dim_city_population(cities: DataFrame, ports: DataFrame) -> DataFrame:
    """Population figures per city with its port code(s)."""
    return _with_port_codes(cities, ports).select(
        "city", "state", "city_code", "state_code", "male_population", "female_population",
        "total_population", "veteran_population", "foreign_population", "race")


def dim_city_stats(cities: DataFrame, ports: DataFrame) -> DataFrame:
    """Median age and household size per city with its port code(s)."""
    return _with_port_codes(cities, ports).select(
        "city", "state", "city_code", "state_code", "median_age", "avg_household_size")


def load_lookups(spark: SparkSession, dictionary_path: str | dict[str, DataFrame]
                 ) -> dict[str, DataFrame]:
    """Countries, ports and states from the code dictionary (parsed once). Lookups that are
    loaded already are given back as they are, so that a build and the refreshes after it
    can share them.

    The parsed entries are small (one row per code) and reused three times,
    so they are checkpointed to the shared scratch folder instead of being
    re-parsed for each lookup.
    """
    if isinstance(dictionary_path, dict):
        return dictionary_path
    entries = lb.code_labels(spark, dictionary_path)
    entries = spark.read.parquet(write_parquet(entries, scratch_path(spark, "code_labels")))
    st = lb.states(entries)
    return {"entries": entries, "countries": lb.countries(entries), "states": st,
            "ports": lb.ports(entries, st)}


def stage_arrivals(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(cleaned arrivals, files with their numbers), both written to the scratch folder. The
    same files give the same ids, however Spark splits the scan."""
    placed = with_place(read_parquet(spark, path, schemas.ARRIVALS_RAW))
    files = spark.read.parquet(write_parquet(numbered_files(files_of(placed)),
                                             scratch_path(spark, "arrival_files")))
    clean = clean_arrivals(with_row_ids(placed, files), "_id")
    return spark.read.parquet(write_parquet(clean, scratch_path(spark, "arrivals_clean"))), files


def build_star(spark: SparkSession, arrivals_path: str,
               dictionary_path: str | dict[str, DataFrame],
               demographics_path: str, airports_path: str, out_dir: str,
               person_buckets: int | None = None, database: str | None = None,
               refreshable: bool = False, csv_multiline: bool = False) -> dict[str, str]:
    """Build and write the six star tables; returns ``{table: path}``. ``dictionary_path``
    may be what :func:`load_lookups` gave for the dictionary.

    The cleaned arrivals and the cities are written once to the scratch folder
    and the tables read those copies, instead of re-reading and
    re-cleaning the raw files for each of them (this also cuts lineage, so
    a lost executor re-runs only the last stage). Every table is replaced whole.
    The columns of the two CSV inputs are found by name; records that do not fit them are
    written to :func:`rejected_path` with file and reason (``csv_multiline``: quoted fields may
    hold line breaks).

    With ``person_buckets`` the fact and the person dimension are also
    registered as catalog tables of those names (in ``database`` if given),
    bucketed and sorted by the person key with the same bucket count: their join
    (the largest of the OLAP question) then runs without a shuffle on
    either side.

    With ``refreshable`` the fact, person and flight tables get a ``batch``
    partition level (``-1`` for this build) so that
    :func:`starloom.streaming.refresh_star` can add later months to the same
    folders; read them with :func:`read_star`. Counts of arrivals per month, port and
    gender are kept beside them (:mod:`starloom.plans.summary`).
    """
    if refreshable and person_buckets:
        raise ValueError("a refresh writes plain files: choose refreshable or person_buckets")
    staged, files = stage_arrivals(spark, arrivals_path)
    lk = load_lookups(spark, dictionary_path)
    demog, bad_demog = read_csv_by_name(spark, demographics_path, schemas.DEMOGRAPHICS_RAW, ";",
                                        csv_multiline)
    airports, bad_airports = read_csv_by_name(spark, airports_path, schemas.AIRPORTS_RAW, ",",
                                              csv_multiline)
    rejected = bad_demog.unionByName(bad_airports)
    cities = spark.read.parquet(write_parquet(majority_rows(demog, tie_break="Race"),
                                              scratch_path(spark, "cities")))
    persons = dim_personal(staged, lk["countries"], one_row_per_key=True)
    tables = {
        "fact_immigration": fact_immigration(staged),
        "dim_personal": persons if person_buckets else clustered_for_write(persons, ["cicid"]),
        "dim_flight": dim_flight(staged, one_row_per_key=True),
        "dim_airports": us_airports(airports),
        "dim_city_population": dim_city_population(cities, lk["ports"]),
        "dim_city_stats": dim_city_stats(cities, lk["ports"]),
    }
    if refreshable:
        tables["dim_personal"] = coded_persons(staged, lk["countries"])
        tables["dim_flight"] = flight_rows(staged)

    def write(name: str, df: DataFrame) -> str:
        path = f"{out_dir.rstrip('/')}/{name}"
        part = ["year", "month"] if name == "fact_immigration" else None
        if refreshable and name in COMMITTED_TABLES:
            df = df.withColumn("batch", F.lit(-1))
            part = (part or []) + ["batch"]
        if person_buckets and name in ("fact_immigration", "dim_personal"):
            qualified = f"{database}.{name}" if database else name
            write_bucketed_table(df, qualified, path, person_buckets, ["cicid"], part)
        else:
            write_parquet(df, path, partition_by=part)
        return path

    # The six writes are independent jobs: submit them together so small
    # dimension jobs run alongside the fact write instead of after it.
    with ThreadPoolExecutor(max_workers=len(tables) + 1) as pool:
        futures = {name: pool.submit(write, name, df) for name, df in tables.items()}
        pool.submit(write_parquet, rejected, rejected_path(out_dir)).result()
        if refreshable:  # the persons are read back, not reduced to one row per key again
            persons = spark.read.parquet(futures["dim_personal"].result())
            write(SUMMARY, port_gender_counts(tables["fact_immigration"], persons))
        out = {name: f.result() for name, f in futures.items()}
    if refreshable:  # after the fact, whose overwrite also removes older state
        fact = out["fact_immigration"]
        write_parquet(files, ledger_path(fact, -1))
        last = files.agg(F.coalesce(F.max("file_no"), F.lit(-1))).first()[0]

        def first_commit(state: dict) -> dict:
            return commits.added(-1, [*COMMITTED_TABLES, LEDGER])({**state, "next_file": last + 1})
        commits.commit(spark, fact, first_commit)
    return out


def rejected_path(out_dir: str) -> str:
    """CSV records that a build could not read (``file, block, row, record, reason``)."""
    return f"{out_dir.rstrip('/')}/_rejected"


# Tables that a refresh extends, and the list of the arrival files they were loaded from.
REFRESHED_TABLES = ("fact_immigration", "dim_personal", "dim_flight")
COMMITTED_TABLES = (*REFRESHED_TABLES, SUMMARY)
LEDGER = "files"


def ledger_path(fact_dir: str, batch: int | None = None) -> str:
    """Folder of the list of loaded files (``path, length, modified, file_no``)."""
    root = f"{commits.state_dir(fact_dir)}/{LEDGER}"
    return root if batch is None else f"{root}/batch={batch}"


def coded_persons(clean: DataFrame, countries: DataFrame) -> DataFrame:
    """Stored form of the person rows of a refreshable star: names beside
    the codes by which rows of several batches are compared."""
    return name_countries(person_rows(clean), countries)


def merged(df: DataFrame, name: str) -> DataFrame:
    """One row per key of a refreshed person or flight table over all batches,
    by the same order as within one load."""
    df = df.drop("batch")
    if name == "dim_personal":
        return first_by_key(df, PERSON_KEY, PERSON_ORDER)
    return first_by_key(df, "adm_num", _flight_order())


def read_star(spark: SparkSession, star_dir: str) -> dict[str, DataFrame]:
    """The six tables under ``star_dir``.

    For a refreshed star only the batches of the newest commit are read and the
    bookkeeping columns are resolved: fact rows are all kept; person and flight rows are one
    per key (a partial aggregate, so a key present in every batch costs one row per
    task), exactly those of a build from all months at once. :func:`compact_star`
    shortens that work.
    """
    root = star_dir.rstrip("/")
    tables = {n: spark.read.parquet(f"{root}/{n}") for n in schemas.STAR_SCHEMAS}
    if "batch" not in tables["fact_immigration"].columns:
        return tables
    state = commits.latest(spark, f"{root}/fact_immigration")
    for name in REFRESHED_TABLES:
        df = commits.live_rows(tables[name], state, name)
        if name == "dim_personal":
            df = merged(df, name).drop("citizen_country", "residence_country").withColumnsRenamed(
                {"citizen_country_name": "citizen_country",
                 "residence_country_name": "residence_country"})
        elif name == "dim_flight":
            df = merged(df, name)
        tables[name] = df.select(*schemas.STAR_SCHEMAS[name].fieldNames())
    return tables


def read_summary(spark: SparkSession, star_dir: str) -> DataFrame:
    """``year, month, port, gender, n`` of a refreshable star, merged over its batches."""
    root = star_dir.rstrip("/")
    state = commits.latest(spark, f"{root}/fact_immigration")
    return merged_counts(commits.live_rows(spark.read.parquet(f"{root}/{SUMMARY}"), state, SUMMARY))


def compact_star(spark: SparkSession, star_dir: str) -> None:
    """One stored row per key again in the person, flight and summary tables of a refreshed star.

    The merged rows are a batch of their own, which the next commit puts in the place of
    the batches it was made from. Until then, and if this fails, readers see those;
    a refresh that commits in between keeps its rows, and one that failed before has
    none that are live. Replaced folders are deleted after the commit."""
    root = star_dir.rstrip("/")
    fact = f"{root}/fact_immigration"
    state = commits.latest(spark, fact)
    if state is None:
        raise ValueError(f"{star_dir} was not built with refreshable=True")
    folders = {n: f"{root}/{n}" for n in ("dim_personal", "dim_flight", SUMMARY)}
    for name, path in folders.items():
        batches = state["live"].get(name, [])
        if len(batches) < 2:
            continue
        rows = commits.live_rows(spark.read.parquet(path), state, name)
        batch, _ = commits.claim(spark, fact)
        one = merged_counts(rows) if name == SUMMARY else merged(rows, name)
        write_parquet(one, f"{path}/batch={batch}")
        commits.commit(spark, fact, commits.swapped(batch, name, batches))
    commits.remove_dead(spark, fact, folders)


def register_views(spark: SparkSession, star: str | dict[str, DataFrame],
                   prefix: str = "") -> dict[str, DataFrame]:
    """Expose the star tables to SQL as temporary views.

    ``star`` is the output folder of :func:`build_star` or a ``{name: df}``
    mapping; views are named ``prefix + table``.
    """
    if isinstance(star, str):
        star = read_star(spark, star)
    for name, df in star.items():
        df.createOrReplaceTempView(prefix + name)
    return star
