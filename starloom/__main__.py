"""Command line: build the star, check it, ask the OLAP question.

    python -m starloom build --arrivals A --dictionary D --demographics C \
        --airports P --out OUT [--person-buckets N --database DB | --refreshable]
    python -m starloom check --star OUT [--out FINDINGS]
    python -m starloom ask --star OUT
    python -m starloom sql --star OUT "SELECT ... FROM fact_immigration ..." [--out RESULT]
    python -m starloom refresh --landing NEW_MONTHS --star OUT --dictionary D \
        [--checkpoint CKPT] [--max-files N]     # after build --refreshable
    python -m starloom compact --star OUT       # after many refreshes

``--out`` writes the whole result as Parquet; what is printed is a first part of it
and says so.

Under spark-submit the cluster's session is used as configured; run
directly, a local session is created.
"""

from __future__ import annotations

import argparse

from pyspark import SparkConf
from pyspark.sql import SparkSession


def _session() -> SparkSession:
    if SparkConf().contains("spark.master"):  # spark-submit / cluster
        return SparkSession.builder.appName("starloom").getOrCreate()
    from .session import build_session
    return build_session()


def _print(df, rows: int) -> None:
    """The first ``rows`` rows, and how many there are if that is not all."""
    n = df.count()
    df.show(rows, truncate=False)
    if n > rows:
        print(f"{rows} of {n} rows shown; --out writes all")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="starloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    for name in ("arrivals", "dictionary", "demographics", "airports", "out"):
        b.add_argument(f"--{name}", required=True)
    b.add_argument("--person-buckets", type=int)
    b.add_argument("--database")
    b.add_argument("--refreshable", action="store_true")
    r = sub.add_parser("refresh")
    r.add_argument("--landing", required=True)
    r.add_argument("--star", required=True)
    r.add_argument("--dictionary", required=True)
    r.add_argument("--checkpoint")
    r.add_argument("--max-files", type=int)
    for name in ("check", "ask", "compact"):
        one = sub.add_parser(name)
        one.add_argument("--star", required=True)
        if name == "check":
            one.add_argument("--out")
    q = sub.add_parser("sql")
    q.add_argument("--star", required=True)
    q.add_argument("query")
    q.add_argument("--rows", type=int, default=50, help="rows to print")
    q.add_argument("--out", help="folder for the whole result")
    args = ap.parse_args(argv)

    spark = _session()
    if args.cmd == "build":
        from .plans.star import build_star
        for table, path in build_star(spark, args.arrivals, args.dictionary, args.demographics,
                                      args.airports, args.out,
                                      person_buckets=args.person_buckets,
                                      database=args.database,
                                      refreshable=args.refreshable).items():
            print(f"{table}\t{path}")
    elif args.cmd == "check":
        from .operators import raise_on_failure
        from .plans.checks import check_star
        from .session import scratch_path
        from .sources.files import write_parquet
        # one pass over the star; the small findings table is shown and checked
        findings = spark.read.parquet(write_parquet(
            check_star(spark, args.star, raise_errors=False),
            args.out or scratch_path(spark, "findings")))
        _print(findings.orderBy("ok", "check", "subject"), 200)
        raise_on_failure(findings, "star")
    elif args.cmd == "refresh":
        from .streaming import refresh_star
        refresh_star(spark, args.landing, args.star, args.dictionary, args.checkpoint,
                     args.max_files).awaitTermination()
        print(f"refreshed {args.star}")
    elif args.cmd == "sql":
        from .plans.star import register_views
        register_views(spark, args.star)
        result = spark.sql(args.query)
        if args.out:
            from .sources.files import write_parquet
            result = spark.read.parquet(write_parquet(result, args.out))
        _print(result, args.rows)
    elif args.cmd == "compact":
        from .plans.star import compact_star
        compact_star(spark, args.star)
        print(f"compacted {args.star}")
    else:
        from .plans.olap import top_female_port_city
        from .plans.star import read_star
        t = read_star(spark, args.star)
        top_female_port_city(t["fact_immigration"], t["dim_city_population"],
                             t["dim_personal"]).show(truncate=False)


if __name__ == "__main__":
    main()
