"""Run queries() against oracle_sql() the way the driver does (row count,
column names, order-insensitive values). Usable from pytest and as a CLI:

    python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT_FLOATS = os.environ.get("ORACLE_EXACT_FLOATS", "1") == "1"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if EXACT_FLOATS else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def _rows(cols, tuples):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in tuples]
    return sorted(out, key=lambda r: tuple("\0" if x is None else x for x in r))


SPARK_TYPES = {"bigint": "int64", "int": "int32", "smallint": "int16", "tinyint": "int8",
               "double": "float64", "float": "float32", "string": "string",
               "boolean": "bool", "timestamp_ntz": "timestamp", "timestamp": "timestamp",
               "date": "date"}
DUCK_TYPES = {"BIGINT": "int64", "INTEGER": "int32", "SMALLINT": "int16", "TINYINT": "int8",
              "DOUBLE": "float64", "FLOAT": "float32", "VARCHAR": "string",
              "BOOLEAN": "bool", "TIMESTAMP": "timestamp", "DATE": "date"}


def _types(sdf, cur) -> dict:
    s = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
         for f in sdf.schema.fields}
    d = {c[0]: DUCK_TYPES.get(str(c[1]), str(c[1])) for c in cur.description}
    return {k: (s.get(k), d.get(k)) for k in sorted(set(s) | set(d)) if s.get(k) != d.get(k)}


def compare(spark, key: str, fn, sql: str | None, sf_dir: str, con) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"columns differ: spark={s_cols} oracle={d_cols}"
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a == b:
        res["status"] = "ok"
        mism = _types(sdf, cur)
        if mism:
            res["status"] = f"types differ: {mism}"
    else:
        diff = [x for x in a if x not in set(b)][:3]
        diff2 = [x for x in b if x not in set(a)][:3]
        res["status"] = f"values differ: spark-only={diff} oracle-only={diff2}"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/") and not a.startswith("--")]
    import __spark_entry__ as E
    if "--plain" in argv:  # a session with none of the library's options
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]")
                 .config("spark.ui.enabled", "false")
                 .config("spark.sql.session.timeZone", "America/Los_Angeles").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from starloom.session import build_session
        spark = build_session(shuffle_partitions=8)
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or sorted(qs):
        try:
            r = compare(spark, k, qs[k], orc.get(k), sf_dir, con)
        except Exception as e:  # report and continue
            r = {"key": k, "status": f"error: {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("ok", "no-oracle")
        print(r, flush=True)
    print(f"{len(keys or qs) - bad} ok / {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
