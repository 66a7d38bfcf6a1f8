"""A third of all rows on one key: results stay exact, hot work is split."""

import pytest
from pyspark.sql import functions as F

from starloom.operators import dq_fk_orphans, first_by_key, hot_key_join, hot_keys, rows_at_group_max
from starloom.operators.joins import SALTS_PER_SHARE
from starloom.plans.olap import top_market

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.fixture()
def skewed(spark):
    n = 30000
    # one port and one person carry a third of all fact rows
    fact = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("port"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 4000).alias("person"))
    persons = spark.range(4000).select(
        F.col("id").alias("pkey"),
        F.when(F.col("id") % 2 == 1, "F").otherwise("M").alias("gender"))
    markets = spark.range(500).select(
        F.col("id").alias("code"), F.concat(F.lit("m"), F.col("id")).alias("name"),
        ((F.col("id") * 37) % 101).alias("size"))
    return fact, persons, markets


def test_top_market_exact_under_skew(spark, skew_conf, skewed):
    fact, persons, markets = skewed
    got = top_market(fact, markets, persons, fact_id="id", fact_port="port",
                     fact_person="person", market_code="code", market_name="name",
                     market_size="size", person_key="pkey", person_attr="gender",
                     person_value="F").collect()
    for name, df in (("sk_fact", fact), ("sk_persons", persons), ("sk_markets", markets)):
        df.createOrReplaceTempView(name)
    want = spark.sql("""
        SELECT m.name AS market, count(f.id) AS n_arrivals, m.size AS market_size
        FROM sk_fact f JOIN sk_persons p ON f.person = p.pkey AND p.gender = 'F'
        LEFT JOIN sk_markets m ON f.port = m.code
        GROUP BY m.name, m.size ORDER BY m.size DESC NULLS LAST, m.name LIMIT 1""").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_hot_join_key_is_split_by_aqe(spark, skew_conf, skewed):
    fact, persons, _ = skewed
    joined = fact.join(persons, fact.person == persons.pkey)
    rows = joined.collect()  # runs this DataFrame's own (adaptive) plan
    assert len(rows) == 30000
    final = joined._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in final, final


def test_group_operators_exact_under_skew(spark, skew_conf, skewed):
    fact, _, _ = skewed
    fact.createOrReplaceTempView("sk_fact2")
    got = sorted(map(tuple, rows_at_group_max(fact, "port", "person").collect()))
    want = sorted(map(tuple, spark.sql("""
        SELECT a.* FROM sk_fact2 a JOIN (SELECT port, max(person) m FROM sk_fact2 GROUP BY port) b
        ON a.port = b.port AND a.person = b.m""").collect()))
    assert got == want
    first = {r.port: r.id for r in first_by_key(fact, "port", ["id"]).collect()}
    assert first[7] == 0 and len(first) == 500
    orph = dq_fk_orphans(fact, "person", spark.range(2).withColumnRenamed("id", "pk"),
                         "pk", "f->p").first()
    assert orph.n_orphan_rows == 30000 - fact.where("person IN (0, 1)").count()


@pytest.fixture()
def no_aqe(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_keys_lists_keys_above_their_share(spark, skewed):
    fact, _, _ = skewed
    want = spark.range(1).select(F.xxhash64(F.lit(7).cast("bigint")).alias("h")).first().h
    rows = fact.where("port = 7").count()
    got = {r.key_hash: r.n_salts for r in hot_keys(fact, "port", 8).collect()}
    assert got == {want: -(-rows * 8 * SALTS_PER_SHARE // 30000)}
    assert hot_keys(fact.where("false"), "port", 8).count() == 0
    assert hot_keys(fact.select(F.lit(None).cast("int").alias("port")), "port", 8).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_key_join_equals_plain_join(spark, no_aqe, skewed, how):
    fact, persons, _ = skewed
    f = (fact.withColumn("person", F.when(F.col("id") % 11 != 0, F.col("person")))
         .withColumn("gender", F.lit("x")))                # a name on both sides
    f = f.unionByName(f.where("id < 50"))                  # repeated rows
    p = (persons.where("pkey % 5 != 0").unionByName(persons.where("pkey < 20"))  # missing, repeated
         .withColumn("pkey", F.col("pkey").cast("int"))    # another width
         .unionByName(spark.sql("SELECT CAST(NULL AS INT) pkey, 'F' gender")))
    want = f.join(p, f.person == p.pkey, how)
    got = hot_key_join(f, p, {"person": "pkey"}, ["id"], how, shares=8)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert hot_key_join(f.where("false"), p, {"person": "pkey"}, ["id"], how).count() == 0
    none = hot_key_join(f, p.where("false"), {"person": "pkey"}, ["id"], how).count()
    assert none == (0 if how in ("inner", "left_semi") else f.count())


def test_hot_key_join_of_two_columns(spark, no_aqe):
    f = spark.range(6000).select("id", F.when(F.col("id") % 2 == 0, "a").alias("x"),
                                 (F.col("id") % 3).alias("y"))
    d = spark.sql("SELECT * FROM VALUES ('a', 0, 1), ('a', 1, 2), ('b', 1, 3), (NULL, 2, 4) AS t(c, y, v)")
    got = hot_key_join(f, d, {"x": "c", "y": "y"}, ["id"], "left")
    want = f.join(d, (f.x == d.c) & (f.y == d.y), "left")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_key_is_split_without_aqe(spark, no_aqe, skewed):
    fact, persons, _ = skewed

    def per_task(df):
        rows = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
        counts = sorted(r["count"] for r in rows)
        return counts[-1], counts[len(counts) // 2]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        most, median = per_task(fact.join(persons, fact.person == persons.pkey))
        assert most > 4 * median
        most, median = per_task(hot_key_join(fact, persons, {"person": "pkey"}, ["id"]))
        assert most <= 2 * median
        # null keys are dealt too
        nulls = fact.withColumn("person", F.when(F.col("id") % 3 != 0, F.col("person")))
        most, median = per_task(hot_key_join(nulls, persons, {"person": "pkey"}, ["id"], "left"))
        assert most <= 2 * median
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_hot_key_join_refuses_what_it_cannot_split(spark, skewed):
    fact, persons, _ = skewed
    with pytest.raises(ValueError, match="left_semi"):
        hot_key_join(fact, persons, {"person": "pkey"}, ["id"], "full")
    with pytest.raises(ValueError, match="differ in type"):
        hot_key_join(fact, persons, {"person": "gender"}, ["id"])
    x = fact.withColumn("person", F.col("person").cast("double"))
    with pytest.raises(ValueError, match="cannot be split"):
        hot_key_join(x, persons.withColumn("pkey", F.col("pkey").cast("double")), {"person": "pkey"}, ["id"])
