"""The OLAP question over the star: how many fact rows whose person has a
given attribute arrive at the market with the largest size measure.

Semantics: fact rows are matched to markets by port code (rows without a
market form one NULL group) and to persons by person key, keeping only
rows whose person has the attribute (so the person join is inner, and a
person key present twice counts its facts twice). Counts are taken per
(market name, market size); the answer is the group with the largest size,
NULL sizes last, ties by name.

Plan used here: filter the person dimension first, join it to the narrow
fact projection, **count per port before joining the market dimension**
(partial aggregation collapses every port, hot ones included, to one row
per task), then join the per-port counts to the market dimension,
re-aggregate per market and take the top row. Summing per-port counts
gives exactly the counts of joining first and counting afterwards, fan-out
included.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import hot_key_join, top_k
from .summary import PERSON_KEY


def top_market(fact: DataFrame, markets: DataFrame, persons: DataFrame, *,
               fact_id: str, fact_port: str, fact_person: str | Sequence[str],
               market_code: str, market_name: str, market_size: str,
               person_key: str | Sequence[str], person_attr: str, person_value,
               out_name: str = "market", out_count: str = "n_arrivals",
               out_size: str = "market_size", k: int = 1,
               spread_by: Sequence[str] | None = None) -> DataFrame:
    """Top ``k`` markets by size with their count of matching fact rows (module doc).

    With ``spread_by`` (fact columns that differ within a person) the person join splits
    hot persons itself (:func:`starloom.operators.hot_key_join`) and does not rely on AQE.
    """
    fk = [fact_person] if isinstance(fact_person, str) else list(fact_person)
    pk = [person_key] if isinstance(person_key, str) else list(person_key)
    p = (persons.where(F.col(person_attr) == F.lit(person_value))
         .select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(pk)]))
    spread = {c: f"_s{i}" for i, c in enumerate(spread_by or [])}
    f = fact.select(F.col(fact_id).alias("_id"), F.col(fact_port).alias("_port"),
                    *[F.col(c).alias(f"_f{i}") for i, c in enumerate(fk)],
                    *[F.col(c).alias(n) for c, n in spread.items()])
    if spread:
        joined = hot_key_join(f, p, {f"_f{i}": f"_p{i}" for i in range(len(pk))},
                              list(spread.values()))
    else:
        same = reduce(lambda a, b: a & b, [f[f"_f{i}"] == p[f"_p{i}"] for i in range(len(pk))])
        joined = f.join(p, same, "inner")
    per_port = joined.groupBy("_port").agg(F.count("_id").alias("_n"))
    return _top_of_ports(per_port, markets, market_code, market_name, market_size, out_name,
                         out_count, out_size, k)


def _top_of_ports(per_port: DataFrame, markets: DataFrame, market_code: str, market_name: str,
                  market_size: str, out_name: str, out_count: str, out_size: str, k: int) -> DataFrame:
    """The largest markets with the counts (``_port, _n``) of their ports."""
    m = markets.select(F.col(market_code).alias("_code"),
                       F.col(market_name).alias(out_name),
                       F.col(market_size).alias(out_size))
    per_market = (per_port.join(m, per_port["_port"] == m["_code"], "left")
                  .groupBy(out_name, out_size)
                  .agg(F.sum("_n").cast("bigint").alias(out_count)))
    return top_k(per_market, k, out_size, [out_name]).select(out_name, out_count, out_size)


def top_female_port_city_by_counts(counts: DataFrame, city_population: DataFrame) -> DataFrame:
    """The answer of :func:`top_female_port_city` from the counts that refreshes keep
    (:func:`starloom.plans.star.read_summary`), without reading facts or persons."""
    per_port = (counts.where("gender = 'F'").groupBy(F.col("port").alias("_port"))
                .agg(F.sum("n").alias("_n")))
    return _top_of_ports(per_port, city_population, "city_code", "city", "foreign_population",
                         "city", "n_female_arrivals", "foreign_population", 1)


def top_female_port_city(fact: DataFrame, city_population: DataFrame,
                         personal: DataFrame) -> DataFrame:
    """Arrivals of women at the city with most foreign-born inhabitants, on the
    star tables built by :mod:`.star`."""
    return top_market(fact, city_population, personal,
                      fact_id="id", fact_port="port", fact_person=PERSON_KEY,
                      market_code="city_code", market_name="city",
                      market_size="foreign_population",
                      person_key=PERSON_KEY, person_attr="gender", person_value="F",
                      out_name="city", out_count="n_female_arrivals",
                      out_size="foreign_population")
