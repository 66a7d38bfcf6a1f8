"""URL filter with a cascade of Bloom filters.

Level 0 holds the listed keys; level 1 those keys of the universe that level 0
takes for listed by mistake; level 2 the listed keys that level 1 takes for
mistakes, and so on until a level makes none. A key's first missing level tells
membership, exactly for each key of the universe and of the list, and without a
join. The universe is every key that the corpus can ask about.

The filters are literals of the plan. Their size follows the list, not the corpus
(the logarithm of the universe per listed key), and is checked: above
``MOST_BYTES`` membership comes from a join of the keys instead.

Only DataFrame functions are used. Null urls, and urls without ``://``, have an empty
host and path and fit no rule; repeated rows give one result each; empty tables
and lists work; columns beside id and url are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import stage

MOST_BYTES = 16 << 20
MOST_LEVELS = 64
PAGE_BITS = 32_768      # bits of one aggregated bitmap
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass
class Level:
    bits: bytes
    size: int
    hashes: int
    salt: int

    def places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.salt), F.lit(i)), F.lit(self.size))
                for i in range(self.hashes)]

    def contains(self, key: Column) -> Column:
        table = F.lit(self.bits)
        hit = None
        for place in self.places(key):
            octet = F.conv(F.hex(F.substring(table, (F.floor(place / 8) + 1).cast("int"),
                                             F.lit(1))), 16, 10).cast("long")
            one = F.getbit(octet, F.pmod(place, F.lit(8)).cast("int")) == 1
            hit = one if hit is None else hit & one
        return hit


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def contains(self, key: Column) -> Column:
        """Membership of a key of the universe."""
        found = F.lit(len(self.levels) % 2 == 1)
        for k in reversed(range(len(self.levels))):
            found = F.when(self.levels[k].contains(key), found).otherwise(F.lit(k % 2 == 1))
        return found

    def bytes(self) -> int:
        return sum(len(x.bits) for x in self.levels)


def _level(keys: DataFrame, n: int, rate: float, salt: int) -> Level:
    """Filter over ``n`` distinct keys with about the given rate of mistakes."""
    hashes = max(1, math.ceil(math.log2(1 / rate)))
    size = max(64, math.ceil(1.4427 * n * math.log2(1 / rate) / 8) * 8)
    level = Level(b"", size, hashes, salt)
    place = keys.select(F.explode(F.array(*level.places(F.col("key")))).alias("p"))
    one_based = (F.col("p") + 1).cast("long")
    pages = (place.groupBy(F.bitmap_bucket_number(one_based).alias("page"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(one_based)).alias("bits")).collect())
    out = bytearray(-(-size // PAGE_BITS) * PAGE_BITS // 8)
    for r in pages:
        at = (r.page - 1) * PAGE_BITS // 8
        out[at:at + len(r.bits)] = r.bits
    level.bits = bytes(out[:size // 8])
    return level


def build_cascade(listed: DataFrame, universe: DataFrame, most_bytes: int = MOST_BYTES
                  ) -> Cascade | None:
    """Cascade over the ``key`` columns of both tables; None if the filters would
    be larger than ``most_bytes``."""
    listed = stage(listed.select("key").where("key is not null").distinct(), "listed")
    n_in = listed.count()
    if not n_in:
        return Cascade()
    rest = stage(universe.select("key").where("key is not null").distinct()
                 .join(listed, "key", "left_anti"), "universe")
    n_out = max(1, rest.count())
    cascade = Cascade()
    keys, others, n = listed, rest, n_in
    for k in range(MOST_LEVELS):
        # the first level is as exact as makes the levels together smallest
        rate = min(0.5, n_in / n_out / math.sqrt(2)) if k == 0 else 0.5
        if cascade.bytes() + 1.4427 * n * math.log2(1 / rate) / 8 > most_bytes:
            return None
        level = _level(keys, n, rate, k)
        cascade.levels.append(level)
        wrong = stage(others.where(level.contains(F.col("key"))), "wrong")
        n = wrong.count()
        if not n:
            return cascade
        keys, others = wrong, keys
    raise RuntimeError(f"the cascade did not end after {MOST_LEVELS} levels")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a url."""
    known = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, UPPER.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(""), F.when(known, path).otherwise("")


def candidates(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """All host suffixes of so many labels with path prefixes of so many
    characters: the keys that can be a rule for this url."""
    parts = F.split(host, r"\.", -1)
    hosts = F.array(*[F.when(F.size(parts) >= n, F.array_join(
        F.slice(parts, F.size(parts) - n + 1, n), ".")) for n in labels])
    paths = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths])
    pairs = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))
    return F.array_compact(pairs)


def judge_urls(pages: DataFrame, allow: list[tuple[str, str]], block: list[tuple[str, str]],
               id_col: str = "page_id", url_col: str = "url", most_bytes: int = MOST_BYTES
               ) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``. Rules are (host, path)
    pairs; the longest fitting one decides, and a url on no list is allowed."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select(
        "page_id", host.alias("host"), path.alias("path"))
    rules = [(h, p) for h, p in (*allow, *block)]
    if not rules:
        return urls.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")})
    labels = sorted({h.count(".") + 1 for h, _ in rules})
    lengths = sorted({len(p) for _, p in rules})
    asked = urls.withColumn("keys", candidates(F.col("host"), F.col("path"), labels, lengths))
    universe = stage(asked.select(F.explode("keys").alias("key")).distinct(), "keys")
    lists = [spark.createDataFrame([(h + p,) for h, p in rows] or [("",)], "key string")
             .where("key != ''") for rows in (allow, block)]
    cascades = [build_cascade(x, universe, most_bytes) for x in lists]
    for name, cascade, keys in zip(("allowed", "blocked"), cascades, lists):
        if cascade is None:
            asked = _by_join(asked, keys, name)
        else:
            asked = asked.withColumn(name, F.filter("keys", cascade.contains))

    def longest(column):
        return F.array_max(F.transform(column, lambda k: F.struct(
            F.length(k).alias("n"), k.alias("key"))))
    best = asked.withColumns({"a": longest("allowed"), "b": longest("blocked")})
    blocked = F.col("b").isNotNull() & (F.col("a").isNull() | (F.col("b.n") >= F.col("a.n")))
    return best.select("page_id", "host", "path",
                       F.when(blocked, F.col("b.key")).otherwise(F.col("a.key")).alias("rule"),
                       F.when(blocked, "block").otherwise("allow").alias("verdict"))


def _by_join(asked: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """Listed ones of each row's keys by a join, for lists beyond the filter bound."""
    rows = stage(asked.withColumn("row", F.monotonically_increasing_id()), "asked")
    hits = (rows.select("row", F.explode("keys").alias("key")).join(keys.distinct(), "key")
            .groupBy("row").agg(F.collect_set("key").alias(name)))
    return (rows.join(hits, "row", "left").drop("row")
            .withColumn(name, F.coalesce(name, F.array().cast("array<string>"))))
