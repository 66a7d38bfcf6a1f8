"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints are 64 bits: a bit is 1 if it is set in over half of the shingle
hashes (XXH64, seed 42). Distinct fingerprints are sorted by Gray rank, where
neighbours differ in few bits, and dealt out in ranges of that order. Each range
knows the bits all its members share; a pair of ranges whose shared bits already
differ in more than ``max_bits`` places is never brought together. Within a
pair of ranges the sorted members form a tree: a node keeps the shared bits of its
group as mask and pattern, differences of patterns under both masks are a lower
bound for all pairs below, and whole groups are pruned by it. Links found are
kept as a spanning forest per task; components follow by star contraction of
the remaining links, whose lineage is cut in the shared scratch folder.

Null and empty texts have fingerprint zero and link like any other. Equal
fingerprints are one vertex, so copies are never paired. A null id is never a
component's smallest id; a component of null ids only has a null component_id.
Repeated rows give one result row each; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import as_bytes, documents_view, small_batches, stage

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
RANGE_ROWS = 100_000  # distinct fingerprints of a range, on average
MOST_RANGES = 4096    # bound of the range table that the driver sees
FAN_OUT = 4

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(raw: bytes | None, words: int = SHINGLE_WORDS) -> list[bytes]:
    """Space-joined runs of ``words`` words, repeats included."""
    parts = (raw or b"").translate(_LOWER).split()
    if len(parts) <= words:
        return [b" ".join(parts)] if parts else []
    joined = b" ".join(parts)
    ends, at = [], -1
    for p in parts:
        at += len(p) + 1
        ends.append(at)
    starts = [0] + [e + 1 for e in ends]
    return [joined[starts[i]:ends[i + words - 1]] for i in range(len(parts) - words + 1)]


def _bit_table():
    import numpy as np
    return np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(hashes, table) -> int:
    """Majority of every bit over an array of 64-bit hashes."""
    import numpy as np
    if not len(hashes):
        return 0
    octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    if len(hashes) < 400:
        counts = np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    else:  # per byte: how often each value occurs, times its bits
        counts = np.concatenate([np.bincount(octets[:, k], minlength=256) @ table
                                 for k in range(8)])
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def _fingerprint_batches(batches, words: int):
    import numpy as np
    import pyarrow as pa
    import xxhash
    digest = xxhash.xxh64_intdigest
    table = _bit_table()
    for batch in small_batches(batches):
        out = []
        for raw in as_bytes(batch.column("text")):
            hashes = np.array([digest(s, SEED) for s in shingles(raw, words)], np.uint64)
            out.append(fingerprint(hashes, table))
        keep = [batch.column(i) for i in range(batch.num_columns)
                if batch.schema.field(i).name != "text"]
        names = [n for n in batch.schema.names if n != "text"]
        codes = np.array(out, np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(keep + [pa.array(codes)], names + ["code"])


def with_fingerprints(view: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``view`` with ``code`` (fingerprint as a signed long) in place of ``text``."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in view.schema.fields
                       if f.name != "text")
    return view.mapInArrow(lambda it: _fingerprint_batches(it, words), f"{fields}, code long")


def gray_rank(codes):
    """Position of each code in the reflected Gray sequence."""
    import numpy as np
    rank = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


def gray_rank_column(code: str):
    """Gray rank as a signed long that sorts like the unsigned one."""
    rank = F.col(code)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


class Index:
    """Levels of groups over codes in Gray order: shared bits as mask and pattern."""

    def __init__(self, codes, fan_out: int = FAN_OUT):
        import numpy as np
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        ones, any_ = [self.codes], [self.codes]
        while len(ones[-1]) > 1:
            starts = np.arange(0, len(ones[-1]), fan_out)
            ones.append(np.bitwise_and.reduceat(ones[-1], starts))
            any_.append(np.bitwise_or.reduceat(any_[-1], starts))
        self.fan_out = fan_out
        self.masks = [~(a ^ o) for a, o in zip(ones, any_)]
        self.patterns = ones

    def size(self, level: int) -> int:
        return len(self.patterns[min(level, len(self.patterns) - 1)])

    def at(self, level: int):
        level = min(level, len(self.patterns) - 1)
        return self.patterns[level], self.masks[level]


class Forest:
    """Union-find over array positions."""

    def __init__(self, n: int):
        import numpy as np
        self.up = np.arange(n)

    def roots(self, x):
        import numpy as np
        r = self.up[x]
        while True:
            nxt = self.up[r]
            if np.array_equal(nxt, r):
                self.up[x] = r
                return r
            r = nxt

    def link(self, a, b) -> None:
        import numpy as np
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            open_ = ra != rb
            if not open_.any():
                return
            a, b = a[open_], b[open_]
            low, high = np.minimum(ra, rb)[open_], np.maximum(ra, rb)[open_]
            np.minimum.at(self.up, high, low)


def search(left: Index, right: Index, max_bits: int, found, step: int = 4096) -> None:
    """Call ``found(i, j)`` with arrays of positions of near codes. ``left`` and
    ``right`` may be one index; then each pair comes once."""
    import numpy as np
    same = left is right
    top = max(len(left.patterns), len(right.patterns)) - 1
    todo = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        level, a, b = todo.pop()
        if len(a) > step:  # depth first in bounded blocks
            todo += [(level, a[k:k + step], b[k:k + step]) for k in range(0, len(a), step)]
            continue
        (pa, ma), (pb, mb) = left.at(level), right.at(level)
        near = np.bitwise_count((pa[a] ^ pb[b]) & ma[a] & mb[b]) <= max_bits
        a, b = a[near], b[near]
        if not len(a):
            continue
        if level == 0:
            if same:
                other = a != b
                a, b = a[other], b[other]
            found(a, b)
            continue
        a, b = _children(left, right, level, a, b)
        if same:
            upper = a <= b
            a, b = a[upper], b[upper]
        todo.append((level - 1, a, b))


def _children(left: Index, right: Index, level: int, a, b):
    """All pairs of children of each pair of nodes."""
    import numpy as np

    def below(index, x):
        if level >= len(index.patterns):  # the shorter tree waits at its root
            return x[:, None], np.ones((len(x), 1), bool)
        kids = x[:, None] * index.fan_out + np.arange(index.fan_out)
        return kids, kids < index.size(level - 1)
    ka, va = below(left, a)
    kb, vb = below(right, b)
    ok = va[:, :, None] & vb[:, None, :]
    shape = ok.shape
    return (np.broadcast_to(ka[:, :, None], shape)[ok], np.broadcast_to(kb[:, None, :], shape)[ok])


def _link_task(pdf, max_bits: int):
    """Links within one range, or between the two ranges of a task, as (code,
    smallest position's code of its tree) pairs."""
    import numpy as np
    import pandas as pd
    codes = pdf["code"].to_numpy().view(np.uint64)
    part = pdf["part"].to_numpy()
    sides = [Index(codes[part == p]) for p in np.unique(part)]
    every = np.concatenate([x.codes for x in sides])
    forest = Forest(len(every))
    if len(sides) == 1:
        search(sides[0], sides[0], max_bits, forest.link)
    else:
        at = len(sides[0].codes)
        search(sides[0], sides[1], max_bits, lambda i, j: forest.link(i, j + at))
    root = forest.roots(np.arange(len(every)))
    linked = root != np.arange(len(every))
    return pd.DataFrame({"a": every[linked].view(np.int64), "b": every[root[linked]].view(np.int64)})


def near_links(codes: DataFrame, max_bits: int = MAX_BITS, range_rows: int = RANGE_ROWS
               ) -> DataFrame:
    """Links (a, b) that connect the distinct ``code`` values as all pairs within
    ``max_bits`` would; staged."""
    ranked = codes.select("code", gray_rank_column("code").alias("rank"))
    n = ranked.count()
    parts = int(min(MOST_RANGES, max(1, -(-n // range_rows))))
    cuts = sorted(set(ranked.approxQuantile("rank", [k / parts for k in range(1, parts)],
                                            0.1 / parts))) if parts > 1 else []
    # quantiles are doubles: cut on the upper 48 bits, which doubles hold exactly
    cuts = sorted({int(c) >> 16 for c in cuts})
    upper = F.shiftright("rank", 16)
    part = F.lit(0)
    if cuts:
        array = F.array(*[F.lit(c) for c in cuts])
        part = F.size(F.filter(array, lambda c: c <= upper)) if len(cuts) <= 64 else \
            F.aggregate(array, F.lit(0), lambda s, c: s + (c <= upper).cast("int"))
    ranked = stage(ranked.select("code", part.cast("int").alias("part")), "gray")
    shared = ranked.groupBy("part").agg(F.bit_and("code").alias("ones"),
                                        F.bit_or("code").alias("any")).collect()
    pairs = _range_pairs([(r.part, r.ones, r.any) for r in shared], max_bits)
    tasks = ranked.sparkSession.createDataFrame(
        [(p, x, y) for x, y in pairs for p in {x, y}], "part int, x int, y int")
    dealt = ranked.join(F.broadcast(tasks), "part")  # bounded with the ranges
    # a task holds one range or two, whatever the number of ranges
    return stage(dealt.groupBy("x", "y").applyInPandas(
        lambda pdf: _link_task(pdf, max_bits), "a long, b long"), "links")


def _range_pairs(shared, max_bits: int) -> list[tuple[int, int]]:
    """Pairs of ranges that have to meet, each range with itself included."""
    import numpy as np
    full = (1 << 64) - 1
    parts = [p for p, _, _ in shared]
    patterns = np.array([a & full for _, a, _ in shared], np.uint64)
    masks = np.array([~(a ^ o) & full for _, a, o in shared], np.uint64)
    out = []
    for i, p in enumerate(parts):
        apart = np.bitwise_count((patterns[i] ^ patterns[i:]) & masks[i] & masks[i:])
        out += [(p, parts[i + int(j)]) for j in np.flatnonzero(apart <= max_bits)]
    return out


def star_components(links: DataFrame, name: str = "star", most_rounds: int = 40) -> DataFrame:
    """(code, root): the smallest code of each linked code's component.

    Alternates large and small stars; every round is written to the shared
    folder. Hubs are handled by partial minima and ordinary joins."""
    edges = stage(links.where("a != b").select(F.greatest("a", "b").alias("a"),
                                               F.least("a", "b").alias("b")).distinct(), name)
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = large.where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = (small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(small.select("a", F.col("m").alias("b")))
                 .where("a != b").distinct())
        new = stage(small, name)
        before, after = (e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                         .first() for e in (edges, new))
        edges = new
        if tuple(before) == tuple(after):
            return edges.select(F.col("a").alias("code"), F.col("b").alias("root"))
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per document: ``doc_id, text_hash, code, component_id`` (the smallest id
    of the component)."""
    view = documents_view(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    marked = stage(with_fingerprints(view, words), "codes")
    classes = stage(marked.groupBy("code").agg(F.min("doc_id").alias("least")), "classes")
    roots = star_components(near_links(classes.select("code"), max_bits, range_rows))
    rooted = classes.join(roots, "code", "left").select(
        "code", "least", F.coalesce("root", "code").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("code", "component_id")
    return marked.join(named, "code").select("doc_id", "text_hash", "code", "component_id")


def fingerprint_hex(code):
    return F.lower(F.lpad(F.hex(code), 16, "0"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without all but one row of every component: the row with the
    smallest id (of equal ids: smallest text hash, then any one of the equal
    rows). All columns stay."""
    found = stage(near_duplicates(docs, **options), "found")
    rows = found.groupBy("doc_id", "text_hash", "component_id").agg(F.count("*").alias("n"))
    best = rows.groupBy("component_id").agg(F.min_by(
        F.struct("doc_id", "text_hash", "n"),
        F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("best"))
    best = stage(best.select("best.*").withColumnsRenamed(
        {"doc_id": "_id", "text_hash": "_hash", "n": "_n"}), "best")
    match = (docs["doc_id"].eqNullSafe(best["_id"])
             & (F.xxhash64(docs["text"]) == best["_hash"]))
    single = docs.join(best.where("_n = 1"), match, "left_semi")
    key = F.struct(docs["doc_id"], F.xxhash64(docs["text"]))
    several = (docs.join(best.where("_n > 1"), match, "left_semi")
               .groupBy(key.alias("_key")).agg(F.first(F.struct(*docs.columns)).alias("_row"))
               .select("_row.*"))
    return single.unionByName(several)
