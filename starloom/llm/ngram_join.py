"""Jaccard self-join over word n-grams with prefix, length, positional and suffix filters.

A document's set holds the 64-bit hashes of its different n-grams (fewer words than
``words``: the whole sequence). Documents with equal sets are one vertex. N-grams are counted
over all vertices by tasks that each own a share of the hashes; n-grams of one vertex
only can be in no intersection, take the first places of the order (rarest first) and travel
no further. Vertices whose prefix, the places that a similar set must share one of,
has no n-gram in common with another vertex are done.

The others are joined on their prefix n-grams in two steps that together verify
each pair at most once and miss none:

1. every vertex is verified against one vertex of its n-grams, the one with the fewest
   n-grams of its own (the middle of a group of near copies);
2. of all pairs on a common prefix n-gram those that step 1 has left in different
   components pass the length, positional and suffix filter and are verified. N-grams
   whose vertices are all in one component take no part, so a large group of near
   copies makes as many pairs as members, not their square.

Verification intersects the whole sets. N-grams found in over ``HOT_SHARE`` of the documents
(a bounded list) are not gathered for counting: they come last in the order.

Null texts, texts without words: empty set, linked with nothing, own component. A
null id is never a component's smallest id; a component of null ids only has a
null component_id. Repeated rows give one result row each; other columns are ignored.
Sets are held equal if 64-bit hashes are, n-grams if the upper 48 bits of theirs and
their share of the hashes are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import ngrams
from starloom.llm.common import documents_view, stage
from starloom.llm.simhash import star_components

SHINGLE_WORDS = 5
PERCENT = 80
BLANKS = b" \t\n\x0b\x0c\r"
HOT_SHARE = 0.01      # of all documents: at most 1 / share n-grams per n-gram of a document
SLICE_SHARE = 0.02    # of a slice: what is counted as a candidate for hot
PART_GRAMS = 4_000_000
MOST_PARTS = 1 << 16
FLUSH_GRAMS = 1_000_000
SUFFIX_PARTS = 32


def needed(a, b, percent: int = PERCENT):
    """Least intersection of two linked sets of sizes ``a`` and ``b``."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n, percent: int = PERCENT):
    """Places of a set's order of which a linked set shares one at least."""
    return n - -(-percent * n // 100) + 1


# --- sets of a slice of texts ------------------------------------------------------------

def _sets(texts, words: int):
    """Sorted n-gram hashes of every text."""
    import numpy as np
    found = ngrams.joined(texts, ngrams.byte_kinds(BLANKS))
    at = found.places(words, found.doc)
    doc, grams = found.doc[at], found.grams(words, at)
    length = np.bincount(found.doc, minlength=len(texts))
    first = np.cumsum(length) - length
    for n in range(1, words):
        short = np.flatnonzero(length == n)
        doc = np.concatenate([doc, short])
        grams = np.concatenate([grams, found.grams(n, first[short])])
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    doc, grams = doc[new], grams[new]
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [grams[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def _vertex(grams) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(grams.tobytes())


def _signed(values):
    import numpy as np
    return np.array(values, np.uint64).view(np.int64)


def _mark_batches(batches, words: int):
    """A row per document (``doc_id, vertex, n``) and rows ``gram, n`` of n-grams that are
    frequent in a slice."""
    import numpy as np
    import pyarrow as pa
    for part, texts in ngrams.text_slices(batches):
        sets = _sets(texts, words)
        sizes = np.array([len(s) for s in sets], np.int64)
        vertex = _signed([_vertex(s) if len(s) else 0 for s in sets])
        grams, counts = np.unique(np.concatenate(sets), return_counts=True)
        often = counts >= max(8, SLICE_SHARE * len(sets))
        grams, counts = grams[often].view(np.int64), counts[often]
        ids = part.column("doc_id")
        none = pa.nulls(len(grams))
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([ids, none.cast(ids.type)]),
             pa.concat_arrays([pa.array(vertex, mask=sizes == 0), none.cast(pa.int64())]),
             pa.array(np.concatenate([sizes, counts])),
             pa.concat_arrays([pa.nulls(len(sets)).cast(pa.int64()), pa.array(grams)])],
            ["doc_id", "vertex", "n", "gram"])


# --- counting n-grams in shares of the hashes -------------------------------------------------

def _share(grams, parts: int):
    """Share of every hash, by its lowest 16 bits."""
    import numpy as np
    return ((grams & np.uint64(0xFFFF)) * np.uint64(parts) >> np.uint64(16)).astype(np.int64)


def _narrow(grams, parts: int):
    """The hash as it can be told from the share and the upper 48 bits."""
    import numpy as np
    return grams & ~np.uint64(0xFFFF) | _share(grams, parts).astype(np.uint64)


def _request_batches(batches, words: int, parts: int, hot):
    """Rows (share, vertices, sizes, counts, hashes); hot n-grams go to a negative share
    that is a vertex's own, so that their rows spread."""
    import numpy as np
    import pyarrow as pa
    hot = np.array(hot, np.int64).view(np.uint64)
    seen: set = set()
    held: list = []
    size = 0

    def flush():
        vertex = np.array([v for v, _ in held], np.uint64)
        sizes = np.array([len(s) for _, s in held], np.uint32)
        grams = np.concatenate([s for _, s in held])
        doc = np.repeat(np.arange(len(held)), sizes)
        share = _share(grams, parts)
        common = np.isin(grams, hot)
        share[common] = -1 - (vertex[doc[common]] % np.uint64(parts)).astype(np.int64)
        grams = _narrow(grams, parts)
        order = np.lexsort((doc, share))
        share, doc, grams = share[order], doc[order], grams[order]
        cuts = np.flatnonzero(np.concatenate([[True], share[1:] != share[:-1]]))
        rows: list = [[], [], [], [], []]
        for a, b in zip(cuts, [*cuts[1:], len(share)]):
            own, counts = np.unique(doc[a:b], return_counts=True)
            octets = grams[a:b].view(np.uint8).reshape(-1, 8)
            blob = octets if share[a] < 0 else octets[:, 2:]  # the share tells the lowest two
            for to, x in zip(rows, (int(share[a]), vertex[own].tobytes(), sizes[own].tobytes(),
                                    counts.astype(np.uint32).tobytes(), blob.tobytes())):
                to.append(x)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.int32())] + [pa.array(r, pa.binary()) for r in rows[1:]],
            ["share", "vertices", "sizes", "counts", "grams"])

    for _, texts in ngrams.text_slices(batches):
        for s in _sets(texts, words):
            if not len(s):
                continue
            v = _vertex(s)
            if v not in seen:  # copies in the same task
                seen.add(v)
                held.append((v, s))
                size += len(s)
        if size >= FLUSH_GRAMS:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _whole(table, name: str, kind):
    import numpy as np
    return np.concatenate([np.frombuffer(b, kind) for b in table.column(name).to_pylist()])


def _count_share(table, bundles: int):
    """For one share: the n-grams of two or more vertices with their class of frequency (eighths
    of powers of two; hot ones 255), by vertex, a row for every bundle of vertices."""
    import numpy as np
    import pyarrow as pa
    share = table.column("share")[0].as_py()
    counts = _whole(table, "counts", np.uint32)
    vertex = np.repeat(_whole(table, "vertices", np.uint64), counts)
    sizes = np.repeat(_whole(table, "sizes", np.uint32), counts)
    octets = _whole(table, "grams", np.uint8)
    if share < 0:
        grams = octets.view(np.uint64)
    else:
        full = np.zeros((len(octets) // 6, 8), np.uint8)
        full[:, 2:] = octets.reshape(-1, 6)
        grams = full.view(np.uint64).ravel() | np.uint64(share)
    order = np.lexsort((vertex, grams))
    vertex, sizes, grams = vertex[order], sizes[order], grams[order]
    new = np.ones(len(grams), bool)  # copies in other tasks
    new[1:] = (grams[1:] != grams[:-1]) | (vertex[1:] != vertex[:-1])
    vertex, sizes, grams = vertex[new], sizes[new], grams[new]
    starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    often = np.diff(np.append(starts, len(grams)))
    level = np.minimum(254, 8 * np.log2(often)).astype(np.uint8)
    if share < 0:
        level[:], often = 255, often + 1
    keep = np.repeat(often > 1, np.diff(np.append(starts, len(grams))))
    level = np.repeat(level, np.diff(np.append(starts, len(grams))))[keep]
    vertex, sizes, grams = vertex[keep], sizes[keep], grams[keep]
    bundle = (vertex % np.uint64(bundles)).astype(np.int64)
    order = np.lexsort((vertex, bundle))
    vertex, sizes, grams, level = vertex[order], sizes[order], grams[order], level[order]
    bundle = bundle[order]
    first = np.ones(len(vertex), bool)
    first[1:] = vertex[1:] != vertex[:-1]
    starts = np.flatnonzero(first)
    counts = np.diff(np.append(starts, len(vertex))).astype(np.uint32)
    own, sizes, of = vertex[starts], sizes[starts], bundle[starts]
    cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else of
    rows: list = [[], [], [], [], [], []]
    ends = np.append(starts, len(vertex))
    for a, b in zip(cuts, [*cuts[1:], len(of)]):
        for to, x in zip(rows, (int(of[a]), own[a:b].tobytes(), sizes[a:b].tobytes(),
                                counts[a:b].tobytes(), grams[ends[a]:ends[b]].tobytes(),
                                level[ends[a]:ends[b]].tobytes())):
            to.append(x)
    return pa.Table.from_arrays(
        [pa.array(rows[0], pa.int32())] + [pa.array(r, pa.binary()) for r in rows[1:]],
        ["bundle", "vertices", "sizes", "counts", "grams", "levels"])


def _rank_bundle(table, percent: int):
    """Per vertex of a bundle its shared n-grams in the order (rarest first), if its prefix has
    any, and how many of them fall in each part of the hashes."""
    import numpy as np
    import pyarrow as pa
    counts = _whole(table, "counts", np.uint32)
    vertex = np.repeat(_whole(table, "vertices", np.uint64), counts)
    size = np.repeat(_whole(table, "sizes", np.uint32), counts).astype(np.int64)
    grams, level = _whole(table, "grams", np.uint64), _whole(table, "levels", np.uint8)
    order = np.lexsort((grams, level, vertex))
    vertex, size, grams, level = vertex[order], size[order], grams[order], level[order]
    new = np.ones(len(vertex), bool)  # hot ones of copies
    new[1:] = (vertex[1:] != vertex[:-1]) | (grams[1:] != grams[:-1])
    vertex, size, grams = vertex[new], size[new], grams[new]
    starts = np.flatnonzero(np.concatenate([[True], vertex[1:] != vertex[:-1]]))
    out: list = [[], [], [], [], []]
    for a, b in zip(starts, np.append(starts[1:], len(vertex))):
        n = int(size[a])
        if n - (b - a) >= prefix_length(n, percent):
            continue
        parts = np.bincount((grams[a:b] >> np.uint64(59)).astype(np.int64), minlength=SUFFIX_PARTS)
        for to, x in zip(out, (int(vertex[a:a + 1].view(np.int64)[0]), n, int(b - a),
                               grams[a:b].tobytes(), parts.astype(np.int32))):
            to.append(x)
    return pa.Table.from_arrays(
        [pa.array(x, pa.int64()) for x in out[:3]]
        + [pa.array(out[3], pa.binary()), pa.array(out[4], pa.list_(pa.int32()))],
        ["vertex", "n", "shared", "grams", "parts"])


def ranked_sets(view: DataFrame, marks: DataFrame, words: int = SHINGLE_WORDS,
                percent: int = PERCENT, part_grams: int = PART_GRAMS) -> DataFrame:
    """``vertex, n, shared, grams, parts`` of all vertices that may have a link; staged."""
    docs, total = marks.where("gram is null").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    hot = [r.gram for r in marks.where("gram is not null").groupBy("gram").agg(F.sum("n").alias("n"))
           .where(F.col("n") >= max(64, HOT_SHARE * docs)).select("gram").collect()]
    parts = int(min(MOST_PARTS, max(1, -(-total // part_grams))))
    requests = view.select("text").mapInArrow(
        lambda it: _request_batches(it, words, parts, hot),
        "share int, vertices binary, sizes binary, counts binary, grams binary")
    counted = requests.groupBy("share").applyInArrow(
        lambda rows: _count_share(rows, parts),
        "bundle int, vertices binary, sizes binary, counts binary, grams binary, levels binary")
    return stage(counted.groupBy("bundle").applyInArrow(
        lambda rows: _rank_bundle(rows, percent),
        "vertex long, n long, shared long, grams binary, parts array<int>"), "ranked")


# --- joining --------------------------------------------------------------------------------------

def _prefix_batches(batches, percent: int):
    """A row for every shared n-gram of a prefix: ``gram, vertex, n, place, rare``."""
    import numpy as np
    import pyarrow as pa
    for batch in batches:
        n = batch.column("n").to_numpy()
        rare = n - batch.column("shared").to_numpy()
        take = prefix_length(n, percent) - rare
        grams = [np.frombuffer(g, np.int64, count=int(t))
                 for g, t in zip(batch.column("grams").to_pylist(), take)]
        row = np.repeat(np.arange(len(n)), take)
        place = np.concatenate([np.arange(t) for t in take]) if len(n) else row
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(grams) if grams else np.zeros(0, np.int64)),
             pa.array(batch.column("vertex").to_numpy()[row]), pa.array(n[row]),
             pa.array(place + rare[row]), pa.array(rare[row])],
            ["gram", "vertex", "n", "place", "rare"])


def _verify_batches(batches, percent: int):
    import numpy as np
    import pyarrow as pa
    for batch in batches:
        names = ("a", "b", "na", "nb", "ga", "gb")
        a, b, na, nb, ga, gb = (batch.column(c) for c in names)
        linked = []
        for x, y, n, m in zip(ga.to_pylist(), gb.to_pylist(), na.to_pylist(), nb.to_pylist()):
            common = np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64),
                                    assume_unique=True)
            linked.append(100 * len(common) >= percent * (n + m - len(common)))
        keep = pa.array(linked, pa.bool_())
        yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], ["a", "b"])


def _verified(pairs: DataFrame, ranked: DataFrame, percent: int) -> DataFrame:
    """Linked pairs among distinct pairs (a, b): the suffix filter on the counts of the hash
    parts, then the intersection of the whole sets."""
    sizes = ranked.select("vertex", "n", "parts")
    sets = ranked.select("vertex", "grams")

    def side(df, c):
        return df.select(F.col("vertex").alias(c), F.col("n").alias(f"n{c}"),
                         F.col("parts").alias(f"p{c}"))
    least = F.expr("aggregate(zip_with(pa, pb, (x, y) -> least(x, y)), 0, (s, x) -> s + x)")
    rough = (pairs.join(side(sizes, "a"), "a").join(side(sizes, "b"), "b")
             .where(least >= F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent)))
             .select("a", "b", "na", "nb"))
    return (rough.join(sets.select(F.col("vertex").alias("a"), F.col("grams").alias("ga")), "a")
            .join(sets.select(F.col("vertex").alias("b"), F.col("grams").alias("gb")), "b")
            .select("a", "b", "na", "nb", "ga", "gb")
            .mapInArrow(lambda it: _verify_batches(it, percent), "a long, b long"))


def _length_filter(a, b, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _middle_pairs(posted: DataFrame, percent: int) -> DataFrame:
    """(a, b): every vertex with one other, the one that is the least rare of the most of its
    n-grams."""
    own = F.struct(F.col("rare"), F.col("vertex").alias("b"), F.col("n").alias("nb"))
    middle = posted.groupBy("gram").agg(F.min(own).alias("m"), F.count("*").alias("c")) \
        .where("c > 1").select("gram", "m.b", "m.nb")
    met = (posted.join(middle, "gram").where("vertex != b").where(_length_filter(F.col("n"), F.col("nb"), percent))
           .groupBy("vertex", "b").agg(F.count("*").alias("c")))
    best = met.groupBy("vertex").agg(F.max(F.struct("c", "b")).alias("m"))
    return best.select(F.greatest("vertex", "m.b").alias("a"),
                       F.least("vertex", "m.b").alias("b")).distinct()


def _size_step(n):
    """Number of the step of sizes, a tenth wide, that a size falls in."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(1.1))).cast("int")


def _open_pairs(posted: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """(a, b) in different components that pass the length and positional filter at a common
    n-gram of their prefixes.

    The first common n-gram of a linked pair leaves enough places behind it in both sets. For
    the smaller set that is so in its first places only; the larger one meets the sizes that its
    place allows. Both are dealt by n-gram and step of sizes, groups of one component as a
    whole."""
    over = 100 + percent
    placed = posted.drop("rare").join(
        roots.select(F.col("code").alias("vertex"), "root"), "vertex", "left") \
        .withColumn("root", F.coalesce("root", "vertex"))
    several = placed.groupBy("gram", "root").agg(F.count("*").alias("c")).groupBy("gram") \
        .agg(F.count("*").alias("c")).where("c > 1").select("gram")
    placed = stage(placed.join(several, "gram", "left_semi"), "open")
    n, place = F.col("n"), F.col("place")
    small = (placed.where(place <= n - F.ceil(percent * 2 * n / over))
             .withColumn("step", _size_step(n)))
    most = F.least(n, F.floor(over * (n - place) / percent) - n)
    least = F.ceil(percent * n / 100)
    large = placed.where(most >= least).withColumn(
        "step", F.explode(F.sequence(_size_step(least), _size_step(most))))
    keys = ["gram", "step", "root"]
    meet = (large.select(*keys).distinct()
            .join(small.select("gram", "step", F.col("root").alias("other")).distinct(),
                  ["gram", "step"]).where("root <> other"))
    x = large.join(meet, keys).select("gram", "step", F.col("other").alias("root"),
                                      F.col("vertex").alias("x"), F.col("n").alias("nx"),
                                      F.col("place").alias("px"))
    need = F.ceil(percent * (F.col("nx") + n) / over)
    return (x.join(small, keys)
            .where((n <= F.col("nx")) & _length_filter(F.col("nx"), n, percent)
                   & (F.col("px") <= F.col("nx") - need) & (place <= n - need))
            .select(F.greatest("x", "vertex").alias("a"), F.least("x", "vertex").alias("b"))
            .distinct())


def components(ranked: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(code, root) of all linked vertices, as all pairs of similar sets would connect them."""
    posted = stage(ranked.select("vertex", "n", "shared", "grams").mapInArrow(
        lambda it: _prefix_batches(it, percent),
        "gram long, vertex long, n long, place long, rare long"), "prefixes")
    first = stage(_middle_pairs(posted, percent), "middle-pairs")
    roots = star_components(_verified(first, ranked, percent), "middle-roots")
    rest = _open_pairs(posted, roots, percent).join(first, ["a", "b"], "left_anti")
    more = _verified(stage(rest, "open-pairs"), ranked, percent)
    # what step 2 links are components of step 1: one vertex each

    def named(df, c):
        own = roots.select(F.col("code").alias(c), F.col("root").alias(f"root_{c}"))
        return df.join(own, c, "left").withColumn(c, F.coalesce(f"root_{c}", c)).drop(f"root_{c}")
    joined = star_components(named(named(more, "a"), "b"), "open-roots")
    outer = joined.select(F.col("code").alias("root"), F.col("root").alias("outer"))
    return (roots.join(outer, "root", "left")
            .select("code", F.coalesce("outer", "root").alias("root"))
            .unionByName(joined.join(roots, "code", "left_anti")))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      words: int = SHINGLE_WORDS, percent: int = PERCENT,
                      part_grams: int = PART_GRAMS) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, vertex`` (documents of equal sets share it;
    null for empty sets), ``component_id`` (the smallest id reachable by links)."""
    view = documents_view(docs, id_col, text_col)
    id_type = view.schema["doc_id"].dataType.simpleString()
    marks = stage(view.mapInArrow(lambda it: _mark_batches(it, words),
                                  f"doc_id {id_type}, vertex long, n long, gram long"), "sets")
    roots = components(ranked_sets(view, marks, words, percent, part_grams), percent)
    rows = marks.where("gram is null").drop("gram")
    classes = (rows.where("vertex is not null").groupBy("vertex")
               .agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")))
    rooted = stage(classes.join(roots.withColumnRenamed("code", "vertex"), "vertex", "left").select(
        "vertex", "least", F.coalesce("root", "vertex").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("vertex", "component_id")
    return rows.join(named, "vertex", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "vertex",
        F.when(F.col("vertex").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"))
