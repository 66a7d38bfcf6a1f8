"""Collocations: frequent phrases scored by their weakest cut, per language.

Rabin-Karp: prefix polynomials over word hashes give the fingerprint of every n-gram of
a slice of texts at once. Two shuffles add up fingerprints (one and two words, then
three to five whose pairs of words are all frequent), each task owning a share of
them; what comes back is one bit table of fixed size that says which fingerprints may
be frequent. In the last pass a task keeps, for each such fingerprint of a slice,
its count and a pointer to one occurrence, checks all other occurrences of the slice
against the text there (words byte by byte, n-grams word by word; what differs is counted
by its own words) and only then makes the phrase. Counts are added up by phrase, so
neither collisions of fingerprints nor the bit table's size change a result.

A null text is empty, a null language ``und``. Repeated rows count each time. Texts
without frequent phrases and empty tables give no rows; fewer than ``top`` candidates are
all returned. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm import ngrams
from starloom.llm.common import stage

MOST_WORDS = 5
MIN_COUNT = 100
TOP = 2000
BLANKS, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
TABLE_BITS = 25       # the bit table takes 2^25 bits (4 MB), whatever the input
SHARE_GRAMS = 4_000_000
MOST_SHARE_BITS = 16
FLUSH_GRAMS = 4_000_000
FLUSH_PHRASES = 200_000
RANK_ROWS = 100_000


# --- fingerprints ----------------------------------------------------------------------------

def _slice_words(part, texts):
    """Words of a slice with ``seed``, a hash of each word's language."""
    import numpy as np
    import xxhash
    words = ngrams.joined(texts, ngrams.byte_kinds(BLANKS, BREAKS))
    seeds = np.array([xxhash.xxh64_intdigest(x) for x in part.column("lang").to_pylist()], np.uint64)
    words.seed = seeds[words.doc]
    return words


def _prints(words, n: int, at):
    return ngrams.mixed(words.grams(n, at) ^ words.seed[at])


class Table:
    """Which fingerprints may be frequent: two bits each, in the segment of their share."""

    def __init__(self, octets, share_bits: int):
        self.octets, self.share_bits = octets, share_bits

    @staticmethod
    def places(low, share_bits: int):
        """Both bit places within a share's segment of fingerprints' 32 bits behind the share."""
        import numpy as np
        width = np.uint32(TABLE_BITS - share_bits)
        return low >> (np.uint32(32) - width), low & ((np.uint32(1) << width) - np.uint32(1))

    def has(self, prints):
        import numpy as np
        base = share_of(prints, self.share_bits) << (TABLE_BITS - self.share_bits)
        found = np.ones(len(prints), bool)
        for place in self.places(low_bits(prints, self.share_bits), self.share_bits):
            bit = base + place.astype(np.int64)
            found &= self.octets[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1
        return found


def share_of(prints, share_bits: int):
    """Share of every fingerprint: its first bits."""
    import numpy as np
    if not share_bits:
        return np.zeros(len(prints), np.int64)
    return (prints >> np.uint64(64 - share_bits)).astype(np.int64)


def low_bits(prints, share_bits: int):
    """The 32 bits behind the share."""
    import numpy as np
    return (prints >> np.uint64(32 - share_bits)).astype(np.uint32)


def _grams(words, sizes, table: Table | None):
    """Fingerprints of all n-grams of ``sizes``; with a table only those whose pairs
    of neighbouring words are all in it."""
    import numpy as np
    pair = None
    if table is not None:
        pair = np.zeros(len(words) + 1, bool)
        at = words.places(2)
        pair[at] = table.has(_prints(words, 2, at))
    for n in sizes:
        at = words.places(n)
        if pair is not None:
            at = at[np.logical_and.reduce([pair[at + j] for j in range(n - 1)])]
        yield _prints(words, n, at)


def _count_batches(batches, sizes, share_bits: int, table: Table | None):
    """Rows (share, fingerprints' low bits, counts, counts from 255 on)."""
    import numpy as np
    import pyarrow as pa

    def flush(held):
        prints, counts = np.unique(np.concatenate(held) >> np.uint64(32 - share_bits),
                                   return_counts=True)
        prints = prints << np.uint64(32 - share_bits)
        share, low = share_of(prints, share_bits), low_bits(prints, share_bits)
        cuts = np.flatnonzero(np.concatenate([[True], share[1:] != share[:-1]])) \
            if len(share) else []
        rows: list = [[], [], [], []]
        for a, b in zip(cuts, [*cuts[1:], len(share)]):
            c = counts[a:b]
            for to, x in zip(rows, (int(share[a]), low[a:b].tobytes(),
                                    np.minimum(c, 255).astype(np.uint8).tobytes(),
                                    c[c >= 255].astype(np.int64).tobytes())):
                to.append(x)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.int32())] + [pa.array(r, pa.binary()) for r in rows[1:]],
            ["share", "prints", "counts", "large"])

    held, size = [], 0
    for part, texts in ngrams.text_slices(batches):
        for prints in _grams(_slice_words(part, texts), sizes, table):
            held.append(prints)
            size += len(prints)
        if size >= FLUSH_GRAMS:
            yield flush(held)
            held, size = [], 0
    if size:
        yield flush(held)


def _share_segment(rows, share_bits: int, min_count: int):
    """The bit table's segment for one share."""
    import numpy as np
    import pyarrow as pa

    def whole(name, kind):
        return np.concatenate([np.frombuffer(b, kind) for b in rows.column(name).to_pylist()])
    low, small = whole("prints", np.uint32), whole("counts", np.uint8)
    counts = small.astype(np.int64)
    counts[small == 255] = whole("large", np.int64)
    order = np.argsort(low)
    low, counts = low[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    often = low[starts[np.add.reduceat(counts, starts) >= min_count]]
    bits = np.zeros(1 << max(3, TABLE_BITS - share_bits), bool)
    for place in Table.places(often, share_bits):
        bits[place] = True
    return pa.table({"share": rows.column("share").slice(0, 1),
                     "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})


def _frequent(view: DataFrame, sizes, share_bits: int, min_count: int, table: Table | None) -> Table:
    """Bit table of the fingerprints of n-grams of ``sizes`` found ``min_count`` times, joined to
    ``table``. The driver sees 2^TABLE_BITS bits."""
    import numpy as np
    counted = view.mapInArrow(lambda it: _count_batches(it, sizes, share_bits, table),
                              "share int, prints binary, counts binary, large binary")
    segments = counted.groupBy("share").applyInArrow(
        lambda rows: _share_segment(rows, share_bits, min_count), "share int, bits binary")
    octets = np.zeros(1 << (TABLE_BITS - 3), np.uint8) if table is None else table.octets.copy()
    size = len(octets) >> share_bits
    for r in segments.collect():
        octets[r.share * size:(r.share + 1) * size] |= np.frombuffer(r.bits, np.uint8)
    return Table(octets, share_bits)


# --- phrases -----------------------------------------------------------------------------------

def _word_ids(words):
    """A number for every word such that equal numbers mean equal bytes."""
    import numpy as np
    _, first, ids = np.unique(words.hash, return_index=True, return_inverse=True)
    data = np.frombuffer(words.raw, np.uint8)
    start, length = words.start, words.end - words.start
    same = length == length[first[ids]]
    check = np.flatnonzero(same & (first[ids] != np.arange(len(ids))))
    sizes = length[check]
    for a, b in _blocks(sizes, 1 << 20):  # every byte beside the first occurrence's
        part, n = check[a:b], sizes[a:b]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        equal = (data[np.repeat(start[part], n) + inside]
                 == data[np.repeat(start[first[ids[part]]], n) + inside])
        wrong = np.flatnonzero(~equal)
        same[part[np.unique(np.searchsorted(np.cumsum(n), wrong, side="right"))]] = False
    own: dict = {}
    for i in np.flatnonzero(~same):  # a collision: numbered by its bytes
        ids[i] = own.setdefault(words.raw[words.start[i]:words.end[i]], len(first) + len(own))
    return ids


def _blocks(sizes, most: int):
    """Ranges of rows of about ``most`` bytes together."""
    import numpy as np
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most)))
        yield at, to
        at = to


def _slice_phrases(words, most_words: int, table: Table):
    """(first word, n, count) of the frequent n-grams of a slice, checked against the text."""
    import numpy as np
    if not len(words):
        return
    ids = _word_ids(words)
    before = None
    for n in range(1, most_words + 1):
        at = words.places(n)
        if before is not None:
            at = at[before[at] & before[at + 1]]
        prints = _prints(words, n, at)
        known = table.has(prints)
        at, prints = at[known], prints[known]
        before = np.zeros(len(words) + 1, bool)
        before[at] = True
        _, first, group, counts = np.unique(prints, return_index=True, return_inverse=True,
                                            return_counts=True)
        same = np.ones(len(at), bool)
        for j in range(n):
            same &= ids[at + j] == ids[at[first[group]] + j]
        same &= words.seed[at] == words.seed[at[first[group]]]
        other = np.flatnonzero(~same)
        if len(other):
            counts = counts - np.bincount(group[other], minlength=len(counts))
            own: dict = {}
            for i in at[other]:
                key = (int(words.seed[i]), *ids[i:i + n])
                own.setdefault(key, [int(i), 0])[1] += 1
            for i, c in own.values():
                yield i, n, c
        for i, c in zip(at[first].tolist(), counts.tolist()):
            yield i, n, c


COUNTS = "lang string, size int, phrase string, f long"


def _phrase_counts(batches, most_words: int, table: Table):
    """Counts of (lang, size, phrase) in bounded dictionaries; size 0: all words of the language."""
    import numpy as np
    found: dict = {}
    for part, texts in ngrams.text_slices(batches):
        words = _slice_words(part, texts)
        langs, raw = part.column("lang").to_pylist(), words.raw
        start, end = words.start.tolist(), words.end.tolist()
        per_doc = np.bincount(words.doc, minlength=len(texts)).tolist()
        for lang, c in zip(langs, per_doc):
            if c:
                found[lang, 0, b""] = found.get((lang, 0, b""), 0) + c
        doc = words.doc.tolist()
        for i, n, c in _slice_phrases(words, most_words, table):
            text = raw[start[i]:end[i]] if n == 1 else \
                b" ".join([raw[start[j]:end[j]] for j in range(i, i + n)])
            key = (langs[doc[i]], n, text)
            found[key] = found.get(key, 0) + c
        if len(found) >= FLUSH_PHRASES:
            yield found
            found = {}
    if found:
        yield found


def _packed_batches(batches, most_words: int, table: Table):
    """The counts as tables, one row per share of the phrases' hashes."""
    import numpy as np
    import pyarrow as pa
    import xxhash
    shares = 1 << table.share_bits
    for found in _phrase_counts(batches, most_words, table):
        keys = list(found)
        columns = pa.table({
            "lang": pa.array([k[0] for k in keys], pa.string()),
            "size": pa.array([k[1] for k in keys], pa.int32()),
            "phrase": pa.array([k[2] for k in keys], pa.binary()).cast(pa.string()),
            "f": pa.array([found[k] for k in keys], pa.int64())})
        share = np.array([xxhash.xxh64_intdigest(k[2]) % shares for k in keys])
        columns = columns.take(pa.array(np.argsort(share, kind="stable")))
        own, counts = np.unique(share, return_counts=True)
        blobs, at = [], 0
        for n in counts.tolist():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, columns.schema) as out:
                out.write_table(columns.slice(at, n))
            blobs.append(sink.getvalue().to_pybytes())
            at += n
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(blobs, pa.binary())],
                                         ["share", "counts"])


def _summed_share(rows, min_count: int):
    """Counts of one share over all tasks, of frequent phrases and of languages."""
    import pyarrow as pa
    import pyarrow.compute as pc
    parts = [pa.ipc.open_stream(b).read_all() for b in rows.column("counts").to_pylist()]
    summed = pa.concat_tables(parts).group_by(["lang", "size", "phrase"]).aggregate([("f", "sum")])
    keep = pc.or_(pc.greater_equal(summed.column("f_sum"), min_count),
                  pc.equal(summed.column("size"), 0))
    summed = summed.filter(keep)
    return pa.table({c: summed.column(f"{c}_sum" if c == "f" else c)
                     for c in ("lang", "size", "phrase", "f")})


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  min_count: int = MIN_COUNT, most_words: int = MOST_WORDS) -> DataFrame:
    """``lang, size, phrase, f`` of all phrases found ``min_count`` times, and per language a
    row of size 0 with the number of its words; staged."""
    view = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    size = view.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shares = max(1, size // 3 // SHARE_GRAMS)  # a word takes six bytes, about
    share_bits = min(MOST_SHARE_BITS, (shares - 1).bit_length())
    table = _frequent(view, (1, 2), share_bits, min_count, None)
    if most_words > 2:
        table = _frequent(view, range(3, most_words + 1), share_bits, min_count, table)
    packed = view.mapInArrow(lambda it: _packed_batches(it, most_words, table),
                             "share int, counts binary")
    return stage(packed.groupBy("share").applyInArrow(
        lambda rows: _summed_share(rows, min_count), COUNTS), "phrases")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                 min_count: int = MIN_COUNT, most_words: int = MOST_WORDS, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    ``score`` is the lowest floor(1000 a n / (l r)) over the cuts of a phrase; phrases inside a
    longer candidate that is as frequent are dropped."""
    counts = phrase_counts(docs, text_col, lang_col, min_count, most_words)
    phrases = counts.where("size > 0")
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    candidates = phrases.where("size > 1").withColumn("w", F.split("phrase", " "))
    parts = phrases.where(F.col("size") < most_words).select("lang", "phrase", "f")
    cuts = (candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
            .select("lang", "phrase", F.col("f").alias("a"), "k",
                    F.concat_ws(" ", F.expr("slice(w, 1, k)")).alias("head"),
                    F.concat_ws(" ", F.expr("slice(w, k + 1, size - k)")).alias("tail")))
    for part, count in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(part), F.col("f").alias(count)),
                         ["lang", part])
    scored = cuts.join(totals, "lang").withColumn("score", F.expr(
        "(cast(a as decimal(19,0)) * cast(n as decimal(19,0)) * 1000BD)"
        " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = candidates.where("size > 2").select(
        "lang", "f", "w", "size", F.explode(F.expr("sequence(2, size - 1)")).alias("m"))
    inner = (inner.select("*", F.explode(F.expr("sequence(1, size - m + 1)")).alias("at"))
             .select("lang", F.concat_ws(" ", F.expr("slice(w, at, m)")).alias("phrase"), "f")
             .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = (weakest.join(inner, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
    return _first_of_each(stage(kept, "scored"), top)


def _first_of_each(scored: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of every language with their rank; a language of many rows is first
    cut to that many in parts of it."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    parts = -(-scored.count() // RANK_ROWS)
    levels = []
    while parts > 1:
        levels.append(parts)
        parts = parts * 2 * top // RANK_ROWS
    for n in levels:
        part = F.pmod(F.xxhash64("phrase"), F.lit(n))
        scored = (scored.withColumn("part", part).withColumn("rank", F.row_number().over(
            Window.partitionBy("lang", "part").orderBy(*order)))
            .where(F.col("rank") <= top).drop("part", "rank"))
    ranked = scored.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
