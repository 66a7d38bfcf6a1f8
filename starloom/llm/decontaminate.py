"""Benchmark decontamination by winnowing.

A window is ``WINDOW`` consecutive words of an item; an item of fewer words is
one window. Of the k-gram hashes inside a window the smallest is its
fingerprint, so neighbouring windows mostly share one, and equal windows have
equal fingerprints wherever they stand: every shared span of a window or more is
found. Fingerprints of documents are joined to those of the benchmark and each
hit is extended to the windows that it stands for, compared word by word. Windows
of short items have their whole hash as fingerprint.

Before the join, document fingerprints pass a bit table of fixed size (2 ** BITS
bits, whatever the size of the benchmark); it never drops a fingerprint of the
benchmark.

Null and empty texts have no words, no hits and are not contaminated; null or
empty items have no windows; repeated rows give one result each, repeated items
count once per item_id; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import as_bytes, documents_view, small_batches, stage

WINDOW = 13
KGRAM = 8              # with 13 - 8 + 1 = 6 k-grams in a window
BITS = 22
LEAST_SHARE = 20       # contaminated if n_hit * LEAST_SHARE >= n_words
CHUNK_WORDS = 200_000
CACHE = 100_000        # words whose hash a worker remembers

# After this a text's words are its runs without spaces: A-Z become a-z, other
# ASCII than digits and letters becomes a space, all else belongs to words.
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127
               else 32 for b in range(256))


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(_CLEAN).split()


class _Hashes(dict):
    def __missing__(self, word):
        import xxhash
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def gram_hashes(hashes, n: int):
    """Mixed hashes of all runs of ``n`` word hashes."""
    import numpy as np
    size = max(0, len(hashes) - n + 1)
    out = np.full(size, n, np.uint64)
    for j in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + size]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def window_marks(hashes, n: int):
    """Fingerprint of the window of ``n`` words at every place: the smallest
    k-gram hash in it."""
    import numpy as np
    if n < WINDOW:
        return gram_hashes(hashes, n)
    grams = gram_hashes(hashes, KGRAM)
    size = max(0, len(hashes) - n + 1)
    marks = grams[:size]
    for j in range(1, WINDOW - KGRAM + 1):
        marks = np.minimum(marks, grams[j:j + size])
    return marks


def _item_windows(batches):
    """Every window of every item: (item_id, mark, n, gram)."""
    import numpy as np
    import pyarrow as pa
    cache = _Hashes()
    for batch in small_batches(batches):
        out = []
        for item, raw in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))):
            words = words_of(raw)
            if not words:
                continue
            n = min(WINDOW, len(words))
            marks = window_marks(np.array([cache[w] for w in words], np.uint64), n)
            grams = {b" ".join(words[i:i + n]): m for i, m in enumerate(marks.view(np.int64))}
            out += [(item, int(m), n, g) for g, m in grams.items()]
        cols = list(zip(*out)) if out else [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], batch.column("doc_id").type), pa.array(cols[1], pa.int64()),
             pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.binary())],
            ["item_id", "mark", "n", "gram"])


def _document_windows(batches, lengths: list[int], table: bytes):
    """Per document: number of words and the windows whose fingerprint may be
    one of the benchmark's, each with its places."""
    import numpy as np
    import pyarrow as pa
    bits = np.unpackbits(np.frombuffer(table, np.uint8)).astype(bool)
    mask = np.uint64(len(bits) - 1)
    cache = _Hashes()
    kind = pa.list_(pa.struct([("mark", pa.int64()), ("n", pa.int32()), ("gram", pa.binary()),
                               ("at", pa.list_(pa.int32()))]))

    def look(raws, counts, hashes):
        found = [{} for _ in raws]
        all_hashes = np.array(hashes, np.uint64)
        owner = np.repeat(np.arange(len(raws)), counts)
        first = np.concatenate([[0], np.cumsum(counts)])
        split: dict = {}
        for n in lengths:
            marks = window_marks(all_hashes, n)
            if not len(marks):
                continue
            near = bits[marks & mask] & (owner[:len(marks)] == owner[n - 1:])
            for i in np.flatnonzero(near):
                d = int(owner[i])
                if d not in split:
                    split = {d: words_of(raws[d])}  # places come in document order
                at = int(i - first[d])
                gram = b" ".join(split[d][at:at + n])
                entry = found[d].setdefault(gram, {"mark": int(marks[i].view(np.int64)), "n": n,
                                                   "gram": gram, "at": []})
                entry["at"].append(at)
        return [list(f.values()) for f in found]
    for batch in small_batches(batches):
        n_words, found = [], []
        raws, counts, hashes = [], [], []
        for raw in as_bytes(batch.column("text")):
            words = words_of(raw)
            n_words.append(len(words))
            raws.append(raw)
            counts.append(len(words))
            hashes.extend(map(cache.__getitem__, words))
            if len(hashes) >= CHUNK_WORDS:
                found += look(raws, counts, hashes)
                raws, counts, hashes = [], [], []
        if raws:
            found += look(raws, counts, hashes)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(n_words, pa.int64()),
             pa.array(found, kind)], ["doc_id", "text_hash", "n_words", "found"])


def _bit_table(marks: DataFrame) -> bytes:
    """Bit table of the fingerprints; at most 2 ** BITS places reach the driver."""
    import numpy as np
    bits = np.zeros(1 << BITS, np.uint8)
    places = marks.select(F.col("mark").bitwiseAND(F.lit((1 << BITS) - 1)).cast("int").alias("p"))
    for r in places.distinct().toLocalIterator():
        bits[r.p] = 1
    return np.packbits(bits).tobytes()


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
                  ) -> DataFrame:
    """One row per document: ``doc_id, text_hash, n_words, n_hit, items`` (item ids
    with occurring windows, sorted as strings) and ``contaminated``."""
    items = documents_view(benchmark, item_col, item_text_col)
    item_type = items.schema["doc_id"].dataType.simpleString()
    windows = stage(items.mapInArrow(
        _item_windows, f"item_id {item_type}, mark long, n int, gram binary"), "windows")
    lengths = [r.n for r in windows.select("n").distinct().orderBy("n").collect()]
    bits = _bit_table(windows)
    view = documents_view(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    id_type = view.schema["doc_id"].dataType.simpleString()
    looked = stage(view.mapInArrow(
        lambda it: _document_windows(it, lengths, bits),
        f"doc_id {id_type}, text_hash long, n_words long, "
        "found array<struct<mark:long,n:int,gram:binary,at:array<int>>>")
        .withColumn("row", F.monotonically_increasing_id()), "looked")
    found = (looked.where(F.size("found") > 0).select("row", F.explode("found").alias("f"))
             .select("row", "f.mark", "f.n", "f.gram", "f.at"))
    # join on the fingerprint; the equal gram extends the hit to a whole window
    hits = stage(found.join(windows.select("mark", "gram").distinct(), ["mark", "gram"]), "hits")
    spans = hits.select("row", F.explode("at").alias("b"), "n").select(
        "row", "b", (F.col("b") + F.col("n")).alias("e"))
    before = Window.partitionBy("row").orderBy("b", "e").rowsBetween(
        Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col("e") - F.greatest("b", F.coalesce(F.max("e").over(before),
                                                                       F.lit(0))))
    n_hit = (spans.withColumn("new", new).groupBy("row")
             .agg(F.sum("new").cast("long").alias("n_hit")))
    items_of = (hits.select("row", "mark", "gram")
                .join(windows.select("mark", "gram", "item_id"), ["mark", "gram"])
                .select("row", F.col("item_id").cast("string").alias("item")).distinct()
                .groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items")))
    share = F.col("n_hit") * LEAST_SHARE >= F.col("n_words")
    return (looked.drop("found").join(n_hit, "row", "left").join(items_of, "row", "left")
            .withColumns({"n_hit": F.coalesce("n_hit", F.lit(0)),
                          "items": F.coalesce("items", F.array().cast("array<string>"))})
            .withColumn("contaminated", (F.col("n_hit") > 0) & share).drop("row"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (columns ``doc_id`` and ``text`` among them) without contaminated
    rows; columns stay as they are."""
    bad = stage(contamination(docs, benchmark).where("contaminated")
                .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
                .distinct(), "contaminated")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"])
                     & (F.xxhash64(docs["text"]) == bad["_hash"]), "left_anti")
