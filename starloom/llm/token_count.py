"""Token counts by distinct pre-tokens.

Every distinct pre-token of the corpus is encoded once; documents only
carry (pre-token, frequency) pairs, joined to the counts and summed. Ids are
never materialised.

The most frequent pre-tokens (``HOT`` of them, at most ``HOT_BYTES`` bytes each:
a fixed bound of 16 MB) are summed inside the map tasks; all others go through a
shuffle join. Removing the hot keys also removes the skew of that join, since
what is left is rare by construction. Both ways count every occurrence.

Null texts count as empty (0 bytes, 0 tokens); empty texts and tables give 0
tokens and no rows; repeated rows give one result row each; columns beside id
and text are ignored.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import as_bytes, documents_view, small_batches, stage

HOT = 131_072
HOT_BYTES = 64
DISTINCT_FLUSH = 400_000  # distinct pre-tokens a map task holds before it passes them on
PER_WORKER = 200_000      # entries of a worker's chunk cache

# Fixed value: the pre-tokenizer pattern of the word_bpe_49k.json vocabulary.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Printable Latin-1 only: there lower-casing is one code point to one and NFC
# changes nothing, so the split below is the library's own.
_PLAIN = re.compile(r"[!-~¡-ÿ]+")


@functools.lru_cache(maxsize=1)
def _splitter():
    import regex
    return regex.compile(WORD_PATTERN)


def pre_tokens(chunk: bytes) -> list[str]:
    """Pre-tokens of a chunk without ASCII white space.

    The pattern never crosses white space and normalisation never joins over
    it, so chunks are independent. Chunks with other characters, or with a
    possible special token, stay whole: the library splits them itself.
    """
    s = chunk.decode("utf-8")
    if _PLAIN.fullmatch(s) and "<|" not in s:
        s = s.lower()
        return [s] if s.isalpha() else _splitter().findall(s)
    return [s]


class _Cache(dict):
    """chunk -> value, cleared when full."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= PER_WORKER:
            self.clear()
        value = self[key] = self.make(key)
        return value


def _distinct_in_tasks(batches):
    import pyarrow as pa
    from collections import Counter
    chunks: Counter = Counter()

    def flush():
        pieces: Counter = Counter()
        for chunk, n in chunks.items():
            for p in pre_tokens(chunk):
                pieces[p] += n
        chunks.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(list(pieces), pa.string()), pa.array(list(pieces.values()), pa.int64())],
            ["piece", "freq"])
    for batch in small_batches(batches):
        for text in as_bytes(batch.column("text")):
            if text:
                chunks.update(text.split())
                if len(chunks) >= DISTINCT_FLUSH:
                    yield flush()
    if chunks:
        yield flush()


def _count_pieces(batches, path: str):
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import pyarrow as pa
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    for batch in small_batches(batches):
        pieces = batch.column("piece").to_pylist()
        counts = [len(e.ids) for e in tok.encode_batch_fast(pieces, add_special_tokens=False)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("piece"), batch.column("freq"), pa.array(counts, pa.int64())],
            ["piece", "freq", "n_tokens"])


def _sum_hot(batches, hot: dict):
    """Per document: bytes, tokens of hot pre-tokens, and the rest as pairs."""
    import pyarrow as pa
    from collections import Counter

    def split(chunk):
        known, rest = 0, []
        for p in pre_tokens(chunk):
            n = hot.get(p)
            if n is None:
                rest.append(p)
            else:
                known += n
        return known, rest
    cache = _Cache(split)
    pair = pa.struct([("piece", pa.string()), ("n", pa.int64())])
    for batch in small_batches(batches):
        n_bytes, tokens, offsets, names, freqs = [], [], [0], [], []
        for text in as_bytes(batch.column("text")):
            total, rare = 0, Counter()
            if text:
                for chunk, n in Counter(text.split()).items():
                    known, rest = cache[chunk]
                    total += known * n
                    for p in rest:
                        rare[p] += n
            n_bytes.append(len(text or b""))
            tokens.append(total)
            names.extend(rare)
            freqs.extend(rare.values())
            offsets.append(len(names))
        rest = pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()),
            pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(freqs, pa.int64())],
                                       fields=list(pair)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(tokens, pa.int64()),
             rest], ["doc_id", "n_bytes", "hot_tokens", "rest"])


def most_frequent(pieces: DataFrame) -> DataFrame:
    """At most ``HOT`` of the most frequent pre-tokens, as whole classes of
    frequency (steps of a 16th of an octave): a cut by class sends the driver no
    more rows than it keeps, whatever the number of tasks."""
    short = pieces.where(F.octet_length("piece") <= HOT_BYTES).withColumn(
        "class", F.floor(F.log2("freq") * 16).cast("int"))
    total, least = 0, None
    for r in short.groupBy("class").count().orderBy(F.desc("class")).collect():
        total += r["count"]
        if total > HOT:
            break
        least = r["class"]
    return short.where(F.lit(False) if least is None else F.col("class") >= least).select(
        "piece", "n_tokens")


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens``."""
    view = documents_view(docs, id_col, text_col)
    texts = view.select("text")
    pieces = (texts.mapInArrow(_distinct_in_tasks, "piece string, freq long")
              .groupBy("piece").agg(F.sum("freq").alias("freq"))
              .mapInArrow(lambda it: _count_pieces(it, tokenizer_path),
                          "piece string, freq long, n_tokens long"))
    pieces = stage(pieces, "pieces")
    hot = {r.piece: r.n_tokens for r in most_frequent(pieces).collect()}
    id_type = view.schema["doc_id"].dataType.simpleString()
    counted = stage(
        view.mapInArrow(lambda it: _sum_hot(it, hot),
                        f"doc_id {id_type}, n_bytes long, hot_tokens long, "
                        "rest array<struct<piece:string,n:long>>")
        .withColumn("row", F.monotonically_increasing_id()), "counted")
    rest = (counted.where(F.size("rest") > 0)
            .select("row", F.explode("rest").alias("r")).select("row", "r.piece", "r.n"))
    rare = (rest.join(pieces.select("piece", "n_tokens"), "piece")
            .groupBy("row").agg(F.sum(F.col("n") * F.col("n_tokens")).alias("rest_tokens")))
    return (counted.drop("rest").join(rare, "row", "left")
            .select("doc_id", "n_bytes",
                    (F.col("hot_tokens") + F.coalesce("rest_tokens", F.lit(0))).alias("n_tokens")))
