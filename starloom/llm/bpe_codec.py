"""Byte-level BPE encoding and decoding with tree concatenation.

Text is cut into pre-tokens. Short ones are encoded as they are. A pre-token of
more than ``leaf_bytes`` is long unsplit text: it is halved down to leaves that
Spark encodes in parallel tasks, and neighbours are joined pairwise up the tree.
A join re-encodes a window around the seam and doubles it until its first and
last token equal those of both sides. A token sequence is the BPE encoding of
its text exactly if each adjacent pair of tokens is the encoding of the pair's
text; with equal outer tokens every pair of the joined sequence lies within one
of three valid encodings, so the result is exact.

Null texts count as empty (no ids, decoded ""); repeated rows give one result
each; empty tables give no rows; columns beside id and text are ignored.
"""

from __future__ import annotations

import functools
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import documents_view, small_batches, stage

LEAF_BYTES = 16_384

# Fixed value: the pre-tokenizer pattern of byte-level BPE vocabularies of this kind.
BYTE_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_alphabet() -> dict[int, str]:
    """Byte -> printable character of byte-level vocabularies: printable
    Latin-1 stands for itself, all others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def byte_encoding(path: str):
    """(encoding, special tokens) of a byte-level tokenizer file."""
    import tiktoken
    with open(path, encoding="utf-8") as fh:
        spec = json.load(fh)
    vocab = spec["model"]["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    order = [vocab[a + b] for a, b in pairs]
    if order != sorted(order):
        raise ValueError("ids of the vocabulary must follow its merges")
    byte_of = {c: b for b, c in byte_alphabet().items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in special}
    return tiktoken.Encoding("own", pat_str=BYTE_PATTERN, mergeable_ranks=ranks,
                             special_tokens=special), special


class Codec:
    """Encoder and decoder over one tokenizer file."""

    def __init__(self, path: str):
        self.path = path
        self.fast, self.special = byte_encoding(path)
        self.char_of = byte_alphabet()
        self.special_re = re.compile("|".join(
            re.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")

    # only long unsplit text needs the following
    @functools.cached_property
    def model(self):
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.path).model

    @functools.cached_property
    def names(self) -> dict[int, str]:
        with open(self.path, encoding="utf-8") as fh:
            return {i: t for t, i in json.load(fh)["model"]["vocab"].items()}

    @functools.cached_property
    def pattern(self):
        import regex
        return regex.compile(BYTE_PATTERN)

    def encode(self, text: str):
        """Ids of a text without long pre-tokens, as a numpy array."""
        import numpy as np
        if not self.special_re.search(text):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.concatenate([np.empty(0, np.uint32)] + [
            np.array([self.special[p]], np.uint32) if p in self.special
            else self.fast.encode_to_numpy(p, disallowed_special=())
            for p in self._cut_special(text)])

    def _cut_special(self, text: str) -> list[str]:
        at, out = 0, []
        for m in self.special_re.finditer(text):
            out += [text[at:m.start()], m.group()]
            at = m.end()
        return [p for p in out + [text[at:]] if p]

    def pieces(self, text: str) -> list[tuple[int, str]]:
        """(special id or -1, pre-token) of a whole text."""
        out = []
        for part in self._cut_special(text):
            if part in self.special:
                out.append((self.special[part], part))
            else:
                out += [(-1, p) for p in self.pattern.findall(part)]
        return out

    def mapped(self, data: bytes) -> str:
        return "".join(map(self.char_of.__getitem__, data))

    def encode_bytes(self, data: bytes) -> list[int]:
        """Ids of one pre-token (or any part of one), without splitting it."""
        return [t.id for t in self.model.tokenize(self.mapped(data))]

    def join(self, a: list[int], b: list[int]) -> list[int]:
        """Encoding of the joined text from the encodings of both parts."""
        if not a or not b:
            return a + b
        width = 2
        while True:
            i, j = max(0, len(a) - width), min(len(b), width)
            text = "".join(self.names[t] for t in a[i:] + b[:j])
            ids = [t.id for t in self.model.tokenize(text)]
            if (i == 0 or ids[0] == a[i]) and (j == len(b) or ids[-1] == b[j - 1]):
                return a[:i] + ids + b[j:]
            width *= 2

    def join_tree(self, parts: list[list[int]]) -> list[int]:
        while len(parts) > 1:
            parts = [self.join(parts[i], parts[i + 1]) if i + 1 < len(parts) else parts[i]
                     for i in range(0, len(parts), 2)]
        return parts[0] if parts else []

    def decode(self, ids) -> str:
        return self.fast.decode_bytes(list(ids)).decode("utf-8", errors="replace")


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def halves(data: bytes, leaf_bytes: int) -> list[bytes]:
    """Leaves of a binary tree over ``data``, none above ``leaf_bytes``."""
    parts = [data]
    while len(parts[0]) > leaf_bytes:
        parts = [h for p in parts for h in (p[:(len(p) + 1) // 2], p[(len(p) + 1) // 2:])]
    return parts


def _encode_short(batches, path: str):
    import numpy as np
    import pyarrow as pa
    c = codec(path)
    for batch in small_batches(batches):
        ids, decoded = [], []
        for text in batch.column("text").to_pylist():
            ids.append(c.encode(text or "").astype(np.int32, copy=False))
            decoded.append(c.decode(ids[-1].tolist()))
        offsets = np.zeros(len(ids) + 1, np.int32)
        np.cumsum([len(x) for x in ids], out=offsets[1:])
        values = np.concatenate(ids) if ids else np.empty(0, np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.ListArray.from_arrays(offsets, values),
             pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])


def _cut_long(batches, path: str, leaf_bytes: int):
    """Rows of work: (row, no, leaf, fixed, parts). A run of short pre-tokens
    is one row; each leaf of a long pre-token is a row of its own."""
    import pyarrow as pa
    c = codec(path)
    for batch in small_batches(batches):
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
            out, run, size = [], [], 0

            def close():
                nonlocal run, size
                if run:
                    out.append((-1, run))
                run, size = [], 0
            for special, piece in c.pieces(text):
                data = piece.encode("utf-8")
                if special < 0 and len(data) > leaf_bytes:
                    close()
                    out += [(k, [h]) for k, h in enumerate(halves(data, leaf_bytes))]
                else:
                    run.append(data)
                    size += len(data)
                    if size > 4 * leaf_bytes:
                        close()
            close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([row] * len(out), pa.int64()), pa.array(range(len(out)), pa.int32()),
                 pa.array([k for k, _ in out], pa.int32()),
                 pa.array([p for _, p in out], pa.list_(pa.binary()))],
                ["row", "no", "leaf", "parts"])


def _encode_parts(batches, path: str):
    import pyarrow as pa
    c = codec(path)
    for batch in small_batches(batches):
        ids = []
        for leaf, parts in zip(batch.column("leaf").to_pylist(), batch.column("parts").to_pylist()):
            got: list[int] = []
            for p in parts:
                known = c.special.get(p.decode("utf-8")) if leaf < 0 else None
                got += [known] if known is not None else c.encode_bytes(p)
            ids.append(got)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("no"), batch.column("leaf"),
             pa.array(ids, pa.list_(pa.int32()))], ["row", "no", "leaf", "ids"])


def _join_document(pdf, path: str):
    import pandas as pd
    c = codec(path)
    out: list[int] = []
    tree: list[list[int]] = []
    pdf = pdf.sort_values("no")
    for leaf, ids in zip(pdf["leaf"], pdf["ids"]):
        if leaf <= 0 and tree:  # a new piece begins
            out += c.join_tree(tree)
            tree = []
        if leaf < 0:
            out += list(map(int, ids))
        else:
            tree.append(list(map(int, ids)))
    out += c.join_tree(tree)
    return pd.DataFrame({"row": [pdf["row"].iloc[0]], "ids": [out], "decoded": [c.decode(out)]})


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                  text_col: str = "text", leaf_bytes: int = LEAF_BYTES) -> DataFrame:
    """One row per document: ``doc_id, ids array<int>, decoded string``."""
    view = documents_view(docs, id_col, text_col)
    id_type = view.schema["doc_id"].dataType.simpleString()
    # a pre-token above the limit needs a run of as many bytes (a quarter in
    # code points) with or without white space; others have no long pre-token
    least = max(1, leaf_bytes // 4)
    long = ((F.octet_length("text") > leaf_bytes)
            & F.col("text").rlike(rf"\S{{{least}}}|[\s\x1c-\x1f\x85\p{{Z}}]{{{least}}}"))
    long = F.coalesce(long, F.lit(False))
    short = view.where(~long).mapInArrow(
        lambda it: _encode_short(it, tokenizer_path),
        f"doc_id {id_type}, ids array<int>, decoded string")
    rows = stage(view.where(long).withColumn("row", F.monotonically_increasing_id()), "unsplit")
    joined = (rows.select("row", "text")
              .mapInArrow(lambda it: _cut_long(it, tokenizer_path, leaf_bytes),
                          "row long, no int, leaf int, parts array<binary>")
              .repartition("row", "no")
              .mapInArrow(lambda it: _encode_parts(it, tokenizer_path),
                          "row long, no int, leaf int, ids array<int>")
              .groupBy("row").applyInPandas(lambda pdf: _join_document(pdf, tokenizer_path),
                                            "row long, ids array<int>, decoded string"))
    return short.unionByName(rows.select("row", "doc_id").join(joined, "row").drop("row"))


def token_digests(encoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of :func:`encode_decode` rows."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
