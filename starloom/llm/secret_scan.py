"""Secret scan: base patterns plus a token-efficiency test.

A tokenizer vocabulary spells ordinary words with few tokens, but random strings
with many: characters per token fall. Candidates are runs of key-like characters;
those at or below ``max_ratio`` characters per token are reported as ``random``,
unless they are a known digest (hex of a usual digest length) or a known
identifier (UUID, date or number, e-mail, a run of few different
characters). Words, paths and file names pass by their ratio, whatever their case.
Base spans always stay. Spans are code point offsets, end exclusive; a random span
that base spans cover wholly is not reported again.

Null texts count as empty. Empty texts and tables, repeated rows and very
long texts need no special case; columns beside id and text are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.bpe_codec import byte_encoding
from starloom.llm.common import documents_view, small_batches

# The base patterns and the order of their kinds.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
# ends of the base patterns' key words, in lower case: texts with none have no assignment
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
HEX_LONG = re.compile(r"[0-9a-f]{24,}")

METHOD_KIND = "random"
MAX_RATIO = 1.9       # code points per token, at most
LEAST_CHARS = 20      # shorter candidates tell too little
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
# Lengths of hex digests (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512).
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_HEX_ONLY = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_DOMAIN = re.compile(r"(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![A-Za-z0-9.-]*@)")
_USER_INFO = re.compile(r"[^\s/@:]*(?::[^\s@]*)?")
_NUMBER = re.compile(r"[0-9_+/=-]+")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text)
                if len(m.group(2)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= ACCESS_LEAST]
    # [0-9a-f]+ takes whole runs, so a length in the pattern gives the same spans
    out += [("hex", *m.span()) for m in HEX_LONG.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def known_harmless(s: str) -> bool:
    """Digests of a usual length, UUIDs, numbers and runs of few characters."""
    if _HEX_ONLY.fullmatch(s) and len(s) in DIGEST_LENGTHS:
        return True
    return bool(_UUID.fullmatch(s) or _NUMBER.fullmatch(s)) or len(set(s)) <= 6


def _counter(path: str):
    """Token counter over a byte-level vocabulary file."""
    enc, _ = byte_encoding(path)
    return lambda s: len(enc.encode_ordinary(s))


def random_spans(text: str, count, max_ratio: float) -> list[tuple[str, int, int]]:
    out = []
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        if text[end:end + 1] == "@":
            user = _user_info(text, start, end)
            if user is not None:
                start = max(start, user)
            elif "/" not in m.group() and _DOMAIN.match(text, end + 1):
                continue  # local part of a mail address
        elif start > 1 and text[start - 1] == "@" and not text[start - 2].isspace():
            domain = _DOMAIN.match(text, start)
            if domain and domain.end() >= end:
                continue
        s = text[start:end]
        if len(s) < LEAST_CHARS or known_harmless(s) or len(s) > max_ratio * count(s):
            continue
        out.append((METHOD_KIND, start, end))
    return out


def _user_info(text: str, start: int, end: int) -> int | None:
    """Where the user-info of a URL starts, if it ends with the candidate."""
    # it holds no "@", so the search ends at the one before, and all searches of a text
    # together pass over it once
    at = text.rfind("://", text.rfind("@", 0, start) + 1, end)
    return at + 3 if at >= 0 and _USER_INFO.fullmatch(text, at + 3, end) else None


def _covered(start: int, end: int, spans) -> bool:
    """Whether spans, sorted by start, cover every place from start to end."""
    for _, b, e in spans:
        if b > start:
            break
        start = max(start, e)
    return start >= end


def scan(text: str, count, max_ratio: float) -> tuple[list, list]:
    """(base spans, all spans) of one text."""
    base = base_spans(text)
    own = [s for s in random_spans(text, count, max_ratio)
           if not _covered(s[1], s[2], base)]
    order = (*KINDS, METHOD_KIND)
    return base, sorted(base + own, key=lambda s: (s[1], order.index(s[0])))


_SPAN = "array<struct<kind:string,start:int,end:int>>"


def _scan_batches(batches, path: str, max_ratio: float):
    import pyarrow as pa
    count = _counter(path)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def rows(spans):
        return [{"kind": k, "start": b, "end": e} for k, b, e in spans]
    for batch in small_batches(batches):
        base, every = [], []
        for text in batch.column("text").to_pylist():
            found = scan(text or "", count, max_ratio)
            base.append(rows(found[0]))
            every.append(rows(found[1]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(base, kind), pa.array(every, kind)],
            ["doc_id", "base_spans", "spans"])


def scan_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                   text_col: str = "text", max_ratio: float = MAX_RATIO) -> DataFrame:
    """One row per document: ``doc_id, base_spans, spans``, each an array of
    (kind, start, end)."""
    view = documents_view(docs, id_col, text_col)
    id_type = view.schema["doc_id"].dataType.simpleString()
    return view.mapInArrow(lambda it: _scan_batches(it, tokenizer_path, max_ratio),
                           f"doc_id {id_type}, base_spans {_SPAN}, spans {_SPAN}")


def span_list(col):
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(col, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_digests(scanned: DataFrame) -> DataFrame:
    def number(kind):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(span_list(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"))


def _redact_batches(batches, path: str, max_ratio: float, mark: str):
    import pyarrow as pa
    count = _counter(path)
    for batch in small_batches(batches):
        texts, at = [], batch.schema.get_field_index("text")
        for text in batch.column(at).to_pylist():
            spans = scan(text, count, max_ratio)[1] if text else []
            out, done = [], 0
            for _, b, e in spans:
                if b >= done:
                    out += [text[done:b], mark]
                done = max(done, e)
            texts.append("".join(out) + text[done:] if spans else text)
        yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))


def redact(docs: DataFrame, tokenizer_path: str, max_ratio: float = MAX_RATIO,
           mark: str = "[secret]") -> DataFrame:
    """``docs`` (column ``text``) with every span replaced by ``mark``; all
    rows and columns stay, null texts stay null."""
    return docs.mapInArrow(lambda it: _redact_batches(it, tokenizer_path, max_ratio, mark),
                           docs.schema)
