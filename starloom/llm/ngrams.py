"""Words and n-grams of many texts at once, as numpy arrays.

Texts are joined to one byte string and cut into words by a byte table; a word's
hash comes from prefix polynomials modulo 2^64 over its bytes (words of over
``LONG_WORD`` bytes, where such polynomials are weak, are hashed one by one), an
n-gram's from prefix polynomials over the word hashes, both mixed. Byte
arrays are made for windows of ``WINDOW`` bytes that end between words, so long
texts need no more memory than their words do.
"""

from __future__ import annotations

from collections.abc import Iterator

WINDOW = 1 << 20
SLICE_BYTES = 1 << 20
SLICE_ROWS = 500
LONG_WORD = 256
# Odd multipliers of the two polynomials and the constants of the mixing step.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xC2B2AE3D27D4EB4F
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORD, BLANK, BREAK = 0, 1, 2


def byte_kinds(blanks: bytes, breaks: bytes = b""):
    """Kind of every byte: part of a word, blank between words, end of a piece."""
    import numpy as np
    kinds = np.zeros(256, np.uint8)
    kinds[list(blanks)] = BLANK
    kinds[list(breaks)] = BREAK
    return kinds


def mixed(h):
    """Spreads every bit of 64-bit values over all bits."""
    import numpy as np
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(MIX[0])
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(MIX[1])
    return h ^ (h >> np.uint64(31))


_powers: dict = {}


def powers(base: int, n: int):
    """(base^i, base^-i) modulo 2^64 for i < n, kept and grown as needed."""
    import numpy as np
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, WINDOW + 1)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        if size > 4 * WINDOW:  # of one very long text: not kept
            return both
        _powers[base] = both
    return _powers[base]


class Words:
    """Words of a joined text: ``start``, ``end`` (bytes), ``hash``, ``piece``."""

    def __init__(self, raw: bytes, kinds):
        import numpy as np
        self.raw = raw
        parts, at, broken = [], 0, 0
        data = np.frombuffer(raw, np.uint8)
        while at < len(data):
            size = WINDOW
            while True:
                window = data[at:at + size]
                kind = kinds[window]
                if at + size >= len(data):
                    break
                ends = np.flatnonzero(kind[::-1])  # cut behind the last byte between words
                if len(ends):
                    window, kind = window[:len(window) - ends[0]], kind[:len(kind) - ends[0]]
                    break
                size *= 2
            inside = np.zeros(len(kind) + 2, bool)
            inside[1:-1] = kind == WORD
            edges = np.flatnonzero(inside[1:] != inside[:-1])
            start, end = edges[::2], edges[1::2]
            up, down = powers(BYTE_BASE, len(window) + 1)
            prefix = np.zeros(len(window) + 1, np.uint64)
            np.cumsum((window.astype(np.uint64) + np.uint64(1)) * down[:len(window)], out=prefix[1:])
            h = mixed((prefix[end] - prefix[start]) * up[start] + (end - start).astype(np.uint64))
            breaks = np.cumsum(kind == BREAK, dtype=np.int64) + broken
            piece = breaks[start] if len(start) else np.zeros(0, np.int64)
            broken = int(breaks[-1])
            parts.append((start + at, end + at, h, piece))
            at += len(window)
        empty = np.zeros(0, np.int64)
        columns = list(zip(*parts)) if parts else [(empty,)] * 4
        self.start, self.end, self.hash, self.piece = (np.concatenate(c) for c in columns)
        self.hash = self.hash.astype(np.uint64)
        if len(self.hash):
            import xxhash
            for i in np.flatnonzero(self.end - self.start > LONG_WORD):
                self.hash[i] = xxhash.xxh64_intdigest(raw[self.start[i]:self.end[i]])
        up, down = powers(WORD_BASE, len(self.hash) + 1)
        self._up = up
        self._prefix = np.zeros(len(self.hash) + 1, np.uint64)
        np.cumsum(self.hash * down[:len(self.hash)], out=self._prefix[1:])

    def __len__(self) -> int:
        return len(self.hash)

    def grams(self, n: int, at):
        """Hashes of the n-grams that begin at words ``at``."""
        import numpy as np
        return mixed((self._prefix[at + n] - self._prefix[at]) * self._up[at] + np.uint64(n))

    def places(self, n: int, group=None):
        """First words of all n-grams inside one ``group`` (default: piece)."""
        import numpy as np
        group = self.piece if group is None else group
        if len(group) < n:
            return np.zeros(0, np.int64)
        return np.flatnonzero(group[n - 1:] == group[:len(group) - n + 1])


def text_slices(batches) -> Iterator[tuple]:
    """``(batch slice, list of lower-cased UTF-8 texts)``, bounded by bytes and rows (a
    longer text is a slice of its own); null texts are empty."""
    import pyarrow as pa
    for batch in batches:
        raw = batch.column("text").cast(pa.binary())
        at, size = 0, 0
        lengths = [0 if not x.is_valid else x.as_buffer().size for x in raw]
        for i, n in enumerate(lengths):
            if i > at and (size + n > SLICE_BYTES or i - at >= SLICE_ROWS):
                yield batch.slice(at, i - at), _lowered(raw, at, i)
                at, size = i, 0
            size += n
        if len(lengths) > at:
            yield batch.slice(at, len(lengths) - at), _lowered(raw, at, len(lengths))
        del batch, raw
        pa.default_memory_pool().release_unused()


def _lowered(raw, at: int, to: int) -> list[bytes]:
    return [(t or b"").translate(LOWER) for t in raw.slice(at, to - at).to_pylist()]


def joined(texts: list[bytes], kinds):
    """Words of all texts, with ``doc``, the number of each word's text."""
    import numpy as np
    words = Words(b"\n".join(texts), kinds)
    ends = np.cumsum([len(t) + 1 for t in texts])
    words.doc = np.searchsorted(ends, words.start, side="right")
    return words
