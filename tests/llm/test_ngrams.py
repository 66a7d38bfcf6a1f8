"""Whitening, the Jaccard join and collocations against plain versions of their contracts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from starloom.llm import collocations, ngram_join, ngrams, whitening
from starloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- words and n-grams ------------------------------------------------------------------------

def test_words_over_windows(monkeypatch):
    """Windows of any size cut the same words with the same hashes."""
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é.\n\t") for _ in range(rng.randrange(400))) for _ in range(30)]
    texts += ["x" * 3000, "", " ", "."]
    raw = [t.encode() for t in texts]
    kinds = ngrams.byte_kinds(b" \t", b".\n")
    whole = ngrams.joined(raw, kinds)
    want = [(d, i) for d, t in enumerate(texts)
            for i, p in enumerate(re.split(r"[.\n]", t)) for w in re.findall(r"[^ \t]+", p)]
    assert len(whole) == len(want) and whole.doc.tolist() == [d for d, _ in want]
    for a, b, (x, y) in zip(whole.piece, whole.piece[1:], zip(want, want[1:])):
        assert (a == b) == (x == y)
    grams = whole.grams(3, whole.places(3))
    monkeypatch.setattr(ngrams, "WINDOW", 64)
    small = ngrams.joined(raw, kinds)
    assert np.array_equal(small.hash, whole.hash) and np.array_equal(small.start, whole.start)
    assert np.array_equal(small.piece, whole.piece)
    assert np.array_equal(small.grams(3, small.places(3)), grams)


# --- whitening ----------------------------------------------------------------------------------

@pytest.mark.parametrize("make", [
    lambda r: r.standard_normal((50, 1)), lambda r: r.standard_normal((50, 2)),
    lambda r: r.standard_normal((80, 17)), lambda r: r.standard_normal((90, 3)) @ r.standard_normal((3, 9)),
    lambda r: np.repeat(np.eye(6), 4, axis=0), lambda r: np.ones((5, 4)), lambda r: np.zeros((3, 3)),
    lambda r: np.kron(r.standard_normal((40, 3)), np.eye(2))])
def test_principal(make):
    x = make(np.random.default_rng(3))
    v = x.T @ x / len(x)
    values, axes = whitening.principal(v, 4)
    want = np.linalg.eigvalsh(v)[::-1][:4]
    want = want[want > 1e-12 * max(want[0], 1e-300)]
    assert np.allclose(values, want, rtol=1e-12)
    assert np.abs(axes.T @ axes - np.eye(len(values))).max(initial=0) < 1e-13
    assert np.abs(v @ axes - axes * values).max(initial=0) < 1e-13 * max(1, v.max())


def _whitened(rows):
    """Contract by plain numpy on (id, vector) rows: n, sums, eigenvalues, whitened."""
    x = np.array([[int(np.floor(256 * float(c))) for c in v] for _, v in rows])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:4], q[:, ::-1][:, :4]
    return n, ((n * x.astype(object) - s) ** 2).sum(axis=1), e / np.trace(v), (x - s / n) @ q / np.sqrt(e)


def test_whitening_equals_numpy(spark):
    rows = [(r.vec_id, r.embedding) for r in
            spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    n, deviation, explained, white = _whitened(rows)
    got = defaultdict(dict)
    for r in QUERIES["op11_embedding_whitening"](spark, SF).collect():
        got[r.component][r.vec_id] = r
        assert r.n == n and r.identity_error < 1e-9
        assert abs(r.explained - explained[r.component - 1]) < 1e-10
    assert sorted(got) == [1, 2, 3, 4]
    for c, by_id in got.items():
        mine = np.array([by_id[i].whitened for i, _ in rows])
        assert min(np.abs(mine - white[:, c - 1]).max(), np.abs(mine + white[:, c - 1]).max()) < 1e-9
        assert [by_id[i].deviation for i, _ in rows] == deviation.tolist()


def test_whitening_edge_cases(spark):
    schema = "vec_id long, embedding array<double>, n int, whitened string"
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 0.5]), (1, [1.0, 2.0, 0.5]), (None, [0.5]), (2, None), (3, [nan, 1.0]),
            (4, [1.0, None]), (5, []), (6, [-inf]), (7, [-0.001, 0.002, 1.0]), (8, [3.0, -2.0, 7.0])]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], schema)
    out = whitening.whiten(df).collect()
    fit = [(i, (v + [0.0] * 3)[:3]) for i, v in rows if i in (None, 1, 5, 7, 8) and v is not None]
    n, deviation, explained, white = _whitened(fit)
    assert n == 5 and {r.n for r in out} == {5} and len(out) == 3 * len(fit)
    ids = sorted([str(r.vec_id) for r in out if r.component == 1])
    assert ids == sorted(str(i) for i, _ in fit)
    by_id = {r.vec_id: r for r in out if r.component == 2}
    for k, (i, _) in enumerate(fit):
        assert by_id[i].deviation == deviation[k]
        assert abs(abs(by_id[i].whitened) - abs(white[k, 1])) < 1e-9
    for none in ("vec_id = 1", "vec_id = 5", "vec_id = 2", "false"):
        got = whitening.whiten(df.where(none))
        assert got.collect() == [] and got.columns[:3] == ["vec_id", "component", "n"]


def test_deviation_beyond_64_bits():
    x = np.array([[1 << 40, 0], [3, -5], [(1 << 30) - 1, 7]])
    n, s = 1_000_003, [1 << 45, -12345]
    want = [sum((n * int(a) - b) ** 2 for a, b in zip(row, s)) for row in x]
    assert want[0] >= 1 << 63
    got = whitening._exact_deviation(x, n, s)
    assert got.tolist() == [w if w < 1 << 63 else None for w in want]


# --- Jaccard join -------------------------------------------------------------------------------

def shingle_set(text, words=5):
    w = BLANK.findall(lower(text))
    if len(w) < words:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + words]) for i in range(len(w) - words + 1))


def joined_plainly(texts, percent=80):
    """id -> (set size, component) by all pairs that share a shingle."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    holders, common = defaultdict(list), Counter()
    for i, s in sets.items():
        for g in s:
            common.update((j, i) for j in holders[g])
            holders[g].append(i)
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for (a, b), c in common.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_join_equals_all_pairs(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in QUERIES["op12_ngram_join"](spark, SF).collect()}
    assert got == joined_plainly(texts)


def _versions(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_join_on_edited_groups(spark, seed, monkeypatch):
    """Groups around the threshold, chains of versions and a passage that half the texts share;
    every share size, and no n-gram or many n-grams hot."""
    rng = random.Random(seed)
    texts = []
    for length in (6, 20, 60, 200):
        base = [f"w{rng.randrange(10**5)}" for _ in range(length)]
        texts += _versions(rng, base, 25, max(1, length // 20))
        for _ in range(20):  # a chain
            base = list(base)
            base[rng.randrange(length)] = f"c{rng.randrange(10**5)}"
            texts.append(" ".join(base))
    passage = [f"p{i}" for i in range(40)]
    texts += [" ".join(passage + [f"t{rng.randrange(10**5)}" for _ in range(rng.randrange(12))])
              for _ in range(60)]
    texts += ["", " ", "one", "one two", "ONE two", "one two three four five"] + texts[:5]
    rng.shuffle(texts)
    texts = dict(enumerate(texts))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    if seed:
        monkeypatch.setattr(ngram_join, "HOT_SHARE", 0.05 if seed == 1 else 1e9)
        monkeypatch.setattr(ngram_join, "FLUSH_GRAMS", 500)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in ngram_join.similar_documents(df, part_grams=(4_000_000, 2000, 300)[seed]).collect()}
    assert got == joined_plainly(texts)


def test_join_edge_cases(spark):
    prose = "the quick brown fox jumps over the lazy dog while seven wizards mix potions"
    rows = [(1, None), (2, ""), (None, prose), (3, prose), (3, prose.upper()), (4, prose + "  "),
            (5, "x" * 70_000), (None, None), (None, "alone here"), (6, "alone here"), (7, " \n")]
    df = spark.createDataFrame([(i, t, "c", 9, 8, 7) for i, t in rows],
                               "doc_id long, text string, vertex string, n long, component_id long, gram long")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id)
                  for r in ngram_join.similar_documents(df).collect()), key=str)
    n = len(prose.split()) - 4
    assert got == sorted([(1, 0, 1), (2, 0, 2), (None, n, 3), (3, n, 3), (3, n, 3), (4, n, 3), (5, 1, 5),
                          (None, 0, None), (None, 1, 6), (6, 1, 6), (7, 0, 7)], key=str)
    assert ngram_join.similar_documents(df.limit(0)).collect() == []
    assert [r.component_id for r in ngram_join.similar_documents(df.where("doc_id = 2")).collect()] == [2]


# --- collocations ---------------------------------------------------------------------------------

def collocations_plainly(rows, min_count, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower(text)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        often = [p for p, a in counts.items() if a >= min_count and len(p) > 1]
        inner = defaultdict(int)
        for p in often:
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inner[p[i:i + k]] = max(inner[p[i:i + k]], counts[p])
        found = []
        for p in often:
            a = counts[p]
            if inner[p] >= a:
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k)
                           for k in range(1, len(p)))
            phrase = " ".join(p)
            found.append((-score, -a, phrase.encode(), lang, phrase, a, counts[p[:k]], counts[p[k:]], n[lang], score))
        out += [(r[3], i + 1, *r[4:]) for i, r in enumerate(sorted(found)[:top])]
    return sorted(out)


def _rows(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def test_collocations_equal_counting(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.text, r.lang) for r in docs.collect()]
    want = collocations_plainly(rows, 100)
    assert want and _rows(QUERIES["op13_collocations"](spark, SF)) == want
    assert _rows(collocations.collocations(docs, min_count=5, top=50)) == \
        collocations_plainly(rows, 5, 50)


@pytest.mark.parametrize("broken", ["", "grams", "words", "table"])
def test_collocations_survive_collisions(spark, monkeypatch, broken):
    """Fingerprints that collide, of words or of n-grams, and a bit table that says yes to
    everything change nothing."""
    rng = random.Random(9)
    rows = [(" ".join(rng.choice("abcdef") + rng.choice(("", " ", ".", "  \t"))
                      for _ in range(rng.randrange(60))), rng.choice(("en", "de", None)))
            for _ in range(120)] + [(None, "en"), ("", "xx"), ("solo", "yy")]
    df = spark.createDataFrame([(t, x, 1, 2) for t, x in rows], "text string, lang string, phrase int, n int")
    view = df.selectExpr("coalesce(text, '') as text", "coalesce(lang, 'und') as lang").toArrow()
    want = collocations_plainly(rows, 6, 40)
    if broken == "":
        assert _rows(collocations.collocations(df, min_count=6, top=40)) == want
    # the passes by hand, as workers do not see what a test replaces
    if broken == "grams":
        monkeypatch.setattr(collocations, "_prints", lambda w, n, at: w.grams(n, at) % np.uint64(7))
    if broken == "words":
        plain = ngrams.joined

        def joined(texts, kinds):
            words = plain(texts, kinds)
            words.hash = words.hash % np.uint64(3)
            return words
        monkeypatch.setattr(collocations.ngrams, "joined", joined)
    table = collocations.Table(np.full(1 << (collocations.TABLE_BITS - 3), 255, np.uint8), 0)
    counts = Counter()
    for found in collocations._phrase_counts(iter(view.to_batches(max_chunksize=40)), 5, table):
        for (lang, n, phrase), f in found.items():
            counts[lang, n, phrase.decode()] += f
    exact = Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.]", lower(text)):
            w = piece.split()
            exact.update({(lang, 0, ""): len(w)} if w else {})
            exact.update((lang, k, " ".join(w[i:i + k])) for k in range(1, 6)
                         for i in range(len(w) - k + 1))
    assert counts == exact


def test_collocations_small_parts(spark, monkeypatch):
    """Many shares of fingerprints and ranking in parts give the same."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = _rows(collocations.collocations(docs, min_count=20, top=30))
    monkeypatch.setattr(collocations, "SHARE_GRAMS", 3000)
    monkeypatch.setattr(collocations, "RANK_ROWS", 100)
    assert want and _rows(collocations.collocations(docs, min_count=20, top=30)) == want


def test_collocations_edge_cases(spark):
    text = "New York, new york! new  york\tnew\nyork city New York city."
    df = spark.createDataFrame([(text, "en", 1)] * 2 + [(None, "en", 1), ("x" * 70_000, None, 1)],
                               "text string, lang string, rank int")
    got = _rows(collocations.collocations(df, min_count=2))
    assert got == collocations_plainly([(r.text, r.lang) for r in df.collect()], 2)
    assert collocations.collocations(df).collect() == []
    assert collocations.collocations(df.limit(0)).collect() == []
