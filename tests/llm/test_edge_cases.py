"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty
tables and further columns whose names clash with the operators' own."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import (bpe_codec, decontaminate, html_wrapper, license_scan, quality_rules,
                          secret_scan, sharding, simhash, token_count, url_filter)
from starloom.llm.queries import ALLOW, BLOCK, BYTE_BPE, WORD_BPE

DOC = ("doc_id long, text string, lang string, source string, n_chars long, row long, code long, "
       "text_hash long, n_words long, kept boolean, mark long, hash string, shard int, _id long, "
       "part int, least long")
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards mix potions in the cellar. "


def _row(i, text):
    return (i, text, "en", None, None if text is None else len(text), 1, 2, 3, 4, None, 5, None, 6, 7,
            8, 9)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [_row(1, None), _row(2, ""), _row(None, PROSE), _row(3, PROSE), _row(3, PROSE),
            _row(4, PROSE + "end"), _row(5, "x" * 70_000), _row(6, " \n\t" * 9000),
            _row(7, "naïve Σςσ \u2003 İK \x1c\x00 <|endoftext|>don't 'tis ſecret=abcdefgh"),
            _row(None, None), _row(8, "word " * 12_000)]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 0), (4, None, 0)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, PROSE), (3, PROSE), (4, "lazy dog")],
                                 "item_id long, text string")


def _pages(df):
    return df.select(F.col("doc_id").alias("page_id"), F.col("lang").alias("url"),
                     F.col("text").alias("html"), "row", "n_words", F.lit("h").alias("host"),
                     F.lit(1).alias("wrapper"), F.lit(1).alias("keys"))


OPERATORS = {
    "html": lambda d, l, b: html_wrapper.main_text(_pages(d)),
    "bpe": lambda d, l, b: bpe_codec.token_digests(bpe_codec.encode_decode(d, BYTE_BPE)),
    "quality": lambda d, l, b: quality_rules.judge_documents(d, l),
    "decontaminate": lambda d, l, b: decontaminate.contamination(d, b),
    "tokens": lambda d, l, b: token_count.count_tokens(d, WORD_BPE),
    "shards": lambda d, l, b: sharding.shard_by_bytes(d),
    "licences": lambda d, l, b: license_scan.scan_licenses(d),
    "simhash": lambda d, l, b: simhash.near_duplicates(d),
    "secrets": lambda d, l, b: secret_scan.span_digests(secret_scan.scan_documents(d, BYTE_BPE)),
    "urls": lambda d, l, b: url_filter.judge_urls(_pages(d), ALLOW, BLOCK),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(docs, labels, benchmark, name):
    out = OPERATORS[name](docs, labels, benchmark)
    key = "page_id" if "page_id" in out.columns else "doc_id"
    got = sorted((r[key] for r in out.collect()), key=str)
    assert got == sorted([1, 2, None, 3, 3, 4, 5, 6, 7, None, 8], key=str)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, labels, benchmark, name):
    assert OPERATORS[name](docs.limit(0), labels.limit(0), benchmark.limit(0)).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_side_tables(docs, labels, benchmark, name):
    assert OPERATORS[name](docs, labels.limit(0), benchmark.limit(0)).count() == 11


def _kept(df):
    assert df.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] or "n_tokens" in df.columns
    return sorted((r.doc_id for r in df.collect()), key=str)


def test_stages_keep_columns(spark, docs, labels, benchmark, tmp_dir):
    labels.write.parquet(f"{tmp_dir}/labels.parquet")
    benchmark.write.parquet(f"{tmp_dir}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tmp_dir)
        assert out.schema.names == docs.schema.names
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert stage(spark, docs.limit(0), tmp_dir).count() == 0
    assert corpus_pipeline.quality(spark, docs, tmp_dir).count() == 4
    # PROSE has doc ids 3, 3 and null: the smallest id stays, once; null, empty and blank
    # texts are one group, and so are the texts that differ in few bits
    kept = _kept(corpus_pipeline.near_duplicates(spark, docs, tmp_dir))
    assert kept.count(3) == 1 and kept.count(None) == 0 and kept.count(1) == 1
    assert 2 not in kept and 6 not in kept
    clean = _kept(corpus_pipeline.decontamination(spark, docs, tmp_dir))
    assert 3 not in clean and 4 not in clean and clean.count(None) == 1 and 8 in clean
    assert len(_kept(corpus_pipeline.secrets(spark, docs, tmp_dir))) == 11
    assert corpus_pipeline.encoding(spark, docs, tmp_dir).count() == 11


def test_run(spark, docs, labels, benchmark, tmp_dir):
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    labels.write.parquet(f"{tmp_dir}/labels.parquet")
    benchmark.limit(0).write.parquet(f"{tmp_dir}/benchmark.parquet")
    out = corpus_pipeline.run(spark, tmp_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    # ids 1, 2, 5, 6, 8 and the null text fail the base rules
    assert sorted(r.doc_id for r in out.collect())[0] == 3
