"""All operators over empty tables, nulls in any column, repeated rows and clashing column names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodeframe.llm.exact_dedup import exact_dedup, keep_one
from lodeframe.llm.html_text import extract_text
from lodeframe.llm.jaccard_join import keep_first, near_duplicates
from lodeframe.llm.licenses import scan_licenses
from lodeframe.llm.mixing import mix, mixed_docs
from lodeframe.llm.packing import VOCABULARY, pack
from lodeframe.llm.pii import find_pii
from lodeframe.llm.quality import keep_good, quality
from lodeframe.llm.substring_dedup import without_repeats
from lodeframe.llm.url_rules import judge_urls
from tests.llm.cases import docs

BITS = {"sketch_bits": 16}
OPERATORS = {
    "exact": exact_dedup, "pii": find_pii, "mix": mix, "substring": lambda d: without_repeats(d, **BITS), "licenses": scan_licenses, "quality": quality,
    "pack": lambda d: pack(d, public_tokenizers.path(VOCABULARY)), "near": lambda d: near_duplicates(d, **BITS),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edges(spark, name):
    rows = [(None, "one two", None), (1, None, "a"), (2, "", "a"), (3, "x " * 50_000, "a"), (3, "x " * 50_000, "a"), (4, "one two", None)]
    got = OPERATORS[name](docs(spark, rows)).collect()
    assert len({r["doc_id"] for r in got}) == 5
    assert OPERATORS[name](docs(spark, [])).count() == 0


@pytest.mark.parametrize("stage", [keep_one, keep_good, lambda d: keep_first(d, **BITS), mixed_docs])
def test_stages_keep_columns(spark, stage):
    d = docs(spark, [(None, "one two three", None), (1, None, "a"), (2, "alpha beta " * 40, "a"), (2, "alpha beta " * 40, "a")])
    assert stage(d).schema == d.schema
    assert stage(docs(spark, [])).count() == 0


def test_stages_go_by_row(spark):
    import random

    r = random.Random(3)
    texts = [" ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 8))) for _ in range(70)) for _ in range(5)]
    for i in (None, 7):
        good = docs(spark, [(i, texts[0]), (i, "too short"), (i, texts[1]), (9, texts[2])])
        assert sorted(x["text"] for x in keep_good(good).collect()) == sorted(texts[:3])
        copies = docs(spark, [(i, texts[0]), (i, texts[0]), (i, texts[1]), (i, texts[2]), (1, texts[2])])
        for stage in (keep_one, lambda d: keep_first(d, **BITS)):
            got = stage(copies).collect()
            assert sorted(x["text"] for x in got) == sorted(texts[:3])
            assert {x["doc_id"] for x in got if x["text"] == texts[2]} == {1}
        rows = [(i, texts[k] if k < 3 else "a b c d e " * k, "ab"[k % 2]) for k in range(5)]
        want = {x["source"]: round(x["target"]) for x in mix(docs(spark, rows)).select("target", "source_size").distinct().join(docs(spark, rows).groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), " "))).alias("source_size")), "source_size").collect()}
        got = {}
        for x in mixed_docs(docs(spark, rows)).collect():
            got[x["source"]] = got.get(x["source"], 0) + len(x["text"].split())
        assert got == want


def test_pages(spark):
    pages = spark.createDataFrame([(None, None, None, 1), (1, "http://a.com/x", "", 1), (1, "http://a.com/x", "", 1)], "page_id long, url string, html string, `row` int")
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in extract_text(pages).collect()) == [(0, "", 0), (1, "", 0), (1, "", 0)]
    rules = spark.createDataFrame([("a.com", "/", "block"), ("a.com", "/", "block")], "host string, path string, action string")
    assert sorted((r["page_id"] or 0, r["rule"], r["verdict"]) for r in judge_urls(pages, rules).collect()) == [(0, None, "allow"), (1, "a.com/", "block"), (1, "a.com/", "block")]
    assert extract_text(pages.limit(0)).count() == 0 and judge_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_pipeline(spark, tmp_path):
    from tests.llm.cases import corpus

    docs(spark, corpus(80, 5)).write.parquet(str(tmp_path / "documents.parquet"))
    source = spark.read.parquet(str(tmp_path / "documents.parquet"))
    good = {r["doc_id"] for r in quality(source).filter("kept").collect()}
    kept = corpus_pipeline.STAGES[0][1](spark, source, str(tmp_path))
    assert {r["doc_id"] for r in kept.collect()} <= good and good
    once = corpus_pipeline.STAGES[1][1](spark, kept, "")
    assert once.select(F.regexp_replace("text", r"[\x20\x09-\x0D]", "")).distinct().count() == once.count()
    apart = corpus_pipeline.STAGES[2][1](spark, once, "")
    assert near_duplicates(apart).filter("component_id != doc_id").count() == 0
    taken = {r["doc_id"]: r["taken"] for r in mix(apart).collect()}
    mixed = corpus_pipeline.STAGES[3][1](spark, apart, "").collect()
    from tests.llm.cases import words

    got = {}
    for r in mixed:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(words(r["text"]))
    assert got == {k: v for k, v in taken.items() if v}
    assert corpus_pipeline.run(spark, str(tmp_path)).agg(F.sum("length")).first()[0] > 0


def test_pipeline_on_nothing_and_on_odd_rows(spark, tmp_path):
    docs(spark, []).write.parquet(str(tmp_path / "none/documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    import random

    r = random.Random(4)
    text = lambda n: " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 9))) for _ in range(n))
    long = text(40_000)
    rows = [(None, text(90)), (None, text(90)), (5, text(90)), (5, text(90)), (6, long), (7, long), (8, None), (9, "")]
    docs(spark, rows).write.parquet(str(tmp_path / "odd/documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()
    assert {x["doc_id"] for x in got} == {None, 5, 6} and len({(x["doc_id"], x["piece"], x["ids_crc32"]) for x in got if x["piece"] == 0}) == 5
    for name, f in corpus_pipeline.STAGES:
        assert "empty" in f.__doc__ and "null" in f.__doc__.lower() and "long" in f.__doc__, name


def test_mix_spreads_rows_without_an_id(spark):
    rows = [(None, "w " * (k % 5 + 1) + str(k), "a") for k in range(300)] + [(k, "v " * 3, "b") for k in range(40)]
    one, many = (sorted((x["doc_id"] or -1, x["size"], x["taken"]) for x in mix(docs(spark, rows), ranges=n).collect()) for n in (1, 500))
    assert one == many
