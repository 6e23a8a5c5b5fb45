import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from lodeframe.llm import exact_dedup as module
from lodeframe.llm.exact_dedup import Directory, exact_dedup, inserted, keep_one
from tests.llm.cases import corpus, docs


def model(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    return {i: (min(g)[1], len(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for _, i in g}


def result(df):
    return {r["doc_id"]: (r["keep_id"], r["group_size"], r["text_sha256"]) for r in df.collect()}


def test_against_model(spark):
    rows = corpus(80)
    assert result(exact_dedup(docs(spark, rows))) == model(rows)


def test_bytes_decide_when_hash_and_digest_collide(spark):
    rows = corpus(60, 2)
    df = exact_dedup(docs(spark, rows), hash_of=lambda c: F.length(c) % 3, digest_of=lambda c: F.lit("x"))
    want = {k: v[:2] for k, v in model(rows).items()}
    assert {k: v[:2] for k, v in result(df).items()} == want


def test_buckets_split_until_they_fit(spark):
    records = spark.range(3000).select(F.xxhash64("id").alias("h")).checkpoint()
    doors = inserted(records, 50, 20)
    assert doors.depth == 6 and doors.leaves is not None  # some of the 64 buckets hold more than 50 of 3,000
    held = {(r["bucket"], r["depth"]): r["count"] for r in doors.buckets(records).groupBy("bucket", "depth").count().collect()}
    assert sum(held.values()) == 3000 and all(n <= 50 for n in held.values()) and len({d for _, d in held}) > 1
    # a bucket's hashes share their first bits, and no other bucket has them
    for r in doors.buckets(records).collect():
        assert (r["h"] - r["bucket"]) % 2**64 < 2 ** (64 - r["depth"])
    assert inserted(records, 10_000, 8) == Directory(0)
    one = inserted(spark.range(500).select(F.lit(5).cast("long").alias("h")).checkpoint(), 10, 12)
    assert one == Directory(6)  # one hash can't be split: its bucket overflows
    assert inserted(records.limit(0), 10, 8) == Directory(0)


def test_small_buckets_give_the_same_answers(spark, monkeypatch):
    rows = corpus(120, 4)
    assert result(exact_dedup(docs(spark, rows), capacity=3)) == model(rows)
    # groups above SALT_ROWS, sent to all tasks or dealt to salted copies
    monkeypatch.setattr(module, "SALT_ROWS", 2)
    assert result(exact_dedup(docs(spark, rows), capacity=8)) == model(rows)
    monkeypatch.setattr(module, "BROADCAST_IDS", 1)
    assert result(exact_dedup(docs(spark, rows), capacity=8)) == model(rows)


def test_the_index_answers(spark, monkeypatch):
    """Rows that are sent to another bucket than their record's find nothing."""
    rows, real, calls = corpus(60, 5), Directory.buckets, []
    assert exact_dedup(docs(spark, rows), capacity=4).count() == len(rows)

    def elsewhere(self, df):
        calls.append(df)
        return real(self, df) if len(calls) == 1 else df.withColumns({"bucket": F.lit(-1).cast("long"), "depth": F.lit(0)})

    monkeypatch.setattr(Directory, "buckets", elsewhere)
    assert exact_dedup(docs(spark, rows), capacity=4).count() == 0


def test_null_and_repeated_ids(spark):
    rows = [(1, "aa"), (3, "a a"), (3, "bb"), (None, "cc"), (None, "aa"), (4, None), (4, "")]
    got = sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"], r["kept"]) for r in exact_dedup(docs(spark, rows)).collect())
    assert got == [(0, 0, 1, True), (0, 3, 3, False), (1, 3, 3, False), (3, 3, 1, True), (3, 3, 3, True), (4, 4, 2, False), (4, 4, 2, True)]
    kept = sorted((r["text"] or "") for r in keep_one(docs(spark, rows)).collect())
    assert kept == ["", "a a", "bb", "cc"]
