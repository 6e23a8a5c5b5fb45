import random

import numpy as np

from lodeframe.llm.jaccard_join import keep_first, near_duplicates
from tests.llm.cases import corpus, docs, words


def model(rows, n=5, percent=80):
    sets = {}
    for i, t, *_ in rows:
        ws = words((t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets[i] = {tuple(ws[k : k + n]) for k in range(len(ws) - n + 1)} if len(ws) >= n else {tuple(ws)} - {()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_against_model(spark):
    for seed, bits in ((1, 18), (2, 8)):
        rows = corpus(70, seed)
        assert result(near_duplicates(docs(spark, rows), sketch_bits=bits)) == model(rows)


def test_family_of_near_copies(spark):
    """Copies with few and many edits, chains of edits, and a passage that all share."""
    r = random.Random(5)
    base = ["b%d" % r.randrange(400) for _ in range(150)]
    rows = []
    for i in range(70):
        ws = base[:]
        for _ in range(r.randrange(0, 7)):
            ws[r.randrange(150)] = "e%d" % r.randrange(10**6)
        rows.append((i, " ".join(ws)))
    chain = base[:]
    for i in range(70, 95):
        chain = chain[:]
        chain[r.randrange(150)] = "c%d" % i
        rows.append((i, " ".join(chain)))
    rows += [(100 + i, " ".join(base[:40] + ["u%d-%d" % (i, k) for k in range(60)])) for i in range(20)]
    assert result(near_duplicates(docs(spark, rows), sketch_bits=18)) == model(rows)
    assert result(near_duplicates(docs(spark, rows), sketch_bits=8)) == model(rows)


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    r = random.Random(8)
    a, b, c = (" ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(40)) for _ in range(3))
    got = sorted((str(x["doc_id"]), x["n_shingles"], str(x["component_id"])) for x in near_duplicates(docs(spark, [(5, a), (5, b), (7, a), (8, b), (None, c), (None, c), (None, b), (9, None), (None, "")]), sketch_bits=12).collect())
    assert got == sorted([("5", 36, "5"), ("5", 36, "5"), ("7", 36, "5"), ("8", 36, "5"), ("None", 36, "None"), ("None", 36, "None"), ("None", 36, "5"), ("9", 0, "9"), ("None", 0, "None")])
    # 7 and 8 are in classes of their own, though both have the smallest id 5
    kept = sorted(x["text"] or "" for x in keep_first(docs(spark, [(5, a), (5, b), (7, a), (8, b), (None, c), (None, c)]), sketch_bits=12).collect())
    assert kept == sorted([a, b, c])


def test_sizes_at_the_threshold(spark):
    """Sets of n shingles inside sets of n / 0.8: exactly linked, in neighbouring steps of sizes; one more shingle is too many."""
    rows = []
    for k, n in enumerate((4, 8, 16, 20, 40, 64, 100, 256)):
        ws = [f"w{k}x{i}" for i in range(2 * n + 10)]
        rows += [(10 * k, " ".join(ws[: n + 4])), (10 * k + 1, " ".join(ws[: n * 5 // 4 + 4])), (10 * k + 2, " ".join(ws[: n * 5 // 4 + 4] + ["y"])), (10 * k + 3, " ".join(["z", *ws[: n * 5 // 4 + 4], "z"]))]
    for bits in (8, 16):
        assert result(near_duplicates(docs(spark, rows), sketch_bits=bits)) == model(rows)


def test_sketches_grow_with_their_values(spark):
    from lodeframe.llm.jaccard_join import FULL_LOAD, SAMPLED_LOAD, SAMPLED_PER_BYTE
    from lodeframe.llm.sketch import MOST_BITS, plane, repeated_cells, row_bits, twice

    # at 6 GB a text of unique shingles must not seem to repeat in 60 % of them
    for gb in (0.1, 0.5, 3, 6):
        values = gb * 1e9 * SAMPLED_PER_BYTE
        assert 1 - 2.718281828 ** (-values / 2 ** row_bits(values, SAMPLED_LOAD)) < 0.5
    assert row_bits(0, FULL_LOAD) < row_bits(1e8, FULL_LOAD) < row_bits(1e15, FULL_LOAD) == MOST_BITS
    rng = np.random.default_rng(3)
    values = rng.integers(0, 2**63, 40_000, dtype=np.int64)
    df = spark.createDataFrame([(int(v),) for v in np.concatenate([values, values[:15_000], values[:10]])], "v long").repartition(5)
    seen = plane(repeated_cells(df, lambda bs: (b["v"].to_numpy().view(np.uint64) for b in bs), 20), 20, 1)
    hit = twice(seen, values.view(np.uint64), 20, 1)
    assert hit[:15_000].all() and hit[15_000:].mean() < 0.1


def test_shingles_are_kept_once_where_sketches_are_full(spark):
    """Texts without links, all let through: the checkpoint folder gets one copy of their shingles, and a fifth for prefixes."""
    from pathlib import Path
    from urllib.parse import urlparse

    from lodeframe.llm.common import shared_checkpoints

    r = random.Random(11)
    n, size = 300, 600
    rows = [(i, " ".join("%x" % r.randrange(1 << 40) for _ in range(size + 4))) for i in range(n)]
    shared_checkpoints(spark)
    folder = Path(urlparse(spark.sparkContext.getCheckpointDir()).path)
    used = lambda: sum(p.stat().st_size for p in folder.rglob("part-*"))
    before = used()
    assert result(near_duplicates(docs(spark, rows), sketch_bits=8)) == {i: (size, i) for i, _ in rows}
    assert used() - before < 1.7 * 8 * n * size


def test_verification_in_rounds(spark, monkeypatch):
    from lodeframe.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "ROUND", 1)
    r = random.Random(6)
    base = ["b%d" % r.randrange(400) for _ in range(120)]
    rows = []
    for i in range(60):
        ws = base[:]
        for _ in range(r.randrange(0, 6)):
            ws[r.randrange(120)] = "e%d" % r.randrange(10**6)
        rows.append((i, " ".join(ws)))
    assert result(near_duplicates(docs(spark, rows), sketch_bits=18)) == model(rows)
