import itertools
import random

import numpy as np

from lodeframe.llm.sketch import Sketch, twice
from lodeframe.llm.substring_dedup import without_repeats
from lodeframe.llm.textkit import BASES, mix, windows
from tests.llm.cases import corpus, docs, words


def model(rows, size):
    seen, gone = {}, {}
    for i, t, *_ in rows:
        ws = words(t)
        for k in range(len(ws) - size + 1):
            seen.setdefault(tuple(ws[k : k + size]), []).append((i, k))
    for places in seen.values():
        for i, k in places:
            if (i, k) != min(places):
                gone.setdefault(i, set()).update(range(k, k + size))
    return {i: (len(words(t)), len(gone.get(i, ())), " ".join(w for k, w in enumerate(words(t)) if k not in gone.get(i, ()))) for i, t, *_ in rows}


def result(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in df.collect()}


def test_against_model(spark):
    for seed, size, bits in ((1, 20, 20), (2, 5, 20), (3, 20, 8), (4, 1, 16)):
        rows = corpus(60, seed)
        assert result(without_repeats(docs(spark, rows), size, bits)) == model(rows, size), (seed, size, bits)


def test_rows_without_an_id_of_their_own(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(12)) for x in "abc")
    tables = [
        # a run past the end of the other row with the same id; words at its places there; the same place in both
        [(1, f"{a} {b}"), (None, f"{c} z1 z2 z3 z4 z5 {a} {c} {a}"), (None, "u v w x y z")],
        [(1, b), (2, f"{a} {b}"), (2, c + " q" + a)],
        [(None, a), (None, a), (None, f"{b} {b}"), (2**63 - 1, f"{b} x")],
        [(7, f"{a} {b}"), (7, f"{a} {c}"), (7, f"{a} {b}"), (3, c)],
    ]
    for rows in tables:
        found = without_repeats(docs(spark, rows), 5, 16).collect()
        got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_text"]) for r in found)
        allowed = []
        for order in itertools.permutations(rows):
            if list(order) == sorted(order, key=lambda r: (r[0] is None, r[0] or 0)):
                want = model(list(enumerate(t for _, t in order)), 5)
                allowed.append(sorted((str(i), *want[k]) for k, (i, _) in enumerate(order)))
        assert got in allowed, rows


def test_periodic_text(spark):
    rows = [(1, "a b c " * 30), (2, "a b c " * 10), (3, "x " * 25)]
    assert result(without_repeats(docs(spark, rows), 20, 16)) == model(rows, 20)


def test_sketch_never_underestimates():
    r = np.random.default_rng(1)
    for bits in (8, 10, 16):
        values = r.integers(0, 3000, 5000).astype(np.uint64) * np.uint64(BASES[0])
        s = Sketch(bits)
        for part in np.array_split(values, 7):
            s.add(part)
        v, n = np.unique(values, return_counts=True)
        assert twice(s.twice, v[n > 1], bits).all()
    assert not twice(Sketch(16).twice, values, 16).any()


def test_windows_hash_words_in_order():
    r = random.Random(2)
    h = mix(np.array([r.randrange(5) for _ in range(200)], np.uint64))
    for n in (1, 2, 3, 5, 10, 20):
        got = windows(h, n, BASES[0])
        assert len(got) == 200 - n + 1
        for i in range(0, 200 - n + 1, 7):
            want = 0
            for x in h[i : i + n].tolist():
                want = (want * BASES[0] + x) % 2**64
            assert int(got[i]) == want


def test_very_common_windows_are_dealt_to_parts(spark):
    for seed in (5, 6):
        rows = corpus(70, seed)
        df = docs(spark, rows).repartition(9)
        for chunks in (1, 2, 4):
            assert result(without_repeats(df, 20, 18, common_chunks=chunks)) == model(rows, 20), (seed, chunks)
        assert result(without_repeats(df, 20, 8, common_chunks=3)) == model(rows, 20)


def test_common_cells_are_counted_over_all_partitions(spark):
    from lodeframe.llm.sketch import COMMON_CELLS, common_cells, repeated

    one = np.array([123456789], np.uint64)
    df = spark.range(0, 400, 1, 8)

    def values(batches):
        for b in batches:
            yield np.concatenate((one, b["id"].to_numpy().astype(np.uint64) * np.uint64(BASES[0])))

    _, common = repeated(df, values, 12, common_from=3)
    assert common.sum() >= 1 and common[common_cells(one)].all() and len(common) == COMMON_CELLS
    _, common = repeated(df, values, 12, common_from=1000)
    assert not common.any()
