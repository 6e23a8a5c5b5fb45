import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lodeframe.llm.packing import VOCABULARY, WordIds, make_plan, pack
from tests.llm.cases import corpus, docs

PATH = public_tokenizers.path(VOCABULARY)


def test_pieces_and_places(spark):
    rows = corpus(60, 3) + [(2000, "Hello, WORLD's don't <|endoftext|> <|ENDOFTEXT|> é́ x\x1cy\u3000z 12"), (2001, "word " * 5000)]
    tok, got = Tokenizer.from_file(PATH), {}
    placed = pack(docs(spark, rows), PATH, 256).collect()
    for r in placed:
        got.setdefault(r["doc_id"], []).append(r)
    for i, t, *_ in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        parts = sorted(got[i], key=lambda r: r["piece"])
        assert [r["start"] for r in parts] == list(range(0, len(ids), 256))
        for r in parts:
            own = ids[r["start"] : r["start"] + 256]
            assert (r["length"], r["ids_crc32"]) == (len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
    sequences = {}
    for r in placed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r["length"] for r in placed)
    assert len(sequences) <= 1.2 * total / 256 + 1


def test_words_are_tokenized_as_whole_texts():
    ids, tok = WordIds(PATH), Tokenizer.from_file(PATH)
    for t in ("The end.", "it's I'LL we'd", "a,b;c", "12.5% $3 #x", "naïve Café ÉCLAIR", "x" * 300, "…—“q”", "'s 't", "foo.bar!!", "e\u0301.", "١٢٣."):
        assert np.frombuffer(ids.of(t.encode()), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("lengths", [[], [10], [4, 6] * 7, [3, 3, 4] * 5, [9] * 4 + [1] * 3, [1] * 25, [6] * 5, [7, 2, 1] * 3 + [10]])
def test_plan_places_every_piece_once(lengths):
    counts = {x: lengths.count(x) for x in set(lengths)}
    plan = make_plan(counts, 10)
    assert dict(plan.used) == counts
    filled, seen = {}, {}
    for x, segments in plan.segments.items():
        for k, (first, sequence, offset, row) in enumerate(segments):
            end = segments[k + 1][0] if k + 1 < len(segments) else plan.used[x]
            for rank in range(first, end):
                s, at = sequence + (rank - first) // row, offset + (rank - first) % row * x
                seen[x] = seen.get(x, 0) + 1
                filled.setdefault(s, []).append((at, x))
    assert seen == counts and len(filled) == plan.sequences
    for s in filled.values():
        at = 0
        for offset, x in sorted(s):
            assert offset == at
            at += x
        assert at <= 10


def test_plan_is_near_the_bound():
    r = np.random.default_rng(1)
    lengths = np.minimum(2048, r.lognormal(6.3, 1, 50_000).astype(int) + 1)
    counts = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True))}
    assert make_plan(counts).sequences <= 1.001 * -(-int(lengths.sum()) // 2048)
