"""Token counts, shards and packing against the tokenizers library used text by text."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lakemill.llm import counts, packing, queries, repair, tokens, words
from tests.conftest import SF
from tests.llm.conftest import EDGE, documents


def encoded(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def by_id(rows):
    return sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))


@pytest.mark.parametrize("size", [40, 1 << 20])
def test_words_are_those_of_the_pattern(size):
    texts = [t for _, t in EDGE if t is None or len(t) < 1000]
    got = [[] for _ in texts]
    for part in words.words(pa.array(texts), size=size):
        raw = part.data.tobytes()
        for row, a, b in zip(part.row, part.start, part.end, strict=True):
            got[row].append(raw[a:b].decode())
    import re

    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


def test_token_counts_equal_the_library(spark, edge, nothing):
    path = counts.default_path()
    got = counts.count_tokens(edge, path).collect()
    want = [(i, len((t or "").encode()), len(encoded(path, t))) for i, t in EDGE]
    assert sorted(str(tuple(r)) for r in got) == sorted(map(str, want))
    assert counts.count_tokens(nothing, path).collect() == []
    rows = {r["doc_id"]: r for r in queries.op10_token_counts(spark, SF).collect()}
    for r in documents(spark).collect():
        n = len(encoded(path, r["text"]))
        assert (rows[r["doc_id"]]["n_tokens"], rows[r["doc_id"]]["over_limit"]) == (n, n > 1024)


def test_proved_tokens_are_single():
    path = counts.default_path()
    proved = counts.prove(path)
    assert " the" in proved and len(proved) > 40_000
    assert all(len(encoded(path, t)) == 1 for t in random.Random(0).sample(sorted(proved), 50))


@pytest.mark.parametrize("n", [0, 1, 2, 7, 5000])
def test_grammar_round_trip_and_random_access(n):
    ids = np.random.default_rng(n).integers(0, 9, n).astype(np.uint32)
    grammar = repair.read_frame(repair.frame_bytes(repair.compress(ids, least=2)))
    assert np.array_equal(repair.decode(grammar), ids)
    assert np.array_equal(repair.decode(grammar, n // 3, n // 2), ids[n // 3 : n // 2])
    assert n < 5000 or len(grammar.sequence) < n / 2


def test_replacement_ends_when_no_pair_is_frequent():
    rng = np.random.default_rng(2)
    passage = rng.integers(0, 1000, 300).astype(np.uint32)
    ids = np.concatenate([np.append(passage, rng.integers(0, 1000)) for _ in range(400)]).astype(np.uint32)
    grammar = repair.compress(ids)
    pairs = np.unique(np.stack([grammar.sequence[:-1], grammar.sequence[1:]], 1), axis=0, return_counts=True)[1]
    assert pairs.max() < repair.LEAST and len(grammar.sequence) < len(ids) / 64
    assert np.array_equal(repair.decode(repair.read_frame(repair.frame_bytes(grammar))), ids)


def test_a_full_shard_is_one_frame():
    for size, frames in ((repair.FRAME_TOKENS + 5000, 1), (2 * repair.FRAME_TOKENS + 5000, 2)):
        ids = np.arange(size, dtype=np.uint32) % 50_000
        one = np.ones(1, bool)
        data = b"".join(repair.shard_chunks(np.array([3]), one, np.array([size]), ids))
        assert int.from_bytes(data[-12:-4], "little") == frames
        assert np.array_equal(repair.read_shard(data)[3], ids)


def test_equal_ids_compress():
    ids = np.full(1001, 7, np.uint32)
    assert np.array_equal(repair.decode(repair.compress(ids, least=2)), ids)


def test_shards_give_back_all_ids(spark, edge, nothing, monkeypatch):
    path = tokens.default_path()
    monkeypatch.setattr(repair, "SHARD_TOKENS", 500)
    rows = by_id(repair.round_trip(edge, path).collect())
    want = by_id([{"doc_id": i, "ids": np.array([*encoded(path, t), 1], "<u4").tobytes()} for i, t in EDGE])
    assert [(r["doc_id"], bytes(r["ids"])) for r in rows] == [(w["doc_id"], w["ids"]) for w in want]
    assert [r["start"] for r in rows] == np.cumsum([0, *(len(w["ids"]) // 4 for w in want)])[:-1].tolist()
    assert repair.round_trip(nothing, path).collect() == []


def test_shard_query(spark):
    path, start = tokens.default_path(), 0
    got = {r["doc_id"]: r for r in queries.op9_repair_shards(spark, SF).collect()}
    for r in documents(spark).orderBy("doc_id").collect():
        ids = np.array([*encoded(path, r["text"]), 1], "<u4")
        assert tuple(got[r["doc_id"]])[1:] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def fewest(sizes, capacity):
    best = [len(sizes)]

    def put(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + sizes[k] <= capacity:
                put(k + 1, [*bins[:j], bins[j] + sizes[k], *bins[j + 1 :]])
        put(k + 1, [*bins, sizes[k]])

    put(0, [])
    return best[0]


def test_bin_completion_is_optimal_on_small_groups():
    rng = random.Random(5)
    for _ in range(150):
        sizes = sorted((rng.randint(1, 60) for _ in range(rng.randint(0, 9))), reverse=True)
        bins = packing.complete(sizes, 100, effort=50)
        assert sorted(x for b in bins for x in b) == sorted(sizes) and all(sum(b) <= 100 for b in bins)
        assert len(bins) == fewest(sizes, 100)


def test_bin_completion_improves_on_best_fit():
    rng = random.Random(1)
    sizes = [rng.randint(251, 500) for _ in range(300)]
    assert len(packing.complete(sizes, 1000)) < len(packing.best_fit(sizes, 1000))


def check_packing(rows, texts, path, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
    for members in sequences.values():
        members.sort(key=lambda r: r["offset"])
        ends = np.cumsum([r["length"] for r in members])
        assert [r["offset"] for r in members] == [0, *ends[:-1].tolist()] and ends[-1] <= capacity
    want = []
    for doc_id, text in texts:
        ids = np.array([*encoded(path, text), 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            want.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in rows)
    return len(sequences), -(-sum(w[3] for w in want) // capacity)


def test_packing(spark, edge, nothing):
    path = tokens.default_path()
    check_packing(packing.pack_documents(edge, path, 64).collect(), EDGE, path, 64)
    assert packing.pack_documents(nothing, path).collect() == []
    texts = [(r["doc_id"], r["text"]) for r in documents(spark).collect()]
    used, least = check_packing(queries.op8_best_fit_packing(spark, SF).collect(), texts, path, 4096)
    assert used <= least + 1


def test_sequences_hold_the_ids(spark):
    path = tokens.default_path()
    pieces = packing.stage(packing.cut(documents(spark).where("doc_id < 20"), path), "pieces")
    placed = packing.place(pieces)
    assert all(len(r["ids"]) == 4 * r["length"] <= 4 * 4096 for r in packing.sequences(placed).collect())
