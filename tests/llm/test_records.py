"""Archives, conversations and neighbours."""

import hashlib
import io
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import zstandard

from lakemill.llm import chat, nearest, queries, warc
from tests.check import compare
from tests.conftest import SF


@pytest.mark.parametrize("name", ["op4_warc_bundles", "op5_chat_format"])
def test_query_equals_sql(spark, duck, name):
    assert compare(queries.QUERIES[name](spark, SF), duck, queries.ORACLES[name]) is None


def test_warc_edges(spark):
    rows = [(1, "u v\r\nX: y", "a"), (2, None, "a"), (2, "x", None), (None, "x", ""), (3, "x", "a"), (3, "x", "a"), (4, "y", "é" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS bundle", "2 AS frame")
    back = warc.round_trip(pages).collect()
    got = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0, r["payload_bytes"]) for r in back)
    assert got == [(0, "revisit", 2, 0), (1, "revisit", 3, 1), (2, "response", 0, 0), (2, "revisit", 3, 1),
                   (3, "response", 0, 1), (3, "revisit", 3, 1), (4, "response", 0, 600_000)]
    assert {bytes(r["block"]).decode() for r in back if r["record_type"] == "response"} == {"", "a", "é" * 300_000}
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_bundle_is_seekable_and_plain_zstandard():
    records = [f"record {k} ".encode() * (k % 50 + 1) for k in range(500)]
    writer = warc.BundleWriter(records, frame_bytes=2000)
    data = b"".join(writer.chunks())
    file = io.BytesIO(data)
    file.size = lambda: len(data)
    bundle = warc.Bundle(file)
    assert len(writer.frames) > 10
    for k in random.Random(0).sample(range(500), 100):
        assert bundle.read(*writer.places[k]) == records[k]
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True) as reader:
        assert reader.read() == b"".join(records)


def test_chat_edges(spark):
    rows = [
        (1, 0, "user", "<user>[+]</user>\\<\\"), (1, 1, "user", None), (1, 2, "tool>%", "x[<"), (1, 3, None, ""),
        (1, 4, "assistant", "<"), (1, 4, "assistant", "<"), (1, None, "assistant", "[+]"), (None, None, "user", "a"),
        (2, 0, "assistant", "y" * 500_000),
    ]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS formatted", "2 AS segments")
    formatted = chat.format_conversations(given)
    from pyspark.sql import functions as F

    got = {r["conv_id"]: r for r in formatted.select("*", chat.read_turns(F.col("formatted")).alias("turns")).collect()}
    want = [("assistant", "[+]"), ("user", rows[0][3]), ("user", ""), ("tool>%", "x[<"), ("", ""), ("assistant", "<"), ("assistant", "<")]
    assert [tuple(t) for t in got[1]["turns"]] == want
    assert [tuple(t) for t in got[None]["turns"]] == [("user", "a")]
    assert got[1]["formatted"] == "".join(s["text"] for s in got[1]["segments"])
    learned = {r["conv_id"]: r for r in chat.digests(formatted).collect()}
    assert learned[1]["loss_sha256"] == hashlib.sha256(b"[+]<<").hexdigest()
    assert learned[2]["loss_chars"] == 500_000
    assert chat.format_conversations(given.limit(0)).collect() == []


def brute(ids, vectors, queries_at, k):
    out = {}
    for q in queries_at:
        score = vectors @ vectors[q]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_factor_one_is_exact_with_ties_and_copies(spark):
    rng = np.random.default_rng(3)
    vectors = rng.integers(-2, 3, (600, 5)).astype(float)
    vectors[vectors.any(1) == 0] = 1.0
    vectors[200:420] = vectors[7]  # a third is one vector
    ids = rng.permutation(600) * 2
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors, strict=True)]
    df = nearest.stage(nearest.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), "v")
    got = {}
    for r in nearest.nearest(df.where("vec_id % 20 = 0"), df, 20, 1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == brute(ids, vectors, np.flatnonzero(ids % 20 == 0), 20)


def test_recall_of_the_query(spark):
    given = queries.table(spark, SF, "embeddings").orderBy("vec_id").collect()
    ids, vectors = np.array([r["vec_id"] for r in given]), np.array([r["embedding"] for r in given], float)
    want = brute(ids, vectors, np.flatnonzero(ids % 20 == 0), 20)
    got = {}
    for r in queries.op6_nearest(spark, SF).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sum(len(got[q] & {i for i, _ in near}) for q, near in want.items()) >= 0.9 * 20 * len(want)


def unequal(rng, n):
    """Vectors with norms 0.5 to 1.5, unit vectors with five outliers, and clusters with lognormal norms."""
    random, centres = (rng.normal(size=(rows, 64)) for rows in (n, 64))
    unit = random / np.linalg.norm(random, axis=1, keepdims=True)
    outliers = unit.copy()
    outliers[1:6] *= 3
    clusters = (centres[rng.integers(0, 64, n)] + 0.3 * random) / 8 * rng.lognormal(0, 0.5, (n, 1))
    return {"norms": unit * rng.uniform(0.5, 1.5, (n, 1)), "outliers": outliers, "clusters": clusters}


@pytest.mark.parametrize("kind", ["norms", "outliers", "clusters"])
def test_recall_of_the_query_with_unequal_norms_on_full_shards(spark, tmp_path, kind):
    n = 2 * nearest.SHARD_VECTORS
    ids, vectors = np.arange(n), unequal(np.random.default_rng(0), n)[kind]
    flat = pa.ListArray.from_arrays(pa.array(np.arange(0, 64 * n + 1, 64), pa.int32()), pa.array(vectors.ravel()))
    pq.write_table(pa.table({"vec_id": ids, "embedding": flat}), tmp_path / "embeddings.parquet")
    got = {}
    for r in queries.op6_nearest(spark, str(tmp_path)).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    score = vectors[::20] @ vectors.T
    score[np.arange(len(score)), ids[::20]] = -np.inf
    want = np.argpartition(-score, 20, axis=1)[:, :20]
    assert sum(len(got[20 * k] & set(near)) for k, near in enumerate(want.tolist())) >= 0.9 * want.size


def test_factor_falls_until_the_sample_has_the_recall(spark):
    rng = np.random.default_rng(0)
    vectors = unequal(rng, 4000)["norms"]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = nearest.stage(nearest.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), "v")
    folder = nearest.new_folder(spark, "nearest")
    trees = nearest.build_index(df, folder, 20)
    asked = df.where("vec_id % 20 = 0")
    factors = [nearest.measured_factor(asked, trees, folder, 20, 20.0, recall, 100) for recall in (0.0, 0.9, 1.01)]
    assert factors[0] == 20 > factors[1] > factors[2] == 1
    assert nearest.measured_factor(asked, trees, folder, 20, 20.0, 0.0, 200) == 20  # measured with few queries too


def test_nearest_edges(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]),
            (6, [float("inf"), 0.0]), (7, [0.5, 0.5]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "2 AS rank")
    given = nearest.stage(nearest.usable(df), "v")
    got = sorted(tuple(r) for r in nearest.nearest(given.where("vec_id % 20 = 0"), given).collect())
    assert got == [(0, 1, 20, 2.0), (0, 2, 7, 0.5), (20, 1, 0, 2.0), (20, 2, 7, 1.0)]
    none = given.limit(0)
    assert nearest.nearest(none, none).collect() == []


def test_a_bundle_is_written_as_its_rows_come(spark, tmp_path, monkeypatch):
    """Rows that are revisits bring no payload to the writer, and no more than a frame of records is held."""
    seen, record = [], warc.record
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 4000)
    monkeypatch.setattr(warc, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 0})())}))
    monkeypatch.setattr(warc, "record", lambda *a: seen.append((a[4], len(a[2]))) or record(*a))
    monkeypatch.setattr(warc, "stage", lambda df, name: df)
    taken = {}
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.mapInArrow", lambda self, f, kinds: taken.update(f=f, df=self) or self)
    held = []
    monkeypatch.setattr(warc, "write_file", lambda folder, name, chunks: held.append((name, len(seen), [(len(c), len(seen)) for c in chunks])))
    monkeypatch.setattr(warc.BundleWriter.__init__, "__defaults__", (600,))
    pages = spark.createDataFrame([(k, f"u{k}", "same" * 50 if k % 2 else f"page {k} " * 20) for k in range(40)], "page_id long, url string, html string")
    warc.write_bundles(pages, str(tmp_path))
    rows = taken["df"].toArrow().combine_chunks().to_batches()
    index = [r for batch in taken["f"](iter(rows)) for r in batch.to_pylist()]
    assert sorted(r["page_id"] for r in index) == list(range(40))
    assert sum(1 for revisit, size in seen if revisit) == 19 and all(size == 0 for revisit, size in seen if revisit)
    assert len(held) > 1 and all(before < 40 for _, before, _ in held[:1])
    first = held[0][2]
    assert first[0][1] < first[-1][1]  # the first frame is out before the bundle's last record is made
