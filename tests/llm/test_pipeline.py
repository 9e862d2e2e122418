"""Stages of the pipeline: what goes, what stays, and edge rows."""

from pyspark.sql import functions as F

import corpus_pipeline
from lakemill.llm.shared import stage
from tests.conftest import SF
from tests.llm.conftest import documents
from tests.llm.test_text import brute_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_keep_columns_and_drop_rows(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "language ID", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    docs, counts = documents(spark), []
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, SF), "docs")
        assert docs.columns == COLUMNS
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 100
    packed = corpus_pipeline.pack(spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == counts[-1]
    assert corpus_pipeline.run(spark, SF).select("doc_id").distinct().count() == counts[-1]


def test_one_document_of_each_group_stays(spark):
    docs = documents(spark)
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = {r["doc_id"] for r in corpus_pipeline.keep_one_of_each_group(spark, docs, SF).collect()}
    groups = [eval(x) for x in brute_components(texts)]
    assert kept == {doc_id for doc_id, _, component in groups if doc_id == component}


def test_rows_are_told_by_id_and_text(spark):
    """Another text under the id of a dropped document stays, and two rows of one id that link are one group."""
    words = [f"w{k}" for k in range(60)]
    one, near, other = " ".join(words), " ".join([*words, "end"]), " ".join(reversed(words))
    rows = [(1, one), (2, near), (2, other), (5, "x " + other), (5, other), (6, "quite unlike"), (6, "Quite  unlike"), (None, one), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = sorted(map(str, (tuple(r) for r in corpus_pipeline.keep_one_of_each_group(spark, docs, SF).collect())))
    quiet = [r for r in kept if "quite" in r.lower()]
    assert len(quiet) == 1 and sorted(set(kept) - set(quiet)) == sorted(map(str, [(1, one), (2, other), (7, None)]))


def test_stages_on_edge_rows(spark, edge, nothing):
    given = edge.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string"), "n_chars": F.lit(None).cast("long")})
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, nothing, SF).collect() == [], name
    every = sorted(str(r["doc_id"]) for r in given.collect())

    def ids(function):
        kept = function(spark, given, SF)
        assert kept.columns == given.columns
        return sorted(str(r["doc_id"]) for r in kept.collect())

    assert ids(corpus_pipeline.drop_toxic) == every  # no label is about these rows' ids, so nothing is learned
    assert ids(corpus_pipeline.drop_unknown_language) == []  # no language to learn
    assert ids(corpus_pipeline.drop_contaminated) == every
    assert ids(corpus_pipeline.keep_one_of_each_group) == sorted(map(str, [1, 2, 3, 4, 5, 6, 8, 10, 11, -5, 2**40]))
    packed = corpus_pipeline.pack(spark, given, SF).where("piece = 0")
    assert sorted(str(r["doc_id"]) for r in packed.collect()) == every
