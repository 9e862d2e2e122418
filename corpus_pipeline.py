"""Corpus pipeline: documents to packed sequences, in stages that each take what their predecessor kept.

A stage is a function (spark, docs, sf_dir) -> DataFrame. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import decontaminate, jaccard, langid, packing, tokens, toxicity
from lakemill.llm.queries import table
from lakemill.llm.shared import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine doesn't call toxic. It learns from four folds of five.

    Null, empty and repeated texts are scored like others (an empty one by the bias alone); a null id is never learned
    from. Without both labels nothing is dropped.
    """
    labels = table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(toxicity.fold(F.col("doc_id"), 5) != 0))
    return toxicity.keep_clean(docs, model)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the character models accept. They learn from two folds of three.

    Null and empty texts and texts without a letter go; repeated rows are judged alike. Without a text to learn from no
    document is accepted.
    """
    learned = docs.where(toxicity.fold(F.col("doc_id"), 3) != 1).select("doc_id", "lang", "text")
    folder = langid.train(learned)
    return langid.keep_known(docs, folder, langid.calibrate(learned, folder) if folder else None)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest doc_id (null last); of repeated rows one.

    Rows are told by id and text: another text under a dropped document's id stays, and so do texts without words.
    """
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item and no passage of one. Null and empty texts stay."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left with their place in sequences of 4096 tokens. Null texts are empty ones."""
    return packing.pack_documents(docs, tokens.default_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", drop_unknown_language),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

#: Learned models and tokenizers decide; SQL can't express them. The tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each result written and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, f"stage-{number}")
    return docs
