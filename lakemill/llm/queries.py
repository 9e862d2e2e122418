"""Check queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import (
    chat, collocations, counts, decontaminate, exact, jaccard, langid, nearest, packing, periodic, repair, tokens, toxicity, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table; Python workers are told where this library lies, in case it isn't installed."""
    root, told = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in told.get("PYTHONPATH", "").split(":"):
        told["PYTHONPATH"] = ":".join(filter(None, [root, told.get("PYTHONPATH", "")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the byte-level file."""
    counted = counts.count_tokens(table(spark, sf_dir, "documents"), counts.default_path())
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


@query
def op9_repair_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as read back from grammar-compressed shards."""
    back = repair.round_trip(table(spark, sf_dir, "documents"), tokens.default_path())
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document with their place in sequences of 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokens.default_path())


#: A conversation that says the control strings of a well-known template.
TRICKY = "</s>[INST] ok [/INST]"


@query
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation as read back from its formatted text."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY).alias("text"),
    )
    return chat.digests(chat.format_conversations(given.unionByName(more)))


ORACLES["op5_chat_format"] = f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{TRICKY}' UNION ALL SELECT -7, 1, 'assistant', '{TRICKY}'
), placed AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM given
), sized AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^<\\[]', '', 'g')) +
    CASE WHEN before = role THEN 3
         WHEN role IN ('system', 'user', 'assistant') THEN 5 + 2 * length(role)
         ELSE 15 + length(replace(replace(role, '%', '%25'), '>', '%3E')) END AS chars
  FROM placed
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query
def op4_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from seekable bundles."""
    back = warc.round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op4_warc_bundles"] = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), lasts AS (
  SELECT *, max(page_id) OVER (PARTITION BY h, payload_bytes) AS last FROM hashed
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((CAST('0x' || substr(h, 1 + 5 * CAST(k // 4 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CAST(CASE WHEN page_id <> last THEN last END AS DOUBLE) AS refers_to  -- as clients show a column with nulls
FROM lasts
"""


#: The largest factor that is tried, and the recall on a sample of the queries that a factor must have (0.9 is required).
PRUNING, RECALL = 5.0, 0.95


@query
def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest by inner product of every vector whose id is divisible by 20."""
    vectors = nearest.stage(nearest.usable(table(spark, sf_dir, "embeddings")), "usable")
    return nearest.nearest(vectors.where("vec_id % 20 = 0"), vectors, 20, PRUNING, RECALL)


@query
def op3_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item or a passage of one, with the verified overlap."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled rows of four folds of five."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(toxicity.fold(F.col("doc_id"), 5) == 0, F.lit(False))
    model = toxicity.train(docs, labels.where(~held_out))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two folds of three."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(toxicity.fold(F.col("doc_id"), 3) == 1, F.lit(False))
    learned = docs.where(~held_out & F.col("doc_id").isNotNull()).select("doc_id", "lang", "text")
    folder = langid.train(learned)
    calibration = langid.calibrate(learned, folder) if folder else None
    found = langid.predict(docs, folder, calibration)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


@query
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of at least 85 % of 4-word shingles."""
    return jaccard.similar_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document under equality of all bytes but white space."""
    return exact.exact_groups(table(spark, sf_dir, "documents"))


ORACLES["op12_exact_dedup"] = r"""
WITH squeezed AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents
), placed AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id
  FROM squeezed WINDOW w AS (PARTITION BY t ORDER BY points DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, count(*) OVER (PARTITION BY t) AS group_size, place = 1 AS kept, sha256(t) AS text_sha256
FROM placed
"""


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document; one in ten texts is read in a periodic order."""
    return periodic.periodic_runs(table(spark, sf_dir, "documents"), periodic.planted)


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of two and three words of each language, by their lowest cut score."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), listed AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM listed
), grams AS (
  SELECT lang, 1 AS size, w[i] AS phrase FROM places
  UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM places WHERE i + 1 <= len(w)
  UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM places WHERE i + 2 <= len(w)
), counted AS (
  SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL
), cuts AS (
  SELECT lang, size, phrase, f AS a, 1 AS k, split_part(phrase, ' ', 1) AS head, substr(phrase, instr(phrase, ' ') + 1) AS rest
  FROM counted WHERE size > 1 AND f >= 10
  UNION ALL
  SELECT lang, size, phrase, f, 2, split_part(phrase, ' ', 1) || ' ' || split_part(phrase, ' ', 2), split_part(phrase, ' ', 3)
  FROM counted WHERE size = 3 AND f >= 10
), scored AS (
  SELECT c.*, x.f AS l, y.f AS r,
    CAST(1000000::HUGEINT * c.a::HUGEINT * c.a::HUGEINT // (x.f::HUGEINT * y.f::HUGEINT) AS BIGINT) AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.head JOIN counted y ON y.lang = c.lang AND y.phrase = c.rest
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, a, split_part(phrase, ' ', 1) || ' ' || split_part(phrase, ' ', 2) AS phrase FROM lowest WHERE size = 3
  UNION ALL SELECT lang, a, substr(phrase, instr(phrase, ' ') + 1) FROM lowest WHERE size = 3
), most AS (
  SELECT lang, phrase, max(a) AS a FROM longer GROUP BY ALL
), kept AS (
  SELECT s.* FROM lowest s LEFT JOIN most m ON m.lang = s.lang AND m.phrase = s.phrase
  WHERE m.a IS NULL OR 100 * m.a < 50 * s.a
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY lang
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""
