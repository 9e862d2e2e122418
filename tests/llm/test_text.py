"""Toxicity, language identification, the Jaccard join and decontamination on small tables."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakemill.llm import decontaminate, jaccard, langid, queries, toxicity
from tests.conftest import SF
from tests.llm.conftest import EDGE, documents

SF_MIDDLE = "/root/testdata/sf0.01"


def test_toxicity_held_out_accuracy(spark):
    scored = queries.op1_toxicity(spark, SF_MIDDLE)
    labels = queries.table(spark, SF_MIDDLE, "labels").where("toxic IS NOT NULL")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert scored.count() == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["predicted"] == r["toxic"] for r in rows) / len(rows) > 0.9
    assert sum(r["predicted"] for r in rows if r["toxic"] == 0) == 0


def test_toxicity_of_pairs():
    """Two terms that are harmless alone and toxic together: the linear part alone can't tell."""
    rng = random.Random(0)
    rows, numbers, labels = [], [], []
    for k in range(2000):
        has = rng.choice([(0,), (1,), (0, 1), ()])
        rows += [k] * len(has)
        numbers += has
        labels.append(float(len(has) == 2))
    model = toxicity.fit(np.array(rows), np.array(numbers), np.array(labels), np.arange(2, dtype=np.uint64))
    value, _ = toxicity.margins(np.array([0, 1, 2, 2]), np.array([0, 1, 0, 1]), 4, model.bias, model.weight, model.factor)
    assert (value > 0).tolist() == [False, False, True, False]


def test_toxicity_edges(spark, edge, nothing):
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (6, None), (8, 0), (8, 1)], "doc_id long, toxic int")
    model = toxicity.train(edge, labels)
    got = toxicity.score(edge, model).collect()
    assert len(got) == len(EDGE) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.train(nothing, labels) is None
    assert toxicity.train(edge, labels.limit(0)) is None
    assert toxicity.score(nothing, model).collect() == []
    assert {r["score"] for r in toxicity.score(edge, None).collect()} == {0.0}
    kept = toxicity.keep_clean(edge, None)
    assert kept.columns == edge.columns and kept.count() == len(EDGE)


def test_language_held_out_accuracy(spark):
    rows = queries.op7_language_id(spark, SF_MIDDLE).join(queries.table(spark, SF_MIDDLE, "documents"), "doc_id")
    rows = rows.where("held_out AND lang IS NOT NULL").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97
    assert sum(not r["accepted"] for r in rows) <= len(rows) // 100


def kneser_ney(counts, gram, alphabet):
    """Interpolated probability of a gram's last letter, straight from the definition."""
    if not gram:
        return 1 / alphabet
    order = len(gram)
    own = counts[order]
    total = sum(n for g, n in own.items() if g[:-1] == gram[:-1])
    lower = kneser_ney(counts, gram[1:], alphabet)
    if not total:
        return lower
    once, twice = (sum(n == k for n in own.values()) for k in (1, 2))
    d = max(0.1, min(0.95, once / (once + 2 * twice))) if once + twice else 0.1
    kinds = sum(g[:-1] == gram[:-1] for g in own)
    return max(own.get(gram, 0) - d, 0) / total + d * kinds / total * lower


def test_language_model_is_kneser_ney(spark):
    texts = ["abba abac", "baba cab abba", "ca"]
    folder = langid.train(spark.createDataFrame([("x", t) for t in texts], "lang string, text string"))
    counts = {langid.ORDER: {}}
    for word in " ".join(texts).split():
        padded = langid.PAD * (langid.ORDER - 1) + word + langid.END
        for k in range(len(padded) - langid.ORDER + 1):
            gram = padded[k : k + langid.ORDER]
            counts[langid.ORDER][gram] = counts[langid.ORDER].get(gram, 0) + 1
    for order in range(langid.ORDER - 1, 0, -1):
        counts[order] = {}
        for gram in counts[order + 1]:
            counts[order][gram[1:]] = counts[order].get(gram[1:], 0) + 1
    models = langid.Models(folder)
    for text in ("abba", "cabz", "zz"):
        padded = langid.PAD * (langid.ORDER - 1) + text + langid.END
        grams = [padded[k : k + langid.ORDER] for k in range(len(padded) - langid.ORDER + 1)]
        want = -sum(np.log(kneser_ney(counts, g, models.alphabet)) for g in grams) / len(grams)
        assert models.entropies(pa.array([text]))[0][0, 0] == pytest.approx(want, rel=1e-4)


def test_language_model_keeps_all_grams_in_several_files(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_GRAMS", 8, raising=False)
    monkeypatch.setattr(langid, "RANGE_GRAMS", 4, raising=False)
    texts = {"x": ["abba abac", "baba cab abba", "ca"], "y": ["a"], "": ["zyx zyx"]}
    folder = langid.train(spark.createDataFrame([(k, t) for k, v in texts.items() for t in v], "lang string, text string"))
    models = langid.Models(folder)
    assert models.langs == ["", "x", "y"]
    for number, lang in enumerate(models.langs):
        counts = {langid.ORDER: {}}
        for word in " ".join(texts[lang]).split():
            padded = langid.PAD * (langid.ORDER - 1) + word + langid.END
            for k in range(len(padded) - langid.ORDER + 1):
                gram = padded[k : k + langid.ORDER]
                counts[langid.ORDER][gram] = counts[langid.ORDER].get(gram, 0) + 1
        for order in range(langid.ORDER - 1, 0, -1):
            counts[order] = {}
            for gram in counts[order + 1]:
                counts[order][gram[1:]] = counts[order].get(gram[1:], 0) + 1
        for text in ("abba", "abac", "cabz", "zyx", "q"):
            padded = langid.PAD * (langid.ORDER - 1) + text + langid.END
            grams = [padded[k : k + langid.ORDER] for k in range(len(padded) - langid.ORDER + 1)]
            want = -sum(np.log(kneser_ney(counts, g, models.alphabet)) for g in grams) / len(grams)
            assert models.entropies(pa.array([text]))[0][0, number] == pytest.approx(want, rel=1e-4)
    assert len(models.parts[1]) > 2 and len(models.opened) > 4


def test_language_edges(spark, edge, nothing):
    learned = spark.createDataFrame([(1, "en", "the and of"), (2, "fr", "le la de"), (3, None, "x"), (4, "en", None)], "doc_id long, lang string, text string")
    folder = langid.train(learned)
    calibration = langid.calibrate(learned, folder)
    got = {r["doc_id"]: r for r in langid.predict(edge, folder, calibration).collect()}
    assert all(got[i]["lang_pred"] == langid.UNKNOWN and not got[i]["accepted"] for i in (1, 2, 3, 11, -5))
    assert got[4]["lang_pred"] in ("en", "fr")
    assert langid.predict(nothing, folder, calibration).collect() == []
    assert langid.train(nothing) is None and langid.keep_known(edge, None, None).count() == 0
    assert {r["lang_pred"] for r in langid.predict(edge, None, None).collect()} == {langid.UNKNOWN}


def brute_components(texts):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets.append({tuple(words[k : k + 4]) for k in range(len(words) - 3)} if len(words) >= 4 else {tuple(words)} - {()})
    parent = list(range(len(texts)))

    def top(k):
        return k if parent[k] == k else top(parent[k])

    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * len(sets[a] | sets[b]):
                parent[top(a)] = top(b)
    least = {}
    for k, (doc_id, _) in enumerate(texts):
        if doc_id is not None:
            least[top(k)] = min(doc_id, least.get(top(k), doc_id))
    return sorted(str((doc_id, len(sets[k]), least.get(top(k)))) for k, (doc_id, _) in enumerate(texts))


def components(df):
    rows = jaccard.similar_groups(df).collect()
    return sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in rows)


def test_jaccard_edges(edge, nothing):
    assert components(edge) == brute_components(EDGE)
    assert components(nothing) == []


def test_jaccard_equals_brute_force(spark):
    """Chains, near misses, many similar copies, and a passage that many texts share."""
    rng = random.Random(2)
    passage, texts = [f"p{k}" for k in range(12)], []
    for group in range(25):
        base = [f"{group}-{k}" for k in range(rng.choice([5, 30, 80]))]
        for _ in range(rng.choice([1, 4, 25])):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 3])):
                words[rng.randrange(len(words))] = f"new{rng.random()}"
            if rng.random() < 0.3:
                words += passage
            texts.append((len(texts) * 3 % 1009, " ".join(words)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert components(df) == brute_components(texts)
    small = documents(spark).select("doc_id", "text")
    assert components(small) == brute_components([tuple(r) for r in small.collect()])


def test_prefixes_never_lose_a_link():
    """Sets at the threshold share a prefix token under every order, whatever the classes are."""
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(1, 120))
        one = rng.integers(0, 1 << 62, n).astype(np.uint64)
        other = one.copy()
        while True:
            other[rng.integers(n)] = rng.integers(0, 1 << 62)
            common = len(np.intersect1d(one, other))
            if 100 * common < 85 * (2 * n - common):
                break
            classes = rng.integers(0, 4, jaccard.SKETCH).astype(np.uint8)
            frequent = rng.random(jaccard.BLOOM) < 0.3
            for order in range(jaccard.ORDERS):
                a, b = (jaccard.prefix(np.unique(s), classes, frequent, order) for s in (one, other))
                assert len(np.intersect1d(a, b))


def test_decontamination_edges(spark, edge, nothing):
    items = [(1, "a b c d e f"), (2, None), (3, ""), (4, "a b"), (None, "one two three four five six"), (5, "A, b; c. D e F!")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS score")
    got = sorted((r["doc_id"] or 0, r["item_id"]) for r in decontaminate.contaminated(edge, benchmark).collect())
    assert got == [(0, 1), (0, 5), (8, 1), (8, 1), (8, 5), (8, 5), (9, 1), (9, 5)]
    kept = decontaminate.decontaminate(edge, benchmark)
    assert kept.columns == edge.columns and kept.count() == len(EDGE) - 4
    assert decontaminate.contaminated(nothing, benchmark).collect() == []
    assert decontaminate.contaminated(edge, benchmark.limit(0)).collect() == []
    assert decontaminate.decontaminate(edge, benchmark.limit(0)).count() == len(EDGE)


def test_decontamination_equals_brute_force_and_tolerates_substitutions(spark):
    rng, items = random.Random(4), []
    for r in queries.table(spark, SF, "benchmark").collect():
        items.append((r["item_id"], re.findall(r"[^\W_]+", r["text"].lower())))
    texts = [re.findall(r"[^\W_]+", r["text"].lower()) for r in documents(spark).collect()]
    index = decontaminate.Index([i for i, _ in items], [" ".join(w) for _, w in items])
    found = {(row, item) for row, item, *_ in index.overlaps(pa.array([" ".join(t) for t in texts]))}
    grams = {}
    for k, (_, w) in enumerate(items):
        for a in range(len(w) - 12):
            grams.setdefault(tuple(w[a : a + 13]), set()).add(k)
    want = {(row, k) for row, t in enumerate(texts) for a in range(len(t) - 12) for k in grams.get(tuple(t[a : a + 13]), ())}
    assert want <= found
    changed = []
    for k, (_, w) in enumerate(items):
        spots = set(rng.sample(range(len(w)), len(w) // 12))
        changed.append("before it " + " ".join("zzz" if j in spots else x for j, x in enumerate(w)) + " after it")
    hit = {(row, item) for row, item, *_ in index.overlaps(pa.array(changed))}
    assert sum((k, k) in hit for k in range(len(items))) >= 0.95 * len(items)


def substituted(words, spots):
    return " ".join(["before", "it", *("zzz" if j in spots else x for j, x in enumerate(words)), "after", "it"])


def test_a_copy_with_one_changed_word_is_found_wherever_that_is():
    for size in range(12, 31):
        words = [f"w{j}" for j in range(size)]
        index = decontaminate.Index([1], [" ".join(words)])
        texts = pa.array([substituted(words, {j}) for j in range(size)])
        assert [row for row, *_ in index.overlaps(texts)] == list(range(size)), size


def test_verification_of_substitutions_equals_brute_force():
    rng, missed, several = random.Random(5), 0, 0
    for size in range(8, 41):
        words = [f"w{j}" for j in range(size)]
        index = decontaminate.Index([1], [" ".join(words)])
        for changes in range(1, size // 5 + 1):
            several += 20
            for _ in range(20):
                spots = rng.sample(range(size), changes)
                same = np.array([j not in spots for j in range(size)])
                enough = min(decontaminate.LEAST_WORDS, decontaminate.LEAST_SHARE * size)
                assert same.sum() >= enough  # of the whole item
                text = index.key.copy()
                text[~same] = 0
                begin, own, words_n, equal = index.verify(text, 0, 0)
                assert begin == own and equal == same[own : own + words_n].sum() >= enough and 10 * equal >= 8 * words_n
                missed += not list(index.overlaps(pa.array([substituted(words, spots)])))
        for _ in range(200):
            same = np.array([rng.random() < 0.75 for _ in range(size)])
            text = np.where(same, index.key, 0).astype(np.uint64)
            want = any(
                same[a:b].sum() >= enough and 10 * same[a:b].sum() >= 8 * (b - a) for a in range(size) for b in range(a, size + 1)
            )
            assert (index.verify(text, 0, 0) is not None) == want
    assert missed <= 0.08 * several, missed / several  # by the seeds


def test_blocks_of_the_benchmark_give_the_same(spark):
    docs, benchmark = documents(spark), queries.table(spark, SF, "benchmark")
    whole, parts = (decontaminate.contaminated(docs, benchmark, n) for n in (1 << 20, 200))
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))


def test_repeated_ids_do_not_add_to_the_samples(spark):
    """One id with many rows is one row of the sample; so is each id of the calibration."""
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    labels = spark.createDataFrame([(7, 1)], "doc_id long, toxic int")
    assert [r["text"] for r in toxicity.sample(docs, labels, 10).collect()] == ["text 0"]
    learned = docs.withColumn("lang", F.lit("en"))
    folder = langid.train(learned)
    assert langid.calibrate(learned, folder, 10).mean.keys() == {"en"}


def test_training_texts_without_letters(spark):
    """Nothing to calibrate with: no document is accepted, and none fails."""
    rows = spark.createDataFrame([(1, "en", "— … €"), (2, "de", "€ €")], "doc_id long, lang string, text string")
    folder = langid.train(rows)
    calibration = langid.calibrate(rows, folder) if folder else None
    assert calibration is None
    assert {r["lang_pred"] for r in langid.predict(rows, folder, calibration).collect()} == {"und"}
    assert langid.keep_known(rows, folder, calibration).collect() == []


def test_margins_are_the_plain_sum_over_pairs():
    """The machine's value from its sums of squares equals the sum over all pairs of a text's terms."""
    rng = np.random.default_rng(4)
    weight, factor = rng.normal(size=9).astype(np.float32), rng.normal(size=(9, 4)).astype(np.float32)
    texts = [sorted(rng.choice(9, size=k, replace=False).tolist()) for k in (0, 1, 2, 5, 9)]
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    value, _ = toxicity.margins(row, np.concatenate(texts).astype(np.int64), len(texts), 0.3, weight, factor)
    for k, terms in enumerate(texts):
        pairs = sum(float(factor[i] @ factor[j]) for n, i in enumerate(terms) for j in terms[n + 1 :])
        assert np.isclose(value[k], 0.3 + sum(weight[i] for i in terms) + pairs, atol=1e-4)


def test_low_complexity_texts_give_as_many_pairs_as_lanes():
    """Runs of equal words on both sides: every lane is hit, each only about once a mask."""
    rng = random.Random(2)
    for _ in range(30):
        items = [" ".join(rng.choice(["x"] * 12 + ["x y"] * 6 + [f"w{k}" for k in range(6)]).split() * rng.randrange(1, 20)) for _ in range(3)]
        items += [" ".join(rng.choices(["a", "a", "a", "b"], k=rng.randrange(5, 40)))]
        index = decontaminate.Index(list(range(4)), items)
        words = [w for _ in range(6) for w in rng.choice(["x", "x y", "a", "a b a", "w1 w2"]).split() * rng.randrange(1, 15)]
        _, _, row, key = next(iter(decontaminate.documents(decontaminate.normalised(pa.array([" ".join(words)])), decontaminate.NOT_ALNUM)))
        here, there = index.hits(row, key)
        want = set()
        for mask in index.masks:
            own, own_place = decontaminate.seeds(row, key, mask)
            value, place = decontaminate.seeds(index.row, index.key, mask)
            fits = index.length[index.row[place]] >= 5 if mask in decontaminate.MASKS else index.length[index.row[place]] == len(mask)
            want |= {(int(index.row[q]), int(p - q)) for v, p in zip(own, own_place) for u, q in zip(value[fits], place[fits]) if u == v}
        assert {(int(index.row[q]), int(p - q)) for p, q in zip(here, there)} == want
    index = decontaminate.Index([1], ["same " * 200])
    _, _, row, key = next(iter(decontaminate.documents(decontaminate.normalised(pa.array(["same " * 8000])), decontaminate.NOT_ALNUM)))
    assert len(index.hits(row, key)[0]) < 5 * (8000 + 200)


def test_signatures_bound_the_difference():
    rng = np.random.default_rng(8)
    for n in (1, 5, 100, 1000, 5000):
        base = rng.integers(0, 1 << 63, n).astype(np.uint64)
        for changed in {0, 1, n // 10, n // 2, n}:
            other = np.concatenate([base[changed:], rng.integers(0, 1 << 63, changed).astype(np.uint64)])
            bits = np.unpackbits((jaccard.signature(np.unique(base)) ^ jaccard.signature(np.unique(other))).view(np.uint8)).sum()
            assert bits <= len(np.setxor1d(base, other))


def test_family_just_below_the_threshold(spark):
    """400 texts of one family, 70 to 90 % alike in steps: links and components as by brute force."""
    rng = random.Random(11)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(400):
        own = list(base)
        for at in rng.sample(range(0, 120, 4), rng.choice([1, 2, 3, 4, 6, 8])):
            own[at] = f"x{k % 40}-{at}"
        rows.append((k, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in jaccard.similar_groups(df).collect())
    assert got == sorted(brute_components(rows))


def test_calibration_takes_every_training_row(spark):
    """Figures equal those of all rows, and the stage keeps a training text however many others come before it by hash."""
    import corpus_pipeline

    ids = spark.range(31_000).select(F.col("id").alias("doc_id"))
    learned = ids.where(toxicity.fold(F.col("doc_id"), 3) != 1)
    last = learned.orderBy(F.xxhash64("doc_id").desc()).first()["doc_id"]
    rng = random.Random(5)
    odd = " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(9)) for _ in range(60))
    text = F.when(F.col("doc_id") == last, odd).when(F.col("doc_id") % 2 == 0, "the cat and the dog").otherwise("a dog")
    docs = ids.withColumns({"lang": F.lit("en"), "text": text})
    rows = docs.join(learned, "doc_id").select("doc_id", "lang", "text")
    folder = langid.train(rows)
    got = langid.calibrate(rows, folder)
    number = {r["text"]: r["count"] for r in rows.groupBy("text").count().collect()}
    assert number[odd] == 1 and sum(number.values()) > 20_000
    entropy, size = langid.Models(folder).entropies(pa.array(list(number)))
    mean = np.average(entropy[:, 0], weights=list(number.values()))
    assert got.mean["en"] == pytest.approx(mean, rel=1e-9)
    assert got.limit["en"] == pytest.approx(langid.SLACK * langid.deviation(entropy[:, 0], size, mean).max(), rel=1e-9)
    assert corpus_pipeline.drop_unknown_language(spark, docs, SF).count() == 31_000


def test_pieces_of_a_batch_hold_each_row_once(monkeypatch):
    monkeypatch.setattr(langid, "PIECE", 10)
    for texts in ([], [None], ["x" * 50], ["abcd", None, "", "x" * 30, "ab", "cd", "efghij", "é" * 5, ""]):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["n", "text"])
        found = list(langid.pieces(batch, 1))
        assert [n for part in found for n in part.column(0).to_pylist()] == list(range(len(texts)))
        assert all(sum(len((x or "").encode()) for x in part.column(1).to_pylist()) <= 10 or len(part) == 1 for part in found)


def test_pivots_lie_amid_a_family(spark):
    """Of 30 nodes that share a token, the one that shares another one with each of them is compared with all, in the first turn."""
    hub = 29
    rows = [(1, k, 100, 100, k) for k in range(30)]
    rows += [(100 + k, node, 100, 100, node) for k in range(hub) for node in (k, hub)]
    own = spark.createDataFrame(rows, "token long, node long, n long, left long, comp long")
    many = own.groupBy("token").agg(F.count(F.lit(1)).alias("many"))
    weights = own.join(many, "token").groupBy("node").agg(F.sum("many").alias("weight"))
    of_all = own.where("token = 1")
    first, second = ({tuple(r) for r in jaccard._with_pivots(of_all, weights, turn).collect()} for turn in (0, 1))
    assert {(k, hub) for k in range(hub)} <= first and len({x for pair in first for x in pair}) == 30
    assert all({hub, 0, 1, 2} & set(pair) for pair in first) and all({3, 4, 5, 6} & set(pair) for pair in second)
    assert len(first) <= 4 * 29 and len(second) <= 4 * 29


def test_one_order_is_dealt_out():
    """Blocks hold prefix tokens of the first order alone; for counting, tokens and a part of each node's hash."""
    from types import SimpleNamespace

    texts = [" ".join(f"w{k}-{n}" for n in range(40)) for k in range(50)]
    classes = SimpleNamespace(value=np.zeros(jaccard.SKETCH, np.uint8))
    frequent = SimpleNamespace(value=bytes(jaccard.BLOOM // 8))
    for last, names in ((None, ["tokens", "nodes"]), (frequent, ["tokens", "nodes", "sizes", "places"])):
        batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
        blocks = list(jaccard._prefixes(classes, last, 4, iter([batch])))
        assert all(b.schema.names == ["part", *names] for b in blocks)
        tokens = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for b in blocks for x in b.column(1)])
        assert len(tokens) == 50 * jaccard.prefix_length(37) and not (tokens % np.uint64(jaccard.ORDERS)).any()


def test_workers_let_go_of_other_operators_caches():
    from lakemill.llm import shared

    shared.own_cache("one")["x"] = 1
    assert shared.own_cache("one") == {"x": 1}
    shared.own_cache("other")["y"] = 2
    assert shared.own_cache("one") == {} and shared.own_cache("other") == {}


def test_rows_without_partner_are_left_out(monkeypatch):
    """Of a token's rows those stay that sizes and places allow to link with another; rows of frequent tokens all stay."""
    monkeypatch.setattr(jaccard, "COMPARED", 12)
    rng = np.random.default_rng(4)
    many = rng.choice([1, 2, 3, 5, 12, 13], 300)
    token = np.repeat(np.arange(300, dtype=np.uint64), many)
    size = rng.integers(50, 120, len(token))
    left = size - rng.integers(0, 18, len(token))
    keep = jaccard.partnered(np.repeat(many, many), token, size, left)
    for k, n in enumerate(many):
        rows = [(s, r, x) for s, r, x in zip(size[token == k].tolist(), left[token == k].tolist(), keep[token == k], strict=True)]
        for at, (s, r, x) in enumerate(rows):
            fit = [100 * min(s, t) >= 85 * max(s, t) and 185 * min(r, q) >= 85 * (s + t) for i, (t, q, _) in enumerate(rows) if i != at]
            assert x == (any(fit) or n > 12)


def test_only_sets_of_pairs_are_kept(spark, monkeypatch):
    """Texts that share one rare passage and else nothing: neither their whole sets nor all rows of the shared tokens are stored."""
    rng = random.Random(6)
    rows = []
    for k in range(120):
        passage = " ".join(f"p{k // 4}-{n}" for n in range(6))
        rows.append((k, passage + " " + " ".join(f"w{rng.random()}" for _ in range(60 + 40 * (k % 4)))))
    rows += [(500, rows[0][1] + " end"), (None, rows[7][1] + " end"), (None, rows[7][1] + " ends"), (3, rows[3][1])]
    stored, stage = {}, jaccard.stage

    def counted(df, name):
        found = stage(df, name)
        stored.setdefault(name, []).append(found)
        return found

    monkeypatch.setattr(jaccard, "stage", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in jaccard.similar_groups(df).collect()]
    assert sorted(got) == sorted(brute_components(rows))
    assert sum(x.count() for x in stored["sets"]) < 20
    assert stored["shared"][0].select("node").distinct().count() < 20
