"""Jaccard join of word shingles: prefix filters under several global token orders.

A text's set holds the distinct SHINGLE-word shingles of its words as 64-bit hashes. Two sets of at least 85 % Jaccard
similarity must share a token among the first n - ceil(0.85 n) + 1 of each, under any order of the tokens that all texts
agree on. Here there are ORDERS such orders, each by another hash, and in all of them tokens that a sketch of the whole
corpus shows to be frequent come last; in the first order also those that a first pass over the prefixes shows to be.
Nodes meet by the prefix tokens of the first order. Their sizes, the tokens that come before the shared one, a shared
prefix token in every other order, and bit signatures of the whole sets must allow the similarity; only then are whole
sets compared.

Equal sets are one node, named by a 64-bit hash of the set, so copies cost nothing. Links are followed to components:
first each token's nodes are compared with the PIVOTS of them that share most, and what that joins needs no further
comparison; then, as long as that joins more, with the next ones; at last all pairs that still lie in different
components and pass the filters. No link between different components is left out. With d distinct sets, hashes join two by mistake with a
chance of d^2 / 2^65.

Defined results: null texts and texts without words have the empty set and link with nothing; texts of fewer than
SHINGLE words have their whole sequence as one shingle; repeated rows belong to one component; rows with a null doc_id
get the component's id like others (null if they are alone). Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakemill.llm.shared import own_cache, stage
from lakemill.llm.words import LOWER_AZ, WHITE, documents, mix, ranges, runs

# Freed Arrow memory goes back to the system: workers live long, and their batches vary much in size.
pa.set_memory_pool(pa.system_memory_pool())

SHINGLE, PERCENT, ORDERS = 4, 85, 2  # ORDERS: a power of two
#: Buckets of the corpus sketch, in rows of CHUNK; its size is fixed, so it may be broadcast.
SKETCH, CHUNK = 1 << 21, 1 << 16
#: Bits of the filters of frequent tokens and of the sets that comparisons need; fixed as well.
BLOOM = 1 << 24
#: Tokens that a task gathers before it hands on a block, and nodes it remembers to leave out copies.
HELD_TOKENS, HELD_NODES = 1 << 17, 1 << 17
#: Nodes, and shingles of them, whose sets or traits a task hands on in one block.
BLOCK_NODES, BLOCK_SHINGLES = 256, 1 << 19
#: A token in the prefixes of more nodes is frequent.
FREQUENT = 8
#: 64-bit words of a set's signature: bit p tells whether an odd number of its shingles have p as their first 9 bits (11
#: in the fine one, which is only taken to pairs).
SIGNATURE, FINE = 8, 32
#: Rounds with PIVOTS nodes per token before all pairs are compared; they end early when links get rarer than one in RARER.
ROUNDS, PIVOTS, RARER = 3, 4, 20
#: Rows of a token among which those that can link with none are looked for; those of more frequent tokens all stay.
COMPARED = 64
#: Prefix tokens that one part of the join holds, on average, and rows that reach a Python worker at once.
PART_TOKENS, BATCH_ROWS = 1 << 20, 64


def sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingles of each text of a batch that has words."""
    for first, _, row, key in documents(texts, WHITE, LOWER_AZ):
        if not len(row):
            continue
        grams = np.zeros(max(0, len(key) - SHINGLE + 1), np.uint64)
        for k in range(SHINGLE):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + key[k : k + len(grams)]
        grams = mix(grams)
        begin = runs(row)
        for low, high in zip(begin.tolist(), np.append(begin[1:], len(row)).tolist(), strict=True):
            if high - low >= SHINGLE:
                yield first + int(row[low]), np.unique(grams[low : high - SHINGLE + 1])
            else:
                value = np.zeros(1, np.uint64)
                for word in key[low:high]:
                    value = value * np.uint64(0x9E3779B97F4A7C15) + word
                yield first + int(row[low]), mix(value + np.uint64(high - low))


def node_of(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64))


def signature(shingles: np.ndarray, words: int = SIGNATURE) -> np.ndarray:
    odd = np.bincount((shingles >> np.uint64(65 - (64 * words).bit_length())).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prefix_length(size: int) -> int:
    return size - -(-PERCENT * size // 100) + 1


def bloom_places(keys: np.ndarray) -> tuple[np.ndarray, ...]:
    mixed = mix(keys.view(np.uint64))
    return tuple((mixed >> np.uint64(shift) & np.uint64(BLOOM - 1)).astype(np.int64) for shift in (0, 20, 40))


def prefix(shingles: np.ndarray, classes: np.ndarray, frequent: np.ndarray | None, order: int) -> np.ndarray:
    """The first tokens of a set under an order, in that order, as tokens whose lowest bits tell the order.

    Tokens in the filter of frequent tokens come last, before them those of higher classes; the rest is hash order.
    """
    token = mix(shingles + np.uint64((order + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1))
    token += np.uint64(order) - token % np.uint64(ORDERS)
    length = prefix_length(len(token))
    rank = classes[shingles & np.uint64(SKETCH - 1)].astype(np.uint64) << np.uint64(56) | token >> np.uint64(8)
    if frequent is not None:
        one, two, three = bloom_places(token)
        rank |= (frequent[one] & frequent[two] & frequent[three]).astype(np.uint64) << np.uint64(63)
    if length < len(token):
        first = np.argpartition(rank, length - 1)[:length]
        token, rank = token[first], rank[first]
    return token[np.lexsort((token, rank))]


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and node of each text; at the end the task's part of the sketch, counts up to 255 by bucket."""
    own_cache("jaccard")
    sketch = np.zeros(SKETCH, np.int64)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("chunk", pa.int32()), ("counts", pa.binary())])
    for batch in batches:
        size, node = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
        held, waiting = [], 0
        for row, shingles in sets(batch.column(1)):
            size[row], node[row] = len(shingles), node_of(shingles)
            held.append(shingles)
            waiting += len(shingles)
            if waiting > HELD_TOKENS:
                sketch += np.bincount((np.concatenate(held) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
                held, waiting = [], 0
        if held:
            sketch += np.bincount((np.concatenate(held) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        columns = [batch.column(0), pa.array(size), pa.array(node, mask=size == 0)]
        nothing = [pa.nulls(len(batch), pa.int32()), pa.nulls(len(batch), pa.binary())]
        yield pa.RecordBatch.from_arrays([*columns, *nothing], schema=schema)
    rows = np.minimum(sketch, 255).astype(np.uint8).reshape(-1, CHUNK)
    used = [k for k in range(len(rows)) if rows[k].any()]
    if used:
        empty = [pa.nulls(len(used), pa.int64())] * 3
        counts = pa.array([rows[k].tobytes() for k in used], pa.binary())
        yield pa.RecordBatch.from_arrays([*empty, pa.array(used, pa.int32()), counts], schema=schema)


def _sum_chunk(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(x, np.uint8).astype(np.uint32) for x in rows["counts"]], axis=0, dtype=np.uint32)
    return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "counts": [total.tobytes()]})


def frequency_classes(sized: DataFrame) -> np.ndarray:
    """How far each bucket of the sketch lies above the mean, by powers of two: SKETCH bytes."""
    chunks = sized.where("chunk IS NOT NULL").select("chunk", "counts")
    sketch = np.zeros(SKETCH)
    for row in chunks.groupBy("chunk").applyInPandas(_sum_chunk, "chunk int, counts binary").collect():
        sketch[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["counts"], np.uint32)
    usual = 2 * max(1.0, float(sketch.mean())) + 2
    return np.floor(np.log2(np.maximum(sketch / usual, 1))).astype(np.uint8)


def _blocks(parts: int, held: list[tuple[int, int, np.ndarray]], counting: bool) -> pa.RecordBatch:
    """Prefix tokens of some nodes, in blocks by part: tokens with the node of each and, unless they are only counted,
    its size and the token's place in its order. For counting a part of the node's hash will do."""
    node, size, tokens = (list(x) for x in zip(*held, strict=True))
    many = np.array([len(x) for x in tokens])
    token = np.concatenate(tokens)
    part = (mix(token) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    node = np.repeat(np.array(node, np.int64), many)
    columns = [token, node.astype(np.uint32) if counting else node]
    if not counting:
        place = ranges(np.zeros(len(many), np.int64), many).astype(np.int32)
        columns += [np.repeat(np.array(size, np.int32), many), place]
    part = part[order]
    begin = runs(part)
    end = np.append(begin[1:], len(part))
    made = [pa.array(part[begin])]
    for values in (x[order] for x in columns):
        made.append(pa.array([values[a:b].tobytes() for a, b in zip(begin, end, strict=True)], pa.binary()))
    return pa.RecordBatch.from_arrays(made, names=["part", *BLOCK[: len(columns)]])


BLOCK = ("tokens", "nodes", "sizes", "places")


def _prefixes(classes: Broadcast, frequent: Broadcast | None, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix tokens of the first order, in blocks by part; without ``frequent`` only for counting."""
    own_cache("jaccard")
    held: list[tuple[int, int, np.ndarray]] = []
    seen: set[int] = set()
    waiting = 0
    last = None if frequent is None else unpacked(frequent.value)
    for batch in batches:
        for _, shingles in sets(batch.column(0)):
            node = node_of(shingles)
            if node in seen:
                continue
            if len(seen) < HELD_NODES:
                seen.add(node)
            held.append((node, len(shingles), prefix(shingles, classes.value, last, 0)))
            waiting += len(held[-1][2])
            if waiting > HELD_TOKENS:
                yield _blocks(parts, held, frequent is None)
                held, waiting = [], 0
    if held:
        yield _blocks(parts, held, frequent is None)


def unpacked(bits: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8)).view(bool)


def _gathered(batches: Iterator[pa.RecordBatch], kinds: tuple[type, ...]) -> tuple[np.ndarray, ...] | None:
    """Token, number of its nodes, node and what else there is, sorted and distinct, of a partition's blocks."""
    held: tuple[list, ...] = tuple([] for _ in kinds)
    for batch in batches:
        for k, kind in enumerate(kinds):
            held[k].extend(np.frombuffer(x.as_buffer(), kind) for x in batch.column(k + 1))
    if not held[0]:
        return None
    token, node, *more = map(np.concatenate, held)
    order = np.lexsort((node, token))
    token, node = token[order], node[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
    token, node = token[new], node[new]
    many = np.diff(np.append(runs(token), len(token)))
    return token, np.repeat(many, many), node, *(x[order][new] for x in more)


def partnered(many: np.ndarray, token: np.ndarray, size: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Which rows, sorted by token, have one of the same token that sizes and places allow them to link with (``sizes_allow``).

    Tokens that more than COMPARED nodes have aren't looked into: all their rows count.
    """
    keep = many > COMPARED
    one = np.flatnonzero((many > 1) & ~keep)
    for step in range(1, COMPARED):
        one = one[one + step < len(token)]
        one = one[token[one] == token[one + step]]
        if not len(one):
            break
        other = one + step
        small, large = np.minimum(size[one], size[other]), np.maximum(size[one], size[other])
        rest = np.minimum(left[one], left[other])
        fit = (100 * small >= PERCENT * large) & ((100 + PERCENT) * rest >= PERCENT * (small + large))
        keep[one[fit]] = keep[other[fit]] = True
    return keep


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens that more than one node has: (token, node, n, left, many), left: tokens of the node from this one on, many: nodes
    of the token. Most tokens are shared by chance: rows that can link with no other of their token are left out."""
    if (found := _gathered(batches, (np.uint64, np.int64, np.int32, np.int32))) is not None:
        token, many, node, size, place = (x[found[1] > 1] for x in found)
        size = size.astype(np.int64)
        keep = partnered(many, token, size, size - place)
        columns = [x[keep] for x in (token.view(np.int64), node, size, size - place, many)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "node", "n", "left", "many"])


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens that are in the prefixes of more than FREQUENT nodes."""
    if (found := _gathered(batches, (np.uint64, np.uint32))) is not None:
        token = np.unique(found[0][found[1] > FREQUENT])
        yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64))], names=["token"])


def shared_tokens(rows: DataFrame, sized: DataFrame, classes: Broadcast) -> DataFrame:
    """Prefix tokens of the first order that at least two nodes share.

    Prefixes are made twice: first by the classes of the sketch, which is too coarse for tokens of middling frequency;
    those that turn out to be in many prefixes come last in the second order.
    """
    spark = rows.sparkSession
    shingles = sized.agg(F.sum("n")).first()[0] or 0
    tokens = (100 - PERCENT + 1) * shingles // 100
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // PART_TOKENS))

    def dealt(frequent: Broadcast | None) -> DataFrame:
        columns = BLOCK[:2] if frequent is None else BLOCK
        schema = ", ".join(["part int", *(f"{c} binary" for c in columns)])
        blocks = rows.select("text").mapInArrow(partial(_prefixes, classes, frequent, parts), schema)
        return blocks.repartition(parts, "part")

    often = stage(dealt(None).mapInArrow(_often, "token long"), "often")
    frequent = spark.sparkContext.broadcast(bloom_filter(often))
    return stage(dealt(frequent).mapInArrow(_groups, "token long, node long, n long, left long, many long"), "shared")


def bloom_filter(keys: DataFrame) -> bytes:
    """A Bloom filter of the one column of ``keys``, of fixed size; few tasks make one each, the driver unites them."""
    bits = np.zeros(BLOOM // 8, np.uint8)
    for row in keys.coalesce(8).mapInArrow(_bloom_part, "bits binary").toLocalIterator():
        bits |= np.frombuffer(row["bits"], np.uint8)
    return bits.tobytes()


def _bloom_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(BLOOM, bool)
    for batch in batches:
        for place in bloom_places(batch.column(0).to_numpy()):
            bits[place] = True
    if bits.any():
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bits"])


def near(one: str, other: str, sizes: str, words: int = SIGNATURE) -> Column:
    """Whether bit signatures allow two sets to link.

    They differ in at least as many shingles as their signatures in bits, and linked ones in no more than
    (100 - PERCENT) / (100 + PERCENT) of their summed sizes.
    """
    differ = " + ".join(f"bit_count({one}[{k}] ^ {other}[{k}])" for k in range(words))
    return F.expr(f"{100 + PERCENT} * ({differ}) <= {100 - PERCENT} * ({sizes})")


def pass_filters(pairs: DataFrame, traits: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) that share a prefix token in all other orders, too, and whose signatures allow a link."""
    names = {"tokens": "t", "fine": "s", "size": "m"}
    traits = traits.drop("sign")
    one = traits.withColumnsRenamed({"node": "a"} | {k: f"{v}_a" for k, v in names.items()})
    other = traits.withColumnsRenamed({"node": "b"} | {k: f"{v}_b" for k, v in names.items()})
    both = pairs.select("a", "b").distinct().join(one, "a").join(other, "b")
    for order in range(ORDERS - 1):
        both = both.where(F.arrays_overlap(F.col("t_a")[order], F.col("t_b")[order]))
    return both.where(near("s_a", "s_b", "m_a + m_b", FINE)).select("a", "b")


def sizes_allow(one: str, other: str, one_left: str, other_left: str) -> Column:
    """Whether two sets can be similar enough, if a token is the first in the order that they share.

    What comes before it in either set isn't in the other, so they share no more than the shorter rest.
    """
    sizes = f"100 * least({one}, {other}) >= {PERCENT} * greatest({one}, {other})"
    rests = f"{100 + PERCENT} * least({one_left}, {other_left}) >= {PERCENT} * ({one} + {other})"
    return F.expr(f"{sizes} AND {rests}")


def _chosen(wanted: Broadcast, named: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Node and shingles of texts whose id and node filters let through, as rows without an id; some come more than once."""
    own_cache("jaccard")
    bits, ids, seen = unpacked(wanted.value), unpacked(named.value), set()
    for batch in batches:
        one, two, three = bloom_places(batch.column(0).fill_null(0).to_numpy())
        keep = ids[one] & ids[two] & ids[three] | ~batch.column(0).is_valid().to_numpy(False)
        if not keep.any():
            continue
        for _, shingles in sets(batch.column(1).filter(pa.array(keep))):
            node = node_of(shingles)
            if node in seen or not all(bits[p[0]] for p in bloom_places(np.array([node]))):
                continue
            if len(seen) < HELD_NODES:
                seen.add(node)
            yield node, shingles


def _in_blocks(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of a node, the size of its set and more, in blocks of BLOCK_NODES nodes or less, if their sets are large."""
    held, size = [], 0

    def block() -> pa.RecordBatch:
        columns = [pa.array(x, kind) for x, kind in zip(zip(*held, strict=True), schema.types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for row in rows:
        held.append(row)
        size += row[1]
        if len(held) == BLOCK_NODES or size > BLOCK_SHINGLES:
            yield block()
            held, size = [], 0
    if held:
        yield block()


def _traits(wanted: Broadcast, named: Broadcast, classes: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    longs = pa.list_(pa.int64())
    schema = pa.schema([("node", pa.int64()), ("size", pa.int64()), ("sign", longs), ("fine", longs), ("tokens", pa.list_(pa.list_(pa.int32())))])

    def traits(node: int, shingles: np.ndarray) -> tuple:
        tokens = [prefix(shingles, classes.value, None, k).astype(np.uint32).view(np.int32) for k in range(1, ORDERS)]
        return node, len(shingles), signature(shingles), signature(shingles, FINE), tokens

    return _in_blocks((traits(*x) for x in _chosen(wanted, named, batches)), schema)


def _sets(wanted: Broadcast, named: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.int64()), ("size", pa.int64()), ("shingles", pa.binary())])
    return _in_blocks(((node, len(x), x.tobytes()) for node, x in _chosen(wanted, named, batches)), schema)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for one, other in zip(batch.column(2), batch.column(3), strict=True):
            x, y = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(other.as_buffer(), np.uint64)
            both = np.concatenate([x, y])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= PERCENT * (len(both) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        pa.default_memory_pool().release_unused()


def filters_of(nodes: DataFrame, docs: DataFrame) -> tuple[Broadcast, Broadcast]:
    """Bloom filters of ``nodes`` and of the smallest id that each has; ``docs``: (doc_id, node) of all rows."""
    named = docs.join(nodes.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    named = stage(named, "nodes")
    context = docs.sparkSession.sparkContext
    return tuple(context.broadcast(bloom_filter(x)) for x in (named.select("node"), named.select("doc_id").where("doc_id IS NOT NULL")))


def traits_of(rows: DataFrame, docs: DataFrame, nodes: DataFrame, classes: Broadcast) -> DataFrame:
    """(node, size, sign, fine, tokens) of ``nodes``, made again from the texts; some others and copies may be among them.
    ``tokens``: per order but the first, parts of the hashes of its prefix."""
    schema = "node long, size long, sign array<long>, fine array<long>, tokens array<array<int>>"
    return rows.mapInArrow(partial(_traits, *filters_of(nodes, docs), classes), schema)


def verify(pairs: DataFrame, rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar enough. Only the sets of the pairs are made again from their texts, and kept."""
    if pairs.isEmpty():
        return pairs
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    chosen = rows.mapInArrow(partial(_sets, *filters_of(nodes, docs)), "node long, size long, shingles binary")
    chosen = stage(chosen, "sets").dropDuplicates(["node"])
    one = chosen.select(F.col("node").alias("a"), F.col("shingles").alias("one"))
    other = chosen.select(F.col("node").alias("b"), F.col("shingles").alias("other"))
    both = pairs.join(one, "a").join(other, "b").select("a", "b", "one", "other")
    return stage(both.mapInArrow(_linked, "a long, b long"), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of all linked nodes: the smallest node reachable, by minimum labels and pointer jumping."""
    edges = stage(links.union(links.select("b", "a")).distinct(), "edges")
    labels = stage(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", "comp", F.least("comp", "near").alias("low"))
        ahead = labels.select(F.col("node").alias("low"), F.col("comp").alias("jump"))
        after = step.join(ahead, "low", "left").select("node", "comp", F.least("low", "jump").alias("next"))
        after = stage(after, "labels")
        labels = after.select("node", F.col("next").alias("comp"))
        if after.where("comp <> next").isEmpty():
            return labels


def link(rows: DataFrame, docs: DataFrame, shared: DataFrame, classes: Broadcast) -> DataFrame:
    """(node, comp) of all nodes that have a link."""
    traits = stage(traits_of(rows, docs, shared, classes).dropDuplicates(["node"]), "traits")
    weights = stage(shared.groupBy("node").agg(F.sum("many").alias("weight")), "weights")
    shared = shared.drop("many")
    open_rows, comps, linked, all_pairs = shared.withColumn("comp", F.col("node")), None, 0, False
    for turn in range(ROUNDS + 1):
        if comps is not None:  # tokens with nodes of different components; none of the others will have them again
            placed = open_rows.drop("comp").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
            mixed = placed.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y")
            open_rows = stage(placed.join(mixed.select("token"), "token", "left_semi"), "open")
        all_pairs = all_pairs or turn == ROUNDS
        if all_pairs:
            pairs = _pairs(open_rows.join(traits.select("node", "sign"), "node"))
        else:
            pairs = _with_pivots(open_rows, weights, turn)
        more = verify(stage(pass_filters(pairs, traits), "pairs"), rows, docs)
        if (new := more.count()) or comps is None:
            # what was linked before is told by a link of each node with its component
            comps = components(more if comps is None else more.union(comps.where("node <> comp").select("node", "comp")))
        if all_pairs:
            return comps
        linked += new
        all_pairs = turn > 0 and RARER * new < linked or not new
    return comps


def _with_pivots(own: DataFrame, weights: DataFrame, turn: int) -> DataFrame:
    """Pairs of each token's nodes with PIVOTS of them, where components and sizes ask for it; the smaller node first.

    The next PIVOTS in each turn, heaviest first: a node weighs what nodes its tokens have, as much as it lies amid others.
    """
    order = Window.partitionBy("token").orderBy(F.col("weight").desc(), "node")
    ranked = own.join(weights, "node").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PIVOTS * (turn + 1))
    pivots = ranked.where(F.col("rank") > PIVOTS * turn).select("token", F.struct("node", "n", "left", "comp").alias("p"))
    pairs = own.join(pivots, "token").where("comp <> p.comp").where(sizes_allow("n", "p.n", "left", "p.left"))
    return pairs.select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b"))


def _pairs(own: DataFrame) -> DataFrame:
    """Pairs of each token's nodes in different components that sizes and signatures allow to link.

    The bounds are part of the join's condition, so of a family below the threshold only pairs close to it become rows.
    """
    left = own.withColumnsRenamed({"node": "a", "comp": "x"})
    right = own.withColumnsRenamed({"node": "b", "n": "m", "left": "rest", "comp": "y", "sign": "ngis"})
    joined = left.join(right, "token").where("a < b AND x <> y").where(sizes_allow("n", "m", "left", "rest"))
    return joined.where(near("sign", "ngis", "n + m")).select("a", "b")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Hand rows to Python workers in batches of BATCH_ROWS: whole texts, blocks of tokens and pairs of sets are large rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(BATCH_ROWS, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def similar_groups(df: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, node (null for an empty set) and comp of every row.

    ``comp`` tells components apart also where ids repeat. Jobs run while this is built.
    """
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with small_batches(df.sparkSession):
        sized = stage(rows.mapInArrow(_sizes, "doc_id long, n long, node long, chunk int, counts binary"), "sizes")
        classes = df.sparkSession.sparkContext.broadcast(frequency_classes(sized))
        docs = sized.where("chunk IS NULL").select("doc_id", "n", "node")
        comps = link(rows, docs, shared_tokens(rows, sized, classes), classes)
    nodes = docs.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    nodes = nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = nodes.groupBy("comp").agg(F.min("least").alias("component_id"), F.sum("copies").alias("members"))
    shared = nodes.join(least.where("members > 1"), "comp").select("node", "comp", "component_id")
    found = docs.join(shared, "node", "left")
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "node",
        F.coalesce("comp", "node").alias("comp"),
    )


def _with_nodes(text: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node = np.zeros(len(batch), np.int64)
        empty = np.ones(len(batch), bool)
        for row, shingles in sets(batch.column(text)):
            node[row], empty[row] = node_of(shingles), False
        yield batch.append_column("__node", pa.array(node, mask=empty))


def keep_one(df: DataFrame) -> DataFrame:
    """The rows, all columns, of one document per component: that with the smallest doc_id, then node; of its repeated
    rows one. Rows that link with nothing stay, also those without words, and a row is told by id and text, not by id alone."""
    groups = similar_groups(df).where("node IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node"))
    stay = groups.groupBy("comp").agg(first.alias("f")).select(F.col("f.doc_id").alias("__id"), F.col("f.node").alias("__own"))
    schema = StructType([*df.schema.fields, StructField("__node", LongType())])
    rows = df.mapInArrow(partial(_with_nodes, df.columns.index("text")), schema)
    same = rows["doc_id"].cast("long").eqNullSafe(stay["__id"]) & (rows["__node"] == stay["__own"])
    kept = rows.where("__node IS NOT NULL").join(stay, same, "left_semi")
    repeats = Window.partitionBy("doc_id", "__node").orderBy(F.xxhash64("text"))
    kept = kept.withColumn("__repeat", F.row_number().over(repeats)).where("__repeat = 1").select(df.columns)
    return kept.unionByName(rows.where("__node IS NULL").select(df.columns))
