"""Nearest neighbours by inner product: a vantage-point tree per shard.

Each vector gets one more component that brings it to the largest norm of its shard, so the largest inner product is the
smallest Euclidean distance, and the triangle inequality holds. Queries lie where that component is 0, so the smallest one
of a subtree is an offset that all its distances have in common. A subtree is left out if what its lower bound has beyond
the offset, times ``factor``, exceeds what the distance of the worst neighbour kept has beyond it: factor 1 gives exact
results, larger factors prune more. Which factor a table bears is measured: a bounded sample of the queries is searched
exactly and with falling factors, until one has the recall that is asked for.

Equal vectors are indexed once, with their smallest ids: no answer can hold more of them than it has places. Trees and
blocks of queries are files in the shared folder; a task searches some trees for one block and carries the neighbours
found from tree to tree.

Defined results: vectors that are null, zero, empty, or hold null or non-finite components take no part; only vectors of
one length are compared; rows with null ids take no part; repeated rows count once, and rows with the query's id are
all its own; ties go to the smaller id; an empty table gives no row.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemill.llm.shared import new_folder, open_store, stage, write_file
from lakemill.llm.words import ranges

SHARD_VECTORS, BLOCK_QUERIES, LEAF, SPARE = 8192, 1024, 256, 8
#: Queries on which recall is measured; a factor that fails is followed by STEP times it.
SAMPLE, STEP = 512, 0.7
#: Rounding of distances, relative to the largest norm; a bound this close doesn't prune.
SLACK = 1e-7


def usable(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Distinct (vec_id, vector as doubles) of the vectors that take part."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0)).distinct()


class Tree:
    """Vantage-point tree over the rows of ``points``; ids: the smallest ids of each, ascending."""

    def __init__(self, points: np.ndarray, ids: list[np.ndarray], leaf: int = LEAF):
        norm = (points * points).sum(1)
        self.reach = float(norm.max())
        extra = np.sqrt(np.maximum(self.reach - norm, 0))
        lifted = np.concatenate([points, extra[:, None]], 1)
        order, nodes = np.arange(len(points)), []
        rng = np.random.default_rng(len(points))

        def build(low: int, high: int) -> int:
            number = len(nodes)
            nodes.append((low, high, -1, -1, 0.0, 0.0, 0.0, 0.0))
            if high - low > leaf:
                pick = low + int(rng.integers(high - low))
                order[[low, pick]] = order[[pick, low]]
                rest = order[low + 1 : high]
                far = np.sqrt(((lifted[rest] - lifted[order[low]]) ** 2).sum(1))
                by = np.argsort(far, kind="stable")
                order[low + 1 : high], far = rest[by], far[by]
                half = len(far) // 2
                inner = build(low + 1, low + 1 + half)
                outer = build(low + 1 + half, high)
                nodes[number] = (low, high, inner, outer, far[0], far[half - 1], far[half], far[-1])
            return number

        build(0, len(points))
        table = np.array(nodes)
        self.nodes, self.bounds = table[:, :4].astype(np.int64), table[:, 4:]
        self.points, self.extra = points[order], extra[order]
        self.offset = np.array([self.extra[low:high].min() for low, high in self.nodes[:, :2]])
        self.many = np.array([len(ids[k]) for k in order])
        self.ids = np.concatenate([ids[k] for k in order])

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: np.asarray(v) for k, v in vars(self).items()})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Tree:
        tree = cls.__new__(cls)
        for name, value in np.load(io.BytesIO(data)).items():
            setattr(tree, name, value if value.ndim else float(value))
        return tree

    def search(self, queries: np.ndarray, best: np.ndarray, found: np.ndarray, factor: float) -> int:
        """Improve ``best`` (scores, the worst one last) and ``found`` (smallest ids) in place.

        Returns the number of scores computed.
        """
        size = (queries * queries).sum(1)
        slack = SLACK * np.sqrt(max(self.reach, float(size.max(initial=0))))
        first = self.ids[np.cumsum(self.many) - self.many]
        places, computed = best.shape[1], 0

        def offer(rows: np.ndarray, low: int, high: int, score: np.ndarray) -> None:
            better = (score >= best[rows, -1][:, None]).any(1)
            rows, score = rows[better], score[better]
            if not len(rows):
                return
            scores = np.concatenate([best[rows], score], 1)
            ids = np.concatenate([found[rows], np.broadcast_to(first[low:high], score.shape)], 1)
            top = np.argpartition(-scores, places - 1, axis=1)[:, :places]
            worst = np.take_along_axis(scores, top[:, -1:], 1)
            tied = np.flatnonzero((scores >= worst).sum(1) > places)
            if len(tied):  # the smaller ids stay
                top[tied] = np.lexsort((ids[tied], -scores[tied]), axis=1)[:, :places]
            best[rows] = np.take_along_axis(scores, top, 1)
            found[rows] = np.take_along_axis(ids, top, 1)

        def distance(rows: np.ndarray, score: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(size[rows] + self.reach - 2 * score, 0))

        waiting = [(0, np.arange(len(queries)), np.zeros(len(queries)))]
        while waiting:
            node, rows, bound = waiting.pop()
            common = self.offset[node] ** 2
            keep = factor**2 * np.maximum(bound**2 - common, 0) <= (distance(rows, best[rows, -1]) + slack) ** 2 - common
            rows, bound = rows[keep], bound[keep]
            if not len(rows):
                continue
            low, high, inner, outer = self.nodes[node]
            if inner < 0:
                offer(rows, low, high, queries[rows] @ self.points[low:high].T)
                computed += len(rows) * (high - low)
                continue
            score = queries[rows] @ self.points[low]
            computed += len(rows)
            offer(rows, low, low + 1, score[:, None])
            # the queries lie in the plane where the extra component is 0, so this is their distance to the point
            far = distance(rows, score)
            in_low, in_high, out_low, out_high = self.bounds[node]
            to_in = np.maximum(bound, np.maximum(far - in_high, in_low - far))
            to_out = np.maximum(bound, np.maximum(far - out_high, out_low - far))
            near = to_in <= to_out
            waiting += [
                (inner, rows[~near], to_in[~near]), (outer, rows[near], to_out[near]),
                (outer, rows[~near], to_out[~near]), (inner, rows[near], to_in[near]),
            ]
        return computed


def build_index(df: DataFrame, folder: str, k: int, shard_vectors: int = SHARD_VECTORS) -> DataFrame:
    """Write a tree file per shard of (vec_id, vector) rows; returns their names and sizes."""
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    ranked = df.withColumn("__rank", F.row_number().over(smallest)).where(F.col("__rank") <= k + 1)
    classes = stage(ranked.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "vectors")
    shards = -(-classes.count() // shard_vectors)
    classes = classes.withColumn("__dim", F.size("vector"))
    classes = classes.withColumn("__shard", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(max(1, shards))))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(__first=[int(x[0]) for x in rows["ids"]]).sort_values("__first")
        dim, shard = int(rows["__dim"].iloc[0]), int(rows["__shard"].iloc[0])
        tree = Tree(np.stack(rows["vector"].to_list()), [np.asarray(x, np.int64) for x in rows["ids"]])
        name = f"tree-{dim}-{shard}.npz"
        write_file(folder, name, [tree.dump()])
        return pd.DataFrame({"dim": [dim], "tree": [name], "n": [len(rows)]})

    return stage(classes.groupBy("__dim", "__shard").applyInPandas(build, "dim int, tree string, n long"), "trees")


def write_blocks(queries: DataFrame, folder: str, block_queries: int = BLOCK_QUERIES, prefix: str = "queries") -> DataFrame:
    """Write the queries as files of about ``block_queries`` each; returns their names."""
    blocks = -(-queries.count() // block_queries)
    dealt = queries.withColumns(
        {"__dim": F.size("vector"), "__block": F.pmod(F.xxhash64("vec_id", "vector"), F.lit(max(1, blocks)))}
    )

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        dim, name = int(rows["__dim"].iloc[0]), f"{prefix}-{rows['__dim'].iloc[0]}-{rows['__block'].iloc[0]}.npz"
        out = io.BytesIO()
        np.savez(out, ids=rows["vec_id"].to_numpy(np.int64), vectors=np.stack(rows["vector"].to_list()))
        write_file(folder, name, [out.getvalue()])
        return pd.DataFrame({"dim": [dim], "block": [name]})

    return stage(dealt.groupBy("__dim", "__block").applyInPandas(write, "dim int, block string"), "blocks")


def search_index(trees: DataFrame, blocks: DataFrame, folder: str, k: int, factor: float) -> DataFrame:
    """The k nearest of each query: query_id, rank, vec_id, score."""
    spark = trees.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    pairs = trees.count() * blocks.count()
    together = min(16, max(1, pairs // (2 * tasks)))
    numbered = trees.withColumn("__n", F.row_number().over(Window.partitionBy("dim").orderBy("tree")))
    runs = numbered.groupBy("dim", F.floor(F.col("__n") / together).alias("__run")).agg(F.collect_list("tree").alias("trees"))
    jobs = stage(blocks.join(runs, "dim").select("block", "trees"), "jobs")

    def load(name: str):
        store, base = open_store(folder)
        with store.open_input_file(f"{base}/{name}") as file:
            return file.read()

    def searched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, names in zip(frame["block"], frame["trees"], strict=True):
                with np.load(io.BytesIO(load(block))) as file:
                    ids, queries = file["ids"], file["vectors"]
                best = np.full((len(ids), k + 1 + SPARE), -np.inf)
                found = np.full(best.shape, -1, np.int64)
                loaded = []
                for name in sorted(names):
                    tree = Tree.load(load(name))
                    tree.search(queries, best, found, factor)
                    loaded.append(tree)
                points = np.concatenate([tree.points for tree in loaded])
                many, all_ids = (np.concatenate([getattr(tree, x) for tree in loaded]) for x in ("many", "ids"))
                first = np.cumsum(many) - many
                order = np.argsort(all_ids[first])
                row, slot = np.nonzero(best > -np.inf)
                place = order[np.searchsorted(all_ids[first], found[row, slot], sorter=order)]
                score = (queries[row] * points[place]).sum(1)
                repeat = many[place]
                at = ranges(first[place], repeat)
                row, score = np.repeat(row, repeat), np.repeat(score, repeat)
                yield pd.DataFrame({"query_id": ids[row], "vec_id": all_ids[at], "score": score})

    dealt = jobs.repartition(tasks)
    got = dealt.mapInPandas(searched, "query_id long, vec_id long, score double").where("query_id <> vec_id").distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return got.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def measured_factor(
    queries: DataFrame, trees: DataFrame, folder: str, k: int, factor: float, recall: float, sample: int = SAMPLE
) -> float:
    """The first of falling factors, from ``factor`` on, with this recall on a sample of the queries; 1, which is exact, last."""
    names = queries.select("vec_id").distinct()
    some = names.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
    blocks = write_blocks(stage(queries.join(F.broadcast(some), "vec_id"), "sample"), folder, prefix="sample")
    exact = stage(search_index(trees, blocks, folder, k, 1.0).select("query_id", "vec_id"), "exact")
    wanted = recall * exact.count()
    while factor > 1:
        got = search_index(trees, blocks, folder, k, factor).select("query_id", "vec_id")
        if got.join(exact, ["query_id", "vec_id"]).count() >= wanted:
            return factor
        factor = max(1.0, STEP * factor)
    return 1.0


def nearest(
    queries: DataFrame, vectors: DataFrame, k: int = 20, factor: float = 1.0, recall: float | None = None, sample: int = SAMPLE
) -> DataFrame:
    """The k nearest ``vectors`` of each of ``queries``, both (vec_id, vector) as from ``usable``.

    With ``recall``, ``factor`` is the largest one, and as much smaller as this recall on a sample of the queries needs.
    """
    folder = new_folder(vectors.sparkSession, "nearest")
    trees = build_index(vectors, folder, k)
    if recall is not None:
        factor = measured_factor(queries, trees, folder, k, factor, recall, sample)
    blocks = write_blocks(queries, folder)
    return search_index(trees, blocks, folder, k, factor).select("query_id", "rank", "vec_id", "score")
