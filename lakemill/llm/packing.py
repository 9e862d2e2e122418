"""Best-fit packing of tokenised documents: bin completion by branch and bound.

Documents longer than a sequence are cut into pieces of its length; pieces are then dealt into groups of some thousands,
each packed in a task of its own. In a group, best-fit decreasing gives the first incumbent. If it uses more sequences
than the total length asks for, sequences are filled one at a time around the largest piece left: undominated fillings
are enumerated, fullest first, branches whose waste exceeds what the incumbent allows are pruned, and better packings
become the incumbent.

Defined results: a null text is empty and gives one piece with just the end id; repeated rows are packed as often as
they come; an empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.shared import stage
from lakemill.llm.tokens import id_bytes, with_end, word_ids
from lakemill.llm.words import ranges

CAPACITY = 4096
#: Pieces packed together, fillings tried around a piece, and sequences opened by the search for each one needed.
GROUP_PIECES, FILLINGS, EFFORT = 20_000, 4, 3


def cut(df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """Tokenise (doc_id, text) and cut: doc_id, piece, start, length, ids (little-endian 32-bit). No shuffle."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 512):
                rows = batch.slice(low, 512)
                ids, count = with_end(*word_ids(path).encode(rows.column(1)), end_id)
                number = -(-count // capacity)
                row, piece = np.repeat(np.arange(len(rows)), number), ranges(np.zeros(len(rows), np.int64), number)
                length = np.minimum(capacity, count[row] - piece * capacity)
                columns = [rows.column(0).take(pa.array(row)), piece.astype(np.int32), piece * capacity, length]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), id_bytes(ids, length)], names=["doc_id", "piece", "start", "length", "ids"]
                )

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(pieces, "doc_id long, piece int, start long, length long, ids binary")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each size goes where it leaves the least room."""
    bins, rooms, by_room = [], [], defaultdict(list)
    for size in sorted(sizes, reverse=True):
        at = bisect_left(rooms, size)
        if at == len(rooms):
            bins.append([size])
            index, room = len(bins) - 1, capacity - size
        else:
            room = rooms[at]
            index = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
            bins[index].append(size)
            room -= size
        if room:
            if not by_room[room]:
                insort(rooms, room)
            by_room[room].append(index)
    return bins


def fillings(sizes: list[int], count: dict[int, int], room: int, most: int = FILLINGS) -> list[tuple[int, ...]]:
    """Undominated ways to fill ``room`` with up to three pieces left, then the largest that fit; fullest first.

    ``sizes`` are the distinct sizes left in ascending order. A filling is dominated if a piece left out still fits,
    or fits in place of a smaller one.
    """
    if count.get(room):
        return [(room,)]
    found: dict[tuple[int, ...], int] = {}
    top = bisect_right(sizes, room)
    for first in range(top - 1, max(-1, top - 65), -1):
        used, left = [sizes[first]], room - sizes[first]
        while left:
            at = bisect_right(sizes, min(left, used[-1])) - 1
            while at >= 0 and count[sizes[at]] <= used.count(sizes[at]):
                at -= 1
            if at < 0:
                break
            if len(used) == 1 and (exact := left) <= used[-1] and count.get(exact, 0) > used.count(exact):
                used.append(exact)
                left = 0
                break
            used.append(sizes[at])
            left -= sizes[at]
        filling = tuple(used)
        if left == 0:
            return [filling]
        if all(_no_swap(sizes, count, used, y, left) for y in set(used)):
            found[filling] = left
    return sorted(found, key=lambda f: (found[f], [-x for x in f]))[:most] or [()]


def _no_swap(sizes: list[int], count: dict[int, int], used: list[int], size: int, left: int) -> bool:
    at = bisect_right(sizes, size + left) - 1
    while at >= 0 and sizes[at] > size:
        if count[sizes[at]] > used.count(sizes[at]):
            return False
        at -= 1
    return True


def complete(sizes: list[int], capacity: int, effort: int = EFFORT) -> list[list[int]]:
    """Bin completion, depth first, from the best-fit packing as incumbent."""
    best, total = best_fit(sizes, capacity), sum(sizes)
    least = -(-total // capacity)
    budget = effort * max(least, 1) + 100
    if len(best) == least:
        return best
    count: dict[int, int] = defaultdict(int)
    for size in sizes:
        count[size] += 1
    distinct = sorted(count)

    def take(items: tuple[int, ...], sign: int) -> None:
        for item in items:
            count[item] += sign
            if sign < 0 and not count[item]:
                distinct.pop(bisect_left(distinct, item))
            elif sign > 0 and count[item] == 1:
                insort(distinct, item)

    path: list[tuple[int, ...]] = []
    waste = 0
    open_ways: list[list[tuple[int, ...]]] = []

    def ways() -> list[tuple[int, ...]]:
        largest = distinct[-1]
        take((largest,), -1)
        got = [(largest, *f) for f in fillings(distinct, count, capacity - largest)]
        take((largest,), 1)
        return got[::-1]

    open_ways.append(ways())
    while open_ways and budget and len(best) > least:
        allowed = (len(best) - 1) * capacity - total
        if not open_ways[-1]:
            open_ways.pop()
            if path:
                undone = path.pop()
                take(undone, 1)
                waste -= capacity - sum(undone)
            continue
        way = open_ways[-1].pop()
        if waste + capacity - sum(way) > allowed:
            open_ways[-1].clear()  # those after it waste no less
            continue
        budget -= 1
        take(way, -1)
        path.append(way)
        waste += capacity - sum(way)
        if distinct:
            open_ways.append(ways())
        else:
            best = [list(x) for x in path]
            open_ways.append([])
    return best


def place(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add sequence_id and offset to pieces with a ``length``; all columns are kept, so leave out the wide ones.

    Reads ``pieces`` twice, for their number and to pack them: give it a staged table.
    """
    groups = -(-pieces.count() // group_pieces)
    dealt = pieces.withColumn("__group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(1, groups))))
    columns = pieces.columns

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", *(c for c in ("doc_id", "piece", "start") if c in rows)], kind="stable")
        length = rows["length"].to_numpy()
        waiting: dict[int, list[int]] = defaultdict(list)
        for k, size in enumerate(length.tolist()):
            waiting[size].append(k)
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        base = int(rows["__group"].iloc[0]) << 32
        for number, sizes in enumerate(complete(length.tolist(), capacity)):
            at = 0
            for size in sizes:
                k = waiting[size].pop()
                sequence[k], offset[k] = base + number, at
                at += size
        return rows[columns].assign(sequence_id=sequence, offset=offset)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("__group").applyInPandas(pack, f"{kinds}, sequence_id long, offset long")


def sequences(placed: DataFrame) -> DataFrame:
    """Ids of each sequence, from placed pieces that still carry ``ids``; a sequence is bounded by the capacity."""
    held = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return placed.groupBy("sequence_id").agg(
        F.unhex(F.array_join(F.transform(held, lambda x: x["ids"]), "")).alias("ids"), F.sum("length").alias("length")
    )


def pack_documents(df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """Pieces with digest and place; the ids themselves stay in a staged table and are not shuffled."""
    pieces = stage(cut(df, path, capacity, end_id), "pieces")
    return place(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity)
