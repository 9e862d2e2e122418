"""Exact duplicates by owners that keep full texts in Patricia tries.

Texts are equal when they are after white space (space and the bytes 9 to 13) is deleted. Each scan task puts its texts
into a compressed radix trie, so that a text goes on only once a task, with the number of its rows and the best of them.
These entries are dealt out by length and content hash; the owner of a part inserts the whole byte strings into one trie,
whose terminal nodes hold the smallest identifier, the number of rows and the entries that ended there. Hashes only deal
out: two texts are one group only if every byte is equal. A text that a third of all rows hold reaches its owner once per
scan task. Owners name the group of each entry, and rows find theirs by the task and entry that they went into.

When an owner's trie passes its bound, its heaviest subtree is written to the shared folder and later strings with that
prefix follow it there; spilled subtrees are then merged one after another, by the same rule. A scan task that passes its
bound hands on its entries and starts a new trie.

Defined results: null counts as the empty text, and white texts equal it; of the rows of a group that with the most code
points before deletion stays, then the one with the smallest doc_id (null last), then the first one read, so that one of
repeated rows stays. Very long texts are whole keys. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterable, Iterator
from functools import partial
from io import BytesIO
from typing import NamedTuple
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.shared import new_folder, open_store, stage, write_file
from lakemill.llm.words import WHITE, buffers

#: Bytes of a scan task's trie, and of an owner's; nodes count with about what Python needs for one.
HELD, OWNED, NODE = 32 << 20, 96 << 20, 300
SLICE = 4 << 20


def squeezed(texts: pa.Array) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """First row, texts without white space, and code points of the texts as given, some texts at a time."""
    _, at = buffers(texts)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(at, at[low] + SLICE, "right")) - 1)
        data, place = buffers(texts.slice(low, high - low))
        keep, starts = ~WHITE[data], (data & 0xC0) != 0x80
        kept = data[keep].tobytes()
        ends = np.concatenate([[0], np.cumsum(keep)])[place].tolist()
        points = np.diff(np.concatenate([[0], np.cumsum(starts)])[place])
        yield low, [kept[a:b] for a, b in zip(ends, ends[1:], strict=False)], points
        low = high


class Best(NamedTuple):
    """A row by the order in which rows of a group are kept: the smallest one stays."""

    fewer: int
    unnamed: bool
    doc_id: int
    task: int
    row: int


class Group:
    """What a terminal node holds: number of rows, the best one, and the entries that ended here."""

    __slots__ = ("best", "entries", "rows")

    def __init__(self, rows: int, best: Best, entries: list[tuple[int, int]]):
        self.rows, self.best, self.entries = rows, best, entries

    def add(self, other: Group) -> None:
        self.rows += other.rows
        self.best = min(self.best, other.best)
        self.entries += other.entries


class Node:
    """A label, children by their first byte (none in a leaf), and a group if a text ends here; or a spilled subtree."""

    __slots__ = ("children", "group", "label", "spill")

    def __init__(self, label: bytes, children: dict[int, Node] | None = None):
        self.label, self.children = label, children
        self.group: Group | None = None
        self.spill: Spill | None = None


def common_length(label: bytes, key: bytes, at: int) -> int:
    """Equal bytes at the beginning of ``label`` and of ``key`` from ``at`` on."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == key[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    def __init__(self) -> None:
        self.root, self.held = Node(b"", {}), 0

    def find(self, key: bytes) -> tuple[Node, bytes]:
        """The node where the key ends, made if it is new; or a spilled subtree and the rest of the key below it."""
        node, at = self.root, 0
        while at < len(key):
            if node.children is None:
                node.children = {}
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                self.held += len(child.label) + NODE
                return child, b""
            if not key.startswith(child.label, at):
                equal = common_length(child.label, key, at)
                middle = Node(child.label[:equal], {child.label[equal]: child})
                child.label = child.label[equal:]
                node.children[key[at]] = child = middle
                self.held += NODE
            node = child
            at += len(node.label)
            if node.spill is not None:
                return node, key[at:]
        return node, b""

    def items(self, top: Node | None = None) -> Iterator[tuple[bytes, Group | Spill]]:
        """Texts below a node (relative to it) and their groups, and subtrees that were spilled before."""
        waiting = [(top or self.root, b"")]
        while waiting:
            node, text = waiting.pop()
            if node.group is not None or node.spill is not None:
                yield text, node.spill or node.group
            for child in (node.children or {}).values():
                waiting.append((child, text + child.label))

    def heaviest(self) -> tuple[Node, int] | None:
        """A subtree to spill, and its size: down the heaviest children until what is left is at most half of all.

        It never holds all texts of the trie, so a spilled subtree is smaller than the trie it comes from.
        """
        order, above = [self.root], [0]
        for k, node in enumerate(order):  # grows as it goes
            children = [c for c in (node.children or {}).values() if c.spill is None]
            order += children
            above += [k] * len(children)
        size = [len(n.label) + NODE for n in order]
        for k in range(len(order) - 1, 0, -1):
            size[above[k]] += size[k]
        best: dict[int, int] = {}
        for k in range(1, len(order)):
            if size[k] > size[best.get(above[k], k)] or above[k] not in best:
                best[above[k]] = k
        at, alone = 0, True
        while at in best:
            node = order[at]
            alone = alone and node.group is None and len(node.children) == 1
            at = best[at]
            if not alone and size[at] <= self.held // 2:
                break
        return None if alone else (order[at], size[at])


class Spill:
    """Files with what lies below a node that left memory; subtrees spilled there before are part of it."""

    def __init__(self, folder: str, buffer: int):
        self.folder, self.buffer = folder, buffer
        self.out, self.names = BytesIO(), []
        self.parts: list[tuple[bytes, Spill]] = []

    def add(self, rest: bytes, group: Group | Spill) -> None:
        if isinstance(group, Spill):
            self.parts.append((rest, group))
            return
        pickle.dump((rest, group.rows, tuple(group.best), group.entries), self.out)
        if self.out.tell() > self.buffer:
            self.write()

    def write(self) -> None:
        if self.out.tell():
            self.names.append(f"{uuid4().hex}.subtree")
            write_file(self.folder, self.names[-1], [self.out.getvalue()])
            self.out = BytesIO()

    def read(self) -> Iterator[tuple[bytes, Group]]:
        """The strings below the node; each file goes when it has been read."""
        self.write()
        store, base = open_store(self.folder)
        for name in self.names:
            with store.open_input_stream(f"{base}/{name}", compression=None) as source:
                data = BytesIO(source.read())
            while data.tell() < data.getbuffer().nbytes:
                rest, rows, best, entries = pickle.load(data)
                yield rest, Group(rows, Best(*best), entries)
            store.delete_file(f"{base}/{name}")
        for prefix, part in self.parts:
            for rest, group in part.read():
                yield prefix + rest, group


def merged(found: Iterable[tuple[bytes, Group]], folder: str, bound: int = OWNED) -> Iterator[Group]:
    """One group per distinct byte string, with a trie of about ``bound`` bytes in memory."""
    waiting: list[Iterable[tuple[bytes, Group]]] = [found]
    while waiting:
        trie = Trie()
        for key, group in waiting.pop():
            node, rest = trie.find(key)
            if node.spill is not None:
                node.spill.add(rest, group)
            elif node.group is None:
                node.group = group
            else:
                node.group.add(group)
            while trie.held > bound and (found_subtree := trie.heaviest()) is not None:
                top, size = found_subtree
                spill = Spill(folder, bound // 16)
                for rest, below in trie.items(top):
                    spill.add(rest, below)
                spill.write()
                top.children, top.group, top.spill = None, None, spill
                trie.held -= size
        for _, found_group in trie.items():
            if isinstance(found_group, Spill):
                waiting.append(found_group.read())
            else:
                yield found_group


ENTRIES = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("task", pa.int32()), ("row", pa.int64()), ("entry", pa.int64()),
    ("length", pa.int64()), ("hash", pa.int64()), ("rows", pa.int64()), ("text", pa.large_binary()),
])
OWNERS = pa.schema([
    ("task", pa.int32()), ("entry", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()),
    ("keep_task", pa.int32()), ("keep_row", pa.int64()), ("text_sha256", pa.string()),
])


def _handed_on(trie: Trie, task: int) -> Iterator[pa.RecordBatch]:
    """The entries of a scan task: the best row, the number of rows, the text and where it goes."""
    held: list[tuple] = []
    size = 0
    for text, group in trie.items():
        best = group.best
        where = int(np.uint64(xxhash.xxh3_64_intdigest(text)).view(np.int64))
        doc_id = None if best.unnamed else best.doc_id
        held.append((doc_id, -best.fewer, task, best.row, group.entries[0][1], len(text), where, group.rows, text))
        size += len(text)
        if size > SLICE:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), ENTRIES)], schema=ENTRIES)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), ENTRIES)], schema=ENTRIES)


def _scan(bound: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the entry it belongs to (no text), and each entry of the task (with text)."""
    task, row, trie = TaskContext.get().partitionId(), 0, Trie()
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for first, texts, points in squeezed(batch.column(1)):
            entry = np.zeros(len(texts), np.int64)
            for k, text in enumerate(texts):
                doc_id = ids[first + k]
                best = Best(-int(points[k]), doc_id is None, doc_id or 0, task, row + k)
                node, _ = trie.find(text)
                if node.group is None:
                    node.group = Group(1, best, [(task, row + k)])
                else:
                    node.group.rows += 1
                    node.group.best = min(node.group.best, best)
                entry[k] = node.group.entries[0][1]
            n = len(texts)
            columns = [batch.column(0).slice(first, n), pa.array(points), pa.array(np.full(n, task, np.int32)),
                       pa.array(np.arange(row, row + n)), pa.array(entry)]
            nothing = [pa.nulls(n, f.type) for f in list(ENTRIES)[5:]]
            yield pa.RecordBatch.from_arrays([*columns, *nothing], schema=ENTRIES)
            row += n
            if trie.held > bound:
                yield from _handed_on(trie, task)
                trie = Trie()
    yield from _handed_on(trie, task)


def _own(folder: str, bound: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each entry of an owner's part: the row of its group that stays, the group's size and its text's digest."""
    digests: dict[tuple[int, int], bytes] = {}

    def arrived() -> Iterator[tuple[bytes, Group]]:
        for batch in batches:
            for doc_id, points, task, row, entry, rows, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield text, Group(rows, Best(-points, doc_id is None, doc_id or 0, task, row), [(task, entry)])
                digests[task, entry] = hashlib.sha256(text).digest()

    out: list[tuple] = []
    for group in merged(arrived(), folder, bound):
        best = group.best
        keep_id = None if best.unnamed else best.doc_id
        for task, entry in group.entries:
            out.append((task, entry, keep_id, group.rows, best.task, best.row, digests.pop((task, entry)).hex()))
        if len(out) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), OWNERS)], schema=OWNERS)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), OWNERS)], schema=OWNERS)


def exact_groups(df: DataFrame, held: int = HELD, owned: int = OWNED) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row. Scans and stages the texts while it is built.

    ``held``, ``owned``: bytes of a scan task's and an owner's trie.
    """
    spark = df.sparkSession
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_chars long, task int, row long, entry long, length long, hash long, rows long, text binary"
    scanned = stage(rows.mapInArrow(partial(_scan, held), schema), "scanned")
    entries = scanned.where("text IS NOT NULL").repartition("length", "hash")
    sent = entries.select("doc_id", "n_chars", "task", "row", "entry", "rows", "text")
    schema = "task int, entry long, keep_id long, group_size long, keep_task int, keep_row long, text_sha256 string"
    owners = sent.mapInArrow(partial(_own, new_folder(spark, "subtrees"), owned), schema)
    docs = scanned.where("text IS NULL").select("doc_id", "task", "row", "entry")
    found = docs.join(owners, ["task", "entry"])
    kept = (F.col("task") == F.col("keep_task")) & (F.col("row") == F.col("keep_row"))
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")
