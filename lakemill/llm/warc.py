"""WARC records in seekable Zstandard bundles.

A bundle is one file: records are grouped into independent Zstandard frames; a skippable frame at the end holds the seek
table (compressed and plain size of each frame) in the published seekable format. The index maps each record to its
bundle, frame, and place in the frame's plain bytes, so one record is read without the rest of the bundle.

Of pages with equal payloads the one with the largest page_id is written as response, the others as revisit records
without the payload that refer to it. Defined results: a null html is an empty payload; a null url gives no target URI;
null page_ids come before others, and a revisit of one with a null page_id has no reference; repeated rows are written
as often as they come, one of them as response; an empty table gives no bundle. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemill.llm.shared import new_folder, open_store, stage, write_file

FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 64 << 20
#: Fixed values of the seekable format: magic numbers of the skippable frame and of the seek table's footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: A fixed record date: the tables have none, and archives written twice should be equal.
DATE = "1970-01-01T00:00:00Z"


def with_revisits(pages: DataFrame) -> DataFrame:
    """Add ``is_revisit`` and ``refers_to``: which page a payload repeats.

    Payloads are compared by SHA-1 and length. Copies are counted on narrow rows, and only digests that occur more than
    once take part in the narrow join, in which Spark may split a hot digest. The payloads are shuffled once, by page_id.
    """
    pages = pages.withColumn("__id", F.coalesce(F.col("page_id").cast("string"), F.lit("")))  # one key for join and window
    narrow = pages.select("__id", "page_id", "__digest", "__size")
    copies = narrow.groupBy("__digest", "__size").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("last"))
    found = narrow.distinct().join(copies.where("n > 1").drop("n"), ["__digest", "__size"])
    found = found.select("__id", "__digest", "last", F.lit(True).alias("copied"))
    joined = pages.join(found, ["__id", "__digest"], "left")
    joined = joined.withColumn("__repeat", F.row_number().over(Window.partitionBy("__id", "__digest").orderBy("url")))
    revisit = F.col("copied") & (~F.col("page_id").eqNullSafe(F.col("last")) | (F.col("__repeat") > 1))
    return joined.withColumn("is_revisit", F.coalesce(revisit, F.lit(False))).withColumn(
        "refers_to", F.when(F.col("is_revisit"), F.col("last"))
    )


def record_uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, refers_to: int | None, size: int | None = None
) -> bytes:
    """One WARC/1.1 record. A revisit needs no payload, if its ``size`` is told."""
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_uri(page_id),
        "WARC-Date": DATE,
        **({"WARC-Target-URI": "".join(url.split())} if url else {}),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Payload-Length": str(len(payload) if size is None else size),
        "Content-Type": "text/html; charset=utf-8",
    }
    if revisit:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        if refers_to is not None:
            head["WARC-Refers-To"] = record_uri(refers_to)
    block = b"" if revisit else payload
    lines = [f"{name}: {value}\r\n" for name, value in (head | {"Content-Length": str(len(block))}).items()]
    return b"WARC/1.1\r\n" + "".join(lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    return fields, rest[: int(fields["Content-Length"])]


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class BundleWriter:
    """Groups records into frames; ``chunks`` gives the bundle's bytes and may be used once."""

    def __init__(self, records: Iterable[bytes], frame_bytes: int = FRAME_BYTES):
        self.records, self.frame_bytes = records, frame_bytes
        self.places: list[tuple[int, int, int]] = []
        self.frames: list[tuple[int, int]] = []

    def chunks(self) -> Iterator[bytes]:
        compressor, held, size = zstandard.ZstdCompressor(level=3), [], 0

        def frame() -> bytes:
            data = compressor.compress(b"".join(held))
            self.frames.append((len(data), size))
            return data

        for data in self.records:
            if held and size + len(data) > self.frame_bytes:
                yield frame()
                held, size = [], 0
            self.places.append((len(self.frames), size, len(data)))
            held.append(data)
            size += len(data)
        if held:
            yield frame()
        yield seek_table(self.frames)


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", *x) for x in frames)
    return struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(frames), 0, SEEKABLE)


class Bundle:
    """Reads frames of an open bundle by the seek table at its end."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        file.seek(size - 9)
        count, _, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        file.seek(size - 9 - 8 * count)
        sizes = np.frombuffer(file.read(8 * count), "<u4").reshape(-1, 2).astype(np.int64)
        self.sizes, self.begin = sizes, np.cumsum(sizes[:, 0]) - sizes[:, 0]
        self.number, self.plain = -1, b""

    def read(self, frame: int, offset: int, length: int) -> bytes:
        if frame != self.number:
            self.file.seek(int(self.begin[frame]))
            data = self.file.read(int(self.sizes[frame, 0]))
            self.plain = zstandard.ZstdDecompressor().decompress(data, max_output_size=int(self.sizes[frame, 1]))
            self.number = frame
        return self.plain[offset : offset + length]


def write_bundles(pages: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, url, html) rows; returns the index: page_id, bundle, frame, offset, length.

    Each task writes bundles of about BUNDLE_BYTES of payload from the rows it holds.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("__payload"),
    )
    rows = rows.withColumns({"__digest": F.sha1("__payload"), "__size": F.octet_length("__payload")})
    rows = with_revisits(rows)
    kept = F.when(~F.col("is_revisit"), F.col("__payload")).alias("__payload")
    rows = rows.select("page_id", "url", kept, "__size", "__digest", "is_revisit", "refers_to")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
        for batch in batches:
            for low in range(0, len(batch), 64):
                for row in batch.slice(low, 64).to_pylist():
                    digest = base64.b32encode(bytes.fromhex(row["__digest"])).decode()
                    about = row["url"], row["__payload"] or b"", digest, row["is_revisit"], row["refers_to"], row["__size"]
                    yield row["page_id"], record(row["page_id"], *about)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, records = TaskContext.get().partitionId(), encoded(batches)
        for number, head in enumerate(records):  # the first record of each bundle; frames are written as they fill
            ids: list[int | None] = []

            def taken(head: tuple[int | None, bytes] = head, ids: list[int | None] = ids) -> Iterator[bytes]:
                size = 0
                for page_id, data in chain([head], records):
                    ids.append(page_id)
                    size += len(data)
                    yield data
                    if size >= BUNDLE_BYTES:
                        return

            name, bundle = f"part-{part:06d}-{number:06d}.warc.zst", BundleWriter(taken())
            write_file(folder, name, bundle.chunks())
            frame, offset, length = (np.array(x, np.int64) for x in zip(*bundle.places, strict=True))
            columns = [pa.array(ids, pa.int64()), pa.array([name] * len(ids)), *map(pa.array, (frame, offset, length))]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "bundle", "frame", "offset", "length"])

    kinds = "page_id long, bundle string, frame long, offset long, length long"
    return stage(rows.mapInArrow(written, kinds), "index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Read the indexed records back by seeking: page_id, headers of interest, and the block.

    Rows of one frame come together; a bundle may be read by several tasks.
    """
    schema = "page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long, block binary"
    kinds = pa.schema(
        [("page_id", pa.int64()), ("record_type", pa.string()), ("payload_digest", pa.string())]
        + [("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("block", pa.binary())]
    )

    def number(uri: str | None) -> int | None:
        text = (uri or "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        name, bundle, out, size = None, None, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["bundle"] != name:
                    name = row["bundle"]
                    bundle = Bundle(store.open_input_file(f"{base}/{name}"))
                fields, block = parse(bundle.read(row["frame"], row["offset"], row["length"]))
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                revisit = fields["WARC-Type"] == "revisit"
                if not revisit and (digest_of(block) != digest or len(block) != int(fields["Payload-Length"])):
                    raise ValueError(f"damaged record {fields['WARC-Record-ID']} in {name}")
                out.append(
                    {
                        "page_id": number(fields["WARC-Record-ID"]),
                        "record_type": fields["WARC-Type"],
                        "payload_digest": digest,
                        "payload_bytes": int(fields["Payload-Length"]),
                        "refers_to": number(fields.get("WARC-Refers-To")),
                        "block": block,
                    }
                )
                size += len(block) + 200
                if size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema=kinds)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=kinds)

    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.select("bundle", "frame", "offset", "length").repartition(tasks, "bundle", "frame")
    return dealt.sortWithinPartitions("bundle", "frame", "offset").mapInArrow(records, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to a new shared folder, then read them back."""
    folder = new_folder(pages.sparkSession, "warc")
    return read_records(write_bundles(pages, folder), folder)
