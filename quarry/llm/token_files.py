"""Token ids in files of independent zstandard frames with a trailing seek table.

File layout: one zstandard frame per document (its ids as little-endian
unsigned 32-bit integers, with zstandard's own content checksum), then one
skippable frame that any zstandard tool passes over. The skippable frame holds
the seek table, one entry per document (id, whether the id is null, frame
offset and size, token count, crc32 of the ids), and a 24-byte footer with the
number of entries, the table's crc32 and a magic word. A reader fetches the
footer, the table and only the frames of the documents it wants, and checks
each frame against its checksum.

Writing: rows are dealt by range of id and sorted inside each task; file k
holds smaller ids than file k + 1. A task writes to a hidden name of its own
and renames at the end, so a lost or doubled task leaves a whole file. Files go
to any store that pyarrow's file systems reach. Ids must be integers.

Defined results: null or empty text is the end id alone; null ids come first
and are marked; repeated ids are kept in text order; other columns are not
read; an empty table gives no documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import col
from quarry.llm.tokens import encoder

ENTRY = np.dtype([("doc_id", "<i8"), ("is_null", "u1"), ("offset", "<u8"), ("size", "<u8"), ("n_tokens", "<u8"), ("crc32", "<u4")])
FOOTER = np.dtype([("entries", "<u8"), ("crc32", "<u4"), ("pad", "<u4"), ("magic", "S8")])
SKIPPABLE = (0x184D2A5E).to_bytes(4, "little")
MAGIC = b"QTOKENS1"
SUFFIX = ".qtok"
OUT_BYTES = 16 << 20


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a location as Spark names it (file:/x, /x, or any scheme pyarrow knows)."""
    if uri.startswith("file:/"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def write_file(uri: str, name: str, docs: Iterator[tuple[int | None, bytes]], attempt: str) -> tuple[int, int]:
    """Write one file; returns its documents and tokens."""
    import zstandard

    store, folder = open_store(uri)
    hidden, table, at = f"{folder}/.{name}.{attempt}", [], 0
    compress = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True).compress
    with store.open_output_stream(hidden) as out:
        for doc_id, raw in docs:
            frame = compress(raw)
            out.write(frame)
            table.append((0 if doc_id is None else doc_id, doc_id is None, at, len(frame), len(raw) // 4, zlib.crc32(raw)))
            at += len(frame)
        body = np.array(table, dtype=ENTRY).tobytes()
        footer = np.array([(len(table), zlib.crc32(body), 0, MAGIC)], dtype=FOOTER).tobytes()
        out.write(SKIPPABLE + (len(body) + len(footer)).to_bytes(4, "little") + body + footer)
    store.move(hidden, f"{folder}/{name}")
    return len(table), sum(x[4] for x in table)


def read_table(source, size: int) -> np.ndarray:
    """The seek table of an open file."""
    if size < FOOTER.itemsize:
        raise ValueError("not a token file: too short")
    source.seek(size - FOOTER.itemsize)
    footer = np.frombuffer(source.read(FOOTER.itemsize), dtype=FOOTER)[0]
    if footer["magic"] != MAGIC:
        raise ValueError("not a token file: no seek table at its end")
    length = int(footer["entries"]) * ENTRY.itemsize
    source.seek(size - FOOTER.itemsize - length)
    body = source.read(length)
    if zlib.crc32(body) != footer["crc32"]:
        raise ValueError("seek table checksum does not match")
    return np.frombuffer(body, dtype=ENTRY)


def read_frames(source, table: np.ndarray, wanted: np.ndarray) -> Iterator[bytes]:
    """The ids of the wanted entries, decompressing no other frame."""
    import zstandard

    decompress = zstandard.ZstdDecompressor().decompress
    for k in wanted.tolist():
        entry = table[k]
        source.seek(int(entry["offset"]))
        raw = decompress(source.read(int(entry["size"])))
        if zlib.crc32(raw) != entry["crc32"] or len(raw) != 4 * int(entry["n_tokens"]):
            raise ValueError(f"frame {k} does not match its checksum")
        yield raw


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 2, drops_white_space: bool = True) -> DataFrame:
    """Write the files; returns (file, n_docs, n_tokens), evaluated once by the caller's action."""
    end_bytes = int(end_id).to_bytes(4, "little")
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():08d}{SUFFIX}"
        encode = encoder(tokenizer, drops_white_space).encode

        def rows():
            for batch in batches:
                texts = batch.column(1).to_pylist()
                for doc_id, raw in zip(batch.column(0).to_pylist(), encode(texts), strict=True):
                    yield doc_id, raw + end_bytes

        n_docs, n_tokens = write_file(folder, name, rows(), f"{task.stageId()}-{task.taskAttemptId()}")
        yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()], pa.int64()), pa.array([n_docs], pa.int64()),
                                          pa.array([n_tokens], pa.int64())], names=["file", "n_docs", "n_tokens"])

    rows = docs.select(col(id_col).cast("long").alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    return rows.repartitionByRange("id").sortWithinPartitions("id", "text") \
        .mapInArrow(run, "file long, n_docs long, n_tokens long")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder).select("path", "length")


def read_tokens(spark: SparkSession, folder: str, doc_ids: list[int] | None = None, id_col: str = "doc_id") -> DataFrame:
    """(id, start, ids) per document; start counts all tokens before it over all files.

    ``doc_ids``: a short list of requested documents; other frames stay compressed.
    """
    picked = None if doc_ids is None else np.array(sorted(set(doc_ids)), dtype=np.int64)
    file_no = F.regexp_extract("path", r"part-(\d+)", 1).cast("long")

    def opened(batches):
        for batch in batches:
            rest = [batch.column(k).to_pylist() for k in range(2, batch.num_columns)]
            for path, size, *tail in zip(*[batch.column(k).to_pylist() for k in range(2)], *rest, strict=True):
                store, name = open_store(path)
                with store.open_input_file(name) as source:
                    yield *tail, source, read_table(source, size)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, table in opened(batches):
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([int(table["n_tokens"].sum())], pa.int64())],
                                             names=["file", "n_tokens"])

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, base, source, table in opened(batches):
            before = base + np.cumsum(table["n_tokens"]).astype(np.int64) - table["n_tokens"].astype(np.int64)
            wanted = np.arange(len(table)) if picked is None else np.flatnonzero(np.isin(table["doc_id"], picked) & (table["is_null"] == 0))
            held, first, size = [], 0, 0
            for k, raw in enumerate(read_frames(source, table, wanted)):
                held.append(raw)
                size += len(raw)
                if size >= OUT_BYTES or k + 1 == len(wanted):
                    at = wanted[first:k + 1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(table["doc_id"][at], mask=table["is_null"][at] == 1), pa.array(before[at]), pa.array(held, pa.binary())],
                        names=["id", "start", "ids"])
                    held, first, size = [], k + 1, 0

    files = _files(spark, folder).select("path", "length", file_no.alias("file"))
    # One row per file, so as many as the writing job had tasks: that bounds the window and the broadcast.
    totals = files.mapInArrow(sums, "file long, n_tokens long")
    before = totals.select("file", (F.sum("n_tokens").over(Window.orderBy("file")) - F.col("n_tokens")).alias("base"))
    return files.join(F.broadcast(before), "file").select("path", "length", "file", "base") \
        .mapInArrow(frames, "id long, start long, ids binary").select(F.col("id").alias(id_col), "start", "ids")
