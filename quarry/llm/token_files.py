"""Token-id files: fixed-size blocks of ids, transposed into planes, each plane compressed by zstandard.

A file holds the documents of one range of ids in ascending order:

    magic | planes of block 0 | planes of block 1 | ... | document table | index (JSON) | length of index | magic

Ids are unsigned 32-bit integers. A block of BLOCK ids becomes 4 byte planes (byte p of every id) or 32 bit
planes (bit p of every id, packed). The index lists, for each block, its offset, its number of ids and the
size of every plane, so one block can be read alone. The document table has doc_id, a null mark and the
number of ids of each document.

Every task writes files of its own name and reports them in a manifest, which Spark commits; files of lost
or repeated attempts are in no manifest and so are never read.

Cases: a null text is an empty one, and has its end id only. A null doc_id comes first. Rows with the same
doc_id are kept, ordered by a hash of their texts and dealt by it too, so that texts without an id, or under one, are
spread over files. Ids are whole numbers; one that cannot be read as such is an error. Other columns are ignored.
Empty input gives an empty manifest.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pyarrow as pa
import public_tokenizers
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, new_path, table
from .words import word_encoder

MAGIC = b"QPLANES1"
BLOCK = 65536
END_ID = 1
#: Bytes of ids that a reader holds before it hands a batch on.
BATCH = 4_000_000
MANIFEST = "shard int, file string, n_docs long, n_ids long"


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [p.tobytes() for p in raw.T]
    return [np.packbits(p).tobytes() for p in np.unpackbits(raw, axis=1, bitorder="little").T]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    rows = [np.frombuffer(p, np.uint8) for p in planes]
    if len(planes) == 4:
        raw = np.stack(rows, axis=1)
    else:
        raw = np.packbits(np.stack([np.unpackbits(r, count=n) for r in rows], axis=1), axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


class Writer:
    def __init__(self, out, bits: bool = False, block: int = BLOCK, level: int = 3):
        self.out, self.bits, self.block = out, bits, block
        self.zip = zstandard.ZstdCompressor(level=level)
        self.at, self.blocks, self.rest, self.ids, self.sizes = len(MAGIC), [], bytearray(), [], []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(doc_id)
        self.sizes.append(len(ids) // 4)
        self.rest += ids
        full = len(self.rest) // (4 * self.block) * 4 * self.block
        for at in range(0, full, 4 * self.block):
            self._put(bytes(self.rest[at : at + 4 * self.block]))
        if full:
            del self.rest[:full]

    def _put(self, ids: bytes) -> None:
        planes = [self.zip.compress(p) for p in to_planes(np.frombuffer(ids, "<u4"), self.bits)]
        self.blocks.append([self.at, len(ids) // 4, *map(len, planes)])
        self._write(b"".join(planes))

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def close(self) -> tuple[int, int]:
        """Write what is left and the index; gives the numbers of documents and ids."""
        if self.rest:
            self._put(bytes(self.rest))
        docs = np.array([i or 0 for i in self.ids], "<i8").tobytes()
        docs += np.array([i is None for i in self.ids], np.uint8).tobytes() + np.array(self.sizes, "<i8").tobytes()
        packed = self.zip.compress(docs)
        index = {"docs": [self.at, len(packed), len(self.ids)], "block": self.block, "blocks": self.blocks}
        self._write(packed)
        text = json.dumps(index).encode()
        self.out.write(text + len(text).to_bytes(8, "little") + MAGIC)
        return len(self.ids), sum(self.sizes)


class Reader:
    """file: seekable and binary, of the given size."""

    def __init__(self, file, size: int):
        self.file, self.unzip = file, zstandard.ZstdDecompressor()
        tail = self._at(size - 16, 16)
        if tail[8:] != MAGIC:
            raise ValueError("not a token file, or cut short")
        n = int.from_bytes(tail[:8], "little")
        self.index = json.loads(self._at(size - 16 - n, n))

    def _at(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def block(self, k: int) -> np.ndarray:
        at, n, *sizes = self.index["blocks"][k]
        data, planes = self._at(at, sum(sizes)), []
        for s in sizes:
            planes.append(self.unzip.decompress(data[:s]))
            data = data[s:]
        return from_planes(planes, n)

    def documents(self):
        """(doc_id, ids as bytes) in the order of the file, reading block after block."""
        at, size, n = self.index["docs"]
        raw = self.unzip.decompress(self._at(at, size))
        ids, null = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n)
        sizes, held, k = np.frombuffer(raw, "<i8", n, 9 * n), bytearray(), 0
        for i in range(n):
            need = 4 * int(sizes[i])
            while len(held) < need:
                held += self.block(k).tobytes()
                k += 1
            yield None if null[i] else int(ids[i]), bytes(held[:need])
            del held[:need]


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, bits: bool = False, block: int = BLOCK
) -> DataFrame:
    """Encode docs(doc_id, text), write token files below folder and give their manifest.

    folder must be reachable by every executor. Ranges of doc_id become shards, numbered upwards.
    """
    end = end_id.to_bytes(4, "little")

    def run(batches):
        from pyspark import TaskContext

        encode, writer, out = word_encoder(vocabulary).encode, None, None
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            for k, i in enumerate(ids):
                if writer is None:
                    store, base = fs.FileSystem.from_uri(folder)
                    shard = TaskContext.get().partitionId()
                    name = f"shard-{shard:06d}-{uuid.uuid4().hex}.planes"
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}")
                    writer = Writer(out, bits, block)
                writer.add(i, encode(texts[k].as_py() or "") + end)
        if writer is not None:
            n_docs, n_ids = writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "file": [name],
                    "n_docs": pa.array([n_docs], pa.int64()),
                    "n_ids": pa.array([n_ids], pa.int64()),
                }
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("salt", F.rand(10))  # equal rows may go to any of several files
    ordered = rows.repartitionByRange("doc_id", "tie", "salt").sortWithinPartitions("doc_id", "tie", "text").drop("tie", "salt")
    return materialise(ordered.mapInArrow(run, MANIFEST), "manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, ids): the documents of the manifest's files; ids as little-endian unsigned 32-bit integers.

    start counts the ids of all documents before. The running total is over one row for each file.
    """
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.withColumn("before", before).repartition(max(1, manifest.count()))
    kinds = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        store, base = fs.FileSystem.from_uri(folder)
        for b in batches:
            for row in b.to_pylist():
                path, start, rows, held = f"{base}/{row['file']}", row["before"], [], 0
                with store.open_input_file(path) as f:
                    for doc_id, ids in Reader(f, f.size()).documents():
                        rows.append({"doc_id": doc_id, "start": start, "ids": ids})
                        start, held = start + len(ids) // 4, held + len(ids)
                        if held > BATCH:
                            yield pa.RecordBatch.from_pylist(rows, kinds)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, kinds)

    return files.mapInArrow(run, "doc_id long, start long, ids binary")


def token_table(docs: DataFrame, vocabulary: str | None = None, bits: bool = False) -> DataFrame:
    """Write docs as token files in the shared folder and digest what is read back from them."""
    folder = new_path(docs.sparkSession, "token-files")
    manifest = write_token_files(docs, folder, vocabulary or public_tokenizers.path("word_bpe_49k.json"), bits=bits)
    return read_token_files(manifest, folder).select(
        "doc_id", "start", F.expr("CAST(octet_length(ids) / 4 AS LONG)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(table(spark, sf_dir, "documents"))


QUERIES = {"op10_token_files": op10_token_files}
ORACLES: dict[str, str] = {}
