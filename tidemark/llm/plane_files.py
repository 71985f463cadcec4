"""Token files of bit planes (operator 12): format, Spark data source and random access.

A file holds blocks of ``BLOCK`` ids (the last one may be shorter). Of a block the
k-th bits of all ids stand together (bit planes), or the k-th bytes (byte planes),
as many planes as its largest id needs; each plane is one zstandard frame. After
the blocks come the documents (their key and number of ids, an Arrow stream in one
zstandard frame), the chunk index (place and length of every plane) and the length
of both. A folder is one sequence of ids: its manifest lists the files in order
with the ids before each.

    spark.dataSource.register(TokenPlanes)
    df.write.format("token_planes").option("planes", "byte").mode("append").save(folder)
    spark.read.format("token_planes").load(folder)      # key, start, n_tokens, ids
"""

from __future__ import annotations

import io
import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from tidemark.llm.common import fresh, python_batches
from tidemark.llm.token_ids import encode_ids

#: Ids of a block, ids after which a task begins another file, and bytes of ids in a batch that is read.
BLOCK, FILE_IDS, BATCH_BYTES = 65_536, 16_000_000, 4_000_000
MAGIC, TAIL = b"TDPLANE1", "<QQ8s"
MANIFEST = "manifest.json"


# blocks
def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """The block's planes, lowest bit or byte first; none if all ids are 0."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    if planes == "byte":
        rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
        return [rows[:, k].tobytes() for k in range((top + 7) // 8)]
    return [np.packbits((ids >> k & 1).astype(np.uint8), bitorder="little").tobytes() for k in range(top)]


def from_planes(parts: list[bytes], n: int, planes: str) -> np.ndarray:
    """The ids of a block of ``n`` from its planes."""
    out = np.zeros(n, dtype="<u4")
    if planes == "byte":
        rows = out.view(np.uint8).reshape(-1, 4)
        for k, p in enumerate(parts):
            rows[:, k] = np.frombuffer(p, dtype=np.uint8)
    else:
        for k, p in enumerate(parts):
            bits = np.unpackbits(np.frombuffer(p, dtype=np.uint8), count=n, bitorder="little")
            out |= bits.astype("<u4") << np.uint32(k)
    return out


# files
def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The store that ``path`` lies in and its place there; a shared folder or any URI that pyarrow opens."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


class FileWriter:
    """One file: ids come in, blocks go out as they fill."""

    def __init__(self, sink, planes: str, block: int, level: int):
        self.sink, self.planes, self.block = sink, planes, block
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.at, self.held, self.n_held, self.n_ids, self.n_docs = 0, [], 0, 0, 0
        self.index, self.keys, self.counts = [], [], []
        self._put(MAGIC)

    def _put(self, data: bytes) -> int:
        self.sink.write(data)
        self.at += len(data)
        return len(data)

    def add(self, ids: bytes) -> None:
        row = np.frombuffer(ids, dtype="<u4")
        self.held.append(row)
        self.n_held += len(row)
        self.n_ids += len(row)
        if self.n_held >= self.block:
            rows = np.concatenate(self.held)
            cut = len(rows) - len(rows) % self.block
            for k in range(0, cut, self.block):
                self._flush(rows[k:k + self.block])
            self.held, self.n_held = [rows[cut:].copy()], len(rows) - cut

    def _flush(self, ids: np.ndarray) -> None:
        at = self.at
        self.index.append([at, [self._put(self.zstd.compress(p)) for p in to_planes(ids, self.planes)]])

    def documents(self, keys: pa.Array, counts: list[int]) -> None:
        self.keys.append(keys)
        self.counts += counts
        self.n_docs += len(counts)

    def close(self) -> None:
        if self.n_held:
            self._flush(np.concatenate(self.held))
        keys = pa.concat_arrays(self.keys)
        table = pa.RecordBatch.from_arrays([keys, pa.array(self.counts, pa.int64())], ["key", "n_tokens"])
        out = io.BytesIO()
        with pa.ipc.new_stream(out, table.schema) as stream:
            stream.write_batch(table)
        docs = self._put(self.zstd.compress(out.getvalue()))
        about = {"planes": self.planes, "block": self.block, "n_ids": self.n_ids, "chunks": self.index}
        index = self._put(self.zstd.compress(json.dumps(about).encode()))
        self._put(struct.pack(TAIL, docs, index, MAGIC))
        self.sink.close()


class FileReader:
    """One file: its documents, and the ids of any span."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        tail = struct.calcsize(TAIL)
        docs, index, magic = struct.unpack(TAIL, self.file.read_at(tail, size - tail))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        self.zstd = zstandard.ZstdDecompressor()
        at = size - tail - index
        about = json.loads(self.zstd.decompress(self.file.read_at(index, at)))
        self.planes, self.block, self.n_ids, self.chunks = (about[k] for k in ("planes", "block", "n_ids", "chunks"))
        self._docs = at - docs, docs

    def documents(self) -> pa.RecordBatch:
        """key, n_tokens of every document, in order."""
        data = self.zstd.decompress(self.file.read_at(self._docs[1], self._docs[0]))
        return pa.ipc.open_stream(data).read_next_batch()

    def chunk(self, k: int) -> np.ndarray:
        at, lengths = self.chunks[k]
        data = self.file.read_at(sum(lengths), at)
        parts, begin = [], 0
        for length in lengths:
            parts.append(self.zstd.decompress(data[begin:begin + length]))
            begin += length
        return from_planes(parts, min(self.block, self.n_ids - k * self.block), self.planes)

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from ``start`` on (fewer at the file's end); reads only the chunks that hold them."""
        stop = min(start + count, self.n_ids)
        if start >= stop:
            return np.zeros(0, dtype="<u4")
        first = start // self.block
        rows = np.concatenate([self.chunk(k) for k in range(first, (stop - 1) // self.block + 1)])
        return rows[start - first * self.block:stop - first * self.block]


def _manifest(folder: str) -> dict:
    fs, place = file_system(folder)
    with fs.open_input_stream(f"{place}/{MANIFEST}") as f:
        return json.loads(f.read())


def read_span(folder: str, start: int, count: int) -> np.ndarray:
    """Ids ``start`` ... ``start + count - 1`` of the folder's sequence, as a trainer reads a window of it."""
    fs, place = file_system(folder)
    out = []
    for f in _manifest(folder)["files"]:
        low, high = max(start, f["start"]), min(start + count, f["start"] + f["n_ids"])
        if low < high:
            out.append(FileReader(fs, f"{place}/{f['name']}").ids(low - f["start"], high - low))
    return np.concatenate(out) if out else np.zeros(0, dtype="<u4")


# Spark source and sink
@dataclass
class _Written(WriterCommitMessage):
    files: list


class _Writer(DataSourceArrowWriter):
    """Tasks write files under names of their own; only those that the commit lists are part of the folder."""

    def __init__(self, options: dict, schema: T.StructType):
        self.folder = options["path"]
        self.planes = options.get("planes", "byte")
        self.block = int(options.get("block", BLOCK))
        self.level = int(options.get("level", 3))
        self.file_ids = int(options.get("fileids", FILE_IDS))
        fs, place = file_system(self.folder)
        if fs.get_file_info(f"{place}/{MANIFEST}").type != pafs.FileType.NotFound:
            raise ValueError(f"{self.folder} holds a sequence already; a folder is written once")
        if self.planes not in ("bit", "byte") or self.block < 1:
            raise ValueError("planes is bit or byte, block at least 1")
        if len(schema) != 2 or schema[1].dataType != T.BinaryType():
            raise ValueError("rows are a key and its ids (binary)")
        self.key = T.StructType([T.StructField("key", schema[0].dataType)]).jsonValue()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext
        fs, place = file_system(self.folder)
        fs.create_dir(place, recursive=True)
        part, files, out = TaskContext.get().partitionId(), [], None

        def close():
            out.close()
            files.append({"name": name, "part": part, "n_ids": out.n_ids, "n_docs": out.n_docs})
        for batch in iterator:
            ids = batch.column(1)
            begin = 0
            for k in range(len(batch)):
                if out is None:
                    name = f"part-{part:06d}-{len(files):04d}-{uuid.uuid4().hex[:12]}.planes"
                    out, begin = FileWriter(fs.open_output_stream(f"{place}/{name}"), self.planes, self.block, self.level), k
                out.add(ids[k].as_py() or b"")
                if out.n_ids >= self.file_ids or k == len(batch) - 1:
                    rows = ids.slice(begin, k + 1 - begin)
                    out.documents(batch.column(0).slice(begin, k + 1 - begin), [len(x.as_py() or b"") // 4 for x in rows])
                    begin = k + 1
                if out.n_ids >= self.file_ids:
                    close()
                    out = None
        if out is not None:
            close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        """The manifest appears once all tasks are done: files by partition, ids counted up."""
        files = sorted((f for m in messages if m is not None for f in m.files), key=lambda f: (f["part"], f["name"]))
        at = 0
        for f in files:
            f["start"] = at
            at += f["n_ids"]
        fs, place = file_system(self.folder)
        fs.create_dir(place, recursive=True)
        new = f"{place}/.{MANIFEST}-{uuid.uuid4().hex[:12]}"
        with fs.open_output_stream(new) as out:
            out.write(json.dumps({"key": self.key, "n_ids": at, "files": files}).encode())
        fs.move(new, f"{place}/{MANIFEST}")

    def abort(self, messages: list) -> None:
        fs, place = file_system(self.folder)
        for m in messages:
            for f in (m.files if m is not None else []):
                fs.delete_file(f"{place}/{f['name']}")


@dataclass
class _File(InputPartition):
    name: str
    start: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.files = _manifest(self.folder)["files"]

    def partitions(self) -> list[InputPartition]:
        return [_File(f["name"], f["start"]) for f in self.files] or [_File("", 0)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        fs, place = file_system(self.folder)
        file = FileReader(fs, f"{place}/{partition.name}")
        docs = file.documents()
        counts = docs.column("n_tokens").to_numpy()
        ends = np.cumsum(counts)
        n, at = len(counts), 0
        while at < n:       # documents of about a batch's bytes, one at least
            begin = int(ends[at] - counts[at])
            to = max(at + 1, int(np.searchsorted(ends, begin + BATCH_BYTES // 4, side="right")))
            data = file.ids(begin, int(ends[to - 1]) - begin)
            cuts = np.concatenate([[0], ends[at:to] - begin])
            ids = [data[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [docs.column("key").slice(at, to - at), pa.array(partition.start + begin + cuts[:-1], pa.int64()),
                 pa.array(counts[at:to], pa.int64()), pa.array(ids, pa.binary())], ["key", "start", "n_tokens", "ids"])
            at = to


class TokenPlanes(DataSource):
    """Source and sink ``token_planes``: options path, planes (byte or bit), block, level, fileids."""

    @classmethod
    def name(cls) -> str:
        return "token_planes"

    def schema(self) -> T.StructType:
        key = T.StructType.fromJson(_manifest(self.options["path"])["key"])
        return T.StructType([*key.fields, T.StructField("start", T.LongType()),
                             T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options, schema)


def in_key_order(docs: DataFrame, key: str, text: str, partitions: int | None = None) -> DataFrame:
    """key and text in ascending order of key over the partitions; rows of one key by their texts.

    Ranges are cut by key and a hash of the text, so that a key of very many
    rows is spread over several partitions; of equal hashes the texts decide.
    """
    h = fresh("_h", docs.columns)
    rows = docs.select(F.col(key).alias(key), F.col(text).alias(text)).withColumn(h, F.xxhash64(text))
    rows = rows.repartitionByRange(partitions, key, h) if partitions else rows.repartitionByRange(key, h)
    return rows.sortWithinPartitions(key, h, text).drop(h)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None, key: str = "doc_id",
                 text: str = "text", planes: str = "byte", block: int = BLOCK, partitions: int | None = None) -> None:
    """Encode every whole text and write its ids, documents in ascending order of ``key``, to ``folder``.

    Null keys come first; a null text is empty; rows of one key follow each other
    by a hash of their texts (equal rows are equal files either way). No documents: a manifest
    without files.
    """
    spark = docs.sparkSession
    spark.dataSource.register(TokenPlanes)
    rows = encode_ids(in_key_order(docs, key, text, partitions), tokenizer, end_id, text, fresh("ids", [key]))
    rows.write.format("token_planes").option("planes", planes).option("block", str(block)).mode("append").save(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """key, start (ids of the folder before the document), n_tokens, ids (binary, unsigned 32-bit little-endian)."""
    spark.dataSource.register(TokenPlanes)
    python_batches(spark)
    return spark.read.format("token_planes").load(folder)
