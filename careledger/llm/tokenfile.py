"""Operator 9: token ids in files of independent zstandard frames with a seek table.

File format (the public seekable zstandard layout): data frames, each a zstandard frame
of its own over the ids of some documents, then one skippable frame that holds the seek
table: per data frame its compressed size, decompressed size and the low 32 bits of the
XXH64 of its content (little-endian unsigned 32-bit each), closed by the number of frames
(4 bytes), a descriptor (1 byte, bit 7: checksums present) and the number 0x8F92EAB1.
The first data frame of a file is its header: a JSON object with the number of documents,
the width of an id and the number of ids, documents and frames, then the documents' ids
(null: the smallest int64) and token counts as little-endian int64.

A reader gets header and seek table first and then decompresses only frames that hold a
document it wants, checking each frame's checksum.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as c
from .tokens import token_ids, tokenizer_path

SEEK_MAGIC, SKIP_MAGIC, DESCRIPTOR = 0x8F92EAB1, 0x184D2A5E, 0x80
#: Ids of a frame; a longer document has several frames of its own.
FRAME = 1 << 16
NO_ID = -(1 << 63)


def _fs(uri: str):
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _sum(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class Writer:
    """One file; ``add`` documents in order, then ``close``. Written under another name, then moved into place."""

    def __init__(self, uri: str, width: int = 4, frame: int = FRAME, level: int = 3):
        import zstandard

        self.fs, self.path = _fs(uri)
        self.own = f"{self.path}.{uuid.uuid4().hex}"
        self.zip = zstandard.ZstdCompressor(level=level, write_checksum=False)
        self.frame, self.kind = frame, np.dtype("<u2" if width == 2 else "<u4")
        self.docs, self.counts, self.held, self.n, self.frames, self.data = [], [], [], 0, [], []

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append(NO_ID if doc_id is None else doc_id)
        self.counts.append(len(ids))
        self.held.append(ids.astype(self.kind))
        self.n += len(ids)
        if self.n >= self.frame:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        flat = np.concatenate(self.held) if self.held else np.zeros(0, self.kind)
        at = 0
        while len(flat) - at >= self.frame or (last and at < len(flat)):
            self._put(flat[at : at + self.frame].tobytes(), self.data)
            at += self.frame
        self.held, self.n = [flat[at:]], max(0, len(flat) - at)

    def _put(self, raw: bytes, to: list) -> None:
        z = self.zip.compress(raw)
        to.append((z, len(raw), _sum(raw)))

    def close(self) -> None:
        self._flush(True)
        head: list = []
        meta = json.dumps({"documents": len(self.docs), "width": self.kind.itemsize, "frame": self.frame, "ids": int(sum(self.counts))}).encode()
        self._put(struct.pack("<I", len(meta)) + meta + np.array(self.docs, "<i8").tobytes() + np.array(self.counts, "<i8").tobytes(), head)
        frames = head + self.data
        table = b"".join(struct.pack("<III", len(z), n, s) for z, n, s in frames) + struct.pack("<IBI", len(frames), DESCRIPTOR, SEEK_MAGIC)
        with self.fs.open_output_stream(self.own) as f:
            for z, _, _ in frames:
                f.write(z)
            f.write(struct.pack("<II", SKIP_MAGIC, len(table)) + table)
        self.fs.move(self.own, self.path)


class Reader:
    """Random access to a file's documents; ``frames_read`` counts decompressed data frames."""

    def __init__(self, uri: str):
        import zstandard

        fs, path = _fs(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or not flags & 0x80:
            raise ValueError(f"{uri}: no seek table")
        raw = self._at(size - 9 - 12 * n, 12 * n)
        skip, length = struct.unpack("<II", self._at(size - 17 - 12 * n, 8))
        if skip != SKIP_MAGIC or length != 12 * n + 9:
            raise ValueError(f"{uri}: broken seek table")
        self.table = np.frombuffer(raw, "<u4").reshape(n, 3).astype(np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        self.unzip = zstandard.ZstdDecompressor()
        self.uri = uri
        head = self._frame(0)
        (m,) = struct.unpack("<I", head[:4])
        meta = json.loads(head[4 : 4 + m])
        self.kind, self.per_frame, d = np.dtype("<u2" if meta["width"] == 2 else "<u4"), meta["frame"], meta["documents"]
        self.ids = np.frombuffer(head, "<i8", d, 4 + m)
        self.counts = np.frombuffer(head, "<i8", d, 4 + m + 8 * d)
        self.starts = np.cumsum(self.counts) - self.counts
        self.frames_read, self._last = 0, (-1, None)

    def _at(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def _frame(self, k: int) -> bytes:
        raw = self.unzip.decompress(self._at(int(self.start[k]), int(self.table[k, 0])), max_output_size=int(self.table[k, 1]))
        if len(raw) != self.table[k, 1] or _sum(raw) != self.table[k, 2]:
            raise ValueError(f"{self.uri}: frame {k} is damaged")
        return raw

    def _data(self, k: int) -> np.ndarray:
        if self._last[0] != k:
            self.frames_read += 1
            self._last = (k, np.frombuffer(self._frame(k + 1), self.kind))
        return self._last[1]

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document of the file, uint32."""
        a, b = int(self.starts[i]), int(self.starts[i] + self.counts[i])
        out = []
        while a < b:
            k, s = divmod(a, self.per_frame)
            part = self._data(k)[s : s + b - a]
            out.append(part)
            a += len(part)
        return np.concatenate(out).astype(np.uint32) if out else np.zeros(0, np.uint32)

    def close(self) -> None:
        self.file.close()


def _write(path, end_id, width, root):
    def run(batches):
        writer = at = None

        def done():
            writer.close()
            return pa.record_batch([pa.array([at], pa.int32()), pa.array([f"{root}/part-{at:08d}.tok"]), pa.array([len(writer.docs)], pa.int64()),
                                    pa.array([int(sum(writer.counts))], pa.int64())], names=["part", "file", "documents", "tokens"])

        for b in batches:
            part, ids = b.column(0).to_numpy(), b.column(1).to_pylist()
            for i, j, flat, per in token_ids(c.texts_of(b.column(2)), path):
                stop = np.cumsum(per)
                for x in range(i, j):
                    if part[x] != at:
                        if writer:
                            yield done()
                        at = int(part[x])
                        writer = Writer(f"{root}/part-{at:08d}.tok", width)
                    own = flat[stop[x - i] - per[x - i] : stop[x - i]]
                    writer.add(ids[x], np.append(own, np.uint32(end_id)))
        if writer:
            yield done()

    return run, "part int, file string, documents long, tokens long"


def write_tokens(docs: DataFrame, root: str, path: str | None = None, end_id: int = 2, rows_each: int = 4000) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text) to files below ``root``, in ascending doc_id order over all files
    (null first, repeated ids by text), and return one row (part, file, documents, tokens) per file.

    Each file is one range of doc_id of about ``rows_each`` documents; ids take two bytes where the vocabulary
    allows it. A null text is an empty one. A task that is run again writes the same file again and moves it into
    place whole. An empty table writes no file.
    """
    path = path or tokenizer_path("word_bpe_49k.json")
    spark = docs.sparkSession
    fs, at = _fs(root)
    fs.create_dir(at, recursive=True)
    from tokenizers import Tokenizer

    width = 2 if Tokenizer.from_file(path).get_vocab_size(True) <= 1 << 16 else 4
    rows = c.columns_of(docs, {"doc_id": "long", "text": "string"})
    bounds = c.range_bounds(rows, "doc_id", rows_each)
    rows = rows.select(c.range_of(F.col("doc_id"), bounds).cast("int").alias("part"), "doc_id", "text")
    rows = rows.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "doc_id", "text")
    fn, schema = _write(path, end_id, width, root)
    return c.stored(rows.mapInArrow(fn, schema), "files")


def read_tokens(spark, files: DataFrame) -> DataFrame:
    """One row per document of the files of ``write_tokens``: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 and ids, as read back."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = files.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    files = c.stored(files, "bases")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        for b in batches:
            for uri, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                r = Reader(uri)
                for at in range(0, len(r.ids), 1024):
                    out = [[], [], [], [], []]
                    for i in range(at, min(at + 1024, len(r.ids))):
                        ids = r.document(i)
                        out[0].append(None if r.ids[i] == NO_ID else int(r.ids[i]))
                        out[1].append(base + int(r.starts[i]))
                        out[2].append(len(ids))
                        out[3].append(zlib.crc32(ids.astype("<u4").tobytes()))
                        out[4].append(ids.view(np.int32))
                    yield pa.record_batch([pa.array(x, f.type) for x, f in zip(out, schema, strict=True)], schema=schema)
                r.close()

    n = files.count()
    spread = files.select("file", "base", "part").repartition(max(1, n), "part").select("file", "base")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>")


def op9_token_binary_output(spark, sf_dir):
    docs = c.read_table(spark, sf_dir, "documents")
    return read_tokens(spark, write_tokens(docs, c.new_dir(spark, "tokens"))).drop("ids")
