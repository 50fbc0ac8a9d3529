"""Token ids in fixed-width packed binary files (operator 2).

A shard file holds the ids of consecutive documents, each id in the fewest bits
that the vocabulary needs, least significant bit first:

    blocks of BLOCK_IDS ids, each padded to whole bytes
    block table   little-endian u64, byte offset of every block, then their end
    document table  u64 start of every document in ids, then their end
    document ids  i64, then one byte a document: 1 if the id is null
    footer        u64 ids, u64 documents, u32 ids a block, u32 bits, 8 bytes of magic

Blocks and tables are written as a stream, so a writer holds one block and 17
bytes a document. Any range of ids is read from the blocks it touches alone.

Defined results: documents stand in ascending (doc_id, text) order, null ids
first; null or empty text is the end id alone; repeated rows are each written;
an empty table gives no shards with ids and no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .pieces import PieceCache, compiled, worker_cache
from .runtime import fresh_dir, texts_of
from .words import text_chunks

MAGIC = b"IDPACK01"
BLOCK_IDS = 8192
_FOOTER = np.dtype([("ids", "<u8"), ("docs", "<u8"), ("block", "<u4"), ("bits", "<u4"), ("magic", "S8")])


def bits_for(vocab_size: int) -> int:
    return max(1, int(vocab_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as consecutive ``bits``-wide fields, the last byte padded with zeros."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first n ids of a packed block."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=n).astype(np.uint32)
    planes = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=n * bits).reshape(n, bits)
    return (planes.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


class ShardWriter:
    """Streams documents into one shard; the file appears under its name only
    when complete, so a lost or repeated task leaves no half-written shard."""

    def __init__(self, uri: str, bits: int, block: int = BLOCK_IDS):
        self.fs, self.path = pafs.FileSystem.from_uri(uri)
        self.temp = f"{self.path}.{uuid.uuid4().hex[:8]}.tmp"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.temp)
        self.bits, self.block = bits, block
        self.table, self.starts, self.names = [0], [0], []
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.names.append(doc_id)
        self.starts.append(self.starts[-1] + len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block:
            self._flush(False)

    def _flush(self, everything: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        to = len(ids) if everything else len(ids) // self.block * self.block
        for i in range(0, to, self.block):
            data = pack(ids[i:min(i + self.block, to)], self.bits)
            self.out.write(data)
            self.table.append(self.table[-1] + len(data))
        self.held, self.n_held = [ids[to:]], len(ids) - to

    def close(self) -> None:
        self._flush(True)
        for part in (np.array(self.table, "<u8"), np.array(self.starts, "<u8"),
                     np.array([0 if x is None else x for x in self.names], "<i8"),
                     np.array([x is None for x in self.names], np.uint8),
                     np.array([(self.starts[-1], len(self.names), self.block, self.bits, MAGIC)], _FOOTER)):
            self.out.write(part.tobytes())
        self.out.close()
        self.fs.move(self.temp, self.path)


class ShardReader:
    """Random access to one shard file."""

    def __init__(self, uri: str):
        self.fs, self.path = pafs.FileSystem.from_uri(uri)
        self.file = self.fs.open_input_file(self.path)
        size = self.file.size()
        foot = np.frombuffer(self.file.read_at(_FOOTER.itemsize, size - _FOOTER.itemsize), _FOOTER)[0]
        if foot["magic"] != MAGIC:
            raise ValueError(f"no packed id shard: {uri}")
        self.n_ids, self.n_docs, self.block, self.bits = (int(foot[k]) for k in ("ids", "docs", "block", "bits"))
        n_blocks = -(-self.n_ids // self.block)
        sizes = [8 * (n_blocks + 1), 8 * (self.n_docs + 1), 8 * self.n_docs, self.n_docs]
        at = size - _FOOTER.itemsize - sum(sizes)
        raw = self.file.read_at(sum(sizes), at)
        cut = np.cumsum([0, *sizes])
        self.table = np.frombuffer(raw[cut[0]:cut[1]], "<u8").astype(np.int64)
        self.starts = np.frombuffer(raw[cut[1]:cut[2]], "<u8").astype(np.int64)
        names, null = np.frombuffer(raw[cut[2]:cut[3]], "<i8"), np.frombuffer(raw[cut[3]:cut[4]], np.uint8)
        self.names = pa.array(names, pa.int64(), mask=null.astype(bool))

    def ids(self, start: int, count: int) -> np.ndarray:
        """Ids [start, start + count), from the blocks that hold them."""
        if count <= 0:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (start + count - 1) // self.block
        lo = int(self.table[first])
        raw = self.file.read_at(int(self.table[last + 1]) - lo, lo)
        out = [unpack(raw[int(self.table[b]) - lo:int(self.table[b + 1]) - lo],
                      min(self.block, self.n_ids - b * self.block), self.bits) for b in range(first, last + 1)]
        return np.concatenate(out)[start - first * self.block:][:count]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1] - self.starts[k]))


def _encoder(content: bytes):
    def make():
        from tokenizers import Tokenizer
        tk = Tokenizer.from_str(content.decode())
        tk.encode_special_tokens = True  # their strings in a text are ordinary text

        def encode(pieces: list[bytes]) -> list[list[int]]:
            out = []
            for i in range(0, len(pieces), 2048):  # the library's results are larger than their ids
                some = [p.decode() for p in pieces[i:i + 2048]]
                out += [e.ids for e in tk.encode_batch_fast(some, add_special_tokens=False)]
            return out
        return PieceCache(encode)
    return worker_cache("library_" + hashlib.md5(content).hexdigest(), make)


def _as_loaded(content: bytes):
    def make():
        from tokenizers import Tokenizer
        return Tokenizer.from_str(content.decode())
    return worker_cache("loaded_" + hashlib.md5(content).hexdigest(), make)


def rows_with(data: np.ndarray, off: np.ndarray, strings: list[bytes]) -> set[int]:
    """The rows that hold any of the strings."""
    raw, out = data.tobytes(), set()
    for s in strings:
        at = raw.find(s)
        while at >= 0:
            row = int(np.searchsorted(off, at, side="right")) - 1
            if at + len(s) <= off[row + 1]:
                out.add(row)
                at = raw.find(s, int(off[row + 1]))
            else:  # from one row into the next
                at = raw.find(s, at + 1)
    return out


def write_shards(docs: DataFrame, tokenizer_path: str, pattern: str, end_id: int, out_dir: str | None = None,
                 special_as_text: bool = True) -> tuple[str, DataFrame]:
    """Encode every text with the tokenizers library, append ``end_id`` and write
    one packed shard a range of doc_ids, in ascending order.

    The texts are cut with ``pattern``, the byte-level pre-tokenisation, and the
    library encodes each distinct piece once a worker. Strings of added tokens are
    ordinary text; without ``special_as_text`` they are what the tokenizer as loaded
    makes of them: a text that holds one goes to it whole. Returns the folder and
    the manifest (shard, n_ids, n_docs, first_id), one row a shard.
    """
    import json

    spark = docs.sparkSession
    out_dir = out_dir or fresh_dir(spark, "idpack")
    with open(tokenizer_path, "rb") as f:
        content = f.read()
    made = json.loads(content)
    bits = bits_for(max([*made["model"]["vocab"].values(), *(t["id"] for t in made["added_tokens"]), end_id]) + 1)
    shared = spark.sparkContext.broadcast(content)
    added = [] if special_as_text else [t["content"].encode() for t in made["added_tokens"] if t["content"]]

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        writer, shard, cache, cut = None, TaskContext.get().partitionId(), _encoder(shared.value), compiled(pattern)
        end = np.array([end_id], np.uint32)
        for b in batches:
            for lo, hi, data, off in text_chunks(b.column(1)):
                writer = writer or ShardWriter(f"{out_dir}/shard-{shard:06d}.ids", bits)
                ids, at = cache.rows(data, off, cut)
                whole = rows_with(data, off, added)
                for k, name in enumerate(b.column(0).slice(lo, hi - lo).to_pylist()):
                    own = ids[at[k]:at[k + 1]]
                    if k in whole:
                        text = data[off[k]:off[k + 1]].tobytes().decode()
                        own = np.array(_as_loaded(shared.value).encode(text, add_special_tokens=False).ids, np.uint32)
                    writer.add(name, np.concatenate((own, end)))
        if writer:
            writer.close()
            yield pa.record_batch([pa.array([x], pa.int64()) for x in (shard, writer.starts[-1], len(writer.names))],
                                  ["shard", "n_ids", "n_docs"])

    rows = (texts_of(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    rows.mapInArrow(run, "shard long, n_ids long, n_docs long").write.parquet(f"{out_dir}/written")
    # one row a shard: as many as there were tasks
    sizes = sorted(tuple(r) for r in spark.read.parquet(f"{out_dir}/written").collect())
    first, manifest = 0, []
    for shard, n_ids, n_docs in sizes:
        manifest.append((shard, n_ids, n_docs, first))
        first += n_ids
    return out_dir, spark.createDataFrame(manifest, "shard long, n_ids long, n_docs long, first_id long")


def read_documents(spark: SparkSession, out_dir: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 from
    the shard files; a shard is read some blocks at a time."""
    def run(batches):
        for b in batches:
            for shard, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                r = ShardReader(f"{out_dir}/shard-{shard:06d}.ids")
                at = 0
                while at < r.n_docs:
                    to = max(at + 1, int(np.searchsorted(r.starts, r.starts[at] + (1 << 20), side="right")) - 1)
                    to = min(to, r.n_docs)
                    ids = r.ids(int(r.starts[at]), int(r.starts[to] - r.starts[at])).astype("<u4")
                    off = (r.starts[at:to + 1] - r.starts[at]).tolist()
                    crc = [zlib.crc32(ids[i:j]) for i, j in zip(off, off[1:])]
                    yield pa.record_batch([r.names.slice(at, to - at), pa.array(first + r.starts[at:to]),
                                           pa.array(np.diff(r.starts[at:to + 1])), pa.array(crc, pa.int64())],
                                          ["doc_id", "start", "n_tokens", "ids_crc32"])
                    at = to

    shards = max(1, manifest.count())
    return (manifest.select("shard", "first_id").repartition(shards)
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))
