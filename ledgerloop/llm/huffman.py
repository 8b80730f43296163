"""Token ids in files of canonical, length-limited Huffman codes.

The code is made from the counts of all ids.  Lengths are limited (package-merge), so that one
table of 2^limit entries decodes any code in one step; codes of one length ascend with the id, so the
lengths alone give the code.  Every block carries them: a folder is read without anything else.

A file is a Parquet file whose rows are blocks; it can lie in any store that Spark writes to.  A
block holds whole documents in ascending order of their ids:

    part, block        position of the file and of the block in it
    first              ids in this file before the block
    doc_ids, n_tokens  the documents, and their numbers of ids, end id included
    payload            codes, first bit first; each document starts at a whole byte
    checkpoints        of every document, each 64 ids, the bit in the payload where they start
    lengths            one byte per id of the vocabulary, its code's length, deflated; the same in all
                       blocks, so that the dictionary of a Parquet file holds it once

Files are cut by ranges of document ids, of about as many documents each; a block ends before the
document that would make it longer than its bound.  Blocks are independent.  All stretches between
checkpoints of many blocks are decoded side by side, one id of each per step.

A null text has no ids but its end id.  Documents without an id come first; those that repeat an
id stand next to each other in the order of their ids' bytes.

Texts are read whole, whatever their length.  An empty table writes no file and gives an empty result.
Only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloop.llm.bpe import codec_of, vocabulary
from ledgerloop.llm.common import Workspace, read_table, share, total

END_ID = 2
LIMIT = 18
CHECKPOINT = 64
#: Ids per block (a longer document is a block of its own) and per file.
BLOCK_IDS = 1 << 19
FILE_IDS = 1 << 23


def limited_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Code lengths of the least total for these counts, none above `limit`; 0: no code.

    Package-merge.  Each level merges the symbols with pairs of the level below; going back, the
    symbols among the first 2n - 2 items of a level gain one bit each, which are its smallest.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.int64)
    n = len(used)
    if n == 1:
        lengths[used] = 1
    if n < 2:
        return lengths
    limit = max(limit, int(n - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    levels: list[np.ndarray] = []
    weights = leaves
    is_leaf = np.ones(n, dtype=bool)
    levels.append(is_leaf)
    for _ in range(limit - 1):
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        sort = np.argsort(both, kind="stable")
        weights = both[sort]
        levels.append(sort < n)
    take = 2 * n - 2
    for is_leaf in reversed(levels):
        own = int(np.count_nonzero(is_leaf[:take]))
        lengths[order[:own]] += 1
        take = 2 * (take - own)
    return lengths


@dataclass
class Code:
    lengths: np.ndarray

    def __post_init__(self):
        used = np.flatnonzero(self.lengths)
        order = used[np.lexsort((used, self.lengths[used]))]
        self.bits = int(self.lengths.max(initial=1))
        steps = np.uint64(1) << (self.bits - self.lengths[order]).astype(np.uint64)
        starts = np.concatenate([[0], np.cumsum(steps)])[:-1].astype(np.uint64)
        self.codes = np.zeros(len(self.lengths), dtype=np.uint64)
        self.codes[order] = starts >> (self.bits - self.lengths[order]).astype(np.uint64)
        self.symbol_at = np.zeros(1 << self.bits, dtype=np.uint32)
        self.length_at = np.ones(1 << self.bits, dtype=np.uint8)
        filled = np.repeat(order, steps.astype(np.int64))
        self.symbol_at[: len(filled)] = filled
        self.length_at[: len(filled)] = self.lengths[filled]

    def packed(self) -> bytes:
        """The lengths as a block holds them."""
        return zlib.compress(self.lengths.astype(np.uint8).tobytes(), 9)

    @classmethod
    def unpacked(cls, lengths: bytes) -> Code:
        return cls(np.frombuffer(zlib.decompress(lengths), np.uint8).astype(np.int64))

    def encode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Of documents of these sizes, one after the other: the payload, and the bit at which
        each id starts."""
        length = self.lengths[ids]
        ends = np.cumsum(length)
        doc_ends = np.cumsum(sizes)
        doc_bits = np.diff(ends[doc_ends - 1], prepend=0)
        doc_bytes = (doc_bits + 7) // 8
        shift = (np.cumsum(doc_bytes) - doc_bytes) * 8 - (np.cumsum(doc_bits) - doc_bits)
        at = ends - length + np.repeat(shift, sizes)
        word, offset = at >> 6, at & 63
        over = offset + length - 64
        code = self.codes[ids]
        spill = np.flatnonzero(over > 0)
        head = code << np.maximum(-over, 0).astype(np.uint64)
        head[spill] = code[spill] >> over[spill].astype(np.uint64)
        size = int(doc_bytes.sum())
        out = np.zeros(size // 8 + 2, dtype=np.uint64)
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[starts]] = np.bitwise_or.reduceat(head, starts)
        out[word[spill] + 1] |= code[spill] << (64 - over[spill]).astype(np.uint64)
        return out.astype(">u8").tobytes()[:size], at

    def decode(self, payload: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The ids of stretches that start at these bits, one after the other."""
        data = np.frombuffer(payload + bytes(4), dtype=np.uint8).astype(np.uint32)
        window = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        order = np.argsort(-sizes, kind="stable")
        at = starts[order].astype(np.int64)
        to = (np.cumsum(sizes) - sizes)[order]
        out = np.empty(int(sizes.sum()), dtype=np.uint32)
        active = np.searchsorted(-sizes[order], -np.arange(int(sizes.max(initial=0))), "left")
        mask, rest = np.uint32((1 << self.bits) - 1), 32 - self.bits
        for step, n in enumerate(active.tolist()):
            p = at[:n]
            index = window[p >> 3] >> (rest - (p & 7)).astype(np.uint32) & mask
            out[to[:n] + step] = self.symbol_at[index]
            p += self.length_at[index]
        return out


def tokenize(docs: DataFrame, definition: str, ws: Workspace) -> DataFrame:
    """A written table of key, n and ids (two bytes each if the vocabulary allows, else four)."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    source = docs.select(F.col("doc_id").alias("key"), "text")

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        narrow = codec.size <= 1 << 16
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            encoded = [e + end for e in codec.encode_array(batch.column("text"))]
            size = pa.array([len(e) // 4 for e in encoded], pa.int64())
            if narrow:
                encoded = [np.frombuffer(e, "<u4").astype("<u2").tobytes() for e in encoded]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), size, pa.array(encoded, pa.binary())],
                names=["key", "n", "ids"],
            )

    tokens = source.mapInArrow(run, "key long, n long, ids binary")
    path = ws.new_path("token-ids")
    tokens.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(tokens.schema).parquet(path)


def _numbers(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4")


def count_ids(tokens: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs; one number per id of the vocabulary reaches the driver."""

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            ids = batch.column("ids").cast(pa.large_binary())
            if not len(ids):
                continue
            # All documents' bytes lie one after the other.
            _, offsets, data = ids.buffers()
            edges = np.frombuffer(offsets, np.int64)[ids.offset : ids.offset + len(ids) + 1]
            joined = memoryview(data)[int(edges[0]) : int(edges[-1])]
            wide = np.frombuffer(joined, "<u2" if size <= 1 << 16 else "<u4")
            for start in range(0, len(wide), 1 << 20):
                counts += np.bincount(wide[start : start + (1 << 20)], minlength=size)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(counts[seen])], names=["id", "count"]
        )

    found = tokens.select("ids").mapInArrow(run, "id int, count long")
    counts = np.zeros(size, dtype=np.int64)
    for row in found.groupBy("id").agg(F.sum("count").alias("count")).collect():
        counts[row["id"]] = row["count"]
    return counts


BLOCK_SCHEMA = (
    "part int, block int, first long, doc_ids array<long>, n_tokens array<long>, "
    "payload binary, checkpoints array<long>, lengths binary"
)


def write_files(tokens: DataFrame, code: Code, path: str, file_ids: int = FILE_IDS) -> None:
    """Writes the files below `path`, each with the next higher range of document ids."""
    files = max(1, -(-total(tokens, "n") // file_ids))
    shared = share(tokens.sparkSession, code)

    def build(batches: Iterator) -> Iterator[pa.RecordBatch]:
        code = shared()
        lengths = code.packed()
        before, block, n_held = 0, 0, 0
        keys: list = []
        sizes: list[int] = []
        held: list[np.ndarray] = []
        part = TaskContext.get().partitionId()

        def finished() -> pa.RecordBatch:
            n = np.array(sizes, dtype=np.int64)
            payload, at = code.encode(np.concatenate(held).astype(np.int64), n)
            starts = np.cumsum(n) - n
            marks = np.concatenate(
                [np.arange(s, s + m, CHECKPOINT) for s, m in zip(starts.tolist(), sizes)]
            )
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([before], pa.int64()),
                    pa.array([keys], pa.list_(pa.int64())),
                    pa.array([sizes], pa.list_(pa.int64())),
                    pa.array([payload], pa.binary()),
                    pa.array([at[marks]], pa.list_(pa.int64())),
                    pa.array([lengths], pa.binary()),
                ],
                names=[
                    "part", "block", "first", "doc_ids", "n_tokens", "payload", "checkpoints",
                    "lengths",
                ],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "n", "ids")]
            for key, n, ids in zip(*columns):
                if held and n_held + n > BLOCK_IDS:
                    yield finished()
                    before, block, n_held = before + n_held, block + 1, 0
                    keys, sizes, held = [], [], []
                keys.append(key)
                sizes.append(n)
                n_held += n
                held.append(_numbers(ids, n))
        if held:
            yield finished()

    # Rows of one id, and those without an id, lie in one range; the number of ranges is kept.
    ranges = tokens.repartitionByRange(files, "key").sortWithinPartitions("key", "ids")
    blocks = ranges.mapInArrow(build, BLOCK_SCHEMA)
    blocks.write.option("compression", "none").parquet(path)


def read_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, start (ids before it in all files), n_tokens, ids (bytes of
    little-endian unsigned 32-bit integers; null if not asked for) and their crc32.  The folder is
    all that is read."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    sizes = blocks.select(
        "part", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")
    )
    # One row per file.
    files = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        packed, code = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                block = {c: batch.column(c)[k] for c in batch.schema.names}
                lengths = block["lengths"].as_py()
                if lengths != packed:
                    packed, code = lengths, Code.unpacked(lengths)
                n = np.array(block["n_tokens"].as_py(), dtype=np.int64)
                marks = block["checkpoints"].values.to_numpy()
                stretches = -(-n // CHECKPOINT)
                lengths = np.full(int(stretches.sum()), CHECKPOINT, dtype=np.int64)
                lengths[np.cumsum(stretches) - 1] = n - (stretches - 1) * CHECKPOINT
                ids = code.decode(block["payload"].as_py(), marks, lengths).astype("<u4")
                ends = np.cumsum(n)
                data = memoryview(ids.tobytes())
                own = [data[4 * (e - m) : 4 * e] for e, m in zip(ends.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block["part"].as_py()] * len(n), pa.int32()),
                        pa.array(block["first"].as_py() + ends - n),
                        block["doc_ids"].values,
                        pa.array(n),
                        pa.array([bytes(x) if with_ids else None for x in own], pa.binary()),
                        pa.array([zlib.crc32(x) for x in own], pa.int64()),
                    ],
                    names=["part", "first", "doc_id", "n_tokens", "ids", "ids_crc32"],
                )

    rows = blocks.mapInArrow(
        run, "part int, first long, doc_id long, n_tokens long, ids binary, ids_crc32 long"
    )
    return rows.join(files, "part").select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids", "ids_crc32"
    )


def op6_huffman(spark: SparkSession, folder: str) -> DataFrame:
    ws = Workspace(spark)
    definition = vocabulary()
    tokens = tokenize(read_table(spark, folder, "documents"), definition, ws)
    counts = count_ids(tokens, codec_of(definition).size)
    code = Code(limited_lengths(counts))
    path = ws.new_path("huffman-files")
    write_files(tokens, code, path)
    return read_files(spark, path, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")
