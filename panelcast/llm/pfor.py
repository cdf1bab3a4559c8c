"""Token ids in files of patched frame-of-reference blocks.

A segment holds whole documents. Its ids are cut into blocks of BLOCK_IDS; a
block stores its minimum, the bit width that holds a chosen percentile of the
differences to the minimum, the differences packed at that width, and an
exception list (position, high bits) for the outliers. An index of block starts
allows reading a range of ids without decoding the rest. Segments are the rows
of a Parquet table, which Spark commits and reads in any store, in ascending
document order. Texts are encoded where they are scanned; only ids are shuffled,
to range partitions whose bounds come from the documents' ids and text hashes
(a repeated id may span several), and sorted inside each.

Segment layout, little-endian: magic 'PFR1'; uint32 documents, block size,
blocks; uint64 ids; uint32 ids per document; uint64 block starts (from the
first block, one more than blocks); blocks. Block: uint32 minimum, uint8 width,
uint16 exceptions; packed differences; uint16 positions; uint32 high bits.

Defined results: null or empty text has the end id only; rows that repeat an id
stand next to each other, ordered by the hash of their text; null ids come
first; an empty table gives an empty file set. Extra columns are left out.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import Work
from panelcast.llm.packing import partition_offsets

MAGIC = b"PFR1"
BLOCK_IDS = 1024
WIDTH_PERCENTILE = 0.95
#: A segment is closed at this many ids; a longer document is a segment alone.
SEGMENT_IDS = 500_000
_HEAD = struct.Struct("<4sIIIQ")
_BLOCK = struct.Struct("<IBH")


def _pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of unsigned integers packed at ``width`` bits, lowest bit first. 64 values fill
    ``width`` words of 64 bits; the k-th values of all groups are shifted in together."""
    rows, n = values.shape
    lanes = np.zeros((64, rows, -(-n // 64)), np.uint64)
    for k in range(min(64, n)):
        own = values[:, k::64]
        lanes[k, :, :own.shape[1]] = own
    words = np.zeros((width, *lanes.shape[1:]), np.uint64)
    for k in range(64):
        word, shift = divmod(k * width, 64)
        words[word] |= lanes[k] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= lanes[k] >> np.uint64(64 - shift)
    packed = np.ascontiguousarray(words.transpose(1, 2, 0)).astype("<u8", copy=False)
    return packed.reshape(rows, -1).view(np.uint8)[:, :(n * width + 7) // 8]


def _unpack_bits(packed: np.ndarray, width: int, n: int) -> np.ndarray:
    rows, groups = len(packed), -(-n // 64)
    full = np.zeros((rows, groups * width * 8), np.uint8)
    full[:, :packed.shape[1]] = packed
    words = np.ascontiguousarray(full.view("<u8").reshape(rows, groups, width).transpose(2, 0, 1))
    mask = np.uint64((1 << width) - 1)
    out = np.zeros((rows, groups, 64), np.uint32)
    for k in range(64):
        word, shift = divmod(k * width, 64)
        lane = words[word] >> np.uint64(shift)
        if shift + width > 64:
            lane |= words[word + 1] << np.uint64(64 - shift)
        out[:, :, k] = lane & mask
    return out.reshape(rows, -1)[:, :n]


def encode_blocks(ids: np.ndarray, block: int = BLOCK_IDS, percentile: float = WIDTH_PERCENTILE) -> list[bytes]:
    """The blocks of ``ids``; full blocks are packed together by width."""
    n_full = len(ids) // block
    out: list[bytes] = [b""] * (n_full + (len(ids) % block > 0))
    for first, rows in ((0, ids[:n_full * block].reshape(n_full, block)), (n_full, ids[n_full * block:].reshape(1, -1))):
        if not rows.size:
            continue
        low = rows.min(axis=1)
        diff = (rows - low[:, None]).astype(np.uint32, copy=False)
        rank = min(rows.shape[1] - 1, int(percentile * rows.shape[1]))
        mark = np.partition(diff, rank, axis=1)[:, rank]
        widths = np.ceil(np.log2(mark.astype(np.float64) + 1)).astype(int)
        for width in np.unique(widths).tolist():
            own = np.flatnonzero(widths == width)
            part = diff[own]
            packed = _pack_bits(part & np.uint32((1 << width) - 1), width) if width else np.zeros((len(own), 0), np.uint8)
            high = part >> np.uint32(width) if width < 32 else np.zeros_like(part)
            for k, i in enumerate(own.tolist()):
                at = np.flatnonzero(high[k])
                out[first + i] = (_BLOCK.pack(int(low[i]), width, len(at)) + packed[k].tobytes()
                                  + at.astype("<u2").tobytes() + high[k][at].astype("<u4").tobytes())
    return out


def write_segment(docs: list[np.ndarray], block: int = BLOCK_IDS, percentile: float = WIDTH_PERCENTILE) -> bytes:
    ids = np.concatenate(docs).astype(np.uint32, copy=False) if docs else np.zeros(0, np.uint32)
    blocks = encode_blocks(ids, block, percentile)
    starts = np.cumsum([0, *map(len, blocks)])
    return b"".join([_HEAD.pack(MAGIC, len(docs), block, len(blocks), len(ids)),
                     np.array([len(d) for d in docs], "<u4").tobytes(), starts.astype("<u8").tobytes(), *blocks])


class Segment:
    """Reader of one segment."""

    def __init__(self, data: bytes):
        magic, n_docs, self.block, self.n_blocks, self.n_ids = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        at = _HEAD.size
        self.doc_tokens = np.frombuffer(data, "<u4", n_docs, at).astype(np.int64)
        at += 4 * n_docs
        self.starts = np.frombuffer(data, "<u8", self.n_blocks + 1, at).astype(np.int64)
        self.body, self.data = at + 8 * (self.n_blocks + 1), data

    def blocks(self, first: int, last: int) -> np.ndarray:
        """Ids of the blocks first..last-1; blocks of one width are unpacked together."""
        by_width: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
        for b in range(first, last):
            at = self.body + int(self.starts[b])
            low, width, n_exc = _BLOCK.unpack_from(self.data, at)
            n = min(self.block, self.n_ids - b * self.block)
            by_width.setdefault((width, n), []).append((b, at + _BLOCK.size, low, n_exc))
        out = np.zeros(max(0, min(last * self.block, self.n_ids) - first * self.block), np.uint32)
        for (width, n), own in by_width.items():
            size = (n * width + 7) // 8
            packed = np.stack([np.frombuffer(self.data, np.uint8, size, at) for _, at, _, _ in own])
            values = _unpack_bits(packed, width, n) if width else np.zeros((len(own), n), np.uint32)
            for row, (b, at, low, n_exc) in zip(values, own):
                if n_exc:
                    where = np.frombuffer(self.data, "<u2", n_exc, at + size)
                    row[where] |= np.frombuffer(self.data, "<u4", n_exc, at + size + 2 * n_exc) << np.uint32(width)
                out[(b - first) * self.block:(b - first) * self.block + n] = row + np.uint32(low)
        return out

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids start..stop-1 of the segment, by the index of block starts."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        first, last = start // self.block, -(-stop // self.block)
        return self.blocks(first, last)[start - first * self.block:stop - first * self.block]


def range_bounds(keys: DataFrame) -> list[tuple]:
    """Upper ends (id, text hash) of balanced ranges of ``keys``, but for the last range;
    as many as shuffle partitions."""
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = keys.repartitionByRange(n, "id", "hash").groupBy(F.spark_partition_id().alias("part"))
    ends = ranges.agg(F.max(F.struct("id", "hash")).alias("end")).collect()
    return sorted((_order(r.end.id, r.end.hash) for r in ends))[:-1]


def _order(key, text_hash: int) -> tuple:
    """Sort key of a row: null ids first."""
    return (key is not None, *(() if key is None else (key,)), text_hash)


def encode_ranges(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(part, id, hash, ids): the ids of every document with the end id, as little-endian
    integers of the vocabulary's width, and its range partition."""
    def run(batches):
        from bisect import bisect_left

        import pyarrow as pa

        from panelcast.llm.pfor import _order
        from panelcast.llm.tokens import as_bytes, encoder, small_batches
        enc = encoder(path)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in small_batches(batches):
            keys = map(_order, batch.column(0).to_pylist(), batch.column(1).to_pylist())
            ids = [e.tobytes() + end for e in enc.encode(as_bytes(batch.column(2)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([bisect_left(bounds, k) for k in keys], pa.int32()), *batch.columns[:2], pa.array(ids, pa.binary())],
                ["part", "id", "hash", "ids"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    source = source.select("id", F.xxhash64("text").alias("hash"), "text")
    # For the bounds a hash of the row number is as good as that of the text, which so is not read.
    bounds = range_bounds(source.select("id", F.xxhash64(F.monotonically_increasing_id()).alias("hash")))
    kind = source.schema["id"].dataType.simpleString()
    encoded = source.mapInArrow(run, f"part int, id {kind}, hash long, ids binary")
    return encoded.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("part", "id", "hash")


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Write the ids of all documents to ``folder`` in ascending id order: rows
    (part, part_start, doc_ids, n_ids, segment)."""
    from panelcast.llm.tokens import encoder
    width = encoder(path).dtype.itemsize

    def run(batches):
        import pyarrow as pa

        from panelcast.llm.pfor import SEGMENT_IDS, write_segment
        from panelcast.llm.tokens import small_batches

        def segment():
            size = sum(map(len, held))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([at], pa.int64()), pa.array([keys], pa.list_(kind)),
                 pa.array([size], pa.int64()), pa.array([write_segment(held)], pa.binary())],
                ["part", "part_start", "doc_ids", "n_ids", "segment"])

        part, at, keys, held, size, kind = None, 0, [], [], 0, None
        for batch in small_batches(batches):
            kind = batch.column(1).type
            for own, key, data in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                ids = np.frombuffer(data, f"<u{width}")
                if held and (own != part or size + len(ids) > SEGMENT_IDS):
                    yield segment()
                    at, keys, held, size = at + size, [], [], 0
                if own != part:
                    part, at = own, 0
                keys.append(key)
                held.append(ids)
                size += len(ids)
        if held:
            yield segment()

    encoded = encode_ranges(docs, path, end_id, id_col, text_col)
    kind = encoded.schema["id"].dataType.simpleString()
    (encoded.mapInArrow(run, f"part long, part_start long, doc_ids array<{kind}>, n_ids long, segment binary")
     .write.mode("overwrite").parquet(folder))


def read_tokens(spark, folder: str, with_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) of every document in ``folder``."""
    def run(batches):
        import pyarrow as pa

        from panelcast.llm.pfor import Segment
        for batch in batches:
            for at, keys, data in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                seg = Segment(data)
                ids = seg.ids().astype("<u4", copy=False)
                n = seg.doc_tokens
                ends = np.cumsum(n)
                docs = [ids[i:j].tobytes() for i, j in zip((ends - n).tolist(), ends.tolist())]
                out = [keys.values, pa.array(at + ends - n), pa.array(n),
                       pa.array([zlib.crc32(d) for d in docs], pa.int64())]
                yield pa.RecordBatch.from_arrays(out + [pa.array(docs, pa.binary())] * with_ids, names)

    files = spark.read.parquet(folder)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row per range partition: bounded by the number of tasks of one job.
    based = files.join(F.broadcast(partition_offsets(totals)), "part")
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    names = ["id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    return (based.select((F.col("base") + F.col("part_start")).alias("at"), "doc_ids", "segment")
            .mapInArrow(run, f"id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids))


def roundtrip(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files and read them back."""
    folder = Work(docs.sparkSession, "token-files").path("segments")
    write_tokens(docs, folder, path, end_id, id_col, text_col)
    return read_tokens(docs.sparkSession, folder)
