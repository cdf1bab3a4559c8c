"""Packing token ids into fixed-length sequences: concatenate and cut.

Pass 1 encodes every document (ids plus an end id) and writes them with their
place inside their partition; the token totals of the partitions give, by a
prefix sum, the global offset of each partition. Pass 2 adds the offsets and
cuts the one long stream at every multiple of the sequence length. A document
that crosses a cut gives one boundary record per sequence. No row is shuffled,
nothing is padded but the last sequence.

Order of the stream: partition of the scan, then row order in it.

Defined results: null or empty text has the end id only; a text longer than a
sequence is cut as often as needed; repeated rows and ids are separate
documents; an empty table gives no piece. Extra columns are left out.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import Work

SEQUENCE_TOKENS = 4096


def encode_documents(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int) -> DataFrame:
    """(part, part_start, id, n_tokens, ids): ids as little-endian integers of
    the vocabulary's width, part_start = tokens before the row in its partition."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from panelcast.llm.tokens import as_bytes, encoder, small_batches
        part, at, enc = TaskContext.get().partitionId(), 0, encoder(path)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in small_batches(batches):
            ids = [e.tobytes() + end for e in enc.encode(as_bytes(batch.column(1)))]
            n = np.array([len(e) // enc.dtype.itemsize for e in ids], np.int64)
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), part, np.int64)), pa.array(starts), batch.column(0), pa.array(n),
                 pa.array(ids, pa.binary())], ["part", "part_start", "id", "n_tokens", "ids"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"part long, part_start long, id {kind}, n_tokens long, ids binary")


def partition_offsets(totals: DataFrame) -> DataFrame:
    """(part, base): exclusive prefix sum of (part, n); one row per input task."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def cut_pieces(encoded: DataFrame, offsets: DataFrame, width: int, length: int, with_ids: bool = False) -> DataFrame:
    """Pieces of the documents between the cuts: (id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset[, ids])."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            cols = [[] for _ in range(8)]
            place = []
            starts, n, ids = (np.asarray(batch.column(i)) for i in (1, 2, 3))
            for row, (g, count, own) in enumerate(zip(starts.tolist(), n.tolist(), ids)):
                ids32 = np.frombuffer(own, f"<u{width}").astype("<u4")
                at = 0
                while at < count:
                    seq, offset = divmod(g + at, length)
                    size = min(length - offset, count - at)
                    payload = ids32[at:at + size].tobytes()
                    place.append(row)
                    for c, v in zip(cols, (at, size, zlib.crc32(payload), count, seq, offset, payload)):
                        c.append(v)
                    at += size
            out = [batch.column(0).take(pa.array(place, pa.int64()))] + [pa.array(c, pa.int64()) for c in cols[:6]]
            if with_ids:
                out.append(pa.array(cols[6], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names)

    kind = encoded.schema["id"].dataType.simpleString()
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = (f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long"
              + ", ids binary" * with_ids)
    # One row per input task: bounded by the number of tasks of one job.
    placed = encoded.join(F.broadcast(offsets), "part")
    return placed.select("id", (F.col("base") + F.col("part_start")).alias("at"), "n_tokens", "ids").mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
         length: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """Pieces of every document in sequences of ``length`` tokens."""
    from panelcast.llm.tokens import encoder
    work = Work(docs.sparkSession, "packing")
    encoded = work.table(encode_documents(docs, id_col, text_col, path, end_id), "ids")
    totals = work.table(encoded.groupBy("part").agg(F.sum("n_tokens").alias("n")), "totals")
    return cut_pieces(encoded, partition_offsets(totals), encoder(path).dtype.itemsize, length, with_ids)


def sequences(pieces: DataFrame, pad_id: int, length: int = SEQUENCE_TOKENS) -> DataFrame:
    """(sequence_id, n_tokens, ids): the sequences of ``pack(..., with_ids=True)``,
    ids as little-endian unsigned 32-bit integers. A short sequence is padded to
    ``length`` unless its own length is a power of two. At most ``length``
    pieces meet in a group."""
    joined = (pieces.groupBy("sequence_id")
              .agg(F.sum("length").alias("n_tokens"),
                   F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")))
    n = F.col("n_tokens")
    power = F.bit_count(n) == 1
    pad = F.lit(bytearray(int(pad_id).to_bytes(4, "little")))
    filler = F.array_repeat(pad, F.when(power, F.lit(0)).otherwise(F.lit(length) - n).cast("int"))
    parts = F.concat(F.transform("parts", lambda p: p["ids"]), filler)
    # A fold would copy the growing value for every piece; hex text is joined once.
    return joined.select("sequence_id", "n_tokens",
                         F.unhex(F.array_join(F.transform(parts, lambda b: F.hex(b)), "")).alias("ids"))
