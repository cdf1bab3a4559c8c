"""Importance resampling of a corpus towards a target text set.

Features are the word n-grams of a text, hashed into a fixed number of buckets
by a position-table CRC (``position_crc``). The log ratio of the two bucket
distributions is the gain of a bucket; a document's weight is the sum of its
features' gains, and Gumbel noise made from its id turns "largest scores" into
a draw without replacement.

Plan: one map-only pass per corpus counts buckets (each task emits at most one
row per bucket), the gains are one row per bucket, a second map-only pass
weighs the documents. Only (id, counts, weight, score) rows are sorted, by a
range partition on the score; ranks come from prefix sums over partition sizes.

Defined results: null and empty texts, and texts without words, have no feature
and weight 0; a null id counts as an empty id in the noise and comes first
among ties; rows that repeat an id are separate documents; an empty corpus
gives no row, an empty target set counts 0 in every bucket. Texts of any length
are read in slices that overlap by the n-gram's reach. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import Work
from panelcast.llm.packing import partition_offsets

BUCKETS = 10000
NGRAM = 3
SEED = "42"
#: Text bytes that are handled at a time.
SLICE_BYTES = 400_000
_SPACE = 32


def _byte_maps() -> tuple[np.ndarray, np.ndarray]:
    """(folded byte, is a word byte): digits, letters and every byte above 127."""
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    word = np.zeros(256, bool)
    word[48:58] = word[97:123] = word[128:] = True
    return np.where(word[fold], fold, np.uint8(_SPACE)), word[fold]


class Features:
    """Buckets of word n-grams, for groups of texts."""

    def __init__(self, buckets: int = BUCKETS, ngram: int = NGRAM):
        from panelcast.llm.position_crc import SpanCrc
        self.crc, self.buckets, self.ngram = SpanCrc(), buckets, ngram
        self.fold, self.word = _byte_maps()

    def _words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(data, end of each word, text of each word): the words of all texts, folded,
        each followed by one space."""
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        inside = self.word[raw]
        keep = inside.copy()
        keep[1:] |= inside[:-1]
        data = self.fold[raw[keep]]
        stops = np.cumsum([len(t) + 1 for t in texts])
        seen = np.searchsorted(np.flatnonzero(inside[:-1] & ~inside[1:]), stops)
        return data, np.flatnonzero(data == _SPACE), np.repeat(np.arange(len(texts)), np.diff(seen, prepend=0))

    def _slice(self, texts: list[bytes], skip: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, text, bucket) of the n-grams, arrays per n; n-grams that end in the first
        ``skip`` words are left out."""
        data, ends, text = self._words(texts)
        starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        for k in range(min(self.ngram, len(ends))):
            own = np.flatnonzero(text[:len(text) - k] == text[k:])
            own = own[own + k >= skip]
            if len(own):
                yield k + 1, text[own], self.crc.of(data, starts[own], ends[own + k]) % np.uint32(self.buckets)

    def _long(self, text: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The same of a text that is longer than a slice: cut between words, the last
        words of a slice lead the next one."""
        at, lead = 0, []
        while at < len(text):
            end = at + SLICE_BYTES
            while end < len(text) and self.word[text[end]]:
                end += 1
            part = text[at:end]
            yield from self._slice([b" ".join([*lead, part])], len(lead))
            data, ends, _ = self._words([part])
            tail = data.tobytes()[:-1].split(b" ")[-(self.ngram - 1):] if len(ends) else []
            lead = ([*lead, *tail])[-(self.ngram - 1):] if self.ngram > 1 else []
            at = end

    def of(self, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, row, bucket) arrays that cover all n-grams of the texts."""
        first, size = 0, 0
        for i, t in enumerate([*texts, None]):
            big = t is not None and len(t) > SLICE_BYTES
            if first < i and (t is None or big or size + len(t) > SLICE_BYTES):
                for n, row, found in self._slice(texts[first:i]):
                    yield n, first + row, found
                first, size = i, 0
            if big:
                for n, row, found in self._long(t):
                    yield n, i + row, found
                first, size = i + 1, 0
            elif t is not None:
                size += len(t) + 1


def bucket_counts(texts: DataFrame, text_col: str, buckets: int = BUCKETS, ngram: int = NGRAM) -> DataFrame:
    """(bucket, n) over all texts; only buckets that occur."""
    def run(batches):
        import pyarrow as pa

        from panelcast.llm.importance import Features
        from panelcast.llm.tokens import as_bytes, small_batches
        found, n = Features(buckets, ngram), np.zeros(buckets, np.int64)
        for batch in small_batches(batches):
            for _, _, own in found.of([t or b"" for t in as_bytes(batch.column(0))]):
                n += np.bincount(own, minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at])], ["bucket", "n"])

    rows = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket from the two count tables; add-one smoothed,
    in thousandths of a natural logarithm, rounded down."""
    total = {name: df.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("n")).scalar()
             for name, df in (("s", corpus), ("t", target))}
    every = corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = (every.join(corpus.select("bucket", F.col("n").alias("s")), "bucket", "left")
            .join(target.select("bucket", F.col("n").alias("t")), "bucket", "left"))
    s, t = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in "st")
    ratio = (t + 1) * (total["s"] + float(buckets)) / ((s + 1) * (total["t"] + float(buckets)))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def weigh(docs: DataFrame, gain: list[int], id_col: str = "doc_id", text_col: str = "text",
          ngram: int = NGRAM) -> DataFrame:
    """(id, n_words, n_features, weight) of every row; ``gain`` has one entry per bucket."""
    def run(batches):
        import pyarrow as pa

        from panelcast.llm.importance import Features
        from panelcast.llm.tokens import as_bytes, small_batches
        found, value = Features(len(gain), ngram), np.array(gain, np.int64)
        for batch in small_batches(batches):
            texts = [t or b"" for t in as_bytes(batch.column(1))]
            words, n, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
            for size, row, own in found.of(texts):
                each = np.bincount(row, minlength=len(texts))
                n += each
                words += each * (size == 1)
                # Sums of whole numbers far below 2^53 are exact in doubles.
                weight += np.bincount(row, value[own], len(texts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(n), pa.array(weight)],
                ["id", "n_words", "n_features", "weight"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def noise(id_col: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, fixed by seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(scored: DataFrame, work: Work, order: list[Column]) -> DataFrame:
    """``scored`` with ``rank`` (from 1) by ``order``: range partitions, sorted inside
    each; a row's rank is the size of the partitions before plus its own place."""
    place = F.monotonically_increasing_id()
    rows = work.table(scored.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", place), "sorted")
    rows = rows.withColumn("part", F.expr("shiftright(place, 33)"))
    # One row per range partition: bounded by the number of tasks of one job.
    offsets = partition_offsets(rows.groupBy("part").agg(F.count("*").alias("n")))
    inside = F.col("place") - F.expr("shiftleft(part, 33)")
    return (rows.join(F.broadcast(offsets), "part")
            .select(*scored.columns, (F.col("base") + inside + 1).alias("rank")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", percent: int = 5, min_words: int = 20, buckets: int = BUCKETS,
             ngram: int = NGRAM, seed: str = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every document: of those with
    at least ``min_words`` words the ``percent`` hundredths (rounded down) of highest
    score are drawn, ranked from 1 (ties to the smaller id); rank is null for the others."""
    work = Work(docs.sparkSession, "importance")
    table = gains(work.table(bucket_counts(docs, text_col, buckets, ngram), "corpus"),
                  work.table(bucket_counts(target, target_col, buckets, ngram), "target"), buckets)
    # One number per bucket, whatever the size of the corpus.
    gain = [r.gain for r in table.orderBy("bucket").collect()]
    weighed = weigh(docs, gain, id_col, text_col, ngram)
    scored = work.table(weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "scored")
    fits = F.col("n_words") >= min_words
    drawn = F.floor(scored.where(fits).agg(F.count("*").alias("n")).scalar() * percent / 100)
    order = [F.col("score").desc(), F.col("id").asc(), F.col("n_features").asc(), F.col("weight").asc()]
    inside = ranked(scored.where(fits), work, order)
    inside = inside.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return inside.unionByName(scored.where(~fits).withColumn("rank", F.lit(None).cast("long")))
