"""Approximate nearest neighbours by cosine: multi-index hashing.

Codes: a vector's signs under ROTATIONS learned rotations (iterative quantisation
on a bounded sample), concatenated. A code is split into 16-bit substrings, each
with its own index. Two codes within Hamming radius r = m * a + b of m substrings
agree up to a errors in one of the first b + 1 substrings, or up to a - 1 in one of
the others, so probing those ranges of every substring index retrieves every code
within the radius. What is retrieved is cut to the radius by the whole code and
reranked by the cosine of the original vectors in double precision.

The corpus is dealt into shards of about SHARD_ROWS rows by a hash of the id;
every row is indexed, every query visits every shard and leaves its best k there.
The radius is the quantile of the code distances of true neighbours in the
sample; a shard in which a query finds fewer than k rows is probed again with a
larger radius, up to all of it, so that results are never short.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, nor do null ids and vectors of another length than the
most common; of rows that repeat an id the smallest vector counts; ties go to
the smaller id; fewer candidates than k give all of them. Extra columns are
left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import Work
from panelcast.llm.vectors import matrix, unit, usable_rows

#: Rows the rotations and the radius are learned from, and queries among them.
SAMPLE_ROWS, SAMPLE_QUERIES = 4096, 256
CODE_BITS, SUBSTRING_BITS = 128, 16
#: Share of the sample's true neighbours that the radius takes in.
RADIUS_QUANTILE = 0.98
SHARD_ROWS = 4096


@dataclass
class Codes:
    """Learned projection (dimension x bits) and search radius."""

    projection: np.ndarray
    radius: int

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Codes as rows of 16-bit substrings."""
        bits = np.packbits(x @ self.projection > 0, axis=1, bitorder="little")
        return bits.view("<u2")


def rotation(x: np.ndarray, rng: np.random.Generator, rounds: int = 25) -> np.ndarray:
    """Iterative quantisation: a rotation under which the signs lose least."""
    r, _ = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.sign(x @ r).T @ x)
        r = (u @ v).T
    return r


def distances(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ code).sum(axis=1, dtype=np.int64)


def learn(sample: np.ndarray, k: int, bits: int = CODE_BITS, quantile: float = RADIUS_QUANTILE, seed: int = 5) -> Codes:
    rng, x = np.random.default_rng(seed), unit(sample)
    parts, width = [], 0
    while width < bits:
        # Several rotations of the same space where one has fewer signs than the code has bits.
        parts.append(rotation(x, rng))
        width += x.shape[1]
    codes = Codes(np.concatenate(parts, axis=1)[:, :bits], bits)
    own = codes.encode(x)
    found = []
    for q in range(min(SAMPLE_QUERIES, len(x))):
        cos = x @ x[q]
        cos[q] = -np.inf
        near = np.argsort(-cos, kind="stable")[:min(k, len(x) - 1)]
        found.append(distances(own[near], own[q]))
    found = np.concatenate(found) if found else np.zeros(0)
    codes.radius = int(np.quantile(found, quantile)) if len(found) else bits
    return codes


class Shard:
    """Substring indexes over the rows of a shard."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, codes: Codes):
        self.ids, self.x, self.model = ids, x, codes
        self.norm = np.sqrt((x * x).sum(axis=1))
        self.codes = codes.encode(x)
        self.tables = []
        for j in range(self.codes.shape[1]):
            self.tables.append(np.unique(self.codes[:, j], return_inverse=True))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within the radius: pigeonhole probing, then whole codes."""
        each, rest = divmod(radius, len(self.tables))
        hit = np.zeros(len(self.ids), bool)
        for j, (values, bucket) in enumerate(self.tables):
            reach = each if j <= rest else each - 1
            if reach >= 0:
                # Probe the buckets of the values in reach; rows know their bucket.
                hit |= (np.bitwise_count(values ^ code[j]) <= reach)[bucket]
        rows = np.flatnonzero(hit)
        return rows[distances(self.codes[rows], code) <= radius]

    def search(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the best k rows but the query's own, ties to smaller ids."""
        code, radius = self.model.encode(q[None])[0], self.model.radius
        bits = 16 * len(self.tables)
        want = min(k, int((self.ids != query_id).sum()))
        while True:
            rows = self.within(code, radius)
            rows = rows[self.ids[rows] != query_id]
            if len(rows) >= want or radius >= bits:
                break
            radius = min(bits, radius + max(4, bits // 16))
        # Row sums instead of a matrix product: equal vectors get equal scores.
        score = (self.x[rows] * q).sum(axis=1) / (self.norm[rows] * np.sqrt((q * q).sum()))
        best = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows][best], score[best]


def search(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
           shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, id, score): the k nearest rows found for every row for which
    ``is_query`` (an expression on the column id) holds."""
    spark = vectors.sparkSession
    work = Work(spark, "multi-index")
    rows = work.table(usable_rows(vectors, id_col, vec_col).select(F.col("id").cast("long").alias("id"), "vec"), "rows")
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("vec").toArrow()
    kind = "query_id long, id long, score double"
    if not sample.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, id long, score double")
    model = spark.sparkContext.broadcast(learn(matrix(sample.column(0).combine_chunks()), k))
    n_shards = max(1, -(-rows.count() // shard_rows))

    def run(batches):
        import pyarrow as pa

        from panelcast.llm.multi_index import Shard
        from panelcast.llm.vectors import matrix
        current, held, shard = None, [], None
        for batch in batches:
            where, query, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            x = matrix(batch.column(3))
            out = []
            cuts = np.flatnonzero((np.diff(where) != 0) | (np.diff(query) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)]):
                if where[lo] != current:
                    current, held, shard = where[lo], [], None
                if not query[lo]:
                    held.append((ids[lo:hi], x[lo:hi]))
                    continue
                if shard is None:
                    if not held:
                        continue
                    shard, held = Shard(*map(np.concatenate, zip(*held)), model.value), []
                for i in range(lo, hi):
                    near, score = shard.search(ids[i], x[i], k)
                    out.append((np.full(len(near), ids[i]), near, score))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query_id", "id", "score"])

    index = rows.select(F.pmod(F.xxhash64("id"), F.lit(n_shards)).cast("int").alias("shard"), F.lit(0).alias("query"), "id", "vec")
    queries = rows.where(is_query).select(F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"),
                                          F.lit(1).alias("query"), "id", "vec")
    # A shard's rows come first in its partition, then its queries stream past them.
    dealt = index.unionByName(queries).repartition("shard").sortWithinPartitions("shard", "query", "id")
    found = dealt.mapInArrow(run, kind)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")


def recall(vectors: DataFrame, found: DataFrame, is_query: Column, k: int, id_col: str = "vec_id",
           vec_col: str = "embedding", n_queries: int = 128) -> float:
    """Share of the true k nearest that ``found`` has, for at most ``n_queries`` queries
    (smallest hash of their id), against all rows in blocks."""
    rows = usable_rows(vectors, id_col, vec_col).select(F.col("id").cast("long").alias("id"), "vec")
    asked = rows.where(is_query).orderBy(F.xxhash64("id"), "id").limit(n_queries).toArrow()
    if not asked.num_rows:
        return 1.0
    q_ids, q = asked.column(0).to_numpy(), matrix(asked.column(1).combine_chunks())

    def run(batches):
        import pyarrow as pa

        from panelcast.llm.vectors import matrix, unit
        for batch in batches:
            ids, cos = batch.column(0).to_numpy(), unit(q) @ unit(matrix(batch.column(1))).T
            cos[q_ids[:, None] == ids[None, :]] = -np.inf
            near = np.argsort(-cos, axis=1, kind="stable")[:, :k]
            score = np.take_along_axis(cos, near, 1)
            ok = np.isfinite(score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(q_ids, near.shape[1])[ok.ravel()]), pa.array(ids[near][ok]), pa.array(score[ok])],
                ["query_id", "id", "score"])

    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    true = (rows.mapInArrow(run, "query_id long, id long, score double")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "id"))
    both = true.join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    n, hits = both.agg(F.count("*"), F.count("hit")).first()
    return hits / n if n else 1.0
