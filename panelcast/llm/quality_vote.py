"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Terms of a document are its hashed words (runs of letters, digits and bytes above
127, A-Z lower-cased), the three-byte grams inside words, n-grams of its character
shapes (runs of one character kind count once: letters by case, digits, each
punctuation mark, blanks, line ends, other bytes) and marks of repeated words and
lines. Terms are weighted by log frequency and inverse document frequency, each
kind of term to a fixed share of the vector, projected on the leading singular
vectors of the labelled rows, and scaled to unit length. Every
document is compared with every labelled vector (exact cosines, in blocks), and
the labels of its nearest neighbours vote with their similarities as weights.

Fitting is bounded: at most MAX_PER_CLASS rows of each label, those with the
smallest hash of their id, so the broadcast model has a fixed size bound
(MAX_PER_CLASS, TERMS and DIMENSIONS are parameters of ``fit``). Votes are
weighed back to the label shares of all labelled rows.

Defined results: null and empty texts have no terms and get the share of label
1; so does every text if no label or one class only is known (share 0.5 without
any label); labels that are null are left out, a document with several labels
has their mean, rounded up; repeated rows get the same score. Extra columns are
left out of ``score`` and kept by ``keep_good``.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.common import named, packed, unpacked

MAX_PER_CLASS = 2000
TERMS = 4096
DIMENSIONS = 64
NEIGHBOURS = 25
#: Exponent of a neighbour's cosine, and weight of the prior share.
SHARPNESS, PRIOR_WEIGHT = 8.0, 0.02
#: Length of the word and gram parts of a vector; shapes and marks have length 1.
WORD_WEIGHT, GRAM_WEIGHT = 0.5, 0.5
#: Text bytes that are turned into terms at a time; a word at a cut counts as two.
SLICE_BYTES = 400_000
THRESHOLD = 0.7

_KIND = np.array([0 if b > 127 else 1 if chr(b).islower() else 2 if chr(b).isupper() else 3 if chr(b).isdigit()
                  else 5 if b == 10 else 4 if chr(b).isspace() else b + 6 for b in range(256)], np.uint64)
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint64)
_IN_WORD = np.array([b > 127 or chr(b).isalnum() for b in range(256)])
_MIX = np.uint64(0x9E3779B97F4A7C15)


def parts(terms: int) -> tuple[slice, slice, slice, slice]:
    """Where shapes, words, grams and the 16 repetition marks lie among the terms."""
    words, marks = terms // 4, terms - 16
    return slice(0, marks - 2 * words), slice(marks - 2 * words, marks - words), slice(marks - words, marks), slice(marks, terms)


def _bins(values: np.ndarray, n: int) -> np.ndarray:
    """How many values fall into each of ``n`` hash bins."""
    return np.bincount(((values * _MIX) >> np.uint64(40)).astype(np.int64) % n, minlength=n)


def _repeats(values: np.ndarray) -> list[int]:
    """How often a value follows itself at distance 1, 2 and 3, and occurs again at all."""
    return [int((values[d:] == values[:-d]).sum()) for d in (1, 2, 3)] + [len(values) - len(np.unique(values))]


def _count_shapes(data: np.ndarray, counts: np.ndarray) -> None:
    """Add the shape n-grams of a run of bytes to ``counts``."""
    kind = _KIND[data]
    runs = kind[np.flatnonzero(np.diff(kind, prepend=np.uint64(255)))]
    gram = np.zeros(len(runs), np.uint64)
    for n in range(1, 6):
        gram = gram[:len(runs) - n + 1] * np.uint64(257) + runs[n - 1:] + np.uint64(1)
        if not len(gram):
            break
        if n > 1:
            counts += _bins(gram, len(counts))


def _count_words(data: np.ndarray, words: np.ndarray, grams: np.ndarray) -> None:
    """Add the words and their three-byte grams of a run of bytes to the counts."""
    at = np.flatnonzero(_IN_WORD[data])
    if not len(at):
        return
    low = _LOWER[data[at]]
    first = np.flatnonzero(np.diff(at, prepend=at[0] - 2) > 1)
    place = (at - np.repeat(at[first], np.diff(first, append=len(at)))).astype(np.uint64)
    letter = (low + place * np.uint64(257) + np.uint64(1)) * _MIX
    letter = (letter ^ (letter >> np.uint64(29))) * _MIX
    words += _bins(np.add.reduceat(letter, first), len(words))
    three = (low[:-2] << np.uint64(16)) + (low[1:-1] << np.uint64(8)) + low[2:]
    grams += _bins(three[at[2:] - at[:-2] == 2], len(grams))


def _hashes(text: bytes, sep: bytes | None) -> np.ndarray:
    return np.fromiter(map(hash, text.split(sep)), np.int64)


def term_counts(text: bytes, terms: int = TERMS) -> np.ndarray:
    """Term counts of a whole text; the last 16 terms are the repetition marks."""
    counts = np.zeros(terms, np.float64)
    data = np.frombuffer(text, np.uint8)
    shapes, words, grams, _ = (counts[part] for part in parts(terms))
    for i in range(0, len(data), SLICE_BYTES):
        _count_shapes(data[i:i + SLICE_BYTES], shapes)
        _count_words(data[i:i + SLICE_BYTES], words, grams)
    if text:
        words, lines = _hashes(text, None), _hashes(text, b"\n")
        for at, values in ((terms - 16, words), (terms - 8, lines)):
            if len(values) > 3:
                again = _repeats(values)
                counts[at:at + 4] = again
                # A share of repeated words or lines is a term of its own, whatever the length.
                counts[at + 4:at + 8] = [len(values) * (r > len(values) / 4) for r in again]
    return counts


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """log(1 + share * 1000) of the terms, times idf; each kind of term is brought to its
    length, then rows to unit length. Shares are of the kind's total, marks' of the shapes'."""
    shapes, words, grams, marks = parts(counts.shape[1])
    rows = np.empty(counts.shape, np.float32)
    for part, total in ((shapes, shapes), (words, words), (grams, grams), (marks, shapes)):
        sums = np.maximum(counts[:, total].sum(axis=1, keepdims=True), 1)
        rows[:, part] = np.log1p(1000 * counts[:, part] / sums) * idf[part]
    form = np.sqrt((rows[:, shapes] ** 2).sum(axis=1, keepdims=True) + (rows[:, marks] ** 2).sum(axis=1, keepdims=True))
    for part in (shapes, marks):
        rows[:, part] /= np.where(form > 0, form, 1)
    rows[:, words] = WORD_WEIGHT * _unit(rows[:, words])
    rows[:, grams] = GRAM_WEIGHT * _unit(rows[:, grams])
    return _unit(rows)


@dataclass
class Model:
    """Broadcast model: idf, projection, labelled vectors, their labels and vote weights."""

    terms: int
    share: float
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return self.projected(weigh(counts, self.idf))

    def projected(self, weighted: np.ndarray) -> np.ndarray:
        rows = weighted @ self.projection
        norm = np.linalg.norm(rows, axis=1, keepdims=True)
        return rows / np.where(norm > 1e-6, norm, np.inf)

    def score(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(counts), self.share)
        cos = self.latent(counts) @ self.vectors.T
        k = min(neighbours, cos.shape[1])
        near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        vote = np.maximum(np.take_along_axis(cos, near, 1), 0).astype(np.float64) ** SHARPNESS * self.weights[near]
        voted = (vote * self.labels[near]).sum(axis=1)
        return (voted + PRIOR_WEIGHT * self.share) / (vote.sum(axis=1) + PRIOR_WEIGHT)


def held_out(id_col: str):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def count_column(docs: DataFrame, id_col: str, text_col: str, terms: int) -> DataFrame:
    """(id, counts) of documents, counts as compressed float32 bytes."""
    def run(batches):
        import pyarrow as pa

        from panelcast.llm.quality_vote import term_counts
        from panelcast.llm.tokens import as_bytes, small_batches
        for batch in small_batches(batches):
            rows = [zlib.compress(term_counts(t or b"", terms).astype(np.float32).tobytes(), 1) for t in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["id", "counts"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, counts binary")


def _unpack(fitted: list[tuple[int, bytes]]) -> np.ndarray:
    return np.stack([np.frombuffer(zlib.decompress(packed_counts), np.float32) for _, packed_counts in fitted])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        per_class: int = MAX_PER_CLASS, terms: int = TERMS, dimensions: int = DIMENSIONS) -> Model:
    """Fit on at most ``per_class`` labelled rows of each label that are not held out."""
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("label")))
    known = known.join(docs.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = totals.get(1, 0) / sum(totals.values()) if totals else 0.5
    if len(totals) < 2:
        none = np.zeros((0, 1), np.float32)
        return Model(terms, share, np.ones(terms), np.zeros((terms, 1), np.float32), none, none[:, 0], none[:, 0])
    order = F.xxhash64(F.col("id").cast("string"))
    chosen = None
    for label in (0, 1):
        own = known.where(F.col("label") == label).orderBy(order, "id").limit(per_class)
        chosen = own if chosen is None else chosen.unionByName(own)
    # At most 2 * per_class ids.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # One row per chosen id, however often the id is repeated: the one with the smallest hash.
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = rows.select(F.struct("id", "label").alias("key"), "text")
    found = {r["id"]["id"]: (r["id"]["label"], r["counts"]) for r in count_column(rows, "key", "text", terms).collect()}
    fitted = [found[k] for k in sorted(found)]
    y = np.array([f[0] for f in fitted], np.float64)
    # Only the weighted rows are kept whole, in single precision; counts are unpacked in blocks.
    blocks = [fitted[i:i + 256] for i in range(0, len(fitted), 256)]
    idf = np.log((1 + len(y)) / (1 + sum((_unpack(b) > 0).sum(axis=0) for b in blocks))) + 0.1
    x = np.empty((len(y), terms), np.float32)
    for i, block in enumerate(blocks):
        x[256 * i:256 * i + len(block)] = weigh(_unpack(block), idf)
    # Leading right singular vectors by subspace iteration from a fixed start.
    basis = np.random.default_rng(9).standard_normal((terms, min(dimensions + 16, *x.shape))).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    _, _, turn = np.linalg.svd(x @ basis, full_matrices=False)
    model = Model(terms, share, idf, (basis @ turn.T)[:, :dimensions], np.zeros((0, 1)), y, y)
    weights = np.where(y == 1, share / max((y == 1).mean(), 1e-9), (1 - share) / max((y == 0).mean(), 1e-9))
    model.vectors, model.weights = model.projected(x), weights
    return model


def _scored(rows: DataFrame, model: Model) -> DataFrame:
    """``rows``, whose first column is ``text``, with the column ``score`` behind."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        from panelcast.llm.quality_vote import term_counts
        from panelcast.llm.tokens import as_bytes, small_batches
        m = shared.value
        for batch in small_batches(batches):
            texts, out = as_bytes(batch.column(0)), []
            for i in range(0, len(texts), 128):
                out.append(m.score(np.stack([term_counts(t or b"", m.terms) for t in texts[i:i + 128]])))
            scores = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names)

    names = [*rows.columns, "score"]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every document."""
    rows = docs.select(named(text_col).cast("string").alias("text"), named(id_col).alias("id"))
    return _scored(rows, model).select("id", "score")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, all columns. A model that has
    learned nothing (no label, or one class only, is known) rejects no document."""
    if not len(model.vectors):
        return docs
    rows = docs.select(named(text_col).cast("string").alias("text"), packed(docs, text_col))
    text = F.col("text").cast(docs.schema[text_col].dataType)
    return _scored(rows, model).where(F.col("score") >= threshold).select(*unpacked(docs, **{text_col: text}))
