"""Line de-duplication over a corpus, with DataFrame functions only.

Method: lines become 128-bit key hashes; hashes are range-partitioned and
sorted inside each partition by hash and document (largest first), so that the
first document of a hash in the stream is the one that keeps all its lines (the
order of positions inside a document decides nothing).
The result is a compressed keep bitmap per document, not text: one 64-bit
word per 64 lines, and only the words in which a line is dropped.

Hot keys: a line that holds more than 1 / HEAVY_SLOTS of all lines would be
one sort group. Such keys (fewer than HEAVY_SLOTS of them, by counting) are
found exactly through counts per hash slot, decided with a two-level
aggregate that combines map-side, and joined back as a broadcast table.

Defined results: null or empty text is one empty line; a null ``doc_id`` is
one document, smaller than all others; rows that repeat a ``doc_id`` are the
same document, and each row keeps its own bitmap; documents without a dropped
line have no bitmap. Extra columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import SPACE, Work, lower_ascii, named, packed, unpacked

HEAVY_SLOTS = 65536
#: Groups up to this size are sorted like any other, however small the corpus.
SMALL_GROUP = 1000


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _row_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per line whose key has at least ``min_chars`` code points:
    document, hash of its text (tells repeated ids apart), position, key hash."""
    lines = docs.select(F.col(id_col).alias("doc"), _row_hash(F.col(text_col)).alias("row_hash"),
                        F.posexplode(split_lines(F.col(text_col))).alias("pos", "line"))
    stripped = lines.select("doc", "row_hash", "pos", F.trim("line", F.lit(SPACE)).alias("key"))
    key = lower_ascii(F.col("key"))
    return (stripped.where(F.char_length("key") >= min_chars)
            .select("doc", "row_hash", "pos", key.alias("key"))
            .select("doc", "row_hash", "pos", F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit("second"), "key").alias("h2")))


def _heavy_keys(keys: DataFrame, min_docs: int) -> DataFrame:
    """Keys with more than 1 / HEAVY_SLOTS of all rows: (h1, h2, last_doc, shared)."""
    slot = F.pmod(F.col("h1"), F.lit(HEAVY_SLOTS)).alias("slot")
    slots = keys.groupBy(slot).agg(F.count("*").alias("n"))
    total = slots.agg(F.sum("n").alias("n")).scalar()
    limit = F.greatest(total / F.lit(HEAVY_SLOTS), F.lit(float(SMALL_GROUP)))
    # Fewer than HEAVY_SLOTS slots can pass, so this table is bounded.
    full = slots.where(F.col("n") > limit).select("slot")
    inside = keys.withColumn("slot", slot).join(F.broadcast(full), "slot", "left_semi")
    per_doc = inside.groupBy("h1", "h2", "doc").agg(F.count("*").alias("n"))
    per_key = per_doc.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.count("*").alias("n_docs"),
                                              F.max("doc").alias("last_doc"))
    return per_key.where(F.col("n") > limit).select("h1", "h2", "last_doc",
                                                    (F.col("n_docs") >= min_docs).alias("shared"))


def dropped_lines(keys: DataFrame, work: Work, min_docs: int) -> DataFrame:
    """(doc, row_hash, pos) of every line to drop."""
    heavy = F.broadcast(work.table(_heavy_keys(keys, min_docs), "heavy"))
    hot = (keys.join(heavy, ["h1", "h2"])
           .where(F.col("shared") & ~F.col("doc").eqNullSafe(F.col("last_doc"))))
    # Range partitioning by the hash already clusters the window: no further exchange.
    stream = keys.join(heavy, ["h1", "h2"], "left_anti").repartitionByRange("h1", "h2")
    group = Window.partitionBy("h1", "h2")
    ranked = (stream.withColumn("nth_doc", F.dense_rank().over(group.orderBy(F.col("doc").desc_nulls_last())))
              .withColumn("n_docs", F.max("nth_doc").over(group)))
    cold = ranked.where((F.col("n_docs") >= min_docs) & (F.col("nth_doc") > 1))
    cols = ["doc", "row_hash", "pos"]
    return hot.select(cols).unionByName(cold.select(cols))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Compressed keep bitmaps: (doc, row_hash, n_dropped, keep), where ``keep``
    lists (word, bits) of the 64-line words with a dropped line, bit = 1 for a
    kept line; words that are not listed keep all their lines."""
    work = Work(docs.sparkSession, "line-dedup")
    keys = work.table(line_keys(docs, id_col, text_col, min_chars), "keys")
    drops = dropped_lines(keys, work, min_docs)
    bit = F.expr("shiftleft(1L, pos % 64)")
    words = (drops.groupBy("doc", "row_hash", F.floor(F.col("pos") / 64).cast("int").alias("word"))
             .agg(F.bit_or(bit).alias("bits")))
    return words.groupBy("doc", "row_hash").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).alias("keep"))


def kept_lines(lines: Column, keep: Column) -> Column:
    """Lines whose bit is set: the listed words are laid out densely (gaps are
    all ones) so that each line looks its bit up by index."""
    dense = F.flatten(F.transform(keep, lambda w, i: F.concat(
        F.array_repeat(F.lit(-1).cast("long"),
                       (w["word"] - F.when(i == 0, F.lit(0)).otherwise(
                           F.element_at(keep, F.greatest(i, F.lit(1)))["word"] + 1)).cast("int")),
        F.array(w["bits"]))))

    def bit(words: Column, i: Column) -> Column:
        word = F.coalesce(F.get(words, F.floor(i / 64).cast("int")), F.lit(-1).cast("long"))
        return F.call_function("getbit", word, (i % 64).cast("int")) == 1

    # The dense words are bound once per row by a one-element transform.
    return F.flatten(F.transform(F.array(dense), lambda words: F.filter(lines, lambda _, i: bit(words, i))))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, text, n_lines, n_dropped) of every document: ``row`` holds its other columns,
    ``text`` the kept lines. Null text stays null."""
    rows = docs.select(packed(docs, text_col), named(text_col).alias("text"))
    b = bitmaps.select(F.col("doc").alias("map_doc"), F.col("row_hash").alias("map_hash"),
                       F.col("n_dropped").alias("map_dropped"), "keep")
    # The bitmaps are hashed, the wide text rows stream past without a sort.
    joined = rows.join(b.hint("shuffle_hash"), F.col("row").getField(id_col).eqNullSafe(F.col("map_doc"))
                       & (_row_hash(F.col("text")) == F.col("map_hash")), "left")
    lines = split_lines(F.col("text"))
    kept = F.when(F.col("keep").isNull(), F.col("text")).otherwise(F.array_join(kept_lines(lines, F.col("keep")), "\n"))
    return joined.select("row", kept.alias("text"), F.size(lines).cast("long").alias("n_lines"),
                         F.coalesce("map_dropped", F.lit(0)).cast("long").alias("n_dropped"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None,
                min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Documents without the repeated lines, same columns and rows; ``length_col``, if
    named, is set to the code points of the new text where lines were dropped."""
    maps = keep_bitmaps(docs, id_col, text_col, min_chars, min_docs)
    out = apply_bitmaps(docs, maps, id_col, text_col)
    new = {text_col: F.col("text")}
    if length_col in docs.columns:
        size = F.char_length("text").cast(docs.schema[length_col].dataType)
        new[length_col] = F.when(F.col("n_dropped") > 0, size).otherwise(F.col("row").getField(length_col))
    return out.select(*unpacked(docs, **new))
