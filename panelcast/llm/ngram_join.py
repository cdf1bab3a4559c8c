"""Near-duplicate documents by an exact Jaccard join of word n-grams: grouped prefix join.

1. A document's set of n-word shingles (64-bit fingerprints) is ordered by how
   many shingles of the corpus share its hash slot, rare slots first. Documents
   with the same set are one class; its smallest id stands for it.
2. Two sets of the wanted similarity share a shingle among the first
   n - ceil(0.8 n) + 1 of each. Classes with the same size and the same prefix
   are one group, and only groups are joined on the shingles of their prefixes,
   under the size filter and the positional filter (the sets must still be able
   to overlap enough from the shared shingle on).
3. Groups are expanded and members verified on whole sets.

No bucket of a shingle emits all its pairs. First every member is verified
against one member of its bucket (the one where the shingle stands first), and
groups against their first class. Verified links give components; only pairs
of *different* components that still share buckets (a group of three or more is one),
and enough of their prefixes for the similarity, are verified afterwards, so every link between two texts is
either verified or inside a component. Buckets
are range-partitioned by (shingle, place), so that a hot shingle is cut into
several tasks, whose first members are then paired.

Defined results: null or empty text, or white space only, has no shingle and
links with nothing; a text of fewer words than n is one shingle; an id names one
document: if its rows differ, the row with the smallest digest decides on links,
and every row is reported with that component and its own size; rows with a null
id link with nothing. Extra columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import Work
from panelcast.llm.components import components

WORDS, PERCENT = 5, 80
#: Hash slots of the shingle order: a fixed table of counts.
SLOT_BITS, BLOCK_SLOTS = 18, 4096
SLICE_BYTES = 1_000_000
#: Bits of the table that marks documents whose sets are needed.
MARK_BITS = 2 ** 22

_ODD = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 2 ** 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\x0b\f\r")] = True


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD
    h = (h ^ (h >> np.uint64(29))) * _PLACE[0]
    return h ^ (h >> np.uint64(32))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64."""

    up = down = np.zeros(0, np.uint64)

    @classmethod
    def of(cls, n: int):
        if len(cls.up) < n:
            up, down = np.full(n, _ODD), np.full(n, np.uint64(pow(int(_ODD), -1, 2 ** 64)))
            up[0] = down[0] = 1
            cls.up, cls.down = np.cumprod(up), np.cumprod(down)
        return cls.up, cls.down


def _word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """Hashes of the words of each text, A-Z folded."""
    data = np.frombuffer((b"\n".join(texts) + b"\n").lower(), np.uint8)
    up, down = _Powers.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=sums[1:])
    edge = np.flatnonzero(np.diff(_BLANK[data], prepend=True))
    starts, ends = edge[::2], edge[1::2]
    h = _mix((sums[ends] - sums[starts]) * down[starts])
    stops = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts])).tolist()
    return [h[i:j] for i, j in zip([0, *stops], stops)]


def _long_word_hashes(text: bytes) -> np.ndarray:
    parts, at = [], 0
    while at < len(text):
        end = at + SLICE_BYTES
        while end < len(text) and not _BLANK[text[end]]:
            end += 1
        parts.append(_word_hashes([text[at:end]])[0])
        at = end
    return np.concatenate(parts)


def _set(words: np.ndarray, n: int) -> np.ndarray:
    if not len(words):
        return words
    if len(words) < n:
        return _mix(np.array([(words * _PLACE[1:1 + len(words)]).sum() + np.uint64(len(words))]))
    h = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        h += words[k:k + len(h)] * _PLACE[8 + k]
    return np.unique(_mix(h))


def shingle_sets(texts: list[bytes | None], n: int = WORDS):
    """The sorted shingle fingerprints of each text."""
    group, size = [], 0
    for t in texts:
        t = t or b""
        if group and size + len(t) > SLICE_BYTES:
            yield from (_set(w, n) for w in _word_hashes(group))
            group, size = [], 0
        if len(t) > SLICE_BYTES:
            yield _set(_long_word_hashes(t), n)
        else:
            group.append(t)
            size += len(t)
    if group:
        yield from (_set(w, n) for w in _word_hashes(group))


def digest(h: np.ndarray) -> tuple[int, int]:
    """128-bit digest of a set, as two signed 64-bit integers."""
    d = hashlib.blake2b(h.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def prefix_size(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


def slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def prefix(h: np.ndarray, order: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set in the corpus order (slot count, fingerprint)."""
    count = order[slots(h)]
    k = prefix_size(len(h), percent)
    if k < len(h):
        # Everything up to the k-th smallest count; ties are cut after sorting.
        inside = count <= np.partition(count, k - 1)[k - 1]
        h, count = h[inside], count[inside]
    return h[np.lexsort((h, count))[:k]]


# Spark stages ---------------------------------------------------------------

def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def digest_documents(source: DataFrame, n: int) -> DataFrame:
    """One row per document (id, size, a, b = 128-bit digest of its set), and per task
    rows with block >= 0 and the counts of a block of shingle slots."""
    def run(batches):
        import pyarrow as pa

        from panelcast.llm import ngram_join as J
        from panelcast.llm.tokens import as_bytes, small_batches
        counts = np.zeros(1 << J.SLOT_BITS, np.int64)
        for batch in small_batches(batches):
            size, a, b, held = [], [], [], []
            for h in J.shingle_sets(as_bytes(batch.column(1)), n):
                size.append(len(h))
                for column, half in zip((a, b), J.digest(h)):
                    column.append(half)
                held.append(J.slots(h))
            if held:
                counts += np.bincount(np.concatenate(held), minlength=len(counts))
            m = len(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1] * m, pa.int32()), batch.column(0), pa.array(size, pa.int32()), pa.array(a, pa.int64()),
                 pa.array(b, pa.int64()), pa.nulls(m, pa.binary())], names)
        if counts.any():
            blocks = counts.reshape(-1, J.BLOCK_SLOTS)
            m = len(blocks)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(m), pa.int32()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()),
                 pa.nulls(m, pa.int64()), pa.array([x.tobytes() for x in blocks], pa.binary())], names)

    names = ["block", "id", "size", "a", "b", "counts"]
    return source.mapInArrow(run, "block int, id long, size int, a long, b long, counts binary")


def slot_order(rows: DataFrame) -> np.ndarray:
    """Counts of all slots: a table of fixed size, summed block by block in Spark."""
    def total(table):
        import pyarrow as pa
        out = sum(np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist())
        return pa.table({"block": table.column("block")[:1], "counts": pa.array([out.tobytes()], pa.binary())})

    summed = rows.where("block >= 0").select("block", "counts").groupBy("block").applyInArrow(
        total, "block int, counts binary").collect()
    order = np.zeros(1 << SLOT_BITS, np.int64)
    for r in summed:
        order[r["block"] * BLOCK_SLOTS:(r["block"] + 1) * BLOCK_SLOTS] = np.frombuffer(r["counts"], np.int64)
    return order


def prefix_rows(source: DataFrame, order: np.ndarray, n: int, percent: int) -> DataFrame:
    """(id, a, size, prefix): the ordered prefix of every document with a set."""
    shared = source.sparkSession.sparkContext.broadcast(order)

    def run(batches):
        import pyarrow as pa

        from panelcast.llm import ngram_join as J
        from panelcast.llm.tokens import as_bytes, small_batches
        for batch in small_batches(batches):
            ids, a, size, out = [], [], [], []
            for i, h in zip(batch.column(0).to_pylist(), J.shingle_sets(as_bytes(batch.column(1)), n)):
                if len(h) and i is not None:
                    ids.append(i)
                    a.append(J.digest(h)[0])
                    size.append(len(h))
                    out.append(J.prefix(h, shared.value, percent).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(a, pa.int64()), pa.array(size, pa.int32()),
                 pa.array(out, pa.list_(pa.int64()))], ["id", "a", "size", "prefix"])

    return source.mapInArrow(run, "id long, a long, size int, prefix array<long>")


def _fits(n1, i, n2, j, percent: int):
    """Size and positional filter of two sets that share the shingles at places i and
    j (from 0) and none before: enough is left for the overlap the similarity needs."""
    left = np.minimum(n1 - i, n2 - j)
    need = -(-percent * (n1 + n2) // (100 + percent))
    return (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)) & (left >= need)


def star_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """(token, u, v, place, size, kind) over rows (token, place, size, gid) sorted by
    (token, place, size, gid). Kind 0: a member v paired with its bucket's first member
    u. Kind 1: members u of buckets with more than one row. Kind 2: the first member u
    of the first and last bucket of a task, which other tasks may share."""
    def run(batches):
        import pyarrow as pa

        from panelcast.llm.ngram_join import _fits

        def rows(kind, token, u, v, place, size):
            columns = [pa.array(c, pa.int64()) for c in (token, u, v, place, size)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([kind] * len(token), pa.int32())], names)

        last = None  # (token, place, size, gid) of the running bucket's first member
        for batch in batches:
            token, place, size, gid = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
            if not len(token):
                continue
            new = np.concatenate([[last is None or token[0] != last[0]], token[1:] != token[:-1]])
            if last is None:
                yield rows(2, token[:1], gid[:1], gid[:1], place[:1], size[:1])
            heads = np.flatnonzero(new)
            # First member of each row's bucket; index 0 is the bucket carried over.
            at = np.cumsum(new)
            first = [np.concatenate([[0 if last is None else x], c[heads]]) for x, c in
                     zip(last or (0, 0, 0, 0), (token, place, size, gid))]
            more = np.flatnonzero(~new)
            if len(more):
                yield rows(1, token[more], gid[more], gid[more], place[more], size[more])
                h = np.unique(at[more])
                yield rows(1, first[0][h], first[3][h], first[3][h], first[1][h], first[2][h])
            k = more[_fits(first[2][at[more]], first[1][at[more]], size[more], place[more], percent)]
            if len(k):
                yield rows(0, token[k], first[3][at[k]], gid[k], place[k], size[k])
            if len(heads):
                h = heads[-1]
                last = (int(token[h]), int(place[h]), int(size[h]), int(gid[h]))
        if last is not None:
            yield rows(2, [last[0]], [last[3]], [last[3]], [last[1]], [last[2]])

    names = ["token", "u", "v", "place", "size", "kind"]
    return buckets.select("token", "place", "size", "gid").mapInArrow(
        run, "token long, u long, v long, place long, size long, kind int")


def needed_sets(source: DataFrame, ids: DataFrame, n: int, work: Work, name: str) -> DataFrame:
    """(id, set) of the documents in ``ids`` (distinct columns id, a). A bit table of
    fixed size tells which texts are worth reading, the join keeps the right ones."""
    def slot(id_col: str):
        return F.pmod(F.xxhash64(id_col), F.lit(MARK_BITS)).cast("int")

    marked = ids.select(slot("id").alias("s")).select(
        F.shiftright("s", 6).alias("word"), F.expr("shiftleft(1L, s & 63)").alias("bit"))
    blank = ids.sparkSession.range(MARK_BITS // 64).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bit"))
    words = marked.unionByName(blank).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    table = work.table(words.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"])
                                 .alias("words")), f"{name}-marks")

    def run(batches):
        import pyarrow as pa

        from panelcast.llm import ngram_join as J
        from panelcast.llm.tokens import as_bytes, small_batches
        for batch in small_batches(batches):
            sets = list(J.shingle_sets(as_bytes(batch.column(1)), n))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([J.digest(h)[0] for h in sets], pa.int64()),
                 pa.array([h.tobytes() for h in sets], pa.binary())], ["id", "a", "set"])

    word = F.get(table.scalar(), F.shiftright(slot("id"), 6))
    worth = F.call_function("getbit", word, slot("id").bitwiseAND(F.lit(63))) == 1
    sets = source.where(F.col("id").isNotNull() & worth).mapInArrow(run, "id long, a long, set binary")
    return work.table(sets.join(ids, ["id", "a"], "left_semi").dropDuplicates(["id"]).select("id", "set"), f"{name}-sets")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose whole sets reach the similarity."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            ok = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = np.sort(np.concatenate([a, b]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                ok.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))

    left = sets.select(F.col("id").alias("u"), F.col("set").alias("a"))
    right = sets.select(F.col("id").alias("v"), F.col("set").alias("b"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS,
                    percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, class_id, component_id) of every document."""
    work = Work(docs.sparkSession, "ngram-join")
    source = _source(docs, id_col, text_col)
    rows = work.table(digest_documents(source, n), "digests")
    order = slot_order(rows)
    documents = rows.where("block < 0").select("id", "size", "a", "b")
    # Classes: one set, the smallest id stands for it. An id counts once.
    single = (documents.where("size > 0 AND id IS NOT NULL").groupBy("id")
              .agg(F.min(F.struct("a", "b", "size")).alias("s")).select("id", "s.*"))
    classes = work.table(single.groupBy("a", "b").agg(F.min("id").alias("class_id"), F.first("size").alias("size")), "classes")

    # Groups: same size, same prefix; the smallest class stands for it.
    heads = classes.select(F.col("class_id").alias("id"), "a")
    prefixes = (prefix_rows(source, order, n, percent).join(heads, ["id", "a"], "left_semi").dropDuplicates(["id"])
                .withColumn("p1", F.xxhash64("size", "prefix")).withColumn("p2", F.xxhash64(F.lit(2), "size", "prefix")))
    prefixes = work.table(prefixes, "prefixes")
    groups = prefixes.groupBy("p1", "p2").agg(F.min("id").alias("gid"))
    grouped = work.table(prefixes.select("id", "a", "size", "p1", "p2").join(groups, ["p1", "p2"])
                         .select("id", "a", "size", "gid"), "groups")
    buckets = (prefixes.join(grouped.where("id = gid").select("id"), "id", "left_semi")
               .select(F.col("id").alias("gid"), "size", F.posexplode("prefix").alias("place", "token")))
    # Read straight from the exchange, where a task is one sorted run: files read back are
    # packed several to a task, by size, and a bucket cut at a file's end would be missed.
    buckets = buckets.repartitionByRange("token", "place", "gid").sortWithinPartitions("token", "place", "size", "gid")

    # First round: against the first member of each bucket, and of each group.
    stars = work.table(star_pairs(buckets, percent), "stars")
    ends = stars.where("kind = 2").select("token", "u")
    joined_ends = ends.join(ends.groupBy("token").agg(F.min("u").alias("v")), "token").select("u", "v")
    first = work.table(_ordered(stars.where("kind = 0").select("u", "v").unionByName(joined_ends)
                                .unionByName(grouped.select(F.col("gid").alias("u"), F.col("id").alias("v")))), "first")
    heads = grouped.select("id", "a")
    links = work.table(_verify(first, source, heads, n, percent, work, "first"), "links-1")
    part = components(links, work, "cc-1")

    # Second round: pairs of different components that share a bucket, members expanded.
    # Buckets with the same members count as one, each member at its first place in them.
    # A group of three or more classes is a bucket of its own, whether or not it meets another.
    own = (grouped.groupBy("gid").agg(F.count("*").alias("n"), F.first("size").cast("long").alias("size")).where("n > 2")
           .select(F.col("gid").alias("token"), "gid", F.lit(0).cast("long").alias("place"), "size"))
    members = (stars.where("kind > 0").select("token", F.col("u").alias("gid"), "place", "size").distinct().unionByName(own)
               .join(grouped.select("gid", "id"), "gid").join(part, "id", "left")
               .select("token", "place", "size", "id", F.coalesce("component", "id").alias("comp")))
    members = work.table(members, "members")
    mixed = (members.groupBy("token").agg(
        F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
        F.bit_xor(F.xxhash64("id")).alias("s1"), F.bit_xor(F.xxhash64(F.lit("second"), "id")).alias("s2"))
        .where("n > 2 AND lo <> hi").select("token", F.struct("n", "s1", "s2").alias("bucket")))
    open_rows = work.table(members.join(mixed, "token").groupBy("bucket", "id", "size", "comp")
                           .agg(F.min("place").alias("place")), "open")
    x, y = open_rows.alias("x"), open_rows.alias("y")
    small, large = F.least("x.size", "y.size"), F.greatest("x.size", "y.size")
    left = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    cross = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.id") < F.col("y.id"))
                   & (F.col("x.comp") != F.col("y.comp")) & (100 * small >= percent * large)
                   & ((100 + percent) * left >= percent * (F.col("x.size") + F.col("y.size"))))
    pairs = cross.select(F.col("x.id").alias("u"), F.col("y.id").alias("v")).distinct().join(first, ["u", "v"], "left_anti")
    # Outside its prefix a set has ceil(0.8 n) - 1 shingles; the set whose prefix ends first
    # in the corpus order overlaps the other in what the prefixes share and those at most.
    heads_of = prefixes.select("id", F.col("size").cast("long").alias("size"), "prefix")
    both = (pairs.join(heads_of.select(F.col("id").alias("u"), F.col("size").alias("m"), F.col("prefix").alias("pu")), "u")
            .join(heads_of.select(F.col("id").alias("v"), F.col("size").alias("n"), F.col("prefix").alias("pv")), "v"))
    rest = F.ceil(F.greatest("m", "n") * percent / 100) - 1
    second = both.where((F.size(F.array_intersect("pu", "pv")) + rest) * (100 + percent)
                        >= percent * (F.col("m") + F.col("n"))).select("u", "v")
    second = work.table(second, "second")
    more = work.table(_verify(second, source, heads, n, percent, work, "second"), "links-2")
    found = components(links.unionByName(more), work, "cc-2")

    known = (single.join(classes.select("a", "b", "class_id"), ["a", "b"])
             .join(found.withColumnRenamed("id", "class_id"), "class_id", "left")
             .select("id", "class_id", F.coalesce("component", "class_id").alias("component_id")))
    return documents.select("id", F.col("size").cast("long").alias("n_shingles")).join(known, "id", "left").select(
        "id", "n_shingles", F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("component_id", "id").alias("component_id"))


def _verify(pairs: DataFrame, source: DataFrame, heads: DataFrame, n: int, percent: int, work: Work, name: str) -> DataFrame:
    ids = pairs.select(F.col("u").alias("id")).unionByName(pairs.select(F.col("v").alias("id"))).distinct()
    needed = work.table(heads.join(ids, "id", "left_semi"), f"{name}-ids")
    return verified(pairs, needed_sets(source, needed, n, work, name), percent)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component stays, the one with the smallest id; all columns.
    Rows with a null id stay."""
    kept = near_duplicates(docs, id_col, text_col).where("id = component_id").select(F.col("id").alias("kept_id"))
    inside = docs.join(kept, docs[id_col] == kept["kept_id"], "left_semi")
    return inside.unionByName(docs.where(docs[id_col].isNull()))
