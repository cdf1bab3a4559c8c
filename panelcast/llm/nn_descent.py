"""Near-duplicate vectors by NN-descent: a neighbour graph refined through the
neighbours of neighbours, of which the edges above a threshold are kept.

1. Equal vectors of a label are one class, compared once.
2. Start: in each of TABLES orders (by label and the signs under random
   hyperplanes) a vector meets the WINDOW next ones; each keeps its best K.
3. Rounds: every vector introduces its neighbours (forward and reverse) to each
   other if one of them is new; each keeps its best K again, until few lists
   change.
4. A list that is full of edges above the threshold is saturated: the lists of a
   group of three or more (a component of the edges found) are enlarged to all
   its members, compared block by block; only counts leave a block. Before that, groups
   of one label that hold saturated lists are compared with each other and joined where
   they have a link.
5. Audit: the links of a bounded set of vectors are counted against all rows of
   their label; below TARGET_RECALL the search is repeated with more orders and
   longer lists.

Defined results: a null label, a null id, and vectors that are null, zero or hold
null or non-finite components (or have another length than the most common) link
with nothing; of rows that repeat an id the smallest vector (then label) counts, and every
row is reported. Extra columns are left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import Work
from panelcast.llm.components import components
from panelcast.llm.vectors import usable_rows

THRESHOLD = 0.98
TABLES, WINDOW, NEIGHBOURS = 10, 3, 8
ROUNDS, SETTLED = 4, 0.01
#: Members that are introduced to each other at a time, and rows of a compared block.
JOIN_ROWS, BLOCK_ROWS = 64, 512
AUDIT_VECTORS, TARGET_RECALL, ATTEMPTS = 256, 0.97, 3


def _codes(x: np.ndarray, tables: int, seed: int) -> np.ndarray:
    """Sign codes of 63 hyperplanes for each table, as ordered integers."""
    planes = np.random.default_rng(seed).standard_normal((tables, x.shape[1], 63))
    weights = 1 << np.arange(62, -1, -1, dtype=np.int64)
    return np.stack([((x @ p) > 0) @ weights for p in planes], axis=1)


def unit_rows(rows: DataFrame) -> DataFrame:
    """(id, label, vec) with vec as the bytes of the unit vector in double precision."""
    def run(batches):
        import pyarrow as pa

        from panelcast.llm.vectors import matrix, unit
        for batch in batches:
            x = unit(matrix(batch.column(2)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary())],
                                             ["id", "label", "vec"])

    return rows.select("id", "label", "vec").mapInArrow(run, "id long, label long, vec binary")


def _vectors(column) -> np.ndarray:
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1)


def start_pairs(vectors: DataFrame, tables: int, window: int, seed: int) -> DataFrame:
    """(u, v, cos) of rows that stand close in one of the sign orders."""
    def place(batches):
        import pyarrow as pa

        from panelcast.llm import nn_descent as N
        for batch in batches:
            x, n = N._vectors(batch.column(2)), batch.num_rows
            codes = N._codes(x, tables, seed) if n else np.zeros((0, tables), np.int64)
            for t in range(tables):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, t, np.int32)), batch.column(1), pa.array(codes[:, t]), batch.column(0), batch.column(2)],
                    ["t", "label", "code", "id", "vec"])

    def near(batches):
        import pyarrow as pa

        from panelcast.llm import nn_descent as N
        tail = None
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in (0, 1)], axis=1)
            ids, x = batch.column(3).to_numpy(), N._vectors(batch.column(4))
            if not len(ids):
                continue
            if tail is not None:
                key, ids, x = (np.concatenate(p) for p in zip(tail, (key, ids, x)))
            fresh = 0 if tail is None else len(tail[1])
            for step in range(1, window + 1):
                i = np.arange(max(0, fresh - step), len(ids) - step)
                i = i[(key[i] == key[i + step]).all(axis=1)]
                cos = (x[i] * x[i + step]).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(ids[i + step]), pa.array(cos)], ["u", "v", "cos"])
            tail = (key[-window:], ids[-window:], x[-window:])

    placed = vectors.mapInArrow(place, "t int, label long, code long, id long, vec binary")
    dealt = placed.repartitionByRange("t", "label", "code", "id").sortWithinPartitions("t", "label", "code", "id")
    return dealt.mapInArrow(near, "u long, v long, cos double")


def best_lists(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest v of every u among directed (u, v, cos, fresh); an entry that was
    there before is not fresh. ``kth`` is the list's last cosine, -1 if it is not full."""
    single = pairs.groupBy("u", "v").agg(F.max("cos").alias("cos"), F.min("fresh").alias("fresh"))
    by = Window.partitionBy("u")
    ranked = single.withColumn("rank", F.row_number().over(by.orderBy(F.col("cos").desc(), "v"))).where(F.col("rank") <= k)
    return (ranked.withColumn("n", F.count("*").over(by)).withColumn("last", F.min("cos").over(by))
            .select("u", "v", "cos", "fresh", F.when(F.col("n") >= k, F.col("last")).otherwise(F.lit(-1.0)).alias("kth")))


def introduced(lists: DataFrame, vectors: DataFrame) -> DataFrame:
    """(u, v, cos): members of one list, forward or reverse, with each other, where the
    pair would enter u's list. Lists are handled JOIN_ROWS members at a time, nearest first."""
    def run(batches):
        import pyarrow as pa

        from panelcast.llm import nn_descent as N
        for owner, x_id, fresh, kth, x in N._whole_owners(batches):
            edges = np.flatnonzero(np.diff(owner)) + 1
            out = []
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(owner)]):
                for a in range(lo, hi, N.JOIN_ROWS):
                    own = slice(a, min(hi, a + N.JOIN_ROWS))
                    ids, new = x_id[own], fresh[own]
                    if len(ids) < 2 or not new.any():
                        continue
                    cos = x[own] @ x[own].T
                    ok = (cos > kth[own][:, None]) & (new[:, None] | new[None, :]) & (ids[:, None] != ids[None, :])
                    i, j = np.nonzero(ok)
                    out.append((ids[i], ids[j], cos[i, j]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["u", "v", "cos"])

    sides = lists.select(F.col("u").alias("w"), F.col("v").alias("x"), "cos", "fresh").unionByName(
        lists.select(F.col("v").alias("w"), F.col("u").alias("x"), "cos", "fresh"))
    sides = sides.groupBy("w", "x").agg(F.max("cos").alias("cos"), F.max("fresh").alias("fresh"))
    kth = lists.groupBy(F.col("u").alias("x")).agg(F.first("kth").alias("kth"))
    rows = (sides.join(kth, "x", "left").join(vectors.select(F.col("id").alias("x"), "vec"), "x")
            .select("w", "x", "cos", "fresh", F.coalesce("kth", F.lit(-1.0)).alias("kth"), "vec"))
    return (rows.repartition("w").sortWithinPartitions("w", F.col("cos").desc(), "x")
            .mapInArrow(run, "u long, v long, cos double"))


def _whole_owners(batches):
    """Array batches (owner, member, fresh, kth, vectors) in which an owner's rows stand
    together; rows of a very long list are given out before its end."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = (*(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)),
                batch.column(3).to_numpy(zero_copy_only=False).astype(bool), batch.column(4).to_numpy(), _vectors(batch.column(5)))
        if held is not None:
            rows = tuple(np.concatenate(p) for p in zip(held, rows))
        others = np.flatnonzero(rows[0] != rows[0][-1])
        cut = int(others[-1]) + 1 if len(others) else 0
        if len(rows[0]) - cut > 4 * JOIN_ROWS:
            cut = len(rows[0])
        if cut:
            yield tuple(c[:cut] for c in rows)
        held = tuple(c[cut:] for c in rows) if cut < len(rows[0]) else None
    if held is not None:
        yield held


def neighbour_lists(vectors: DataFrame, work: Work, k: int, tables: int, name: str, seed: int) -> DataFrame:
    """NN-descent: (u, v, cos, fresh, kth)."""
    pairs = start_pairs(vectors, tables, WINDOW, seed).where("u <> v")
    both = pairs.select("u", "v", "cos").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"), "cos"))
    lists = work.table(best_lists(both.withColumn("fresh", F.lit(1)), k), f"{name}-lists-0")
    for i in range(1, ROUNDS + 1):
        found = introduced(lists, vectors)
        old = lists.select("u", "v", "cos", F.lit(0).alias("fresh"))
        lists = work.table(best_lists(old.unionByName(found.withColumn("fresh", F.lit(1))), k), f"{name}-lists-{i}")
        total, fresh = lists.agg(F.count("*"), F.sum("fresh")).first()
        if (fresh or 0) <= SETTLED * total:
            break
    return lists


def group_links(groups: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """(id, n): links of every member of (id, component) with the members of its group,
    each weighed by ``copies``. Groups are compared block by block, a group of any size
    as a grid of blocks of BLOCK_ROWS rows."""
    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    rows = (groups.join(vectors.select("id", "vec", "copies"), "id").join(sizes, "component")
            .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    left = rows.select("component", F.col("block").alias("a"), every.alias("b"), F.lit(0).alias("side"), "id", "vec", "copies")
    right = rows.select("component", every.alias("a"), F.col("block").alias("b"), F.lit(1).alias("side"), "id", "vec", "copies")

    def compare(table):
        import pyarrow as pa

        from panelcast.llm import nn_descent as N
        side = table.column("side").to_numpy()
        ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
        x = N._vectors(table.column("vec").combine_chunks())
        l, r = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        linked = (x[l] @ x[r].T >= threshold) & (ids[l][:, None] != ids[r][None, :])
        return pa.table({"id": pa.array(ids[l]), "n": pa.array((linked * copies[r]).sum(axis=1, dtype=np.int64))})

    cells = left.unionByName(right).groupBy("component", "a", "b").applyInArrow(compare, "id long, n long")
    return cells.groupBy("id").agg(F.sum("n").alias("n"))


def across_links(groups: DataFrame, lists: DataFrame, vectors: DataFrame, threshold: float, work: Work, name: str) -> DataFrame:
    """(u, v): ids of two groups of one label with a link between them, for all groups that
    hold a saturated list. Each group is a ball (a member and the widest angle to it); groups
    whose balls stand further apart than the threshold have no link, the others are compared
    block by block."""
    full = lists.where(F.col("kth") >= threshold).select(F.col("u").alias("id")).distinct()
    chosen = groups.join(full, "id", "left_semi").select("component").distinct()
    rows = work.table(groups.join(chosen, "component", "left_semi").join(vectors.select("id", "label", "vec"), "id"), f"{name}-full")
    centres = rows.where("id = component").select("component", "label", F.col("vec").alias("centre"))

    def angles(batches):
        import pyarrow as pa

        from panelcast.llm import nn_descent as N
        for batch in batches:
            cos = (N._vectors(batch.column(1)) * N._vectors(batch.column(2))).sum(axis=1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.arccos(np.clip(cos, -1, 1)))], ["component", "angle"])

    radii = (rows.join(centres.drop("label"), "component").select("component", "vec", "centre")
             .mapInArrow(angles, "component long, angle double").groupBy("component").agg(F.max("angle").alias("radius")))
    balls = work.table(centres.join(radii, "component"), f"{name}-balls")

    def near(batches):
        import pyarrow as pa

        from panelcast.llm import nn_descent as N
        reach = np.arccos(threshold) + 1e-6
        for batch in batches:
            cos = (N._vectors(batch.column(2)) * N._vectors(batch.column(3))).sum(axis=1) if batch.num_rows else np.zeros(0)
            apart = np.arccos(np.clip(cos, -1, 1)) - batch.column(4).to_numpy()
            yield batch.select([0, 1]).filter(pa.array(apart <= reach))

    x, y = balls.alias("x"), balls.alias("y")
    both = x.join(y, (F.col("x.label") == F.col("y.label")) & (F.col("x.component") < F.col("y.component"))).select(
        F.col("x.component").alias("g"), F.col("y.component").alias("h"), F.col("x.centre").alias("c"), F.col("y.centre").alias("d"),
        (F.col("x.radius") + F.col("y.radius")).alias("wide"))
    close = work.table(both.mapInArrow(near, "g long, h long"), f"{name}-close")

    sizes = rows.groupBy("component").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    placed = rows.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    g, h = (sizes.select(F.col("component").alias(c), F.col("blocks").alias(f"{c}_blocks")) for c in "gh")
    cells = close.join(g, "g").join(h, "h")
    left = (cells.join(placed.select(F.col("component").alias("g"), F.col("block").alias("a"), "id", "vec"), "g")
            .select("g", "h", "a", F.explode(F.sequence(F.lit(0), F.col("h_blocks") - 1)).alias("b"), F.lit(0).alias("side"), "id", "vec"))
    right = (cells.join(placed.select(F.col("component").alias("h"), F.col("block").alias("b"), "id", "vec"), "h")
             .select("g", "h", F.explode(F.sequence(F.lit(0), F.col("g_blocks") - 1)).alias("a"), "b", F.lit(1).alias("side"), "id", "vec"))

    def compare(table):
        import pyarrow as pa

        from panelcast.llm import nn_descent as N
        side, ids = table.column("side").to_numpy(), table.column("id").to_numpy()
        x = N._vectors(table.column("vec").combine_chunks())
        l, r = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        i, j = np.nonzero(x[l] @ x[r].T >= threshold)
        return pa.table({"u": pa.array(ids[l][i[:1]], pa.int64()), "v": pa.array(ids[r][j[:1]], pa.int64())})

    return left.unionByName(right).groupBy("g", "h", "a", "b").applyInArrow(compare, "u long, v long")


def audit(vectors: DataFrame, counted: DataFrame, threshold: float, n_audit: int = AUDIT_VECTORS) -> float:
    """Share of the true links of at most ``n_audit`` vectors (smallest hash of their
    id) that were counted: each is compared with all rows of its label, in blocks."""
    asked = vectors.orderBy(F.xxhash64("id"), "id").limit(n_audit).select("id", "label", "vec").toArrow()
    if not asked.num_rows:
        return 1.0
    q_ids, q_labels = asked.column("id").to_numpy(), asked.column("label").to_numpy()
    q = _vectors(asked.column("vec").combine_chunks())

    def run(batches):
        import pyarrow as pa

        from panelcast.llm import nn_descent as N
        n = np.zeros(len(q_ids), np.int64)
        for batch in batches:
            if batch.num_rows:
                ids, labels, copies = (batch.column(i).to_numpy() for i in (0, 1, 3))
                near = ((q @ N._vectors(batch.column(2)).T >= threshold) & (q_labels[:, None] == labels[None, :])
                        & (q_ids[:, None] != ids[None, :]))
                n += (near * copies).sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(q_ids), pa.array(n)], ["id", "n"])

    true = vectors.select("id", "label", "vec", "copies").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("true"))
    both = true.join(counted, "id", "left").agg(F.sum("true"), F.sum(F.least("true", F.coalesce("n", F.lit(0))))).first()
    return both[1] / both[0] if both[0] else 1.0


def _searched(vectors: DataFrame, work: Work, threshold: float, attempt: int) -> tuple[DataFrame, DataFrame]:
    """(id, component) of the linked vectors and (id, n) links, weighed by copies."""
    grow, name = 2 ** attempt, f"try-{attempt}"
    lists = neighbour_lists(vectors, work, NEIGHBOURS * grow, TABLES * grow, name, seed=attempt)
    edges = lists.where(F.col("cos") >= threshold).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    groups = work.table(components(edges, work, f"{name}-cc"), f"{name}-groups")
    # A saturated list holds no farther links: those between groups are looked for among all members.
    across = work.table(across_links(groups, lists, vectors, threshold, work, name), f"{name}-across")
    groups = work.table(components(edges.unionByName(across), work, f"{name}-cc-2"), f"{name}-groups-2")
    large = groups.groupBy("component").agg(F.count("*").alias("n")).where("n > 2").select("component")
    inside = group_links(groups.join(large, "component", "left_semi"), vectors, threshold)
    # The two members of a pair are linked by the edge that made it.
    pairs = groups.join(large, "component", "left_anti").join(vectors.select("id", "copies"), "id")
    both = pairs.groupBy("component").agg(F.sum("copies").alias("total"))
    twos = pairs.join(both, "component").select("id", (F.col("total") - F.col("copies")).alias("n"))
    return groups, work.table(inside.unionByName(twos), f"{name}-links")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    work = Work(df.sparkSession, "nn-descent")
    given = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), F.col(label_col).cast("long").alias("label"))
    rows = usable_rows(given.where("label IS NOT NULL"), "id", "vec", "label")
    digests = (unit_rows(rows).withColumn("h1", F.xxhash64("vec", "label"))
               .withColumn("h2", F.xxhash64(F.lit("second"), "vec", "label")))
    digests = work.table(digests, "units")
    classes = digests.groupBy("h1", "h2").agg(F.min("id").alias("class_id"), F.count("*").alias("copies"))
    member = work.table(digests.select("id", "h1", "h2").join(classes, ["h1", "h2"]).select("id", "class_id", "copies"), "members")
    vectors = work.table(digests.select("id", "label", "vec").join(
        member.where("id = class_id").select("id", "copies"), "id"), "vectors")
    for attempt in range(ATTEMPTS):
        groups, links = _searched(vectors, work, threshold, attempt)
        if audit(vectors, links, threshold) >= TARGET_RECALL:
            break
    known = (member.join(groups.withColumnRenamed("id", "class_id"), "class_id", "left")
             .join(links.withColumnRenamed("id", "class_id"), "class_id", "left")
             .select("id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "class_id").alias("component_id")))
    out = given.select("id").join(known, "id", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
