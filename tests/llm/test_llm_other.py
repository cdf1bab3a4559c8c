"""Vectors, urls, the classifier, the pipeline and the registered queries."""

import math
import os
import sys
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import corpus_pipeline  # noqa: E402
from panelcast.llm import bloom_cascade, line_dedup, multi_index, nn_descent, packing, quality_vote, queries, tokens  # noqa: E402
from panelcast.llm.common import Work  # noqa: E402
from panelcast.llm.q01_url_filter import RULES  # noqa: E402
from oracle_harness import compare, duck  # noqa: E402

VEC_SCHEMA = "vec_id long, embedding array<double>, label int, id long, vec string, n int, copies int"


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, 1, "x", 2, 3) for i, v, lab in rows], VEC_SCHEMA)


def vector_rows(seed, n=120, dim=16):
    rng = np.random.default_rng(seed)
    rows = [(int(k), rng.standard_normal(dim).tolist(), int(k % 3)) for k in range(n)]
    base = rng.standard_normal(dim)
    # A large cluster, more members than a list has places, and a smaller one.
    rows += [(1000 + k, (base + 0.02 * rng.standard_normal(dim)).tolist(), 1) for k in range(60)]
    rows += [(2000 + k, (3 * base[::-1] + 0.1 * rng.standard_normal(dim)).tolist(), 2) for k in range(5)]
    rows += [(3000, rows[0][1], 0), (3001, rows[0][1], 1), (3002, [2 * x for x in rows[0][1]], 0)]
    odd = [None, [0.0] * dim, [float("nan")] * dim, [float("inf")] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [1.0] * 3]
    rows += [(4000 + k, v, 0) for k, v in enumerate(odd)]
    rows += [(5000, [1e-200 * x for x in rows[1][1]], 1), (5001, [1e200 * x for x in rows[1][1]], 1), (5002, rows[2][1], None)]
    return rows


def good(v, dim=16):
    return v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v) and any(v)


def cosines(rows):
    rows = [r for r in rows if good(r[1])]
    x = np.array([np.array(v) / max(map(abs, v)) for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [r[0] for r in rows], [r[2] for r in rows], x @ x.T


def test_vector_links_equal_brute_force(spark):
    rows = vector_rows(1)
    ids, labels, cos = cosines(rows)
    links = {i: 0 for i, _, _ in rows}
    root = {i: i for i in links}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(len(ids)):
            if a != b and labels[a] == labels[b] and labels[a] is not None and cos[a, b] >= 0.98:
                links[ids[a]] += 1
                x, y = sorted((find(ids[a]), find(ids[b])))
                root[y] = x
    got = nn_descent.near_duplicates(vectors_frame(spark, rows).repartition(3)).collect()
    assert len(got) == len(rows)
    assert {r.id: (r.n_links, r.component_id, r.kept) for r in got} == {
        i: (n, find(i), find(i) == i) for i, n in links.items()}
    assert links[1000] >= 50


def test_links_between_two_saturated_bunches(spark):
    """40 vectors at cosine 0.999 inside and 0.985 across: every list is full of its own bunch."""
    inside, across, dim = 0.999, 0.985, 96
    rows = []
    for bunch in range(2):
        for k in range(40):
            v = np.zeros(dim)
            v[0], v[1 + bunch], v[3 + 40 * bunch + k] = np.sqrt(across), np.sqrt(inside - across), np.sqrt(1 - inside)
            rows.append((40 * bunch + k, v.tolist(), 1))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = nn_descent.near_duplicates(frame).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(79, 0)} and len(got) == 80


def test_vector_links_of_repeated_and_missing_ids(spark):
    v = [1.0] * 16
    rows = [(1, v, 0), (1, v, 0), (2, v, 0), (None, v, 0), (3, v, None)]
    got = nn_descent.near_duplicates(vectors_frame(spark, rows)).collect()
    assert sorted((str(r.id), r.n_links, str(r.component_id), r.kept) for r in got) == [
        ("1", 1, "1", True), ("1", 1, "1", True), ("2", 1, "1", False), ("3", 0, "3", True), ("None", 0, "None", True)]
    assert nn_descent.near_duplicates(vectors_frame(spark, [])).collect() == []


def test_group_comparison_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK_ROWS", 10)
    rows = [(k, [1.0 + 0.001 * (k % 7)] + [1.0] * 15, 0) for k in range(95)]
    got = nn_descent.near_duplicates(vectors_frame(spark, rows)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(94, 0)}


def nearest_by_hand(rows, k):
    ids, _, cos = cosines(rows)
    out = {}
    for a, i in enumerate(ids):
        if i % 50 == 0:
            near = sorted((-cos[a, b], ids[b]) for b in range(len(ids)) if b != a)[:k]
            out[i] = [(j, -c) for c, j in near]
    return out


@pytest.mark.parametrize("shard_rows", [1000, 20])
def test_search_reaches_the_recall(spark, shard_rows):
    rows = [r for r in vector_rows(2, 900) if r[0] < 5000]
    frame = vectors_frame(spark, rows)
    found = multi_index.search(frame, F.col("id") % 50 == 0, 5, shard_rows=shard_rows)
    got = defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        got[r.query_id].append((r.id, r.score))
    want = nearest_by_hand(rows, 5)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    assert multi_index.recall(frame, found, F.col("id") % 50 == 0, 5) >= 0.9
    ids, _, cos = cosines(rows)
    at = {i: a for a, i in enumerate(ids)}
    for q, near in got.items():
        assert all(abs(s - cos[at[q], at[j]]) < 1e-12 for j, s in near)
        assert near == sorted(near, key=lambda n: (-n[1], n[0]))


def test_search_with_few_rows(spark):
    v = [1.0, 0.0, 0.0]
    rows = [(0, v, 0), (50, [2.0, 0.0, 0.0], 0), (7, v, None), (100, [0.0, 0.0, 0.0], 0), (None, v, 0), (0, v, 1)]
    got = multi_index.search(vectors_frame(spark, rows), F.col("id") % 50 == 0, 5).collect()
    assert sorted((r.query_id, r["rank"], r.id, r.score) for r in got) == [(0, 1, 7, 1.0), (0, 2, 50, 1.0), (50, 1, 0, 1.0), (50, 2, 7, 1.0)]
    assert multi_index.search(vectors_frame(spark, []), F.col("id") % 50 == 0, 5).collect() == []


def test_probing_retrieves_every_code_in_the_radius():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((500, 32))
    shard = multi_index.Shard(np.arange(500), x, multi_index.learn(x, 5))
    for q, radius in ((0, 0), (1, 9), (2, 37), (3, 52), (4, 128)):
        near = multi_index.distances(shard.codes, shard.codes[q])
        assert shard.within(shard.codes[q], radius).tolist() == np.flatnonzero(near <= radius).tolist()


# Urls -----------------------------------------------------------------------

URLS = ["http://a.example.com/en/1?x", "HTTPS://WWW.Example.COM/en/", "http://www.example.com/EN/", "http://shop.net/es/x#y",
        "http://net/fr/", "http://net/fr", "http://example.com", "http://example.com?u=http://b.net/es/", "ftp://x.y/#/en/", "no scheme",
        "", None, "http://bad.org/1", "http://sub.bad.org/1", "http://notbad.org/", "://", "http:///en/", "x://example.com/en/://net/es/",
        "http://" + "a." * 3000 + "com/" + "p" * 20000, "http://com/"]


def judged_by_hand(url, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), h + p, a) for a, h, p in RULES if ("." + host).endswith("." + h) and path.startswith(p)]
    own = "block" if any(("." + host).endswith("." + b) for b in listed) else "allow"
    return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, own)


def test_verdicts_equal_brute_force(spark):
    pages = spark.createDataFrame([(k, u, "x", "y", "z") for k, u in enumerate(URLS + URLS[:3])],
                                  "page_id long, url string, host string, rule string, key string")
    listed = spark.createDataFrame([("bad.org",), ("bad.org",), (None,)], "key string")
    got = bloom_cascade.judge_urls(pages, RULES, listed).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == {
        k: judged_by_hand(u, ["bad.org"]) for k, u in enumerate(URLS + URLS[:3])}
    assert got[0].key == "z"
    assert bloom_cascade.judge_urls(pages.where("false"), RULES, listed.where("false")).collect() == []
    assert bloom_cascade.judge_urls(pages, RULES, listed.where("false")).count() == len(URLS) + 3


@pytest.mark.parametrize("key_bits", [1, 12])
def test_cascade_is_exact_over_its_universe(spark, monkeypatch, key_bits):
    monkeypatch.setattr(bloom_cascade, "KEY_BITS", key_bits)  # one bit a key: many false positives, many levels
    universe = spark.range(4000).select(F.concat(F.lit("host"), "id").alias("key"))
    listed = universe.where("hash(key) % 5 = 0")
    cascade = bloom_cascade.Cascade(listed, universe, Work(spark, "test-cascade"))
    assert len(cascade.levels) >= (3 if key_bits == 1 else 1)
    found = universe.select("key", *cascade.attached("c")).where(cascade.has(F.col("key"), "c")).select("key")
    assert sorted(found.collect()) == sorted(listed.collect())


# Classifier -----------------------------------------------------------------

def quality_rows(seed=0, n=400):
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for k in range(n):
        words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 8))) for _ in range(rng.integers(20, 80))]
        junk = k % 4 == 0
        text = " ".join(w.upper() + "!!" for w in words) if junk else " ".join(words).capitalize() + "."
        rows.append((k, text, 1, "x"))
        labels.append((k, 0 if junk else 1, 0))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(spark):
    rows, labels = quality_rows()
    rows += [(1000, None, 1, "x"), (1001, "", 1, "x"), (None, "Some words here.", 1, "x"), (0, rows[0][1], 1, "x"),
             (1002, "LOUD!! " * 50000, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int, label string")
    known = spark.createDataFrame(labels + [(1, None, 0), (9999, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality_vote.fit(docs, known, per_class=100)
    assert len(model.vectors) <= 200
    got = {r.id: r.score for r in quality_vote.score(docs, model).collect()}
    held = [k for k, _, _ in labels if zlib.crc32(str(k).encode()) % 4 == 2]
    assert len(held) > 50 and np.mean([(got[k] >= 0.7) == (labels[k][1] == 1) for k in held]) >= 0.97
    assert 0 <= min(got.values()) and max(got.values()) <= 1
    assert got[1000] == got[1001] == pytest.approx(model.share) and got[1002] < 0.5
    kept = quality_vote.keep_good(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, s in got.items() if s >= 0.7}


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows, labels = quality_rows(n=120)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    turned = [(k, 1 - q if zlib.crc32(str(k).encode()) % 4 == 2 else q) for k, q, _ in labels]
    a, b = (quality_vote.fit(docs, spark.createDataFrame(x, "doc_id long, quality int"))
            for x in ([(k, q) for k, q, _ in labels], turned))
    assert a.share == b.share and np.array_equal(a.vectors, b.vectors) and np.array_equal(a.labels, b.labels)


def test_classifier_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_vote.score(docs, quality_vote.fit(docs, none)).first().score == 0.5
    assert quality_vote.score(docs.where("false"), quality_vote.fit(docs.where("false"), none)).collect() == []


def test_quality_stage_without_labels_keeps_the_documents(spark, tmp_path):
    docs = spark.createDataFrame([(1, "Some plain words."), (2, None), (3, "")], "doc_id long, text string")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.quality(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in got.collect()) == [1, 2, 3] and got.columns == docs.columns


# Pipeline and queries -------------------------------------------------------

def test_pipeline_equals_brute_force(spark):
    """Classifier scores are the operator's; the other stages are redone by hand."""
    from test_llm_text import components_by_hand, dedup_by_hand
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality_vote.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    good_ids = {r.id for r in quality_vote.score(docs, model).where("score >= 0.7").collect()}
    rows = dedup_by_hand([(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good_ids])
    roots = components_by_hand(rows)
    rows = [(i, t) for i, t in rows if roots[i][1] == i]
    tok = tokens.load(tokens.tokenizer_path())
    want = {i: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in rows}
    got = defaultdict(int)
    for r in corpus_pipeline.run(spark, sf).collect():
        got[r.doc_id] += r.length
    assert dict(got) == want


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.where("doc_id < 0"), "/root/testdata/sf0.001")
        assert out.columns == docs.columns and out.collect() == []


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    df = queries.QUERIES[name](spark, sf)
    cur = duck(sf).execute(queries.ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert compare([tuple(r) for r in df.collect()], df.columns, cur.fetchall(), cols) is None


def test_every_operator_has_its_query():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 4 and packing.SEQUENCE_TOKENS == 4096 and line_dedup.HEAVY_SLOTS == 65536
