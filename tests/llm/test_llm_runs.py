"""Periodic runs: extensions and runs against plain versions, odd texts."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from panelcast.llm import periodic_runs as pr
from panelcast.llm.recompression import Grammar
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("seed", range(6))
def test_extensions_equal_plain_comparison(seed):
    rng = random.Random(seed)
    body = []
    while len(body) < 400:
        unit = [rng.randint(0, seed + 1) for _ in range(rng.randint(1, 30))]
        body += unit * rng.randint(1, 9)
    line = np.array([1000, *body, 1001])
    g, n = Grammar(line), len(line)
    i, j = np.array([(x, y) for x in range(1, n - 1, 3) for y in range(x + 1, n - 1, 2)]).T
    ahead, back = g.extend(i, j), g.extend(i, j, forward=False)
    for x, y, f, b in zip(i.tolist(), j.tolist(), ahead.tolist(), back.tolist()):
        want_f = next(k for k in range(n) if line[x + k] != line[y + k])
        want_b = next(k for k in range(n) if line[x - k] != line[y - k])
        assert (f, b) == (want_f, want_b)


def runs_by_hand(w):
    """Every stretch by every period, kept where no smaller period fits it."""
    n, found = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q) and j > i:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def row_by_hand(i, text, planted=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(i).encode())
    g = h // 10
    if planted and i is not None and h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    runs = runs_by_hand(w)
    gone = {k for s, size, q in runs for k in range(s + q, s + size)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    first = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (i, len(runs), *first, sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)),
            sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def odd_texts():
    rng = random.Random(5)
    out = [None, "", " \n\t", "one", "a " * 23, "a " * 24, "a " * 500, "a b " * 12, "a b c " * 7 + "a b", "\x1f\x85 x",
           "é ü " * 30 + "\x0b" + "é ü é " * 9, " ".join("abaababaabaab" * 9)]
    for _ in range(60):
        words = []
        for _ in range(rng.randint(1, 6)):
            unit = [rng.choice("abcd") * rng.randint(1, 2) for _ in range(rng.randint(1, 15))]
            words += unit * rng.randint(1, 8) + unit[:rng.randint(0, len(unit))]
        out.append(rng.choice([" ", "  ", "\n"]).join(words))
    return out


@pytest.mark.parametrize("group", [None, 60])
def test_runs_equal_plain_version(monkeypatch, group):
    if group:  # groups of one text, long texts interned in slices, small chunks of the grid
        monkeypatch.setattr(pr, "GROUP_BYTES", group)
        monkeypatch.setattr(pr, "CHUNK_PLACES", 7)
    texts = odd_texts()
    for t, (n, runs, kept) in zip(texts, pr.runs_of_texts([(t or "").encode() for t in texts])):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        want = runs_by_hand(w)
        gone = {k for s, size, q in want for k in range(s + q, s + size)}
        assert (n, [tuple(r) for r in runs.tolist()]) == (len(w), want)
        assert kept.decode() == " ".join(x for k, x in enumerate(w) if k not in gone)


def test_other_limits_than_the_defaults():
    text = b"x y x y x y z " + b"k " * 5
    _, runs, kept = next(pr.runs_of_texts([text], min_words=4, min_repeats=2))
    assert runs.tolist() == [[0, 6, 2], [7, 5, 1]] and kept == b"x y z k"


def test_operator_on_odd_rows(spark):
    texts = odd_texts()[:20]
    docs = spark.createDataFrame([(k % 15 if k else None, t, "r", 1, "w") for k, t in enumerate(texts)],
                                 "doc_id long, text string, runs string, id int, words string")
    out = pr.periodic_runs(docs)
    assert out.columns == ["id", "n_words", "runs", "text"]
    got = sorted(((r.id, len(r.runs), r.text) for r in out.collect()), key=str)
    want = []
    for k, t in enumerate(texts):
        own = next(pr.runs_of_texts([(t or "").encode()]))
        want.append((k % 15 if k else None, len(own[1]), own[2].decode()))
    assert got == sorted(want, key=str)
    assert pr.periodic_runs(docs.where("false")).count() == 0


def test_query_equals_plain_version_on_whole_table(spark, tmp_path):
    from panelcast.llm.q11_periodic_runs import op11_periodic_runs
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = [(d.doc_id, d.text) for d in docs if len(d.text) < 6000]
    rows += [(10_000_000 + k, t) for k, t in enumerate(odd_texts() * 3)] + [(None, "z " * 40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = op11_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((row_by_hand(i, t) for i, t in rows), key=str)
