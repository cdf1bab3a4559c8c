"""Importance resampling: CRC against zlib, the draw against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from panelcast.llm import importance
from panelcast.llm.position_crc import BLOCK, SpanCrc
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def test_span_crc_equals_zlib_at_every_length():
    rng = random.Random(1)
    data = rng.randbytes(20 * BLOCK)
    starts, ends = [], []
    for size in [*range(1, 2 * BLOCK + 3), 3 * BLOCK, 3 * BLOCK + 1, 19 * BLOCK - 1, 20 * BLOCK]:
        starts.append(rng.randint(0, len(data) - size))
        ends.append(starts[-1] + size)
    got = SpanCrc().of(np.frombuffer(data, np.uint8), np.array(starts), np.array(ends))
    assert got.tolist() == [zlib.crc32(data[i:j]) for i, j in zip(starts, ends)]


def features_by_hand(text):
    words = WORD.findall((text or "").translate(UPPER))
    return len(words), [zlib.crc32(" ".join(words[i:i + k]).encode()) % 10000
                        for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def resample_by_hand(docs, target):
    parts = [(i, *features_by_hand(t)) for i, t in docs]
    s = Counter(b for _, _, f in parts for b in f)
    t = Counter(b for x in target for b in features_by_hand(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    rows = []
    for i, n_words, f in parts:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([i, n_words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], -1 if r[0] is None else r[0], r[2], r[3]))
    rank = {id(r): k + 1 for k, r in enumerate(fit[:5 * len(fit) // 100])}
    return sorted(((r[0], r[2], r[3], r[4], rank.get(id(r))) for r in rows), key=str)


def odd_docs():
    rng = random.Random(3)
    vocab = ["Alpha", "beta2", "naïve", "ÉTÉ", "x", "über", "ж", "mid-word", "a/b", "tab\tbed", "\x7fdel", "42"]
    docs = [(k, " ".join(rng.choices(vocab, k=rng.randint(0, 60)))) for k in range(120)]
    docs += [(200, None), (201, ""), (202, " \n\t--"), (203, "w" * 3000 + " tail"), (None, "one two " * 15),
             (5, "one two " * 15), (5, "one two " * 15), (204, "Z")]
    return docs


def got_rows(spark, docs, target):
    d = spark.createDataFrame([(i, t, 1, "r", 0.5) for i, t in docs], "doc_id long, text string, id int, rank string, score double")
    b = spark.createDataFrame([(t, 1) for t in target], "text string, n int")
    out = importance.resample(d, b)
    assert out.columns == ["id", "n_words", "n_features", "weight", "score", "rank"]
    return sorted(((r.id, r.n_features, r.weight, r.score, r.rank) for r in out.collect()), key=str)


@pytest.mark.parametrize("slice_bytes", [None, 40])
def test_resample_equals_brute_force(spark, monkeypatch, slice_bytes):
    target = ["beta2 x naïve beta2 x", None, "", "été ÉTÉ 42"]
    docs = odd_docs()
    if slice_bytes:  # nearly every text is cut into overlapping slices, in this process
        monkeypatch.setattr(importance, "SLICE_BYTES", slice_bytes)
        found = importance.Features()
        texts = [(t or "").encode() for _, t in docs]
        rows = [Counter() for _ in texts]
        for _, row, own in found.of(texts):
            for r, b in zip(row.tolist(), own.tolist()):
                rows[r][b] += 1
        assert rows == [Counter(features_by_hand(t)[1]) for _, t in docs]
    else:
        assert got_rows(spark, docs, target) == resample_by_hand(docs, target)


def test_resample_of_empty_tables(spark):
    assert got_rows(spark, [], ["x"]) == []
    docs = [(k, "some words " * 20) for k in range(40)]
    assert got_rows(spark, docs, []) == resample_by_hand(docs, [])


def test_query_equals_brute_force_on_whole_tables(spark):
    from panelcast.llm.q13_importance import op13_importance_resampling
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = op13_importance_resampling(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in got.dtypes} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == resample_by_hand([tuple(d) for d in docs], target)
