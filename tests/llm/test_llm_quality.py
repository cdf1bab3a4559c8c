"""Classifier: terms, weights, projection and vote against a plain version; words and scripts."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from panelcast.llm import quality_vote as qv

WRAP = 2 ** 64


def bin_of(value: int, n: int) -> int:
    return (value * 0x9E3779B97F4A7C15 % WRAP >> 40) % n


def kind_of(b: int) -> int:
    if b > 127:
        return 0
    c = chr(b)
    return 1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 5 if c == "\n" else 4 if c.isspace() else b + 6


def word_hash(word: bytes) -> int:
    total = 0
    for place, b in enumerate(word):
        x = (b + 257 * place + 1) * 0x9E3779B97F4A7C15 % WRAP
        total += (x ^ x >> 29) * 0x9E3779B97F4A7C15
    return total % WRAP


def terms_by_hand(text: bytes, terms: int) -> np.ndarray:
    """(shapes, words, grams, marks) in one vector, counted one by one."""
    n = terms // 4
    shapes, words, grams, marks = np.zeros(terms - 16 - 2 * n), np.zeros(n), np.zeros(n), np.zeros(16)
    runs = [k for i, k in enumerate(map(kind_of, text)) if i == 0 or kind_of(text[i - 1]) != k]
    for size in range(2, 6):
        for i in range(len(runs) - size + 1):
            value = 0
            for k in runs[i:i + size]:
                value = (value * 257 + k + 1) % WRAP
            shapes[bin_of(value, len(shapes))] += 1
    word = b""
    for b in [*text, 32]:
        if b > 127 or chr(b).isalnum():
            word += bytes([b + 32 if 65 <= b <= 90 else b])
        elif word:
            words[bin_of(word_hash(word), n)] += 1
            for a, c, d in zip(word, word[1:], word[2:]):
                grams[bin_of(a * 65536 + c * 256 + d, n)] += 1
            word = b""
    for at, items in ((0, text.split()), (8, text.split(b"\n"))):
        if text and len(items) > 3:
            again = [sum(x == y for x, y in zip(items[d:], items)) for d in (1, 2, 3)] + [len(items) - len(set(items))]
            marks[at:at + 4] = again
            marks[at + 4:at + 8] = [len(items) if r > len(items) / 4 else 0 for r in again]
    return np.concatenate([shapes, words, grams, marks])


def weigh_by_hand(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    n = len(counts) // 4
    cut = [0, len(counts) - 16 - 2 * n, len(counts) - 16 - n, len(counts) - 16, len(counts)]
    logs = []
    for k in range(4):
        total = counts[cut[k]:cut[k + 1]].sum() if k < 3 else counts[:cut[1]].sum()
        logs.append(np.log1p(1000 * counts[cut[k]:cut[k + 1]] / max(total, 1)) * idf[cut[k]:cut[k + 1]])
    form = np.concatenate([logs[0], logs[3]])
    lengths = [np.linalg.norm(form), np.linalg.norm(logs[1]) / qv.WORD_WEIGHT, np.linalg.norm(logs[2]) / qv.GRAM_WEIGHT]
    lengths.append(lengths[0])
    row = np.concatenate([p / (s or 1) for p, s in zip(logs, lengths)])
    return row / (np.linalg.norm(row) or 1)


def scores_by_hand(fitted: list[tuple[bytes, int]], texts: list[bytes], share: float, terms: int) -> list[float]:
    """Full decomposition of the fitted rows, one cosine after the other, sorted neighbours."""
    counts = np.array([terms_by_hand(t, terms) for t, _ in fitted])
    labels = [y for _, y in fitted]
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 0.1
    x = np.array([weigh_by_hand(c, idf) for c in counts])
    _, sizes, right = np.linalg.svd(x, full_matrices=False)
    right = right[sizes > 1e-4][:qv.DIMENSIONS]
    ones = sum(labels) / len(labels)
    weight = [share / ones if y else (1 - share) / (1 - ones) for y in labels]
    base, out = x @ right.T, []
    for text in texts:
        own = right @ weigh_by_hand(terms_by_hand(text, terms), idf)
        size = np.linalg.norm(own)
        cos = [float(own @ b / size / np.linalg.norm(b)) if size > 1e-6 else 0.0 for b in base]
        near = sorted(range(len(cos)), key=lambda i: -cos[i])[:qv.NEIGHBOURS]
        votes = [(max(cos[i], 0) ** qv.SHARPNESS * weight[i], labels[i]) for i in near]
        out.append((sum(v * y for v, y in votes) + qv.PRIOR_WEIGHT * share) / (sum(v for v, _ in votes) + qv.PRIOR_WEIGHT))
    return out


def held(i: int) -> bool:
    return zlib.crc32(str(i).encode()) % 4 == 2


def mixed_texts(seed: int, n: int) -> list[str]:
    rng = np.random.default_rng(seed)
    marks = [" ", " ", " ", ". ", "\n", " ### ", "!! ", " 17 ", ", ÄÖ "]
    return ["".join("".join(rng.choice(list("abcdeXYzé"), rng.integers(1, 7))) + str(rng.choice(marks))
                    for _ in range(rng.integers(3, 60))) for _ in range(n)]


@pytest.mark.parametrize("text", ["", "a", "ab", "abc", "  ", "The The the\nthe the", "Ünïcode, 東京都 の 本", "x" * 50,
                                  "one\n\none\n\none\n", "a-b c_d e1f2 99", "\x00\x7f é"])
def test_terms_equal_a_plain_count(text):
    assert np.array_equal(qv.term_counts(text.encode(), 400), terms_by_hand(text.encode(), 400))


def test_terms_of_a_text_of_many_slices(monkeypatch):
    text = "\n".join(mixed_texts(1, 30)).encode()
    whole = qv.term_counts(text, 400)
    monkeypatch.setattr(qv, "SLICE_BYTES", 700)
    cut = qv.term_counts(text, 400)
    words = qv.parts(400)[1]
    # Only what a cut touches differs: a word, and shapes and grams across it.
    assert 0 <= (cut - whole)[words].sum() <= len(text) / 700 and np.abs(cut - whole).sum() < len(text) / 700 * 40


def test_scores_equal_a_plain_version(spark):
    texts = mixed_texts(5, 60) + ["", "LOUD LOUD LOUD LOUD\n" * 20]
    rows = list(enumerate(texts))
    label = [int(i % 3 > 0) for i, _ in rows]
    docs = spark.createDataFrame([*rows, (900, None)], "doc_id long, text string")
    model = qv.fit(docs, spark.createDataFrame([(i, label[i]) for i, _ in rows], "doc_id long, quality int"), terms=400)
    fitted = [(t.encode(), label[i]) for i, t in rows if not held(i)]
    share = sum(y for _, y in fitted) / len(fitted)
    got = {r.id: r.score for r in qv.score(docs, model).collect()}
    want = scores_by_hand(fitted, [t.encode() for t in [*texts, ""]], share, 400)
    assert model.share == pytest.approx(share) and len(model.vectors) == len(fitted) <= qv.DIMENSIONS
    assert [got[i] for i in [*range(len(texts)), 900]] == pytest.approx(want, abs=2e-3)


@pytest.mark.parametrize("letters", ["abcdefghijklmnop", "абвгдежзиклмнопр", "東京都大阪市北海道沖縄県本日"])
def test_words_tell_texts_of_one_shape_apart(spark, letters):
    """Same lengths and punctuation, two vocabularies; also in scripts without ASCII letters."""
    rng = np.random.default_rng(8)
    lists = [["".join(rng.choice(list(letters), 4)) for _ in range(40)] for _ in range(2)]
    rows = [(i, " ".join(rng.choice(lists[i % 2], 30)) + ".") for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = qv.fit(docs, spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int"))
    got = {r.id: r.score for r in qv.score(docs, model).collect() if held(r.id)}
    assert len(got) > 30 and np.mean([(s >= 0.7) == (i % 2 == 1) for i, s in got.items()]) >= 0.97
