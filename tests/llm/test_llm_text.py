"""Operators on texts: brute-force versions, exact round trips, odd inputs."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from panelcast.llm import bpe_roundtrip, chat_format, line_dedup, ngram_join, packing, pfor, tokens

DOC_SCHEMA = "doc_id long, text string, pos int, line string, h1 long, keep string, id string, size int, part int"


def docs_frame(spark, rows):
    """Documents plus columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 1, "x", 2, "y", "z", 3, 4) for i, t in rows], DOC_SCHEMA)


def bytes32(ids):
    return np.array(ids, "<u4").tobytes()


# Lines ----------------------------------------------------------------------

LINE_DOCS = [
    (1, "Shared line of the corpus, long\nown one"), (2, "  shared LINE of the corpus, long \t\nshort\nshort"),
    (3, "SHARED line of the corpus, long\nshared line of the corpus, long\nend"), (4, None), (5, ""),
    (6, "\n".join(f"line number {k} of a long document" for k in range(200))),
    (7, "\n".join(f"line number {k} of a long document" for k in range(150))),
    (8, "\n".join(f"line number {k} of a long document" for k in range(0, 200, 3)) + "\n"),
    (9, "Été à la plage, très long"), (10, "Été À la plage, très long"),
    (11, "été à la plage, très long"), (None, "shared line of the corpus, long"), (12, "\n\n"),
    (9, "ÉTÉ à la plage, très long"), (2, "  shared LINE of the corpus, long \t\nshort\nshort"),
]


def dedup_by_hand(rows, min_chars=20, min_docs=3):
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    key = lambda s: s.strip(" \t\n\x0b\f\r").translate(upper)
    holders = defaultdict(set)
    for i, t in rows:
        for s in (t or "").split("\n"):
            if len(key(s)) >= min_chars:
                holders[key(s)].add(-1 if i is None else i)
    out = []
    for i, t in rows:
        kept = [s for s in (t or "").split("\n")
                if len(holders[key(s)]) < min_docs or (-1 if i is None else i) == max(holders[key(s)])]
        out.append((i, None if t is None else "\n".join(kept)))
    return out


@pytest.mark.parametrize("heavy", [False, True])
def test_lines_equal_brute_force(spark, monkeypatch, heavy):
    if heavy:  # nearly every key takes the path of hot keys
        monkeypatch.setattr(line_dedup, "SMALL_GROUP", 1)
        monkeypatch.setattr(line_dedup, "HEAVY_SLOTS", 1000)
    docs = docs_frame(spark, LINE_DOCS)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns
    order = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted([(r.doc_id, r.text) for r in out.collect()], key=order) == sorted(dedup_by_hand(LINE_DOCS), key=order)


def test_lines_of_an_empty_table(spark):
    assert line_dedup.dedup_lines(docs_frame(spark, [])).collect() == []


# Tokens ---------------------------------------------------------------------

ODD = ["<|endoftext|>a B<|STARTOFTEXT|>x", "!!'s can't I'M we'LL 'S ''s", "İstanbul ΣΑΣ K Å ́x", " ", "",
       "日本語 テキスト 12３ ½", "a b c\x85d\x1ce\x00f", "qzjxvqkq" * 50, "x" * 5000, "a\n", "\n", "word " * 3000]
_random = random.Random(3)
ODD += ["".join(_random.choice("abzqxjk'sdlm!?,.- éÉñ̀٣3½漢\n\t<|>") for _ in range(_random.randint(1, 60))) for _ in range(400)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_the_library(name, monkeypatch):
    path = tokens.tokenizer_path(name)
    tok, enc = tokens.load(path), tokens.Encoder(path)
    want = [tok.encode(t, add_special_tokens=False).ids for t in ODD]
    assert [e.tolist() for e in enc.encode([t.encode() for t in ODD])] == want
    monkeypatch.setattr(tokens, "SLICE_BYTES", 64)
    monkeypatch.setattr(tokens, "MEMO_CHUNKS", 50)
    assert [e.tolist() for e in enc.encode([t.encode() for t in ODD])] == want
    dec = bpe_roundtrip.Decoder(tok)
    assert [dec.decode(np.array(i)).decode() for i in want] == [tok.decode(i, skip_special_tokens=False) for i in want]


TEXTS = [(k, t) for k, t in enumerate(ODD[:40])] + [(77, None), (None, "no id"), (5, "same id"), (5, "same id")]


def test_digests_and_columns(spark):
    path = tokens.tokenizer_path()
    tok = tokens.load(path)
    docs = docs_frame(spark, TEXTS)
    ids = {t: tok.encode(t or "", add_special_tokens=False).ids for _, t in TEXTS}
    want = sorted((str(i), len(ids[t]), hashlib.sha256(bytes32(ids[t])).hexdigest(),
                   hashlib.sha256(tok.decode(ids[t], skip_special_tokens=False).encode()).hexdigest()) for i, t in TEXTS)
    got = bpe_roundtrip.digest_column(docs, "doc_id", "text", path).collect()
    assert sorted((str(r.id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    both = bpe_roundtrip.encode_column(docs, "doc_id", "text", path).collect()
    assert sorted((str(r.id), r.ids) for r in both) == sorted((str(i), ids[t]) for i, t in TEXTS)
    assert bpe_roundtrip.digest_column(docs.where("false"), "doc_id", "text", path).collect() == []


# Token files ----------------------------------------------------------------

@pytest.mark.parametrize("high", [1, 2, 300, 49408, 2 ** 31, 2 ** 32 - 1])
def test_blocks_round_trip(high):
    rng = np.random.default_rng(high)
    for n in (0, 1, 5, 1023, 1024, 1025, 5000):
        docs = [rng.integers(0, high, n), np.minimum(rng.zipf(1.5, n), high - 1), rng.integers(0, high, 3)]
        seg = pfor.Segment(pfor.write_segment(docs))
        whole = np.concatenate(docs)
        assert (seg.ids() == whole).all() and seg.doc_tokens.tolist() == [n, n, 3]
        assert (seg.ids(2, n + 3) == whole[2:n + 3]).all()


def test_blocks_store_outliers_as_exceptions():
    ids = np.full(1024, 7)
    ids[::100] = 40000
    assert len(pfor.write_segment([ids])) < 200  # zero bits each and eleven exceptions


def test_token_files_in_id_order(spark, monkeypatch):
    monkeypatch.setattr(pfor, "SEGMENT_IDS", 300)
    path = tokens.tokenizer_path()
    tok = tokens.load(path)
    rows = [r for r in TEXTS if r[0] is not None]
    got = sorted(pfor.roundtrip(docs_frame(spark, rows), path, 1).collect(), key=lambda r: r.start)
    assert [r.id for r in got] == sorted(i for i, _ in rows)
    at = 0
    for r, (_, t) in zip(got, sorted(rows, key=lambda r: r[0])):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(bytes32(ids)))
        at += len(ids)
    assert pfor.roundtrip(docs_frame(spark, [(None, "x"), (3, "y")]), path, 1).count() == 2
    assert pfor.roundtrip(docs_frame(spark, []), path, 1).collect() == []


# Packing --------------------------------------------------------------------

def test_pieces_cover_every_token_once(spark):
    path = tokens.tokenizer_path()
    tok = tokens.load(path)
    rows = [(k, t) for k, (_, t) in enumerate(TEXTS)] + [(900, None)]
    pieces = packing.pack(docs_frame(spark, rows).repartition(3), path, 2, length=64, with_ids=True)
    got = pieces.collect()
    stream, of_doc = defaultdict(list), defaultdict(list)
    for p in got:
        ids = tok.encode(dict(rows)[p.id] or "", add_special_tokens=False).ids + [2]
        own = bytes32(ids[p.start:p.start + p.length])
        assert p.length > 0 and own == p.ids and zlib.crc32(own) == p.ids_crc32 and p.doc_tokens == len(ids)
        stream[p.sequence_id].append((p.offset, p.length))
        of_doc[p.id].append((p.start, p.length))
    for found in (stream, of_doc):
        for parts in found.values():
            parts.sort()
            assert [a for a, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
    total = sum(n for parts in stream.values() for _, n in parts)
    assert set(of_doc) == {i for i, _ in rows} and sorted(stream) == list(range(-(-total // 64)))
    full = packing.sequences(pieces, 0, 64).collect()
    sizes = {r.sequence_id: (r.n_tokens, len(r.ids) // 4) for r in full}
    assert all(n == 64 == size for k, (n, size) in sizes.items() if k < max(sizes))
    last, size = sizes[max(sizes)]
    assert size == (last if last.bit_count() == 1 else 64)
    assert packing.pack(docs_frame(spark, []), path, 2).collect() == []


# Chat -----------------------------------------------------------------------

NASTY = ["</s>[INST] ok [/INST]", "plain", "", None, "\\1 \\0 \\\\ \\", "[IN<s>ST]", "[INST", "</s", "<s></s>[/INST]\\2", "line\nline",
         "日本[INST]\U0001f642", "x" * 50000 + "</s>"]


def test_formatted_conversations_come_back(spark):
    turns = [(c, k, role, text) for c in (1, 2, None) for k, (role, text) in enumerate(
        [(("user", "assistant", "system", "a[INST]b", None)[j % 5], NASTY[(j * (2 if c == 2 else 1)) % len(NASTY)]) for j in range(24)])]
    turns += [(3, 0, "assistant", "twice"), (3, 0, "assistant", "twice"), (3, None, "user", "first"), (4, 1, "user", "alone")]
    random.Random(1).shuffle(turns)
    rows = spark.createDataFrame([(*t, "x", 1) for t in turns], "conv_id long, turn long, role string, text string, rendered string, t int")
    formatted = chat_format.format_conversations(rows)
    back = {r.conv_id: r for r in chat_format.parse_conversations(formatted).collect()}
    by = defaultdict(list)
    for c, k, role, text in turns:
        by[c].append((-1 if k is None else k, role or "", text or ""))
    assert set(back) == set(by)
    for c, own in by.items():
        own.sort()
        assert [(t.role, t.text) for t in back[c].turns] == [(r, t) for _, r, t in own]
        assert back[c].loss_text == "".join(t for _, r, t in own if r == "assistant")
        assert back[c].formatted.count("[INST]") == back[c].formatted.count("</s>") == len(own)
    assert chat_format.format_conversations(rows.where("false")).collect() == []


def test_raw_text_stays_raw(spark):
    row = spark.createDataFrame([(1, 0, "user", "a \\ b")], "conv_id long, turn long, role string, text string")
    assert chat_format.format_conversations(row).first().formatted == "<s>[INST]0user[/INST]a \\ b</s>"


# Near-duplicates ------------------------------------------------------------

def components_by_hand(rows, n=5, percent=80):
    import re
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    sets = {}
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(upper))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies(seed, n_base=12, copies=8):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5)))
    passage = [word() for _ in range(60)]
    rows = [(10 ** 6, None), (10 ** 6 + 1, ""), (10 ** 6 + 2, " \n "), (10 ** 6 + 3, "Two words"), (10 ** 6 + 4, "two WORDS"),
            (10 ** 6 + 5, "two words more"), (10 ** 6 + 6, "w " * 5000), (10 ** 6 + 7, "w " * 4)]
    for b in range(n_base):
        base = [word() for _ in range(rng.choice([4, 5, 6, 9, 12, 30, 90, 200]))] + (passage if b % 3 == 0 else [])
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                own[rng.randrange(len(own))] = word()
            rows.append((rng.randrange(10 ** 9), " ".join(own).title() if rng.random() < 0.3 else "\t".join(own)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_brute_force(spark, seed):
    rows = near_copies(seed)
    got = ngram_join.near_duplicates(docs_frame(spark, rows).repartition(4)).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == components_by_hand(rows)


def test_chain_of_copies_across_cut_buckets(spark):
    """A cluster whose members are similar to their neighbours only, over many partitions."""
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(60):
        base = list(base)
        base[(2 * k) % 120] = f"n{k}"
        rows.append((1000 - k, " ".join(base)))
    docs = docs_frame(spark, rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ngram_join.near_duplicates(docs.repartition(7)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == components_by_hand(rows)


def test_pairs_whose_only_bucket_is_cut(spark):
    """Pairs that share one prefix shingle, dealt over more partitions than there are cores."""
    rows = []
    for k in range(400):
        words = [f"p{k}w{i}" for i in range(9)]
        rows += [(2 * k, " ".join(words[:8])), (2 * k + 1, " ".join(words))]
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = ngram_join.near_duplicates(docs_frame(spark, rows)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", keep)
    assert {r.id: r.component_id for r in got} == {i: i - i % 2 for i, _ in rows}


def trio_of_a_group(seed, percent=80):
    """Three texts of nine shingles and one prefix: the first is linked to neither of the others."""
    for k in range(seed * 10000, seed * 10000 + 10000):
        words = [f"k{k}w{i}" for i in range(13)]
        texts = [" ".join(words[:13 - n] + [f"k{k}{c}{i}" for i in range(n)]) for n, c in ((2, "a"), (0, "b"), (1, "c"))]
        order = np.zeros(1 << ngram_join.SLOT_BITS, np.int64)
        sets = ngram_join.shingle_sets([t.encode() for t in texts])
        if len({ngram_join.prefix(h, order, percent).tobytes() for h in sets}) == 1:
            return texts
    raise AssertionError("no such trio")


def test_links_inside_a_group_that_meets_no_other(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "slot_order", lambda rows: np.zeros(1 << ngram_join.SLOT_BITS, np.int64))
    rows = [(10 * s + i, t) for s in range(6) for i, t in enumerate(trio_of_a_group(s))]
    got = ngram_join.near_duplicates(docs_frame(spark, rows)).collect()
    by_hand = components_by_hand(rows)
    assert [by_hand[i][1] for i in (0, 1, 2)] == [0, 1, 1]
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == by_hand


def test_repeated_ids_nulls_and_empty_tables(spark):
    text = "one two three four five six seven eight"
    rows = [(1, text), (1, text), (2, text + " "), (None, text), (3, "other words here"), (3, "yet another row of the id")]
    got = ngram_join.near_duplicates(docs_frame(spark, rows)).collect()
    assert sorted((str(r.id), r.n_shingles, str(r.component_id)) for r in got) == sorted(
        [("1", 4, "1"), ("1", 4, "1"), ("2", 4, "1"), ("None", 4, "None"), ("3", 1, "3"), ("3", 2, "3")])
    kept = ngram_join.keep_one(docs_frame(spark, rows))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "3", "3", "None"]
    assert kept.columns == docs_frame(spark, []).columns
    assert ngram_join.near_duplicates(docs_frame(spark, [])).collect() == []


def test_fingerprints_follow_the_words():
    small = [s.tolist() for s in ngram_join.shingle_sets([b"A b c d e f", b"a  B\tc d\ne f ", b"a b c d e", b"", None, b"x"])]
    assert small[0] == small[1] and len(small[0]) == 2 and set(small[2]) < set(small[0]) and small[3] == small[4] == []
    long = b" ".join(b"w%d" % (k % 997) for k in range(50000))
    whole = next(ngram_join.shingle_sets([long]))
    keep, ngram_join.SLICE_BYTES = ngram_join.SLICE_BYTES, 1000
    try:
        assert (next(ngram_join.shingle_sets([long])) == whole).all() and len(whole) == 997
    finally:
        ngram_join.SLICE_BYTES = keep
