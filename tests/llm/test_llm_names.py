"""Columns of the caller that are named like helpers, empty rule lists, big host lists."""

import pytest
from pyspark.sql import functions as F

from panelcast.llm import bloom_cascade, line_dedup, ngram_join, quality_vote
from panelcast.llm.common import Work
from tests.llm.test_llm_text import LINE_DOCS, dedup_by_hand

HELPERS = ["_keep", "keep", "row", "_doc", "map_doc", "map_hash", "_row_hash", "_n_dropped", "n_dropped", "n_lines",
           "_kept_id", "kept_id", "_score", "score", "_text", "label", "_own", "own", "hit", "best", "_best", "listed_1",
           "_listed_1", "key", "odd name", "a.b"]


def wide(df):
    """``df`` with a column for every helper name, and what they must still hold."""
    return df.select("*", *[F.lit(k).alias(n) for k, n in enumerate(HELPERS)])


def untouched(df, first):
    assert df.columns[:len(first)] == first and df.columns[len(first):len(first) + len(HELPERS)] == HELPERS
    rows = df.select(*[F.col(f"`{n}`") for n in HELPERS]).distinct().collect()
    assert [tuple(r) for r in rows] == [tuple(range(len(HELPERS)))]


def test_lines_keep_clashing_columns(spark):
    docs = wide(spark.createDataFrame(LINE_DOCS, "doc_id long, text string"))
    out = line_dedup.dedup_lines(docs)
    untouched(out, ["doc_id", "text"])
    got = [(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()]
    assert sorted(got, key=str) == sorted(dedup_by_hand(LINE_DOCS), key=str)


def test_near_duplicates_keep_clashing_columns(spark):
    words = " ".join(f"w{k}" for k in range(30))
    rows = [(1, words), (2, words), (3, "other words of a text here"), (None, words), (4, None)]
    out = ngram_join.keep_one(wide(spark.createDataFrame(rows, "doc_id long, text string")))
    untouched(out, ["doc_id", "text"])
    assert sorted([r.doc_id for r in out.collect()], key=str) == [1, 3, 4, None]


def test_quality_keeps_clashing_columns(spark):
    good = [(k, f"A sentence with words, number {k}. And one more of them.") for k in range(40)]
    bad = [(100 + k, "$$$ !!! " * (k + 2) + "CLICK") for k in range(40)]
    docs = wide(spark.createDataFrame(good + bad, "doc_id long, text string"))
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in good + bad], "doc_id long, quality int")
    model = quality_vote.fit(docs, labels)
    out = quality_vote.keep_good(docs, model)
    untouched(out, ["doc_id", "text"])
    assert sorted(r.doc_id for r in out.collect()) == list(range(40))
    text_only = quality_vote.keep_good(docs.select("text"), model)
    assert text_only.columns == ["text"] and text_only.count() == 40


def test_fit_takes_one_row_of_a_repeated_id(spark):
    rows = [(1, f"Good words, all of them. {k}") for k in range(30)] + [(2, "!!! $$$ ### !!!")] * 30 + [(5, "###")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (5, 0)], "doc_id long, quality int")
    fitted = [i for i in (1, 2, 5) if not spark.range(1).select(F.crc32(F.lit(str(i)).cast("binary")) % 4 == 2).first()[0]]
    model = quality_vote.fit(docs, labels)
    assert len(model.vectors) == (len(fitted) if {1} < set(fitted) else 0)


RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"))
URLS = ["http://a.example.com/en/1", "http://x.bad.net/a", "http://fine.net/", "no url", None, "http://bad.net"]


def verdicts(df):
    return {r.url: (r.rule, r.verdict) for r in df.select("url", "rule", "verdict").collect()}


@pytest.mark.parametrize("max_bits", [None, 8])
def test_urls_with_clashing_columns_and_lists_of_any_size(spark, monkeypatch, max_bits):
    if max_bits:  # the list of hosts is above the size of a filter
        monkeypatch.setattr(bloom_cascade, "MAX_BITS", max_bits)
    pages = wide(spark.createDataFrame([(u,) for u in URLS], "url string"))
    listed = spark.createDataFrame([("bad.net",), ("bad.net",), (None,)], "key string")
    rules = () if max_bits else RULES
    out = bloom_cascade.judge_urls(pages, rules, listed)
    untouched(out, ["url"])
    assert out.columns[-4:] == ["host", "path", "rule", "verdict"]
    got = verdicts(out)
    assert got[URLS[1]] == got[URLS[5]] == (None, "block") and got[URLS[2]] == got["no url"] == got[None] == (None, "allow")
    assert got[URLS[0]] == ((None, "allow") if max_bits else ("example.com/en/", "block"))


def test_empty_rules_and_empty_list(spark):
    pages = spark.createDataFrame([(u,) for u in URLS], "url string")
    none = spark.createDataFrame([], "key string")
    assert set(verdicts(bloom_cascade.judge_urls(pages, [], none)).values()) == {(None, "allow")}
    assert bloom_cascade.judge_urls(pages.where("false"), [], none).count() == 0


def test_a_cascade_above_the_size_says_where_to_look(spark, monkeypatch):
    monkeypatch.setattr(bloom_cascade, "MAX_BITS", 8)
    keys = spark.createDataFrame([("a",), ("b",)], "key string")
    cascade = bloom_cascade.Cascade(keys, keys, Work(spark, "big-list"))
    with pytest.raises(ValueError, match="members"):
        cascade.has(F.col("key"), "x")
    each = spark.createDataFrame([("h1", "a"), ("h2", "c")], "host string, key string")
    assert [r.host for r in cascade.members(each).collect()] == ["h1"]
