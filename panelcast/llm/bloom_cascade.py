"""URL filtering by Bloom filter cascades, with DataFrame functions only.

A cascade answers exact membership for a closed universe of keys. Level 1
encodes the listed keys; the corpus keys that pass it without being listed are
encoded by level 2; the listed keys that pass level 2 by level 3, and so on
until a level lets nothing false pass. A key is listed if the first level that
rejects it has an even number, or if it passes all of an odd number of levels.
The universe is every key of the whole corpus, so no answer is wrong, and the
filters are small arrays that travel with the plan: judging takes no join.

The bits are arrays of 64-bit words: at most MAX_BITS bits in a level, checked. A
list of hosts above that size is looked up by a left semi join of the distinct
hosts of the corpus instead, which gives the same answers.

Rules: a rule (host, path) fits a url whose host is the rule's or a subdomain,
and whose path starts with the rule's; the longest rule string wins. The
candidate keys of a url are its host suffixes joined with its path prefixes of
the lengths that rules have.

Defined results: a null url, or one without "://", has empty host and path and
fits no rule; such a url is allowed. Repeated rows are judged alike; an empty
table or an empty list gives empty filters. Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import Work, lower_ascii, packed, unpacked

#: Bits a key in a level, hashes a key, and the most bits of a level (32 MB).
KEY_BITS, HASHES, MAX_BITS = 12, 6, 2 ** 28


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without '://'."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def host_suffixes(host: Column, most_labels: int) -> Column:
    """Suffixes of the host of at most ``most_labels`` labels."""
    last = F.slice(F.split(host, r"\.", -1), F.greatest(F.size(F.split(host, r"\.", -1)) - most_labels + 1, F.lit(1)),
                   F.lit(most_labels))

    def each(labels: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))

    return F.element_at(F.transform(F.array(last), each), 1)


def key_candidates(host: Column, path: Column, most_labels: int, path_lengths: Sequence[int]) -> Column:
    """Keys of a url that a rule of these dimensions could have."""
    prefixes = F.array_compact(F.array(*[
        F.when(F.char_length(path) >= n, F.substring(path, 1, n)) for n in sorted(set(path_lengths))]))
    return F.flatten(F.transform(host_suffixes(host, most_labels),
                                 lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))


def _positions(key: Column, level: int, bits: int) -> list[Column]:
    # 31 bits of two hashes; the number of bits is a power of two of at most 2^28.
    a, b = (F.xxhash64(F.lit(2 * level + i), key).bitwiseAND(F.lit(2 ** 31 - 1)) for i in (0, 1))
    return [(a + b * F.lit(i)).bitwiseAND(F.lit(bits - 1)) for i in range(HASHES)]


class Level:
    """One Bloom filter of the cascade; ``words`` is a one-row table (words)."""

    def __init__(self, number: int, bits: int, words: DataFrame):
        self.number, self.bits, self.words = number, bits, words

    def has(self, key: Column, words: Column | None = None) -> Column:
        """Whether the filter lets the key pass; ``words`` is its attached column
        (lambdas cannot hold a subquery)."""
        words = self.words.scalar() if words is None else words
        hit = F.lit(True)
        for p in _positions(key, self.number, self.bits):
            word = F.get(words, F.shiftright(p, 6).cast("int"))
            hit = hit & (F.call_function("getbit", word, p.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return hit


def build_level(keys: DataFrame, number: int, n_keys: int, work: Work) -> Level:
    bits = 64
    while bits < KEY_BITS * n_keys:
        bits *= 2
    if bits > MAX_BITS:
        raise ValueError(f"{n_keys} keys need more than {MAX_BITS} bits")
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), number, bits))).alias("p"))
    set_bits = at.select(F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, CAST(p & 63 AS INT))").alias("bit"))
    blank = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bit"))
    words = set_bits.unionByName(blank).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    dense = words.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words"))
    return Level(number, bits, work.table(dense, f"level-{number}"))


class Cascade:
    """Exact membership in ``listed`` for every key of ``universe`` (columns: key)."""

    def __init__(self, listed: DataFrame, universe: DataFrame, work: Work):
        self.levels: list[Level] = []
        # Keys to encode by the next level, and those that it must not let pass.
        inside = work.table(listed.where("key IS NOT NULL").distinct(), "listed")
        n_inside = inside.count()
        self.joined = inside if KEY_BITS * n_inside > MAX_BITS else None
        outside = None
        while n_inside and self.joined is None:
            number = len(self.levels) + 1
            level = build_level(inside, number, n_inside, work)
            self.levels.append(level)
            if outside is None:
                # The only pass over the corpus: what is left are its false positives.
                passed = universe.where(level.has(F.col("key"))).select("key", F.lit(0).alias("own"))
                marked = passed.unionByName(inside.select("key", F.lit(1).alias("own")))
                wrong = marked.groupBy("key").agg(F.max("own").alias("own")).where("own = 0").select("key")
            else:
                wrong = outside.where(level.has(F.col("key")))
            wrong = work.table(wrong, f"passed-{number}")
            outside, inside, n_inside = inside, wrong, wrong.count()

    def attached(self, name: str) -> list[Column]:
        """The filters as columns of one array each, for ``has``."""
        return [level.words.scalar().alias(f"{name}_{level.number}") for level in self.levels]

    def has(self, key: Column, name: str) -> Column:
        """Membership of a key of the universe, by the filters attached under ``name``."""
        if self.joined is not None:
            raise ValueError(f"more than {MAX_BITS // KEY_BITS} listed keys: look them up by members()")
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            passed = level.has(key, F.col(f"{name}_{level.number}"))
            answer = F.when(passed, answer).otherwise(F.lit(level.number % 2 == 0))
        return answer


    def members(self, candidates: DataFrame) -> DataFrame:
        """The rows (host, key) of ``candidates`` whose key is listed, for lists above MAX_BITS."""
        return candidates.join(self.joined, "key", "left_semi")


class Rules:
    """(action, host, path) rules judged by one cascade per action."""

    def __init__(self, rules: Sequence[tuple[str, str, str]], pages: DataFrame, work_name: str = "url-rules"):
        spark = pages.sparkSession
        self.labels = max([h.count(".") + 1 for _, h, _ in rules], default=1)
        self.lengths = sorted({len(p) for _, _, p in rules})
        self.cascades = {}
        for action in sorted({a for a, _, _ in rules}):
            own = [(h + p,) for a, h, p in rules if a == action]
            universe = pages.select(F.explode(self.candidates(F.col("host"), F.col("path"))).alias("key"))
            self.cascades[action] = Cascade(spark.createDataFrame(own, "key string"), universe,
                                            Work(spark, f"{work_name}-{action}"))

    def candidates(self, host: Column, path: Column) -> Column:
        return key_candidates(host, path, self.labels, self.lengths)

    def attached(self) -> list[Column]:
        return [c for action, cascade in self.cascades.items() for c in cascade.attached(f"_{action}")]

    def best(self, host: Column, path: Column) -> Column:
        """struct(size, key, action) of the longest rule that fits, or null."""
        def fitting(action: str, cascade: Cascade) -> Column:
            return F.transform(F.filter(self.candidates(host, path), lambda k: cascade.has(k, f"_{action}")), lambda k: F.struct(
                F.char_length(k).alias("size"), k.alias("key"), F.lit(action).alias("action")))

        if not self.cascades:
            return F.lit(None).cast("struct<size:int,key:string,action:string>")
        return F.array_max(F.concat(*[fitting(a, c) for a, c in self.cascades.items()]))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], listed_hosts: DataFrame,
               url_col: str = "url") -> DataFrame:
    """``pages`` plus host, path, rule and verdict: the longest rule's action, else
    block if the host or a parent domain is in ``listed_hosts`` (column key)."""
    spark = pages.sparkSession
    host, path = url_parts(F.col(url_col))
    keys = pages.select(host.alias("host"), path.alias("path"))
    judged = Rules(rules, keys)
    labels = listed_hosts.agg(F.max(F.size(F.split("key", r"\.", -1)))).first()[0] or 1
    hosts = keys.select(F.explode(host_suffixes(F.col("host"), labels)).alias("key"))
    listed = Cascade(listed_hosts, hosts, Work(spark, "url-hosts"))
    rows = pages.select(packed(pages), host.alias("host"), path.alias("path"))
    if listed.joined is None:
        own = F.exists(host_suffixes(F.col("host"), labels), lambda k: listed.has(k, "listed"))
    else:
        each = rows.select("host").distinct().select("host", F.explode(host_suffixes(F.col("host"), labels)).alias("key"))
        hit = listed.members(each).select("host").distinct().withColumn("hit", F.lit(True))
        rows, own = rows.join(hit, "host", "left"), F.coalesce("hit", F.lit(False))
    # A url has few candidates; the filters are constant columns beside them.
    found = rows.select("*", *judged.attached(), *listed.attached("listed"))
    best = judged.best(F.col("host"), F.col("path"))
    verdict = F.coalesce(F.col("best.action"), F.when(F.col("own"), F.lit("block")).otherwise(F.lit("allow")))
    result = found.select("row", "host", "path", best.alias("best"), own.alias("own"))
    return result.select(*unpacked(pages.drop("host", "path", "rule", "verdict")), "host", "path", F.col("best.key").alias("rule"), verdict.alias("verdict"))
