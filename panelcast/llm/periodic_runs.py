"""Periodic runs of words in every text, and texts without the repeats.

A run is a stretch of words with smallest period q and at least
``max(min_words, min_repeats * q)`` words that cannot be extended at either
end. The places where a word equals the one q further on are then at least
``step(q) = max(min_words - q, (min_repeats - 1) * q)`` in a row, so one of
them lies on the grid 0, step, 2 step, ...: over all q a harmonic number of
grid places. Each place whose two words agree is extended exactly in both
directions by grammar queries (``recompression``). Of the stretches found for
several periods the smallest period counts: it divides the others.

Map-only: texts are handled in groups of bounded size, one grammar a group; a
longer text is a group alone (its words are interned slice by slice, some 100
bytes per word).

Defined results: null and empty texts, and texts of white space, have no word,
no run and an empty text; rows that repeat an id are separate documents; an
empty table gives no row. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 24
MIN_REPEATS = 3
#: Text bytes in a group, and grid places that are looked at together.
GROUP_BYTES = 1_000_000
CHUNK_PLACES = 1_000_000
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def intern(text: bytes, names: dict[bytes, int]) -> np.ndarray:
    """Words of a text as numbers; new words get the next number."""
    parts, at = [], 0
    while at < len(text):
        end = at + GROUP_BYTES
        while end < len(text) and text[end] not in SPACE_BYTES:
            end += 1
        words = text[at:end].split()
        for w in words:
            if w not in names:
                names[w] = len(names)
        parts.append(np.fromiter(map(names.__getitem__, words), np.int32, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def grid(starts: np.ndarray, sizes: np.ndarray, min_words: int, min_repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of every grid place of the documents, in chunks."""
    periods = np.where(sizes >= min_words, sizes // min_repeats, 0)
    for lo in range(0, int(periods.sum()), CHUNK_PLACES):
        # The pairs (document, period) number lo.. of all of them.
        stops = np.cumsum(periods)
        pair = np.arange(lo, min(lo + CHUNK_PLACES, int(stops[-1])))
        doc = np.searchsorted(stops, pair, side="right")
        q = pair - (stops - periods)[doc] + 1
        step = np.maximum(min_words - q, (min_repeats - 1) * q)
        n = -(-(sizes[doc] - q) // step)
        cuts = np.flatnonzero(np.diff(np.cumsum(n) // CHUNK_PLACES)) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(n)]):
            own = n[i:j]
            nth = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
            yield np.repeat(starts[doc[i:j]], own) + nth * np.repeat(step[i:j], own), np.repeat(q[i:j], own)


def _smallest_periods(found: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) without repeats: of each stretch the smallest period."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    return found[new]


def find_runs(docs: list[np.ndarray], n_names: int, min_words: int = MIN_WORDS,
              min_repeats: int = MIN_REPEATS) -> list[np.ndarray]:
    """(start, length, period) rows of every document, by start, then period."""
    from panelcast.llm.recompression import Grammar
    sizes = np.array([len(d) for d in docs], np.int64)
    # A number of its own stands before every document and after the last.
    marks = [np.array([n_names + k], np.int32) for k in range(len(docs) + 1)]
    line = np.concatenate([x for pair in zip(marks, docs) for x in pair] + marks[-1:])
    starts = 1 + np.cumsum(sizes + 1) - (sizes + 1)
    grammar, found = None, np.zeros((0, 3), np.int64)
    for place, q in grid(starts, sizes, min_words, min_repeats):
        same = line[place] == line[place + q]
        place, q = place[same], q[same]
        if not len(place):
            continue
        grammar = grammar or Grammar(line)
        end = place + q + grammar.extend(place, place + q)
        start = place - grammar.extend(place - 1, place + q - 1, forward=False)
        long = end - start >= np.maximum(min_words, min_repeats * q)
        found = _smallest_periods(np.concatenate([found, np.stack([start, end, q], axis=1)[long]]))
    owner = np.searchsorted(starts, found[:, 0], side="right") - 1
    rows = np.stack([found[:, 0] - starts[owner], found[:, 1] - found[:, 0], found[:, 2]], axis=1)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0], owner))]
    bounds = np.searchsorted(owner, np.arange(len(docs) + 1))
    return [rows[i:j] for i, j in zip(bounds, bounds[1:])]


def keep_mask(n: int, runs: np.ndarray) -> np.ndarray:
    """True for words that are in no run after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def _groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def runs_of_texts(texts: list[bytes], min_words: int = MIN_WORDS,
                  min_repeats: int = MIN_REPEATS) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """(words, runs, text without the repeats) of each text."""
    for group in _groups(texts):
        names: dict[bytes, int] = {}
        docs = [intern(t, names) for t in group]
        words = list(names)
        for own, runs in zip(docs, find_runs(docs, len(names), min_words, min_repeats)):
            kept = own[keep_mask(len(own), runs)] if len(runs) else own
            yield len(own), runs, b" ".join(map(words.__getitem__, kept.tolist()))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                  min_repeats: int = MIN_REPEATS) -> DataFrame:
    """(id, n_words, runs, text) of every row: runs as (start, length, period) by start,
    then period; text = the words that stay, joined by one space."""
    def run(batches):
        import pyarrow as pa

        from panelcast.llm.periodic_runs import runs_of_texts
        from panelcast.llm.tokens import as_bytes, small_batches
        fields = ["start", "length", "period"]
        for batch in small_batches(batches):
            texts = [t or b"" for t in as_bytes(batch.column(1))]
            n, runs, kept = zip(*runs_of_texts(texts, min_words, min_repeats))
            rows = np.concatenate(runs)
            items = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], fields)
            ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), items),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["id", "n_words", "runs", "text"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, n_words long, "
                                  "runs array<struct<start:long,length:long,period:long>>, text string")
