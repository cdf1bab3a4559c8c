"""Token ids by forced-boundary splitting, with the merges of the ``tokenizers`` library.

A pair of adjacent bytes that occurs inside no vocabulary token can never end
up in one token, so a text may be cut between the two: every piece is encoded
on its own and the ids are concatenated. White space is in no token (checked
once per file), which makes the cuts between chunks; inside a chunk the
tokenizer's own normalizer and pre-tokenizer give the words, and forced pairs
cut the words further. (Between two ASCII bytes of which one is a letter and
the other none, or a digit, the words end as well, but for the apostrophe of
contractions: such forced pairs make chunks too.) Only the last piece of a word carries the end-of-word
suffix; the others are merged without it.

Equal chunks of a slice of text are found with array operations and encoded
once; chunks and pieces are memoised in two generations of bounded size (a
cache, results do not depend on it). Vocabularies without these properties are
encoded text by text by the library.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np

#: Chunks and bytes (with ENTRY_BYTES for a chunk's objects) that a memo generation
#: holds, and the longest chunk that is kept.
MEMO_CHUNKS = 500_000
MEMO_BYTES, ENTRY_BYTES = 96_000_000, 180
MEMO_CHUNK_BYTES = 256
#: Pieces in one call of the library.
CALL_PIECES = 5000
#: Text bytes that are handled at a time (some ten 8-byte arrays a byte); longer texts
#: are cut at white space and other edges of words.
SLICE_BYTES = 400_000
#: Bytes of text that a task holds beside the slice it works on.
BATCH_BYTES = 4_000_000
DEFAULT_TOKENIZER = "word_bpe_49k.json"
SPACE_BYTES = b" \t\n\x0b\f\r"
#: The pattern of the vocabulary file (fixed), and what it means for folded ASCII;
#: a line feed stands between chunks.
FIXED_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
ASCII_WORDS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+|\n")


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    """Place of a public vocabulary file; the package is installed on every node."""
    import public_tokenizers
    return public_tokenizers.path(name)


def load(path: str):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def byte_alphabet() -> list[str]:
    """Character that stands for each byte in a byte-level vocabulary: printable
    Latin-1 stands for itself, the others follow from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in printable else extra))
        extra += b not in printable
    return out


def pair_table(token_bytes: list[bytes]) -> np.ndarray:
    """forced[a, b]: the byte pair (a, b) is inside no token."""
    inside = np.zeros((256, 256), bool)
    for t in token_bytes:
        b = np.frombuffer(t, np.uint8)
        inside[b[:-1], b[1:]] = True
    return ~inside


def split_at(data: bytes, counts: np.ndarray, width: int) -> list[bytes]:
    """Consecutive slices of ``data`` with so many items of ``width`` bytes."""
    ends = (np.cumsum(counts) * width).tolist()
    return [data[i:j] for i, j in zip([0, *ends], ends)]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes start..start+length-1 of all ranges, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Memo:
    """key -> value, two generations: the old one is dropped when the new is full."""

    def __init__(self, fill):
        self.fill, self.new, self.old, self.size = fill, {}, {}, 0

    def values(self, keys: list[bytes]) -> list[bytes]:
        """The values of distinct keys."""
        found = list(map(self.new.get, keys))
        missing = [i for i, v in enumerate(found) if v is None]
        if not missing:
            return found
        wanted = [keys[i] for i in missing]
        known = list(map(self.old.get, wanted))
        unknown = [c for c, v in zip(wanted, known) if v is None]
        filled = iter(self.fill(unknown) if unknown else ())
        known = [next(filled) if v is None else v for v in known]
        for i, v in zip(missing, known):
            found[i] = v
        size = ENTRY_BYTES * len(wanted) + sum(map(len, wanted)) + sum(map(len, known))
        if len(self.new) + len(wanted) > MEMO_CHUNKS or self.size + size > MEMO_BYTES:
            self.old, self.new, self.size = self.new, {}, 0
        self.new.update(zip(wanted, known))
        self.size += size
        for c in unknown:
            if len(c) > MEMO_CHUNK_BYTES:
                del self.new[c]
        return found


class Encoder:
    """Ids of texts as little-endian unsigned integers of ``dtype``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        self.tok = load(path)
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 65536 else "<u4")
        self.added = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        spec = json.loads(self.tok.to_str())
        model = spec["model"]
        self.chunked = (model["type"] == "BPE" and not model.get("dropout") and not model.get("byte_fallback")
                        and not model.get("continuing_subword_prefix") and self._drops_space())
        if not self.chunked:
            return
        norm = self.tok.normalizer
        self.folds = norm is not None and norm.normalize_str("AZ") == "az"
        self.ascii_ok = self.folds and any(
            p.get("pattern", {}).get("Regex") == FIXED_PATTERN for p in spec["pre_tokenizer"].get("pretokenizers", []))
        suffix = model.get("end_of_word_suffix") or ""
        alphabet = byte_alphabet()
        self.chars = str.maketrans({chr(b): c for b, c in enumerate(alphabet)})
        self.back = str.maketrans({c: chr(b) for b, c in enumerate(alphabet)})
        special = {a.decode() for a in self.added}
        plain = [t.removesuffix(suffix) if suffix else t for t in model["vocab"] if t not in special]
        self.forced = pair_table([t.translate(self.back).encode("latin-1", "ignore") for t in plain])
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # The same merges for pieces that end inside a word and at its end.
        self.inner = Tokenizer(BPE(vocab=model["vocab"], merges=merges))
        self.final = Tokenizer(BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=suffix or None))
        self.chunk_memo = Memo(self.encode_chunks)
        self.space = np.zeros(256, bool)
        self.space[list(SPACE_BYTES)] = True
        # Kind of a byte: 0 not ASCII or apostrophe, 1 letter, 2 digit, 3 other; words end
        # between two kinds, and around every digit.
        kind = np.array([0 if b > 127 or b == 39 else 1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 3
                         for b in range(256)])
        a, b = kind[:, None], kind[None, :]
        self.word_edge = self.forced & (a > 0) & (b > 0) & ((a != b) | (a == 2)) & self.ascii_ok
        # Powers of an odd number and of its inverse modulo 2^64, for hashes of byte ranges.
        self.odd = np.uint64(0x9E3779B97F4A7C15)
        self.inverse = np.uint64(pow(int(self.odd), -1, 2 ** 64))
        self.powers = np.zeros((2, 0), np.uint64)

    def _drops_space(self) -> bool:
        def ids(text):
            return self.tok.encode(text, add_special_tokens=False).ids

        if any(a.split() != [a] for a in self.added):
            return False
        both = ids("Ab,") + ids("cd")
        return all(ids(w) == [] and ids(f"Ab,{w}cd") == both for w in SPACE_BYTES.decode())

    # Pieces and chunks ------------------------------------------------------

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Pieces tagged with a last byte, 1 at a word's end, else 0: thousands in one
        call, as word_ids names the piece of each id."""
        out = [b""] * len(pieces)
        for tag, model in ((0, self.inner), (1, self.final)):
            own = [i for i, p in enumerate(pieces) if p[-1] == tag]
            for k in range(0, len(own), CALL_PIECES):
                part = own[k:k + CALL_PIECES]
                e = model.encode([pieces[i][:-1].decode("latin-1").translate(self.chars) for i in part],
                                 is_pretokenized=True, add_special_tokens=False)
                counts = np.bincount(np.array(e.word_ids, np.int64), minlength=len(part))
                for i, ids in zip(part, split_at(np.array(e.ids, self.dtype).tobytes(), counts, self.dtype.itemsize)):
                    out[i] = ids
        return out

    def ascii_words(self, chunks: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """(words, words per chunk) of chunks that are all ASCII."""
        if all(map(bytes.isalpha, chunks)):
            return chunks, np.ones(len(chunks), np.int64)
        found = ASCII_WORDS.findall(b"\n".join(chunks).lower() + b"\n")
        ends = np.fromiter((w == b"\n" for w in found), bool, len(found)).nonzero()[0]
        return [w for w in found if w != b"\n"], np.diff(ends, prepend=-1) - 1

    def library_words(self, texts: list[str]) -> tuple[list[bytes], np.ndarray]:
        """(words, words per text) by the library's normalizer and pre-tokenizer: one
        call for all texts, joined by spaces, unless a text has inner white space."""
        norm = self.tok.normalizer.normalize_str if self.tok.normalizer is not None else str
        whole = norm(" ".join(texts))
        parts = whole.split(" ")
        if len(parts) != len(texts):
            each = [self.tok.pre_tokenizer.pre_tokenize_str(norm(t)) for t in texts]
            words, counts = [w for own in each for w, _ in own], np.array(list(map(len, each)), np.int64)
        else:
            found = self.tok.pre_tokenizer.pre_tokenize_str(whole)
            ends = np.cumsum([len(p) + 1 for p in parts])
            owner = np.searchsorted(ends, [at for _, (at, _) in found], side="right")
            words, counts = [w for w, _ in found], np.bincount(owner, minlength=len(texts))
        return [w.translate(self.back).encode("latin-1") for w in words], counts

    def cut(self, words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """(tagged pieces, pieces per word)."""
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(list(map(len, words)), dtype=np.int64)
        at = np.flatnonzero(self.forced[data[:-1], data[1:]]) + 1
        at = at[ends[np.searchsorted(ends, at)] != at] if len(at) else at  # ends of words are cuts anyway
        owner = np.searchsorted(ends, at, side="right")
        counts = 1 + np.bincount(owner, minlength=len(words))
        pieces = [w + b"\1" for w in words]
        if len(at):
            at_of = np.split(at, np.flatnonzero(np.diff(owner)) + 1)
            inside: dict[int, list[bytes]] = {}
            for k, own in zip(np.unique(owner).tolist(), at_of):
                w, first = words[k], int(ends[k]) - len(words[k])
                stops = [*(own - first).tolist(), len(w)]
                parts = [w[i:j] for i, j in zip([0, *stops], stops)]
                inside[k] = [p + b"\0" for p in parts[:-1]] + [parts[-1] + b"\1"]
            pieces = [p for k, whole in enumerate(pieces) for p in inside.get(k, (whole,))]
        return pieces, counts

    def encode_words(self, words: list[bytes], per_chunk: np.ndarray) -> list[bytes]:
        """Ids of chunks given their words."""
        if not words:
            return [b""] * len(per_chunk)
        pieces, counts = self.cut(words)
        values = self.encode_pieces(pieces)
        sizes = np.concatenate([[0], np.cumsum(list(map(len, values)))])
        pieces_end = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(per_chunk)])]
        ends = sizes[pieces_end].tolist()
        data = b"".join(values)
        return [data[i:j] for i, j in zip(ends, ends[1:])]

    def encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        out = [b""] * len(chunks)
        plain, wide = [], []
        for i, c in enumerate(chunks):
            (plain if self.ascii_ok and c.isascii() else wide).append(i)
        for own, split in ((plain, lambda: self.ascii_words([chunks[i] for i in plain])),
                           (wide, lambda: self.library_words([chunks[i].decode("utf-8", "replace") for i in wide]))):
            if own:
                for i, ids in zip(own, self.encode_words(*split())):
                    out[i] = ids
        return out

    # Texts ------------------------------------------------------------------

    def _distinct(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, inverse) of the distinct byte ranges. Ranges are told apart by a
        64-bit hash, and every range is compared with the first of its hash."""
        n = len(data)
        if self.powers.shape[1] < n + 1:
            up = np.full(n + 1, self.odd)
            down = np.full(n + 1, self.inverse)
            up[0] = down[0] = 1
            self.powers = np.stack([np.cumprod(up), np.cumprod(down)])
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[0][:n], out=sums[1:])
        h = (sums[starts + lengths] - sums[starts]) * self.powers[1][starts]
        h = (h ^ (h >> np.uint64(29))) * self.odd
        _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        twin = first[inverse]
        at = ranges(starts, lengths)
        if (lengths != lengths[twin]).any() or (data[at] != data[at + np.repeat(starts[twin] - starts, lengths)]).any():
            # Two texts with one hash: every range stands for itself.
            first = inverse = np.arange(len(starts))
        return first, inverse

    def _encode_slice(self, texts: list[bytes]) -> list[np.ndarray]:
        joined = b"\n".join(texts) + b"\n"
        if self.folds:
            joined = joined.lower()
        data = np.frombuffer(joined, np.uint8)
        blank = self.space[data]
        # Chunks start and end where white space does (the last byte is white space), and at word edges.
        turn = np.diff(blank, prepend=True)
        edge = turn.copy()
        edge[1:] |= self.word_edge[data[:-1], data[1:]]
        starts = np.flatnonzero(edge & ~blank)
        ends = np.flatnonzero(edge[1:] & ~blank[:-1]) + 1
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        chunk_ends = np.searchsorted(starts, text_ends)
        if not len(starts):
            return [np.zeros(0, self.dtype)] * len(texts)
        first, inverse = self._distinct(data, starts, ends - starts)
        values = self.chunk_memo.values([joined[i:j] for i, j in zip(starts[first].tolist(), ends[first].tolist())])
        ids = np.frombuffer(b"".join(values), self.dtype)
        n = np.fromiter(map(len, values), np.int64, len(values)) // self.dtype.itemsize
        own = n[inverse]
        stream = ids[ranges((np.cumsum(n) - n)[inverse], own)]
        stops = np.concatenate([[0], np.cumsum(own)])[chunk_ends].tolist()
        return [stream[i:j] for i, j in zip([0, *stops], stops)]

    def _edge_near(self, text: bytes, at: int) -> int:
        """The last edge of a word in the slice from ``at``; the next one after it if there is none."""
        while at < len(text):
            # Two bytes stand on both sides of an edge, so windows overlap by one.
            window = np.frombuffer(text[at:at + SLICE_BYTES + 1].lower() if self.folds else text[at:at + SLICE_BYTES + 1], np.uint8)
            if at + len(window) == len(text):
                return len(text)
            found = np.flatnonzero(self.space[window[1:]] | self.word_edge[window[:-1], window[1:]])
            if len(found):
                return at + int(found[-1]) + 1
            at += SLICE_BYTES
        return len(text)

    def _long(self, text: bytes) -> np.ndarray:
        parts, at = [], 0
        while at < len(text):
            end = self._edge_near(text, at)
            parts.append(self._encode_slice([text[at:end]])[0])
            at = end
        return np.concatenate(parts)

    def _by_library(self, text: bytes) -> np.ndarray:
        return np.array(self.tok.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, self.dtype)

    def _groups(self, texts: list[bytes]) -> Iterator[list[bytes]]:
        group, size = [], 0
        for t in texts:
            if group and size + len(t) > SLICE_BYTES:
                yield group
                group, size = [], 0
            group.append(t)
            size += len(t)
        if group:
            yield group

    def encode(self, texts: list[bytes | None]) -> Iterator[np.ndarray]:
        """Ids of each text; null is empty."""
        for group in self._groups([t or b"" for t in texts]):
            # Added tokens are found in the raw text, before any cut: the library takes such texts.
            alone = {i: self._by_library(t) for i, t in enumerate(group)
                     if not self.chunked or any(a in t for a in self.added)}
            alone |= {i: self._long(t) for i, t in enumerate(group) if i not in alone and len(t) > SLICE_BYTES}
            rest = iter(self._encode_slice([t for i, t in enumerate(group) if i not in alone])
                        if len(alone) < len(group) else ())
            for i in range(len(group)):
                yield alone[i] if i in alone else next(rest)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def small_batches(batches: Iterator, rows: int = 1000) -> Iterator:
    """The record batches in parts of at most so many rows and BATCH_BYTES of strings and
    binaries (a longer row is a part alone), to bound what a task holds."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def wide(kind):
        return (pa.types.is_string(kind) or pa.types.is_large_string(kind)
                or pa.types.is_binary(kind) or pa.types.is_large_binary(kind))

    for batch in batches:
        size = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if wide(column.type):
                size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        first, held = 0, 0
        for i, n in enumerate(size.tolist()):
            if i > first and (i - first >= rows or held + n > BATCH_BYTES):
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += n
        if first < batch.num_rows:
            yield batch.slice(first)


def as_bytes(column) -> list[bytes | None]:
    """Texts of an Arrow string column as UTF-8 bytes."""
    import pyarrow as pa
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()
