"""BPE encoding and decoding of whole documents.

Encoding is forced-boundary splitting (see ``tokens``). Decoding reads the ids
back: a vocabulary without a decoder gives its tokens joined by a space, which
is a gather from one table of token texts; others are decoded by the library.

Defined results: null and empty texts have no ids and decode to an empty text;
rows are independent, so repeated ids, ties and extra columns change nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.tokens import encoder, ranges

#: Ids that are decoded at a time.
DECODE_IDS = 1_000_000


class Decoder:
    """Texts of id sequences, as the library's decode(ids, skip_special_tokens=False)."""

    def __init__(self, tok):
        self.tok, self.joined = tok, tok.decoder is None
        vocab = tok.get_vocab(with_added_tokens=True)
        size = 1 + max(vocab.values())
        token = [b""] * size
        for t, i in vocab.items():
            token[i] = t.encode() + b" "
        self.length = np.array(list(map(len, token)), np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.text = np.frombuffer(b"".join(token), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        if not self.joined:
            return self.tok.decode(ids.tolist(), skip_special_tokens=False).encode()
        parts = [self.text[ranges(self.start[own], self.length[own])].tobytes()
                 for own in (ids[i:i + DECODE_IDS] for i in range(0, len(ids), DECODE_IDS))]
        return b"".join(parts)[:-1]


_DECODERS: dict[str, Decoder] = {}


def decoder(path: str) -> Decoder:
    if path not in _DECODERS:
        _DECODERS[path] = Decoder(encoder(path).tok)
    return _DECODERS[path]


def _per_document(docs: DataFrame, id_col: str, text_col: str, path: str, columns: str, build) -> DataFrame:
    """(id, *columns): ``build(ids, text)`` gives the Arrow arrays of a batch."""
    def run(batches):
        import pyarrow as pa

        from panelcast.llm.bpe_roundtrip import decoder
        from panelcast.llm.tokens import as_bytes, encoder, small_batches
        enc, dec = encoder(path), decoder(path)
        for batch in small_batches(batches):
            rows = [build(ids, dec.decode(ids)) for ids in enc.encode(as_bytes(batch.column(1)))]
            arrays = [pa.array(c, kind) for c, kind in zip(zip(*rows) if rows else ((),) * len(names), kinds(pa))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["id", *names])

    names = [c.split(" ")[0] for c in columns.split(", ")]

    def kinds(pa):
        known = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
        return [known[c.split(" ")[1]] for c in columns.split(", ")]

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, {columns}")


def encode_column(docs: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """(id, n_tokens, ids, decoded) of every document."""
    return _per_document(docs, id_col, text_col, path, "n_tokens long, ids array<int>, decoded string",
                         lambda ids, text: (len(ids), ids.astype("int32"), text.decode()))


def digest_column(docs: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every document: SHA-256 of the
    ids as little-endian unsigned 32-bit integers and of the decoded text."""
    return _per_document(docs, id_col, text_col, path, "n_tokens long, ids_sha256 string, decoded_sha256 string",
                         lambda ids, text: (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                                            hashlib.sha256(text).hexdigest()))
