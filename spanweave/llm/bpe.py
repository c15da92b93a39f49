"""Byte-level BPE: encoding by forced boundaries, and decoding.

Two neighbouring bytes that stand side by side inside no token of the vocabulary can never be merged,
so a token always ends between them. Texts are cut there, the fragments are encoded independently
and their ids joined. Nearly all fragments are words, so a worker meets most of them again and keeps
their ids.

The vocabulary alone says that merges do not cross a cut; the tokenizer's splitting pattern must not
see across it either. Of the certain cuts those are used whose second byte is an ASCII space, or whose
bytes are both ASCII and not of two kinds that the pattern could join: a cut never follows a
space (the pattern looks from a run of spaces at what comes after) and never parts an apostrophe
from other punctuation before it.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from spanweave.llm.textbatch import (
    SPACE_TABLE,
    binary_array,
    gather_spans,
    list_array,
    slices,
    text_buffer,
)

#: Bytes of text that a worker encodes at once, and fragments whose ids it keeps.
BATCH_BYTES = 1 << 20
KEPT_FRAGMENTS = 200_000


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in byte-level vocabularies, by their public rule."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def token_bytes(path: str) -> list[bytes]:
    """The bytes of every token id; an added token stands for its own text."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    to_byte = byte_alphabet()
    table = {i: bytes(map(to_byte.__getitem__, t)) for t, i in spec["model"]["vocab"].items()}
    table |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    return [table.get(i, b"") for i in range(max(table) + 1)]


def certain_cuts(tokens: Sequence[bytes]) -> np.ndarray:
    """256 x 256 table: True where a cut between the two bytes is certain and safe, see above."""
    never = np.ones((256, 256), bool)
    for token in tokens:
        pair = np.frombuffer(token, np.uint8)
        never[pair[:-1], pair[1:]] = False
    byte = np.arange(256)
    ascii_ = byte < 128
    alnum = np.array([b < 128 and chr(b).isalnum() for b in byte])
    both = (ascii_ & ~SPACE_TABLE)[:, None] & ascii_[None, :]
    apostrophe = np.zeros((256, 256), bool)
    apostrophe[:, ord("'")] = ~alnum
    after_space = SPACE_TABLE[:, None]
    return never & ~after_space & (SPACE_TABLE[None, :] | (both & ~apostrophe))


class FragmentEncoder:
    """Ids of text fragments by the tokenizers library, remembering a bounded number of them."""

    def __init__(self, path: str, kept: int = KEPT_FRAGMENTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kept = kept
        with open(path, encoding="utf-8") as file:
            added = [t for t in json.load(file)["added_tokens"] if t["special"] and not t["normalized"]]
        # Such a token is found before anything else, so what stands on its two sides is independent.
        plain = [t for t in added if not (t["lstrip"] or t["rstrip"] or t["single_word"])]
        self.mark = plain[0]["content"].encode() if plain else b""
        self.mark_id = plain[0]["id"] if plain else -1
        self._forget()

    def _forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.starts = self.lengths = np.zeros(0, np.int64)

    def _learn(self, new: list[bytes], together: bool) -> None:
        """Encode fragments; ``together`` as one text in which the special token keeps them apart."""
        if not new:
            return
        if together and self.mark:
            joined = self.tokenizer.encode_batch_fast([self.mark.join(new).decode()], add_special_tokens=False)[0]
            ids = np.array(joined.ids, np.int32)
            split = ids == self.mark_id
            ends = np.concatenate([[-1], np.flatnonzero(split), [len(ids)]])
            lengths, fresh = np.diff(ends) - 1, ids[~split]
        else:
            parts = [self.tokenizer.encode(f.decode(), add_special_tokens=False).ids for f in new]
            lengths = np.fromiter(map(len, parts), np.int64, len(parts))
            fresh = np.concatenate([np.array(p, np.int32) for p in parts])
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, fresh])

    def encode(self, fragments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and how many each fragment has. ``fragments``: binary, no nulls."""
        if len(self.index) > self.kept:
            self._forget()
        coded = fragments.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [f for f in distinct if f not in self.index]
        self._learn([f for f in new if self.mark and self.mark in f], together=False)
        self._learn([f for f in new if not (self.mark and self.mark in f)], together=True)
        known = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))
        at = known[coded.indices.to_numpy()]
        lengths = self.lengths[at]
        return gather_spans(self.flat, self.starts[at], lengths), lengths


class ForcedBoundaryCodec:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        self.tokens = token_bytes(path)
        self.token_lengths = np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_flat = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.cuts = certain_cuts(self.tokens).ravel()
        self.encoder = FragmentEncoder(path)

    def encode(self, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents end to end and n + 1 offsets into them."""
        flat = np.frombuffer(raw, np.uint8)
        begins = np.zeros(len(flat) + 1, bool)
        if len(flat):
            begins[1:-1] = self.cuts.take((flat[:-1].astype(np.uint16) << 8) | flat[1:])
        begins[offsets] = True
        bounds = np.flatnonzero(begins)
        ids, lengths = self.encoder.encode(binary_array(raw, bounds))
        before = np.concatenate([[0], np.cumsum(lengths)])
        return ids, before[np.searchsorted(bounds, offsets)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of the documents; bytes that are no UTF-8 become U+FFFD."""
        lengths = self.token_lengths[ids]
        raw = gather_spans(self.token_flat, self.token_starts[ids], lengths).tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[offsets].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]


@lru_cache(maxsize=2)
def codec(path: str) -> ForcedBoundaryCodec:
    """One per worker process."""
    return ForcedBoundaryCodec(path)


def encode_and_decode(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """Add the token ids of every whole text, and the text that these ids decode to.

    Ids equal those of the tokenizers library without special tokens added (the strings of special
    tokens inside a text become their ids), without truncation or padding. The work is per row: no
    shuffle, and memory bounded by ``BATCH_BYTES`` or the longest text. A null or empty text has no
    ids and decodes to the empty string. Other columns pass through; one that is called like a new
    column is replaced.
    """
    kept = [f for f in df.schema.fields if f.name not in (ids, decoded)]
    schema = T.StructType(
        kept
        + [
            T.StructField(ids, T.ArrayType(T.IntegerType(), False), False),
            T.StructField(decoded, T.StringType(), False),
        ]
    )
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in slices(batch, text, BATCH_BYTES):
                raw, offsets = text_buffer(part.column(text))
                got, at = own.encode(raw, offsets)
                columns = [part.column(n) for n in names]
                columns += [list_array(got, at, pa.int32()), pa.array(own.decode(got, at), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*names, ids, decoded])

    return df.select(*[f.name for f in kept]).mapInArrow(run, schema)
