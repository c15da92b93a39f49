"""SentencePiece encoding of merge-type (BPE) models by backtracking, and decoding.

Merging the best pair again and again leaves the one sequence of pieces in which every two neighbours
are compatible, that is, merging the characters of both ends in just these two. So the text is walked
from the left: take the longest piece that matches (all matches come from one pass of an Aho-Corasick
automaton), step back to shorter ones while it is incompatible with the piece before, and where none
is left, mark the position as failed, give up the piece before and try its shorter matches. No position
is tried again once it failed, so the work is linear in the text.

Two neighbouring characters that stand side by side inside no piece are never merged. Texts fall
apart there, mostly into words, and a worker remembers the ids of the fragments it meets.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from spanweave.llm.textbatch import binary_array, gather_spans, slices

#: Bytes of text that a worker encodes at once.
BATCH_BYTES = 1 << 22
#: Fragments and pairs of pieces that a worker remembers in each of two generations.
KEPT_FRAGMENTS, KEPT_PAIRS = 200_000, 300_000
#: Characters whose matches are held at once while a fragment is walked.
WINDOW = 4096
#: The mark that stands for a space, a fixed value of the library.
SPACE = "▁"


class Remembered(dict):
    """A dictionary that forgets what was not asked for lately: two generations of ``size`` entries."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.old = size, {}

    def __missing__(self, key):
        value = self.old[key]  # KeyError: unknown
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value


class Vocabulary:
    """Pieces and scores of a model file, what merging two pieces gives, and the automaton."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        self.library = sp = SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        reserved = {i for i in ids if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
        self.ids = {sp.id_to_piece(i): i for i in ids if i not in reserved}
        # Higher scores merge first.
        self.rank = {piece: -sp.get_score(i) for piece, i in self.ids.items()}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(sp.is_byte(i) for i in self.byte_ids):
            raise ValueError("the model has no pieces for single bytes")
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        self.longest = max(map(len, self.ids))
        self._check_scores()
        # The next shorter match at the place of a longer one; a single character always matches.
        self.shorter = {p: next(n for n in range(len(p) - 1, 0, -1) if n == 1 or p[:n] in self.ids) for p in self.ids if len(p) > 1}
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            if len(piece) > 1:
                self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.pairs = Remembered(KEPT_PAIRS)

    def _check_scores(self) -> None:
        """Pairs decide alone where scores differ, or where equal ones are runs of one character only."""
        by_rank: dict[float, list[str]] = {}
        for piece, rank in self.rank.items():
            if len(piece) > 1:
                by_rank.setdefault(rank, []).append(piece)
        for pieces in by_rank.values():
            runs = {c for piece in pieces for c in piece}
            if len(pieces) > 1 and (len(runs) > 1 or any(2 * c in p for c in runs for p in self.ids if set(p) != runs)):
                raise ValueError("pieces of equal score that are no runs of one character: order of merges undefined")

    def merge(self, symbols: list[str]) -> list[str]:
        """Merge by score, the leftmost of equal ones first. For a few symbols."""
        symbols = list(symbols)
        while len(symbols) > 1:
            best = min((self.rank.get(a + b, np.inf), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])))
            if best[0] == np.inf:
                break
            i = best[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the characters of both again gives these two; ``left`` may be empty."""
        key = (left, right)
        try:
            return self.pairs[key]
        except KeyError:
            found = self.merge(list(left + right)) == ([left, right] if left else [right])
            self.pairs.keep(key, found)
            return found


class LongestMatches:
    """How long the longest piece is that starts at a position; found window by window."""

    def __init__(self, vocabulary: Vocabulary, text: str):
        self.vocabulary, self.text, self.windows = vocabulary, text, {}

    def __getitem__(self, position: int) -> int:
        number, offset = divmod(position, WINDOW)
        if number not in self.windows:
            if len(self.windows) > 1:  # backtracking stays within a few pieces
                self.windows.pop(max(self.windows, key=lambda n: abs(n - number)))
            begin = number * WINDOW
            part = self.text[begin : begin + WINDOW + self.vocabulary.longest - 1]
            self.windows[number] = longest_matches(self.vocabulary, part)
        return self.windows[number][offset]


def longest_matches(vocabulary: Vocabulary, text: str) -> list[int]:
    found = [1] * len(text)
    for end, length in vocabulary.automaton.iter(text):  # ends ascend, so a longer match comes later
        found[end - length + 1] = length
    return found


def encode_fragment(vocabulary: Vocabulary, text: str) -> list[str]:
    """The pieces of a normalised text; a character without a piece is a piece of its own."""
    n, pairs, shorter = len(text), vocabulary.pairs, vocabulary.shorter
    longest = longest_matches(vocabulary, text) if n <= WINDOW else LongestMatches(vocabulary, text)
    failed = bytearray(n + 1)
    pieces: list[str] = []
    position, length, before = 0, longest[0], ""
    while True:
        piece, end = text[position : position + length], position + length
        if not failed[end]:
            fits = pairs.get((before, piece))
            if fits or fits is None and vocabulary.compatible(before, piece):
                pieces.append(piece)
                if end == n:
                    return pieces
                position, length, before = end, longest[end], piece
                continue
        while length == 1:  # nothing shorter here: the piece before is given up as well
            failed[position] = 1
            piece = pieces.pop()
            length = len(piece)
            position -= length
        before = pieces[-1] if pieces else ""
        length = shorter[piece]


def char_cuts(pieces) -> np.ndarray:
    """128 x 128 table over ASCII, with the space mark in the place of the space: True where two
    characters stand side by side inside no piece."""
    never = np.ones((128, 128), bool)
    for piece in pieces:
        codes = [32 if c == SPACE else ord(c) for c in piece]
        for a, b in zip(codes, codes[1:]):
            if a < 128 and b < 128:
                never[a, b] = False
    return never


class BacktrackingCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.cuts = char_cuts(self.vocabulary.ids).ravel()
        self.known = Remembered(KEPT_FRAGMENTS)

    def ids_of(self, piece: str) -> list[int]:
        """A piece without an id is one character and becomes its bytes."""
        found = self.vocabulary.ids.get(piece)
        return [found] if found is not None else [self.vocabulary.byte_ids[b] for b in piece.encode()]

    def fragment(self, raw: bytes) -> bytes:
        """The ids of a fragment (in UTF-32), 32 bits each."""
        try:
            return self.known[raw]
        except KeyError:
            pieces = encode_fragment(self.vocabulary, raw.decode("utf-32-le"))
            try:
                ids = [self.vocabulary.ids[piece] for piece in pieces]
            except KeyError:
                ids = [i for piece in pieces for i in self.ids_of(piece)]
            found = array("i", ids).tobytes()
            self.known.keep(raw, found)
            return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, with begin and end ids, and n + 1 offsets into them."""
        normal = [self.vocabulary.library.normalize(t) for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in normal], dtype=np.int64)])
        raw = "".join(normal).encode("utf-32-le")
        codes = np.frombuffer(raw, "<u4")
        ascii_ = np.where(codes == ord(SPACE), 32, np.minimum(codes, 128)).astype(np.int64)
        begins = np.zeros(len(codes) + 1, bool)
        if len(codes):
            a, b = ascii_[:-1], ascii_[1:]
            plain = (a < 128) & (b < 128)
            begins[1:-1][plain] = self.cuts[(a[plain] << 7) | b[plain]]
        begins[offsets] = True
        bounds = np.flatnonzero(begins)
        if len(bounds) > 1:
            coded = binary_array(raw, bounds * 4).dictionary_encode()
            parts = [self.fragment(f) for f in coded.dictionary.to_pylist()]
            sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
            at = coded.indices.to_numpy()
            lengths = sizes[at]
            flat = gather_spans(np.frombuffer(b"".join(parts), np.int32), (np.cumsum(sizes) - sizes)[at], lengths)
        else:
            flat, lengths = np.zeros(0, np.int32), np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(bounds, offsets)]
        marks = np.stack([ends[:-1], ends[1:]], 1).ravel()
        flat = np.insert(flat, marks, [self.vocabulary.bos, self.vocabulary.eos] * len(texts))
        return flat, ends + 2 * np.arange(len(ends))

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        return [self.vocabulary.library.decode(ids[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:])]


@lru_cache(maxsize=1)
def codec(path: str) -> BacktrackingCodec:
    """One per worker process."""
    return BacktrackingCodec(path)


def encode_and_decode(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """Add the token ids of every whole text, and the text that these ids decode to.

    ``ids`` is binary: little-endian unsigned 32-bit integers, with the begin and the end id, equal to the
    sentencepiece library's without sampling. Characters without a piece become their bytes. The work
    is per row: no shuffle, and memory bounded by ``BATCH_BYTES`` or the longest text. A null or empty
    text is the begin and end id and decodes to the empty string. Repeated rows are each encoded, other
    columns pass through; one that is called like a new column is replaced. An empty table gives no rows.
    """
    kept = [f for f in df.schema.fields if f.name not in (ids, decoded)]
    schema = T.StructType(kept + [T.StructField(ids, T.BinaryType(), False), T.StructField(decoded, T.StringType(), False)])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in slices(batch, text, BATCH_BYTES):
                flat, offsets = own.encode([t or "" for t in part.column(text).to_pylist()])
                packed = binary_array(flat.astype("<u4").tobytes(), offsets * 4).cast(pa.binary())
                columns = [part.column(n) for n in names] + [packed, pa.array(own.decode(flat, offsets), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*names, ids, decoded])

    return df.select(*[f.name for f in kept]).mapInArrow(run, schema)
