"""Byte-level BPE: encode texts by the ranks of a public vocabulary, and decode ids to bytes.

A pre-token is looked up in two tiers. A minimal perfect hash over the vocabulary resolves those that
are one token, for all distinct pre-tokens of a slice at once. The others are merged byte by byte: a
heap holds the adjacent pairs by rank, and linked neighbours make each merge a constant amount of work.

Pre-tokens are found on arrays of code points, by the run rules of the published split pattern:

    's|'t|'re|'ve|'m|'ll|'d| ?letters+| ?numbers+| ?others+|white+(?!non-white)|white+

Edge cases: a null or empty text has no ids and decodes to no bytes; texts of any length are encoded
whole; a pre-token may be as long as the text; equal rows give equal results, one each; other columns of
the input are ignored by ``encode`` and ``round_trip``.
"""

from __future__ import annotations

import base64
import unicodedata
from array import array
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loanmeter.llm.arrow_text import flat, gather_spans, mapped, prefix_hash, span_hash
from loanmeter.llm.perfect_hash import PerfectHash

SLICE = 2 << 20
CACHED = 1_000_000
"""Merged pre-tokens a task remembers at most; it forgets all and starts anew beyond."""

LETTER, NUMBER, WHITE, OTHER = range(4)
# Code points with the property White_Space.
WHITE_POINTS = (*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
# Endings that are split off behind an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by id. Lines are ``base64-token rank``."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


@dataclass
class Vocabulary:
    """The vocabulary as flat arrays with its perfect hash. Its size is that of the rank file."""

    blob: np.ndarray
    ends: np.ndarray
    number: PerfectHash
    id_of: np.ndarray
    key_of: np.ndarray
    _merges: dict[int, int] = field(default_factory=dict)
    _bytes: list[int] = field(default_factory=list)
    _first: list[int] = field(default_factory=list)

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        blob = np.frombuffer(b"".join(tokens), np.uint8)
        ends = np.cumsum([len(t) for t in tokens])
        keys = span_hash(prefix_hash(blob), np.r_[0, ends[:-1]], ends)
        number = PerfectHash.build(keys)
        place = number(keys)
        id_of, key_of = np.zeros(len(tokens), np.int32), np.zeros(len(tokens), np.uint64)
        id_of[place], key_of[place] = np.arange(len(tokens)), keys
        return cls(blob, ends, number, id_of, key_of)

    def whole(self, keys: np.ndarray) -> np.ndarray:
        """Ids of pre-tokens by their hash; -1 for those that are not a token."""
        place = self.number(keys)
        return np.where(self.key_of[place] == keys, self.id_of[place], np.int32(-1))

    def merged(self, piece: bytes) -> list[int]:
        """Merge the adjacent pair of lowest rank, leftmost first, until no pair is a token."""
        if not self._merges:
            self._load_merges()
        get, first, single = self._merges.get, self._first, self._bytes
        pair = [first[a << 8 | b] for a, b in zip(piece, piece[1:], strict=False)]
        heap = [rank << 32 | i for i, rank in enumerate(pair) if rank >= 0]
        heapify(heap)
        n = len(piece)
        # One place more at the end: no neighbour, reached from both sides.
        ids = [single[b] for b in piece]
        ids.append(-1)
        pair += (-1, -1)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        while heap:
            entry = heappop(heap)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            if pair[i] != rank:
                continue  # one of the two was merged meanwhile
            j = after[i]
            k = after[i] = after[j]
            before[k] = i
            ids[i], ids[j] = rank, -1
            pair[j] = -1
            follow = pair[i] = get(rank << 32 | ids[k], -1)
            if follow >= 0:
                heappush(heap, follow << 32 | i)
            h = before[i]
            lead = pair[h] = get(ids[h] << 32 | rank, -1)
            if lead >= 0:
                heappush(heap, lead << 32 | h)
        return [x for x in ids if x >= 0]

    def bytes_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of a sequence of ids, and the length of each id's token."""
        starts = np.r_[0, self.ends[:-1]]
        lengths = (self.ends - starts)[ids]
        return self.blob[gather_spans(starts[ids], lengths)], lengths

    def _load_merges(self) -> None:
        blob, start, ids = self.blob.tobytes(), 0, {}
        for i, end in enumerate(self.ends.tolist()):
            ids[blob[start:end]] = i
            start = end
        for token, rank in ids.items():
            for cut in range(1, len(token)):
                left, right = ids.get(token[:cut]), ids.get(token[cut:])
                if left is not None and right is not None:
                    self._merges[left << 32 | right] = rank
        self._bytes = [ids[bytes([b])] for b in range(256)]
        self._first = [ids.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]

    def __getstate__(self):
        return {**self.__dict__, "_merges": {}, "_bytes": [], "_first": []}


_classes: list[np.ndarray] = []


def _class_table() -> np.ndarray:
    if not _classes:
        kind = {"L": LETTER, "N": NUMBER}
        table = np.array([kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
        table[list(WHITE_POINTS)] = WHITE
        _classes.append(table)
    return _classes[0]


def pre_tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pre-tokens of all texts start, in bytes, and the number of them in each text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    byte_of = np.flatnonzero((data & 0xC0) != 0x80)
    kind = _class_table()[points]
    first = np.zeros(len(points) + 1, bool)
    first[np.searchsorted(byte_of, offsets)] = True
    new_text = first[:-1]

    start = np.r_[True, kind[1:] != kind[:-1]] | new_text
    # The last white before a word stands alone, or joins the word when it is a blank.
    words = np.flatnonzero(start & (kind != WHITE) & ~new_text)
    words = words[kind[words - 1] == WHITE]
    start[words - 1] = True
    start[words] = points[words - 1] != 0x20
    # An apostrophe that begins a pre-token takes one of the endings.
    quote = np.flatnonzero(start & (points == 0x27))
    padded = np.r_[points, np.zeros(2, np.uint32)]
    text_end = np.r_[first, True, True]
    second, third = padded[quote + 1], padded[quote + 2]
    length = np.zeros(len(quote), np.int64)
    for ending in ENDINGS:
        fits = ~text_end[quote + 1] & (second == ord(ending[0]))
        if len(ending) == 2:
            fits &= ~text_end[quote + 2] & (third == ord(ending[1]))
        length[fits] = len(ending)
    quote, length = quote[length > 0], length[length > 0]
    start[quote + 1] = False
    behind = quote + 1 + length
    start[behind[behind < len(points)]] = True

    at = byte_of[np.flatnonzero(start)]
    return at, np.diff(np.searchsorted(at, offsets))


class Encoder:
    """Encodes slices; remembers merged pre-tokens from one slice to the next."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._known: dict[int, bytes] = {}

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's ids start and end."""
        starts, count = pre_tokens(data, offsets)
        ends = np.r_[starts[1:], len(data)][: len(starts)]
        keys, first, which = np.unique(
            span_hash(prefix_hash(data), starts, ends), return_index=True, return_inverse=True
        )
        whole = self.vocabulary.whole(keys)
        lengths = np.ones(len(keys), np.int64)
        missing = np.flatnonzero(whole < 0)
        pieces, known = [], self._known
        if len(known) > CACHED:
            known.clear()
        blob = data.tobytes()
        at, to = starts[first[missing]].tolist(), ends[first[missing]].tolist()
        for key, s, e in zip(keys[missing].tolist(), at, to, strict=True):
            ids = known.get(key)
            if ids is None:
                ids = known[key] = array("i", self.vocabulary.merged(blob[s:e])).tobytes()
            pieces.append(ids)
        lengths[missing] = np.array([len(x) for x in pieces], np.int64) // 4
        all_ids = np.empty(lengths.sum(), np.int32)
        begin = np.cumsum(lengths) - lengths
        all_ids[begin[whole >= 0]] = whole[whole >= 0]
        all_ids[gather_spans(begin[missing], lengths[missing])] = np.frombuffer(b"".join(pieces), np.int32)

        ids = all_ids[gather_spans(begin[which], lengths[which])]
        before = np.r_[0, np.cumsum(lengths[which])]
        return ids, before[np.r_[0, np.cumsum(count)]]


def encode(docs: DataFrame, tokens: list[bytes]) -> DataFrame:
    """``doc_id, ids``: the ids of every whole text."""
    encoder = Encoder(Vocabulary.of(tokens))

    def kernel(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, bounds = encoder(*flat(part.column("text")))
        return pa.record_batch([part.column("doc_id"), _lists(ids, bounds)], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(mapped(kernel, most=SLICE), "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, tokens: list[bytes]) -> DataFrame:
    """``doc_id, decoded``: the bytes of ``ids``."""
    vocabulary = Vocabulary.of(tokens)

    def run(batches):
        for batch in batches:
            lists = batch.column("ids")
            counts = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            decoded = _decoded(vocabulary, ids, np.r_[0, np.cumsum(counts)])
            yield pa.record_batch([batch.column("doc_id"), decoded], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, decoded binary")


def round_trip(docs: DataFrame, tokens: list[bytes]) -> DataFrame:
    """``doc_id, ids, decoded``: encode and decode in one pass, so that ids travel once."""
    encoder = Encoder(Vocabulary.of(tokens))

    def kernel(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, bounds = encoder(*flat(part.column("text")))
        decoded = _decoded(encoder.vocabulary, ids, bounds)
        return pa.record_batch(
            [part.column("doc_id"), _lists(ids, bounds), decoded], names=["doc_id", "ids", "decoded"]
        )

    schema = "doc_id bigint, ids array<int>, decoded binary"
    return docs.select("doc_id", "text").mapInArrow(mapped(kernel, most=SLICE), schema)


def _lists(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids, pa.int32()))


def _decoded(vocabulary: Vocabulary, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    data, lengths = vocabulary.bytes_of(ids)
    ends = np.r_[0, np.cumsum(lengths)][bounds].astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())]
    )
