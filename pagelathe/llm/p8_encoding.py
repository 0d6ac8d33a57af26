"""Problem 8: encoding of all texts with a public byte-level BPE vocabulary.

A text is split by the vocabulary's pattern. A piece that is a token is done;
any other is merged over its byte positions: a segment tree holds the rank of
the pair that begins at each position and gives the leftmost pair of the least
rank, and every merge updates the live neighbours in logarithmic time. So a
piece of n bytes takes O(n log n), also one of a million letters.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the rank file lies; a parameter of every function that reads it.
RANK_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces that a Python worker remembers, and the longest of them in letters; the memory is emptied when full.
MEMORY, MEMORY_LETTERS = 200_000, 64
_NONE = 1 << 60


def read_ranks(path: str = RANK_FILE) -> bytes:
    """The rank file as it is, for shipping to the workers (under 1 MB)."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece that is no token itself."""
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    rank = ranks.get
    tree = [_NONE] * (2 * size)
    for i in range(n - 1):
        tree[size + i] = rank(piece[i : i + 2], _NONE)
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a <= b else b
    after = list(range(1, n + 1))  # start of the next token; n behind the last
    before = list(range(-1, n - 1))

    def put(at: int, value: int) -> None:
        i = size + at
        tree[i] = value
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            least = a if a <= b else b
            if tree[i] == least:
                break
            tree[i] = least
            i >>= 1

    while (least := tree[1]) != _NONE:
        i = 1
        while i < size:
            i *= 2
            if tree[i] != least:
                i += 1
        at = i - size
        gone = after[at]
        end = after[gone]
        after[at] = end
        if gone < n - 1:
            put(gone, _NONE)
        if end < n:
            before[end] = at
            put(at, rank(piece[at : after[end]], _NONE))
        else:
            put(at, _NONE)
        if (prior := before[at]) >= 0:
            put(prior, rank(piece[prior:end], _NONE))
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at : after[at]]])
        at = after[at]
    return out


class Encoder(dict):
    """piece -> ids, remembering what it has met."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.split = regex.compile(PATTERN).findall

    def __missing__(self, piece: str) -> list[int]:
        data = piece.encode("utf-8", "surrogatepass")
        own = self.ranks.get(data)
        ids = [own] if own is not None else merge_piece(data, self.ranks)
        if len(piece) <= MEMORY_LETTERS:
            if len(self) >= MEMORY:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in self.split(text):
            out += self[piece]
        return out


_encoders: dict[int, Encoder] = {}


def encoder_of(data: bytes) -> Encoder:
    """The worker's encoder for a rank file; parsed once a worker."""
    key = hash(data)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(parse_ranks(data))
    return _encoders[key]


def encode(documents: DataFrame, rank_file: str = RANK_FILE) -> DataFrame:
    """(doc_id, ids) for every row of `documents` (doc_id, text), repeated rows included.

    A null text and an empty text have the empty list. Texts are encoded whole,
    however long. One pass in Arrow batches, without a shuffle.
    """
    data = documents.sparkSession.sparkContext.broadcast(read_ranks(rank_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(data.value)
        for batch in batches:
            offsets, ids = [0], []
            for text in batch.column("text").to_pylist():
                if text:
                    ids += encoder.encode(text)
                offsets.append(len(ids))
            lists = pa.ListArray.from_arrays(pa.array(np.array(offsets, np.int32)), pa.array(np.array(ids, np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "ids"])

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def token_counts(documents: DataFrame, rank_file: str = RANK_FILE) -> DataFrame:
    """(doc_id, source, tokens) for every row; null and empty texts have 0 tokens."""
    data = documents.sparkSession.sparkContext.broadcast(read_ranks(rank_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(data.value)
        for batch in batches:
            counts = [sum([len(encoder[p]) for p in encoder.split(t)]) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), pa.array(counts, pa.int64())], names=["doc_id", "source", "tokens"]
            )

    return documents.select(F.col("doc_id").cast("bigint"), "source", "text").mapInArrow(run, "doc_id bigint, source string, tokens bigint")
