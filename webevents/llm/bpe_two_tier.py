"""Byte-level BPE encoding and decoding with a two-tier lookup.

First tier: a minimal perfect hash over the vocabulary resolves pre-tokens that are tokens
as a whole. Second tier: the others are merged with a heap of adjacent pairs over a
linked list of their bytes, lowest rank first and leftmost among equals.

The hash is built once on the driver from a rank file and travels with the tasks
(about a megabyte). Texts are encoded whole; frequent chunks of text are remembered
in a table of bounded size per Python worker.

Defined results: a null or empty text has no ids and decodes to no bytes; repeated rows
are encoded one by one; other columns pass through.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webevents.llm.common import Memory

#: Rows put into one output batch.
ROWS = 500

digest = xxhash.xxh64_intdigest


class PerfectHash:
    """Minimal perfect hash of byte strings: a displacement per bucket, one slot per key."""

    PER_BUCKET = 4

    def __init__(self, keys: list[bytes]):
        n = max(len(keys), 1)
        self.shift = [0] * (len(keys) // self.PER_BUCKET + 1)
        self.slots: list[int] = [-1] * n
        buckets: list[list[int]] = [[] for _ in self.shift]
        for i, key in enumerate(keys):
            buckets[digest(key) % len(buckets)].append(i)
        order = sorted(range(len(buckets)), key=lambda b: -len(buckets[b]))
        for b in order:
            if len(buckets[b]) < 2:
                break
            seed = 0
            while True:
                seed += 1
                places = [digest(keys[i], seed) % n for i in buckets[b]]
                if len(set(places)) == len(places) and all(self.slots[p] < 0 for p in places):
                    break
            self.shift[b] = seed
            for i, p in zip(buckets[b], places):
                self.slots[p] = i
        free = (p for p, i in enumerate(self.slots) if i < 0)
        for b in order:  # a bucket of one key names its slot outright
            if len(buckets[b]) == 1:
                p = next(free)
                self.shift[b] = -p - 1
                self.slots[p] = buckets[b][0]

    def index(self, key: bytes) -> int:
        """Number of the only key that ``key`` can be; the caller compares."""
        shift = self.shift[digest(key) % len(self.shift)]
        return self.slots[-shift - 1 if shift < 0 else digest(key, shift) % len(self.slots)]


class Vocabulary:
    """Tokens by rank, the perfect hash over them, and the pre-token pattern."""

    def __init__(self, tokens: dict[bytes, int], pattern: str):
        if any(bytes([b]) not in tokens for b in range(256)):
            raise ValueError("a byte-level vocabulary holds all 256 single bytes")
        self.keys = list(tokens)
        self.ranks = [tokens[k] for k in self.keys]
        self.hash = PerfectHash(self.keys)
        self.by_rank = {r: k for k, r in tokens.items()}
        self.pattern = pattern
        self.name = digest(repr((sorted(tokens.items()), pattern)).encode())

    @staticmethod
    def read(path: str, pattern: str) -> Vocabulary:
        """A rank file: a token in base 64 and its rank on each line."""
        with open(path, "rb") as lines:
            return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)

    def whole(self, piece: bytes) -> int | None:
        """First tier: the id of a pre-token that is a token."""
        i = self.hash.index(piece)
        return self.ranks[i] if self.keys[i] == piece else None


class Encoder:
    """Encodes whole texts; ids are little-endian unsigned 32-bit integers in bytes."""

    #: White space next to white space: the only place where a cut before a space or line
    #: feed could fall inside a pre-token.
    UNEVEN = re.compile(r"\s\s")

    def __init__(self, vocabulary: Vocabulary):
        self.whole = vocabulary.whole
        self.split = regex.compile(vocabulary.pattern).findall
        ranks = {token: r for r, token in vocabulary.by_rank.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        #: rank of a merge by the ranks of its two parts
        self.merged = {
            ranks[token[:cut]] << 32 | ranks[token[cut:]]: r
            for token, r in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        }
        self.chunks = Memory(self.chunk)
        self.tokens = Memory(self.token)

    def merge(self, piece: bytes) -> list[int]:
        """Second tier, for a piece that is no token: a heap of pairs over linked bytes."""
        n, rank = len(piece), self.merged.get
        parts = [self.single[b] for b in piece]
        after = list(range(1, n + 1))  # start of the next part; -1 once merged away
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if (r := rank(parts[i] << 32 | parts[i + 1])) is not None:
                heap.append((r, i, i + 2))
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            r, i, end = pop(heap)
            j = after[i]
            if j < 0 or j >= n or after[j] != end:
                continue  # one of its parts has changed since
            after[i], after[j], parts[i] = end, -1, r
            if end < n:
                before[end] = i
                if (new := rank(r << 32 | parts[end])) is not None:
                    push(heap, (new, i, after[end]))
            h = before[i]
            if h >= 0 and (new := rank(parts[h] << 32 | r)) is not None:
                push(heap, (new, h, end))
        return [parts[i] for i in range(n) if after[i] >= 0]

    def token(self, match: str) -> bytes:
        """Ids of one pre-token."""
        piece = match.encode()
        r = self.whole(piece)
        return array("I", self.merge(piece) if r is None else (r,)).tobytes()

    def pieces(self, text: str) -> bytes:
        """Ids of all pre-tokens of ``text``."""
        return b"".join(self.tokens.all(self.split(text)))

    def chunk(self, chunk: str) -> bytes:
        return self.pieces(chunk if chunk[:1] == "\n" else " " + chunk)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.UNEVEN.search(text):
            return self.pieces(text)
        # no pre-token crosses a lone space or line feed: cut there; a chunk stands for itself
        # with the space before it, or begins with its line feed
        first, *chunks = text.replace("\n", " \n").split(" ")
        return self.pieces(first) + b"".join(self.chunks.all(chunks))


_encoders: dict[int, Encoder] = {}


def encoder_of(vocabulary: Vocabulary) -> Encoder:
    """This worker's encoder for the vocabulary, with what it remembers."""
    if vocabulary.name not in _encoders:
        _encoders.clear()
        _encoders[vocabulary.name] = Encoder(vocabulary)
    return _encoders[vocabulary.name]


def _with_column(df: DataFrame, column: str, into: str, function, keep: list[str] | None) -> DataFrame:
    """The columns ``keep`` of ``df`` (None: all) and the binary column ``into``, ``function``
    of each batch of ``column``."""
    keep = df.columns if keep is None else keep
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(into, T.BinaryType())])
    read = list(dict.fromkeys([*keep, column]))
    at = read.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = function()
        for whole in batches:
            for begin in range(0, whole.num_rows, ROWS):
                batch = whole.slice(begin, ROWS)
                values = pa.array([apply(v) for v in batch.column(at).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], values], names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in read]).mapInArrow(run, schema)


def encode_documents(
    docs: DataFrame, vocabulary: Vocabulary, *, text: str = "text", into: str = "ids", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` plus the ids of each whole text, as little-endian unsigned 32-bit integers."""
    return _with_column(docs, text, into, lambda: encoder_of(vocabulary).encode, keep)


def decode_documents(
    rows: DataFrame, vocabulary: Vocabulary, *, ids: str = "ids", into: str = "decoded", keep: list[str] | None = None
) -> DataFrame:
    """``rows`` plus the bytes that the ids stand for."""

    def decoder():
        size = max(vocabulary.by_rank) + 1
        tokens = [vocabulary.by_rank.get(r, b"") for r in range(size)]
        lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        all_bytes = np.frombuffer(b"".join(tokens), np.uint8)

        def decode(data: bytes | None) -> bytes:
            ranks = np.frombuffer(data or b"", "<u4")
            sizes = lengths[ranks]
            ends = np.cumsum(sizes)
            # byte i of the text is byte i - (its token's begin in the text) of that token
            shift = np.repeat(starts[ranks] - ends + sizes, sizes)
            return all_bytes[shift + np.arange(len(shift))].tobytes()

        return decode

    return _with_column(rows, ids, into, decoder, keep)


def op7_bpe_two_tier(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Length and digests of every document's ids and of what they decode to."""
    vocabulary = Vocabulary.read(ranks_path, pattern)
    encoded = encode_documents(docs.select("doc_id", "text"), vocabulary, keep=["doc_id"]).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), "ids"
    )
    return decode_documents(encoded, vocabulary, keep=["doc_id", "n_tokens", "ids_sha256"]).withColumn(
        "decoded_sha256", F.sha2("decoded", 256)
    ).drop("decoded")
