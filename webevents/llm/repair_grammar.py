"""Token ids in binary shards, compressed by a Re-Pair grammar.

Documents are sorted by id, encoded whole, given an end id and cut into shards. In every
shard the frequent pairs of neighbouring ids are replaced by nonterminals, again and again;
the shard's file holds the rules, the length each expands to, and for every document where its
symbols and its ids begin, so that any document, or any range of ids, is decoded without
the rest. Pairs never span two documents.

Each turn replaces the most frequent pairs together (not one pair a turn), which takes a
few passes over a shard instead of one per rule; the grammar stays exact. Turns go on until no pair
occurs ``MIN_COUNT`` times.

Defined results: a null or empty text is a document of the end id alone; a null id sorts
first; texts of one id stand in the order of their hash, so that reruns agree and a hot id fills
several tasks; repeated rows are documents of their own, one after the other; an empty table has
no shards; other columns are not read.
"""

from __future__ import annotations

import codecs
import os
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webevents.llm.common import Memory, batch_of, new_path, spread, stored
from webevents.llm.files import new_file, open_input, open_output

END_ID = 0
#: A shard is closed at so many ids; a longer document has a shard to itself.
SHARD_IDS = 2_000_000
#: Pairs replaced in one turn, and occurrences a pair needs.
PAIRS = 8192
MIN_COUNT = 8

#: Chunks of text in one generation of a worker's memory (about 200 bytes each).
MEMORY = 500_000
#: Bytes of text encoded together (a longer text by itself), and pre-tokens in one call of the library.
TEXT_BYTES = 4_000_000
AT_ONCE = 5_000

MAGIC = b"RPG2"
HEADER = struct.Struct("<4sIQQQQQ")  # magic, bits per symbol, documents, symbols, ids, rules, first nonterminal


def frequent_pairs(symbols: np.ndarray, ends: np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
    """Up to PAIRS most frequent pairs within documents (``ends``: places of their last symbols), as
    left << bits | right, sorted; bits are those of a symbol, so that a shard of 16-bit symbols sorts 32-bit numbers.
    ``places``: those of ``open_places``, if others need no look."""
    wide = np.uint32 if symbols.dtype == np.uint16 else np.uint64
    pairs = (symbols[:-1] if places is None else symbols[places]).astype(wide)
    pairs <<= wide(8 * symbols.itemsize)
    pairs |= symbols[1:] if places is None else symbols[places + 1]
    across = ends[ends < len(pairs)] if places is None else ends[:0]
    pairs[across] = ~wide(0)  # no pair, as its symbols would be
    pairs.sort()
    pairs = pairs[: len(pairs) - len(across)]
    if not len(pairs):
        return pairs
    begins = np.flatnonzero(pairs[1:] != pairs[:-1]) + 1
    counts = np.diff(begins, prepend=0, append=len(pairs))
    begins = np.concatenate(([0], begins))
    often = np.flatnonzero(counts >= MIN_COUNT)
    if len(often) > PAIRS:  # ties at the border go to the smaller pairs, as the sort is stable
        often = often[np.argsort(-counts[often], kind="stable")[:PAIRS]]
    return np.sort(pairs[begins[often]])


def left_of(pairs: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    return (pairs >> pairs.dtype.type(8 * symbols.itemsize)).astype(np.int64)


def right_of(pairs: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    return (pairs & pairs.dtype.type((1 << 8 * symbols.itemsize) - 1)).astype(np.int64)


def open_places(symbols: np.ndarray, ends: np.ndarray, left: np.ndarray, right: np.ndarray, new: int) -> np.ndarray:
    """Where pairs can be frequent after a turn that took every frequent pair: at its symbols, those from ``new`` on, and
    where its pairs' symbols meet, as overlaps leave some. Neighbours of any other kind were as many before, and too few.
    A pair stands in all of its places here or in none."""
    size = int(symbols.max()) + 1
    begins, closes, fresh = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool), symbols >= new
    begins[left[left < size]] = closes[right[right < size]] = True
    found = fresh[:-1] | fresh[1:] | (begins.take(symbols[:-1]) & closes.take(symbols[1:]))
    found[ends[ends < len(found)]] = False
    return np.flatnonzero(found)


def occurrences(
    symbols: np.ndarray, ends: np.ndarray, pairs: np.ndarray, places: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Places where a pair is to be replaced, left to right without overlap, and which pair."""
    left, row = np.unique(left_of(pairs, symbols), return_inverse=True)
    right, column = np.unique(right_of(pairs, symbols), return_inverse=True)
    # a small table of the pairs, over the symbols that occur in any and one row and column for all others
    table = np.full((len(left) + 1, len(right) + 1), -1, dtype=np.int16)
    table[row, column] = np.arange(len(pairs))
    size = int(symbols.max()) + 1
    of_left, of_right = np.full(size, len(left) * (len(right) + 1), dtype=np.int32), np.full(size, len(right), dtype=np.int32)
    of_left[left], of_right[right] = np.arange(len(left)) * (len(right) + 1), np.arange(len(right))
    if places is None:
        which = table.ravel().take(of_left.take(symbols[:-1]) + of_right.take(symbols[1:]))
        which[ends[ends < len(which)]] = -1
        at = np.flatnonzero(which >= 0)
        which = which[at]
    else:
        which = table.ravel().take(of_left.take(symbols[places]) + of_right.take(symbols[places + 1]))
        at, which = places[which >= 0], which[which >= 0]
    if not len(at):
        return at, which
    # of neighbouring places (which overlap) every second one is taken, from the first
    begins = np.concatenate(([True], np.diff(at) > 1))
    start = np.maximum.accumulate(np.where(begins, at, 0))
    taken = (at - start) & 1 == 0
    return at[taken], which[taken]


#: Symbols packed at once; a multiple of 8, so that their bits end with a byte.
BLOCK = 1 << 16


def packed(symbols: np.ndarray, bits: int) -> bytes:
    """The lowest ``bits`` of every symbol, one after the other."""
    blocks = (symbols[i : i + BLOCK].astype(">u4").view(np.uint8).reshape(-1, 4) for i in range(0, len(symbols), BLOCK))
    return b"".join(np.packbits(np.unpackbits(b, axis=1)[:, 32 - bits :]).tobytes() for b in blocks)


def unpacked(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """``n`` symbols from the bytes of ``packed``."""
    out = np.empty(n, dtype=np.uint32)
    for i in range(0, n, BLOCK):
        size = min(BLOCK, n - i)
        wide = np.zeros((size, 32), dtype=np.uint8)
        wide[:, 32 - bits :] = np.unpackbits(data[i * bits // 8 :][: (size * bits + 7) // 8], count=size * bits).reshape(size, bits)
        out[i : i + size] = np.packbits(wide, axis=1).view(">u4").ravel()
    return out


@dataclass
class Shard:
    """A grammar and its documents; symbols from ``first_rule`` on are nonterminals."""

    doc_ids: np.ndarray  # int64
    known: np.ndarray  # uint8: 0 where the document id is null
    symbol_starts: np.ndarray  # per document and the end
    id_starts: np.ndarray
    symbols: np.ndarray
    rules: np.ndarray  # (n, 2) uint32
    lengths: np.ndarray  # ids each rule expands to
    first_rule: int
    _unfolded: tuple[np.ndarray, np.ndarray] | None = None

    @staticmethod
    def build(doc_ids: list[int | None], ids: np.ndarray, counts: np.ndarray, terminals: int) -> Shard:
        """``ids`` of all documents one after the other, ``counts`` of them in each."""
        id_starts = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        ends = id_starts[1:] - 1
        # symbols fit 16 bits until the vocabulary and all rules together outgrow them
        symbols, rules = ids.astype(np.uint16 if terminals <= 1 << 16 else np.uint32), np.zeros((0, 2), dtype=np.uint32)
        lengths = np.zeros(0, dtype=np.int64)
        places = None
        # each turn shortens the shard: of the places of its pairs at least half are taken
        while len(pairs := frequent_pairs(symbols, ends, places)):
            at, which = occurrences(symbols, ends, pairs, places)
            left, right, every = left_of(pairs, symbols), right_of(pairs, symbols), len(pairs) < PAIRS
            used = np.bincount(which, minlength=len(pairs))
            worth = used >= MIN_COUNT // 2  # overlaps may leave a pair too few places
            at, which = at[worth[which]], which[worth[which]]
            pairs = pairs[worth]
            number = np.cumsum(worth) - 1
            new = np.stack([left_of(pairs, symbols), right_of(pairs, symbols)], axis=1).astype(np.uint32)
            sizes = np.where(new < terminals, 1, 0).astype(np.int64)
            inner = new >= terminals
            sizes[inner] = lengths[new[inner] - terminals]
            if symbols.dtype == np.uint16 and terminals + len(rules) + len(new) > 1 << 16:
                symbols = symbols.astype(np.uint32)
            symbols[at] = terminals + len(rules) + number[which]
            stays = np.ones(len(symbols), dtype=bool)
            stays[at + 1] = False
            symbols, ends = symbols[stays], ends - np.searchsorted(at, ends)  # a last symbol moves by those gone up to it
            places = open_places(symbols, ends, left, right, terminals + len(rules)) if every else None
            rules, lengths = np.concatenate([rules, new]), np.concatenate([lengths, sizes.sum(axis=1)])
        symbol_starts = np.concatenate(([0], ends + 1))
        known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
        return Shard(
            np.array([d or 0 for d in doc_ids], dtype=np.int64), known, symbol_starts, id_starts,
            symbols, rules, lengths, terminals,
        )

    def to_bytes(self) -> bytes:
        """Header, arrays in the order of the fields, and a crc32 of all before it."""
        bits = max(1, (self.first_rule + len(self.rules) - 1).bit_length())
        body = HEADER.pack(
            MAGIC, bits, len(self.doc_ids), len(self.symbols), int(self.id_starts[-1]), len(self.rules), self.first_rule
        ) + b"".join(
            np.ascontiguousarray(a.astype(t)).tobytes()
            for a, t in (
                (self.doc_ids, "<i8"), (self.known, "u1"), (self.symbol_starts, "<u8"), (self.id_starts, "<u8"),
                (self.rules, "<u4"), (self.lengths, "<u8"),
            )
        ) + packed(self.symbols, bits)
        return body + struct.pack("<I", zlib.crc32(body))

    @staticmethod
    def from_bytes(data: bytes) -> Shard:
        magic, bits, n_docs, n_symbols, n_ids, n_rules, first = HEADER.unpack_from(data)
        if magic != MAGIC or zlib.crc32(memoryview(data)[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("not a grammar shard, or a damaged one")
        at, arrays = HEADER.size, []
        for t, n in (("<i8", n_docs), ("u1", n_docs), ("<u8", n_docs + 1), ("<u8", n_docs + 1),
                     ("<u4", 2 * n_rules), ("<u8", n_rules), ("u1", (n_symbols * bits + 7) // 8)):
            arrays.append(np.frombuffer(data, t, n, at))
            at += arrays[-1].nbytes
        ids, known, symbol_starts, id_starts, rules, lengths, symbols = arrays
        if at + 4 != len(data) or int(id_starts[-1]) != n_ids or int(symbol_starts[-1]) != n_symbols:
            raise ValueError("the shard's lengths disagree with its header")
        return Shard(
            ids, known, symbol_starts.astype(np.int64), id_starts.astype(np.int64), unpacked(symbols, n_symbols, bits),
            rules.reshape(-1, 2), lengths.astype(np.int64), first,
        )

    def unfolded(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all terminals and rules in a row, and where each begins. Rules refer to earlier
        turns only, so a few passes unfold them all."""
        ids = np.arange(self.first_rule, self.first_rule + len(self.rules), dtype=np.uint32)
        while (inner := ids >= self.first_rule).any():
            at = np.cumsum(1 + inner) - 1 - inner
            out = np.empty(len(ids) + int(inner.sum()), dtype=np.uint32)
            out[at[~inner]] = ids[~inner]
            pairs = self.rules[ids[inner] - self.first_rule]
            out[at[inner]], out[at[inner] + 1] = pairs[:, 0], pairs[:, 1]
            ids = out
        ids = np.concatenate([np.arange(self.first_rule, dtype=np.uint32), ids])
        starts = np.concatenate([np.arange(self.first_rule), self.first_rule + np.cumsum(self.lengths) - self.lengths])
        return ids, starts

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of a run of symbols."""
        if self._unfolded is None:
            self._unfolded = self.unfolded()
        ids, starts = self._unfolded
        sizes = np.concatenate([np.ones(self.first_rule, dtype=np.int64), self.lengths])[symbols]
        ends = np.cumsum(sizes)
        # id i of the run is id i - (its symbol's begin in the run) of that symbol
        shift = np.repeat(starts[symbols] - ends + sizes, sizes)
        shift += np.arange(len(shift))
        return ids[shift]

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document, from its own symbols only."""
        return self.expand(self.symbols[self.symbol_starts[k] : self.symbol_starts[k + 1]])

    def window(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end`` of the shard: the rules' lengths tell which symbols hold them."""
        sizes = np.ones(len(self.symbols), dtype=np.int64)
        inner = self.symbols >= self.first_rule
        sizes[inner] = self.lengths[self.symbols[inner] - self.first_rule]
        starts = np.concatenate(([0], np.cumsum(sizes)))
        a = max(int(np.searchsorted(starts, begin, "right")) - 1, 0)
        b = int(np.searchsorted(starts, end, "left"))
        return self.expand(self.symbols[a:b])[begin - starts[a] : end - starts[a]]


# How byte-level vocabularies spell bytes: printable Latin-1 as itself, the others from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = iter(range(256, 512))
#: The letter of every byte; but the line feed, which no pre-token of letters holds, stands between them.
SPELLING = "".join(chr(b if b in _PRINTABLE else next(_OTHERS)) for b in range(256)).replace(chr(256 + ord("\n")), "\n")
#: Marks that end words (an apostrophe would begin a pre-token of its own, were letters to follow).
MARKS = ".,!?;:#%&*$|()-\""


#: White space to Python or to the library, twice in a row.
UNEVEN = "[" + "".join(rf"\x{{{c:x}}}" for c in range(0x3001) if chr(c).isspace()) + "]{2}"


def strings(array: pa.StringArray) -> list[str]:
    """The strings of an array, none of which has a space: one conversion, not one for each."""
    return pc.binary_join(pa.ListArray.from_arrays([0, len(array)], array), " ")[0].as_py().split(" ") if len(array) else []


class TextEncoder:
    """Encodes whole texts with the tokenizers library.

    Byte-level pre-tokens never cross a lone space or line feed, so texts are cut there. The chunks of many texts
    are numbered together, words met before are looked up, and thousands of others go through the
    library's model in one call; the library encodes the other chunks, and every text in which white space
    meets white space, or that holds the string of an added token, as a whole."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: The model alone, for pre-tokens spelled in its letters, of which none is a line feed.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = CharDelimiterSplit("\n")
        letters = self.model.get_vocab()
        self.spaced = np.zeros(1 + max(letters.values()), dtype=bool)
        self.spaced[[i for token, i in letters.items() if token.startswith(SPELLING[ord(" ")])]] = True
        self.chunks = Memory(self.chunk, MEMORY)
        self.marks = Memory(self.ids)

    def ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def chunk(self, chunk: str) -> bytes:
        """Ids of a chunk from the library; a line feed at its begin has no space before it."""
        return self.marks["\n"] + self.head(chunk[1:]) if chunk[:1] == "\n" else self.ids(" " + chunk)

    def words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words of letters, each with the space before it, from the library's model alone."""
        for i in range(0, len(words), AT_ONCE):
            spelled, _ = codecs.charmap_decode((" " + "\n ".join(words[i : i + AT_ONCE])).encode(), "strict", SPELLING)
            ids = self.model.encode_batch_fast([spelled], add_special_tokens=False)[0].ids
            data = array("I", ids).tobytes()
            # a pre-token has its space at its begin and nowhere else, so that space tells where its ids begin
            begins = (4 * np.flatnonzero(self.spaced[ids])).tolist()
            yield from map(data.__getitem__, map(slice, begins, [*begins[1:], len(data)]))

    def pieces(self, chunks: list[str], bare: list[str], marked: list[int]) -> list[bytes]:
        """Ids of different chunks. Letters, with the space before them, are one pre-token, and so are the marks that
        follow them in the places ``marked`` (``bare``: chunks without); anything else goes through the library as a whole."""
        memory, old, keys = self.chunks, self.chunks.old, chunks.copy()
        memory.turn()
        self.marks.turn()
        for i in marked:
            if bare[i].isalpha():
                keys[i] = bare[i]
        found = [*map(memory.get, keys)]
        missing = [i for i, ids in enumerate(found) if ids is None]
        new = []
        for key in dict.fromkeys(map(keys.__getitem__, missing)):
            if (ids := old.get(key)) is not None:
                memory[key] = ids
            elif key.isalpha():
                new.append(key)
        memory.update(zip(new, self.words(new), strict=True))
        for i in missing:
            found[i] = memory[keys[i]]
        for i in marked:
            if keys[i] is not chunks[i]:
                found[i] += self.marks[chunks[i][len(keys[i]) :]]
        return found

    def head(self, text: str) -> bytes:
        """Ids of text that begins a line, without a space before it."""
        return self.ids(text) if text else b""

    def encode(self, text: str | None) -> bytes:
        """Ids of one text."""
        return self.encode_all(pa.array([text], pa.string()), b"")[0].tobytes()

    def encode_all(self, texts: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, ``end`` after each, and how many each has with it."""
        whole = pc.match_substring_regex(texts, UNEVEN)
        for t in self.added:
            whole = pc.or_(whole, pc.match_substring(texts, t))
        whole = pc.fill_null(whole, True)
        # a chunk stands for itself with the space before it, or begins with its line feed
        spaced = pc.replace_substring(pc.if_else(whole, "", texts), "\n", " \n")
        cut = pc.split_pattern(spaced, " ")
        offsets, flat = cut.offsets.to_numpy().astype(np.int64), cut.values
        inner = np.ones(len(flat), dtype=bool)
        inner[offsets[:-1]] = False
        heads = flat.take(pa.array(offsets[:-1])).to_pylist()
        numbered = flat.filter(pa.array(inner)).dictionary_encode()
        n, chunks = len(numbered.dictionary), numbered.dictionary
        bare = pc.utf8_rtrim(chunks, MARKS)
        marked = np.flatnonzero(pc.not_equal(pc.binary_length(chunks), pc.binary_length(bare)).to_numpy(zero_copy_only=False))
        pieces = [*self.pieces(strings(chunks), strings(bare), marked.tolist()), end, *map(self.head, heads)]
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
            pieces[n + 1 + i] = self.head(texts[i].as_py())
        # the number of every chunk, of each text's head and, after each text, of the end
        codes = np.empty(len(flat), dtype=np.int32)
        codes[inner] = numbered.indices.to_numpy()
        codes[offsets[:-1]] = n + 1 + np.arange(len(heads))
        codes = np.insert(codes, offsets[1:], n)
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) // 4
        starts = np.cumsum(sizes) - sizes
        taken = sizes[codes]
        ends = np.cumsum(taken)
        where = np.repeat(starts[codes] - ends + taken, taken)
        where += np.arange(len(where))
        ids = np.frombuffer(b"".join(pieces), "<u4")[where]
        return ids, np.diff(ends[offsets[1:] + np.arange(len(heads))], prepend=0)


_encoders: dict[int, TextEncoder] = {}


def encoder_of(tokenizer_json: str) -> TextEncoder:
    """This worker's encoder, with what it remembers."""
    name = xxhash.xxh64_intdigest(tokenizer_json)
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = TextEncoder(tokenizer_json)
    return _encoders[name]


def together(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``batch`` whose second column has about ``most`` bytes in all, or one row."""
    ends, at = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def write_shards(
    docs: DataFrame, folder: str, tokenizer_json: str, terminals: int, *, doc_id: str = "doc_id",
    text: str = "text", end_id: int = END_ID, shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """Write the shards below ``folder``; their list (part, shard, path, documents, ids), in order.

    The list is stored, and only files on it count: what lost or repeated attempts have
    written is never read."""
    schema = pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("path", pa.string()),
                        ("documents", pa.int64()), ("ids", pa.int64())])
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_json)
        part, shard = TaskContext.get().partitionId(), 0
        names, sizes, pieces, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            path = new_file(folder, ".rpg")
            data = np.concatenate(pieces)
            with open_output(path) as out:
                out.write(Shard.build(names, data, np.concatenate(sizes), terminals).to_bytes())
            return batch_of(schema, [part], [shard], [path], [len(names)], [len(data)])

        for batch in batches:
            for some in together(batch, TEXT_BYTES):
                ids, counts = encoder.encode_all(some.column(1).cast(pa.string()), end)
                own, ends, at = some.column(0).to_pylist(), np.concatenate(([0], np.cumsum(counts))), 0
                while at < len(own):
                    # the first document that fills the shard is its last
                    full = int(np.searchsorted(ends, ends[at] + shard_ids - held))
                    to = min(full, len(own))
                    names += own[at:to]
                    sizes.append(counts[at:to])
                    pieces.append(ids[ends[at] : ends[to]])
                    held, at = held + int(ends[to] - ends[at]), to
                    if held >= shard_ids:
                        yield flush()
                        names, sizes, pieces, held, shard = [], [], [], 0, shard + 1
        if names:
            yield flush()

    ordered = (
        docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
        .withColumn("hash", F.xxhash64("text"))
        .repartitionByRange("id", "hash").sortWithinPartitions("id", "hash").select("id", "text")
    )
    return stored(
        ordered.mapInArrow(run, "part long, shard long, path string, documents long, ids long"), "grammar-shards"
    )


def shard_starts(shards: DataFrame) -> DataFrame:
    """``shards`` plus ``start``, the ids before each shard: within parts, then over the parts' sums."""
    parts = shards.groupBy("part").agg(F.sum("ids").alias("_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per Spark partition
    parts = parts.select("part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (
        shards.withColumn("_inside", F.coalesce(F.sum("ids").over(inside), F.lit(0)))
        .join(parts, "part").withColumn("start", F.col("_before") + F.col("_inside")).drop("_before", "_inside")
    )


def read_shards(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files listed."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0), batch.column(1)):
                with open_input(path.as_py()) as file:
                    shard = Shard.from_bytes(file.read())
                ids = shard.expand(shard.symbols).astype("<u4").tobytes()
                cuts = shard.id_starts
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(cuts, cuts[1:])]
                yield batch_of(
                    schema, pa.array(shard.doc_ids, mask=shard.known == 0), cuts[:-1] + start.as_py(), np.diff(cuts), crc
                )

    return (
        spread(shard_starts(shards).select("path", "start"), "path")
        .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )


def op2_repair_tokens(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write all documents' ids as grammar shards, read them back, and digest each document."""
    import json

    with open(tokenizer_path) as file:
        tokenizer_json = file.read()
    spec = json.loads(tokenizer_json)
    terminals = 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    folder = new_path(docs.sparkSession, "token-shards")
    return read_shards(write_shards(docs, folder, tokenizer_json, terminals))
