"""Ranked lexical search in K2-treaps over the grid of terms and documents.

Documents are cut into blocks of text; each block becomes one file with the K2-treap of its grid: a
quadtree over (term, document) cells whose nodes say which of their four quarters hold postings and
what the largest impact inside is, kept as the difference from the parent's (most are none and take a
bit). A term's row is a path of quarters. A search descends the paths of all terms of an item together:
a state is a range of documents with the node of every term that occurs there, its bound the weighted sum of their
maxima. The states with the highest bounds go on first, halves of their range become new states,
and an item is done with a block when no bound reaches its k-th best score so far.

Impacts don't depend on the terms' weights, so an index serves any items. Blocks are built and searched by
tasks of their own; an item's best so far carries from one block of a task to the next. The bounds are never
below the true scores, so the result is exact.

Defined results: a null or empty text has no terms and is never found; a null id is an id like any other
and comes last among ties; every repeated row is a document of its own; equal item rows are searched
once, different texts under one item id each; other columns don't matter; no rows on either side
give no rows.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webevents.llm.common import batch_of, new_path, spread, stored
from webevents.llm.files import new_file, open_input, open_output

K = 20
BLOCK_BYTES = 1 << 24  # text in one treap
ITEMS_TOGETHER = 64  # items whose states go through a block together
STATES_EACH = 32  # of an item expanded in one turn
TERMS_TOGETHER = 20_000  # looked up in a block's list of terms in one turn
BLOCKS_PER_TASK = 4

# A term is a run of ASCII digits and letters and of anything beyond ASCII.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_END = b" \n "  # a document's end; a line feed is in no term


def _number_terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number and document of each term in order, and the terms."""
    joined = b"".join(chain.from_iterable((t.translate(_TABLE), _END) for t in texts))
    offsets = pa.array([0, len(joined)], pa.int64()).buffers()[1]
    whole = pa.LargeStringArray.from_buffers(1, offsets, pa.py_buffer(joined))
    words = pc.list_flatten(pc.split_pattern(whole, " "))
    coded = words.filter(pc.not_equal(words, "")).dictionary_encode()
    codes, terms = coded.indices.to_numpy(), coded.dictionary.cast(pa.large_string())
    ends = codes == pc.index(terms, pa.scalar("\n", pa.large_string())).as_py()
    document = np.cumsum(ends)
    return codes[~ends].astype(np.int64), document[~ends], terms


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts, about ``most`` bytes of text at a time and one text at least."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
            ids.append(i)
            texts.append(text.as_py() or b"")
            size += len(texts[-1])
            if size >= most:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _spread_bits(x: np.ndarray) -> np.ndarray:
    """The lower 32 bits of each number at its even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Bits:
    """Bits with the number of set ones before each place."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @staticmethod
    def packed(places: np.ndarray, size: int) -> np.ndarray:
        flags = np.zeros(-(-size // 64) * 64, bool)
        flags[places] = True
        return np.packbits(flags, bitorder="little").view("<u8")

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def rank(self, at: np.ndarray) -> np.ndarray:
        below = self.words[at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[at >> 6] + np.bitwise_count(below)


def build_treap(row: np.ndarray, column: np.ndarray, impact: np.ndarray, height: int) -> dict[str, np.ndarray]:
    """The K2-treap of the points (row, column, impact), at least one, in a square of side 2 ** ``height``."""
    code = _spread_bits(row) << np.uint64(1) | _spread_bits(column)
    order = np.argsort(code)
    code, most = code[order], impact[order]
    quarters, less = [], []
    for _ in range(height):
        above = code >> np.uint64(2)
        first = np.r_[True, above[1:] != above[:-1]]
        parent, starts = np.cumsum(first) - 1, np.flatnonzero(first)
        over = np.maximum.reduceat(most, starts)
        quarters.append((4 * parent + (code & np.uint64(3)).astype(np.int64), len(starts)))
        less.append(over[parent] - most)
        code, most = above[starts], over
    # breadth first from the root: the n-th quarter that holds something is node n + 1
    places, nodes = [], 0
    for at, n in reversed(quarters):
        places.append(at + 4 * nodes)
        nodes += n
    less = np.concatenate([np.zeros(0, np.int64), *reversed(less)])
    return {
        "quarters": Bits.packed(np.concatenate([np.zeros(0, np.int64), *places]), 4 * nodes),
        "lower": Bits.packed(np.flatnonzero(less), len(less)),
        "less": less[less > 0].astype(np.uint32),
        "root": np.array([most[0]], np.int64),
    }


class Treap:
    """A block's treap as it is searched."""

    def __init__(self, arrays: dict[str, np.ndarray], height: int):
        self.quarters, self.lower, self.less = Bits(arrays["quarters"]), Bits(arrays["lower"]), arrays["less"].astype(np.int64)
        self.root, self.height = int(arrays["root"][0]), height

    def child(self, node: np.ndarray, most: np.ndarray, quarter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the nodes have something in the quarter, and of these the child and its maximum."""
        at = 4 * node + quarter
        there = np.flatnonzero(self.quarters[at])
        n, most = self.quarters.rank(at[there]), most[there].copy()
        lower = np.flatnonzero(self.lower[n])
        most[lower] -= self.less[self.lower.rank(n[lower])]
        return there, n + 1, most


# --- files ---

_MAGIC = b"k2treap1"


def write_block(folder: str, arrays: dict[str, np.ndarray], about: dict) -> str:
    """One file: a JSON header, then every array compressed on its own."""
    parts = [pa.compress(np.ascontiguousarray(a).tobytes(), "zstd", asbytes=True) if a.nbytes else b"" for a in arrays.values()]
    about = {**about, "arrays": [[name, a.dtype.str, a.nbytes, len(p)] for (name, a), p in zip(arrays.items(), parts)]}
    header = json.dumps(about).encode()
    path = new_file(folder, ".k2t")
    with open_output(path) as out:
        out.write(_MAGIC + len(header).to_bytes(8, "little") + header)
        for part in parts:
            out.write(part)
    return path


def read_block(path: str, only: tuple[str, ...] = ()) -> tuple[dict[str, np.ndarray], dict]:
    """A file's arrays (``only`` some) and header."""
    with open_input(path) as file:
        head = file.read(16)
        if head[:8] != _MAGIC:
            raise ValueError(f"{path} is not a block of this index")
        about = json.loads(file.read(int.from_bytes(head[8:], "little")))
        arrays, at = {}, file.tell()
        for name, kind, size, stored_size in about["arrays"]:
            if not only or name in only:
                file.seek(at)
                raw = pa.decompress(file.read(stored_size), size, "zstd", asbytes=True) if size else b""
                arrays[name] = np.frombuffer(raw, kind)
            at += stored_size
    return arrays, about


def _terms_of(arrays: dict[str, np.ndarray]) -> pa.Array:
    offsets, data = pa.py_buffer(arrays["term_offsets"]), pa.py_buffer(arrays["term_bytes"])
    return pa.LargeStringArray.from_buffers(len(arrays["term_offsets"]) - 1, offsets, data)


# --- index ---

_COUNTED = pa.schema([("documents", pa.int64()), ("terms", pa.int64())])
_BUILT = pa.schema([("path", pa.string()), ("documents", pa.int64()), ("postings", pa.int64())])


def count_collection(texts: DataFrame) -> tuple[int, int]:
    """Number of documents (id, text) with a term, and of all their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in _blocks(batches, BLOCK_BYTES):
            joined = np.frombuffer(b" " + b" ".join(t.translate(_TABLE) for t in block) + b" ", np.uint8) != 32
            begins = np.flatnonzero(joined[1:] & ~joined[:-1])
            ends = np.cumsum([len(t) + 1 for t in block])
            each = np.diff(np.searchsorted(begins, ends), prepend=0)
            yield batch_of(_COUNTED, [int((each > 0).sum())], [len(begins)])

    n, terms = texts.mapInArrow(count, "documents long, terms long").agg(F.sum("documents"), F.sum("terms")).first()
    return n or 0, terms or 0


def build_index(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int, int]:
    """(path, documents, postings) of the files, and the collection's documents and terms.

    No shuffle: a task cuts its own documents into blocks. Only files on the list count, so lost
    or repeated attempts do no harm."""
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    documents, terms = count_collection(texts)
    folder = new_path(docs.sparkSession, "treap-blocks")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in _blocks(batches, block_bytes):
            code, document, words = _number_terms(block)
            if not len(code):
                continue
            length = np.bincount(document, minlength=len(ids))
            points, times = np.unique(code * len(ids) + document, return_counts=True)
            term, document = np.divmod(points, len(ids))
            found = np.bincount(term, minlength=len(words))
            order = np.argsort(-found, kind="stable")  # common terms side by side
            order = order[: np.count_nonzero(found)]
            row = np.empty(len(words), np.int64)
            row[order] = np.arange(len(order))
            slow = np.array([100 - 25 + 25 * n * documents // terms for n in length.tolist()], np.int64)
            impact = 1_000_000_000 * times // (1000 * times + 12 * slow[document])
            height = max(len(order) - 1, len(ids) - 1, 1).bit_length()
            kept = words.take(pa.array(order))
            _, offsets, data = kept.buffers()
            offsets = np.frombuffer(offsets, np.int64)[: len(kept) + 1]
            arrays = {
                "term_offsets": offsets, "term_bytes": np.frombuffer(data, np.uint8)[: offsets[-1]], "found": found[order].astype(np.int32),
                "ids": np.array([0 if i is None else i for i in ids], np.int64), "null_ids": np.array([i is None for i in ids]),
                **build_treap(row[term], document, impact, height),
            }
            yield batch_of(_BUILT, [write_block(folder, arrays, {"height": height})], [len(ids)], [len(points)])

    built = texts.mapInArrow(build, "path string, documents long, postings long")
    return stored(built, "treap-index"), documents, terms


# --- search ---

_ITEM_TERMS = "item_id long, text_hash long, term string, times long"


def item_terms(items: DataFrame, *, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, text_hash, term, times): the terms of every item with one."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("item_id", pa.int64()), ("text_hash", pa.int64()), ("term", pa.large_string()), ("times", pa.int64())])
        for batch in batches:
            code, item, terms = _number_terms([t.as_py() or b"" for t in batch.column(2).cast(pa.large_binary())])
            points, times = np.unique(item * max(1, len(terms)) + code, return_counts=True)
            item, code = np.divmod(points, max(1, len(terms)))
            at = pa.array(item)
            yield batch_of(schema, batch.column(0).take(at), batch.column(1).take(at), terms.take(pa.array(code)), times)

    own = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{text}`").alias("text")).where(F.col("text").isNotNull()).distinct()
    return stored(own.select("item_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(split, _ITEM_TERMS), "treap-items")


def document_counts(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, df): documents of the index that hold each of ``terms`` (term), where there is one.

    The terms go to every block in portions; a block reads its list of terms only."""
    portions = math.ceil(terms.count() / TERMS_TOGETHER)
    lists = terms.groupBy(F.pmod(F.xxhash64("term"), F.lit(max(1, portions))).cast("int").alias("portion")).agg(F.collect_list("term").alias("terms"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("term", pa.large_string()), ("df", pa.int64())])
        for batch in batches:
            for path, wanted in zip(batch["path"].to_pylist(), batch["terms"]):
                arrays, _ = read_block(path, ("term_offsets", "term_bytes", "found"))
                wanted = wanted.values.cast(pa.large_string())
                at = pc.index_in(wanted, _terms_of(arrays))
                yield batch_of(schema, wanted.filter(at.is_valid()), arrays["found"][at.drop_null().to_numpy()].astype(np.int64))

    work = _with_portions(index, portions).join(lists, "portion")
    return work.select("path", "terms").mapInArrow(look_up, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))


def _with_portions(index: DataFrame, portions: int) -> DataFrame:
    """Each block once per portion of a stated query set."""
    blocks = spread(index.select("path"), "path")
    return blocks.withColumn("portion", F.explode(F.sequence(F.lit(0), F.lit(max(1, portions) - 1))))


class Best:
    """The best of each of some items so far: scores, ids, null ids, ordered by item, score and id."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.item, self.score, self.id, self.null = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))

    def add(self, item: np.ndarray, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        rows = [np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.id, ids), (self.null, null))]
        order = np.lexsort((rows[2], rows[3], -rows[1], rows[0]))
        rows = [x[order] for x in rows]
        starts = np.searchsorted(rows[0], rows[0])
        kept = np.arange(len(order)) - starts < self.k
        self.item, self.score, self.id, self.null = (x[kept] for x in rows)
        full = np.bincount(self.item, minlength=len(self.least)) >= self.k
        last = np.searchsorted(self.item, np.arange(len(self.least)), "right") - 1
        self.least = np.where(full, self.score[last] if len(last) and len(self.score) else 1, 1)


def _edges(start: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the states' edges, and which of the states each belongs to."""
    n = start[states + 1] - start[states]
    owner = np.repeat(np.arange(len(states)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[states], n), owner


def search_block(treap: Treap, ids: np.ndarray, null: np.ndarray, item: np.ndarray, row: np.ndarray, weight: np.ndarray, best: Best) -> None:
    """Add a block's documents to the best of each item. An item's terms are the places of ``item``, sorted, with the
    term's row and weight."""
    # states: item, level, range of documents, bound; their edges: place of the term, node, its maximum
    items = np.unique(item)
    start = np.r_[np.searchsorted(item, items), len(item)]
    term, node, most = np.arange(len(item)), np.zeros(len(item), np.int64), np.full(len(item), treap.root)
    total = np.r_[0, np.cumsum(weight * treap.root)]
    state = (items, np.zeros(len(items), np.int64), np.zeros(len(items), np.int64), total[start[1:]] - total[start[:-1]])
    while len(state[0]):
        alive = state[3] >= best.least[state[0]]
        order = np.lexsort((-state[3], state[0]))
        order = order[alive[order]]
        of = state[0][order]
        first = np.arange(len(of)) - np.searchsorted(of, of) < STATES_EACH
        waiting = order[~first]
        parts = [([x[waiting] for x in state], _edges(start, waiting), None)]
        at, owner = _edges(start, order[first])
        of, level, low, _ = (x[order[first]] for x in state)
        shift = treap.height - 1 - level
        half = 2 * (row[term[at]] >> shift[owner] & 1)
        for side in (0, 1):
            there, child, maximum = treap.child(node[at], most[at], half + side)
            begins = np.r_[0, np.cumsum(np.bincount(owner[there], minlength=len(of)))]
            total = np.r_[0, np.cumsum(weight[term[at[there]]] * maximum)]
            bound = total[begins[1:]] - total[begins[:-1]]
            column = 2 * low + side
            leaf = np.flatnonzero((shift == 0) & (bound >= best.least[of]))
            if len(leaf):
                best.add(of[leaf], bound[leaf], ids[column[leaf]], null[column[leaf]])
            inner = np.flatnonzero((shift > 0) & (bound >= best.least[of]))
            own, back = _edges(begins, inner)
            parts.append(([of[inner], level[inner] + 1, column[inner], bound[inner]], (own, back), (term[at[there]], child, maximum)))
        edges = [(own, back, *(x[own] for x in (arrays or (term, node, most)))) for _, (own, back), arrays in parts]
        sizes = np.concatenate([np.bincount(back, minlength=len(s[0])) for (s, _, _), (_, back, *_) in zip(parts, edges)])
        start = np.r_[0, np.cumsum(sizes)].astype(np.int64)
        term, node, most = (np.concatenate([e[n] for e in edges]) for n in (2, 3, 4))
        state = tuple(np.concatenate([s[n] for s, _, _ in parts]) for n in range(4))


def search(
    docs: DataFrame, items: DataFrame, *, k: int = K, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest scores above 0 for each item, ties by id.

    With N documents that have terms, L terms in all, n terms in a document, df documents that hold a term and tf
    occurrences in one: w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 75 + 25 n N div L, and a score sums
    w * (10^9 tf div (1000 tf + 12 m)) over the item's terms, repeats included."""
    terms = item_terms(items, item_id=item_id, text=item_text)
    index, documents, _ = build_index(docs, doc_id=doc_id, text=text, block_bytes=block_bytes)
    counts = stored(document_counts(index, terms.select("term").distinct()), "treap-counts")
    w = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1)))
    weighted = terms.join(counts, "term").select("item_id", "text_hash", F.struct("term", (w * F.col("times")).alias("weight")).alias("term"))
    per_item = weighted.groupBy("item_id", "text_hash").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    portions = math.ceil(terms.select("item_id", "text_hash").distinct().count() / ITEMS_TOGETHER)
    lists = per_item.groupBy(F.pmod(F.xxhash64("item_id", "text_hash"), F.lit(max(1, portions))).cast("int").alias("portion")).agg(
        F.collect_list(F.struct("item_id", "text_hash", "terms")).alias("items")
    )
    lists = stored(lists, "treap-portions")
    result = pa.schema([("item_id", pa.int64()), ("text_hash", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        for batch in batches:
            for path, portion, asked in zip(batch["path"].to_pylist(), batch["portion"].to_pylist(), batch["items"]):
                asked = asked.values
                listed = pc.struct_field(asked, "terms")
                each = listed.flatten()
                names, weight = pc.struct_field(each, "term").cast(pa.large_string()), pc.struct_field(each, "weight").to_numpy()
                item = np.repeat(np.arange(len(asked)), pc.list_value_length(listed).to_numpy())
                if portion not in found:
                    found[portion] = asked, Best(len(asked), k)
                arrays, about = read_block(path)
                at = pc.index_in(names, _terms_of(arrays))
                here = at.is_valid().to_numpy(zero_copy_only=False)
                row = at.drop_null().to_numpy().astype(np.int64)
                search_block(Treap(arrays, about["height"]), arrays["ids"], arrays["null_ids"], item[here], row, weight[here], found[portion][1])
        for asked, best in found.values():
            at = pa.array(best.item)
            yield batch_of(
                result, pc.struct_field(asked, "item_id").take(at), pc.struct_field(asked, "text_hash").take(at),
                pa.array(best.id, mask=best.null), best.score,
            )

    tasks = max(1, math.ceil(index.count() * max(1, portions) / BLOCKS_PER_TASK))
    work = _with_portions(index, portions).join(lists, "portion").select("path", "portion", "items")
    best = work.repartition(min(tasks, 10_000), "portion", F.pmod(F.xxhash64("path"), F.lit(max(1, tasks // max(1, portions)))))
    found = stored(best.mapInArrow(look, "item_id long, text_hash long, doc_id long, score long"), "treap-found")
    order = Window.partitionBy("item_id", "text_hash").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def op12_treap_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return search(docs, items)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents
), size AS (
  SELECT count(*) AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM d WHERE len(ws) > 0
), items AS (
  SELECT item_id, text, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), asked AS (
  SELECT item_id, text, term, count(*) AS times FROM items GROUP BY ALL
), postings AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(ws) AS n, unnest(ws) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, size GROUP BY term, n_docs
), scored AS (
  SELECT item_id, text, r, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), size
  GROUP BY item_id, text, r, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""
