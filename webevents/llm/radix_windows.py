"""Repeated byte strings by a depth-limited radix sort of suffixes.

Two suffixes share their first ``length`` bytes exactly if they fall into one group when
suffixes are ordered through ``length`` bytes only. The order is made digit by digit, the
most significant first, and only groups of two or more go on to the next digit:

1. The first digit of a suffix is the gram of ``length - WIDTHS[0] + 1`` bytes with the smallest hash
   in its window. It is a function of the window alone, so equal windows agree in it, and
   neighbouring windows share it: one row stands for a run of up to ``WIDTHS[0]`` suffixes. Rows are
   range-sorted by (gram, whole content of the run): equal content means that all windows of
   the run repeat, a gram alone in the order that none does.
2. Runs in between are cut into blocks of 16 windows, sorted by (bytes that all windows of the
   block share, content of the block).
3. What is still open is sorted window by window: equal groups are the repeated windows.

Runs never need to be compared in pairs: a row looks at its two neighbours in the order. The
order is made by range partitions, which cut a group of any size over as many tasks as it fills.

Rows equal in id and text are one class: a class of two or more repeats wholly, which needs no look at
its windows, and one row of it takes part in the order for the others' sake.

Defined results: a null text is empty; texts shorter than ``length`` have no windows; repeated
rows repeat each other wholly; a null id is an id like any other; other columns are not read.
Hashes stand for content: 128 bits of it at every digit, and 64 bits beside the id for a row's whole text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from webevents.llm.common import batch_of, stored

LENGTH = 400
#: Windows that one row stands for, digit by digit.
WIDTHS = (128, 16, 1)
#: Bytes whose windows are looked at together.
SPAN = 1 << 20

# A place in one long: 32 bits of the first window's begin, 7 bits of windows - 1, 7 bits of the
# gram's begin in the first window. The text's whole hash, which tells rows of one id apart, is a column beside it.
BEGIN_BITS, SMALL_BITS = 32, 7

SORTED = "core long, hull long, doc long, text_hash long, place long, own boolean"


def pack(begin: np.ndarray, windows: np.ndarray, gram: np.ndarray) -> np.ndarray:
    return begin.astype(np.int64) << 2 * SMALL_BITS | (windows - 1).astype(np.int64) << SMALL_BITS | gram.astype(np.int64)


def unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, windows and the gram's offset."""
    small = (1 << SMALL_BITS) - 1
    return (place >> 2 * SMALL_BITS) & ((1 << BEGIN_BITS) - 1), ((place >> SMALL_BITS) & small) + 1, place & small


def text_hash_column(text: Column) -> Column:
    return F.xxhash64(text)


class Grams:
    """Smallest grams of windows, by a rolling hash modulo 2^64 whose base has an inverse."""

    def __init__(self, length: int, width: int):
        self.length, self.width, self.gram = length, width, length - width + 1
        rng = np.random.default_rng(400)
        self.value = rng.integers(1, 2**63, 256, dtype=np.uint64)
        base, size = 0x9E3779B97F4A7C15, SPAN + 2 * length
        self.power = self._powers(base, size)
        self.inverse = self._powers(pow(base, -1, 1 << 64), size)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def of_windows(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every window begin: its smallest gram's begin, and that gram's hash."""
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.value[data] * self.power[: len(data)], out=sums[1:])
        grams = (sums[self.gram :] - sums[: -self.gram]) * self.inverse[: len(data) - self.gram + 1]
        grams ^= grams >> np.uint64(32)
        grams *= np.uint64(0xD6E8FEB86659FD93)
        grams ^= grams >> np.uint64(29)
        # smallest hash (40 bits of it), and of equal ones the last: never a tie
        low = np.uint64((1 << 24) - 1)
        order = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
        # sliding minimum: of a block's end and the next block's beginning
        w = self.width
        blocks = np.concatenate([order, np.full(-len(order) % w, 2**64 - 1, dtype=np.uint64)]).reshape(-1, w)
        forward = np.minimum.accumulate(blocks, axis=1).ravel()
        backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(grams) - w + 1
        smallest = np.minimum(backward[:n], forward[w - 1 : w - 1 + n])
        at = (low - (smallest & low)).astype(np.int64)
        return at, grams[at]


_grams: dict[tuple[int, int], Grams] = {}


def grams_of(length: int, width: int) -> Grams:
    """This worker's tables for the lengths."""
    if (length, width) not in _grams:
        _grams[length, width] = Grams(length, width)
    return _grams[length, width]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each value begins (and the last ends)."""
    texts = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs_of(data: np.ndarray, starts: np.ndarray, length: int, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows with one smallest gram: document, begin, windows, gram's offset, gram's hash, hash of the content."""
    grams, digest, whole = grams_of(length, width), xxhash.xxh3_64_intdigest, memoryview(data)
    n_windows = len(data) - length + 1
    for begin in range(0, n_windows, SPAN):
        end = min(begin + SPAN, n_windows)
        at, key = grams.of_windows(data[begin : end + length - 1])
        window = np.arange(begin, end)
        doc = np.searchsorted(starts, window, "right") - 1
        inside = window + length <= starts[doc + 1]
        window, doc, at, key = window[inside], doc[inside], at[inside], key[inside]
        if not len(window):
            continue
        cut = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 0) | (np.diff(window) != 1) | (np.diff(doc) != 0))))
        first, last = window[cut], window[np.concatenate((cut[1:] - 1, [len(window) - 1]))]
        hull = [digest(whole[a : b + length]) for a, b in zip(first.tolist(), last.tolist())]
        yield (
            doc[cut], first - starts[doc[cut]], last - first + 1, at[cut] + begin - first,
            key[cut].view(np.int64), np.array(hull, dtype=np.uint64).view(np.int64),
        )


def first_digit(docs: DataFrame, length: int) -> DataFrame:
    """Rows to sort by the first digit, from (doc, text_hash, text)."""
    schema = pa.schema([
        ("core", pa.int64()), ("hull", pa.int64()), ("doc", pa.int64()), ("text_hash", pa.int64()), ("place", pa.int64()), ("own", pa.bool_()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = text_bytes(batch.column("text"))
            for doc, begin, windows, gram, key, hull in runs_of(data, starts, length, WIDTHS[0]):
                rows = pa.array(doc)
                yield batch_of(
                    schema, key, hull, batch.column("doc").take(rows), batch.column("text_hash").take(rows),
                    pack(begin, windows, gram), np.ones(len(doc), dtype=bool),
                )

    return docs.mapInArrow(run, SORTED)


def next_digit(texts: DataFrame, length: int, coarse: int, width: int) -> DataFrame:
    """Rows to sort by the next digit: the open runs of (doc, text_hash, text, places, owns), of up to
    ``coarse`` windows each, in blocks of ``width`` windows aligned to the gram."""
    schema = pa.schema([
        ("core", pa.int64()), ("hull", pa.int64()), ("doc", pa.int64()), ("text_hash", pa.int64()), ("place", pa.int64()), ("own", pa.bool_()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for doc, text_hash, text, places, owns in zip(*(batch.column(c) for c in ("doc", "text_hash", "text", "places", "owns"))):
                data = memoryview((text.as_py() or "").encode())
                cores, hulls, begins, counts, grams, own = [], [], [], [], [], []
                for begin, windows, gram, mine in zip(*(x.tolist() for x in unpack(places.values.to_numpy())), owns.as_py()):
                    anchor = begin + gram
                    for block in range((gram - windows + 1) // width, gram // width + 1):
                        # windows by how far they begin before the gram: nearest to furthest
                        near, far = max(block * width, gram - windows + 1), min(block * width + width - 1, gram)
                        a, b = anchor - far, anchor - near + length
                        shared = data[anchor - block * width : anchor - block * width - width + 1 + length]
                        cores.append(digest(shared, 1))
                        hulls.append(digest(data[a:b], 2))
                        begins.append(a)
                        counts.append(far - near + 1)
                        grams.append(far)
                        own.append(mine)
                if begins:
                    n = len(begins)
                    yield batch_of(
                        schema, np.array(cores, dtype=np.uint64).view(np.int64), np.array(hulls, dtype=np.uint64).view(np.int64),
                        pa.array([doc.as_py()] * n, pa.int64()), np.full(n, text_hash.as_py()),
                        pack(*(np.array(x, dtype=np.int64) for x in (begins, counts, grams))), own,
                    )

    return texts.select("doc", "text_hash", "text", "places", "owns").mapInArrow(run, SORTED)


VERDICTS = "doc long, text_hash long, place long, own boolean, core long, hull long, full boolean, open boolean, leads boolean, part long, edge int"


def in_order(rows: DataFrame, label: str) -> DataFrame:
    """Sort ``rows`` by (core, hull) and judge each by its neighbours; rows alone in their core go.

    full: some other row has the same content; open: only the same core; leads: the first of
    its content. Neighbours across two range partitions are compared at the end, from two
    rows per partition."""
    schema = pa.schema([
        ("doc", pa.int64()), ("text_hash", pa.int64()), ("place", pa.int64()), ("own", pa.bool_()), ("core", pa.int64()), ("hull", pa.int64()),
        ("full", pa.bool_()), ("open", pa.bool_()), ("leads", pa.bool_()), ("part", pa.int64()), ("edge", pa.int32()),
    ])

    def judge(batch: pa.RecordBatch, before: tuple | None, after: tuple | None, part: int) -> pa.RecordBatch:
        core, hull = (batch.column(i).to_numpy() for i in (0, 1))
        n = len(core)
        same_core, same_hull = np.zeros(n + 1, dtype=bool), np.zeros(n + 1, dtype=bool)  # with the row before
        same_core[1:n] = core[1:] == core[:-1]
        same_hull[1:n] = same_core[1:n] & (hull[1:] == hull[:-1])
        for i, other, own in ((0, before, 0), (n, after, n - 1)):
            if other is not None:
                same_core[i] = other[0] == core[own]
                same_hull[i] = same_core[i] and other[1] == hull[own]
        full = same_hull[:n] | same_hull[1:]
        some = same_core[:n] | same_core[1:]
        edge = np.zeros(n, dtype=np.int32)
        edge[0] += before is None
        edge[-1] += 2 * (after is None)
        keep = pa.array(some | (edge > 0))
        out = batch_of(
            schema, batch.column(2), batch.column(3), batch.column(4), batch.column(5), core, hull,
            full, some & ~full, ~same_hull[:n], np.full(n, part), edge,
        )
        return out.filter(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, before = TaskContext.get().partitionId(), None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield judge(held, before, (batch.column(0)[0].as_py(), batch.column(1)[0].as_py()), part)
                before = (held.column(0)[-1].as_py(), held.column(1)[-1].as_py())
            held = batch
        if held is not None:
            yield judge(held, before, None, part)

    keys = ["core", "hull", "doc", "text_hash", "place"]
    rows = stored(rows, f"{label}-rows")  # a range partition reads its input twice; hashing the texts costs more than that
    judged = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, VERDICTS), label)
    edges = sorted(judged.where("edge > 0").collect(), key=lambda r: (r["part"], r["edge"]))  # two rows per partition at most
    edges = [r.asDict() for r in edges]
    for a, b in zip(edges, edges[1:]):
        if a["part"] != b["part"] and a["core"] == b["core"]:
            if a["hull"] == b["hull"]:
                a["full"] = b["full"] = True
                b["leads"] = False
            else:
                a["open"] = b["open"] = True
    for r in edges:
        r["open"] = r["open"] and not r["full"]
    mended = [tuple(r.values()) for r in edges if r["full"] or r["open"]]
    mended = judged.sparkSession.createDataFrame(mended, judged.schema)
    return judged.where("edge = 0").unionByName(mended)


def listed(verdicts: DataFrame, last: bool) -> DataFrame:
    """Per (doc, text_hash): ``fulls``, places known to repeat, and ``opens`` / ``owns``, places for the next digit.

    Open are runs that only share their core, and beside them one run of every content
    that repeats (``leads``), as far as it shares the core of an open one."""
    fulls = verdicts.where("full AND own").select("doc", "text_hash", F.col("place").alias("full"), F.lit(None).cast("long").alias("open"), "own")
    if last:
        every = fulls
    else:
        unsettled = stored(verdicts.where("open AND own").select("core").distinct(), "windows-open")
        others = verdicts.where("(open AND NOT own) OR (full AND leads)").join(unsettled, "core", "left_semi")
        nothing = F.lit(None).cast("long").alias("full")
        every = (
            fulls
            .unionByName(verdicts.where("open AND own").select("doc", "text_hash", nothing, F.col("place").alias("open"), "own"))
            .unionByName(others.select("doc", "text_hash", nothing, F.col("place").alias("open"), F.lit(False).alias("own")))
        )
    return every.groupBy("doc", "text_hash").agg(
        F.collect_list("full").alias("fulls"),
        F.collect_list(F.when(F.col("open").isNotNull(), F.struct("open", "own"))).alias("opens"),
    )


def covered(places: np.ndarray, length: int) -> np.ndarray:
    """Maximal runs (begin, end) of bytes under the windows of ``places``."""
    begin, windows, _ = unpack(np.sort(places))
    if not len(begin):
        return np.zeros((0, 2), dtype=np.int64)
    end = np.maximum.accumulate(begin + windows - 1 + length)
    cut = np.flatnonzero(np.concatenate(([True], begin[1:] > end[:-1])))
    return np.column_stack([begin[cut], end[np.concatenate((cut[1:] - 1, [len(end) - 1]))]])


def kept_bytes(data: bytes, spans: np.ndarray) -> bytes:
    cuts = [0, *spans.ravel().tolist(), len(data)]
    return b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2]))


def same_class() -> Column:
    """Condition that a row belongs to the class (``_doc``, ``_hash``) of another table."""
    return F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))


def cut_repeats(
    docs: DataFrame, result: Callable[[bytes, np.ndarray], tuple], schema: str, *, doc_id: str = "doc_id",
    text: str = "text", length: int = LENGTH,
) -> DataFrame:
    """``result`` (of ``schema``) of each document's bytes and its removed spans, beside ``doc_id``."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text")).withColumn(
        "text_hash", text_hash_column(F.coalesce("text", F.lit("")))
    )
    classes = rows.groupBy(F.col("doc").alias("_doc"), F.col("text_hash").alias("_hash")).agg(F.count("*").alias("_copies"))
    classes = stored(classes.where(F.col("_copies") > 1), "windows-classes")
    if classes.isEmpty():
        return cut_classes(rows, result, schema, length).select(F.col("doc").alias(doc_id), "result.*")
    # a class's copies meet its one row in a join that adaptive execution can split
    split = rows.join(classes, same_class(), "left")
    copies = split.where(F.col("_copies").isNotNull()).select("doc", "text_hash", "text")
    alone = split.where(F.col("_copies").isNull()).select("doc", "text_hash", "text")
    others = cut_classes(alone.unionByName(copies.dropDuplicates(["doc", "text_hash"])), result, schema, length)
    others = others.join(classes, same_class(), "left_anti").select("doc", "result")
    names = T.StructType.fromDDL(schema).names
    out_schema = pa.schema([("doc", pa.int64()), ("result", to_arrow_type(T.StructType.fromDDL(schema)))])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for value in batch.column(1).cast(pa.large_binary()).to_pylist():
                data = value or b""
                spans = np.array([[0, len(data)]] if len(data) >= length else [], dtype=np.int64).reshape(-1, 2)
                found.append(dict(zip(names, result(data, spans))))
            yield batch_of(out_schema, batch.column(0), pa.array(found, out_schema[1].type))

    repeated = copies.select("doc", "text").mapInArrow(whole, T.StructType.fromDDL(f"doc long, result struct<{struct_fields(schema)}>"))
    return others.unionByName(repeated).select(F.col("doc").alias(doc_id), "result.*")


def struct_fields(schema: str) -> str:
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in T.StructType.fromDDL(schema))


def cut_classes(rows: DataFrame, result: Callable[[bytes, np.ndarray], tuple], schema: str, length: int) -> DataFrame:
    """(doc, text_hash, result) of ``rows`` (doc, text, text_hash), no two of which agree in both.

    The text is shuffled once; documents with open runs, which are few, are kept aside
    with their texts until the last digit."""
    spark_schema = T.StructType.fromDDL(schema)
    met = rows.join(
        listed(in_order(first_digit(rows, length), "windows-1"), last=False)
        .withColumnsRenamed({"doc": "_doc", "text_hash": "_hash"}),
        same_class(), "left",
    ).select("doc", "text_hash", "text", "fulls", "opens")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Results of documents without open runs of their own; texts of those with open runs."""
        for batch in batches:
            out = [[] for _ in range(7)]
            for doc, text_hash, value, fulls, opens in zip(*(c.to_pylist() for c in batch.columns)):
                opens, fulls = opens or [], fulls or []
                settled = not any(o["own"] for o in opens)
                data = (value or "").encode()
                found = result(data, covered(np.array(fulls, dtype=np.int64), length)) if settled else None
                for column, x in zip(out, (
                    doc, text_hash, value if opens else None, None if settled else fulls,
                    [o["open"] for o in opens], [o["own"] for o in opens],
                    None if found is None else dict(zip(spark_schema.names, found)),
                )):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, settle_schema)], schema=settle_schema)

    result_ddl = f"result struct<{struct_fields(schema)}>"
    settled_ddl = f"doc long, text_hash long, text string, fulls array<long>, places array<long>, owns array<boolean>, {result_ddl}"
    settle_schema = pa.schema([
        ("doc", pa.int64()), ("text_hash", pa.int64()), ("text", pa.string()), ("fulls", pa.list_(pa.int64())),
        ("places", pa.list_(pa.int64())), ("owns", pa.list_(pa.bool_())), ("result", to_arrow_type(spark_schema)),
    ])
    kept = stored(met.mapInArrow(settle, settled_ddl), "windows-texts")
    texts = kept.where("text IS NOT NULL")
    extra = None
    for coarse, width in zip(WIDTHS, WIDTHS[1:]):
        last = width == WIDTHS[-1]
        lists = stored(listed(in_order(next_digit(texts, length, coarse, width), f"windows-{width}"), last), "windows-lists")
        found = lists.where(F.size("fulls") > 0).select("doc", "text_hash", "fulls")
        extra = found if extra is None else extra.unionByName(found)
        if not last:
            again = lists.where(F.size("opens") > 0).select(
                F.col("doc").alias("_doc"), F.col("text_hash").alias("_hash"),
                F.col("opens.open").alias("places"), F.col("opens.own").alias("owns"),
            )
            texts = texts.select("doc", "text_hash", "text").join(again, same_class())
    extra = extra.groupBy(F.col("doc").alias("_doc"), F.col("text_hash").alias("_hash")).agg(
        F.flatten(F.collect_list("fulls")).alias("more")
    )
    unsettled = kept.where("result IS NULL").join(
        extra, same_class(), "left"
    ).select("doc", "text_hash", "text", "fulls", "more")
    out_schema = pa.schema([("doc", pa.int64()), ("text_hash", pa.int64()), ("result", to_arrow_type(spark_schema))])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for value, fulls, more in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                spans = covered(np.array((fulls or []) + (more or []), dtype=np.int64), length)
                found.append(dict(zip(spark_schema.names, result((value or "").encode(), spans))))
            yield batch_of(out_schema, batch.column(0), batch.column(1), pa.array(found, out_schema[2].type))

    finished = unsettled.mapInArrow(finish, f"doc long, text_hash long, {result_ddl}")
    return kept.where("result IS NOT NULL").select("doc", "text_hash", "result").unionByName(finished)


def op4_radix_windows(docs: DataFrame) -> DataFrame:
    """Sizes and digest of what each document keeps."""

    def digest(data: bytes, spans: np.ndarray) -> tuple:
        kept = kept_bytes(data, spans)
        return len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()

    return cut_repeats(docs, digest, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")
