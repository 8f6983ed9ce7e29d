"""SimHash near-duplicates with pigeonring filtering.

A fingerprint is 64 majority votes over the hashes of a text's word shingles. Cut into 8
segments around a ring, two fingerprints at most 3 bits apart must have a start segment from
which every chain of l segments differs by at most floor(l * 3 / 8) bits in all: the first
two segments agree, the next three differ in one bit at most, seven in two. Hence, from
that start, two of the three segments after the first two agree as well: a table keyed
by (start, first two segments, two of the next three) holds each linked pair together in
one bucket. Inside a bucket the chains are checked before the full distance.

Defined results: a null or empty text, or one without words, has fingerprint 0 and is linked
like any other; a text with fewer words than a shingle is one shingle; repeated rows share
fingerprint and component; a row without an id takes the component of its
fingerprint, which is null if no such row has an id; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webevents.llm.common import batch_of, stored
from webevents.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SEGMENTS = 8
WIDTH = 64 // SEGMENTS
#: Buckets of more distinct fingerprints are cut by further segments before they are compared.
BUCKET = 2048
#: Shingle hashes voted on at once.
VOTES = 1 << 16


def shingle_hashes(text: str | None, size: int = SHINGLE, seed: int = SEED) -> list[int]:
    """XXH64 of every shingle of ``size`` words, A-Z in lower case, repeats included."""
    words = (text or "").encode().lower().split()  # on bytes both touch ASCII only
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(b" ".join(words), seed)]
    return [digest(b" ".join(words[i : i + size]), seed) for i in range(len(words) - size + 1)]


def fingerprint(hashes: list[int]) -> int:
    """Bit i is 1 if more than half of the hashes have it."""
    votes = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), VOTES):
        some = np.array(hashes[i : i + VOTES], dtype="<u8")
        votes += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    ones = np.packbits((votes * 2 > len(hashes)).astype(np.uint8), bitorder="little")
    return int(ones.view("<u8")[0])


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp) per row; fp is the fingerprint's 64 bits as a signed long."""
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array(
                [fingerprint(shingle_hashes(t.as_py(), shingle)) for t in batch.column(1)], dtype=np.uint64
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    return docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`")).mapInArrow(run, f"id {id_type}, fp long")


def segment_mask(segments: list[int]) -> int:
    return sum(((1 << WIDTH) - 1) << (WIDTH * (s % SEGMENTS)) for s in segments)


def ring_masks(max_bits: int = MAX_BITS) -> list[int]:
    """Bits that must agree, one mask per start and pair of later segments (see above).

    The budgets floor(l * max_bits / 8) give the shape: ``agree`` first segments may not
    differ; up to ``reach`` segments, one bit may, so all later ones but one agree."""
    agree = max(n for n in range(SEGMENTS) if n * max_bits // SEGMENTS == 0)
    reach = max((n for n in range(SEGMENTS + 1) if n * max_bits // SEGMENTS <= 1), default=agree)
    later = range(agree, reach)
    return sorted({
        segment_mask([start + s for s in (*range(agree), *some)])
        for start in range(SEGMENTS)
        for some in combinations(later, max(len(later) - 1, 0))
    })


def split_masks(mask: int, max_bits: int = MAX_BITS) -> list[int]:
    """``mask`` and one of ``max_bits + 1`` equal shares of the bits it leaves open: of those
    shares at least one agrees too."""
    free = [i for i in range(64) if not mask >> i & 1]
    return [mask | sum(1 << i for i in free[part :: max_bits + 1]) for part in range(max_bits + 1)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near(a: np.ndarray, b: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Which pairs pass the ring's chains and then the full distance."""
    differ = (a ^ b).view(np.uint8).reshape(-1, SEGMENTS)
    counts = np.bitwise_count(differ)
    alive = np.ones((len(a), SEGMENTS), dtype=bool)
    chain = np.zeros((len(a), SEGMENTS), dtype=np.uint8)
    for length in range(1, SEGMENTS + 1):  # chains from every start, one segment longer each turn
        chain = chain + np.roll(counts, 1 - length, axis=1)
        alive &= chain <= length * max_bits // SEGMENTS
    passed = alive.any(axis=1)
    passed[passed] = counts[passed].sum(axis=1) <= max_bits
    return passed


def forest_of(fps: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links that connect what is connected in one bucket: a spanning forest, never all pairs.

    From each fingerprint reached, only those not yet reached are compared."""
    links, left = [], fps
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            at = reached.pop()
            close = np.bitwise_count(left ^ at) <= 2 * max_bits  # cheap bound before the chains
            close[close] = near(left[close], np.full(close.sum(), at, dtype=np.uint64), max_bits)
            links += [(int(at), int(x)) for x in left[close]]
            reached += list(left[close])
            left = left[~close]
    return links


def bucketed_links(rows: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) of rows (mask, key, fp), whose buckets are all small enough.

    Rows come sorted by bucket; only one bucket is held at a time."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def flush(parts: list[np.ndarray], links: list[tuple[int, int]]) -> None:
        fps = np.unique(np.concatenate(parts)).astype(np.int64).view(np.uint64) if parts else ()
        if len(fps) > 1:
            links += forest_of(fps, max_bits)

    def batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
        pairs = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return batch_of(schema, pairs[:, 0], pairs[:, 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parts, links = None, [], []
        for rows_ in batches:
            mask, key, fp = (c.to_numpy(zero_copy_only=False) for c in rows_.columns)
            if not len(fp):
                continue
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            for begin, end in zip([0, *cuts], [*cuts, len(fp)]):
                if (mask[begin], key[begin]) != last:
                    flush(parts, links)
                    last, parts = (mask[begin], key[begin]), []
                parts.append(fp[begin:end])
            if len(links) > 10_000:
                yield batch(links)
                links = []
        flush(parts, links)
        yield batch(links)

    return (
        rows.select("mask", "key", "fp").repartition("mask", "key").sortWithinPartitions("mask", "key")
        .mapInArrow(run, "a long, b long")
    )


def ring_links(distinct: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all fingerprints ``fp`` at most ``max_bits`` bits apart.

    Buckets of one row are dropped by a count that combines before its shuffle. A bucket
    larger than ``bucket`` is cut by the pigeonhole principle over its open bits until
    it is small; that ends, as n open bits hold 2^n distinct fingerprints at most.
    """
    masks = ring_masks(max_bits)
    keyed = distinct.select("fp", F.explode(F.array(*[F.lit(signed(m)) for m in masks])).alias("mask")).withColumn(
        "key", F.col("fp").bitwiseAND(F.col("mask"))
    )
    links = None
    while True:
        # a table of its own, so that adaptive execution can split the rows of a dense bucket
        sizes = stored(keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-sizes")
        shared = stored(keyed.join(sizes, ["mask", "key"]), "simhash-buckets")
        found = bucketed_links(shared.where(F.col("n") <= bucket), max_bits)
        links = found if links is None else links.unionByName(found)
        large = shared.where(F.col("n") > bucket)
        open_masks = [r[0] for r in large.select("mask").distinct().collect()]  # a few dozen constants
        if not open_masks:
            return links
        cuts = F.create_map(*[
            c for m in open_masks
            for c in (F.lit(m), F.array(*[F.lit(signed(x)) for x in split_masks(m & (1 << 64) - 1, max_bits)]))
        ])
        keyed = (
            large.select("fp", F.explode(F.element_at(cuts, F.col("mask"))).alias("mask"))
            .withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
            .distinct()
        )


def near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
    shingle: int = SHINGLE, max_bits: int = MAX_BITS,
) -> DataFrame:
    """(id, fp, component) per row of ``docs``; component is the smallest id reachable over links."""
    fps = stored(fingerprints(docs, doc_id=doc_id, text=text, shingle=shingle), "simhash")
    classes = stored(fps.groupBy("fp").agg(F.min("id").alias("first")), "simhash-classes")
    links = ring_links(classes.select("fp"), max_bits)
    linked = components(links, "simhash-links")
    of_fp = (
        classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
        .withColumn("root", F.coalesce("root", "fp"))
    )
    of_fp = stored(of_fp, "simhash-roots")
    smallest = stored(of_fp.groupBy("root").agg(F.min("first").alias("component")), "simhash-components")
    names = of_fp.join(smallest, "root").select("fp", "component")
    return fps.join(names, "fp").select("id", "fp", "component")


def op5_simhash_ring(docs: DataFrame) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return near_duplicates(docs).select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
