"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors are scaled and given one more coordinate so that the largest inner product is the
smallest distance. Each table hashes them by Gaussian projections, made orthogonal, cut into slots; there are more
of them the more vectors there are, so that the share of all vectors that a query's buckets hold falls. A query visits
its own bucket and perturbed ones in the order of their estimated success (the chance that
a neighbour at a typical distance falls there) until the chances add up to a target. The
candidates of all tables are merged and ranked by their exact inner products.

Defined results: vectors that are null, empty, zero, hold null or non-finite components, or have
another length than most, and rows without an id take no part. Equal vectors are searched once
and share results; ties go to the smaller id. A query that finds fewer than ``k``
candidates is compared with all vectors instead. Repeated rows count once; other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webevents.llm.common import batch_of, hash_share, stored

K = 20
TABLES = 12
#: Estimated chance that one table's probes hold a neighbour at a typical distance. The nearer ones have more,
#: and twelve tables together hold nine of ten.
SUCCESS = 0.17
#: Width of a slot, for directions of all kinds in standard deviations of a projection, and projections per table
#: for each factor of e in the number of vectors.
SLOT = 3.0
HASHES_PER_LOG = 1.3
#: Vectors the index is fitted on, chosen by hash.
FIT_ROWS = 2048
#: A part holds about so many vectors, a batch so many queries.
PART_ROWS = 32_768
QUERY_ROWS = 256
#: Sets of slots weighed at a time, and probes of a query in a table at most.
PROBE_CELLS = 1 << 19
MOST_SETS = 1 << 16


@dataclass
class Index:
    projections: np.ndarray  # (tables, hashes, dimension + 1)
    shifts: np.ndarray  # (tables, hashes)
    mixers: np.ndarray  # (hashes,) odd multipliers that make one number of a bucket's slots
    slot: float
    norm: float  # largest norm
    reach: float  # typical distance of a neighbour
    success: float

    def raised(self, vectors: np.ndarray, queries: bool) -> np.ndarray:
        """The vectors in the space where distance orders by inner product."""
        if queries:
            return np.column_stack([vectors / np.linalg.norm(vectors, axis=1, keepdims=True), np.zeros(len(vectors))])
        scaled = vectors / self.norm
        return np.column_stack([scaled, np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1)))])

    def codes(self, table: int, slots: np.ndarray) -> np.ndarray:
        mixed = (slots.astype(np.int64).view(np.uint64) * self.mixers).sum(axis=-1, dtype=np.uint64)
        mixed ^= mixed >> np.uint64(31)
        return (mixed * np.uint64(0x9E3779B97F4A7C15) + np.uint64(table)).view(np.int64)

    def place(self, table: int, raised: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots of each vector, and how far into the slot it lies."""
        at = raised @ self.projections[table].T + self.shifts[table]
        slots = np.floor(at / self.slot)
        return slots.astype(np.int64), at - slots * self.slot

    def probes(self, table: int, slots: np.ndarray, inside: np.ndarray) -> list[np.ndarray]:
        """For each query the codes of the buckets to visit, likeliest first, until their chances reach ``success``."""
        steps = np.arange(-2, 3)
        edges = (np.arange(-2, 4) * self.slot - inside[:, :, None]) / (self.reach * math.sqrt(2))
        chance = np.diff(0.5 * (1 + _erf(edges)), axis=2)
        out, left, most = [np.zeros(0, np.int64)] * len(slots), np.arange(len(slots)), 64
        while len(left):
            waiting = []
            group = max(1, PROBE_CELLS // (most * len(steps)))
            for own in np.split(left, range(group, len(left), group)):
                sets, reached, whole = likeliest(chance[own], most)
                done = whole | (most >= MOST_SETS) | (reached[:, -1] >= min(self.success, 0.99))
                waiting.append(own[~done])
                for q in np.flatnonzero(done):
                    n = int(np.searchsorted(reached[q], self.success)) + 1
                    out[own[q]] = self.codes(table, slots[own[q]] + steps[sets[q, :n]])
            left, most = np.concatenate(waiting), 4 * most
        return out

    def group(self, codes: np.ndarray, groups: int) -> np.ndarray:
        """The group of parts that holds a bucket."""
        mixed = (codes.view(np.uint64) ^ np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x165667B19E3779F9)
        return ((mixed >> np.uint64(33)) % np.uint64(groups)).astype(np.int64)


def likeliest(chance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """For each query the ``most`` likeliest sets of one step per hash, from the steps' chances (queries, hashes,
    steps), likeliest first; the sums of their chances; and whether these are all sets there are.

    The likeliest n sets extend the likeliest n of one hash less, so pruning is exact."""
    queries, hashes, steps = chance.shape
    chances, sets = np.ones((queries, 1)), np.zeros((queries, 1, 0), dtype=np.int8)
    for h in range(hashes):
        grown = (chances[:, :, None] * chance[:, h, None, :]).reshape(queries, -1)
        if grown.shape[1] > most:
            best = np.argpartition(-grown, most - 1, axis=1)[:, :most]
        else:
            best = np.broadcast_to(np.arange(grown.shape[1]), grown.shape)
        chances = np.take_along_axis(grown, best, 1)
        parents = np.take_along_axis(sets, (best // steps)[:, :, None], 1)
        sets = np.concatenate([parents, (best % steps)[:, :, None].astype(np.int8)], axis=2)
    order = np.argsort(-chances, axis=1, kind="stable")
    reached = np.cumsum(np.take_along_axis(chances, order, 1), axis=1)
    return np.take_along_axis(sets, order[:, :, None], 1), reached, chances.shape[1] == steps**hashes


_erf = np.vectorize(math.erf, otypes=[float])


def projections(rng: np.random.Generator, tables: int, hashes: int, dimension: int) -> np.ndarray:
    """Gaussian directions, orthogonal within a table and, as far as the dimension allows, between tables."""
    rotations = []
    for _ in range(math.ceil(tables / (dimension // hashes))):
        rotation = np.linalg.qr(rng.normal(size=(dimension, dimension)))[0] * math.sqrt(dimension)
        rotations += [rotation[:, i : i + hashes].T for i in range(0, dimension - hashes + 1, hashes)]
    return np.stack(rotations[:tables])


def fit_index(sample: np.ndarray, rows: int, norm: float, *, tables: int, k: int, success: float, seed: int = 9) -> Index:
    """Projections, and the typical distance of a neighbour as a bounded sample shows it."""
    rng = np.random.default_rng(seed)
    dimension = sample.shape[1] + 1
    hashes = min(max(2, round(HASHES_PER_LOG * math.log(max(rows, 2)))), dimension)
    index = Index(
        projections(rng, tables, hashes, dimension), rng.uniform(size=(tables, hashes)),
        rng.integers(1, 2**62, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1), SLOT, norm, 1.0, success,
    )
    points, queries = index.raised(sample, False), index.raised(sample[:256], True)
    apart = np.sqrt(np.maximum(0, 2 - 2 * queries @ points.T))
    # in units of what a projection tells two vectors apart by: sqrt(2) for directions of all kinds
    index.slot = max(SLOT * float(np.median(apart)) / math.sqrt(2), 1e-3)
    index.shifts *= index.slot
    nth = min(max(1, math.ceil(k * len(sample) / max(rows, 1))), len(sample) - 1)  # after the query itself
    index.reach = max(float(np.quantile(np.sort(apart, axis=1)[:, nth], 0.5)), 1e-3)
    return index


def matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


PLACED = "part long, kind int, id long, table int, code long, codes array<long>, vector array<double>"
PLACED_SCHEMA = pa.schema([
    ("part", pa.int64()), ("kind", pa.int32()), ("id", pa.int64()), ("table", pa.int32()), ("code", pa.int64()),
    ("codes", pa.list_(pa.int64())), ("vector", pa.list_(pa.float64())),
])


def place_vectors(classes: DataFrame, index: Index, groups: int, slices: int) -> DataFrame:
    """A row per vector and table, in the part of its bucket; large buckets are cut by id into slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, raised = batch.column(0).to_numpy(), index.raised(matrix(batch.column(1)), False)
                for table in range(len(index.shifts)):
                    codes = index.codes(table, index.place(table, raised)[0])
                    part = index.group(codes, groups) * slices + ids % slices
                    n = len(ids)
                    yield batch_of(
                        PLACED_SCHEMA, part, np.zeros(n, np.int32), batch.column(0), np.full(n, table, np.int32), codes,
                        pa.nulls(n, pa.list_(pa.int64())), batch.column(1),
                    )

    return classes.select("id", "vector").mapInArrow(run, PLACED)


def bucket_sizes(classes: DataFrame, index: Index) -> DataFrame:
    schema = pa.schema([("code", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raised = index.raised(matrix(batch.column(0)), False)
                for table in range(len(index.shifts)):
                    yield batch_of(schema, index.codes(table, index.place(table, raised)[0]))

    return classes.select("vector").mapInArrow(run, "code long").groupBy("code").count()


def visited(index: Index, raised: np.ndarray) -> list[np.ndarray]:
    """For each query the codes of all buckets that it visits."""
    out: list[list[np.ndarray]] = [[] for _ in raised]
    for begin in range(0, len(raised), QUERY_ROWS):
        part = raised[begin : begin + QUERY_ROWS]
        for table in range(len(index.shifts)):
            for i, codes in enumerate(index.probes(table, *index.place(table, part))):
                out[begin + i].append(codes)
    return [np.concatenate(codes) for codes in out]


def place_queries(queries: DataFrame, index: Index, groups: int, slices: int) -> DataFrame:
    """A row per query and part to visit, with the buckets to visit there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, vectors = batch.column(0).to_pylist(), matrix(batch.column(1))
            raised = index.raised(vectors, True)
            visits = visited(index, raised)
            for i, (name, codes) in enumerate(zip(ids, visits)):
                group = index.group(codes, groups)
                order = np.argsort(group, kind="stable")
                codes, group = codes[order], group[order]
                cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
                lists = [c.tolist() for c in np.split(codes, cuts[1:])]
                parts = (group[cuts][:, None] * slices + np.arange(slices)).ravel()
                n = len(parts)
                yield batch_of(
                    PLACED_SCHEMA, parts, np.ones(n, np.int32), np.full(n, name), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
                    [c for c in lists for _ in range(slices)], [vectors[i].tolist()] * n,
                )

    return queries.select("id", "vector").mapInArrow(run, PLACED)


def nearest_in_parts(rows: DataFrame, k: int) -> DataFrame:
    """Best ``k`` candidates per part and query of placed rows.

    A part's vectors (kind 0) come first, sorted by bucket, and are held; its queries (kind 1)
    follow in batches. A query without buckets is compared with the whole part."""
    schema = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])

    def score(vectors: np.ndarray, ids: np.ndarray, buckets: dict, batch: pa.RecordBatch) -> pa.RecordBatch:
        names, points = batch.column("id").to_pylist(), matrix(batch.column("vector"))
        scores = np.full((len(names), len(ids)), -np.inf)
        visits: dict[int, list[int]] = {}
        for i, codes in enumerate(batch.column("codes").to_pylist()):
            if codes is None:
                scores[i] = vectors @ points[i]
            else:
                for code in codes:
                    if code in buckets:
                        visits.setdefault(code, []).append(i)
        for code, who in visits.items():
            scores[who, buckets[code]] = points[who] @ vectors[buckets[code]].T
        out = [], [], []
        for i, name in enumerate(names):
            row = scores[i]
            best = np.flatnonzero(row > -np.inf)
            if len(best) > k:  # keep all that tie with the k-th up to rounding; the exact scores decide
                least = np.partition(row[best], len(best) - k)[len(best) - k]
                best = best[row[best] >= least - 1e-9 * max(1.0, abs(least))]
            exact = (vectors[best] * points[i]).sum(axis=1)  # in an order of its own, whatever the part holds
            # a vector found in two tables counts once
            _, first = np.unique(ids[best], return_index=True)
            best, exact = best[first], exact[first]
            top = np.lexsort((ids[best], -exact))[:k]
            out[0].extend([name] * len(top))
            out[1].extend(ids[best[top]].tolist())
            out[2].extend(exact[top].tolist())
        return batch_of(schema, *out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, ready = None, [], None
        for batch in batches:
            keys = batch.column("part").to_numpy() * 2 + batch.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                piece = batch.slice(begin, end - begin)
                if keys[begin] // 2 != part:
                    part, held, ready = keys[begin] // 2, [], None
                if keys[begin] % 2 == 0:
                    held.append((piece.column("id").to_numpy(), piece.column("code").to_numpy(), matrix(piece.column("vector"))))
                    continue
                if not held:
                    continue
                if ready is None:
                    ids, codes, vectors = (np.concatenate(x) for x in zip(*held))
                    ends = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
                    ready = vectors, ids, {int(codes[a]): slice(a, b) for a, b in zip(ends, ends[1:])}
                    held = [True]
                for at in range(0, piece.num_rows, QUERY_ROWS):
                    yield score(*ready, piece.slice(at, QUERY_ROWS))

    return (
        rows.repartition("part").sortWithinPartitions("part", "kind", "code")
        .mapInArrow(run, "query long, id long, score double")
    )


def search(
    vectors: DataFrame, is_query: Column, *, vec_id: str = "vec_id", vector: str = "embedding", k: int = K,
    tables: int = TABLES, success: float = SUCCESS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best found for each row where ``is_query`` holds.

    Equal vectors form a class with the smallest id's name; only classes are hashed, and only the
    ``k + 1`` smallest ids of a class can matter, so a vector that a third of all rows share is
    one. Buckets are dealt to parts by hash; if the largest one is too much for a part, all are
    cut by id into slices that a query visits each, so a dense region fills no task."""
    x = F.col("vector")
    usable = (
        vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"), is_query.alias("asks"))
        .where(F.col("id").isNotNull() & x.isNotNull() & (F.size(x) > 0))
        .where(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0))
        .select("id", "asks", "vector", F.size(x).alias("length"), F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(1), x).alias("h2"))
    )
    common = usable.groupBy("length").count().orderBy(F.desc("count"), "length").first()
    if common is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = usable.where(F.col("length") == common["length"])
    classes = stored(
        usable.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.any_value("vector").alias("vector"), F.bool_or(F.coalesce("asks", F.lit(False))).alias("asks")),
        "ann-classes",
    )
    rows, norm = classes.agg(F.count("*"), F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v)))).first()
    sample = classes.where(hash_share(rows, FIT_ROWS, "h1", "h2")).select("id", "vector").orderBy("id").collect()
    sample = sample or classes.select("id", "vector").orderBy("id").limit(FIT_ROWS).collect()
    index = fit_index(np.array([r["vector"] for r in sample]), rows, norm, tables=tables, k=k, success=success)

    # the largest bucket decides into how many slices all are cut: a scalar, not a table
    largest = bucket_sizes(classes, index).agg(F.max("count")).first()[0]
    slices = math.ceil(largest / PART_ROWS)
    groups = math.ceil(rows * tables / PART_ROWS)
    held = stored(place_vectors(classes, index, groups, slices), "ann-parts")
    asking = classes.where("asks").select("id", "vector")
    visits = place_queries(asking, index, groups, slices)
    found = stored(nearest_in_parts(held.unionByName(visits), k + 1), "ann-found")

    members = usable.select("h1", "h2", F.col("id").alias("member"), "asks").distinct().join(
        classes.select("h1", "h2", "id"), ["h1", "h2"]
    )
    members = stored(members.select("id", "member", "asks"), "ann-members")
    first = F.row_number().over(Window.partitionBy("id").orderBy("member"))
    smallest = members.select("id", "member", first.alias("n")).where(F.col("n") <= k + 1).select(F.col("id").alias("class"), "member")
    askers = members.where("asks").select(F.col("id").alias("query"), F.col("member").alias("query_id"))

    def ranked(found: DataFrame) -> DataFrame:
        best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
        top = (
            found.distinct().withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
            .select("query", F.col("id").alias("class"), "score")
        )
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "member")
        return (
            top.join(smallest, "class").join(askers, "query").where("member <> query_id")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query", "query_id", "rank", F.col("member").alias("vec_id"), "score")
        )

    result = stored(ranked(found), "ann-ranked")
    others = members.select("member").distinct().count() - 1
    short = (
        askers.select("query", "query_id").distinct()
        .join(result.groupBy("query_id").agg(F.count("*").alias("n")), "query_id", "left")
        .where(F.coalesce("n", F.lit(0)) < min(k, others)).select("query").distinct()
    )
    short = stored(short, "ann-short")
    if not short.isEmpty():
        # every part of one table holds a share of all vectors
        parts = F.sequence(F.lit(0).cast("long"), F.lit(groups * slices - 1).cast("long"))
        every = (
            short.join(asking, short["query"] == asking["id"])
            .select(F.explode(parts).alias("part"), F.lit(1).alias("kind"), "id", F.lit(None).cast("int").alias("table"),
                    F.lit(None).cast("long").alias("code"), F.lit(None).cast("array<long>").alias("codes"), "vector")
        )
        exact = ranked(nearest_in_parts(held.where("table = 0").unionByName(every), k + 1))
        result = result.join(short, "query", "left_anti").unionByName(exact.join(short, "query", "left_semi"))
    return result.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op9_multiprobe(embeddings: DataFrame) -> DataFrame:
    """The 20 nearest of every row whose id is divisible by 20, among all others."""
    return search(embeddings, F.col("vec_id") % 20 == 0)
