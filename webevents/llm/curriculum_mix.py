"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time 0..1. Its integral gives the
source's share of all words; the integral up to a time gives the words demanded so far.
A document's place in its source's stream of words, looked up in the inverse of that
cumulative demand, is its training position, and the mix is range-sorted by position.
Only built-in functions run.

Defined results: a null text has size 0 and is never taken; null is a source of its own,
ranked last; repeated rows are documents of their own; texts of one id stand in the order of size
and hash; a table without words has targets of 0; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webevents.llm.common import WORD, addressed, global_rank, stored

#: Overall weights, dealt to the ranked sources in turn.
WEIGHTS = (5.0, 2.0, 1.0)
#: Weight over training time for each of those classes, as (time, multiplier) knots joined
#: by straight lines: heavy sources fade, light ones grow. Any positive knots will do;
#: each schedule is scaled by its own integral, so overall shares stay those of WEIGHTS.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
)
MAX_EPOCHS = 3

def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def target_sizes(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """Add ``rank``, ``weight`` and ``target`` to rows (source, source_size), one per source.

    Targets are ``min(max_epochs * source_size, level * weight)``. The level rises as
    full sources pass their excess on; each turn reads three sums, no rows.
    """
    ranked = global_rank(sources, [F.col("source").asc_nulls_last()], "rank", "mix-sources")
    turn = F.col("rank") % len(weights)
    weight = F.lit(float(weights[-1]))
    for i, w in enumerate(weights[:-1]):
        weight = F.when(turn == i, float(w)).otherwise(weight)
    ranked = stored(ranked.withColumn("weight", weight), "mix-weights")
    cap = F.col("source_size") * max_epochs
    level = 0.0
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        total, used, free = ranked.agg(
            F.sum("source_size"), F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        higher = ((total or 0) - (used or 0)) / free if free else level
        if higher <= level:
            break
        level = higher
    return ranked.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(level)))


def training_position(demand_share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which a piecewise-linear schedule has used up ``demand_share`` of its integral."""
    pieces, area = [], 0.0
    for (t0, m0), (t1, m1) in zip(knots, knots[1:]):
        pieces.append((area, t0, m0, (m1 - m0) / (t1 - t0)))
        area += (t1 - t0) * (m0 + m1) / 2
    wanted = demand_share * area
    position = None
    for begin, t0, m0, slope in pieces:  # solves begin + m0 x + slope x^2 / 2 = wanted for x
        rest = wanted - begin
        root = F.sqrt(F.greatest(F.lit(m0 * m0) + rest * (2 * slope), F.lit(0.0)))
        solved = F.lit(t0) + rest * 2 / (F.lit(m0) + root)
        position = solved if position is None else F.when(wanted >= begin, solved).otherwise(position)
    return position


def mix_sources(
    docs: DataFrame,
    *,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    max_epochs: int = MAX_EPOCHS,
    seed: str = "mix",
) -> DataFrame:
    """One row per document: the columns ``keep``, ``size``, ``source_size``, ``target``,
    ``taken`` and ``copies``, an array of (epoch, words, position) for each copy in the mix.

    A source's documents stand in the order of a seeded hash, passed through up to
    ``max_epochs`` times until the rounded target is reached; the copy that crosses it is
    cut there, so a source's taken words are exactly its rounded target.

    The text is read once, for its size and hash. Running totals need two levels: within a range of the order,
    and over the ranges' totals. A row's address ends the order, so ranges can be cut anywhere: a source with a
    third of all rows, or as many equal rows or rows without an id, is spread over as many tasks as any others.
    """
    sized = addressed(
        docs.select(
            *[F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)],
            F.col(f"`{source}`").alias("source"),
            word_count(F.col(f"`{text}`")).alias("size"),
            F.xxhash64(F.col(f"`{text}`")).alias("_text"),
            F.col(f"`{doc_id}`").cast("string").alias("_id"),
        ).withColumn("_order", F.md5(F.concat(F.lit(seed), F.coalesce("_id", F.lit(""))))),
        "mix-sized", "_file", "_row",
    )
    sources = target_sizes(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs
    ).withColumnRenamed("source", "_source")
    order = ["_order", "_id", "size", "_text", "_file", "_row"]
    ranged = stored(sized.repartitionByRange("source", *order).withColumn("_range", F.spark_partition_id()), "mix-ranged")
    earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = (  # a row per range and source in it
        ranged.groupBy("source", "_range")
        .agg(F.sum("size").alias("_total"))
        .withColumn("_begin", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
        .join(sources, F.col("source").eqNullSafe(F.col("_source")))
        .select("_source", F.col("_range").alias("_r"), "_begin", "rank", "source_size", "target")
    )
    inside = Window.partitionBy("_range", "source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        ranged.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(totals, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_r")))
        .withColumn("_start", F.col("_begin") + F.col("_inside"))
        .withColumn("_demand", F.floor(F.col("target") + 0.5).cast("long"))
    )
    copies = []
    for epoch in range(max_epochs):
        start = F.col("_start") + F.col("source_size") * epoch
        words = F.greatest(F.least(F.col("_demand") - start, F.col("size")), F.lit(0))
        share = start / F.col("_demand").cast("double")
        turn, position = F.col("rank") % len(weights), training_position(share, schedules[-1])
        for i, knots in enumerate(schedules[:-1]):
            position = F.when(turn == i, training_position(share, knots)).otherwise(position)
        copies.append(F.when(words > 0, F.struct(
            F.lit(epoch).alias("epoch"), words.alias("words"), position.alias("position"))))
    return placed.withColumn("copies", F.array_compact(F.array(*copies))).select(
        *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)],
        "size", "source_size", "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda n, c: n + c["words"]).alias("taken"),
        "copies",
    )


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its ``words``-th word."""
    at_word_end = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"
    return F.array_join(F.slice(F.split(text, at_word_end), 1, words.cast("int")), "")


def training_order(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The mix itself: a row of ``docs`` per copy, cut texts cut, range-sorted by position.

    The rows are stored first, so that copies meet them by their address and each of several equal rows gets its own.
    """
    held = addressed(docs, "mix-rows", "_mix_file", "_mix_row")
    plan = (
        mix_sources(held, keep=(doc_id, "_mix_file", "_mix_row"), text=text, doc_id=doc_id, **options)
        .where(F.col("taken") > 0)
        .select(
            F.col(f"`{doc_id}`").alias("_mix_id"), F.col("_mix_file").alias("_mix_f"), F.col("_mix_row").alias("_mix_r"),
            F.col("size").alias("_mix_size"), F.col("copies").alias("_mix_copies"),
        )
    )
    return (
        held.join(plan, (F.col("_mix_file") == F.col("_mix_f")) & (F.col("_mix_row") == F.col("_mix_r")))
        .withColumn("_mix_copy", F.explode("_mix_copies"))
        .withColumn(
            text,
            F.when(F.col("_mix_copy.words") < F.col("_mix_size"),
                   first_words(F.col(f"`{text}`"), F.col("_mix_copy.words"))).otherwise(F.col(f"`{text}`")),
        )
        .orderBy("_mix_copy.position", "_mix_id", "_mix_copy.epoch")
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def op6_curriculum_mix(docs: DataFrame) -> DataFrame:
    """Each document's part in the mix, in training order (documents left out come last)."""
    return (
        mix_sources(docs)
        .withColumn("first_position", F.round(F.get("copies", F.lit(0))["position"], 9))
        .orderBy(F.col("first_position").asc_nulls_last(), "doc_id")
        .select("doc_id", "size", "source_size", "target", "taken", "first_position")
    )


# The level is found in closed form here: sources in the order in which they fill up,
# the first prefix whose remaining level leaves the next source below its cap.
SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix' || coalesce(doc_id::VARCHAR, '')) AS o,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS rank
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, [5, 2, 1][rank % 3 + 1]::DOUBLE AS weight FROM per_source
), filling AS (
  SELECT *, 3 * source_size / weight AS fills_at,
         sum(3 * source_size) OVER w - 3 * source_size AS capped_before,
         sum(weight) OVER () - (sum(weight) OVER w - weight) AS weight_left,
         sum(source_size) OVER () AS total, row_number() OVER w AS turn
  FROM weighted WINDOW w AS (ORDER BY 3 * source_size / weight, rank ROWS UNBOUNDED PRECEDING)
), level AS (
  SELECT coalesce(arg_min((total - capped_before)::DOUBLE / weight_left, turn)
                  FILTER (WHERE (total - capped_before)::DOUBLE / weight_left <= fills_at), 0) AS level
  FROM filling
), targets AS (
  SELECT source, source_size, rank, least((3 * source_size)::DOUBLE, weight * level) AS target,
         floor(least((3 * source_size)::DOUBLE, weight * level) + 0.5)::BIGINT AS demand
  FROM weighted, level
), placed AS (
  SELECT doc_id, size, source_size, target, demand, rank % 3 AS turn,
         (sum(size) OVER (PARTITION BY s.source ORDER BY o, doc_id::VARCHAR, size
                          ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), shared AS (
  SELECT *, greatest(least(demand - start, size), 0)
            + greatest(least(demand - start - source_size, size), 0)
            + greatest(least(demand - start - 2 * source_size, size), 0) AS taken,
         CASE WHEN least(demand - start, size) > 0 THEN start / demand::DOUBLE END AS u
  FROM placed
)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
       round(CASE turn
         WHEN 1 THEN 0.0::DOUBLE + u * 2 / 2
         WHEN 0 THEN CASE WHEN u >= 0.625
           THEN 0.5::DOUBLE + (u - 0.625) * 2 / (1.0::DOUBLE + sqrt(1.0::DOUBLE + (u - 0.625) * -2))
           ELSE u * 2 / (1.5::DOUBLE + sqrt(2.25::DOUBLE + u * -2)) END
         ELSE CASE WHEN u >= 0.375
           THEN 0.5::DOUBLE + (u - 0.375) * 2 / (1.0::DOUBLE + sqrt(1.0::DOUBLE + (u - 0.375) * 2))
           ELSE u * 2 / (0.5::DOUBLE + sqrt(0.25::DOUBLE + u * 2)) END
       END, 9) AS first_position
FROM shared
"""
