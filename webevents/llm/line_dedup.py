"""Line dedup: drop lines found in many documents, keep them in one.

Lines are exploded with their position, normalised and hashed; documents are counted
per hash; lines over the threshold are dropped by position and the rest put together
again. Only built-in functions run.

Defined results: a null or empty text is one empty line; a row without ``doc_id`` counts
as no document and keeps all its lines; repeated rows of one document count once and each
keeps its row; other columns pass through, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webevents.llm.common import SPACES, stored

#: Dropped positions are kept per block of so many lines, so that looking one up
#: stays cheap in a document of millions of lines.
BLOCK = 1024


def line_key(line: Column) -> Column:
    """The line stripped of white space at both ends, A-Z in lower case."""
    return F.translate(
        F.btrim(line, F.lit(SPACES)), string.ascii_uppercase, string.ascii_lowercase
    )


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def dedup_lines(
    docs: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    min_chars: int = 20,
    min_docs: int = 3,
    counts: tuple[str, str] | None = ("n_lines", "n_dropped"),
) -> DataFrame:
    """``docs`` with ``text`` replaced by its kept lines, plus the counts of lines and of dropped ones
    under the names ``counts`` (None: without them).

    A key of at least ``min_chars`` code points found in at least ``min_docs`` documents
    loses all its lines except those of the largest document id that holds it.

    Keys travel as 128 bits of hash, never as text; the text itself is shuffled once, to
    meet its document's dropped positions. A key that every document holds is combined
    before its shuffle, and its lines join one row of the table of common keys, which
    adaptive execution broadcasts if it is small and else splits.
    """
    # every own name starts with _ld_, so that no column of the input can clash
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_ld_row"),
        F.col(f"`{doc_id}`").alias("_ld_doc"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_ld_text"),
    ).withColumn("_ld_hash", F.xxhash64("_ld_text"))
    keys = (
        rows.where(F.col("_ld_doc").isNotNull())
        .select("_ld_doc", "_ld_hash", F.posexplode(lines_of(F.col("_ld_text"))).alias("_ld_pos", "_ld_line"))
        .withColumn("_ld_key", line_key(F.col("_ld_line")))
        .where(F.char_length("_ld_key") >= min_chars)
        .select(
            "_ld_doc", "_ld_hash", "_ld_pos",
            F.xxhash64("_ld_key").alias("_ld_k1"),
            F.xxhash64(F.lit(1), F.col("_ld_key")).alias("_ld_k2"),
        )
    )
    keys = stored(keys, "line-keys")  # read twice
    common = (
        keys.groupBy("_ld_k1", "_ld_k2")
        .agg(F.count_distinct("_ld_doc").alias("_ld_docs"), F.max("_ld_doc").alias("_ld_keep"))
        .where(F.col("_ld_docs") >= min_docs)
        .select("_ld_k1", "_ld_k2", "_ld_keep")
    )
    # a table of its own, so that a common key's lines meet it in a join that can be split
    common = stored(common, "line-common")
    blocks = (
        keys.join(common, ["_ld_k1", "_ld_k2"])
        .where(F.col("_ld_doc") < F.col("_ld_keep"))
        .withColumn("_ld_block", F.floor(F.col("_ld_pos") / BLOCK).cast("int"))
        .groupBy("_ld_doc", "_ld_hash", "_ld_block")
        .agg(F.collect_set("_ld_pos").alias("_ld_positions"))
    )
    dropped = blocks.groupBy("_ld_doc", "_ld_hash").agg(
        F.map_from_entries(F.collect_list(F.struct("_ld_block", "_ld_positions"))).alias("_ld_dropped"),
        F.sum(F.size("_ld_positions")).alias("_ld_n"),
    )

    def stays(_, i):
        return ~F.coalesce(
            F.array_contains(F.try_element_at("_ld_dropped", F.floor(i / BLOCK).cast("int")), i), F.lit(False)
        )

    kept = F.when(F.col("_ld_dropped").isNull(), F.col("_ld_text")).otherwise(
        F.array_join(F.filter(lines_of(F.col("_ld_text")), stays), "\n")
    )
    others = [
        (F.col("_ld_kept") if c == text else F.col("_ld_row")[c]).alias(c) for c in docs.columns
    ]
    return (
        rows.drop("_ld_text")  # it is in the row too: shuffle it once
        .join(dropped, ["_ld_doc", "_ld_hash"], "left")
        .withColumn("_ld_text", F.coalesce(F.col("_ld_row")[text], F.lit("")))
        .withColumn("_ld_kept", kept)
        .select(
            *others,
            *([] if counts is None else [
                F.size(lines_of(F.col("_ld_text"))).cast("long").alias(counts[0]),
                F.coalesce("_ld_n", F.lit(0)).cast("long").alias(counts[1]),
            ]),
        )
    )


def op8_line_dedup(docs: DataFrame) -> DataFrame:
    """The digest of each document's kept lines."""
    kept = dedup_lines(docs.select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), common AS (
  SELECT k, max(doc_id) AS keep FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT doc_id, pos, line, c.k IS NOT NULL AND doc_id <> c.keep AS gone
  FROM keyed LEFT JOIN common c ON keyed.k = c.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
