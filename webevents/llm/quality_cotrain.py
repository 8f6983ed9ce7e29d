"""Quality classifier by co-training over two views of a document.

One classifier sees the text only, the other its metadata only (source, language, length). Over
some rounds each labels the unlabelled documents that it is surest of, as judged by its
calibrated probability, for the other to learn from. Both are calibrated on labelled rows
kept aside, the calibrated views are combined, and every document is scored.

The fit sees bounded samples chosen by hash of id and text: at most about ``LABELLED_ROWS`` labelled
documents and ``POOL_ROWS`` without any label, each at a rate taken from the rows of its own kind (rows
equal in id and text are chosen together). Scoring reads each document once, with no shuffle.

Defined results: a null text has no words, null metadata is a value of its own; repeated rows are scored
one by one; repeated labels of a document count as the worst of them; without labels of both
classes all scores are null and every document is kept; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webevents.llm.common import batch_of, hash_share, stored

LABELLED_ROWS = 12_000
POOL_ROWS = 8_000
ROUNDS = 3
#: Probability from which a view's label counts as confident, the most it hands over per
#: round (share of the pool), and the weight of such a label.
CONFIDENT = 0.95
HANDED_OVER = 0.2
PSEUDO_WEIGHT = 0.5
#: Documents with at least this probability of being good are kept.
THRESHOLD = 0.5
RIDGE = 1.0

SHAPES, WORDS, RATES = 128, 256, 8
SOURCES, LANGUAGES, LENGTHS = 64, 16, 6

# Letters to a, capitals to A, digits to 0, bytes beyond ASCII to a; the rest stays.
_CLASS = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b
    for b in range(256)
)
_AGAIN = re.compile(rb"(.)\1+", re.DOTALL)


def slot(value: bytes, size: int) -> int:
    return zlib.crc32(value) % size


def text_view(text: str | None) -> np.ndarray:
    """Shares of word shapes and of words, hashed, and a few rates."""
    out = np.zeros(SHAPES + WORDS + RATES, dtype=np.float32)
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    if not n:
        return out
    for shape, count in Counter(_AGAIN.sub(rb"\1", data.translate(_CLASS)).split()).items():
        out[slot(shape, SHAPES)] += count
    counts = Counter(words)
    for word, count in counts.items():
        out[SHAPES + slot(word, WORDS)] += count
    out[: SHAPES + WORDS] = np.sqrt(out[: SHAPES + WORDS] / n)
    lines = [line for line in data.split(b"\n") if line.strip()]
    common = counts.most_common(1)[0][1]
    out[SHAPES + WORDS :] = (
        np.log1p(n), sum(map(len, words)) / n / 10, len(counts) / n, len(counts) / np.sqrt(n) / 10, common / n,
        1 - len(set(lines)) / max(len(lines), 1), np.log1p(n / max(len(lines), 1)), np.log1p(len(lines)),
    )
    return out


def metadata_view(source: str | None, language: str | None, n_chars: int | None) -> np.ndarray:
    """Source and language, hashed, and the length."""
    out = np.zeros(SOURCES + LANGUAGES + LENGTHS, dtype=np.float32)
    out[slot(repr(source).encode(), SOURCES)] = 1
    out[SOURCES + slot(repr(language).encode(), LANGUAGES)] = 1
    log = np.log1p(max(n_chars or 0, 0))
    out[SOURCES + LANGUAGES :] = (n_chars is None, log / 10, (log / 10) ** 2, log < 4, 4 <= log < 6, log >= 9)
    return out


TEXT, METADATA = SHAPES + WORDS + RATES, SOURCES + LANGUAGES + LENGTHS


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE, steps: int = 12) -> np.ndarray:
    """Coefficients (the last one the constant) of a ridge logistic regression, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ b)
        slope = x.T @ (weight * (y - p)) - penalty * b
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        b += step
        if np.abs(step).max() < 1e-6:
            break
    return b


@dataclass
class View:
    """A classifier on standardised features and the line that calibrates its logit."""

    mean: np.ndarray
    scale: np.ndarray
    coefficients: np.ndarray
    calibration: np.ndarray

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, aside: np.ndarray, aside_y: np.ndarray) -> View:
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        view = View(mean, scale, logistic((x - mean) / scale, y, weight), np.array([1.0, 0.0]))
        raw = view.logit(aside)
        view.calibration = logistic(raw[:, None], aside_y, np.ones(len(raw)), ridge=1e-3)
        return view

    def logit(self, x: np.ndarray) -> np.ndarray:
        """The calibrated logit of being good."""
        raw = (x - self.mean) / self.scale @ self.coefficients[:-1] + self.coefficients[-1]
        return np.clip(raw, -30, 30) * self.calibration[0] + self.calibration[1]


@dataclass
class CoTrained:
    text: View
    metadata: View
    combination: np.ndarray  # of both calibrated logits, and a constant
    handed_over: list[tuple[int, int]]  # labels per round: text to metadata, metadata to text

    def scores(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.text.logit(text), self.metadata.logit(metadata)
        return sigmoid(a), sigmoid(b), sigmoid(np.column_stack([a, b]) @ self.combination[:2] + self.combination[2])


def confident(view: View, x: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows still ``free``, those the view is surest of, and its labels for them."""
    p = sigmoid(view.logit(x))
    sure = np.maximum(p, 1 - p)
    rows = np.flatnonzero(free & (sure >= CONFIDENT))
    rows = rows[np.argsort(-sure[rows], kind="stable")][: int(HANDED_OVER * len(x))]
    return rows, (p[rows] > 0.5).astype(float)


def cotrain(
    text: np.ndarray, metadata: np.ndarray, y: np.ndarray, aside: np.ndarray, pool_text: np.ndarray,
    pool_metadata: np.ndarray, rounds: int = ROUNDS,
) -> CoTrained:
    """Labelled rows (views, label, kept aside for calibration?) and the pool's views."""
    learn = ~aside
    views = [(text, pool_text), (metadata, pool_metadata)]
    given: list[tuple[list, list]] = [([], []), ([], [])]  # pool rows and labels each view got
    free = [np.ones(len(pool_text), dtype=bool) for _ in views]

    def fit(k: int) -> View:
        x, pool = views[k]
        rows, labels = (np.concatenate(g) if g else np.zeros(0) for g in given[k])
        return View.fit(
            np.concatenate([x[learn], pool[rows.astype(int)]]), np.concatenate([y[learn], labels]),
            np.concatenate([np.ones(learn.sum()), np.full(len(rows), PSEUDO_WEIGHT)]), x[aside], y[aside],
        )

    counts = []
    for _ in range(rounds):
        fitted = [fit(0), fit(1)]
        handed = []
        for k in (0, 1):  # view k teaches the other one
            rows, labels = confident(fitted[k], views[k][1], free[1 - k])
            free[1 - k][rows] = False
            given[1 - k][0].append(rows)
            given[1 - k][1].append(labels)
            handed.append(len(rows))
        counts.append(tuple(handed))
        if not any(handed):
            break
    a, b = fit(0), fit(1)
    both = np.column_stack([a.logit(text[aside]), b.logit(metadata[aside])])
    return CoTrained(a, b, logistic(both, y[aside], np.ones(aside.sum())), counts)


def views_of(batch: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray]:
    """Both views of a batch whose columns from ``at`` on are text, source, language and length."""
    text = [text_view(t) for t in batch.column(at).to_pylist()]
    rest = [metadata_view(*m) for m in zip(*(batch.column(at + i).to_pylist() for i in (1, 2, 3)))]
    return np.array(text, np.float32).reshape(-1, TEXT), np.array(rest, np.float32).reshape(-1, METADATA)


def narrowed(docs: DataFrame, doc_id: str, text: str, source: str, language: str, length: str) -> DataFrame:
    names = (doc_id, text, source, language, length)
    types = (None, "string", "string", "string", "long")
    return docs.select(*[
        (F.col(f"`{n}`") if t is None else F.col(f"`{n}`").cast(t)).alias(a)
        for n, t, a in zip(names, types, ("_id", "_text", "_source", "_language", "_length"))
    ])


def fit_quality(
    docs: DataFrame, labels: DataFrame, *, target: str = "quality", doc_id: str = "doc_id", text: str = "text",
    source: str = "source", language: str = "lang", length: str = "n_chars",
    labelled_rows: int = LABELLED_ROWS, pool_rows: int = POOL_ROWS, rounds: int = ROUNDS,
) -> CoTrained | None:
    """Fit on bounded samples; None without labels of both classes on both sides of the split."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull())
        .groupBy(F.col("doc_id").alias("_known")).agg(F.min(target).alias("_y"))
    )
    rows = narrowed(docs, doc_id, text, source, language, length).withColumn("_hash", F.xxhash64("_text"))
    # ids and hashes alone tell what is labelled; the texts stay where they are
    told = stored(
        rows.select("_id", "_hash").distinct()
        .join(known, F.col("_id") == F.col("_known"), "left").select("_id", "_hash", "_y"),
        "quality-known",
    )
    n_known, n_free = told.agg(F.count("_y"), F.count_if(F.col("_y").isNull())).first()
    some = told.where(F.col("_y").isNotNull() & hash_share(n_known, labelled_rows, "_id", "_hash", seed=11)).unionByName(
        told.where(F.col("_y").isNull() & hash_share(n_free, pool_rows, "_id", "_hash", seed=12))
    ).select(F.col("_id").alias("_some"), F.col("_hash").alias("_some_hash"), "_y")
    rows = (
        # about labelled_rows + pool_rows rows at most
        rows.join(F.broadcast(some), F.col("_id").eqNullSafe(F.col("_some")) & (F.col("_hash") == F.col("_some_hash")))
        .withColumn("_aside", F.pmod(F.xxhash64(F.lit(13), "_id"), F.lit(10)) < 3)
        # one row for rows equal in id and text, that with the least metadata
        .groupBy("_id", "_hash").agg(
            F.first("_y").alias("_y"), F.first("_aside").alias("_aside"), F.first("_text").alias("_text"),
            F.min(F.struct("_source", "_language", "_length")).alias("_rest"),
        )
        .select("_id", "_y", "_aside", "_text", "_rest.*")
    )
    schema = pa.schema([("id", pa.string()), ("y", pa.int32()), ("aside", pa.bool_()), ("views", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = np.hstack(views_of(batch, 3)).astype("<f4")
            yield batch_of(
                schema, batch.column(0).cast(pa.string()), batch.column(1).cast(pa.int32()),
                batch.column(2).fill_null(False), [v.tobytes() for v in both],
            )

    found = rows.mapInArrow(run, "id string, y int, aside boolean, views binary").collect()
    found.sort(key=lambda r: (r["id"] or "", r["views"]))  # not in the order in which tasks ended
    views = np.array([np.frombuffer(r["views"], "<f4") for r in found], dtype=np.float64).reshape(-1, TEXT + METADATA)
    y = np.array([np.nan if r["y"] is None else float(r["y"] > 0) for r in found])
    aside = np.array([r["aside"] for r in found], dtype=bool)
    labelled = ~np.isnan(y)
    if any(len(np.unique(y[labelled & part])) < 2 for part in (aside, ~aside)):
        return None
    own, pool = views[labelled], views[~labelled]
    return cotrain(
        own[:, :TEXT], own[:, TEXT:], y[labelled], aside[labelled], pool[:, :TEXT], pool[:, TEXT:], rounds
    )


def score_quality(
    docs: DataFrame, model: CoTrained | None, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    language: str = "lang", length: str = "n_chars", threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, text_score, metadata_score, quality_score, kept) of every document."""
    names = ("text_score", "metadata_score", "quality_score")
    fields = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                scores = [pa.nulls(batch.num_rows, pa.float64())] * 3
            else:
                scores = [pa.array(s.astype(np.float64)) for s in model.scores(*views_of(batch, 1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *scores], names=["doc_id", *names])

    return (
        narrowed(docs, doc_id, text, source, language, length)
        .mapInArrow(run, f"doc_id {fields}, " + ", ".join(f"{n} double" for n in names))
        .withColumn("kept", F.coalesce(F.col("quality_score") >= threshold, F.lit(True)))
    )


def op1_quality_cotrain(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Both views' calibrated probabilities, the combined one and the verdict on every document."""
    return score_quality(docs, fit_quality(docs, labels))
