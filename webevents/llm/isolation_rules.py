"""Quality rules judged by an isolation forest over the rules' statistics.

Every document gets the statistics that heuristic quality rules look at. Two base rules
reject outright; a forest of random splits then measures how few splits isolate a
document's statistics, and a threshold calibrated on labelled rows decides from when on
that is an anomaly. There are no limits set by hand: each statistic is seen as its distance from what labelled
good documents have, in units of how far these stray themselves, and splits are drawn from the statistics in
proportion to how well each alone tells labelled bad documents from good ones, so that what
is merely rare (a long document, one with many numbers) takes few splits unless the labels speak against it.

Defined results: a null text counts as one without words, so it fails the base rules; a
row without ``doc_id`` is judged like any other; repeated rows are judged one by one, and seen once
by the fit; an id with several labels has the lowest; other columns pass through. Without any labelled good document nothing is an anomaly, and
an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webevents.llm.common import hash_share

# Fixed values of the contract.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50

#: Bounds of what the fit sees, whatever the table's size.
FIT_ROWS = 20_000
LABELLED_ROWS = 20_000
#: Of the labelled good documents that pass the base rules, at most this share may be
#: rejected at the chosen threshold.
MAX_FALSE_REJECTION = 0.002
TREES = 100
#: Few rows per tree, so that one kind of junk isn't a crowd within it.
TREE_ROWS = 64

SPACE_BYTES = b" \t\n\x0b\x0c\r"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = b"0123456789"
PUNCTUATION = b"!?;:()[]{}\"'/\\_=+-~^@`"

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_digits", "n_punctuation",
)


def count_of(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    covered = bytearray(len(words))
    for i, window in enumerate(windows):
        if found[window] > 1:
            covered[i : i + 3] = b"\1\1\1"
    return sum(covered)


def rule_counts(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one text."""
    data = (text or "").encode()
    words = data.split()  # bytes split at ASCII white space only, as the contract has it
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text or "") - count_of(data, SPACE_BYTES),
        count_of(data, SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        count_of(data, UPPER),
        count_of(data, DIGITS),
        count_of(data, PUNCTUATION),
    )


#: Smallest unit of a statistic, for those that good documents hardly ever show.
LEAST_UNIT = 0.01


def statistics(counts: np.ndarray) -> np.ndarray:
    """The rules' statistics, one row per document: symbols, words in repeated windows and punctuation per word,
    repeated lines per line, capitals and digits per character, characters per word."""
    c = dict(zip(COUNTS, counts.T.astype(np.float64)))
    words, chars, lines = (np.maximum(c[k], 1) for k in ("n_words", "word_chars", "n_lines"))
    return np.column_stack([
        c["n_symbols"] / words, c["n_dup_lines"] / lines, c["n_repeat_words"] / words, c["n_upper"] / chars,
        c["n_digits"] / chars, c["n_punctuation"] / words, c["word_chars"] / words,
    ])


@dataclass
class Scale:
    """What is usual: the good documents' medians, and how far the 95th of a hundred of them lies from these."""

    centre: np.ndarray
    unit: np.ndarray

    @staticmethod
    def fit(good: np.ndarray) -> Scale:
        centre = np.median(good, axis=0)
        return Scale(centre, np.maximum(np.quantile(np.abs(good - centre), 0.95, axis=0), LEAST_UNIT))

    def points(self, values: np.ndarray) -> np.ndarray:
        return np.log1p(np.abs(values - self.centre) / self.unit)


def telling(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Per statistic, how much more often than not a bad document has the larger value (0 to 1); all alike without
    any that tells."""
    if not len(bad):
        return np.ones(good.shape[1])
    larger = np.empty(good.shape[1])
    for f in range(good.shape[1]):
        own = np.sort(good[:, f])
        below, upto = np.searchsorted(own, bad[:, f], "left"), np.searchsorted(own, bad[:, f], "right")
        larger[f] = (below + upto).mean() / 2 / len(own)
    weights = np.maximum(2 * larger - 1, 0)
    return weights if weights.any() else np.ones(good.shape[1])


def unsplit_path(n: np.ndarray | int) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary tree of ``n`` points."""
    n = np.asarray(n, dtype=np.float64)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays: node i of a tree splits ``feature`` at ``cut`` into ``child``, ``child + 1``;
    a leaf (child 0) holds its path length."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    path: np.ndarray
    rows: int

    @staticmethod
    def grow(
        points: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7, weights: np.ndarray | None = None
    ) -> Forest:
        """``weights``: how often each column is drawn for a split, relative to the others that can be split."""
        weights = np.ones(points.shape[1]) if weights is None else weights
        rng = np.random.default_rng(seed)
        rows = min(tree_rows, len(points))
        depth = int(np.ceil(np.log2(max(rows, 2))))
        grown = []
        for _ in range(trees):
            nodes = [[0, 0.0, 0, 0.0]]
            todo = [(0, rng.choice(len(points), rows, replace=False), 0)]
            while todo:
                at, own, level = todo.pop()
                low, high = points[own].min(axis=0), points[own].max(axis=0)
                usable = (high > low) * weights
                if level == depth or not usable.any():
                    nodes[at][3] = level + float(unsplit_path(len(own)))
                    continue
                f = int(rng.choice(len(usable), p=usable / usable.sum()))
                cut = min(rng.uniform(low[f], high[f]), np.nextafter(high[f], low[f]))  # never the largest itself
                side = points[own, f] <= cut
                nodes[at][:3] = [f, cut, len(nodes)]
                todo += [(len(nodes), own[side], level + 1), (len(nodes) + 1, own[~side], level + 1)]
                nodes += [[0, 0.0, 0, 0.0], [0, 0.0, 0, 0.0]]
            grown.append(np.array(nodes))
        most = max(map(len, grown))
        padded = np.stack([np.pad(t, ((0, most - len(t)), (0, 0))) for t in grown])
        return Forest(
            padded[..., 0].astype(np.int64), padded[..., 1], padded[..., 2].astype(np.int64), padded[..., 3], rows
        )

    def score(self, points: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / mean path length of random data): near 1 for anomalies."""
        total, every = np.zeros(len(points)), np.arange(len(points))
        for feature, cut, child, path in zip(self.feature, self.cut, self.child, self.path):
            at = np.zeros(len(points), dtype=np.int64)
            while (child[at] > 0).any():
                right = points[every, feature[at]] > cut[at]
                at = np.where(child[at] > 0, child[at] + right, at)
            total += path[at]
        return 2.0 ** (-total / len(self.path) / max(float(unsplit_path(self.rows)), 1e-9))


@dataclass
class RuleModel:
    forest: Forest | None
    threshold: float
    scale: Scale | None = None

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Anomaly score of each row of ``COUNTS``."""
        return self.forest.score(self.scale.points(statistics(counts))) if self.forest else np.zeros(len(counts))


def with_rules(docs: DataFrame, keep: list[str], text: str, into: str, model: RuleModel) -> DataFrame:
    """The columns ``keep`` and a struct column ``into`` of counts and the model's score."""
    rules = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField("score", T.DoubleType())])
    fields = [docs.schema[c] for c in keep] + [T.StructField(into, rules)]
    own = pa.struct([(c, pa.int64()) for c in COUNTS] + [("score", pa.float64())])
    read = keep + ([text] if text not in keep else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(read.index(text))
            counts = np.array([rule_counts(x.as_py()) for x in texts], dtype=np.int64).reshape(-1, len(COUNTS))
            scores = model.score(counts)
            struct = pa.StructArray.from_arrays(
                [*(pa.array(c) for c in counts.T), pa.array(scores)], fields=list(own)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] + [struct],
                names=[*keep, into],
            )

    return docs.select(*[F.col(f"`{c}`") for c in read]).mapInArrow(run, T.StructType(fields))


def base_failed(rules: str) -> Column:
    words, repeated = F.col(f"`{rules}`.n_words"), F.col(f"`{rules}`.n_repeat_words")
    return (words < MIN_WORDS) | (repeated * 100 > words * MAX_REPEAT_PCT)


def fit_rules(
    docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id",
    fit_rows: int = FIT_ROWS, labelled_rows: int = LABELLED_ROWS,
    max_false_rejection: float = MAX_FALSE_REJECTION, trees: int = TREES, tree_rows: int = TREE_ROWS,
) -> RuleModel:
    """Grow the forest on about ``fit_rows`` documents and calibrate its threshold on about
    ``labelled_rows`` labelled ones. Both samples are chosen by hash at the rate of their own count, among
    different (id, text): no more rows than that reach the driver, however often one is repeated or one id occurs."""
    narrow = docs.select(
        F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"), F.xxhash64(F.col(f"`{text}`")).alias("_hash")
    )
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    known = known.groupBy(F.col("doc_id").alias("_labelled")).agg(F.min("quality").alias("_quality"))
    classes = narrow.select("_id", "_hash").distinct().join(known, F.col("_id") == F.col("_labelled"), "left")
    n, n_labelled = classes.agg(F.count("*"), F.count("_quality")).first()
    chosen = (
        classes.withColumn("_fit", hash_share(n, fit_rows, "_id", "_hash", seed=1))
        .where(F.col("_fit") | (F.col("_quality").isNotNull() & hash_share(n_labelled, labelled_rows, "_id", "_hash", seed=2)))
        .select(F.col("_id").alias("_chosen"), F.col("_hash").alias("_chosen_hash"), "_fit", "_quality")
    )
    own = F.col("_id").eqNullSafe(F.col("_chosen")) & (F.col("_hash") == F.col("_chosen_hash"))
    sample = narrow.join(F.broadcast(chosen), own)  # about fit_rows + labelled_rows rows at most
    rows = (
        with_rules(sample, ["_id", "_hash", "_fit", "_quality"], "_text", "_rules", RuleModel(None, 0.0))
        .where(~base_failed("_rules"))
        .select("_id", "_hash", "_fit", "_quality", *[f"_rules.{c}" for c in COUNTS])
        .distinct()
        .toPandas()
    )
    # sorted, so that the order in which tasks end doesn't show in the forest
    rows = rows.drop(columns=["_id", "_hash"])
    rows = rows.sort_values(list(rows.columns), kind="stable", na_position="last")
    values = statistics(rows[list(COUNTS)].to_numpy(dtype=np.int64).reshape(-1, len(COUNTS)))
    fit, good, bad = (values[(x).to_numpy(dtype=bool)] for x in (rows["_fit"], rows["_quality"] == 1, rows["_quality"] == 0))
    if not len(fit) or not len(good):
        return RuleModel(None, float("inf"))
    scale = Scale.fit(good)
    fit, good, bad = scale.points(fit), scale.points(good), scale.points(bad)
    forest = Forest.grow(fit, trees, tree_rows, weights=telling(good, bad))
    return RuleModel(forest, calibrated(forest.score(good), forest.score(bad), max_false_rejection), scale)


def calibrated(good: np.ndarray, bad: np.ndarray, max_false_rejection: float) -> float:
    """The score above which most labelled bad documents lie, and of the good ones no more
    than the given share; of equal choices the one that rejects fewest good ones."""
    allowed = np.sort(good)[::-1][: int(len(good) * max_false_rejection) + 1]
    caught = [(bad > t).mean() if len(bad) else 0.0 for t in allowed]
    return float(allowed[int(np.argmax(caught))])


def judged(docs: DataFrame, model: RuleModel, *, keep: list[str], into: str, text: str = "text") -> DataFrame:
    """``keep``, the struct ``into`` and the booleans ``<into>_base_failed`` and ``<into>_kept``."""
    return (
        with_rules(docs, keep, text, into, model)
        .withColumn(f"{into}_base_failed", base_failed(into))
        .withColumn(
            f"{into}_kept",
            ~F.col(f"{into}_base_failed") & (F.col(f"`{into}`.score") <= F.lit(model.threshold)),
        )
    )


def op3_isolation_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts, base verdict, anomaly score and final verdict of every document."""
    model = fit_rules(docs, labels)
    return judged(docs, model, keep=["doc_id"], into="r").select(
        "doc_id", *[f"r.{c}" for c in COUNTS[:5]],
        F.col("r_base_failed").alias("base_failed"), F.col("r_kept").alias("kept"),
        F.col("r.score").alias("anomaly_score"),
    )
