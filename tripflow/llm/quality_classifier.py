"""A quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from the text alone. The trees are fitted with numpy on a bounded sample of
labelled rows (``max_rows``, the documents with the lowest hash of their id); per split only a
histogram of gradients per feature is looked at. All documents are scored in their partitions
with the trees flattened into arrays, one vectorised step per level for a whole batch.

Defined results: null and empty texts have all-zero statistics and get a score like any other.
Rows without a label, or with a null one, are not learnt from. A document with several labels
counts once per different label; of several texts under one id the least statistics are learnt
from. Labels of one kind, or none, give every document that kind's share (0.5 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import (
    ASCII_SPACE,
    id_or_none,
    keep_rows,
    map_batches,
    texts_of,
    with_null_ids,
    words,
)

FEATURES = (
    "log_words",
    "mean_word",
    "symbols_per_word",
    "exclamations_per_word",
    "capitals_share",
    "digits_share",
    "lone_symbols_share",
    "stutter_share",
    "distinct_share",
    "repeated_pairs_share",
    "marks_per_word",
    "words_per_line",
    "repeated_lines_share",
    "longest_line_share",
)
SYMBOLS = "#*$%&|<>"
DIGITS = "0123456789"
MARKS = ".,;:?"
#: From this score on a document counts as good.
THRESHOLD = 0.7
_CAPITALS = bytes(range(65, 91))


def statistics(text: str) -> tuple[float, ...]:
    """The values of ``FEATURES`` for one text."""
    tokens = words(text)
    count = len(tokens)
    if not count:
        return (0.0,) * len(FEATURES)
    chars = len(text) - sum(map(text.count, ASCII_SPACE))
    data = text.encode()
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    distinct = len(set(tokens))
    pairs = list(zip(tokens, tokens[1:], strict=False))
    return (
        float(np.log1p(count)),
        chars / count,
        sum(map(text.count, SYMBOLS)) / count,
        text.count("!") / count,
        (len(data) - len(data.translate(None, _CAPITALS))) / chars,
        sum(map(text.count, DIGITS)) / chars,
        sum(1 for token in tokens if len(token) == 1 and not token.isalnum()) / count,
        sum(map(bytes.__eq__, tokens, tokens[1:])) / count,
        distinct / count,
        1 - len(set(pairs)) / len(pairs) if pairs else 0.0,
        sum(map(text.count, MARKS)) / count,
        count / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        max(map(len, lines), default=0) / max(1, chars),
    )


@dataclass(frozen=True)
class BoostParams:
    """``max_rows`` bounds the labelled documents that the fit sees, on whatever volume."""

    trees: int = 60
    depth: int = 3
    rate: float = 0.2
    bins: int = 32
    leaf_weight: float = 1.0
    max_rows: int = 20_000


@dataclass(frozen=True)
class Forest:
    """Complete binary trees as arrays: node ``i`` has the children ``2i + 1`` and ``2i + 2``."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, values: np.ndarray) -> np.ndarray:
        """The chance of label 1 per row of ``values``."""
        rows = np.arange(len(values))[:, None]
        trees = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(values), len(self.feature)), dtype=np.int64)
        inner = self.feature.shape[1]
        while len(self.feature) and node.size and node[0, 0] < inner:
            right = values[rows, self.feature[trees, node]] > self.threshold[trees, node]
            node = 2 * node + 1 + right
        margin = self.base + self.leaf[trees, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def fit_forest(values: np.ndarray, labels: np.ndarray, params: BoostParams) -> Forest:
    """Boosts logistic loss; every split is the best of the histogram of its node."""
    inner, leaves = 2**params.depth - 1, 2**params.depth
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        share_margin = {0.0: -20.0, 1.0: 20.0}.get(share, 0.0)
        empty = np.zeros((0, inner))
        return Forest(share_margin, empty.astype(int), empty, np.zeros((0, leaves)))

    edges = [_edges(values[:, f], params.bins) for f in range(values.shape[1])]
    binned = [np.searchsorted(edges[f], values[:, f]) for f in range(values.shape[1])]
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(labels), base)
    feature = np.zeros((params.trees, inner), dtype=np.int64)
    threshold = np.full((params.trees, inner), np.inf)
    leaf = np.zeros((params.trees, leaves))
    for tree in range(params.trees):
        chance = 1 / (1 + np.exp(-margin))
        gradient, weight = labels - chance, chance * (1 - chance)
        node = np.zeros(len(labels), dtype=np.int64)
        for level in range(params.depth):
            first, width = 2**level - 1, 2**level
            best = np.zeros(width)
            for f, own in enumerate(binned):
                size = len(edges[f]) + 1
                cell = (node - first) * size + own
                sums = np.bincount(cell, gradient, width * size).reshape(width, size)
                weights = np.bincount(cell, weight, width * size).reshape(width, size)
                gain = _split_gain(sums, weights, params.leaf_weight)
                for at in np.flatnonzero(gain.max(axis=1, initial=0) > best + 1e-9):
                    cut = int(gain[at].argmax())
                    best[at] = gain[at, cut]
                    feature[tree, first + at] = f
                    threshold[tree, first + at] = edges[f][cut]
            right = (
                values[np.arange(len(labels)), feature[tree, node]] > threshold[tree, node]
            )
            node = 2 * node + 1 + right
        at = node - inner
        sums = np.bincount(at, gradient, leaves)
        weights = np.bincount(at, weight, leaves)
        leaf[tree] = params.rate * sums / (weights + params.leaf_weight)
        margin += leaf[tree, at]
    return Forest(base, feature, threshold, leaf)


def _split_gain(sums: np.ndarray, weights: np.ndarray, ridge: float) -> np.ndarray:
    """Gain of cutting each node's histogram after each of its bins but the last."""
    left, left_weight = sums.cumsum(axis=1)[:, :-1], weights.cumsum(axis=1)[:, :-1]
    total, total_weight = sums.sum(axis=1)[:, None], weights.sum(axis=1)[:, None]
    right, right_weight = total - left, total_weight - left_weight
    return (
        left**2 / (left_weight + ridge)
        + right**2 / (right_weight + ridge)
        - total**2 / (total_weight + ridge)
    )


def held_out(doc_id: Column) -> Column:
    """True for the fold that is never learnt from. A null id is in no fold and not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _measure(batch: pd.DataFrame) -> np.ndarray:
    return _measure_texts(texts_of(batch["text"]))


def _measure_texts(texts: list[str]) -> np.ndarray:
    found = [statistics(text) for text in texts]
    return np.array(found, dtype=float).reshape(len(found), len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, params: BoostParams | None = None) -> Forest:
    """Fits the trees on labelled documents outside the held-out fold.

    The sample's ids are bounded by ``max_rows``, and so is all that reaches the driver.
    """
    params = params or BoostParams()
    sample = (
        labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
        .filter("doc_id is not null and quality in (0, 1)")
        .filter(~held_out(F.col("doc_id")))
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(params.max_rows)
    )
    chosen = docs.select(F.col("doc_id").cast("long"), "text").join(
        F.broadcast(sample), "doc_id"
    )
    schema = ", ".join(["doc_id long, quality int", *(f"{name} double" for name in FEATURES)])

    def work(batch: pd.DataFrame) -> pd.DataFrame:
        found = pd.DataFrame(_measure(batch), columns=FEATURES)
        return found.assign(doc_id=batch["doc_id"].array, quality=batch["quality"].array)

    rows = (
        map_batches(chosen, work, schema)
        .groupBy("doc_id", "quality")
        .agg(F.min(F.struct(*FEATURES)).alias("found"))
        .select("doc_id", "quality", "found.*")
        .toPandas()
        .sort_values(["doc_id", "quality"])
    )
    return fit_forest(
        rows[list(FEATURES)].to_numpy(float), rows["quality"].to_numpy(float), params
    )


def score_documents(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""

    def work(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "doc_id": batch["doc_id"].array,
                "held_out": batch["held_out"].array,
                "score": forest.score(_measure(batch)),
            }
        )

    ids = docs.select(
        id_or_none(), "text", held_out(F.col("doc_id")).alias("held_out")
    )
    scored = with_null_ids(
        map_batches(ids, work, "doc_id long, held_out boolean, score double")
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, forest: Forest, least: float = THRESHOLD) -> DataFrame:
    """The documents that score ``least`` or more, in all their columns.

    Trees that had no label to learn from say nothing, and all documents stay.
    """
    if not forest.base and not forest.leaf.any():
        return docs

    def work(texts: list[str]) -> tuple[list[bool], list[str] | None]:
        return (forest.score(_measure_texts(texts)) >= least).tolist(), None

    return keep_rows(docs, work)
