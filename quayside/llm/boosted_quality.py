"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics describe the whole text only.  Trees of a fixed depth are grown level
by level on binned statistics with the logistic loss and stored as flat arrays;
scoring walks all rows of a batch through all trees with numpy indexing.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import prepare

# At most so many labelled rows are fitted (a uniform sample by hash of the id).
FIT_ROWS = 20_000

STATISTICS = (
    "log_words word_length distinct_words top_word repeated_word distinct_trigrams one_letter_words longest_word "
    "upper digits space newline non_ascii exclamation bar hash_star_dollar percent_ampersand angle full_stop comma "
    "byte_entropy log_lines words_per_line distinct_lines terminal_lines short_lines upper_words marked_words"
).split()

_BYTES = {name: np.frombuffer(chars, np.uint8) for name, chars in {
    "upper": bytes(range(65, 91)), "digits": b"0123456789", "space": b" \t", "newline": b"\n", "non_ascii": bytes(range(128, 256)),
    "exclamation": b"!", "bar": b"|", "hash_star_dollar": b"#*$", "percent_ampersand": b"%&", "angle": b"<>", "full_stop": b".", "comma": b",",
}.items()}


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text, in the order of ``STATISTICS``; a null
    or empty text gives zeros."""
    if not text:
        return [0.0] * len(STATISTICS)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(data, minlength=256)
    n = len(data)
    share = {name: float(counts[codes].sum()) / n for name, codes in _BYTES.items()}
    seen = counts[counts > 0] / n
    words = text.split()
    k = len(words)
    lines = [line for line in text.split("\n") if line.strip()]
    if not k or not lines:
        words, k, lines = [""], 1, [""]
    times = Counter(words)
    trigrams = len(set(zip(words, words[1:], words[2:]))) / (k - 2) if k > 2 else 1.0
    marked = sum(c for w, c in times.items() if w and not w[-1].isalnum() and w[-1] not in ".,")
    return [
        math.log1p(k), sum(map(len, words)) / k, len(times) / k, max(times.values()) / k,
        sum(a == b for a, b in zip(words, words[1:])) / k, trigrams,
        sum(c for w, c in times.items() if len(w) == 1) / k, float(max(map(len, times))),
        share["upper"], share["digits"], share["space"], share["newline"], share["non_ascii"], share["exclamation"],
        share["bar"], share["hash_star_dollar"], share["percent_ampersand"], share["angle"], share["full_stop"], share["comma"],
        float(-(seen * np.log2(seen)).sum()), math.log1p(len(lines)), k / len(lines), len(set(lines)) / len(lines),
        sum(line.rstrip()[-1:] in tuple('.!?"') for line in lines) / len(lines),
        sum(len(line) < 20 for line in lines) / len(lines),
        sum(c for w, c in times.items() if w.isupper()) / k, marked / k,
    ]


class BoostedTrees:
    """Trees of one depth as flat arrays: node ``i`` has children ``2i+1`` and
    ``2i+2``; a row goes right where its statistic exceeds the threshold."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray):
        self.base, self.feature, self.threshold, self.leaf = base, feature, threshold, leaf

    @property
    def depth(self) -> int:
        return int(math.log2(self.leaf.shape[1])) if self.leaf.size else 0

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row, from 0 to 1."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - (leaf.size - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 48,
              min_rows: int = 20, ridge: float = 1.0) -> BoostedTrees:
    """Fits boosted trees to labels (0 to 1).  With no rows the score is 0.5; with
    one label only it is close to that label everywhere."""
    inner, outer = 2 ** depth - 1, 2 ** depth
    empty = np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, outer))
    if not len(y):
        return BoostedTrees(0.0, *empty)
    mean = (y.sum() + 0.5) / (len(y) + 1)
    base = math.log(mean / (1 - mean))
    if len(np.unique(y)) < 2:
        return BoostedTrees(base, *empty)
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)], 1)
    total = np.full(n, base)
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = 2 ** level - 1, 2 ** level
            local = node - first
            best = np.zeros(nodes)
            for f in range(width):
                at = local * bins + binned[:, f]
                sums = [np.bincount(at, w, nodes * bins).reshape(nodes, bins).cumsum(1) for w in (g, h, None)]
                (gl, hl, nl), (ga, ha, na) = sums, [s[:, -1:] for s in sums]
                gain = gl ** 2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga ** 2 / (ha + ridge)
                gain[(nl < min_rows) | (na - nl < min_rows)] = 0
                cut = gain[:, :len(cuts[f])].argmax(1) if len(cuts[f]) else np.zeros(nodes, int)
                for k in range(nodes):
                    if len(cuts[f]) and gain[k, cut[k]] > best[k] + 1e-9:
                        best[k] = gain[k, cut[k]]
                        feature[first + k], threshold[first + k] = f, cuts[f][cut[k]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        at = node - inner
        leaf = -rate * np.bincount(at, g, outer) / (np.bincount(at, h, outer) + ridge)
        total += leaf[at]
        features.append(feature), thresholds.append(threshold), leaves.append(leaf)
    return BoostedTrees(base, np.array(features), np.array(thresholds), np.array(leaves))


def held_out(id: str = "doc_id"):
    """True for the rows whose labels are never learnt."""
    return F.coalesce(F.pmod(F.crc32(F.col(id).cast("string")), F.lit(4)) == 2, F.lit(False))


def _statistics_of(texts: pd.Series) -> np.ndarray:
    return np.array([statistics(t) for t in texts]).reshape(len(texts), len(STATISTICS))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = FIT_ROWS, text: str = "text", id: str = "doc_id") -> BoostedTrees:
    """Fits the trees to ``labels(id, quality)`` that are not held out.

    At most ``max_rows`` labelled ids are used, chosen by hash: that many ids are
    broadcast, and their statistics are all that reaches the driver.  An id with
    several labels has their mean; null ids and labels are left out; of several
    texts with one id the one with the smallest statistics counts.
    """
    prepare(docs.sparkSession)
    chosen = (labels.filter(F.col(id).isNotNull() & F.col("quality").isNotNull() & ~held_out(id))
              .groupBy(F.col(id).alias("__id")).agg(F.avg("quality").alias("__label"))
              .orderBy(F.xxhash64("__id"), "__id").limit(max_rows))

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series(list(_statistics_of(texts)))

    rows = (docs.select(F.col(id).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__id")
            .select("__id", "__label", measured("__text").alias("__x"))
            .groupBy("__id").agg(F.min(F.struct("__x", "__label")).alias("r")).orderBy("__id").select("r.*").collect())
    x = np.array([r[0] for r in rows]).reshape(len(rows), len(STATISTICS))
    return fit_trees(x, np.array([float(r[1]) for r in rows]))


def score(docs: DataFrame, model: BoostedTrees, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: the model's probability that the whole
    text has label 1.  Every row is scored in place, without a shuffle: repeated
    rows alike, null texts as empty ones; a column of that name is replaced."""
    prepare(docs.sparkSession)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.predict(_statistics_of(texts)))

    return docs.withColumn(name, scored(F.col(text)))
