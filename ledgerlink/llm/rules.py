"""Quality classifier: a sparse ensemble of rules over text statistics, as Spark columns.

Small boosted trees propose rules (the paths to their nodes), an L1 logistic fit weighs them, and the
ones with a weight become one column expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.llm.common import fresh

CUT = 0.7
FOLDS, HELD_OUT = 4, 2
SAMPLE = 20_000


SYMBOLS = b"*#$%&|~^<>{}[]@\\+=_/`"
UPPER = bytes(range(65, 91))
STATISTICS = (
    "log_words",
    "word_length",
    "symbols",
    "calls",
    "capitals",
    "digits",
    "marks",
    "distinct_words",
    "short_words",
    "line_length",
)


def text_statistics(text: bytes) -> tuple[float, ...]:
    """The values of STATISTICS for one whole text, counted in bytes; all 0 for an empty one."""
    if not text:
        return (0.0,) * len(STATISTICS)
    words, size = text.split(), len(text)
    n = max(len(words), 1)

    def share(marks: bytes) -> float:
        return (size - len(text.translate(None, marks))) / size

    short = int((np.fromiter(map(len, words), np.int32, len(words)) <= 3).sum())
    return (
        float(np.log1p(len(words))),
        size / n,
        share(SYMBOLS),
        share(b"!?"),
        share(UPPER),
        share(b"0123456789"),
        share(b".,;:"),
        len(set(words)) / n,
        short / n,
        size / (1 + text.count(b"\n")),
    )


def statistics(text: Column) -> Column:
    """A struct of STATISTICS; a null text counts as an empty one."""

    @F.arrow_udf(T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS]))
    def of(texts: pa.Array) -> pa.Array:
        rows = [text_statistics(t.as_py() or b"") for t in texts]
        made = zip(*rows, strict=True) if rows else [[] for _ in STATISTICS]
        return pa.StructArray.from_arrays([pa.array(x, pa.float64()) for x in made], list(STATISTICS))

    return of(text.cast("string").cast("binary"))


@dataclass(frozen=True)
class Rules:
    """``rules`` are conjunctions of (statistic, above, threshold); a value equal to it is not above."""

    intercept: float
    rules: tuple[tuple[tuple[str, bool, float], ...], ...]
    weights: tuple[float, ...]

    def matrix(self, stats: np.ndarray, names: list[str]) -> np.ndarray:
        out = np.ones((len(stats), len(self.rules)), bool)
        for j, rule in enumerate(self.rules):
            for name, above, at in rule:
                out[:, j] &= (stats[:, names.index(name)] > at) == above
        return out

    def predict(self, stats: np.ndarray, names: list[str]) -> np.ndarray:
        z = self.intercept + self.matrix(stats, names) @ np.array(self.weights)
        return 1 / (1 + np.exp(-z))

    def column(self, stats: Column) -> Column:
        """The score as one expression of comparisons between fields of ``stats`` and constants."""
        z = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for name, above, at in rule:
                holds = holds & (stats[name] > at if above else stats[name] <= at)
            z = z + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def _paths(bins: np.ndarray, grad: np.ndarray, hess: np.ndarray, n_bins: int, depth: int, least: int):
    """A regression tree on binned statistics: the path of every node and the step of each row."""
    paths, step = [], np.zeros(len(bins))

    def split(rows: np.ndarray, path: tuple, left: int) -> None:
        g, h = grad[rows], hess[rows]
        best = (1e-9, None, None)
        if left and len(rows) >= 2 * least:
            for f in range(bins.shape[1]):
                b = bins[rows, f]
                gs, hs = np.bincount(b, g, n_bins).cumsum(), np.bincount(b, h, n_bins).cumsum()
                ns = np.bincount(b, minlength=n_bins).cumsum()
                ok = (ns >= least) & (ns[-1] - ns >= least)
                gain = gs**2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - gs[-1] ** 2 / (hs[-1] + 1)
                gain = np.where(ok, gain, 0)
                if gain.max() > best[0]:
                    best = (gain.max(), f, int(gain.argmax()))
        _, f, at = best
        if f is None:
            step[rows] = -g.sum() / (h.sum() + 1)
            return
        for above in (False, True):
            new = (*path, (f, above, at))
            paths.append(new)
            split(rows[(bins[rows, f] > at) == above], new, left - 1)

    split(np.arange(len(bins)), (), depth)
    return paths, step


def _tight(path: tuple) -> tuple:
    """A path with one bound per statistic and side."""
    bound: dict = {}
    for f, above, at in path:
        now = bound.get((f, above))
        bound[f, above] = at if now is None else (max if above else min)(now, at)
    return tuple(sorted((f, above, at) for (f, above), at in bound.items()))


def _lasso(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int) -> tuple[float, np.ndarray]:
    """Logistic weights with an L1 penalty, by accelerated proximal steps; the intercept is free."""
    n = len(x)
    full = np.c_[np.ones(n), x].astype(np.float64)
    v = np.ones(full.shape[1])
    for _ in range(30):
        v = full.T @ (full @ v)
        v /= np.linalg.norm(v)
    rate = 4 * n / np.linalg.norm(full @ v) ** 2 * 0.95
    w = np.zeros(full.shape[1])
    z, t = w.copy(), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(full @ z, -30, 30)))
        new = z - rate * (full.T @ (p - y)) / n
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return float(w[0]), w[1:]


def fit_rules(
    stats: np.ndarray,
    labels: np.ndarray,
    names: list[str],
    trees: int = 30,
    depth: int = 3,
    n_bins: int = 64,
    penalty: float = 5e-4,
    rounds: int = 400,
) -> Rules:
    """Rules from a bounded sample. Without rows, or with one label only, the score is one smoothed share."""
    labels = labels.astype(np.float64)
    share = (labels.sum() + 1) / (len(labels) + 2)
    prior = float(np.log(share / (1 - share)))
    if not len(labels) or labels.min() == labels.max():
        return Rules(prior, (), ())
    edges = [np.unique(np.quantile(stats[:, f], np.arange(1, n_bins) / n_bins)) for f in range(stats.shape[1])]
    bins = np.stack([np.searchsorted(e, stats[:, f], "left") for f, e in enumerate(edges)], 1)
    score, found = np.full(len(labels), prior), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        paths, step = _paths(bins, p - labels, p * (1 - p), n_bins, depth, max(10, len(labels) // 1000))
        score += 0.3 * step
        for path in map(_tight, paths):
            holds = np.ones(len(labels), bool)
            for f, above, at in path:
                holds &= (bins[:, f] > at) == above
            found.setdefault(np.packbits(holds).tobytes(), (path, holds))
    x = np.stack([holds for _, holds in found.values()], 1)
    intercept, weights = _lasso(x, labels, penalty, rounds)
    kept = [
        (tuple((names[f], above, float(edges[f][at])) for f, above, at in path), float(w))
        for (path, _), w in zip(found.values(), weights, strict=True)
        if abs(w) > 1e-4
    ]
    return Rules(intercept, tuple(r for r, _ in kept), tuple(w for _, w in kept))


def fold(id_col: str, folds: int = FOLDS) -> Column:
    """CRC-32 of the id as text, modulo the number of folds; 0 for a null id."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(folds)), F.lit(0))


def learn_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> Rules:
    """Rules from at most ``sample`` labelled rows outside the held-out fold, those with the smallest id hash.

    Only so many rows of statistics (80 bytes each) reach the driver. Rows without a label are left out.
    """
    used = labels.select(id_col, F.col(label_col).cast("int").alias("_label"))
    used = used.filter((fold(id_col) != HELD_OUT) & F.col("_label").isNotNull() & F.col(id_col).isNotNull())
    used = used.orderBy(F.xxhash64(id_col), id_col, "_label").limit(sample)
    texts = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    rows = texts.join(F.broadcast(used), id_col).select("_label", statistics(F.col("_text")).alias("s"))
    rows = rows.select("_label", "s.*").orderBy(F.xxhash64(*STATISTICS), "_label").limit(sample).toPandas()
    return fit_rules(rows[list(STATISTICS)].to_numpy(np.float64), rows["_label"].to_numpy(), list(STATISTICS))


def score_quality(
    docs: DataFrame, rules: Rules, cut: float = CUT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, held_out, score, predicted) of every row, from its whole text alone.

    Null and empty texts get the score of their (zero) statistics; repeated rows are scored each; a null id counts
    as not held out. Other columns are never looked at.
    """
    wide = docs.select(docs[id_col].alias(id_col), statistics(docs[text_col]).alias("_stats"))
    score = rules.column(F.col("_stats")).alias("score")
    scored = wide.select(id_col, (fold(id_col) == HELD_OUT).alias("held_out"), score)
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return score_quality(docs, learn_quality(docs, labels, id_col, text_col), CUT, id_col, text_col)


def keep_good(docs: DataFrame, rules: Rules, cut: float = CUT, text_col: str = "text") -> DataFrame:
    """The rows whose score reaches ``cut``, with their columns as they are."""
    name = fresh(docs, "_stats")
    wide = docs.withColumn(name, statistics(docs[text_col]))
    return wide.filter(rules.column(F.col(name)) >= cut).select(*docs.columns)
