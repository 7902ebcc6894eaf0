"""Quality scores by a sparse ensemble of rules over text statistics.

Statistics of a whole text (shares of letters, capitals, digits and symbols, repeats of words and lines, lengths) come
from one pass over Arrow batches. Small regression trees are boosted on them; every path from a root to a node is a rule, a
conjunction of bounds on statistics (Friedman and Popescu, 2008). A logistic regression with a lasso penalty over all
rules keeps a few of them, each with a weight; the penalty is the greatest whose loss on a validation fold is within
``TOLERANCE`` of the least.

Labels are learned from at most ``MAX_LABELLED`` rows with a label, chosen by a hash of their id and bounded again after
they met their texts; only their statistics reach the driver, which fits the model. The rest covers all rows. The kept
rules become one column expression over the statistics, so a model is plain Spark and can be read.

A null text counts as empty; its statistics are 0 and are scored as any others. Rows without a label or an id are not
learned from. Without any labelled row the score is 0.5, with labels of one class it is a constant on that side. Rows
that repeat are scored alike. Only the named columns are read; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import itertools
import operator
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that the rules are fitted on at most.
MAX_LABELLED = 8_000
TREES, DEPTH, LEAST_ROWS, BINS, RATE = 40, 3, 20, 48, 0.3
#: Penalties that are tried, greatest first, and how much worse than the best a sparser fit may be.
PENALTIES = (0.1, 0.05, 0.02, 0.01, 0.005, 0.002, 0.001)
TOLERANCE = 0.001
ITERATIONS = 400

_NAMES = (
    "characters", "letters", "capitals", "digits", "outcries", "symbols", "marks", "word_length", "line_words",
    "distinct_words", "repeated_words", "distinct_lines",
)


@functools.cache
def _kinds() -> np.ndarray:
    """Kind of each code point: 0 none of these, 1 letter or mark, 2 capital, 3 digit, 4 outcry, 5 stop, 6 symbol."""
    by_category = {"L": 1, "M": 1, "N": 3, "P": 6, "S": 6, "C": 6, "Z": 0}
    found = np.array([by_category[unicodedata.category(chr(code))[0]] for code in range(0x110000)], np.uint8)
    found[[code for code in range(0x110000) if unicodedata.category(chr(code)) == "Lu"]] = 2
    for characters, kind in ((" \t\n\x0b\x0c\r'\"()-", 0), ("!?", 4), (".,;:", 5)):
        found[[ord(c) for c in characters]] = kind
    return found


def statistics_of(text: str) -> tuple[float, ...]:
    """Values in the order of ``_NAMES``. Words are separated by ``[\\x20\\x09-\\x0D]+``, lines by a line feed."""
    data = text.encode()
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    _, small, capitals, digits, outcries, stops, symbols = np.bincount(_kinds()[codes], minlength=7).tolist()
    words, lines, size = data.split(), data.split(b"\n"), max(1, len(codes))
    n, letters = max(1, len(words)), small + capitals
    repeated = sum(map(operator.eq, words, itertools.islice(words, 1, None)))
    return (
        float(len(codes)), letters / size, capitals / max(1, letters), digits / size, outcries / n, symbols / n, stops / n,
        len(codes) / n, len(words) / len(lines), len(set(words)) / n, repeated / n, len(set(lines)) / len(lines),
    )


def _with_statistics(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [statistics_of(text.as_py()) for text in batch.column("text")]
        columns = zip(*values, strict=True) if values else [[]] * len(_NAMES)
        arrays = [pa.array(column, pa.float64()) for column in columns]
        kept = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*kept, *arrays], [*batch.schema.names[:-1], *_NAMES])


def with_statistics(rows: DataFrame) -> DataFrame:
    """The columns of ``rows`` with the statistics in place of the last one, ``text``."""
    kept = [f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema.fields[:-1]]
    return rows.mapInArrow(_with_statistics, ", ".join(kept + [f"{name} double" for name in _NAMES]))


@dataclass(frozen=True)
class Rule:
    """Bounds (statistic, above, at most) that all hold, and the weight of the rule."""

    bounds: tuple[tuple[str, float | None, float | None], ...]
    weight: float

    def column(self) -> Column:
        parts = []
        for name, above, at_most in self.bounds:
            parts += [F.col(name) > above] if above is not None else []
            parts += [F.col(name) <= at_most] if at_most is not None else []
        return functools.reduce(lambda a, b: a & b, parts)

    def __str__(self) -> str:
        shown = [
            ("" if above is None else f"{above:.4g} < ") + name + ("" if at_most is None else f" <= {at_most:.4g}")
            for name, above, at_most in self.bounds
        ]
        return f"{self.weight:+.3f} if " + " and ".join(shown)


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[Rule, ...]

    def score(self) -> Column:
        """Probability of label 1 as an expression over the columns of the statistics."""
        total = F.lit(float(self.intercept))
        for rule in self.rules:
            total = total + F.when(rule.column(), float(rule.weight)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _best_split(codes: np.ndarray, target: np.ndarray, rows: np.ndarray, features: np.ndarray):
    """(gain, feature, bin) of the split ``code <= bin`` that explains most of the target's variance, or None."""
    best, total, n = None, target[rows].sum(), len(rows)
    for f in features.tolist():
        own = codes[rows, f]
        counts = np.cumsum(np.bincount(own, minlength=BINS))[:-1]
        sums = np.cumsum(np.bincount(own, weights=target[rows], minlength=BINS))[:-1]
        allowed = (counts >= LEAST_ROWS) & (n - counts >= LEAST_ROWS)
        if allowed.any():
            low, high = np.maximum(counts, 1), np.maximum(n - counts, 1)
            gain = np.where(allowed, sums**2 / low + (total - sums) ** 2 / high - total**2 / n, -np.inf)
            at = int(gain.argmax())
            if gain[at] > 1e-9 and (best is None or gain[at] > best[0]):
                best = float(gain[at]), f, at
    return best


def _grown(codes, target, rows, features, path, depth, paths, fitted) -> None:
    """Grow a tree; add every node's path to ``paths`` and the leaves' means to ``fitted``, for all rows."""
    split = _best_split(codes, target, rows, features) if depth < DEPTH else None
    if path:
        paths.append(path)
    if split is None:
        inside = np.ones(len(codes), bool)
        for f, at, upper in path:
            inside &= (codes[:, f] > at) == upper
        fitted[inside] = target[rows].mean()
        return
    _, f, at = split
    above = codes[rows, f] > at
    for upper, own in ((False, rows[~above]), (True, rows[above])):
        _grown(codes, target, own, features, (*path, (f, at, upper)), depth + 1, paths, fitted)


def _paths(codes: np.ndarray, labels: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """Paths of boosted trees, each on half of the rows and two thirds of the statistics."""
    prior = (labels.sum() + 0.5) / (len(labels) + 1)
    score, paths, n = np.full(len(labels), np.log(prior / (1 - prior))), [], len(labels)
    for _ in range(TREES):
        rows = np.sort(rng.permutation(n)[: max(1, n // 2)])
        features = np.sort(rng.permutation(codes.shape[1])[: -(-2 * codes.shape[1] // 3)])
        target, fitted = labels - 1 / (1 + np.exp(-score)), np.zeros(n)
        _grown(codes, target, rows, features, (), 0, paths, fitted)
        score += RATE * 4 * fitted
    return paths


def _held(codes: np.ndarray, paths: list[tuple]) -> tuple[list[dict], np.ndarray]:
    """Distinct rules as bounds by feature (above, at most, as bins), and where they hold. Short paths come first."""
    rules, columns, seen = [], [], set()
    for path in sorted(paths, key=len):
        bounds: dict[int, list] = {}
        for f, at, upper in path:
            low, high = bounds.setdefault(f, [None, None])
            if upper:
                bounds[f][0] = at if low is None else max(low, at)
            else:
                bounds[f][1] = at if high is None else min(high, at)
        holds = np.ones(len(codes), bool)
        for f, (low, high) in bounds.items():
            holds &= (low is None or codes[:, f] > low) & (high is None or codes[:, f] <= high)
        key = np.packbits(holds).tobytes()
        if 0 < holds.sum() < len(codes) and key not in seen:
            seen.add(key)
            rules.append(bounds)
            columns.append(holds)
    return rules, np.array(columns, float).T.reshape(len(codes), -1)


def _lasso(x: np.ndarray, labels: np.ndarray, penalty: float, start: np.ndarray) -> np.ndarray:
    """Weights, and last the intercept, of least logistic loss + penalty * sum |weight|, by accelerated proximal steps."""
    n = len(x)
    wide = np.column_stack([x, np.ones(n)])
    vector = np.ones(wide.shape[1])
    for _ in range(30):
        vector = wide.T @ (wide @ vector)
        vector /= np.linalg.norm(vector)
    step = 4 * n / (vector @ (wide.T @ (wide @ vector))) / 1.02
    at = ahead = start
    pace = 1.0
    for _ in range(ITERATIONS):
        slope = wide.T @ (1 / (1 + np.exp(-np.clip(wide @ ahead, -50, 50))) - labels) / n
        new = ahead - step * slope
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0)
        if (ahead - new) @ (new - at) > 0:  # against the way: start the pace anew
            pace = 1.0
        following = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead, at, pace = new + (pace - 1) / following * (new - at), new, following
    return at


def _loss(x: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    z = x @ weights[:-1] + weights[-1]
    return float(np.mean(np.logaddexp(0, z) - labels * z))


def fit(values: np.ndarray, labels: np.ndarray) -> RuleModel:
    """The model from statistics (rows in the order of ``_NAMES``) and labels 0 or 1, the same at every run."""
    prior = (labels.sum() + 0.5) / (len(labels) + 1)
    if len(labels) == 0 or labels.min() == labels.max():
        return RuleModel(float(np.log(prior / (1 - prior))), ())
    cuts = [np.unique(np.quantile(values[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(values.shape[1])]
    codes = np.stack([np.searchsorted(c, values[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    rules, x = _held(codes, _paths(codes, labels, np.random.default_rng(11)))
    check = np.arange(len(labels)) % 5 == 0
    weights, losses = np.append(np.zeros(x.shape[1]), np.log(prior / (1 - prior))), []
    for penalty in PENALTIES:
        weights = _lasso(x[~check], labels[~check], penalty, weights)
        losses.append(_loss(x[check], labels[check], weights))
    chosen = next(k for k, loss in enumerate(losses) if loss <= min(losses) + TOLERANCE)
    weights = np.append(np.zeros(x.shape[1]), np.log(prior / (1 - prior)))
    for penalty in PENALTIES[: chosen + 1]:
        weights = _lasso(x, labels, penalty, weights)

    def bound(f: int, at: int | None) -> float | None:
        return None if at is None else float(cuts[f][at])

    kept = [
        Rule(tuple((_NAMES[f], bound(f, low), bound(f, high)) for f, (low, high) in bounds.items()), float(w))
        for bounds, w in zip(rules, weights[:-1], strict=True)
        if w
    ]
    return RuleModel(float(weights[-1]), tuple(kept))


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality",
) -> RuleModel:
    """The model; ``learn`` says of the labels' columns which rows may be used."""
    usable = learn & F.col(label_column).isNotNull() & F.col(id_column).isNotNull()
    sample = labels.where(usable).select(
        F.col(id_column).alias("labelled"),
        (F.col(label_column) == 1).cast("int").alias("label"),
        F.xxhash64(id_column).alias("turn"),
    )
    sample = F.broadcast(sample.orderBy("turn", "label").limit(MAX_LABELLED))  # a few hundred kilobytes
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = with_statistics(texts.join(sample, F.col("id") == F.col("labelled")).select("turn", "label", "text"))
    rows = rows.orderBy("turn", "label", *_NAMES).limit(MAX_LABELLED).collect()
    values = np.array([row[2:] for row in rows], float).reshape(len(rows), len(_NAMES))
    return fit(values, np.array([row["label"] for row in rows], float))


def scored(docs: DataFrame, model: RuleModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, score and the statistics of every row of ``docs``."""
    text = F.coalesce(F.col(text_column), F.lit("")).alias("text")
    rows = with_statistics(docs.select(F.col(id_column).alias("id"), text))
    return rows.select(F.col("id").alias(id_column), model.score().alias("score"), *_NAMES)
