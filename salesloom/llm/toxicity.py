"""Toxicity scores by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct character 3-, 4- and 5-grams of its lower-cased UTF-8 bytes, hashed to 2^18
places. Each is scaled by the log ratio of its smoothed shares of the two classes (Wang and Manning, 2012), the
vector is brought to length one, and a logistic regression with a quadratic penalty is fitted to it. The score is the
regression's probability of label 1; its intercept is fixed at the prior log odds.

Labels are learned from at most ``MAX_LABELLED`` labelled rows, chosen by a hash of their id, then of their text, whose
features are made in parallel and fitted in one task, block by block. That task takes rows in this order until they have
``MAX_FEATURES`` features together. The model is two arrays of 2^18 floats. Scoring is one pass over whole texts.

A null text counts as empty and gets the prior as its score, as does an empty one. Rows without a label are
not learned from; with no labelled row the score is 0, with labels of one class the scores stay on that side. Rows that
repeat count as often as they come. Only the named columns are read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.shared import lean

#: Labelled rows that the classifier is fitted on at most.
MAX_LABELLED = 4_000
#: Features of these rows at most; 8 bytes each in the fit.
MAX_FEATURES = 1 << 25
#: Rows whose features are multiplied together.
BLOCK = 128
#: Bytes of features in a batch on its way to the JVM: a text has several times its size in features.
BATCH_BYTES = 2 << 20
BITS = 18
ORDERS = (3, 4, 5)
PENALTY = 3e-5
ITERATIONS = 60


def _features(text: str, mark: np.ndarray) -> np.ndarray:
    """Distinct places of a text's n-grams. ``mark`` is scratch space of one number per place."""
    data = np.frombuffer(f" {text.lower()} ".encode(), np.uint8).astype(np.uint32)
    places = []
    grams = data
    for order in range(2, ORDERS[-1] + 1):
        grams = grams[: max(0, len(data) - order + 1)] * np.uint32(0x01000193) ^ data[order - 1 :]
        if order in ORDERS:
            places.append((grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))
    places = np.concatenate(places)
    number = np.arange(len(places), dtype=np.int32)
    mark[places] = number
    return places[mark[places] == number]


def _featured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mark = np.empty(1 << BITS, np.int32)
    for batch in batches:
        held, held_bytes, start = [], 0, 0
        for end, text in enumerate(batch.column("text"), 1):
            held.append(_features(text.as_py(), mark).astype("<u4").tobytes())
            held_bytes += len(held[-1])
            if held_bytes >= BATCH_BYTES or end == len(batch):
                rows = batch.slice(start, end - start)
                columns = [*(rows.column(name) for name in _ORDER), pa.array(held, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [*_ORDER, "places"])
                held, held_bytes, start = [], 0, end


def _minimum(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray) -> np.ndarray:
    """L-BFGS with a backtracking line search."""
    at, (value, slope) = start, loss(start)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(ITERATIONS):
        way, used = -slope, []
        for move, turn, scale in reversed(steps):
            share = scale * move.dot(way)
            used.append(share)
            way = way - share * turn
        if steps:
            move, turn, _ = steps[-1]
            way = way * (move.dot(turn) / turn.dot(turn))
        for (move, turn, scale), share in zip(steps, reversed(used), strict=True):
            way = way + move * (share - scale * turn.dot(way))
        size = 1.0 if steps else min(1.0, 1 / max(np.abs(slope).sum(), 1e-12))
        while True:
            new = at + size * way
            new_value, new_slope = loss(new)
            if new_value <= value + 1e-4 * size * slope.dot(way):
                break
            size /= 2
            if size < 1e-8:
                return at
        move, turn = new - at, new_slope - slope
        if move.dot(turn) > 1e-12:
            steps = [*steps[-7:], (move, turn, 1 / move.dot(turn))]
        done = abs(value - new_value) < 1e-7 * max(1.0, abs(value))
        at, value, slope = new, new_value, new_slope
        if done:
            break
    return at


def _fitted(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights with the ratios multiplied in, squared ratios, intercept."""
    size, n = 1 << BITS, len(rows)
    counts = {1: np.ones(size), 0: np.ones(size)}
    for row, label in zip(rows, labels, strict=True):
        counts[int(label)][row] += 1  # the places of a row are distinct
    ratio = np.log(counts[1] / counts[1].sum() / (counts[0] / counts[0].sum()))
    scale = ratio.astype(np.float32)
    norms = np.array([max(float((scale[row] ** 2).sum(dtype=np.float64)) ** 0.5, 1e-9) for row in rows])
    blocks = [slice(start, min(start + BLOCK, n)) for start in range(0, n, BLOCK)]

    def loss(weights: np.ndarray) -> tuple[float, np.ndarray]:
        scaled = (weights[:-1] * ratio).astype(np.float32)
        z, slope = np.empty(n), np.zeros(size + 1)
        for block in blocks:
            own = rows[block]
            z[block] = [float(scaled[row].sum(dtype=np.float64)) for row in own]
            z[block] = z[block] / norms[block] + weights[-1]
            error = (1 / (1 + np.exp(-np.clip(z[block], -50, 50))) - labels[block]) / norms[block]
            errors = np.repeat(error, [len(row) for row in own])
            slope[:-1] += np.bincount(np.concatenate(own), weights=errors, minlength=size)
        slope[:-1] = slope[:-1] * ratio / n + 2 * PENALTY * weights[:-1]
        # slope[-1] stays 0: the intercept is the prior, which is what a text without known features gets
        fit = np.mean(np.logaddexp(0, z) - labels * z) + PENALTY * weights[:-1].dot(weights[:-1])
        return float(fit), slope

    prior = (labels.sum() + 0.5) / (len(labels) + 1)
    start = np.zeros(size + 1)
    start[-1] = np.log(prior / (1 - prior))
    if 0 < labels.sum() < len(labels):
        start = _minimum(loss, start)
    return (start[:-1] * ratio).astype("<f4"), (ratio**2).astype("<f4"), float(start[-1])


def _trained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(batches, _FEATURED)
    places = table.column("places")  # put in order without a copy of the features
    order = pc.sort_indices(table.select(list(_ORDER)), sort_keys=[(name, "ascending") for name in _ORDER])
    sizes = np.cumsum(pc.binary_length(places).take(order).to_numpy() // 4)
    order = order.slice(0, int(np.searchsorted(sizes, MAX_FEATURES, side="right")))
    if len(order):
        rows = [np.frombuffer(places[i].as_buffer(), "<u4") for i in order.to_pylist()]
        labels = table.column("label").take(order).to_numpy().astype(float)
        weights, squares, intercept = _fitted(rows, labels)
        arrays = [pa.array([weights.tobytes()]), pa.array([squares.tobytes()]), pa.array([intercept])]
        yield pa.RecordBatch.from_arrays(arrays, ["weights", "squares", "intercept"])


_ORDER = ("id_hash", "text_hash", "label")
_FEATURED = pa.schema([("id_hash", pa.int64()), ("text_hash", pa.int64()), ("label", pa.int32()), ("places", pa.binary())])


def labelled_sample(labels: DataFrame, learn: Column, id_column: str, label_column: str) -> DataFrame:
    """At most ``MAX_LABELLED`` labelled rows that satisfy ``learn``, the same ones at every run."""
    rows = labels.where(learn & F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
    rows = rows.select(F.col(id_column).alias("labelled_id"), (F.col(label_column) == 1).cast("int").alias("label"))
    return rows.withColumn("id_hash", F.xxhash64("labelled_id")).orderBy("id_hash").limit(MAX_LABELLED)


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic",
) -> tuple[np.ndarray, np.ndarray, float] | None:
    """The model, or None without labelled rows. ``learn`` says of the labels' columns which rows may be used."""
    sample = F.broadcast(labelled_sample(labels, learn, id_column, label_column))  # at most MAX_LABELLED rows
    text = F.coalesce(F.col(text_column), F.lit("")).alias("text")
    rows = docs.select(F.col(id_column).alias("id"), text).join(sample, F.col("id") == F.col("labelled_id"))
    rows = rows.select("id_hash", F.xxhash64("text").alias("text_hash"), "label", "text")
    rows = rows.mapInArrow(lean(_featured), "id_hash long, text_hash long, label int, places binary")
    rows = rows.orderBy(*_ORDER).limit(MAX_LABELLED)  # ids may repeat; one task holds the rows that remain
    model = rows.mapInArrow(lean(_trained), "weights binary, squares binary, intercept double").collect()
    if not model:
        return None
    return np.frombuffer(model[0].weights, "<f4"), np.frombuffer(model[0].squares, "<f4"), model[0].intercept


def scored(
    docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float] | None, text_column: str = "text",
    score_column: str = "toxicity",
) -> DataFrame:
    """``docs`` with a column ``score_column`` between 0 and 1, which takes the place of one of that name."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = np.empty(1 << BITS, np.int32)
        for batch in batches:
            found = np.zeros(len(batch))
            if sent.value is not None:
                weights, squares, intercept = sent.value
                for i, text in enumerate(batch.column(batch.schema.get_field_index(text_column))):
                    places = _features(text.as_py() or "", mark)
                    norm = max(float(squares[places].sum(dtype=np.float64)) ** 0.5, 1e-9)
                    found[i] = float(weights[places].sum(dtype=np.float64)) / norm + intercept
                found = 1 / (1 + np.exp(-np.clip(found, -50, 50)))
            columns = [batch.column(i) for i in keep] + [pa.array(found)]
            yield pa.RecordBatch.from_arrays(columns, [*names, score_column])

    names = [name for name in docs.columns if name.lower() != score_column.lower()]
    keep = [docs.columns.index(name) for name in names]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in names)
    return docs.mapInArrow(lean(score), f"{fields}, `{score_column}` double")
