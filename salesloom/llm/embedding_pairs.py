"""Near-duplicate vectors of equal label by counting collisions of one-dimensional projections.

For two vectors of cosine 0.98 the difference of their unit vectors has length ``sqrt(2 - 2 * 0.98)``, and its
projection on a random direction is normal with that length over ``sqrt(dimensions)`` as deviation. All windows and
counts are calibrated with this figure for the pairs that are hardest to find; closer pairs are found more surely.

1. Equal vectors of a label become one class with a multiplicity.
2. ``ROUTING`` projections deal the classes into cells twice as wide as a window. A class is data in its own cell and a
   query in every cell that its window touches, so a pair meets once: the class of larger number is the query. Cells
   of more classes than a tile holds are dealt into tiles.
3. In a tile, each of ``PROJECTIONS`` further projections counts the pairs whose values are within the query-centred
   window. Pairs that collide often enough are verified by their cosine in double precision.
4. A tile gives each class's number of links and a spanning forest of its links, never its pairs.

With the default figures 99.98 % of the pairs of cosine 0.98 pass routing and count.

Vectors that are null, zero, or hold null or non-finite components, and rows without label or id, link with nothing;
they stand for themselves. Vectors of different length do not link. Rows that repeat an id are vectors of their own.
Only the named columns are read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.components import connected_components
from salesloom.llm.ngram_join import _Forest
from salesloom.llm.shared import written

ROUTING = 2
PROJECTIONS = 24
#: Half widths of the windows in deviations, for routing and for counting.
ROUTE_WINDOW, COUNT_WINDOW = 4.0, 2.5
#: Share of the hardest pairs that the count may miss.
MISSED = 1e-6
TILE_DATA, TILE_QUERIES = 2048, 1024
#: Projections that are counted for all pairs of a tile; the others only for pairs that can still reach the count.
FIRST = 8


def _directions(dimensions: int) -> np.ndarray:
    """Random unit directions, the routing ones first; the same for every vector of this length."""
    found = np.random.default_rng([dimensions, 98]).standard_normal((dimensions, ROUTING + PROJECTIONS))
    return found / np.linalg.norm(found, axis=0)


def _deviation(threshold: float, dimensions: int) -> float:
    return math.sqrt((2 - 2 * threshold) / dimensions)


def least_collisions() -> int:
    """The largest count that the hardest pairs reach but for a share of MISSED."""
    hit = math.erf(COUNT_WINDOW / math.sqrt(2))
    missed, failures = 0.0, PROJECTIONS
    while failures and missed + (term := _binomial(failures, 1 - hit)) <= MISSED:
        missed += term
        failures -= 1
    return PROJECTIONS - failures


def _binomial(k: int, p: float) -> float:
    return math.comb(PROJECTIONS, k) * p**k * (1 - p) ** (PROJECTIONS - k)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _noded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [np.asarray(v.as_py(), "<f8").tobytes() for v in batch.column("vector")]
        labels = [str(x.as_py()).encode() for x in batch.column("label")]
        digests = [hashlib.blake2b(lab + b"\0" + v, digest_size=16).digest() for lab, v in zip(labels, vectors, strict=True)]
        nodes = [int.from_bytes(d[:8], "little", signed=True) for d in digests]
        arrays = [batch.column("id"), batch.column("label"), pa.array(nodes, pa.int64())]
        arrays += [pa.array(digests, pa.binary()), pa.array(vectors, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["id", "label", "node", "digest", "vector"])


def _routed(threshold: float, with_vectors: bool):
    names = ["label", "cell", "query", "node"] + ["n", "vector"] * with_vectors

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for label, node, n, content in zip(*(batch.column(c) for c in ("label", "node", "n", "vector")), strict=True):
                vector = np.frombuffer(content.as_py(), "<f8")
                unit = vector / np.linalg.norm(vector)
                window = ROUTE_WINDOW * _deviation(threshold, len(vector))
                at = unit @ _known_directions(len(vector))[:, :ROUTING]
                own = tuple(np.floor(at / (2 * window)).astype(int).tolist())
                low, high = (np.floor((at + side) / (2 * window)).astype(int).tolist() for side in (-window, window))
                more = [n, content] if with_vectors else []
                cells = itertools.product(*({a, b} for a, b in zip(low, high, strict=True)))
                for cell, query in [(own, False), *((c, True) for c in cells)]:
                    found.append((label, f"{len(vector)}:" + ":".join(map(str, cell)), query, node, *more))
            if found:
                kinds = [batch.schema.field("label").type, pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
                columns = ([x.as_py() if isinstance(x, pa.Scalar) else x for x in c] for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names)

    return route


_cache: dict[int, np.ndarray] = {}


def _known_directions(dimensions: int) -> np.ndarray:
    if dimensions not in _cache:
        _cache.clear()
        _cache[dimensions] = _directions(dimensions)
    return _cache[dimensions]


def _pairs(queries: np.ndarray, data: np.ndarray, allowed: np.ndarray, threshold: float) -> np.ndarray:
    """Numbers of (query, datum) among ``allowed`` that collide often enough and whose cosine is high enough."""
    units = [x / np.linalg.norm(x, axis=1, keepdims=True) for x in (queries, data)]
    directions, dimensions = _known_directions(data.shape[1]), data.shape[1]
    ours, theirs = (unit @ directions for unit in units)
    deviation = _deviation(threshold, dimensions)
    for k in range(ROUTING):
        allowed &= np.abs(ours[:, k, None] - theirs[None, :, k]) <= ROUTE_WINDOW * deviation
    window, least = COUNT_WINDOW * deviation, least_collisions()
    counts = np.zeros(allowed.shape, np.int8)
    for k in range(ROUTING, ROUTING + FIRST):
        counts += np.abs(ours[:, k, None] - theirs[None, :, k]) <= window
    q, d = np.nonzero(allowed & (counts >= least - (PROJECTIONS - FIRST)))
    near = np.abs(ours[q, ROUTING + FIRST :] - theirs[d, ROUTING + FIRST :]) <= window
    often = counts[q, d] + near.sum(axis=1) >= least
    q, d = q[often], d[often]
    lengths = [np.linalg.norm(x, axis=1) for x in (queries, data)]
    cosine = np.einsum("ij,ij->i", queries[q], data[d]) / (lengths[0][q] * lengths[1][d])
    return np.stack([q, d], axis=1)[cosine >= threshold]


def _links_of_tile(threshold: float):
    def links(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        data, queries = rows[~rows["query"]], rows[rows["query"]]
        if not len(data) or not len(queries):
            return pd.DataFrame({"a": [], "b": [], "links": []}).astype("int64")
        vectors = [np.stack([np.frombuffer(v, "<f8") for v in side["vector"]]) for side in (queries, data)]
        ids, counts = [s["node"].to_numpy() for s in (queries, data)], [s["n"].to_numpy() for s in (queries, data)]
        nodes = np.union1d(*ids)
        at = [np.searchsorted(nodes, i) for i in ids]
        forest, total = _Forest(len(nodes)), np.zeros(len(nodes), np.int64)
        for start in range(0, len(ids[0]), 256):
            some = slice(start, start + 256)
            found = _pairs(vectors[0][some], vectors[1], ids[0][some, None] > ids[1][None, :], threshold)
            q, d = at[0][some][found[:, 0]], at[1][found[:, 1]]
            np.add.at(total, q, counts[1][found[:, 1]])
            np.add.at(total, d, counts[0][some][found[:, 0]])
            for x, y in zip(q.tolist(), d.tolist(), strict=True):
                forest.join(x, y)
        made = np.array(forest.links, np.int64).reshape(-1, 2)
        linked = np.flatnonzero(total)
        edges = pd.DataFrame({"a": nodes[made[:, 0]], "b": nodes[made[:, 1]], "links": 0})
        return pd.concat([edges, pd.DataFrame({"a": nodes[linked], "b": nodes[linked], "links": total[linked]})])

    return links


def _tiled(classes: DataFrame, threshold: float) -> DataFrame:
    """a, b, links: edges of forests (links 0), and numbers of links (a = b)."""
    kind = classes.schema["label"].dataType.simpleString()
    schema = f"label {kind}, cell string, query boolean, node long"
    cells = classes.mapInArrow(_routed(threshold, with_vectors=False), schema).groupBy("label", "cell")
    cells = cells.agg(
        F.ceil(F.sum((~F.col("query")).cast("long")) / TILE_DATA).alias("i_tiles"),
        F.ceil(F.sum(F.col("query").cast("long")) / TILE_QUERIES).alias("j_tiles"),
    )
    cells = written(cells.where("i_tiles > 0 and j_tiles > 0"), "cells")
    routed = classes.mapInArrow(_routed(threshold, with_vectors=True), f"{schema}, n long, vector binary")
    rows = routed.join(cells, ["label", "cell"])
    turn = F.xxhash64("node")
    own = F.when(F.col("query"), F.pmod(turn, "j_tiles")).otherwise(F.pmod(turn, "i_tiles"))
    others = F.when(F.col("query"), F.col("i_tiles")).otherwise(F.col("j_tiles"))
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), others - 1)))
    rows = rows.select(
        "label", "cell", "query", "node", "n", "vector",
        F.when(F.col("query"), F.col("other")).otherwise(F.col("own")).alias("i"),
        F.when(F.col("query"), F.col("own")).otherwise(F.col("other")).alias("j"),
    )
    return rows.groupBy("label", "cell", "i", "j").applyInPandas(_links_of_tile(threshold), "a long, b long, links long")


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.98, id_column: str = "vec_id", vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """id, n_links, component_id, kept of every row."""
    rows = vectors.select(
        F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vector")
    )
    usable = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("vector")), F.lit(False))
    kinds = rows.schema["id"].dataType.simpleString(), rows.schema["label"].dataType.simpleString()
    noded = rows.where(usable).mapInArrow(
        _noded, f"id {kinds[0]}, label {kinds[1]}, node long, digest binary, vector binary"
    )
    noded = written(noded, "vectors")
    classes = noded.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("id").alias("smallest"),
        F.first("label").alias("label"),
        F.first("vector").alias("vector"),
        F.min("digest").alias("low"),
        F.max("digest").alias("high"),
    )
    collision = F.raise_error(F.lit("two vectors share 64 bits of their digests")).cast("long")
    classes = classes.withColumn("n", F.when(F.col("low") == F.col("high"), F.col("n")).otherwise(collision))
    classes = written(classes.drop("low", "high"), "vector-classes")
    found = written(_tiled(classes, threshold), "links")
    components = connected_components(found.where("links = 0").select("a", "b")).toDF("node", "component")
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    nodes = classes.select("node", "n", "smallest").join(links, "node", "left").join(written(components, "components"), "node", "left")
    nodes = nodes.select(
        "node",
        "smallest",
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component"),
    )
    least = nodes.groupBy("component").agg(F.min("smallest").alias("component_id"))
    nodes = written(nodes.join(least, "component").select("node", "n_links", "component_id"), "smallest-ids")
    linked = noded.select("id", "node").join(nodes, "node").select("id", "n_links", "component_id")
    alone = rows.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
