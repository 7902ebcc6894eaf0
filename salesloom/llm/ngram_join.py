"""Jaccard self-join of texts on word shingles by parity sketches.

1. Every text becomes its set of shingle hashes; equal sets are one class from then on (64 bits of a digest; two sets
   with the same 64 bits are an error).
2. Sets are cut into blocks by their elements' hashes, for their size band and, where a partner can be larger, for the
   next one. A block's key is its parity sketch, wide enough for blocks to have a key in common only if they have equal
   elements. Linked sets have fewer differences than blocks, so they agree in one.
   Tasks send keys and classes, 16 bytes a key, in packets to buckets of bounded size, which leave out keys of one
   class. The other keys are named after all their classes, so that keys which the same classes have are one from then
   on, and go to their classes, again in packets, a row per bucket and part of the classes. There they meet the
   classes' parity sketches, whose Hamming distance is at most the symmetric difference, and go to buckets again, where
   classes with one key are compared by sketch; those within the budget are linked into a spanning forest. A key that more than ``HOT_KEY`` classes of a packet or bucket have links all of
   them with the smallest one without a look at sketches: no task holds such a key whole, and step 3 decides.
   Every pair that links lies in one tree of all forests.
3. In each tree every class is compared exactly with its smallest class. What does not link with that one is compared
   exactly with all others of the tree, in tiles of bounded size. Components of these links are the result.

A set that is close to its tree's smallest class costs one comparison, however many copies there are; nothing is
compared pair by pair but the classes that aren't. No text and no set is shuffled but those of classes in a tree.

Texts are lower-cased in A-Z and cut into words ``[^\\x20\\x09-\\x0D]+``. A text with fewer words than a shingle is one
shingle. A text without words, and a null text, has the empty set and links with nothing. A row without an id links with
nothing and has no component. Rows that repeat an id are one document of several texts. Only the two named columns are
read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.components import connected_components
from salesloom.llm.shared import fresh_name, lean, lean_groups, written
from salesloom.llm.shingles import Bands, Parities, block_keys, mixed, parity, parity_words, shingle_set

#: Keys that meet in a bucket, and keys of a packet, about.
BUCKET_KEYS = 1 << 21
PACKET_KEYS = 1 << 20
#: Links of hot keys that leave together.
PAIR_ROWS = 1 << 16
#: Sets of a tile: those that look for partners, and those they are compared with.
TILE_SEEKERS, TILE_MEMBERS = 256, 1024
#: Classes of a packet or bucket that share a key at most, before they are linked without comparing sketches.
HOT_KEY = 2000
#: Bits of the broadcast filter that lets the sets of possible members pass, for each of them, and at most (16 MB).
#: Others may pass too.
FILTER_BITS_EACH, MOST_FILTER_BITS = 8, 1 << 27


def _node(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()[:8], "little", signed=True)


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))


def fingerprints(rows: DataFrame, words: int) -> DataFrame:
    """id, n, node (the class), digest, parity sketch of every row."""

    def fingerprint(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py(), words) for text in batch.column("text")]
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            nodes = [int.from_bytes(d[:8], "little", signed=True) for d in digests]
            arrays = [batch.column("id"), pa.array(map(len, sets), pa.int64()), pa.array(nodes, pa.int64())]
            arrays += [pa.array(digests, pa.binary()), pa.array([parity(s).tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n", "node", "digest", "sketch"])

    kind = rows.schema["id"].dataType.simpleString()
    return written(rows.mapInArrow(lean(fingerprint), f"id {kind}, n long, node long, digest binary, sketch binary"), "shingles")


def _cut_hot(keys: np.ndarray, nodes: np.ndarray, most: int, known: np.ndarray):
    """Distinct (key, node) in order without those of hot keys but their smallest nodes, links of the latter, hot keys.

    A key is hot that more than ``most`` nodes have, or that is ``known`` to be hot elsewhere.
    """
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    if len(keys):
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])])
        keys, nodes = keys[new], nodes[new]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    lengths = np.diff(np.append(starts, len(keys)))
    hot = (lengths > most) | np.isin(keys[starts], known)
    rest = np.repeat(hot, lengths)
    rest[starts] = False  # the smallest node of a key stays
    smallest = np.repeat(nodes[starts], lengths)
    links = np.unique(np.stack([smallest[rest], nodes[rest]], axis=1), axis=0)
    return keys[~rest], nodes[~rest], links, keys[starts[hot]]


def key_packets(rows: DataFrame, words: int, bands: Bands, buckets: int, hot_key: int) -> DataFrame:
    """Block keys and classes of a task and which keys are hot, a row per bucket; those of bucket -1 hold links."""

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        nodes, keys, waiting = [], [], 0

        def out() -> pa.RecordBatch:
            owners = np.repeat(np.array(nodes, np.int64), [len(k) for k in keys])
            own_keys, owners, links, hot = _cut_hot(np.concatenate(keys), owners, hot_key, np.zeros(0, np.uint64))
            hot_bucket = hot % np.uint64(buckets)
            bucket = (own_keys % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            found = [(-1, links[:, 0].tobytes(), links[:, 1].tobytes(), b"")] if len(links) else []
            for number in range(buckets):
                own = order[cuts[number] : cuts[number + 1]]
                if len(own):
                    own_hot = hot[hot_bucket == number].tobytes()
                    found.append((number, own_keys[own].tobytes(), owners[own].tobytes(), own_hot))
            columns = zip(zip(*found, strict=True), (pa.int32(), *[pa.binary()] * 3), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], ["bucket", "keys", "nodes", "hot"])

        for batch in batches:
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py(), words)
                node = _node(shingles)
                if not len(shingles) or node in seen:
                    continue
                seen.add(node)
                nodes.append(node)
                keys.append(np.concatenate([block_keys(shingles, *cut) for cut in bands.of(len(shingles))]))
                waiting += len(keys[-1])
                if waiting >= PACKET_KEYS:
                    yield out()
                    nodes, keys, waiting = [], [], 0
                    seen.clear()
        if keys:
            yield out()

    return rows.select("text").mapInArrow(lean(packed), "bucket int, keys binary, nodes binary, hot binary")


def _joined(rows: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.concatenate([np.frombuffer(value.as_buffer(), kind) for value in rows.column(name)])


def _distinct(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (key, node) in the order of nodes and their keys."""
    order = np.lexsort((keys, nodes))
    keys, nodes = keys[order], nodes[order]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])])
    return keys[new], nodes[new]


def _named_by_classes(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (name, node): the name of a key is a hash of all nodes that have it; keys are in order.

    Keys which the same classes have get one name, in all buckets. Should two sets of classes get the same one, all
    of them have it, so none of them is lost.
    """
    if not len(keys):
        return keys, nodes
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    lengths = np.diff(np.append(starts, len(keys)))
    names = mixed(np.add.reduceat(mixed(nodes.view("<u8")), starts) + lengths.astype(np.uint64))
    return _distinct(np.repeat(names, lengths), nodes)


def _shared_keys(rows: pa.Table, hot_key: int, parts: int, named: Callable | None = None) -> pa.Table:
    """part, keys, nodes: the keys of a bucket that several classes have, by name if they are ``named``, a row per part
    that has such a class; links of hot keys in part -1."""
    keys, nodes, hot = _joined(rows, "keys", "<u8"), _joined(rows, "nodes", "<i8"), _joined(rows, "hot", "<u8")
    found = []
    if rows.column("bucket")[0].as_py() < 0:
        found.append((-1, keys.tobytes(), nodes.tobytes()))
    else:
        keys, nodes, links, _ = _cut_hot(keys, nodes, hot_key, hot)
        same = keys[1:] == keys[:-1]
        shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        keys, nodes = keys[shared], nodes[shared]
        if named:
            keys, nodes = named(keys, nodes)
        part = nodes % parts
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        if len(links):
            found.append((-1, links[:, 0].tobytes(), links[:, 1].tobytes()))
        for number in np.flatnonzero(np.diff(cuts)).tolist():
            own = order[cuts[number] : cuts[number + 1]]
            found.append((number, keys[own].tobytes(), nodes[own].tobytes()))
    schema = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("nodes", pa.binary())])
    return pa.Table.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(schema.types)], schema=schema)


def _keys_by_class(rows: pa.Table) -> pa.Table:
    """node, keys: the distinct shared keys of all buckets, a row per class of the part."""
    keys, nodes = _distinct(_joined(rows, "keys", "<u8"), _joined(rows, "nodes", "<i8"))
    starts = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]]))
    content = [own.tobytes() for own in np.split(keys, starts[1:])]
    return pa.table([pa.array(nodes[starts]), pa.array(content, pa.binary())], names=["node", "keys"])


def _pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b: links of hot keys, from their packed ends."""
    for batch in batches:
        for a, b in zip(batch.column("keys"), batch.column("nodes"), strict=True):
            ends = [pa.array(np.frombuffer(end.as_buffer(), "<i8")) for end in (a, b)]
            for start in range(0, len(ends[0]), PAIR_ROWS):
                yield pa.RecordBatch.from_arrays([end.slice(start, PAIR_ROWS) for end in ends], ["a", "b"])


_PACKET = ["bucket", "nodes", "sizes", "sketches", "counts", "keys"]


def packets(classes: DataFrame, buckets: int) -> DataFrame:
    """Classes (node, n, sketch, keys) in packets, one row per bucket that one of their keys falls into."""

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, sizes, sketches, keys, waiting = [], [], [], [], 0

        def out() -> pa.RecordBatch:
            all_keys = np.concatenate(keys)
            owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            bucket = (all_keys // np.uint64(buckets) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")  # keys of a bucket stay in the order of their owners
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            ids, lengths = np.array(nodes, "<i8"), np.array(sizes, "<i8")
            found = []
            for number in range(buckets):
                own = order[cuts[number] : cuts[number + 1]]
                if len(own):
                    who, counts = np.unique(owner[own], return_counts=True)
                    bits = np.concatenate([sketches[w] for w in who.tolist()])
                    parts = ids[who], lengths[who], bits, counts.astype("<i8"), all_keys[own]
                    found.append((number, *(p.tobytes() for p in parts)))
            kinds = [pa.int32(), *[pa.binary()] * 5]
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*found, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, _PACKET)

        for batch in batches:
            columns = (batch.column(c) for c in ("node", "n", "sketch", "keys"))
            for node, n, sketch, own_keys in zip(*columns, strict=True):
                nodes.append(node.as_py())
                sizes.append(n.as_py())
                sketches.append(np.frombuffer(sketch.as_py(), "<u8"))
                keys.append(np.frombuffer(own_keys.as_py(), "<u8"))
                waiting += len(keys[-1])
                if waiting >= PACKET_KEYS:
                    yield out()
                    nodes, sizes, sketches, keys, waiting = [], [], [], [], 0
        if keys:
            yield out()

    kinds = ", ".join(f"{name} binary" for name in _PACKET[1:])
    return classes.select("node", "n", "sketch", "keys").mapInArrow(lean(packed), f"bucket int, {kinds}")


class _Forest:
    """Union-find that keeps the links which join two trees."""

    def __init__(self, size: int):
        self._parent = list(range(size))
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        parent = self._parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, x: int, y: int, keep: bool = True) -> None:
        x_root, y_root = self.root(x), self.root(y)
        if x_root != y_root:
            self._parent[max(x_root, y_root)] = min(x_root, y_root)
            if keep:
                self.links.append((x, y))


def _close(bands: Bands, sizes: np.ndarray, sketches: Parities, x, y: np.ndarray) -> np.ndarray:
    """Whether sizes and sketches allow the classes x (one or as many as y) and y to link."""
    found = bands.possible(sizes[x], sizes[y])
    at = np.flatnonzero(found)
    x = np.broadcast_to(x, y.shape)[at]
    found[at] = sketches.distances(x, y[at]) <= bands.budget(sizes[x] + sizes[y[at]])
    return found


def _forest_of_bucket(bands: Bands):
    def forest(rows: pa.Table) -> pa.Table:
        nodes, first, number = np.unique(_joined(rows, "nodes", "<i8"), return_index=True, return_inverse=True)
        sizes = _joined(rows, "sizes", "<i8")
        ends = np.cumsum(parity_words(sizes))
        sketches = Parities(sizes[first], (ends - parity_words(sizes))[first], _joined(rows, "sketches", "<u8"))
        sizes = sizes[first]
        owner = np.repeat(number.astype(np.int32), _joined(rows, "counts", "<i8"))
        keys = _joined(rows, "keys", "<u8")
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        del order
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        lengths = np.diff(np.append(starts, len(keys)))
        del keys
        trees = _Forest(len(nodes))
        twos = starts[lengths == 2]
        if len(twos):
            pairs = np.sort(np.stack([owner[twos], owner[twos + 1]], axis=1), axis=1)
            pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
            pairs = pairs[_close(bands, sizes, sketches, pairs[:, 0], pairs[:, 1])]
            for x, y in pairs.tolist():
                trees.join(x, y)
        for start, length in zip(starts[lengths > 2].tolist(), lengths[lengths > 2].tolist(), strict=True):
            left = np.unique(owner[start : start + length])  # a class may be in several packets
            while len(left):
                queue, left = [int(left[0])], left[1:]
                while queue and len(left):
                    x = queue.pop()
                    near = _close(bands, sizes, sketches, x, left)
                    for y in left[near].tolist():
                        trees.join(x, y)
                        queue.append(y)
                    left = left[~near]
        links = np.array(trees.links, np.int64).reshape(-1, 2)
        return pa.table({"a": nodes[links[:, 0]], "b": nodes[links[:, 1]]})

    return forest


def _filter(nodes: DataFrame) -> np.ndarray:
    """Bits of the nodes' hashes, a power of two by their number; eight partial filters come to the driver."""
    size = 1 << max(16, (FILTER_BITS_EACH * nodes.count()).bit_length())
    size = min(size, MOST_FILTER_BITS)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, bool)
        for batch in batches:
            bits[batch.column("node").to_numpy() % size] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()])], ["bits"])

    found = np.zeros(size // 8, np.uint8)
    for row in nodes.select("node").coalesce(8).mapInArrow(lean(partial), "bits binary").toLocalIterator():
        found |= np.frombuffer(row["bits"], np.uint8)
    return np.unpackbits(found).astype(bool)


def sets_of(rows: DataFrame, words: int, nodes: DataFrame) -> DataFrame:
    """node, shingles of the classes in ``nodes`` (and of a few others)."""
    sent = rows.sparkSession.sparkContext.broadcast(np.packbits(_filter(nodes)))  # 16 MB at most

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = np.unpackbits(sent.value).astype(bool), set()
        for batch in batches:
            found = []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py(), words)
                node = _node(shingles)
                if wanted[node % len(wanted)] and node not in seen:
                    seen.add(node)
                    found.append((node, shingles.tobytes()))
            if found:
                ids, content = zip(*found, strict=True)
                arrays = [pa.array(ids, pa.int64()), pa.array(content, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["node", "shingles"])

    return rows.select("text").mapInArrow(lean(sets), "node long, shingles binary")


def _compared(bands: Bands):
    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for one, other in zip(batch.column("shingles"), batch.column("centre"), strict=True):
                a, b = np.frombuffer(one.as_py(), "<u8"), np.frombuffer(other.as_py(), "<u8")
                common = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(bool(bands.linked(common, len(a) + len(b))))
            arrays = [batch.column("tree"), batch.column("node"), pa.array(linked, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, ["tree", "node", "linked"])

    return compare


def _links_of_tile(bands: Bands):
    def links(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["seeker", "node"], ignore_index=True)
        sets = [np.frombuffer(s, "<u8") for s in rows["shingles"]]
        members = np.flatnonzero(~rows["seeker"])
        elements = np.concatenate([sets[m] for m in members] or [np.zeros(0, np.uint64)])
        owner = np.repeat(members, [len(sets[m]) for m in members])
        order = np.argsort(elements, kind="stable")
        elements, owner = elements[order], owner[order]
        sizes, nodes = np.array([len(s) for s in sets]), rows["node"].to_numpy()
        number = {node: m for m, node in zip(members, nodes[members], strict=True)}
        trees = _Forest(len(rows))
        with_centre = [m for m in members if rows["linked"][m]]
        for m in with_centre[1:]:
            trees.join(with_centre[0], int(m), keep=False)  # known to be in one component
        for seeker in np.flatnonzero(rows["seeker"]):
            if nodes[seeker] in number:
                trees.join(int(number[nodes[seeker]]), int(seeker), keep=False)  # the same class in both roles
            low, high = (np.searchsorted(elements, sets[seeker], side) for side in ("left", "right"))
            lengths = high - low
            at = np.repeat(low - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
            common = np.bincount(owner[at], minlength=len(rows))
            found = bands.linked(common, sizes + sizes[seeker]) & (common > 0) & (nodes != nodes[seeker])
            for m in np.flatnonzero(found).tolist():
                trees.join(int(seeker), m)
        made = np.array(trees.links, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": nodes[made[:, 0]], "b": nodes[made[:, 1]]})

    return links


def _exact_links(members: DataFrame, bands: Bands) -> DataFrame:
    """a, b: links with the same components as all links within the trees of ``members`` (tree, node, shingles)."""
    centres = members.where("tree = node").select("tree", F.col("shingles").alias("centre"))
    others = members.where("tree <> node")
    compared = others.join(centres, "tree").mapInArrow(lean(_compared(bands)), "tree long, node long, linked boolean")
    compared = written(compared, "compared")
    counts = compared.groupBy("tree").agg(F.count(F.lit(1)).alias("m"), F.sum((~F.col("linked")).cast("long")).alias("u"))
    counts = written(counts.where("u > 0 and m > 1"), "open-trees")
    tiles = counts.select(
        "tree", F.ceil(F.col("m") / TILE_MEMBERS).alias("i_tiles"), F.ceil(F.col("u") / TILE_SEEKERS).alias("j_tiles")
    )
    rest = others.join(compared.join(tiles, "tree").select("node", "linked", "i_tiles", "j_tiles"), "node")
    turn, every = F.xxhash64("node"), lambda tiles: F.explode(F.sequence(F.lit(0).cast("long"), F.col(tiles) - 1))
    columns = ["tree", "node", "linked", "shingles"]
    looked_at = rest.select(
        *columns, F.lit(False).alias("seeker"), F.pmod(turn, "i_tiles").alias("i"), every("j_tiles").alias("j")
    )
    seekers = rest.where(~F.col("linked")).select(
        *columns, F.lit(True).alias("seeker"), every("i_tiles").alias("i"), F.pmod(turn, "j_tiles").alias("j")
    )
    found = looked_at.unionByName(seekers).groupBy("tree", "i", "j").applyInPandas(_links_of_tile(bands), "a long, b long")
    return compared.where("linked").select(F.col("tree").alias("a"), F.col("node").alias("b")).unionByName(found)


def _forest(
    rows: DataFrame, classes: DataFrame, words: int, bands: Bands, keys: int, hot_key: int
) -> DataFrame:
    """a, b: links that join all classes which may link into trees; ``keys`` is about the number of all keys."""
    buckets = max(8, keys // BUCKET_KEYS)
    sent = key_packets(rows, words, bands, buckets, hot_key)
    # Rows of bucket -1 are links on their way, dealt like any other bucket's by their first bytes.
    turn = F.when(F.col("bucket") < 0, F.xxhash64("nodes")).otherwise(F.col("bucket").cast("long"))
    parted = sent.withColumn("turn", turn).groupBy("turn").applyInArrow(
        lean_groups(lambda rows: _shared_keys(rows, hot_key, buckets, _named_by_classes)),
        "part int, keys binary, nodes binary",
    )
    found = written(parted, "shared-keys")
    shared = found.where("part >= 0")
    by_class = shared.groupBy("part").applyInArrow(lean_groups(_keys_by_class), "node long, keys binary")
    by_class = written(by_class, "keys-by-class")
    left = by_class.agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    sketched = by_class.join(classes.select("node", "n", "sketch"), "node")
    dealt = packets(sketched, max(8, left // 8 // BUCKET_KEYS)).groupBy("bucket")
    compared = dealt.applyInArrow(lean_groups(_forest_of_bucket(bands)), "a long, b long")
    return compared.unionByName(found.where("part < 0").select("keys", "nodes").mapInArrow(_pairs, "a long, b long"))


def join(
    docs: DataFrame, words: int, numerator: int, denominator: int, id_column: str = "doc_id", text_column: str = "text",
    hot_key: int = HOT_KEY,
) -> DataFrame:
    """id, n_shingles, component_id: texts link if their shingle sets' Jaccard similarity is at least the fraction."""
    bands, rows = Bands(numerator, denominator), _rows(docs, id_column, text_column)
    prints = fingerprints(rows, words)
    classes = prints.where("n > 0 and id is not null").groupBy("node").agg(
        F.min("id").alias("smallest"), F.max("n").alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"),
        F.first("sketch").alias("sketch"),
    )
    collision = F.raise_error(F.lit("two shingle sets share 64 bits of their digests")).cast("long")
    classes = classes.withColumn("n", F.when(F.col("low") == F.col("high"), F.col("n")).otherwise(collision))
    classes = written(classes.select("node", "smallest", "n", "sketch"), "shingle-classes")
    elements = classes.agg(F.sum("n")).first()[0] or 0
    keys = 2 * elements * (denominator - numerator) * 2 // (denominator + numerator)
    usable = rows.where("id is not null")
    forest = _forest(usable, classes, words, bands, keys, hot_key)
    trees = written(connected_components(forest).toDF("node", "tree"), "trees")
    sets = sets_of(usable, words, trees).groupBy("node").agg(F.first("shingles").alias("shingles"))
    members = written(sets.join(trees, "node"), "members")
    components = connected_components(_exact_links(members, bands)).toDF("node", "component")
    nodes = classes.join(written(components, "components"), "node", "left")
    nodes = nodes.select("node", "smallest", F.coalesce("component", "node").alias("component"))
    least = nodes.groupBy("component").agg(F.min("smallest").alias("component_id"))
    nodes = written(nodes.join(least, "component").select("node", "component_id"), "smallest-ids")
    alone = F.when(F.col("n") == 0, F.col("id")).otherwise(F.when(F.col("id").isNotNull(), F.col("component_id")))
    return prints.join(nodes, "node", "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), alone.alias("component_id")
    )


def without_near_copies(
    docs: DataFrame, words: int = 5, numerator: int = 80, denominator: int = 100, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row of each group of near copies, that of the smallest id, with all its columns.

    Rows are told apart by id and text, so a row with an id of its group's smallest row but another text is judged by
    its own text. Of rows equal in both one stays. Rows without an id or without words stay all.
    """
    mark, key_name, again = fresh_name("text"), fresh_name("key"), fresh_name("again")
    digest = F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    key = F.when(F.col("id").isNotNull(), F.struct("id", F.xxhash64("text").alias("own")))
    found = join(rows.withColumn("key", key), words, numerator, denominator, "key", "text")
    found = found.where("n_shingles > 0 and key is not null")
    usable = found.select("key", "component_id").distinct()
    dropped = written(usable.where("key <> component_id").select(F.col("key").alias(key_name)), "dropped")
    repeated = found.groupBy("key").count().where("count > 1")
    repeated = written(repeated.select(F.col("key").alias(again)), "repeated")
    marked = docs.withColumn(mark, F.struct(F.col(id_column).alias("id"), digest.alias("own")))
    left = marked.join(dropped, F.col(mark) == F.col(key_name), "left_anti")
    if repeated.isEmpty():
        return left.drop(mark)
    once = left.join(repeated, F.col(mark) == F.col(again), "left_anti").drop(mark)
    again = left.join(repeated, F.col(mark) == F.col(again), "left_semi").dropDuplicates([mark]).drop(mark)
    return once.unionByName(again)
