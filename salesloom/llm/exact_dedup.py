"""Exact deduplication against immutable snapshots screened by static binary-fuse filters.

A snapshot is a table of text classes (one row per digest, dealt into buckets of bounded size) with one
binary-fuse filter per bucket; neither changes once written. An incoming batch is first grouped by digest for
itself. Its distinct digests meet the filters of their buckets: those that a filter rejects are new, the others are
joined with the exact bucket, where a filter's false positives fall out. Members of every class of two rows or more
then have their texts compared byte by byte.

Texts are equal when they are identical without the characters ``[\\x20\\x09-\\x0D]``. Of equal texts the row with
the most code points stays, then the smallest id. A null text counts as empty; empty texts equal each other. A null
id is larger than every other; rows that repeat an id count one by one and share its outcome. Only the two named
columns are read, so further columns and their names do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm import fuse_filter
from salesloom.llm.shared import fresh_name, written

WHITE_SPACE = " \t\n\x0b\x0c\r"
#: Digests of a bucket on average, which bounds a filter and the rows that build it.
BUCKET_DIGESTS = 8192


@dataclass
class Snapshot:
    classes: DataFrame  # digest, bucket, n, best
    filters: DataFrame  # bucket, filter
    buckets: int


def squeezed(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(squeezed(text), 256))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_chars, digest of every row, written once: the texts are not needed again but for byte checks."""
    text = F.col(text_column)
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.length(F.coalesce(text, F.lit(""))).cast("long").alias("n_chars"),
        _digest(text).alias("digest"),
    )
    return written(rows, "fingerprints")


def classes_of(prints: DataFrame) -> DataFrame:
    """One row per digest: how many rows have it and the best of them. Copies are combined before the shuffle."""
    best = F.struct((-F.col("n_chars")).alias("shorter"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id"))
    return prints.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(best).alias("best"))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")


def _keys(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(d[:8] for d in digests), dtype="<u8")


def _filter_of_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    built = fuse_filter.build(_keys(rows["digest"]))
    return pd.DataFrame({"bucket": rows["bucket"].iloc[:1], "filter": [built]})


def take_snapshot(prints: DataFrame) -> Snapshot:
    """The classes of ``prints`` and their filters, both written to the shared folder."""
    classes = written(classes_of(prints), "classes")
    buckets = max(1, classes.count() // BUCKET_DIGESTS)
    classes = classes.withColumn("bucket", _bucket(buckets))
    filters = classes.select("bucket", "digest").groupBy("bucket")
    filters = filters.applyInPandas(_filter_of_bucket, "bucket int, filter binary")
    return Snapshot(classes, written(filters, "filters"), buckets)


def _screened(rows: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    content = filters["filter"].iloc[0] if len(filters) else b""
    return rows.assign(positive=fuse_filter.contains(content, _keys(rows["digest"])))[["digest", "positive"]]


def screen(snapshot: Snapshot, batch_classes: DataFrame) -> DataFrame:
    """digest, positive of a batch's distinct digests; a digest of the snapshot is always positive."""
    asked = batch_classes.select("digest", _bucket(snapshot.buckets).alias("bucket"))
    pairs = asked.groupBy("bucket").cogroup(snapshot.filters.groupBy("bucket"))
    return pairs.applyInPandas(_screened, "digest binary, positive boolean")


def fold_in(snapshot: Snapshot, batch_classes: DataFrame) -> DataFrame:
    """Classes of the snapshot and the batch together: digest, n, best."""
    batch = batch_classes.join(screen(snapshot, batch_classes), "digest")
    batch = written(batch, "screened")
    positive = batch.where("positive").select("digest", F.col("n").alias("more"), F.col("best").alias("rival"))
    known = snapshot.classes.join(positive, "digest", "left").select(
        "digest",
        (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"),
        F.least("best", F.coalesce("rival", "best")).alias("best"),
    )
    unknown = batch.where("positive").join(snapshot.classes.select("digest"), "digest", "left_anti")
    return known.unionByName(batch.where("not positive").unionByName(unknown).select("digest", "n", "best"))


def _byte_checked(docs: DataFrame, id_column: str, text_column: str, members: DataFrame) -> DataFrame:
    """digest of each class of several rows whose texts are the same bytes; different texts are an error.

    The texts are dealt by id and digest, so a large class is spread, and its copies are combined before they
    meet: the smallest and the largest text of a class are equal or not.
    """
    text = F.col(text_column)
    rows = docs.select(
        F.coalesce(F.col(id_column), F.lit(-1)).alias("id"), _digest(text).alias("digest"), squeezed(text).alias("same")
    )
    rows = rows.join(members.withColumn("id", F.coalesce("id", F.lit(-1))), ["id", "digest"], "left_semi")
    ends = rows.groupBy("digest").agg(F.min("same").alias("low"), F.max("same").alias("high"))
    equal = F.col("low") == F.col("high")
    collision = F.raise_error(F.concat(F.lit("different texts share the digest "), F.hex("digest"))).cast("boolean")
    return ends.select("digest", F.when(equal, F.lit(True)).otherwise(collision).alias("checked"))


def dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Half of the rows, dealt by a hash of the id, are taken as the snapshot and the rest as a batch that comes later.
    """
    prints = fingerprints(docs, id_column, text_column)
    earlier = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    snapshot = take_snapshot(prints.where(earlier))
    groups = fold_in(snapshot, classes_of(prints.where(~earlier))).where("n > 1")
    groups = written(groups.select("digest", "n", F.col("best.id").alias("keep_id")), "groups")
    members = prints.join(groups.select("digest"), "digest", "left_semi").select("id", "digest")
    groups = written(groups.join(_byte_checked(docs, id_column, text_column, members), "digest"), "checked")
    rows = prints.join(groups, "digest", "left")
    keep = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return rows.select(
        F.col("id").alias(id_column),
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all its columns; of rows equal in id and text one stays."""
    key, again = fresh_name("key"), fresh_name("again")
    found = dedup(docs, id_column, text_column)
    found = found.select(F.struct(F.col(id_column).alias("id"), F.unhex("text_sha256").alias("digest")).alias(key), "kept")
    found = written(found, "kept")
    dropped = found.where("not kept").select(F.col(key).alias(again))
    marked = docs.withColumn(key, F.struct(F.col(id_column).alias("id"), _digest(F.col(text_column)).alias("digest")))
    left = marked.join(dropped, F.col(key) == F.col(again), "left_anti")
    repeated = written(found.where("kept").groupBy(F.col(key).alias(again)).count().where("count > 1").select(again), "repeated")
    if repeated.isEmpty():
        return left.drop(key)
    once = left.join(repeated, F.col(key) == F.col(again), "left_anti").drop(key)
    one = left.join(repeated, F.col(key) == F.col(again), "left_semi").dropDuplicates([key]).drop(key)
    return once.unionByName(one)
