import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from salesloom.session import cluster_settings
from salesloom.sources import storage, views
from salesloom.sources.tables import SCHEMAS, Tables


def test_declared_schemas_match_the_files(spark):
    root = "/root/testdata/sf0.001"
    tables = Tables(spark, root)
    for name in SCHEMAS:
        actual = spark.read.parquet(f"{root}/{name}.parquet").schema
        assert [(f.name, f.dataType) for f in getattr(tables, name).schema] == [(f.name, f.dataType) for f in actual]
    with pytest.raises(AttributeError):
        tables.unknown


def test_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    storage.replace_table(spark.range(3), path)
    storage.append_table(spark.range(3, 5), path)
    assert rows_of(spark.read.parquet(path)) == [(i,) for i in range(5)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        storage.replace_table(spark.range(1), path)


def test_frozen_rows_do_not_change(spark):
    kept = storage.frozen(spark.range(20).withColumn("r", F.rand()))
    assert rows_of(kept) == rows_of(kept)


class FakeSession:
    """Session settings only: what the choice of the shared folder looks at."""

    class sparkContext:
        master = "yarn"
        applicationId = "app"

    def __init__(self, **settings):
        self.conf = self
        self._settings = settings
        self.sparkContext = type("Context", (FakeSession.sparkContext,), {"getCheckpointDir": lambda _: None})()

    def get(self, key, default=None):
        return self._settings.get(key.replace(".", "_"), default)


def test_shared_folder_comes_from_the_session():
    assert storage.shared_folder(FakeSession(spark_checkpoint_dir="hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError):
        storage.shared_folder(FakeSession())


def test_views(spark):
    views.create_views({"small": spark.range(3)})
    views.create_views({"small": spark.range(2)})
    assert spark.sql("SELECT count(*) FROM small").first()[0] == 2
    views.drop_views(spark, "small")
    assert not spark.catalog.tableExists("small")


def test_cluster_settings_follow_the_input():
    small = cluster_settings(1 << 30, 100)
    large = cluster_settings(100 << 40, 4000)
    assert small["spark.sql.shuffle.partitions"] == "300"
    assert large["spark.sql.shuffle.partitions"] == "51200"
    assert large["spark.sql.files.maxPartitionBytes"] == str(512 << 20)


def test_a_second_try_of_a_load_replaces_the_first(spark, tmp_path):
    path, schema = f"{tmp_path}/table", spark.range(0).schema
    storage.append_batch(spark.range(3), path, "a")
    storage.append_batch(spark.range(3, 5), path, "b")
    storage.append_batch(spark.range(3, 6), path, "b")
    assert [r.id for r in storage.stored(spark, path, schema).orderBy("id").collect()] == [0, 1, 2, 3, 4, 5]
    others = storage.stored(spark, path, schema, without="b")
    assert [r.id for r in others.orderBy("id").collect()] == [0, 1, 2]
    storage.append_batch(others.select((F.col("id") + 10).alias("id")), path, "b")  # reads the table it appends to
    assert [r.id for r in storage.stored(spark, path, schema).orderBy("id").collect()] == [0, 1, 2, 10, 11, 12]
