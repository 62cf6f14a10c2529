"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: list[str] = []

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session may leave it unset; it gets a local folder.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="spark-shared-"))
        atexit.register(shutil.rmtree, _LOCAL[0].removeprefix("file://"), True)
    return _LOCAL[0]


class Scratch:
    """Tables in the shared folder that go when the block ends.

    What outlives the block must be stored outside of it.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.places, self.tables = spark, [], []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop()

    def drop(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in self.places:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
        self.places, self.tables = [], []

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = _new_place(self.spark, name)
        self.places.append(path)
        return _written(df, path)


def _new_place(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidemark-{name}-{uuid.uuid4().hex}"


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again.

    Cuts the lineage so that later passes and lost executors start from files. For
    what a result still reads when it is returned; all else belongs in a ``Scratch``.
    """
    return _written(df, _new_place(df.sparkSession, name))


def stored_by(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Like ``stored``, but in buckets by ``key``, so that a later grouping by it needs no shuffle.

    Only the files stay; the catalog's entry, without which Spark writes no buckets, goes at once.
    """
    spark = df.sparkSession
    path = _new_place(spark, name)
    table = f"tidemark_{uuid.uuid4().hex}"
    most = "spark.sql.sources.bucketing.maxBuckets"
    if buckets > int(spark.conf.get(most)):
        spark.conf.set(most, buckets)
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(table)
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return rows


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(col, UPPER, UPPER.lower())


def slim(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: extra ones, whatever their names, can't clash."""
    return df.select(*(F.col(f"`{n}`") for n in names))


def partitions_for(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
