"""Tables that cut a lineage: written to the folder all machines share, read back from there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[str] = []
#: Names in the catalog of those of them that are tables in buckets.
_NAMED: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only where that is unset and all tasks run in this
    process (tests). On a cluster each machine would write to a folder of its own, so that raises ValueError."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and return a frame that reads it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(schema).parquet(path)


def written() -> int:
    """How many tables there are by now, as a mark for release()."""
    return len(_WRITTEN)


class Buckets:
    """A table in the shared folder that grows in steps and lies in buckets by one column, so that grouping by that column
    needs no shuffle."""

    def __init__(self, spark: SparkSession, name: str, key: str, n: int):
        self.spark, self.key, self.n = spark, key, min(n, 65536)
        self.name = f"{name}_{uuid.uuid4().hex}"
        self.path = f"{shared_folder(spark)}/{self.name}"
        _WRITTEN.append(self.path)
        _NAMED[self.path] = self.name

    def add(self, df: DataFrame, deal: bool = False) -> None:
        """deal: bring the rows of a bucket together first, where many tasks have a few of each."""
        df = df.repartition(self.n, self.key) if deal else df
        df.write.format("parquet").mode("append").bucketBy(self.n, self.key).option("path", self.path).saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)


def release(spark: SparkSession, since: int = 0, last: bool = True) -> int:
    """Delete the tables written since a mark, once the results that read them are stored; their number. The newest table
    stays if not last: it is what a finished step has left to the next one."""
    hadoop, n = spark._jvm.org.apache.hadoop.fs, 0
    old = _WRITTEN[since:] if last else _WRITTEN[since:-1]
    _WRITTEN[since:] = [] if last else _WRITTEN[max(since, len(_WRITTEN) - 1) :]
    for path in old:
        if path in _NAMED:  # the catalog doesn't own the folder of such a table
            spark.sql(f"DROP TABLE IF EXISTS `{_NAMED.pop(path)}`")
        place = hadoop.Path(path)
        n += bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True))
    return n
