"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a key-only table may be broadcast. Every broadcast of a
#: table whose size follows the input is guarded by a count against this bound
#: and falls back to a shuffle join beyond it.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a temporary one is made if all runs on this machine
    (tests); a cluster needs the setting.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tracklens-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, tag: str, codec: str = "zstd", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage in a way that survives lost executors; the rows are computed
    once however often the result is used.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)
    out._shared_path = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Delete tables of ``written`` that no later plan reads."""
    for df in frames:
        path = getattr(df, "_shared_path", None)
        if path:
            jvm = df.sparkSession._jvm
            hadoop = df.sparkSession._jsc.hadoopConfiguration()
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(hadoop).delete(target, True)


def bounded_broadcast(df: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if it has at most ``bound`` rows, else ``df`` itself.

    The count stops at ``bound + 1`` rows, so the check itself stays small.
    """
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    Catalyst may inline a projected column into a lambda and evaluate it for
    each element; a lambda variable is bound to the computed value.
    """
    return F.transform(F.array(value), body)[0]
