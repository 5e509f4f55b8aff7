"""Where jobs cut their lineage: the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a local folder only where it is unset and Spark runs in one process, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return the table read back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def bucketed(df: DataFrame, name: str, keys: list[str], order: list[str]) -> DataFrame:
    """As :func:`stored`, in as many buckets by ``keys`` as shuffles have partitions, each sorted by ``order``: joins of such tables by ``keys`` need no shuffle.

    ``df`` should be dealt out by ``keys`` already, else each task writes to every bucket.  Don't group a union of such tables:
    Spark 4.1 takes it to be dealt out by ``keys`` even where it then reads the tables without their buckets.
    """
    spark = df.sparkSession
    path, table = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}", f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*order).option("path", path).saveAsTable(table)
    out = spark.table(table)
    out.stored_at, out.stored_as = path, table
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables of :func:`stored` and :func:`bucketed` that no later plan reads."""
    for table in tables:
        if hasattr(table, "stored_as"):
            table.sparkSession.sql(f"DROP TABLE IF EXISTS {table.stored_as}")
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """An eager reliable checkpoint (never a local one: executors may be lost)."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns which ``df`` doesn't have."""
    have = {c.lower() for c in df.columns}
    out = []
    for w in wanted:
        while w.lower() in have:
            w = "_" + w
        have.add(w.lower())
        out.append(w)
    return out


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of finished steps: it does so once their plans are garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
