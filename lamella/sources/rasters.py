"""Rasters as tables: from the driver's tables, from image folders and from channel lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.labels import checkpointed


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def embedding_raster(spark: SparkSession, folder: str) -> DataFrame:
    """Dense planes (z, y, x, v): a vector is a row of 64 pixels, 64 vectors are a plane."""
    cells = table(spark, folder, "embeddings").select("vec_id", F.posexplode("embedding").alias("p", "e"))
    return cells.select(
        F.expr("vec_id div 64").alias("z"), (F.col("vec_id") % 64).alias("y"), F.col("p").cast("long").alias("x"),
        F.floor((F.col("e").cast("double") + 1) * 128).alias("v"),
    )


def lineitem_raster(spark: SparkSession, folder: str) -> DataFrame:
    """Sparse multichannel planes (z, c, y, x, v): quantities by flag, line, supplier and part; a missing pixel is 0."""
    cells = table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("z"), F.col("l_linenumber").cast("long").alias("c"), (F.col("l_suppkey") % 50).alias("y"),
        (F.col("l_partkey") % 50).alias("x"), F.floor("l_quantity").alias("q"),
    )
    return cells.groupBy("z", "c", "y", "x").agg(F.sum("q").alias("v"))


def slide_files(spark: SparkSession, folder: str, suffix: str = "qptiff") -> DataFrame:
    """Image files of a folder with slice_id by the first three characters of the name in lower case, then the name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{suffix}").load(folder).select("path", "length")
    return order_files(files.withColumn("name", F.element_at(F.split("path", "/"), -1)))


def order_files(files: DataFrame, name: str = "name") -> DataFrame:
    """``files`` with slice_id from 0: range-sorted, numbered inside each partition, and moved on by the rows of those before it."""
    columns = [c for c in files.columns if c != "slice_id"]
    at = checkpointed(files.select(*columns).orderBy(F.lower(F.substring(name, 1, 3)), name).select(F.struct(*columns).alias("file"), F.monotonically_increasing_id().alias("at")))
    at = at.select("file", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("place"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    begins = at.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("begin"))  # a row for each partition
    return at.join(F.broadcast(begins), "part").select("file.*", (F.col("begin") + F.col("place")).alias("slice_id"))


def channel_names(spark: SparkSession, path: str) -> DataFrame:
    """(channel, name): a stripped line for each channel, blank lines kept."""
    text = spark.read.text(path, wholetext=True)
    lines = F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n")
    return text.select(F.posexplode(F.transform(lines, lambda line: F.trim(line))).alias("channel", "name"))


def physical_sizes(spark: SparkSession, sizes: DataFrame) -> DataFrame:
    """One size for each dimension of (slice_id, dimension, value_um); different ones raise an error when read."""
    one = sizes.groupBy("dimension").agg(F.count_distinct("value_um").alias("n"), F.min("value_um").alias("value_um"))
    bad = F.raise_error(F.concat(F.lit("different physical sizes along "), "dimension")).cast("double")
    return one.select("dimension", F.when(F.col("n") > 1, bad).otherwise(F.col("value_um")).alias("value_um"))
