"""The command line: a folder of slides, or one, to stacks of tissues: ``python -m lamella.plans.command --input_path FOLDER``."""

from __future__ import annotations

import argparse
import dataclasses
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import raster as ras
from ..sources import metadata, sinks, slides, tiff
from ..sources.rasters import channel_names, physical_sizes
from . import chain


def options() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser()
    defaults = chain.Settings()
    for f in dataclasses.fields(chain.Settings):
        value = getattr(defaults, f.name)
        kind = {"action": "store_true"} if isinstance(value, bool) else {"type": float if isinstance(value, float) else int, "default": value}
        p.add_argument(f"--{f.name}", **kind)
    p.add_argument("--input_path", required=True, help="a folder of slides, or one slide")
    p.add_argument("--suffix", default="qptiff")
    p.add_argument("--level", type=int, default=0, help="0 is the whole size")
    p.add_argument("--output_dir", required=True, help="a folder that all executors share, as a URI or an absolute path")
    p.add_argument("--output_file_basename", default="aligned_tissue")
    p.add_argument("--channel_names", help="a text file with a name on each line")
    return p


def scales(info: DataFrame) -> tuple[int, int]:
    """Scale factors of x and y from the slides' OME-XML, or from their resolutions where they have none; different sizes raise an error."""
    told = metadata.slide_sizes(info.where("ome_xml is not null"))
    kinds = F.explode(F.array(*(F.struct(F.lit(d.upper()).alias("dimension"), F.col(f"{d}_um").alias("value_um")) for d in "xy"))).alias("s")
    rest = info.select("slice_id", kinds).select("slice_id", "s.*").where("value_um is not null").join(told, ["slice_id", "dimension"], "left_anti")
    sizes = physical_sizes(info.sparkSession, told.unionByName(rest))
    found = {r.dimension: max(r.factor, 1) for r in metadata.scale_factors(sizes).collect()}  # two rows
    if set(found) != {"X", "Y"}:
        raise ValueError("the slides don't tell the size of a pixel")
    return found["X"], found["Y"]


def _summed(stacks: DataFrame) -> DataFrame:
    """Channels added up modulo 256, as one channel."""
    sums = ras.channel_sum_u8(stacks.select(F.struct("idx", "z").alias("z"), "y", "x", "v"))
    return sums.select("z.idx", "z.z", F.lit(0).cast("long").alias("c"), "y", "x", "v")


def pixel_sizes(info: DataFrame) -> dict[str, float]:
    """Micrometres of a pixel along X and Y of the first slide, and along Z: its Y size as in the workflow this repeats, 1 without a Z size."""
    first = info.orderBy("slice_id").limit(1)
    told = {r.dimension: r.value_um for r in metadata.slide_sizes(first.where("ome_xml is not null")).collect()}
    row = first.first()
    sizes = {d: told.get(d, row[f"{d.lower()}_um"]) for d in "XY"}
    return sizes | {"Z": sizes["Y"] if "Z" in told else 1.0}


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    """Writes stacks, label images and reports below ``output_dir``; returns the tables that tell what was written.

    Each tissue's stack is one TIFF file with the slides' pixel sizes and the names of the channels; crops are a file
    for each tissue and slice with the slide's own description, its width and height changed.
    """
    info = tiff.slide_info(spark, args.input_path, args.suffix, args.level)
    sx, sy = scales(info)
    size = info.agg(F.min("height"), F.max("height"), F.min("width"), F.max("width")).first()
    if size[0] != size[1] or size[2] != size[3]:
        raise ValueError("the slides differ in height or width")
    settings = chain.Settings(**{f.name: getattr(args, f.name) for f in dataclasses.fields(chain.Settings)})
    boxed = lambda boxes: slides.read_slides(spark, args.input_path, args.suffix, args.level, boxes=boxes)
    out = chain.run(tiff.read_tiff(spark, args.input_path, args.suffix, args.level), sx, sy, size[0], size[2], settings, boxed)
    base = f"{args.output_dir.rstrip('/')}/{args.output_file_basename}"
    base = base if "://" in base else f"file://{Path(base).absolute()}"
    folder, stem = base.rsplit("/", 1)
    done = {}

    def report(name: str, table: DataFrame) -> None:
        table.write.json(f"{base}_{name}")
        done[name] = spark.read.schema(table.schema).json(f"{base}_{name}")

    names = None
    if args.channel_names:
        report("channels", channel_names(spark, args.channel_names))
        names = [r.name for r in done["channels"].orderBy("channel").collect()]  # a line of a text file each
    sizes = pixel_sizes(info)

    def stacks(name: str, pixels: DataFrame, ending: str, bits: int = 16, channels: list[str] | None = None) -> None:
        pixels = pixels.select(F.concat(F.lit(f"{stem}_"), F.col("idx").cast("string"), F.lit(ending)).alias("file"), "z", "c", "y", "x", "v")
        count = lambda c: F.count_distinct(c)
        each = pixels.groupBy("file").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"), count("z").alias("nz"), count("c").alias("nc"))
        told = each.select("file", tiff.ome_xml(F.col("h"), F.col("w"), F.col("nz"), F.col("nc"), channels, bits, sizes).alias("ome_xml"))
        done[name] = tiff.write_stacks(pixels, told, folder, bits)

    colours = sinks.label_colours(out.labels.select("z", "y", "x", F.col("idx").cast("long").alias("label")))
    sinks.write_images(sinks.png_tiles(colours), folder, f"{stem}_labels").write.json(f"{base}_labels")
    done["labels"] = spark.read.schema("path string").json(f"{base}_labels")
    if settings.crop_only:
        crops = out.stacks.withColumn("file", F.concat(F.lit(f"{stem}_"), F.col("idx").cast("string"), F.lit("_"), F.col("z").cast("string")))
        each = crops.groupBy("file", F.col("z").alias("slice_id")).agg((F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height"))
        told = metadata.resized_xml(each.join(info.select("slice_id", "ome_xml"), "slice_id", "left")).select("file", F.coalesce("ome_xml", F.lit("")).alias("ome_xml"))
        done["crops"] = tiff.write_stacks(crops.select("file", "z", "c", "y", "x", "v"), told, folder)
    else:
        stacks("sumChannels_beforeAlignment", _summed(out.stacks), "_sumChannels_beforeAlignment", 8)
    if out.trials is not None:
        sinks.write_trials(out.trials, f"{base}_trials")
        done["trials"] = out.trials
    elif out.aligned is not None:
        report("status", out.status)
        report("metrics", out.metrics)
        sinks.write_stacks(out.aligned, f"{base}_stacks")
        kept = spark.read.parquet(f"{base}_stacks").select("idx", "z", "c", "y", "x", F.bround("v").cast("long").alias("v"))
        stacks("sumChannels", _summed(kept), "_sumChannels", 8)
        stacks("aligned", kept, "", 16, names)
    report("stages", spark.createDataFrame(out.stages, "stage string, rows long, seconds double"))
    return done


def main() -> None:
    args = options().parse_args()
    done = run(SparkSession.builder.getOrCreate(), args)
    for name in ("metrics", "trials"):
        if name in done:
            done[name].show(truncate=False)


if __name__ == "__main__":
    main()
