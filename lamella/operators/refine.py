"""Full-resolution masks of cropped tissues."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .labels import checkpointed, connected_components, fill_blocks, shuffled
from .morphology import as_blocks, block_sequence, from_blocks


def refine_mask(planes: DataFrame, under: DataFrame, threshold: int, k: int, last: int = 70) -> tuple[DataFrame, DataFrame]:
    """(mask, status) of dense planes (z, y, x, v), where z is any key of a crop and ``under`` (z, y, x) is its rough mask.

    Pixels above threshold div 2 are closed, eroded and dilated, opened, closed and dilated again, holes below a tenth
    of the plane go, and after a last dilation the component found most often under the rough mask (the background
    counts too, the lowest label wins ties) is closed by ``last`` small kernels and filled.  A plane with nothing under its
    rough mask has an empty mask and the status 'empty'; if the background is found, its status is 'background'.
    """
    small = k // 5
    m = planes.select("z", "y", "x", (F.col("v") > threshold // 2).cast("long").alias("v"))
    blocks = block_sequence(as_blocks(m), [(operation, small) for operation in ("closing", "erosion", "dilation", "opening", "closing")] + [("dilation", 4 * small)])
    m = checkpointed(from_blocks(block_sequence(fill_blocks(blocks, F.expr("(h * w) div 10")), [("dilation", small)])))
    labels = checkpointed(m.join(shuffled(connected_components(m.where("v = 1"))), ["z", "y", "x"], "left").select("z", "y", "x", F.when(F.col("v") == 1, F.col("label")).otherwise(-1).alias("label")))
    chosen = shuffled(under).join(labels, ["z", "y", "x"]).groupBy("z").agg(F.mode("label", True).alias("chosen"))
    picked = labels.join(chosen, "z", "left").select("z", "y", "x", F.coalesce(F.col("label") == F.col("chosen"), F.lit(False)).cast("long").alias("v"))
    mask = from_blocks(fill_blocks(block_sequence(as_blocks(picked), [("closing", last * small)]), F.expr("(h * w) div 100")))
    status = planes.select("z").distinct().join(chosen, "z", "left").select("z", F.when(F.col("chosen").isNull(), "empty").when(F.col("chosen") == -1, "background").otherwise("found").alias("status"))
    return shuffled(mask).join(status, "z").select("z", "y", "x", F.when(F.col("status") == "empty", 0).otherwise(F.col("v")).cast("long").alias("v")), status
