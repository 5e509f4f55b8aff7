"""Slide metadata as tables: sizes and channels from OME-XML, scale factors, and the XML of a crop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed value: micrometres of a pixel that detection works at.
TARGET_UM = 4.058815539828226
#: Micrometres of a unit of length.
UNITS = {"m": 1e6, "cm": 1e4, "mm": 1e3, "µm": 1.0, "um": 1.0, "nm": 1e-3}


def _pixels(xml: Column, attribute: str) -> Column:
    return F.xpath_string(xml, F.lit(f"//*[local-name()='Pixels']/@{attribute}"))


def slide_sizes(slides: DataFrame, xml: str = "ome_xml") -> DataFrame:
    """(slice_id, dimension, value_um) of X, Y and Z from each slide's OME-XML; sizes without a unit are micrometres.

    A dimension without a size has no row; an unknown unit raises an error when read.
    """
    text = F.regexp_replace(F.col(xml), r"(?s)^\s*<\?xml.*?\?>", "")
    unit = F.create_map(*(F.lit(v) for pair in UNITS.items() for v in pair))
    parts = F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), _pixels(F.col("t"), f"PhysicalSize{d}").alias("s"), _pixels(F.col("t"), f"PhysicalSize{d}Unit").alias("u")) for d in "XYZ")))
    rows = slides.select("slice_id", text.alias("t")).select("slice_id", parts.alias("p")).where("p.s <> ''")
    one = F.when(F.col("p.u") == "", F.lit(1.0)).otherwise(F.coalesce(F.try_element_at(unit, F.col("p.u")), F.raise_error(F.concat(F.lit("unknown unit of length: "), "p.u")).cast("double")))
    return rows.select("slice_id", "p.dimension", (F.col("p.s").cast("double") * one).alias("value_um"))


def scale_factors(sizes: DataFrame, target_um: float = TARGET_UM) -> DataFrame:
    """(dimension, factor) of (dimension, value_um) rows for X and Y: whole pixels in a pixel of the target size."""
    return sizes.where("dimension in ('X', 'Y')").select("dimension", F.floor(F.lit(target_um) / F.col("value_um")).cast("int").alias("factor"))


def resized_xml(slides: DataFrame, xml: str = "ome_xml", width: str = "width", height: str = "height") -> DataFrame:
    """The slides with SizeX and SizeY of their XML replaced by a crop's width and height."""
    out = F.col(xml)
    for name, to in (("SizeX", width), ("SizeY", height)):
        out = F.regexp_replace(out, F.lit(rf"""(\b{name}=["'])[0-9]+"""), F.concat(F.lit("$1"), F.col(to).cast("string")))
    return slides.withColumn(xml, out)
