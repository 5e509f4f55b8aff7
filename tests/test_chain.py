"""Slide metadata and the whole way from slides to stacks, on made slides."""

import numpy as np
import pytest

from lamella.operators import labels as lab, matching as mat
from lamella.plans import chain
from lamella.sources import metadata, sinks

XML = """<?xml version="1.0" encoding="UTF-8"?><OME xmlns="http://www.openmicroscopy.org/Schemas/OME/2016-06"><Image><Pixels SizeX="{0}" SizeY='9' PhysicalSizeX="{1}" PhysicalSizeXUnit="{2}" PhysicalSizeY="0.5"/></Image></OME>"""


def test_sizes_and_factors(spark):
    slides = spark.createDataFrame([(0, XML.format(7, "500", "nm")), (1, XML.format(7, "0.0005", "mm")), (2, None)], "slice_id long, ome_xml string")
    sizes = metadata.slide_sizes(slides)
    assert {(r.slice_id, r.dimension): round(r.value_um, 9) for r in sizes.collect()} == {(0, "X"): 0.5, (0, "Y"): 0.5, (1, "X"): 0.5, (1, "Y"): 0.5}
    factors = metadata.scale_factors(sizes.where("slice_id = 0").select("dimension", "value_um"))
    assert {r.dimension: r.factor for r in factors.collect()} == {"X": 8, "Y": 8}
    new = metadata.resized_xml(slides.selectExpr("*", "31 AS width", "17 AS height")).orderBy("slice_id").first().ome_xml
    assert 'SizeX="31"' in new and "SizeY='17'" in new and 'PhysicalSizeX="500"' in new


def test_unknown_unit(spark):
    slides = spark.createDataFrame([(0, XML.format(7, "1", "parsec"))], "slice_id long, ome_xml string")
    with pytest.raises(Exception, match="unknown unit"):
        metadata.slide_sizes(slides).collect()


def slides_of(spark, side, size, corners, moves):
    rng = np.random.default_rng(5)
    texture = [np.kron(rng.integers(80, 200, (2, -(-size // 4), -(-size // 4))), np.ones((1, 4, 4), int))[:, :size, :size] for _ in corners]
    cells = []
    for z, (dy, dx) in enumerate(moves):
        v = np.zeros((2, side, side), np.int64)
        for (y, x), t in zip(corners, texture, strict=True):
            v[:, y + dy : y + dy + size, x + dx : x + dx + size] = t
        cells += [(z, c, y, x, int(v[c, y, x])) for c in range(2) for y in range(side) for x in range(side)]
    return spark.createDataFrame(cells, "z long, c long, y long, x long, v long"), texture


def test_two_tissues_from_slides_to_aligned_stacks(spark, tmp_path):
    slides, texture = slides_of(spark, 72, 28, ((3, 3), (38, 39)), ((0, 0), (1, 2)))
    out = chain.run(slides, 1, 1, 72, 72, chain.Settings(num_tissue=2, thresh=40, kernel_size=5, padding=2))
    objects = {(r.z, r.idx): r for r in out.objects.collect()}
    assert sorted(objects) == [(0, 1), (0, 2), (1, 1), (1, 2)]
    assert objects[0, 1].cx < objects[0, 2].cx
    assert len(out.boxes.collect()) == 4
    sizes = out.stacks.groupBy("idx", "z", "c").agg({"y": "max", "x": "max"}).toDF("idx", "z", "c", "h", "w").collect()
    assert len(sizes) == 8
    # The refined masks keep each tissue's own pixels.
    kept = {(r.idx, r.z): r["count"] for r in out.stacks.where("c = 0 and v > 0").groupBy("idx", "z").count().collect()}
    assert kept == {(i, z): 28 * 28 for i in (1, 2) for z in (0, 1)}
    assert out.status.count() == 2 and out.status.where("status = 'failed'").count() == 0
    aligned = out.aligned.toPandas()
    assert set(zip(aligned.idx, aligned.z, aligned.c, strict=True)) == {(i, z, c) for i in (1, 2) for z in (0, 1) for c in (0, 1)}
    # Both slices of a tissue show the same picture once they are aligned.
    wide = aligned.pivot_table(index=["idx", "c", "y", "x"], columns="z", values="v").dropna()
    assert len(wide[wide[0] > 0]) >= 4 * 26 * 26 and (wide[0] - wide[1]).abs().median() < 1
    metrics = {r.idx: r for r in out.metrics.collect()}
    assert sorted(metrics) == [1, 2] and all(r.dice > 0.9 and r.agreement > 0.9 for r in metrics.values())
    sinks.write_stacks(out.stacks, f"{tmp_path}/stacks")
    back = spark.read.parquet(f"{tmp_path}/stacks").select(out.stacks.columns)
    assert back.count() == out.stacks.count() and (tmp_path / "stacks" / "idx=2").is_dir()
    assert back.selectExpr("sum(hash(cast(idx AS long), z, c, y, x, v))").first() == out.stacks.selectExpr("sum(hash(cast(idx AS long), z, c, y, x, v))").first()


def test_different_numbers_of_tissues(spark):
    slides, _ = slides_of(spark, 24, 8, ((2, 2), (12, 12)), ((0, 0), (1, 1)))
    one = slides.where("z = 0 or y < 11").unionByName(slides.where("z = 1 and y >= 11").selectExpr("z", "c", "y", "x", "0L AS v"))
    mask = one.where("c = 0").selectExpr("z", "y", "x", "cast(v > 0 as long) AS v")
    with pytest.raises(Exception, match="different numbers"):
        chain.detect(mask, 8)


def test_stack_metrics(spark):
    """Columns 0-3 of slice 0 against 2-5 of slice 1; a stack of one slice; one that is empty throughout."""
    cells = [(1, z, 0, 0, x, int(a <= x <= b)) for z, a, b in ((0, 0, 3), (1, 2, 5)) for x in range(8)]
    cells += [(2, 5, 0, 0, x, 1) for x in range(3)] + [(3, z, 0, 0, x, 0) for z in (0, 2) for x in range(3)]
    got = {r.idx: (r.dice, r.agreement) for r in mat.stack_metrics(spark.createDataFrame(cells, "idx long, z long, c long, y long, x long, v long")).collect()}
    assert got[1] == (0.5, 1.0) and got[2] == (0.0, 0.0) and all(np.isnan(v) for v in got[3])


def test_background_in_the_size_cut(spark):
    stats = spark.createDataFrame([(0, 1, 50), (0, 2, 9), (0, 3, 7)], "z long, label long, area long")
    kept = lambda plane: sorted(r.label for r in lab.top_components(stats, 1, plane).collect())
    assert kept(1000) == [1] and kept(70) == [1, 2] and kept(None) == [1]


def test_sources_without_overlap(spark):
    counts = spark.createDataFrame([(0, 1, 4, 3)], "z long, src long, dst long, n long")
    sources = spark.createDataFrame([(0, 1), (0, 2), (1, 7)], "z long, src long")
    assert sorted((r.z, r.src, r.dst, r.n) for r in mat.greedy_matches(counts, sources).collect()) == [(0, 1, 4, 3), (0, 2, None, 0), (1, 7, None, 0)]
