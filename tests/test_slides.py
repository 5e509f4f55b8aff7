"""The slide source: rows as of the plain reader, and how many segments filters and boxes open."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan

import test_tiff
from lamella.sources import slides, tiff


@pytest.fixture
def folder(tmp_path):
    rng = np.random.default_rng(5)
    for name in ("b_two", "A_one", "c_three"):
        pages = [rng.integers(0, 200, (70, 90)).astype("u2") for _ in range(3)]
        test_tiff.write(tmp_path / f"{name}.qptiff", pages, tile=(16, 16), compression=5, predictor=2)
    return tmp_path


def opened(folder, filters=(), monkeypatch=None, **options):
    """(partitions, segments opened) of a read with filters."""
    reader = slides.SlideReader({"path": str(folder), **options}, "long")
    assert list(reader.pushFilters(list(filters))) == list(filters)  # Spark checks rows again
    count, real = [0], tiff._lines

    def counted(f, s):
        count[0] += 1
        return real(f, s)

    monkeypatch.setattr(tiff, "_lines", counted)
    parts = reader.partitions()
    rows = sum(b.num_rows for p in parts for b in reader.read(p))
    monkeypatch.setattr(tiff, "_lines", real)
    return len(parts), count[0], rows


def test_rows_equal_the_plain_reader(spark, folder, monkeypatch):
    a, b = slides.read_slides(spark, str(folder)), tiff.read_tiff(spark, str(folder))
    assert a.columns == b.columns and a.exceptAll(b).count() == b.exceptAll(a).count() == 0 and a.count() == 3 * 3 * 70 * 90
    near = (F.col("z") == 1) & F.col("c").isin(0, 2) & (F.col("y") >= 20) & (F.col("y") < 30) & (F.col("x") > 80)
    got = a.where(near)
    assert sorted(got.collect()) == sorted(b.where(near).collect()) and got.count() == 2 * 10 * 9
    assert a.where(near).rdd.getNumPartitions() == 2  # a band of segments in each of two pages
    one = slides.read_slides(spark, f"file://{folder}/b_two.qptiff")
    assert sorted(one.collect()) == sorted(tiff.read_tiff(spark, f"{folder}/b_two.qptiff").collect())


def test_filters_open_few_segments(folder, monkeypatch):
    monkeypatch.setattr(slides, "BAND", 1)
    segments = 5 * 6  # of a page
    assert opened(folder, monkeypatch=monkeypatch) == (3 * 3 * 5, 9 * segments, 9 * 70 * 90)
    z, c = EqualTo(("z",), 1), In(("c",), (0, 2))
    assert opened(folder, [z, c], monkeypatch)[1] == 2 * segments
    window = [GreaterThanOrEqual(("y",), 20), LessThan(("y",), 33), EqualTo(("x",), 40)]
    assert opened(folder, [z, *window], monkeypatch)[:2] == (3 * 2, 3 * 2)
    assert opened(folder, [EqualTo(("z",), 7)], monkeypatch) == (0, 0, 0)


def test_boxes_open_few_segments(spark, folder, monkeypatch):
    boxes = [(0, 0, 0, 10, 10), (2, 30, 60, 50, 70)]
    assert opened(folder, monkeypatch=monkeypatch, boxes=str([list(b) for b in boxes]))[1] == 3 * (1 + 2 * 3)
    got = slides.read_slides(spark, str(folder), boxes=boxes)
    inside = "z = 0 and x < 10 and y < 10 or z = 2 and x >= 30 and x < 50 and y >= 60 and y < 70"
    assert sorted(got.where(inside).collect()) == sorted(tiff.read_tiff(spark, str(folder)).where(inside).collect())
    assert slides.read_slides(spark, str(folder), boxes=[]).count() == 0


def test_places_of_segments_are_read_by_tasks(folder):
    with tiff._open(f"{folder}/b_two.qptiff") as f:
        whole, lazy = tiff._pages(f), tiff._pages(f, 64)
        for a, b in zip(whole, lazy, strict=True):
            assert b[0][tiff.TILES][0] == tiff.LATER
            assert tiff._values(f, b[0], tiff.TILES, 7, 5) == a[0][tiff.TILES][7:12] == tiff._values(f, a[0], tiff.TILES, 7, 5)
