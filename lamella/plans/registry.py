"""All queries of the raster engine by name, with their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators import align, labels as lab, matching as mat, morphology as mor, objects as obj, raster as ras, refine, register as reg, shapes
from ..operators.scalespace import Detector
from ..sources.metadata import TARGET_UM, scale_factors
from ..sources.rasters import embedding_raster, lineitem_raster, order_files, physical_sizes, table
from ..sources.sinks import grey_levels, label_colours, png_tiles

CUT = 136  # foreground threshold of the derived raster

QUERIES: dict = {}
SQL: dict[str, str] = {}

EMB = "r AS (SELECT vec_id // 64 AS z, vec_id % 64 AS y, CAST(x AS BIGINT) AS x, CAST(floor((CAST(e AS DOUBLE) + 1) * 128) AS BIGINT) AS v FROM (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS x, unnest(embedding) AS e FROM embeddings))"
LI = "l AS (SELECT l_returnflag AS z, CAST(l_linenumber AS BIGINT) AS c, l_suppkey % 50 AS y, l_partkey % 50 AS x, CAST(sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) AS v FROM lineitem GROUP BY ALL)"
MASK = f"{EMB}, m AS (SELECT z, y, x, CAST(v > {CUT} AS BIGINT) AS v FROM r)"
HIST = f"{EMB}, h AS (SELECT z, v, count(*) AS n FROM r GROUP BY z, v)"
OTSU = f"""{HIST}, c AS (SELECT z, v, sum(n) OVER w AS p, sum(n * v) OVER w AS s, sum(n) OVER (PARTITION BY z) AS pp, sum(n * v) OVER (PARTITION BY z) AS ss FROM h WINDOW w AS (PARTITION BY z ORDER BY v)),
g AS (SELECT a.z, a.v AS t1, b.v AS t2, round(CAST(a.s AS DOUBLE) * a.s / a.p + CAST(b.s - a.s AS DOUBLE) * (b.s - a.s) / (b.p - a.p) + CAST(a.ss - b.s AS DOUBLE) * (a.ss - b.s) / (a.pp - b.p), 4) AS g FROM c a JOIN c b ON a.z = b.z AND a.v < b.v AND b.p < b.pp),
o AS (SELECT z, t1, t2 FROM g QUALIFY row_number() OVER (PARTITION BY z ORDER BY g DESC, t1, t2) = 1)"""


def _around(name: str, source: str, test: str, reach: int) -> str:
    return f"""{name}(z, id, l) AS (SELECT z, y * 1048576 + x, y * 1048576 + x FROM {source} WHERE {test}
UNION SELECT p.z, p.y * 1048576 + p.x, {name}.l FROM {name} JOIN {source} p ON p.z = {name}.z AND abs(p.y - {name}.id // 1048576) <= 1 AND abs(p.x - {name}.id % 1048576) <= 1
 AND abs(p.y - {name}.id // 1048576) + abs(p.x - {name}.id % 1048576) <= {reach} AND p.{test} AND {name}.l < p.y * 1048576 + p.x)"""


COMP = f"RECURSIVE {MASK}, {_around('f', 'm', 'v = 1', 2)}, k AS (SELECT z, id // 1048576 AS y, id % 1048576 AS x, min(l) AS label FROM f GROUP BY z, id)"
STATS = f"{COMP}, s AS (SELECT z, label, count(*) AS area, min(x) AS x_min, min(y) AS y_min, max(x) - min(x) + 1 AS w, max(y) - min(y) + 1 AS h FROM k GROUP BY z, label)"
TOP = f"{STATS}, t AS (SELECT * FROM s QUALIFY rank() OVER (PARTITION BY z ORDER BY area DESC) <= 8)"
CENT = f"{TOP}, q AS (SELECT z, label, avg(x) AS cx, avg(y) AS cy FROM k SEMI JOIN t USING (z, label) GROUP BY z, label)"
ORDER = f"""{CENT}, b AS (SELECT *, row_number() OVER (PARTITION BY z ORDER BY cx, label) AS r, count(*) OVER (PARTITION BY z) AS n FROM q),
u AS (SELECT z, label, cx, cy, row_number() OVER (PARTITION BY z ORDER BY CAST(r > n // 2 AS INT), CASE WHEN r > n // 2 THEN cy ELSE -cy END, r) AS idx FROM b)"""


def query(name: str, sql: str | None = None):
    """Registers a query; ``sql`` begins after WITH."""

    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = "WITH " + sql
        return f

    return add


def _mask(spark: SparkSession, folder: str) -> DataFrame:
    return ras.binarize(embedding_raster(spark, folder), CUT)


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return lab.connected_components(_mask(spark, folder).where("v = 1"))


def _objects(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(labels, ordered top objects with area, box, centroid and idx)."""
    labels = _labels(spark, folder)
    top = lab.top_components(lab.component_stats(labels), 8)
    points = lab.centroids(labels.join(top.select("z", "label"), ["z", "label"], "left_semi"))
    return labels, lab.u_order(points).join(top, ["z", "label"])


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Threshold, components, the largest ones of each slice and their consistent order."""
    _, objects = _objects(spark, folder)
    return objects.select("z", "idx", "label", "area", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))


query("detect_tissues", f"{ORDER} SELECT z, CAST(idx AS BIGINT) AS idx, label, area, round(cx, 6) AS cx, round(cy, 6) AS cy FROM u JOIN t USING (z, label)")(flagship)


@query("block_mean", f"{EMB} SELECT z, y // 4 AS y, x // 4 AS x, sum(v) / 16.0::DOUBLE AS v FROM r GROUP BY ALL")
def block_mean(spark, folder):
    return ras.block_mean(embedding_raster(spark, folder), 4, 4)


@query("channel_sum_u16", f"{LI} SELECT z, y, x, CAST(sum(v) % 65536 AS BIGINT) AS v FROM l GROUP BY z, y, x")
def channel_sum_u16(spark, folder):
    return ras.channel_sum_u16(lineitem_raster(spark, folder))


@query("channel_sum_u8", f"{LI} SELECT z, y, x, CAST(sum(v) % 256 AS BIGINT) AS v FROM l GROUP BY z, y, x")
def channel_sum_u8(spark, folder):
    return ras.channel_sum_u8(lineitem_raster(spark, folder))


@query("channel_sum_wide", f"{LI} SELECT z, y, x, CAST(sum(v) AS BIGINT) AS v FROM l GROUP BY z, y, x")
def channel_sum_wide(spark, folder):
    return ras.channel_sum_wide(lineitem_raster(spark, folder))


@query("minmax_normalize", f"{EMB} SELECT z, y, x, CAST(round_even((v - min(v) OVER w) * 255.0::DOUBLE / (max(v) OVER w - min(v) OVER w), 0) AS BIGINT) AS v FROM r WINDOW w AS (PARTITION BY z)")
def minmax_normalize(spark, folder):
    return ras.minmax_normalize(embedding_raster(spark, folder))


@query("histogram", f"{HIST} SELECT z, v, n FROM h")
def histogram(spark, folder):
    return ras.histogram(embedding_raster(spark, folder))


@query("multi_otsu", f"{OTSU} SELECT z, t1, t2 FROM o")
def multi_otsu(spark, folder):
    return ras.multi_otsu(ras.histogram(embedding_raster(spark, folder)))


@query("binarize_const", f"{MASK} SELECT z, y, x, v FROM m")
def binarize_const(spark, folder):
    return _mask(spark, folder)


@query("binarize_auto", f"{OTSU} SELECT z, y, x, CAST(v > t1 / 2 AS BIGINT) AS v FROM r JOIN o USING (z)")
def binarize_auto(spark, folder):
    return ras.binarize_auto(embedding_raster(spark, folder))


def _sql_pass(source: str, name: str, k: int, how: str) -> str:
    frame = f"RANGE BETWEEN {k // 2} PRECEDING AND {k - 1 - k // 2} FOLLOWING"
    return f"{name}x AS (SELECT z, y, x, {how}(v) OVER (PARTITION BY z, y ORDER BY x {frame}) AS v FROM {source}), {name} AS (SELECT z, y, x, {how}(v) OVER (PARTITION BY z, x ORDER BY y {frame}) AS v FROM {name}x)"


for _k in (3, 4, 9):
    for _name, _passes in {"dilation": ["max"], "erosion": ["min"], "opening": ["min", "max"], "closing": ["max", "min"]}.items():
        _sql = MASK
        for _i, _how in enumerate(_passes):
            _sql += ", " + _sql_pass("m" if not _i else f"p{_i - 1}", f"p{_i}", _k, _how)
        query(f"{_name}_{_k}", f"{_sql} SELECT z, y, x, v FROM p{len(_passes) - 1}")(lambda spark, folder, k=_k, op=_name: mor.morphology(_mask(spark, folder), k, op))

query("erode_is_identity", f"{MASK} SELECT z, y, x, v FROM m")(lambda spark, folder: mor.morphology(_mask(spark, folder), 3, "erode"))

_ROWS = ", ".join(str(t) for t in mor.ellipse(5))
query(
    "ellipse_open",
    f"""{MASK}, e(dy, a, b) AS (VALUES {_ROWS}), e1 AS (SELECT m.z, m.y, m.x, min(n.v) AS v FROM m JOIN e ON true JOIN m n ON n.z = m.z AND n.y = m.y + dy AND n.x BETWEEN m.x + a AND m.x + b GROUP BY ALL)
SELECT m.z, m.y, m.x, max(n.v) AS v FROM m JOIN e ON true JOIN e1 n ON n.z = m.z AND n.y = m.y + dy AND n.x BETWEEN m.x + a AND m.x + b GROUP BY ALL""",
)(lambda spark, folder: mor.ellipse_open(_mask(spark, folder), 5))

query("median_filter", f"{EMB} SELECT a.z, a.y, a.x, quantile_disc(b.v, 0.5) AS v FROM r a JOIN r b ON a.z = b.z AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY ALL")(
    lambda spark, folder: ras.median_filter(embedding_raster(spark, folder))
)

_CELLS = ", ".join(f"({dy}, {dx})" for dy, a, b in mor.ellipse(3) for dx in range(a, b + 1))
query(
    "remove_islands",
    f"""{MASK}, c(dy, dx) AS (VALUES {", ".join(f"({i}, {j})" for i in (-1, 0, 1) for j in (-1, 0, 1))}), e(dy, dx) AS (VALUES {_CELLS}),
d AS (SELECT m.z, m.y, m.x, quantile_disc(n.v, 0.5) AS v FROM (SELECT z, y + dy AS y, x + dx AS x, v FROM m, c) n JOIN m USING (z, y, x) GROUP BY ALL),
e1 AS (SELECT d.z, d.y, d.x, min(n.v) AS v FROM (SELECT z, y + dy AS y, x + dx AS x, v FROM d, e) n JOIN d USING (z, y, x) GROUP BY ALL)
SELECT d.z, d.y, d.x, max(n.v) AS v FROM (SELECT z, y + dy AS y, x + dx AS x, v FROM e1, e) n JOIN d USING (z, y, x) GROUP BY ALL""",
)(lambda spark, folder: mor.remove_islands(_mask(spark, folder)))

query("connected_components", f"{COMP} SELECT z, y, x, label FROM k")(_labels)
query("component_stats", f"{STATS} SELECT * FROM s")(lambda spark, folder: lab.component_stats(_labels(spark, folder)))

_OPEN = f"RECURSIVE {EMB}, m AS (SELECT z, y, x, CAST(v > 118 AS BIGINT) AS v FROM r)"
query("fill_holes", f"{_OPEN}, {_around('f', 'm', 'v = 0', 1)}, k AS (SELECT z, id, min(l) AS label FROM f GROUP BY z, id), a AS (SELECT z, label FROM k GROUP BY z, label HAVING count(*) < 6) SELECT m.z, y, x, CAST(CASE WHEN a.label IS NULL THEN v ELSE 1 END AS BIGINT) AS v FROM m LEFT JOIN k ON k.z = m.z AND k.id = y * 1048576 + x LEFT JOIN a ON a.z = k.z AND a.label = k.label")(
    lambda spark, folder: lab.fill_holes(ras.binarize(embedding_raster(spark, folder), 118), 6)
)
query("top_components", f"{TOP} SELECT * FROM t")(lambda spark, folder: lab.top_components(lab.component_stats(_labels(spark, folder)), 8))
query("renumber", f"{TOP} SELECT *, CAST(dense_rank() OVER (PARTITION BY z ORDER BY label) AS BIGINT) AS number FROM t")(lambda spark, folder: lab.renumber(lab.top_components(lab.component_stats(_labels(spark, folder)), 8)))
query("centroids", f"{COMP} SELECT z, label, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy FROM k GROUP BY z, label")(lambda spark, folder: lab.centroids(_labels(spark, folder)).select("z", "label", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy")))
query("u_order", f"{ORDER} SELECT z, label, CAST(idx AS BIGINT) AS idx FROM u")(lambda spark, folder: _objects(spark, folder)[1].select("z", "label", "idx"))

_BOX = f"{ORDER}, x AS (SELECT z, idx, w, h, CAST(floor(cx) AS BIGINT) AS cx, CAST(floor(cy) AS BIGINT) AS cy FROM u JOIN t USING (z, label))"
_BEST = f"{_BOX}, best AS (SELECT idx, z, w, h FROM x QUALIFY row_number() OVER (PARTITION BY idx ORDER BY w * h DESC, z) = 1)"


def _boxes(spark, folder):
    return _objects(spark, folder)[1].select("z", "idx", "w", "h", F.floor("cx").alias("cx"), F.floor("cy").alias("cy"))


def _expanded(spark, folder):
    boxes = lab.checkpointed(_boxes(spark, folder))
    best = obj.biggest_boxes(boxes).select("idx", "w", "h")
    return obj.expand_box(boxes.drop("w", "h").join(best, "idx"), 1, 1, 2, 64, 64).select("z", "idx", "x1", "y1", "x2", "y2")


def _sides(c: str, s: str, n: int) -> str:
    return f"CAST(greatest(greatest({c} - {s} // 2, 0) - 2, 0) AS BIGINT) AS {c[1]}1, CAST(least(least({c} + {s} // 2, {n}) + 2, {n}) AS BIGINT) AS {c[1]}2"


_EXP = f"{_BEST}, ex AS (SELECT x.z, x.idx, {_sides('cx', 'bw', 64)}, {_sides('cy', 'bh', 64)} FROM x JOIN (SELECT idx, w AS bw, h AS bh FROM best) b ON b.idx = x.idx)"
_CROP = f"{_EXP}, cr AS (SELECT r.z, idx, y - y1 AS y, x - x1 AS x, v FROM r JOIN ex ON r.z = ex.z AND x >= x1 AND x < x2 AND y >= y1 AND y < y2)"
query("biggest_box_ref", f"{_BEST} SELECT CAST(idx AS BIGINT) AS idx, z, w, h FROM best")(lambda spark, folder: obj.biggest_boxes(_boxes(spark, folder)))
query("box_expand", f"{_EXP} SELECT z, CAST(idx AS BIGINT) AS idx, x1, y1, x2, y2 FROM ex")(_expanded)


def _crops(spark, folder):
    return obj.crop(embedding_raster(spark, folder), _expanded(spark, folder))


query("crop_range_join", f"{_CROP} SELECT z, CAST(idx AS BIGINT) AS idx, y, x, v FROM cr")(_crops)
query(
    "pad_stack",
    f"""{_CROP}, sz AS (SELECT idx, z, max(y) + 1 AS h, max(x) + 1 AS w FROM cr GROUP BY idx, z), sh AS (SELECT idx, z, max(h) OVER (PARTITION BY idx) - h AS dy, max(w) OVER (PARTITION BY idx) - w AS dx FROM sz)
SELECT CAST(idx AS BIGINT) AS idx, z, y + dy AS y, x + dx AS x, v FROM cr JOIN sh USING (idx, z)""",
)(lambda spark, folder: obj.pad_stack(lab.checkpointed(_crops(spark, folder))))
query("nonuniform_groups", f"{_CROP}, sz AS (SELECT idx, z, max(y) AS h, max(x) AS w FROM cr GROUP BY idx, z) SELECT CAST(idx AS BIGINT) AS idx, count(DISTINCT (h, w)) AS shapes FROM sz GROUP BY idx HAVING shapes > 1")(lambda spark, folder: obj.nonuniform_groups(_crops(spark, folder)))
query("mask_apply", f"{MASK} SELECT r.z, r.y, r.x, r.v FROM r JOIN m USING (z, y, x) WHERE m.v = 1 AND r.v <> 0")(lambda spark, folder: obj.apply_mask(embedding_raster(spark, folder), _mask(spark, folder).where("v = 1")))
query("label_mode", f"{COMP}, c AS (SELECT m.z, coalesce(label, 0) AS label, count(*) AS n FROM m LEFT JOIN k USING (z, y, x) GROUP BY ALL) SELECT z, label FROM c QUALIFY row_number() OVER (PARTITION BY z ORDER BY n DESC, label) = 1")(
    lambda spark, folder: lab.label_mode(_mask(spark, folder).select("z", "y", "x").join(_labels(spark, folder), ["z", "y", "x"], "left").select("z", F.coalesce("label", F.lit(0)).cast("long").alias("label")))
)


def _axis(n: str, size: str, s: int) -> str:
    return f"""{n} AS (SELECT z, t, greatest(0, least(CAST(floor((t + 0.5::DOUBLE) / {s} - 0.5) AS BIGINT) + k, {size} - 1)) AS i, abs((t + 0.5::DOUBLE) / {s} - 0.5 - floor((t + 0.5::DOUBLE) / {s} - 0.5) - k) AS d FROM (SELECT z, {size}, unnest(range({size} * {s})) AS t FROM sz), (SELECT unnest([-1, 0, 1, 2]) AS k)),
{n}w AS (SELECT z, t, i, CASE WHEN d <= 1 THEN (1.25 * d - 2.25) * d * d + 1 WHEN d < 2 THEN ((-0.75 * d + 3.75) * d - 6) * d + 3 ELSE 0 END AS c FROM {n})"""


query("cubic_upsample", f"{MASK}, sz AS (SELECT z, max(y) + 1 AS h, max(x) + 1 AS w FROM m GROUP BY z), {_axis('ay', 'h', 2)}, {_axis('ax', 'w', 3)} SELECT m.z, ayw.t AS y, axw.t AS x FROM m JOIN ayw ON ayw.z = m.z AND ayw.i = m.y JOIN axw ON axw.z = m.z AND axw.i = m.x WHERE m.v = 1 GROUP BY ALL HAVING round(sum(ayw.c * axw.c), 6) > 0.5")(
    lambda spark, folder: mor.cubic_upsample(_mask(spark, folder), 2, 3)
)

query("upsample_grey", f"{EMB}, sz AS (SELECT z, max(y) + 1 AS h, max(x) + 1 AS w FROM r GROUP BY z), {_axis('ay', 'h', 3)}, {_axis('ax', 'w', 2)}, s AS (SELECT r.z, ayw.t AS y, axw.t AS x, CAST(round_even(round(sum(r.v * ayw.c * axw.c), 6), 0) AS BIGINT) AS v FROM r JOIN ayw ON ayw.z = r.z AND ayw.i = r.y JOIN axw ON axw.z = r.z AND axw.i = r.x GROUP BY ALL) SELECT z, y, x, least(v, 255) AS v FROM s WHERE v > 0")(
    lambda spark, folder: mor.cubic_upsample_grey(embedding_raster(spark, folder), 3, 2)
)

query("dice_adjacent", f"{MASK} SELECT a.z, round(2.0::DOUBLE * sum(a.v * b.v) / nullif(sum(a.v) + sum(b.v), 0), 6) AS dice FROM m a JOIN m b ON b.z = a.z + 1 AND a.y = b.y AND a.x = b.x GROUP BY a.z")(lambda spark, folder: mat.dice_adjacent(_mask(spark, folder)))
query("dice_pairs", f"{MASK} SELECT a.z, round(2.0::DOUBLE * sum(a.v * b.v) / nullif(sum(a.v) + sum(b.v), 0), 6) AS dice FROM m a JOIN m b ON b.z = 0 AND a.z <> 0 AND a.y = b.y AND a.x = b.x GROUP BY a.z")(lambda spark, folder: mat.dice_pairs(_mask(spark, folder)))
query("area_consistency", f"{MASK}, u AS (SELECT y, x, max(v) AS u FROM m GROUP BY y, x) SELECT z, round(CAST(sum(CAST(v = u AS BIGINT)) AS DOUBLE) / (SELECT sum(u) FROM u), 6) AS agreement FROM m JOIN u USING (y, x) WHERE z >= 1 GROUP BY z")(lambda spark, folder: mat.area_consistency(_mask(spark, folder)))

_OVER = f"{COMP}, ov AS (SELECT a.z, a.label AS src, b.label AS dst, count(*) AS n FROM k a JOIN k b ON b.z = a.z + 1 AND a.y = b.y AND a.x = b.x GROUP BY ALL), om AS (SELECT * FROM ov QUALIFY row_number() OVER (PARTITION BY z, src ORDER BY n DESC, dst) = 1)"
query("overlap_match", f"{_OVER} SELECT z, src, dst, n FROM om")(lambda spark, folder: mat.overlap_match(mat.overlaps(lab.checkpointed(_labels(spark, folder)))))
query("point_lookup", f"{COMP}, c AS (SELECT z, label, CAST(floor(avg(x)) AS BIGINT) AS px, CAST(floor(avg(y)) AS BIGINT) AS py FROM k GROUP BY z, label) SELECT c.z, c.label, k.label AS found FROM c LEFT JOIN k ON k.z = c.z AND k.y = py AND k.x = px")(
    lambda spark, folder: (lambda k: mat.point_lookup(lab.centroids(k), k))(lab.checkpointed(_labels(spark, folder)))
)
query("relabel", f"{TOP} SELECT z, y, x, coalesce(n, 0) AS label FROM k LEFT JOIN (SELECT z, label, CAST(dense_rank() OVER (PARTITION BY z ORDER BY label) AS BIGINT) AS n FROM t) USING (z, label)")(
    lambda spark, folder: (lambda k: mat.relabel(k, lab.renumber(lab.top_components(lab.component_stats(k), 8)).select("z", "label", F.col("number").alias("new"))))(lab.checkpointed(_labels(spark, folder)))
)


@query("propagate", f"{_OVER}, p(z, label, origin) AS (SELECT DISTINCT CAST(0 AS BIGINT), label, label FROM k WHERE z = 0 UNION ALL SELECT p.z + 1, om.dst, max(origin) FROM p JOIN om ON om.z = p.z AND om.src = p.label GROUP BY p.z, om.dst) SELECT z, label, max(origin) AS origin FROM p GROUP BY z, label")
def propagate(spark, folder):
    labels = lab.checkpointed(_labels(spark, folder))
    matches = lab.checkpointed(mat.overlap_match(mat.overlaps(labels)))
    n = (labels.agg(F.max("z")).first()[0] or 0) + 1  # slices, not pixels
    return mat.propagate(matches, labels.where("z = 0").select("label").distinct(), n)


_DIMS = [f"e{i}" for i in range(64)]
_FEAT = "f AS (SELECT CAST(label AS BIGINT) AS z, vec_id AS label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"


def _features(spark, folder):
    e = (F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(_DIMS))
    return table(spark, folder, "embeddings").select(F.col("label").cast("long").alias("z"), F.col("vec_id").alias("label"), *e)


query("zscore_features", f"{_FEAT} SELECT z, label, " + ", ".join(f"round((e[{i}] - avg(e[{i}]) OVER w) / coalesce(nullif(stddev_pop(e[{i}]) OVER w, 0), 1), 6) + 0 AS {c}" for i, c in enumerate(_DIMS, 1)) + " FROM f WINDOW w AS (PARTITION BY z)")(
    lambda spark, folder: mat.zscore(_features(spark, folder), _DIMS).select("z", "label", *((F.round(c, 6) + 0).alias(c) for c in _DIMS))
)
query("nearest_blob", f"{_FEAT} SELECT p.z, p.label AS src, q.label AS dst, round(list_distance(p.e, q.e), 6) AS d FROM f p JOIN f q ON q.z = p.z + 1 QUALIFY row_number() OVER (PARTITION BY p.z, p.label ORDER BY d, q.label) = 1")(
    lambda spark, folder: mat.nearest(_features(spark, folder), _DIMS)
)


@query("knn2_ratio", """v AS (SELECT CAST(label AS BIGINT) AS g, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
p AS (SELECT a.g, a.vec_id AS id, b.vec_id AS near, round(list_distance(a.e, b.e), 6) AS d FROM v a JOIN v b ON a.g = b.g AND a.vec_id % 2 = 0 AND b.vec_id % 2 = 1),
t AS (SELECT *, row_number() OVER (PARTITION BY g, id ORDER BY d, near) AS r FROM p QUALIFY r <= 2)
SELECT g, id, min(near) FILTER (WHERE r = 1) AS near, min(d) FILTER (WHERE r = 1) AS d1, min(d) FILTER (WHERE r = 2) AS d2 FROM t GROUP BY g, id HAVING d1 < 0.98 * d2""")
def knn2_ratio(spark, folder):
    v = table(spark, folder, "embeddings").select(F.col("label").cast("long").alias("g"), "vec_id", F.col("embedding").cast("array<double>").alias("e"))
    queries = v.where("vec_id % 2 = 0").select("g", F.col("vec_id").alias("id"), F.col("e").alias("a"))
    return mat.knn_ratio(queries, v.where("vec_id % 2 = 1").select("g", F.col("vec_id").alias("near"), F.col("e").alias("b")), 0.98)


query("warp", f"{EMB}, t AS (SELECT ty, tx, ty + dy - 2 AS y, tx + dx - 3 AS x, CASE WHEN dx = 0 THEN 0.5 ELSE 0.5 END AS c FROM (SELECT unnest(range(64)) AS ty), (SELECT unnest(range(64)) AS tx), (SELECT 0 AS dy), (SELECT unnest([0, 1]) AS dx)) SELECT z, ty AS y, tx AS x, round(CAST(sum(v * c) AS DOUBLE), 6) AS v FROM r JOIN t USING (y, x) GROUP BY z, ty, tx")(
    lambda spark, folder: reg.warp(embedding_raster(spark, folder), [1, 0, 2.5, 0, 1, 2, 0, 0, 1], 64, 64)
)


@query("homography")
def homography(spark, folder):
    """Known shifts of centroids are recovered, one homography for each slice."""
    points = lab.centroids(_labels(spark, folder))
    moved = points.select("z", F.col("cx").alias("sx"), F.col("cy").alias("sy"), (F.col("cx") * 1.1 + F.col("z") + 3).alias("dx"), (F.col("cy") * 0.9 - F.col("z")).alias("dy"))
    return reg.find_homographies(moved, ["z"])


@query("param_search")
def param_search(spark, folder):
    """25 trials for each tissue of ``align_stack``'s, proposed by what its earlier ones have scored: aligned with the trial's parameters, scored by Dice."""
    stack = _moved_stack(spark, folder)
    reference = stack.where("z = 0").select("idx", "z").distinct()
    return reg.study(reference, align.scorer(stack, reference, 64, 64, CUT))


query("file_order", "f AS (SELECT s_name AS name FROM supplier) SELECT name, CAST(row_number() OVER (ORDER BY lower(substr(name, 1, 3)), name) - 1 AS BIGINT) AS slice_id FROM f")(lambda spark, folder: order_files(table(spark, folder, "supplier").select(F.col("s_name").alias("name"))))
query("validation_uniqueness", "d AS (SELECT r_name AS dimension, CAST(r_regionkey AS DOUBLE) AS value_um FROM region) SELECT dimension, min(value_um) AS value_um FROM d GROUP BY dimension")(
    lambda spark, folder: physical_sizes(spark, table(spark, folder, "region").select(F.col("r_name").alias("dimension"), F.col("r_regionkey").cast("double").alias("value_um")))
)

query("scale_factors", f"d AS (SELECT c_custkey AS slice_id, 0.1::DOUBLE + c_custkey % 7 / 10.0::DOUBLE AS value_um FROM customer) SELECT 'X' AS dimension, CAST(floor({TARGET_UM}::DOUBLE / value_um) AS INT) AS factor FROM d")(
    lambda spark, folder: scale_factors(table(spark, folder, "customer").select(F.lit("X").alias("dimension"), (F.lit(0.1) + F.col("c_custkey") % 7 / F.lit(10.0)).alias("value_um")))
)

_FILLED = f"""{STATS}, g AS (SELECT z, label, y, x FROM (SELECT z, label, x_min, w, unnest(range(y_min - 1, y_min + h + 1)) AS y FROM s), LATERAL (SELECT unnest(range(x_min - 1, x_min + w + 1)) AS x)),
fr AS (SELECT * FROM g ANTI JOIN k USING (z, label, y, x)),
o(z, label, y, x) AS (SELECT z, label, y_min - 1, x_min - 1 FROM s UNION SELECT p.z, p.label, p.y, p.x FROM o JOIN fr p ON p.z = o.z AND p.label = o.label AND abs(p.y - o.y) + abs(p.x - o.x) = 1),
fi AS (SELECT * FROM g ANTI JOIN o USING (z, label, y, x)),
qs AS (SELECT z, label, y - a AS qy, x - b AS qx, count(*) AS n, sum(y) AS sy, sum(x) AS sx, CASE count(*) WHEN 4 THEN 1.0::DOUBLE WHEN 3 THEN 0.5 ELSE 0 END AS ar FROM fi, (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS b) GROUP BY z, label, y - a, x - b)"""
query("contour_centroid", f"{_FILLED}, t AS (SELECT z, label, sum(ar) AS area, sum(ar * sx / n) AS mx, sum(ar * sy / n) AS my FROM qs GROUP BY z, label) SELECT z, label, area, CAST(CASE WHEN area > 0 THEN floor(round(mx / area, 9)) ELSE 0 END AS BIGINT) AS cx, CAST(CASE WHEN area > 0 THEN floor(round(my / area, 9)) ELSE 0 END AS BIGINT) AS cy FROM t")(
    lambda spark, folder: shapes.contour_centroids(lab.checkpointed(_labels(spark, folder)))
)
_AT = "(SELECT unnest([0, 0, 1, -1]) AS a, unnest([1, -1, 0, 0]) AS b)"
query(
    "outline_sums",
    f"""{_FILLED}, nb AS (SELECT fi.z, fi.label, fi.y, fi.x, count(o.x) AS n FROM fi CROSS JOIN {_AT} LEFT JOIN fi o ON o.z = fi.z AND o.label = fi.label AND o.y = fi.y + a AND o.x = fi.x + b GROUP BY ALL HAVING n < 4),
ol AS (SELECT z, label, x_min AS x0, y_min AS y0, CAST(x - x_min AS DOUBLE) AS x, CAST(y - y_min AS DOUBLE) AS y FROM nb JOIN s USING (z, label))
SELECT z, label, x0, y0, {", ".join(f"sum(x ** {p} * y ** {q}) AS s{p}{q}" for p, q in shapes.POWERS)} FROM ol GROUP BY z, label, x0, y0""",
)(lambda spark, folder: shapes.outline_sums(shapes.filled(lab.checkpointed(_labels(spark, folder)))))
query("shape_features")(lambda spark, folder: shapes.shape_features(lab.checkpointed(_labels(spark, folder))))

_PROFILE = f"{EMB}, cs AS (SELECT z, y % 2 AS c, x, sum(v) % 65536 AS s FROM r GROUP BY ALL), ps AS (SELECT z, x, sum(s) AS s FROM cs GROUP BY ALL), pm AS (SELECT z, x, CAST(round_even((s - min(s) OVER w) * 255.0::DOUBLE / (max(s) OVER w - min(s) OVER w), 0) > 0 AS BIGINT) AS v FROM ps WINDOW w AS (PARTITION BY z))"


def _profile(spark, folder):
    return mat.profile_mask(embedding_raster(spark, folder).withColumn("c", F.col("y") % 2))


query("profile_dice", f"{_PROFILE} SELECT a.z, round(2.0::DOUBLE * sum(a.v * b.v) / nullif(sum(a.v) + sum(b.v), 0), 6) AS dice FROM pm a JOIN pm b ON b.z = a.z + 1 AND a.x = b.x GROUP BY a.z")(lambda spark, folder: mat.dice_adjacent(_profile(spark, folder)))
query("profile_area_consistency", f"{_PROFILE}, u AS (SELECT x, max(v) AS u FROM pm GROUP BY x) SELECT z, round(CAST(sum(CAST(v = u AS BIGINT)) AS DOUBLE) / (SELECT sum(u) FROM u), 6) AS agreement FROM pm JOIN u USING (x) WHERE z >= 1 GROUP BY z")(lambda spark, folder: mat.area_consistency(_profile(spark, folder)))
query("greedy_overlap")(lambda spark, folder: mat.greedy_matches(mat.overlaps(lab.checkpointed(_labels(spark, folder)))))


@query("refine_mask")
def refine_mask(spark, folder):
    planes = embedding_raster(spark, folder)
    return refine.refine_mask(planes, planes.where("y between 16 and 47 and x between 16 and 47").select("z", "y", "x"), 290, 10, 2)[0]


def _moved_stack(spark, folder):
    """Each plane, stretched to 0 to 255, is a tissue's reference slice, 0; slice 1 is a moved copy."""
    still = ras.minmax_normalize(embedding_raster(spark, folder)).withColumnRenamed("z", "idx").withColumn("z", F.lit(0).cast("long"))
    moved = still.select("idx", F.lit(1).cast("long").alias("z"), ((F.col("y") + 3) % 64).alias("y"), ((F.col("x") + 5) % 64).alias("x"), "v")
    return lab.written(still.select("idx", "z", "y", "x", "v").unionByName(moved))


@query("align_stack")
def align_stack(spark, folder):
    """Each plane is a tissue's reference slice; a moved copy is brought back onto it."""
    stack = _moved_stack(spark, folder)
    return align.align_stack(stack, stack.where("z = 0").select("idx", "z").distinct(), 64, 64, detector=Detector(1.6, 3, 0.01, 10.0))[0]


query("label_colours", f"{COMP} SELECT m.z, m.y, m.x, {', '.join(f'CAST(CASE WHEN label IS NULL THEN 0 ELSE ((label + 1) * {k} + {t}) % 255 + 1 END AS BIGINT) AS {c}' for c, k, t in (('r', 73, 11), ('g', 151, 83), ('b', 199, 157)))} FROM m LEFT JOIN k USING (z, y, x)")(
    lambda spark, folder: label_colours(_all_labels(spark, folder))
)


def _all_labels(spark, folder):
    """Labels of all pixels from 1 on, so that a component at pixel (0, 0) differs from the background, 0."""
    return _mask(spark, folder).join(_labels(spark, folder), ["z", "y", "x"], "left").select("z", "y", "x", F.coalesce(F.col("label") + 1, F.lit(0)).cast("long").alias("label"))


query("grey_image", f"{EMB}, n AS (SELECT z, y, x, CAST(round_even((v - min(v) OVER w) * 255.0::DOUBLE / (max(v) OVER w - min(v) OVER w), 0) AS BIGINT) AS v FROM r WINDOW w AS (PARTITION BY z)) SELECT z, y, x, v AS r, v AS g, v AS b FROM n")(
    lambda spark, folder: grey_levels(embedding_raster(spark, folder))
)
query("label_png")(lambda spark, folder: png_tiles(label_colours(_all_labels(spark, folder))))
