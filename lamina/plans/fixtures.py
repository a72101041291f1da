"""Map layers derived from the given tables by plain SQL that runs unchanged in Spark and DuckDB.

Coordinates are whole numbers, so sums and cross products are exact in any order.
"""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.operators.tables import spread

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

# name -> (rows as SQL, geometry expression or None)
LAYERS: dict[str, str] = {
    "customer_pt": """
        SELECT c_custkey AS fid, c_nationkey, c_acctbal, CAST((c_custkey * 7919) % 1000 AS DOUBLE) AS x,
               CAST((c_custkey * 104729) % 1000 AS DOUBLE) AS y FROM customer""",
    "supplier_pt": """
        SELECT s_suppkey AS fid, s_nationkey, CAST((s_suppkey * 613) % 1000 AS DOUBLE) AS x,
               CAST((s_suppkey * 397) % 1000 AS DOUBLE) AS y FROM supplier""",
    "part_box": """
        SELECT p_partkey AS fid, p_size, CAST((p_partkey * 31) % 980 AS DOUBLE) AS xmin, CAST((p_partkey * 17) % 980 AS DOUBLE) AS ymin,
               CAST((p_partkey * 31) % 980 + 1 + p_size % 20 AS DOUBLE) AS xmax,
               CAST((p_partkey * 17) % 980 + 1 + p_size % 20 AS DOUBLE) AS ymax FROM part""",
    "nation_poly": """
        SELECT CAST(n_nationkey AS BIGINT) AS fid, n_name, n_regionkey, CAST((n_nationkey % 5) * 200 AS DOUBLE) AS xmin,
               CAST(((n_nationkey - n_nationkey % 5) / 5) * 200 AS DOUBLE) AS ymin,
               CAST((n_nationkey % 5) * 200 + 200 AS DOUBLE) AS xmax,
               CAST(((n_nationkey - n_nationkey % 5) / 5) * 200 + 200 AS DOUBLE) AS ymax FROM nation""",
    "supplier_tri": """
        SELECT s_suppkey AS fid, s_nationkey, CAST((s_suppkey * 61) % 900 AS DOUBLE) AS x0, CAST((s_suppkey * 37) % 900 AS DOUBLE) AS y0,
               CAST(20 + s_suppkey % 50 AS DOUBLE) AS w, CAST(20 + (s_suppkey * 7) % 60 AS DOUBLE) AS h FROM supplier""",
    # square with a square hole, side a multiple of four
    "part_donut": """
        SELECT p_partkey AS fid, p_brand, CAST(4 * ((p_partkey * 31) % 980) AS DOUBLE) AS x0, CAST(4 * ((p_partkey * 17) % 980) AS DOUBLE) AS y0,
               CAST(4 * (1 + p_size % 20) AS DOUBLE) AS s FROM part""",
    # axis-parallel two-point lines: even keys run along x, odd ones along y
    "part_seg": """
        SELECT p_partkey AS fid, CAST(p_partkey % 2 AS INT) AS upright, CAST((p_partkey * 43) % 950 AS DOUBLE) AS xmin,
               CAST((p_partkey * 29) % 950 AS DOUBLE) AS ymin,
               CAST((p_partkey * 43) % 950 + (1 - p_partkey % 2) * (1 + p_size) AS DOUBLE) AS xmax,
               CAST((p_partkey * 29) % 950 + (p_partkey % 2) * (1 + p_size) AS DOUBLE) AS ymax FROM part""",
    "event_point": """
        SELECT user_id AS fid, ts, event_id, CAST((event_id * 37) % 1000 AS DOUBLE) AS x, CAST((event_id * 91) % 1000 AS DOUBLE) AS y FROM events""",
}

_BOX = x.box("xmin", "ymin", "xmax", "ymax")
GEOMETRY: dict[str, str] = {
    "customer_pt": x.point("x", "y"),
    "supplier_pt": x.point("x", "y"),
    "part_box": _BOX,
    "nation_poly": _BOX,
    "supplier_tri": x.polygon(f"array({x.ring_of(('x0', 'y0'), ('x0 + w', 'y0'), ('x0', 'y0 + h'), ('x0', 'y0'))})"),
    "part_donut": x.polygon(
        "array("
        + x.ring_of(("x0", "y0"), ("x0 + s", "y0"), ("x0 + s", "y0 + s"), ("x0", "y0 + s"), ("x0", "y0")) + ", "
        + x.ring_of(("x0 + s / 4", "y0 + s / 4"), ("x0 + s / 4", "y0 + 3 * s / 4"), ("x0 + 3 * s / 4", "y0 + 3 * s / 4"),
                    ("x0 + 3 * s / 4", "y0 + s / 4"), ("x0 + s / 4", "y0 + s / 4")) + ")"),
    "part_seg": x.line(x.ring_of(("xmin", "ymin"), ("xmax", "ymax"))),
    "event_point": x.point("x", "y"),
}

_FRAMES: WeakKeyDictionary = WeakKeyDictionary()  # session -> {path: frame}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the given tables; the frame is kept so that its schema is read once per session."""
    frames = _FRAMES.setdefault(spark, {})
    path = f"{sf}/{name}.parquet"
    if path not in frames:
        frames[path] = spark.read.parquet(path)
    return frames[path]


def views(spark: SparkSession, sf: str, *layers: str) -> None:
    """Register the given tables, and the named layers with their geometry, as temporary views."""
    for name in TABLES:
        table(spark, sf, name).createOrReplaceTempView(name)
    for name in layers:
        layer(spark, sf, name).createOrReplaceTempView(name)


def rows(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A derived layer without its geometry column."""
    base = {t: table(spark, sf, t) for t in TABLES if f"FROM {t}" in LAYERS[name]}
    text = LAYERS[name]
    for t in base:
        text = text.replace(f"FROM {t}", "FROM {" + t + "}")
    return spark.sql(text, **base)


def layer(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A derived layer with its geometry as ``geom``."""
    return rows(spark, sf, name).withColumn("geom", F.expr(GEOMETRY[name]))


def spread_rows(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """``rows`` in any order, dealt to all tasks before anything is made of them."""
    return spread(rows(spark, sf, name))


def spread_layer(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """``layer`` in any order, its geometry made by all tasks."""
    return spread_rows(spark, sf, name).withColumn("geom", F.expr(GEOMETRY[name]))


def with_layers(*names: str) -> str:
    """WITH clause defining the named layers, for the reference SQL."""
    return "WITH " + ", ".join(f"{n} AS ({LAYERS[n].strip()})" for n in names) + " "
