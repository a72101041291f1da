"""Sources, layer definitions, stored layers and feature requests (rows A and B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.functions.registry import register_functions
from lamina.plans.catalog import query
from lamina.plans.fixtures import layer, rows, table, views, with_layers
from lamina.session import shared_folder
from lamina.sources import layer as ly
from lamina.sources.readers import point_layer, read_delimited, typed, wkt_layer

# ---------------------------------------------------------------- A: sources, layers, sinks


@query("src_attach", """
    SELECT r_name, n_name, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name""")
def src_attach(spark, sf):
    at = shared_folder(spark, "attach")
    table(spark, sf, "nation").write.mode("overwrite").csv(f"{at}/nation", header=True)
    table(spark, sf, "region").write.mode("overwrite").json(f"{at}/region")
    made = ly.create_layer(spark, ly.LayerDef(
        sources=(
            ly.Source("cust", "parquet", f"{sf}/customer.parquet"),
            ly.Source("nat", "csv", f"{at}/nation", options={"header": "true"}),
            ly.Source("reg", "json", f"{at}/region"),
        ),
        query="SELECT r_name, n_name, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM cust "
              "JOIN nat ON c_nationkey = CAST(n_nationkey AS INT) JOIN reg ON CAST(n_regionkey AS INT) = r_regionkey GROUP BY r_name, n_name"))
    return made.df


@query("src_live", """
    SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer WHERE c_acctbal > 0 AND c_nationkey < 20
    GROUP BY c_mktsegment""")
def src_live(spark, sf):
    views(spark, sf)
    first = ly.create_layer(spark, "?layer_ref=customer:c&query=SELECT * FROM c WHERE c_acctbal %3E 0")
    first.view("positive")
    second = ly.create_layer(spark, "?layer_ref=positive:p&query=SELECT * FROM p WHERE c_nationkey %3C 20")
    second.view("southern")
    return ly.create_layer(spark, ly.LayerDef(
        (ly.Source(ref="southern"),),
        "SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM vtab1 GROUP BY c_mktsegment")).df


@query("src_autoname", """
    SELECT n_name, s_name, s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def src_autoname(spark, sf):
    views(spark, sf)
    return ly.create_layer(spark, ly.LayerDef(
        (ly.Source(fmt="parquet", path=f"{sf}/supplier.parquet"), ly.Source(ref="nation")),
        "SELECT n_name, s_name, s_acctbal FROM vtab1 JOIN vtab2 ON s_nationkey = n_nationkey")).df


@query("src_csv", """
    SELECT doc_id, lang, CAST(n_chars AS BIGINT) AS n_chars, md5(text) AS digest FROM documents""")
def src_csv(spark, sf):
    at = shared_folder(spark, "csv")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    docs.write.mode("overwrite").csv(
        f"{at}/docs", header=True, sep="|", quote='"', escape='"', quoteAll=True, encoding="UTF-8",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    back = read_delimited(spark, f"{at}/docs", "doc_id BIGINT, text STRING, lang STRING, n_chars BIGINT", sep="|")
    return back.select("doc_id", "lang", "n_chars", F.md5("text").alias("digest"))


@query("src_autoref", """
    SELECT r_name, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def src_autoref(spark, sf):
    views(spark, sf)
    table(spark, sf, "region").createOrReplaceTempView("region_id_20150701")
    return ly.create_layer(spark, ly.LayerDef(
        query="SELECT r_name, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey "
              "JOIN region_id_20150701 ON n_regionkey = r_regionkey GROUP BY r_name")).df


@query("view_query", with_layers("supplier_tri") + """
    SELECT fid, s_nationkey, w * h / 2 AS area FROM supplier_tri WHERE w * h / 2 > 500""")
def view_query(spark, sf):
    views(spark, sf, "supplier_tri")
    register_functions(spark, ["ST_Area"])
    made = ly.create_layer(spark, ly.LayerDef(
        query="SELECT fid, s_nationkey, ST_Area(geom) AS area FROM supplier_tri"))
    made.view("Supplier Triangles")
    return spark.sql("SELECT * FROM `Supplier Triangles` WHERE area > 500")


@query("view_passthrough", "SELECT * FROM nation")
def view_passthrough(spark, sf):
    return ly.create_layer(spark, ly.LayerDef((ly.Source("n", "parquet", f"{sf}/nation.parquet"),))).df


@query("layer_save_open", with_layers("customer_pt") + """
    SELECT c_nationkey, count(*) AS n, CAST(sum(fid) AS BIGINT) AS sum_fid, CAST(sum(x) AS BIGINT) AS sum_x, 4326 AS srid, 1 AS gtype
    FROM customer_pt WHERE c_acctbal > 0 AND x BETWEEN 100 AND 600 GROUP BY c_nationkey""")
def layer_save_open(spark, sf):
    views(spark, sf)
    register_functions(spark, ["MakePoint"])
    made = ly.create_layer(spark, ly.LayerDef(
        (ly.Source("c", "parquet", f"{sf}/customer.parquet"),),
        "SELECT c_custkey, c_nationkey, MakePoint(CAST((c_custkey * 7919) % 1000 AS DOUBLE), CAST((c_custkey * 104729) % 1000 AS DOUBLE), 4326) AS place "
        "FROM c WHERE c_acctbal > 0", uid="C_CustKey", geometry="place", gtype=1, srid=4326))
    at = shared_folder(spark, "saved")
    made.save(f"{at}/plain")
    ly.open_layer(spark, f"{at}/plain").save(f"{at}/laid_out", data=True)
    back = ly.open_layer(spark, f"{at}/laid_out")
    near = back.features(rect=(100, 0, 600, 1000))
    return near.withColumn("fid", F.col(back.uid)).groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("fid").alias("sum_fid"),
        F.sum(F.expr("place.parts[0].rings[0][0].x")).cast("long").alias("sum_x"),
        F.max("place.srid").alias("srid"), F.max("place.gtype").alias("gtype"))


@query("layer_uid", """
    SELECT o_orderkey, o_custkey AS chosen, CAST(row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS BIGINT) AS fid FROM orders""")
def layer_uid(spark, sf):
    from lamina.operators.ordered import dense_ids

    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    chosen = ly.Layer(orders, uid="o_custkey").with_fid().withColumnRenamed("fid", "chosen")
    return dense_ids(chosen, ["o_totalprice", "o_orderkey"]).select("o_orderkey", "chosen", "fid")


# the fourth row and the ones after it keep the number they were attached with
@query("layer_rowid", """
    SELECT CAST(rn AS BIGINT) AS uid, c_custkey, c_name FROM
      (SELECT row_number() OVER (ORDER BY c_name, c_custkey) - 1 AS rn, c_custkey, c_name FROM customer) AS t ORDER BY rn LIMIT 10 OFFSET 3""")
def layer_rowid(spark, sf):
    from lamina.operators.ordered import dense_ids

    ided = dense_ids(table(spark, sf, "customer").select("c_custkey", "c_name"), ["c_name", "c_custkey"], "rowid")
    ided.createOrReplaceTempView("numbered_customer")
    return spark.sql("SELECT rowid AS uid, c_custkey, c_name FROM numbered_customer ORDER BY rowid LIMIT 10 OFFSET 3")


@query("layer_geom_pick", with_layers("supplier_tri") + """
    SELECT 'first' AS pick, 'geom' AS name, 3 AS gtype, 0 AS srid, count(*) AS n, CAST(sum(x0) AS BIGINT) AS sum_x FROM supplier_tri
    UNION ALL SELECT 'named', 'corner', 1, 3857, count(*), CAST(sum(x0 + w) AS BIGINT) FROM supplier_tri""")
def layer_geom_pick(spark, sf):
    tri = layer(spark, sf, "supplier_tri").withColumn("corner", F.expr(x.point("x0 + w", "y0", 3857)))
    tri.createOrReplaceTempView("two_geometries")
    first = ly.create_layer(spark, "?query=SELECT * FROM two_geometries")
    named = ly.create_layer(spark, "?query=SELECT * FROM two_geometries&geometry=corner:point:3857")

    def row(pick, made):
        meta = made.df.schema[made.geometry].metadata
        return made.df.agg(
            F.lit(pick).alias("pick"), F.lit(made.geometry).alias("name"), F.lit(meta["gtype"]).alias("gtype"), F.lit(meta["srid"]).alias("srid"),
            F.count(F.lit(1)).alias("n"), F.sum(F.expr(f"{made.geometry}.parts[0].rings[0][0].x")).cast("long").alias("sum_x"))

    return row("first", first).unionByName(row("named", named))


@query("layer_nogeom", with_layers("part_box") + "SELECT fid, p_size, xmin, ymin, xmax, ymax FROM part_box")
def layer_nogeom(spark, sf):
    layer(spark, sf, "part_box").createOrReplaceTempView("part_box")
    return ly.create_layer(spark, "?layer_ref=part_box&nogeometry").df


@query("layer_describe", """
    SELECT * FROM (VALUES ('customer_pt', 0, 'fid', 'bigint', NULL, NULL, NULL), ('customer_pt', 1, 'c_nationkey', 'int', NULL, NULL, NULL),
      ('customer_pt', 2, 'c_acctbal', 'double', NULL, NULL, NULL), ('customer_pt', 3, 'x', 'double', NULL, NULL, NULL),
      ('customer_pt', 4, 'y', 'double', NULL, NULL, NULL), ('customer_pt', 5, 'geom', 'geometry', 1, 'XY', 0),
      ('id_a', 0, 'fid', 'bigint', NULL, NULL, NULL), ('id_a', 1, 'geom', 'geometry', 3, 'XY', 4326),
      ('id_b', 0, 'fid', 'bigint', NULL, NULL, NULL), ('id_b', 1, 'geom', 'geometry', 1, 'XYZ', 0)) AS t(layer, pos, "column", type, gtype, dims, srid)""")
def layer_describe(spark, sf):
    tri = layer(spark, sf, "supplier_tri")
    polys = tri.select("fid", F.expr(x.set_srid("geom", 4326)).alias("geom"))
    tops = tri.select("fid", F.expr(x.point("x0", "y0", 0, "h")).alias("geom"))
    return ly.describe_layers([
        ("customer_pt", "id_c", layer(spark, sf, "customer_pt")), ("supplier", "id_a", polys), ("supplier", "id_b", tops)])


@query("layer_stats", with_layers("customer_pt", "part_box", "supplier_tri") + """
    SELECT 'customer_pt' AS layer, count(*) AS n, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM customer_pt
    UNION ALL SELECT 'part_box', count(*), min(xmin), min(ymin), max(xmax), max(ymax) FROM part_box
    UNION ALL SELECT 'supplier_tri', count(*), min(x0), min(y0), max(x0 + w), max(y0 + h) FROM supplier_tri""")
def layer_stats(spark, sf):
    out = None
    for name in ("customer_pt", "part_box", "supplier_tri"):
        one = ly.layer_stats(layer(spark, sf, name)).withColumn("layer", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query("layer_denormalize", """
    SELECT c.*, n.n_nationkey AS nation_n_nationkey, n.n_name AS nation_n_name, n.n_regionkey AS nation_n_regionkey, o.n AS totals_n
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey""")
def layer_denormalize(spark, sf):
    totals = table(spark, sf, "orders").filter("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    joined, _ = ly.denormalize(table(spark, sf, "customer"), [
        ly.AttributeJoin("nation", table(spark, sf, "nation"), "c_nationkey", "n_nationkey"),
        ly.AttributeJoin("totals", totals, "c_custkey", "o_custkey", ("n",)),
    ], pk="c_custkey")
    return joined


@query("layer_contract", """
    WITH t AS (SELECT l.doc_id AS lid, d.doc_id % 7 AS k FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT 'unnamed_columns' AS rule, CAST(0 AS BIGINT) AS violations
    UNION ALL SELECT 'uid_null', count(*) FROM t WHERE lid IS NULL
    UNION ALL SELECT 'uid_duplicate', count(lid) - count(DISTINCT lid) FROM t
    UNION ALL SELECT 'geom_null', count(*) FROM t WHERE k = 0
    UNION ALL SELECT 'geom_type', count(*) FROM t WHERE k = 1
    UNION ALL SELECT 'geom_srid', count(*) FROM t WHERE k = 2""")
def layer_contract(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    labels = table(spark, sf, "labels").select("doc_id", F.col("doc_id").alias("lid"))
    as_line = x.line(x.ring_of(("doc_id", "0"), ("doc_id", "1")))
    geom = (
        f"CASE doc_id % 7 WHEN 0 THEN {x.NO_GEOM} WHEN 1 THEN {as_line} WHEN 2 THEN {x.point('doc_id', '0', 4326)} "
        f"ELSE {x.point('doc_id', '0')} END"
    )
    df = docs.join(labels, "doc_id", "left").select("lid", F.expr(geom).alias("geom"))
    return ly.contract(df, uid="lid", geom="geom", gtype=1, srid=0)


@query("sink_wkt", with_layers("supplier_tri") + """
    SELECT fid, 'POLYGON((' || CAST(x0 AS BIGINT) || ' ' || CAST(y0 AS BIGINT) || ',' || CAST(x0 + w AS BIGINT) || ' ' || CAST(y0 AS BIGINT) || ','
      || CAST(x0 AS BIGINT) || ' ' || CAST(y0 + h AS BIGINT) || ',' || CAST(x0 AS BIGINT) || ' ' || CAST(y0 AS BIGINT) || '))' AS geom FROM supplier_tri""")
def sink_wkt(spark, sf):
    at = shared_folder(spark, "wkt")
    ly.with_wkt(layer(spark, sf, "supplier_tri").select("fid", "geom")).write.mode("overwrite").csv(f"{at}/wkt", header=True, quoteAll=True)
    return read_delimited(spark, f"{at}/wkt", "fid BIGINT, geom STRING", multiline=False)


# well-known text of six kinds and two broken ones, from the supplier triangles
_WKT = """
    SELECT fid, CAST(fid % 8 AS INT) AS k, CASE fid % 8
      WHEN 0 THEN 'POINT(' || px || ')' WHEN 1 THEN 'LINESTRING(' || px || ', ' || qx || ')'
      WHEN 2 THEN 'POLYGON((' || px || ',' || qx || ',' || rx || ',' || px || '))' WHEN 3 THEN 'multipoint((' || px || '),(' || qx || '))'
      WHEN 4 THEN 'MULTILINESTRING((' || px || ',' || qx || '),(' || qx || ',' || rx || '))'
      WHEN 5 THEN 'MULTIPOLYGON(((' || px || ',' || qx || ',' || rx || ',' || px || ')),((' || rx || ',' || qx || ',' || px || ',' || rx || ')))'
      WHEN 6 THEN 'POLYGON((' || px || ',' || qx || ',' || rx || '))' ELSE 'POINT(' || px END AS wkt
    FROM (SELECT fid, CAST(CAST(x0 AS BIGINT) AS VARCHAR(20)) || ' ' || CAST(CAST(y0 AS BIGINT) AS VARCHAR(20)) AS px,
                 CAST(CAST(x0 + w AS BIGINT) AS VARCHAR(20)) || ' ' || CAST(CAST(y0 AS BIGINT) AS VARCHAR(20)) AS qx,
                 CAST(CAST(x0 AS BIGINT) AS VARCHAR(20)) || ' ' || CAST(CAST(y0 + h AS BIGINT) AS VARCHAR(20)) AS rx FROM supplier_tri) AS s"""


@query("src_wkt_layer", with_layers("supplier_tri") + """
    SELECT CASE fid % 8 WHEN 0 THEN 'POINT' WHEN 1 THEN 'LINESTRING' WHEN 2 THEN 'POLYGON' WHEN 3 THEN 'MULTIPOINT' WHEN 4 THEN 'MULTILINESTRING'
             WHEN 5 THEN 'MULTIPOLYGON' ELSE 'rejected' END AS kind, count(*) AS n,
           CAST(sum(CASE fid % 8 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 WHEN 3 THEN 2 WHEN 4 THEN 4 WHEN 5 THEN 8 ELSE 0 END) AS BIGINT) AS n_points,
           CAST(sum(CASE WHEN fid % 8 < 6 THEN x0 + CASE WHEN fid % 8 = 5 THEN x0 ELSE 0 END
                              + CASE fid % 8 WHEN 3 THEN x0 + w WHEN 4 THEN x0 + w ELSE 0 END ELSE 0 END) AS BIGINT) AS sum_x
    FROM supplier_tri GROUP BY 1""")
def src_wkt_layer(spark, sf):
    texts = spark.sql(_WKT.replace("FROM supplier_tri", "FROM {tri}"), tri=rows(spark, sf, "supplier_tri"))
    good, bad = wkt_layer(texts)
    anchors = f"aggregate({x.anchors('geom')}, 0D, (wa_s, wa_v) -> wa_s + wa_v.x)"
    accepted = good.select(F.expr(x.type_name("geom")).alias("kind"), F.expr(x.n_points("geom")).alias("p"), F.expr(anchors).alias("ax"))
    rejected = bad.select(F.lit("rejected").alias("kind"), F.lit(0).alias("p"), F.lit(0.0).alias("ax"))
    return accepted.unionByName(rejected).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum("p").alias("n_points"), F.sum("ax").cast("long").alias("sum_x"))


@query("src_point_table", with_layers("customer_pt") + "SELECT fid, x AS px, y AS py, c_acctbal AS pz, 4326 AS srid FROM customer_pt")
def src_point_table(spark, sf):
    made = point_layer(rows(spark, sf, "customer_pt"), "x", "y", 4326, zcol="c_acctbal")
    v = "geom.parts[0].rings[0][0]"
    return made.select("fid", F.expr(f"{v}.x").alias("px"), F.expr(f"{v}.y").alias("py"), F.expr(f"{v}.z").alias("pz"), F.col("geom.srid").alias("srid"))


# ---------------------------------------------------------------- B: feature requests


def _boxes(spark, sf):
    return ly.Layer(layer(spark, sf, "part_box"), uid="fid", geometry="geom", gtype=3, srid=0)


def _triangles(spark, sf):
    return ly.Layer(layer(spark, sf, "supplier_tri"), uid="fid", geometry="geom", gtype=3, srid=0)


@query("req_subset", with_layers("part_box") + "SELECT fid, p_size FROM part_box WHERE p_size > 40 AND xmin < 500")
def req_subset(spark, sf):
    return _boxes(spark, sf).features(subset="P_Size > 40 AND xmin < 500", columns=["p_size"], geometry=False)


@query("req_rect_mbr", with_layers("supplier_tri") + """
    SELECT fid, x0, y0, w, h FROM supplier_tri WHERE x0 + w >= 200 AND x0 <= 420 AND y0 + h >= 150 AND y0 <= 380""")
def req_rect_mbr(spark, sf):
    return _triangles(spark, sf).features(rect=(420, 380, 200, 150)).select("fid", "x0", "y0", "w", "h")


@query("req_rect_exact", with_layers("supplier_tri") + """
    SELECT fid, x0, y0, w, h FROM supplier_tri WHERE x0 + w >= 200 AND x0 <= 420 AND y0 + h >= 150 AND y0 <= 380
      AND (greatest(200, x0) - x0) * h + (greatest(150, y0) - y0) * w <= w * h""")
def req_rect_exact(spark, sf):
    return _triangles(spark, sf).features(rect=(200, 380, 420, 150), exact=True).select("fid", "x0", "y0", "w", "h")


# the features are stored along a space-filling curve; statistics skip the files that lie elsewhere
@query("req_rect_stored", with_layers("part_box") + """
    SELECT fid, p_size FROM part_box WHERE xmax >= 100 AND xmin <= 300 AND ymax >= 50 AND ymin <= 200""")
def req_rect_stored(spark, sf):
    at = shared_folder(spark, "stored")
    views(spark, sf, "part_box")
    ly.create_layer(spark, "?query=SELECT fid, p_size, geom FROM part_box&uid=fid").save(at, data=True)
    return ly.open_layer(spark, at).features(rect=(100, 50, 300, 200), geometry=False).select("fid", "p_size")


@query("req_fid", with_layers("part_box") + "SELECT fid, p_size, xmin FROM part_box WHERE fid = 77")
def req_fid(spark, sf):
    return _boxes(spark, sf).features(fid=77, columns=["p_size", "xmin"], geometry=False)


@query("req_fids", with_layers("part_box") + """
    SELECT 'list' AS how, fid, p_size FROM part_box WHERE fid IN (3, 61, 77, 100000000)
    UNION ALL SELECT 'table', fid, p_size FROM part_box WHERE fid IN (SELECT s_suppkey * 3 FROM supplier)""")
def req_fids(spark, sf):
    boxes = _boxes(spark, sf)
    by_list = boxes.features(fids=[3, 61, 77, 100000000], columns=["p_size"], geometry=False)
    ids = table(spark, sf, "supplier").select((F.col("s_suppkey") * 3).alias("id"))
    by_table = boxes.features(fids=ids, columns=["p_size"], geometry=False)
    return by_list.select(F.lit("list").alias("how"), "fid", "p_size").unionByName(by_table.select(F.lit("table").alias("how"), "fid", "p_size"))


@query("req_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def req_columns(spark, sf):
    return ly.Layer(table(spark, sf, "orders"), uid="o_orderkey").features(columns=["o_totalprice"])


@query("req_nogeom", with_layers("customer_pt") + "SELECT fid, c_nationkey, c_acctbal, x, y FROM customer_pt")
def req_nogeom(spark, sf):
    geo = layer(spark, sf, "customer_pt")
    return ly.Layer(geo.withColumn("geom", typed(F.col("geom"), "geom", 1, 0)), uid="fid", geometry="geom").features(geometry=False)
