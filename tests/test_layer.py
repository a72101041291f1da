"""Layer definitions, requests, storage and readers."""

import random

import pytest
from conftest import SF
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.functions.registry import register_functions
from lamina.operators.tables import with_bounds
from lamina.plans.fixtures import layer
from lamina.sources import layer as ly
from lamina.sources.readers import geometry_columns, point_layer, read_delimited, typed, wkt_layer

PARTS = [
    (11, 736.0, "Basse", "Région", "POLYGON((-2 49,-1 49,-1 50,-2 50,-2 49))"), (12, 800.0, "Haute", "Région", "POLYGON((0 49,1 49,1 50,0 50,0 49))"),
    (14, 728.0, "Loire", "Région", "POLYGON((-2 47,-1 47,-1 48,-2 47))"), (22, 800.0, "Centre", "Région", "POLYGON((1 47,2 47,2 48,1 48,1 47))"),
]


@pytest.fixture
def parts(spark, tmp_path):
    path = str(tmp_path / "parts")
    df = spark.createDataFrame(PARTS, "OBJECTID int, km double, name string, kind string, t string")
    df.withColumn("geometry", F.expr(x.from_wkt("t", 4326))).drop("t").write.parquet(path)
    return path


def test_delimited_text(spark, tmp_path):
    f = tmp_path / "t.csv"
    f.write_text('id,"description",data,info\n1,Plain record,Some data,Some info\n2,Quoted field,"Quoted data",Unquoted\n'
                 '3,Escaped quotes,"Quoted ""citation"" data",Unquoted\n4,Quoted newlines,"Line 1\nLine 2\n\nLine 4",No data\n'
                 "5,Extra fields,data,info,message,,,\n6,Missing fields\n", encoding="utf-8")
    got = read_delimited(spark, str(f), "id INT, description STRING, data STRING, info STRING").orderBy("id").collect()
    assert [r.id for r in got] == [1, 2, 3, 4, 5, 6] and sum(r.id for r in got) == 21
    assert got[2].data == 'Quoted "citation" data' and got[3].data == "Line 1\nLine 2\n\nLine 4"
    assert got[4].info == "info" and got[5].data is None
    ids = ly.Layer(read_delimited(spark, str(f))).with_fid()
    assert ids.agg(F.sum("fid")).first()[0] == 15


def test_separator_and_dynamic_geometry(spark, tmp_path):
    f = tmp_path / "p.txt"
    f.write_text("id|description|x|y\n" + "".join(f"{i}|Point {i}|{i * 10}|{i * 5}\n" for i in range(1, 10)))
    df = read_delimited(spark, str(f), "id INT, description STRING, x INT, y INT", sep="|")
    df.createOrReplaceTempView("pts")
    register_functions(spark, ["MakePoint"])
    made = ly.create_layer(spark, "?layer_ref=pts&query=select *, MakePoint(x, y) as geom from vtab1&geometry=geom:1:0&uid=id")
    assert made.with_fid().agg(F.sum("fid")).first()[0] == 45
    assert point_layer(df).select("geom.parts").first()[0][0].rings[0][0].x == 10.0


def test_encoding(spark, tmp_path):
    f = tmp_path / "l.csv"
    f.write_bytes("id,kind\n1,Région\n".encode("latin1"))
    for enc, text in (("latin1", "Région"), ("UTF-8", "R�gion")):
        made = ly.create_layer(spark, ly.LayerDef((ly.Source("fp", "csv", str(f), enc, {"header": "true"}),)))
        assert made.df.first().kind == text


def test_definition_from_url():
    d = ly.LayerDef.from_url("?layer=csv:file%3A///a%2Cb.csv:t:latin1&layer_ref=other&layer=parquet:/p&query=SELECT%201&uid=id&geometry=g:polygon:4326")
    assert [(s.name, s.fmt, s.path, s.encoding, s.ref) for s in d.named_sources()] == [
        ("t", "csv", "file:///a,b.csv", "latin1", None), ("vtab2", None, None, "UTF-8", "other"), ("vtab3", "parquet", "/p", "UTF-8", None)]
    assert (d.query, d.uid, d.geometry, d.gtype, d.srid, d.nogeometry) == ("SELECT 1", "id", "g", 3, 4326, False)
    assert ly.LayerDef.from_url("?layer=parquet:/p&nogeometry").nogeometry


def test_query_uid_and_geometry_choice(spark, parts):
    url = f"?layer=parquet:{parts}:ww&query=SELECT *, geometry AS geom2 FROM ww&uid=ObJeCtId"
    first = ly.create_layer(spark, url)
    assert (first.uid, first.geometry, first.gtype, first.srid) == ("OBJECTID", "geometry", 3, 4326)
    assert first.with_fid().agg(F.sum("fid"), F.sum("km")).first() == (59, 3064.0)
    assert ly.create_layer(spark, url + "&geometry=geom2:3:4326").geometry == "geom2"
    bare = ly.create_layer(spark, url + "&nogeometry")
    assert bare.geometry is None and geometry_columns(bare.df) == []
    short = ly.create_layer(spark, url + "&geometry=geom2:polygon")
    assert (short.geometry, short.gtype, short.srid) == ("geom2", 3, 0)
    assert ly.LayerDef.from_url("?geometry=g:1003:4326").gtype == 3
    with pytest.raises(ValueError, match="geometry field"):
        ly.create_layer(spark, url + "&geometry=geo")
    with pytest.raises(ValueError, match="id column"):
        ly.create_layer(spark, url.replace("ObJeCtId", "nope"))


def test_requests(spark, parts):
    made = ly.create_layer(spark, f"?layer=parquet:{parts}:ww&query=SELECT * FROM ww&uid=objectid")

    def ids(**kw):
        return sorted(r.OBJECTID for r in made.features(**kw).collect())

    assert ids(rect=(-1.677, 49.624, -0.816, 49.086), exact=True) == [11]
    assert ids(fid=11) == [11] and ids(fids=[11, 14]) == [11, 14]
    assert ids(fids=spark.createDataFrame([(14,), (5,)], "k long")) == [14]
    assert ids(rect=(-2, 47.6, -1.9, 48)) == [14] and ids(rect=(-2, 47.6, -1.9, 48), exact=True) == []
    assert ids(rect=(-9, 40, 9, 60), fid=11) == [11, 12, 14, 22]
    assert ids(subset="name LIKE 'B%'", rect=(-9, 40, 9, 60)) == [11]
    assert made.features(columns=["km"]).columns == ["OBJECTID", "km", "geometry"]
    assert made.features(geometry=False).columns == ["OBJECTID", "km", "name", "kind"]
    assert ids(rect=(1.4, 47.4, 1.5, 47.5), exact=True) == [22]  # a rectangle inside the polygon
    no_uid = ly.create_layer(spark, f"?layer=parquet:{parts}")
    assert no_uid.features(fid=11).count() == 4


def test_rectangles_prune_by_bounds_columns(spark, tmp_path):
    with_bounds(layer(spark, SF, "supplier_tri")).write.parquet(str(tmp_path / "t"))
    df = ly.rect_filter(spark.read.parquet(str(tmp_path / "t")), (0, 0, 10, 10))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(xmax,0.0)" in plan and "LessThanOrEqual(ymin,10.0)" in plan


def test_statistics(spark, parts):
    made = ly.create_layer(spark, f"?layer=parquet:{parts}")
    assert tuple(made.stats().first()) == (4, -2.0, 47.0, 2.0, 50.0)
    assert made.stats() is made.stats()
    assert ly.layer_stats(made.df.drop("geometry"), None).first().n == 4


def test_errors(spark, parts):
    with pytest.raises(ValueError, match="source layer or a query"):
        ly.create_layer(spark, ly.LayerDef())
    with pytest.raises(ValueError, match="need a query"):
        ly.create_layer(spark, f"?layer=parquet:{parts}&layer=parquet:{parts}")
    with pytest.raises(ValueError, match="Referenced table nowhere in query not found!"):
        ly.create_layer(spark, "?query=SELECT * FROM nowhere")
    with pytest.raises(ValueError, match="Result column #1 has no name"):
        ly.create_layer(spark, "?query=SELECT 42")
    assert ly.create_layer(spark, "?query=SELECT 42 AS `share (per cent)`").df.columns == ["share (per cent)"]
    with pytest.raises(AnalysisException):
        ly.create_layer(spark, f"?layer=parquet:{parts}:p&query=SELECT missing FROM p")
    register_functions(spark, ["GeomFromText"])
    with pytest.raises(ValueError, match="Can't deduce the geometry type"):
        ly.create_layer(spark, "?query=SELECT GeomFromText('') AS geom&geometry=geom")
    made = ly.create_layer(spark, "?query=SELECT GeomFromText('POINT(0 0)') AS geom&geometry=geom:point:0")
    assert (made.gtype, made.srid) == (1, 0)
    named = ly.create_layer(spark, "?query=SELECT 42 AS t, 'ok'||'ok' AS t2")
    assert named.df.dtypes == [("t", "int"), ("t2", "string")] and named.df.first().t2 == "okok"


def test_save_and_open(spark, parts, tmp_path):
    at = str(tmp_path / "saved")
    made = ly.create_layer(spark, f"?layer=parquet:{parts}:v&query=SELECT * FROM v&uid=objectid&geometry=geometry:3:4326")
    made.save(at)
    back = ly.open_layer(spark, at)
    assert (back.uid, back.geometry, back.gtype, back.srid) == ("OBJECTID", "geometry", 3, 4326)
    assert back.with_fid().agg(F.sum("fid"), F.sum("km")).first() == (59, 3064.0)
    ly.create_layer(spark, f"?layer=parquet:{parts}:v&nogeometry").save(at)
    assert ly.open_layer(spark, at).geometry is None
    made.save(at, data=True)
    assert ly.open_layer(spark, at).features(rect=(-2, 49, -1, 50)).count() == 1
    with pytest.raises(ValueError, match="No metadata"):
        ly.open_layer(spark, str(tmp_path / "nothing"))
    spark.createDataFrame([(9,)], "version int").write.mode("overwrite").json(f"{at}/definition")
    with pytest.raises(ValueError, match="version"):
        ly.open_layer(spark, at)
    made.view("live_parts")
    with pytest.raises(ValueError, match="Cannot store referenced layers"):
        ly.create_layer(spark, "?layer_ref=live_parts").save(at)


def test_definitions_hold_what_the_query_reads(spark, parts, tmp_path):
    ly.create_layer(spark, f"?layer=parquet:{parts}").view("found by name")
    spark.range(5).createOrReplaceTempView("side_rows")
    q = ("WITH own AS (SELECT * FROM `found by name` WHERE km > (SELECT min(id) FROM side_rows)) "
         "SELECT own.km, n FROM own JOIN (SELECT count(*) AS n FROM side_rows) AS c")
    assert sorted(ly.relations(spark, q)) == ["found by name", "side_rows"]
    made = ly.create_layer(spark, ly.LayerDef(query=q))
    assert sorted(s.ref for s in made.definition.sources) == ["found by name", "side_rows"]
    with pytest.raises(ValueError, match="Cannot store referenced layers"):
        made.save(str(tmp_path / "no"))
    made.save(str(tmp_path / "yes"), data=True)
    assert ly.open_layer(spark, str(tmp_path / "yes")).df.count() == 4


def test_names_are_judged_by_the_query_not_by_their_letters(spark):
    spark.sql("SELECT 1 AS `2020`, 2 AS `price ($)`, 3 AS `a+b`").createOrReplaceTempView("odd_names")
    assert ly.create_layer(spark, "?query=SELECT * FROM odd_names").df.columns == ["2020", "price ($)", "a+b"]
    assert ly.create_layer(spark, "?query=SELECT `a+b`, explode(array(1)) FROM odd_names").df.columns == ["a+b", "col"]
    for query, place in (("SELECT 'ok'", 1), ("SELECT NULL", 1), ("SELECT *, 1 + 1 FROM odd_names", 4), ("SELECT `2020` AS y, upper('a') FROM odd_names ORDER BY 1 LIMIT 3", 2),
                         ("SELECT count(*) FROM odd_names", 1), ("SELECT 1 AS a UNION ALL SELECT 2", 0)):
        if place:
            with pytest.raises(ValueError, match=f"Result column #{place} has no name"):
                ly.create_layer(spark, ly.LayerDef(query=query))
        else:
            assert ly.create_layer(spark, ly.LayerDef(query=query)).df.columns == ["a"]
    rules = {r.rule: r.violations for r in ly.contract(spark.sql("SELECT *, 1 + `2020` FROM odd_names")).collect()}
    assert rules["unnamed_columns"] == 1


def test_types_are_declared_known_or_refused(spark):
    register_functions(spark, ["MakePoint", "GeomFromText", "CastToPoint"])
    text = "GeomFromText('POINT(1 2)')"
    with pytest.raises(ValueError, match="Can't deduce the geometry type"):
        ly.create_layer(spark, f"?query=SELECT {text} AS geom&geometry=geom")
    plain = ly.create_layer(spark, f"?query=SELECT 42 AS t, {text} AS t3")
    assert plain.geometry is None and plain.df.columns == ["t", "t3"]
    for made in (f"?query=SELECT {text} AS geom&geometry=geom:point:0", f"?query=SELECT CastToPoint({text}) AS geom", "?query=SELECT MakePoint(1, 2) AS geom&geometry=geom"):
        assert ly.create_layer(spark, made).gtype == 1


@pytest.mark.parametrize("uid", ["id", None])
def test_stored_files_are_even_and_skipped(spark, tmp_path, uid):
    """A cluster, a place with many features and an outlier."""
    rnd = random.Random(12)
    data = [(i, rnd.gauss(0, 1), rnd.gauss(0, 1)) for i in range(6000)] + [(6000 + i, 0.25, 0.25) for i in range(2000)] + [(9999, 1e9, -1e9)]
    df = spark.createDataFrame(data, "id long, x double, y double").withColumn("geom", typed(F.expr(x.point("x", "y")), "geom", 1, 0)).drop("x", "y")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ly.Layer(df, uid, "geom", 1, 0).save(str(tmp_path / "s"), data=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = ly.open_layer(spark, str(tmp_path / "s"))
    files = back.df.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), *(F.min(c).alias(c) for c in ("xmin", "ymin")), *(F.max(c).alias(c) for c in ("xmax", "ymax"))).collect()
    assert len(files) >= 14 and max(f.n for f in files) < 2.5 * min(f.n for f in files)
    rect = (0.9, 0.9, 1.4, 1.4)
    met = [f for f in files if f.xmax >= rect[0] and f.xmin <= rect[2] and f.ymax >= rect[1] and f.ymin <= rect[3]]
    assert len(met) <= len(files) // 2
    assert back.features(rect=rect).count() == sum(rect[0] <= px <= rect[2] and rect[1] <= py <= rect[3] for _, px, py in data)


def test_views_over_views_and_names(spark, parts):
    base = ly.create_layer(spark, f"?layer=parquet:{parts}")
    base.view("FranCe parts")
    for i in range(3):
        again = ly.create_layer(spark, f"?layer_ref=FranCe parts:t{i}&query=SELECT * FROM t{i}&uid=OBJECTID")
        assert again.with_fid().agg(F.sum("fid")).first()[0] == 59
    assert spark.sql("SELECT OBJECTId FROM `FranCe parts`").agg(F.sum("OBJECTId")).first()[0] == 59


def test_denormalize(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string").withColumn("uid", F.lit(0))
    other = spark.createDataFrame([("a", 10), ("c", 30)], "key string, n int")
    df, pk = ly.denormalize(base, [ly.AttributeJoin("o", other, "k", "key"), ly.AttributeJoin("p", other, "k", "key", ("n",))])
    assert pk == "uid_" and df.columns == ["id", "k", "uid", "uid_", "o_key", "o_n", "p_n"]
    assert {(r.id, r.o_n, r.p_n) for r in df.collect()} == {(1, 10, 10), (2, None, None), (3, None, None)}
    assert sorted(r.uid_ for r in df.collect()) == [0, 1, 2]


def test_contract_counts_violations(spark, parts):
    df = ly.create_layer(spark, f"?layer=parquet:{parts}").df.unionByName(spark.read.parquet(parts).filter("OBJECTID = 11"))
    got = {r.rule: r.violations for r in ly.contract(df, "OBJECTID", "geometry", 3, 0).collect()}
    assert got == {"unnamed_columns": 0, "geom_null": 0, "geom_type": 0, "geom_srid": 5, "uid_null": 0, "uid_duplicate": 1}


def test_metadata_and_text(spark, parts):
    df = spark.read.parquet(parts)
    marked = df.withColumn("geometry", typed(F.col("geometry"), "geometry", 3, 4326))
    assert marked.filter("km > 0").select("geometry").schema["geometry"].metadata == {"gtype": 3, "srid": 4326}
    assert ly.geometry_type(marked, "geometry") == (3, 4326)
    text = ly.with_wkt(df.filter("OBJECTID = 14"), "geometry").first().geometry
    assert text == PARTS[2][4]
    good, bad = wkt_layer(spark.createDataFrame([("POINT(1 1)",), ("POINT(",), (None,)], "wkt string"))
    assert (good.count(), bad.count()) == (1, 2)


def test_requests_work_on_a_stream(spark, parts, tmp_path):
    """Requests and measures are stateless, so a streaming DataFrame takes them unchanged."""
    stream = spark.readStream.schema(spark.read.parquet(parts).schema).parquet(parts)
    near = ly.rect_filter(stream, (-2, 49, 1, 50), True, "geometry").select("OBJECTID", F.expr(x.area("geometry")).alias("a"))
    q = near.writeStream.format("memory").queryName("near_parts").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {r.OBJECTID for r in spark.table("near_parts").collect()} == {11, 12}


def test_views_of_the_session_keep_their_rows(spark, parts):
    spark.range(3).createOrReplaceTempView("mine")
    made = ly.create_layer(spark, f"?layer=parquet:{parts}:mine&query=SELECT * FROM mine&uid=objectid")
    assert made.df.count() == 4 and spark.table("mine").count() == 3
    with pytest.raises(ValueError, match="not found"):
        ly.create_layer(spark, f"?layer=parquet:{parts}:mine&query=SELECT * FROM mine JOIN nowhere")
    assert spark.table("mine").count() == 3


def test_url_with_a_storage_path(spark, parts, tmp_path):
    at = str(tmp_path / "stored layer").replace(" ", "%20")
    made = ly.create_layer(spark, f"{at}?layer=parquet:{parts}:ww&query=SELECT objectid, geometry FROM ww WHERE km > 730 AND 'a?b' <> ''&uid=objectid")
    back = ly.create_layer(spark, at)
    assert back.df.columns == made.df.columns == ["objectid", "geometry"] and back.uid == "objectid"
    assert back.df.count() == 3
    assert ly.create_layer(spark, f"layer=parquet:{parts}").df.count() == 4


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    from lamina import session

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Stub:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Stub, "step")
    Stub.conf["spark.checkpoint.dir"] = "/shared"
    assert session.shared_folder(Stub, "step").startswith("/shared/lamina-step-")
