"""SQL names of the geometry functions, as temporary SQL functions.

``register_functions(spark)`` makes the names usable in any query text.  Spark expands
the bodies while planning, so nothing runs in Python.  Rewrites that need several rows
(collect, union, make line over rows, ...) are DataFrame operators, not functions.

Names taken by Spark's own functions are left out: ``reverse`` and ``transform`` exist
here only with the ``ST_`` prefix, ``contains`` only as ``ST_Contains``, and ``st_srid``
and ``st_setsrid`` only as ``Srid`` and ``SetSrid``.
"""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession

from lamina.functions import exprs as x
from lamina.functions import relate as r

G = x.GEOM
D = "DOUBLE"


def _both(*names: str) -> list[str]:
    """Each name with and without the ST_ prefix."""
    return [p + n for n in names for p in ("", "ST_")]


def _pair(name: str) -> str:
    def side(g: str) -> str:
        return (
            f"named_struct('es', {x.edges(g)}, 'dim', {x.dimension(g)}, 'ends', {x.ends(g)}, 'anchors', {x.anchors(g)})"
        )

    return x.let(side("a"), "sa", x.let(side("b"), "sb", r.predicate(name, "sa.", "sb.")))


def _distance(what: str) -> str:
    near = x.closest("de", "df")
    meets = (
        f"({x.any_edges_touch('de', 'df')} "
        f"OR ({x.dimension('b')} = 2 AND exists({x.anchors('a')}, dp -> {x.locate('dp.x', 'dp.y', 'df')} > 0)) "
        f"OR ({x.dimension('a')} = 2 AND exists({x.anchors('b')}, dq -> {x.locate('dq.x', 'dq.y', 'de')} > 0)))"
    )
    body = {
        "distance": f"IF({meets}, 0D, sqrt({near}.d2))",
        # features that meet away from the ends of their edges have no such place
        "closest": x.let(near, "dn", f"IF(dn.d2 > 0 AND {meets}, NULL, {x.point('dn.ax', 'dn.ay', 'a.srid')})"),
        "shortest": x.let(near, "dn", f"IF(dn.d2 > 0 AND {meets}, NULL, {x.line(x.ring_of(('dn.ax', 'dn.ay'), ('dn.bx', 'dn.by')), 'a.srid')})"),
    }[what]
    return x.let(x.edges("a"), "de", x.let(x.edges("b"), "df", body))


def _mbr_pair(fn) -> str:
    return x.let(x.bounds("a"), "ba", x.let(x.bounds("b"), "bb", fn("ba", "bb")))


# fixed values: time format letters and what they stand for
TIME_FORMATS = {
    "%d": "date_format(t, 'dd')", "%f": "date_format(t, 'ss.SSS')", "%H": "date_format(t, 'HH')", "%j": "date_format(t, 'DDD')", "%J": "CAST(julianday AS STRING)",
    "%m": "date_format(t, 'MM')", "%M": "date_format(t, 'mm')", "%s": "CAST(unix_date(to_date(t)) * 86400L + hour(t) * 3600 + minute(t) * 60 + CAST(floor(extract(SECOND FROM t)) AS BIGINT) AS STRING)",
    "%S": "date_format(t, 'ss')", "%w": "CAST(dayofweek(t) - 1 AS STRING)", "%W": "lpad(CAST((dayofyear(t) + 6 - (dayofweek(t) + 5) % 7) div 7 AS STRING), 2, '0')", "%Y": "date_format(t, 'yyyy')",
}
JULIAN_DAY = "unix_date(to_date(t)) + (hour(t) * 3600 + minute(t) * 60 + CAST(extract(SECOND FROM t) AS DOUBLE)) / 86400D + 2440587.5D"


def _time_text(f: str) -> str:
    """SQL: a time format filled in; all other letters stay as they are, ``%%`` is a percent sign."""
    # what is filled in holds no percent sign, so letters can be filled in one after the other
    f = f"replace({f}, '%%', '\\0')"
    for mark, made in TIME_FORMATS.items():
        f = f"replace({f}, '{mark}', {made.replace('julianday', JULIAN_DAY)})"
    return f"replace({f}, '\\0', '%')"


def _glob_pattern(p: str) -> str:
    """Anchored regular expression of a glob: * any run, ? one character, [...] a set, [^...] its complement."""
    escaped = "regexp_replace(" + p + r", '([.+$(){}|\\\\]|(?<!\\[)\\^)', '\\\\$1')"
    return f"concat('^(?s)', replace(replace({escaped}, '*', '.*'), '?', '.'), '$')"


def definitions() -> list[tuple[list[str], str, str, str]]:
    """(names, parameters, return type, body) of every SQL function."""
    g, gg = f"g {G}", f"a {G}, b {G}"
    out: list[tuple[list[str], str, str, str]] = []

    def add(names, params, returns, body):
        out.append(([names] if isinstance(names, str) else list(names), params, returns, body))

    # constructors
    add(["MakePoint", "ST_Point"], f"x {D}, y {D}, srid INT DEFAULT 0", G, x.point("x", "y", "srid"))
    add("MakePointZ", f"x {D}, y {D}, z {D}, srid INT DEFAULT 0", G, x.point("x", "y", "srid", "z"))
    add("MakeLine", gg, G, x.line(f"array({x.first_ring('a')}[0], {x.first_ring('b')}[0])", "a.srid"))
    add("BuildMbr", f"x1 {D}, y1 {D}, x2 {D}, y2 {D}, srid INT DEFAULT 0", G, x.box("x1", "y1", "x2", "y2", "srid"))
    add("BuildCircleMbr", f"x {D}, y {D}, r {D}, srid INT DEFAULT 0", G, x.box("x - r", "y - r", "x + r", "y + r", "srid"))
    text = {
        "point": ["Point"],
        "linestring": ["Line", "LineString"],
        "polygon": ["Poly", "Polygon"],
        "multipoint": ["MPoint", "MultiPoint"],
        "multilinestring": ["MLine", "MultiLineString"],
        "multipolygon": ["MPoly", "MultiPolygon"],
    }
    for kind, stems in text.items():
        add(_both(*(s + "FromText" for s in stems)), "t STRING, srid INT DEFAULT 0", G, x.from_wkt("t", "srid", kind))
    add(_both("GeomFromText"), "t STRING, srid INT DEFAULT 0", G, x.from_wkt("t", "srid"))

    # scalar and geometry casts
    add("CastToInteger", "v STRING", "BIGINT", "CAST(try_cast(v AS DOUBLE) AS BIGINT)")
    add("CastToDouble", "v STRING", D, "try_cast(v AS DOUBLE)")
    add("CastToText", "v STRING", "STRING", "v")
    for name, code in x.TYPE_CODES.items():
        add("CastTo" + name, g, G, x.cast_type("g", code))
    add(["CastToMulti", "ST_Multi"], g, G, x.cast_multi("g"))
    add("CastToSingle", g, G, x.cast_single("g"))
    add("CastToXY", g, G, x.to_xy("g"))
    add("CastToXYZ", g, G, x.to_xyz("g"))

    # accessors
    add("ST_X", g, D, f"IF(g.gtype = 1, {x.first_ring('g')}[0].x, {x.NO_Z})")
    add("ST_Y", g, D, f"IF(g.gtype = 1, {x.first_ring('g')}[0].y, {x.NO_Z})")
    add("ST_Z", g, D, f"IF(g.gtype = 1, {x.first_ring('g')}[0].z, {x.NO_Z})")
    add("ST_Dimension", g, "INT", x.dimension("g"))
    add("ST_GeometryType", g, "STRING", x.type_name("g"))
    add("ST_AsText", g, "STRING", x.to_wkt("g"))
    add("Srid", g, "INT", "g.srid")
    add("SetSrid", f"g {G}, srid INT", G, x.set_srid("g", "srid"))
    add(_both("NumPoints"), g, "INT", f"IF(g.gtype = 2, size({x.first_ring('g')}), CAST(NULL AS INT))")
    add(_both("PointN"), f"g {G}, n INT", G, x.nth_vertex("g", "n"))
    add(_both("StartPoint"), g, G, x.nth_vertex("g", "1"))
    add(_both("EndPoint"), g, G, x.nth_vertex("g", "-1"))
    add(_both("ExteriorRing"), g, G, x.exterior_ring("g"))
    add(_both("InteriorRingN"), f"g {G}, n INT", G, x.interior_ring("g", "n"))
    add("ST_Boundary", g, G, x.boundary("g"))
    add(_both("NumGeometries"), g, "INT", "size(g.parts)")
    add(_both("GeometryN"), f"g {G}, n INT", G, x.part_n("g", "n"))
    for kind, name in ((1, "MultiPoint"), (2, "MultiLineString"), (3, "MultiPolygon")):
        add("Extract" + name, g, G, x.only_kind("g", kind))
    add("ST_IsEmpty", g, "BOOLEAN", f"coalesce({x.n_points('g')}, 0) <= 0")
    add("ST_IsClosed", g, "BOOLEAN", f"g.gtype IN (2, 5) AND forall({x.rings('g')}, ic_r -> {x.closed_ring('ic_r')})")

    # measures and boxes
    add("ST_Area", g, D, x.area("g"))
    add("ST_Length", g, D, x.length("g"))
    add("ST_Perimeter", g, D, x.perimeter("g"))
    add(_both("Centroid"), g, G, x.let(x.centroid_xy("g"), "cp", x.point("cp.x", "cp.y", "g.srid")))
    add(_both("Envelope"), g, G, x.envelope("g"))
    for name in ("MinX", "MinY", "MaxX", "MaxY"):
        add(["ST_" + name, "Mbr" + name], g, D, f"({x.bounds('g')}).{name[-1].lower()}{name[:3].lower()}")

    # editing
    add("ST_Reverse", g, G, x.reverse_line("g"))
    add(_both("AddPoint"), f"g {G}, p {G}, n INT DEFAULT -1", G, x.add_point("g", "p", "n"))
    add(_both("SetPoint"), f"g {G}, n INT, p {G}", G, x.set_point("g", "n", "p"))
    add(_both("RemovePoint"), f"g {G}, n INT", G, x.remove_point("g", "n"))
    add(_both("MakePolygon"), f"g {G}, h {G} DEFAULT NULL", G, x.make_polygon("g", "h"))
    add(_both("ForceLHR"), g, G, x.force_lhr("g"))
    add(["ST_Translate"], f"g {G}, dx {D}, dy {D}, dz {D} DEFAULT 0D", G, x.translate("g", "dx", "dy", "dz"))
    add(["ScaleCoords", "ScaleCoordinates"], f"g {G}, fx {D}, fy {D} DEFAULT NULL", G, x.scale("g", "fx", "coalesce(fy, fx)"))
    add(["RotateCoords", "RotateCoordinates"], f"g {G}, angle {D}", G, x.rotate("g", "angle"))
    add(["ReflectCoords", "ReflectCoordinates"], f"g {G}, fx INT, fy INT", G, x.reflect("g", "fx", "fy"))
    add(["SwapCoords", "SwapCoordinates"], g, G, x.swap_xy("g"))
    add("ST_Shift_Longitude", g, G, x.shift_longitude("g"))
    add("NormalizeLonLat", g, G, x.normalize_lonlat("g"))
    add("ST_Transform", f"g {G}, srid INT", G, x.transform_crs("g", "srid"))
    add("ST_Expand", f"g {G}, r {D}", G,
        x.let(x.bounds("g"), "bf", x.box("bf.xmin - r", "bf.ymin - r", "bf.xmax + r", "bf.ymax + r", "g.srid")))
    add(_both("Buffer"), f"g {G}, r {D}", G,
        f"CASE WHEN g IS NULL THEN NULL WHEN g.gtype = 1 THEN {x.circle(x.first_ring('g') + '[0].x', x.first_ring('g') + '[0].y', 'r', 32, 'g.srid')} "
        "ELSE raise_error('Buffer takes single points; ST_Expand widens the box of any geometry') END")

    # places on lines and surfaces, clipping to a convex polygon, validity
    add(_both("Line_Interpolate_Point"), f"g {G}, f {D}", G, x.interpolate_point("g", "f"))
    add(_both("Line_Interpolate_Equidistant_Points"), f"g {G}, d {D}", G, x.equidistant_points("g", "d"))
    add(_both("Line_Substring"), f"g {G}, f0 {D}, f1 {D}", G, x.substring("g", "f0", "f1"))
    add(_both("PointOnSurface"), g, G, x.let(x.point_on_surface("g"), "pp", x.point("pp.x", "pp.y", "g.srid")))
    add(_both("Intersection"), gg, G, x.clip_to_convex("a", "b"))
    add(_both("ConvexHull"), g, G, x.convex_hull("g"))
    add(_both("Snap"), f"a {G}, b {G}, tolerance {D}", G, x.snap_to("a", "b", "tolerance"))
    add("ST_IsSimple", g, "BOOLEAN", x.is_simple("g"))
    add("ST_IsRing", g, "BOOLEAN", f"g.gtype = 2 AND {x.closed_ring(x.first_ring('g'))} AND {x.is_simple('g')}")
    add("ST_IsValid", g, "BOOLEAN", x.is_valid("g"))

    # scalar names of the query dictionary that Spark lacks
    add("julianday", "t TIMESTAMP_NTZ", D, JULIAN_DAY)
    add("datetime", "t TIMESTAMP_NTZ", "STRING", "date_format(t, 'yyyy-MM-dd HH:mm:ss')")
    add("strftime", "f STRING, t TIMESTAMP_NTZ", "STRING", _time_text("f"))
    add("glob", "p STRING, t STRING", "BOOLEAN", f"t RLIKE {_glob_pattern('p')}")

    # pair predicates, for pairs already found by a join of lamina.operators.spatial
    for name, fn in (("Equal", x.mbr_same), ("Touches", x.mbr_touching), ("Within", x.mbr_inside),
                     ("Overlaps", x.mbr_overlapping), ("Intersects", x.mbr_meets)):
        add("Mbr" + name, gg, "BOOLEAN", _mbr_pair(fn))
    add("MbrContains", gg, "BOOLEAN", _mbr_pair(lambda p, q: x.mbr_inside(q, p)))
    add("MbrDisjoint", gg, "BOOLEAN", _mbr_pair(lambda p, q: f"(NOT {x.mbr_meets(p, q)})"))
    for name in ("Intersects", "Disjoint", "Within", "Touches", "Overlaps", "Crosses"):
        add(_both(name), gg, "BOOLEAN", _pair(name.lower()))
    add("ST_Contains", gg, "BOOLEAN", _pair("contains"))
    add("ST_Equals", gg, "BOOLEAN", f"{r.edge_key(x.edges('a'))} = {r.edge_key(x.edges('b'))}")
    add("ST_Distance", gg, D, _distance("distance"))
    add(_both("ClosestPoint"), gg, G, _distance("closest"))
    add(_both("ShortestLine"), gg, G, _distance("shortest"))
    return out


_DONE: WeakKeyDictionary = WeakKeyDictionary()  # session -> names it already has


def register_functions(spark: SparkSession, only: list[str] | None = None) -> None:
    """Create the temporary SQL functions (all, or ``only`` some) once per session."""
    done = _DONE.setdefault(spark, set())
    wanted = None if only is None else {n.lower() for n in only} - done
    if wanted is not None and not wanted:
        return
    for names, params, returns, body in definitions():
        for name in names:
            low = name.lower()
            if low not in done and (wanted is None or low in wanted):
                spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")
                done.add(low)
