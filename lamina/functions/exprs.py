"""Geometry expressions as Spark SQL text.

Every function here takes Spark SQL expressions (usually column names) and
returns a Spark SQL expression built from native array/struct functions, so the
same text serves ``selectExpr``/``F.expr`` (see :mod:`lamina.functions.columns`)
and the SQL functions registered by :mod:`lamina.functions.registry`.

Layout of a geometry value::

    GEOM = struct<gtype, srid, parts: array<struct<kind, rings: array<array<struct<x, y, z>>>>>>

``gtype``/``kind``: 1 point, 2 line, 3 polygon; ``gtype`` 4/5/6 = multi, 0 = mixed.
Polygon rings are closed and ring 0 is the outer one; a point is one ring of one
vertex; ``z`` is NULL in two dimensions.

Lambda variables carry a prefix of their own in each function because the
expressions are nested into each other.
"""

from __future__ import annotations

PT = "STRUCT<x: DOUBLE, y: DOUBLE, z: DOUBLE>"
RING = f"ARRAY<{PT}>"
PART = f"STRUCT<kind: INT, rings: ARRAY<{RING}>>"
GEOM = f"STRUCT<gtype: INT, srid: INT, parts: ARRAY<{PART}>>"
EDGES = "ARRAY<STRUCT<x1: DOUBLE, y1: DOUBLE, x2: DOUBLE, y2: DOUBLE>>"

NO_Z = "CAST(NULL AS DOUBLE)"
NO_GEOM = f"CAST(NULL AS {GEOM})"

# Geometry type codes and their names.
TYPE_CODES = {
    "point": 1,
    "linestring": 2,
    "polygon": 3,
    "multipoint": 4,
    "multilinestring": 5,
    "multipolygon": 6,
}
EARTH_RADIUS = 6378137.0  # metres, sphere of EPSG:3857


# ---------------------------------------------------------------- building

def let(value: str, name: str, body: str) -> str:
    """Evaluate ``value`` once and refer to it as ``name`` inside ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def vertex(x: str, y: str, z: str = NO_Z) -> str:
    return f"named_struct('x', CAST({x} AS DOUBLE), 'y', CAST({y} AS DOUBLE), 'z', CAST({z} AS DOUBLE))"


def part(kind: str | int, rings: str) -> str:
    return f"named_struct('kind', CAST({kind} AS INT), 'rings', {rings})"


def geom(gtype: str | int, srid: str | int, parts: str) -> str:
    return f"named_struct('gtype', CAST({gtype} AS INT), 'srid', CAST({srid} AS INT), 'parts', {parts})"


def point(x: str, y: str, srid: str | int = 0, z: str = NO_Z) -> str:
    return geom(1, srid, f"array({part(1, f'array(array({vertex(x, y, z)}))')})")


def line(ring: str, srid: str | int = 0) -> str:
    return geom(2, srid, f"array({part(2, f'array({ring})')})")


def polygon(rings: str, srid: str | int = 0) -> str:
    """Polygon from an array of closed rings."""
    return geom(3, srid, f"array({part(3, rings)})")


def ring_of(*xy: tuple[str, str]) -> str:
    """Array of vertices from (x, y) expression pairs."""
    return "array(" + ", ".join(vertex(x, y) for x, y in xy) + ")"


def box(x0: str, y0: str, x1: str, y1: str, srid: str | int = 0) -> str:
    """Axis-aligned rectangle, counter-clockwise from its lower left corner; corners in any order."""
    lx, hx = f"least({x0}, {x1})", f"greatest({x0}, {x1})"
    ly, hy = f"least({y0}, {y1})", f"greatest({y0}, {y1})"
    return polygon(f"array({ring_of((lx, ly), (hx, ly), (hx, hy), (lx, hy), (lx, ly))})", srid)


def circle(x: str, y: str, r: str, n: str | int = 32, srid: str | int = 0) -> str:
    """Regular polygon with ``n`` corners around a point."""
    turn = f"2 * pi() * (cb_i % {n}) / {n}"
    pts = f"transform(sequence(0, {n}), cb_i -> {vertex(f'{x} + {r} * cos({turn})', f'{y} + {r} * sin({turn})')})"
    return polygon(f"array({pts})", srid)


# ---------------------------------------------------------------- reading

def vertices(g: str) -> str:
    return f"flatten(transform({g}.parts, vs_p -> flatten(vs_p.rings)))"


def rings(g: str) -> str:
    return f"flatten(transform({g}.parts, rs_p -> rs_p.rings))"


def ring_edges(r: str) -> str:
    n = f"greatest(size({r}) - 1, 0)"
    return (
        f"zip_with(slice({r}, 1, {n}), slice({r}, 2, {n}), "
        "(re_s, re_e) -> named_struct('x1', re_s.x, 'y1', re_s.y, 'x2', re_e.x, 'y2', re_e.y))"
    )


def edges(g: str) -> str:
    """All edges of all rings; a point contributes one edge of length zero."""
    lone = "transform(ed_r, ed_v -> named_struct('x1', ed_v.x, 'y1', ed_v.y, 'x2', ed_v.x, 'y2', ed_v.y))"
    return (
        f"flatten(transform({g}.parts, ed_p -> flatten(transform(ed_p.rings, "
        f"ed_r -> IF(ed_p.kind = 1, {lone}, {ring_edges('ed_r')})))))"
    )


def anchors(g: str) -> str:
    """First vertex of every part."""
    return f"transform({g}.parts, an_p -> an_p.rings[0][0])"


def ends(g: str) -> str:
    """End vertices of the open lines of a geometry (its boundary, for lines)."""
    open_lines = f"filter({g}.parts, en_p -> en_p.kind = 2 AND NOT ({closed_ring('en_p.rings[0]')}))"
    return (
        f"flatten(transform({open_lines}, en_q -> array(element_at(en_q.rings[0], 1), element_at(en_q.rings[0], -1))))"
    )


def closed_ring(r: str) -> str:
    return f"(element_at({r}, 1).x = element_at({r}, -1).x AND element_at({r}, 1).y = element_at({r}, -1).y)"


def bounds(g: str) -> str:
    """struct<xmin, ymin, xmax, ymax> in one pass; all NULL for an empty geometry."""
    empty = ", ".join(f"'{n}', {NO_Z}" for n in ("xmin", "ymin", "xmax", "ymax"))
    step = (
        "named_struct('xmin', least(bo_s.xmin, bo_v.x), 'ymin', least(bo_s.ymin, bo_v.y), "
        "'xmax', greatest(bo_s.xmax, bo_v.x), 'ymax', greatest(bo_s.ymax, bo_v.y))"
    )
    return f"aggregate({vertices(g)}, named_struct({empty}), (bo_s, bo_v) -> {step})"


def n_points(g: str) -> str:
    return f"size({vertices(g)})"


def dimension(g: str) -> str:
    return f"(array_max(transform({g}.parts, dm_p -> dm_p.kind)) - 1)"


def has_z(g: str) -> str:
    return f"exists({vertices(g)}, hz_v -> hz_v.z IS NOT NULL)"


def type_name(g: str) -> str:
    cases = " ".join(f"WHEN {c} THEN '{n.upper()}'" for n, c in TYPE_CODES.items())
    return f"CASE {g}.gtype {cases} ELSE 'GEOMETRYCOLLECTION' END"


# ---------------------------------------------------------------- measures

def ring_area(r: str) -> str:
    """Signed area, positive when counter-clockwise."""
    return f"(aggregate({ring_edges(r)}, 0D, (ra_s, ra_e) -> ra_s + ra_e.x1 * ra_e.y2 - ra_e.x2 * ra_e.y1) / 2)"


def area(g: str) -> str:
    ring = f"IF(ar_i = 0, 1D, -1D) * abs({ring_area('ar_r')})"
    one = f"aggregate(transform(ar_p.rings, (ar_r, ar_i) -> {ring}), 0D, (ar_t, ar_v) -> ar_t + ar_v)"
    return f"aggregate({g}.parts, 0D, (ar_s, ar_p) -> ar_s + IF(ar_p.kind = 3, {one}, 0D))"


def _edge_len(e: str) -> str:
    return f"sqrt(({e}.x2 - {e}.x1) * ({e}.x2 - {e}.x1) + ({e}.y2 - {e}.y1) * ({e}.y2 - {e}.y1))"


def ring_length(r: str) -> str:
    return f"aggregate({ring_edges(r)}, 0D, (rl_s, rl_e) -> rl_s + {_edge_len('rl_e')})"


def _length_of_kind(g: str, kind: int) -> str:
    one = f"aggregate(ln_p.rings, 0D, (ln_t, ln_r) -> ln_t + {ring_length('ln_r')})"
    return f"aggregate({g}.parts, 0D, (ln_s, ln_p) -> ln_s + IF(ln_p.kind = {kind}, {one}, 0D))"


def length(g: str) -> str:
    """Length of the lines of a geometry."""
    return _length_of_kind(g, 2)


def perimeter(g: str) -> str:
    """Length of all polygon rings, holes included."""
    return _length_of_kind(g, 3)


def centroid_xy(g: str) -> str:
    """struct<x, y>: area-weighted for polygons, length-weighted for lines, vertex mean for points."""
    zero = "named_struct('w', 0D, 'x', 0D, 'y', 0D)"

    def add(s: str, w: str, x: str, y: str) -> str:
        return f"named_struct('w', {s}.w + {w}, 'x', {s}.x + {x}, 'y', {s}.y + {y})"

    cross = "(ce_e.x1 * ce_e.y2 - ce_e.x2 * ce_e.y1)"
    moments = (
        f"aggregate({ring_edges('ce_r')}, {zero}, (ce_s, ce_e) -> "
        + add("ce_s", f"{cross} / 2", f"(ce_e.x1 + ce_e.x2) * {cross} / 6", f"(ce_e.y1 + ce_e.y2) * {cross} / 6")
        + ")"
    )
    sign = "(IF(ce_i = 0, 1D, -1D) * IF(ce_m.w < 0, -1D, 1D))"
    signed = let(
        moments, "ce_m",
        f"named_struct('w', {sign} * ce_m.w, 'x', {sign} * ce_m.x, 'y', {sign} * ce_m.y)",
    )
    by_ring = (
        f"flatten(transform(filter({g}.parts, ce_p -> ce_p.kind = 3), "
        f"ce_q -> transform(ce_q.rings, (ce_r, ce_i) -> {signed})))"
    )
    wlen = _edge_len("ce_l")
    by_edge = (
        f"flatten(transform(filter({g}.parts, ce_p -> ce_p.kind = 2), ce_q -> transform({ring_edges('ce_q.rings[0]')}, "
        f"ce_l -> named_struct('w', {wlen}, 'x', {wlen} * (ce_l.x1 + ce_l.x2) / 2, 'y', {wlen} * (ce_l.y1 + ce_l.y2) / 2))))"
    )
    by_point = f"transform({vertices(g)}, ce_v -> named_struct('w', 1D, 'x', ce_v.x, 'y', ce_v.y))"
    terms = f"CASE {dimension(g)} WHEN 2 THEN {by_ring} WHEN 1 THEN {by_edge} ELSE {by_point} END"
    total = f"aggregate({terms}, {zero}, (ce_t, ce_u) -> {add('ce_t', 'ce_u.w', 'ce_u.x', 'ce_u.y')})"
    return let(total, "ce_z", "named_struct('x', ce_z.x / ce_z.w, 'y', ce_z.y / ce_z.w)")


# ---------------------------------------------------------------- editing

def map_vertices(g: str, var: str, body: str) -> str:
    """Rewrite every vertex of a geometry; ``body`` refers to the vertex as ``var``."""
    parts = (
        f"transform({g}.parts, mv_p -> "
        + part("mv_p.kind", f"transform(mv_p.rings, mv_r -> transform(mv_r, {var} -> {body}))")
        + ")"
    )
    return f"IF({g} IS NULL, {NO_GEOM}, {geom(f'{g}.gtype', f'{g}.srid', parts)})"


def translate(g: str, dx: str, dy: str, dz: str = "0D") -> str:
    return map_vertices(g, "tr_v", vertex(f"tr_v.x + {dx}", f"tr_v.y + {dy}", f"tr_v.z + {dz}"))


def scale(g: str, fx: str, fy: str) -> str:
    return map_vertices(g, "sc_v", vertex(f"sc_v.x * {fx}", f"sc_v.y * {fy}", "sc_v.z"))


def rotate(g: str, degrees: str) -> str:
    """Counter-clockwise around the origin."""
    c, s = f"cos(radians({degrees}))", f"sin(radians({degrees}))"
    return map_vertices(g, "ro_v", vertex(f"ro_v.x * {c} - ro_v.y * {s}", f"ro_v.x * {s} + ro_v.y * {c}", "ro_v.z"))


def reflect(g: str, flip_x: str, flip_y: str) -> str:
    """Mirror: a non-zero flag changes the sign of the x (first flag) or y coordinates."""
    return map_vertices(
        g, "rf_v",
        vertex(f"IF({flip_x} <> 0, -rf_v.x, rf_v.x)", f"IF({flip_y} <> 0, -rf_v.y, rf_v.y)", "rf_v.z"),
    )


def swap_xy(g: str) -> str:
    return map_vertices(g, "sw_v", vertex("sw_v.y", "sw_v.x", "sw_v.z"))


def shift_longitude(g: str) -> str:
    """Negative longitudes move by 360 degrees (range 0..360)."""
    return map_vertices(g, "sl_v", vertex("IF(sl_v.x < 0, sl_v.x + 360, sl_v.x)", "sl_v.y", "sl_v.z"))


def normalize_lonlat(g: str) -> str:
    """Longitudes into -180..180 and latitudes into -90..90; crossing a pole turns the longitude by 180."""
    lat = "(pmod(nl_v.y + 90, 360) - 90)"  # -90 .. 270
    over = f"({lat} > 90)"
    lon = f"(pmod(nl_v.x + IF({over}, 180, 0) + 180, 360) - 180)"
    keep_180 = f"IF({lon} = -180 AND nl_v.x > 0, 180D, {lon})"
    return map_vertices(g, "nl_v", vertex(keep_180, f"IF({over}, 180 - {lat}, {lat})", "nl_v.z"))


def to_xy(g: str) -> str:
    return map_vertices(g, "xy_v", vertex("xy_v.x", "xy_v.y"))


def to_xyz(g: str) -> str:
    return map_vertices(g, "xz_v", vertex("xz_v.x", "xz_v.y", "coalesce(xz_v.z, 0D)"))


def set_srid(g: str, srid: str | int) -> str:
    return f"IF({g} IS NULL, {NO_GEOM}, {geom(f'{g}.gtype', srid, f'{g}.parts')})"


def transform_crs(g: str, srid: str | int) -> str:
    """4326 <-> 3857 in closed form; the same code is a no-op; any other pair raises."""
    r = repr(EARTH_RADIUS) + "D"
    forward = map_vertices(
        g, "tf_v", vertex(f"radians(tf_v.x) * {r}", f"ln(tan(pi() / 4 + radians(tf_v.y) / 2)) * {r}", "tf_v.z"))
    back = map_vertices(
        g, "tb_v", vertex(f"degrees(tb_v.x / {r})", f"degrees(2 * atan(exp(tb_v.y / {r})) - pi() / 2)", "tb_v.z"))
    fail = f"raise_error(concat('no transformation from ', CAST({g}.srid AS STRING), ' to ', CAST({srid} AS STRING)))"
    moved = (
        f"CASE WHEN {g} IS NULL OR {g}.srid = {srid} THEN {g} "
        f"WHEN {g}.srid = 4326 AND {srid} = 3857 THEN {forward} "
        f"WHEN {g}.srid = 3857 AND {srid} = 4326 THEN {back} "
        f"ELSE CAST({fail} AS {GEOM}) END"
    )
    return set_srid(moved, srid) if "(" not in g else let(moved, "tc_g", set_srid("tc_g", srid))


def first_ring(g: str) -> str:
    return f"{g}.parts[0].rings[0]"


def with_line(g: str, ring: str) -> str:
    """Replace the vertices of a line, keeping its srid."""
    return f"IF({g}.gtype = 2, {line(ring, f'{g}.srid')}, {NO_GEOM})"


def add_point(g: str, p: str, index: str = "-1") -> str:
    """Insert a vertex before the zero-based position ``index``; -1 appends."""
    r, v = first_ring(g), f"{first_ring(p)}[0]"
    inner = (
        f"CASE WHEN {index} < 0 THEN concat({r}, array({v})) "
        f"ELSE concat(slice({r}, 1, {index}), array({v}), slice({r}, {index} + 1, greatest(size({r}) - {index}, 0))) END"
    )
    return f"IF({index} > size({r}), {NO_GEOM}, {with_line(g, inner)})"


def set_point(g: str, index: str, p: str) -> str:
    ring = f"transform({first_ring(g)}, (sp_v, sp_i) -> IF(sp_i = {index}, {first_ring(p)}[0], sp_v))"
    return f"IF({index} < 0 OR {index} >= size({first_ring(g)}), {NO_GEOM}, {with_line(g, ring)})"


def remove_point(g: str, index: str) -> str:
    ring = f"filter({first_ring(g)}, (rp_v, rp_i) -> rp_i <> {index})"
    bad = f"{index} < 0 OR {index} >= size({first_ring(g)}) OR size({first_ring(g)}) < 3"
    return f"IF({bad}, {NO_GEOM}, {with_line(g, ring)})"


def reverse_line(g: str) -> str:
    return with_line(g, f"reverse({first_ring(g)})")


def make_polygon(g: str, holes: str = NO_GEOM) -> str:
    """Polygon from a closed line and, optionally, the closed lines of its holes."""
    hole_rings = f"transform(coalesce({holes}.parts, array()), mp_h -> mp_h.rings[0])"
    all_rings = f"concat(array({first_ring(g)}), {hole_rings})"
    ok = f"{g}.gtype = 2 AND size({first_ring(g)}) >= 4 AND forall({all_rings}, mp_r -> {closed_ring('mp_r')})"
    return f"IF({ok}, {polygon(all_rings, f'{g}.srid')}, {NO_GEOM})"


def force_lhr(g: str) -> str:
    """Outer rings clockwise, holes counter-clockwise (interior on the right hand of the outline's direction)."""
    ring = f"IF(({ring_area('lh_r')} > 0) = (lh_i = 0), reverse(lh_r), lh_r)"
    parts = (
        f"transform({g}.parts, lh_p -> "
        + part("lh_p.kind", f"IF(lh_p.kind = 3, transform(lh_p.rings, (lh_r, lh_i) -> {ring}), lh_p.rings)")
        + ")"
    )
    return geom(f"{g}.gtype", f"{g}.srid", parts)


# ---------------------------------------------------------------- parts and types

def only_kind(g: str, kind: int) -> str:
    """Multi geometry of the parts of one kind; NULL when there are none."""
    kept = f"filter({g}.parts, ok_p -> ok_p.kind = {kind})"
    return f"IF(size({kept}) > 0, {geom(kind + 3, f'{g}.srid', kept)}, {NO_GEOM})"


def cast_type(g: str, gtype: int) -> str:
    """Cast to a type code; NULL when the parts do not fit."""
    kind = gtype if gtype <= 3 else gtype - 3
    fits = f"forall({g}.parts, ct_p -> ct_p.kind = {kind}) AND size({g}.parts) " + ("= 1" if gtype <= 3 else ">= 1")
    return f"IF({fits}, {geom(gtype, f'{g}.srid', f'{g}.parts')}, {NO_GEOM})"


def uniform_kind(g: str) -> str:
    """The kind shared by all parts, or 0."""
    lo = f"array_min(transform({g}.parts, uk_p -> uk_p.kind))"
    hi = f"array_max(transform({g}.parts, uk_q -> uk_q.kind))"
    return f"IF({lo} = {hi}, {lo}, 0)"


def cast_multi(g: str) -> str:
    kind = uniform_kind(g)
    return f"IF(size({g}.parts) > 0, {geom(f'IF({kind} = 0, 0, {kind} + 3)', f'{g}.srid', f'{g}.parts')}, {NO_GEOM})"


def cast_single(g: str) -> str:
    return f"IF(size({g}.parts) = 1, {geom(f'{g}.parts[0].kind', f'{g}.srid', f'{g}.parts')}, {NO_GEOM})"


def part_n(g: str, n: str) -> str:
    """n-th part, counted from 1."""
    return f"IF({n} BETWEEN 1 AND size({g}.parts), {geom(f'{g}.parts[{n} - 1].kind', f'{g}.srid', f'slice({g}.parts, greatest({n}, 1), 1)')}, {NO_GEOM})"


def exterior_ring(g: str) -> str:
    return f"IF({g}.gtype = 3, {line(first_ring(g), f'{g}.srid')}, {NO_GEOM})"


def interior_ring(g: str, n: str) -> str:
    """n-th hole, counted from 1."""
    inside = f"{g}.gtype = 3 AND {n} >= 1 AND {n} < size({g}.parts[0].rings)"
    return f"IF({inside}, {line(f'{g}.parts[0].rings[{n}]', f'{g}.srid')}, {NO_GEOM})"


def boundary(g: str) -> str:
    """Rings of a polygon as lines, end points of open lines, NULL for points."""
    ring_parts = f"transform({rings(g)}, by_r -> {part(2, 'array(by_r)')})"
    end_parts = f"transform({ends(g)}, by_v -> {part(1, 'array(array(by_v))')})"
    as_lines = geom(f"IF(size({ring_parts}) = 1, 2, 5)", f"{g}.srid", ring_parts)
    as_points = geom(f"IF(size({end_parts}) = 1, 1, 4)", f"{g}.srid", end_parts)
    return (
        f"CASE WHEN {dimension(g)} = 2 THEN {as_lines} "
        f"WHEN {dimension(g)} = 1 AND size({end_parts}) > 0 THEN {as_points} ELSE {NO_GEOM} END"
    )


def nth_vertex(g: str, n: str) -> str:
    """Vertex n (from 1; negative counts from the end) of a line as a point; NULL outside."""
    v = f"try_element_at({first_ring(g)}, {n})"
    ok = f"{g}.gtype = 2 AND {n} <> 0 AND abs({n}) <= size({first_ring(g)})"
    return f"IF({ok}, {geom(1, f'{g}.srid', f'array({part(1, f'array(array({v}))')})')}, {NO_GEOM})"


def envelope(g: str) -> str:
    return let(bounds(g), "ev_b", f"IF(ev_b.xmin IS NULL, {NO_GEOM}, {box('ev_b.xmin', 'ev_b.ymin', 'ev_b.xmax', 'ev_b.ymax', f'{g}.srid')})")


# ---------------------------------------------------------------- text

def number_text(x: str) -> str:
    return f"IF({x} = floor({x}) AND abs({x}) < 1e15, CAST(CAST({x} AS BIGINT) AS STRING), CAST({x} AS STRING))"


def to_wkt(g: str) -> str:
    """Geometry as well-known text."""
    xy = f"concat({number_text('wk_v.x')}, ' ', {number_text('wk_v.y')}, IF(wk_v.z IS NULL, '', concat(' ', {number_text('wk_v.z')})))"
    ring = f"concat('(', array_join(transform(wk_r, wk_v -> {xy}), ','), ')')"
    rings_text = f"array_join(transform(wk_p.rings, wk_r -> {ring}), ',')"
    body = f"IF(wk_p.kind = 3, concat('(', {rings_text}, ')'), {rings_text})"
    bodies = f"transform({g}.parts, wk_p -> {body})"
    names = "element_at(array('POINT', 'LINESTRING', 'POLYGON'), wk_p.kind)"
    tagged = f"transform({g}.parts, wk_p -> concat({names}, {body}))"
    return (
        f"CASE WHEN {g} IS NULL THEN CAST(NULL AS STRING) "
        f"WHEN size({g}.parts) = 0 THEN concat({type_name(g)}, ' EMPTY') "
        f"WHEN {g}.gtype BETWEEN 1 AND 3 THEN concat({type_name(g)}, element_at({bodies}, 1)) "
        f"WHEN {g}.gtype = 0 THEN concat('GEOMETRYCOLLECTION(', array_join({tagged}, ','), ')') "
        f"ELSE concat({type_name(g)}, '(', array_join({bodies}, ','), ')') END"
    )


def wkt_tag(t: str) -> str:
    """Lower-case type word of a WKT string, '' when there is none."""
    return f"lower(regexp_extract({t}, '(?i)^\\\\s*((?:multi)?(?:point|linestring|polygon))\\\\s*z?\\\\s*\\\\(', 1))"


def from_wkt(t: str, srid: str | int = 0, want: str | None = None) -> str:
    """Parse WKT; NULL when malformed or, with ``want``, of another type.

    The bracket skeleton is checked first, coordinates are then split out level by
    level, so no regular expression has to span a whole long text.
    """
    tag = wkt_tag(t)
    body = f"trim(regexp_extract({t}, '(?s)^[^(]*(\\\\(.*\\\\))\\\\s*$', 1))"
    skeleton = (
        "regexp_replace(regexp_replace(regexp_replace(fw_b, '[^()]', ''), '\\\\(\\\\)', 'r'), '\\\\(r+\\\\)', 'p')"
    )
    shape_ok = (
        "CASE fw_t WHEN 'point' THEN fw_k = 'r' WHEN 'linestring' THEN fw_k = 'r' WHEN 'polygon' THEN fw_k = 'p' "
        "WHEN 'multipoint' THEN fw_k IN ('p', 'r') WHEN 'multilinestring' THEN fw_k = 'p' "
        "WHEN 'multipolygon' THEN fw_k RLIKE '^\\\\(p+\\\\)$' ELSE false END"
    )
    # parts as text, each with its rings still separated by '),('
    rings_of = "split(regexp_replace(fw_c, '^[\\\\s(]+|[\\\\s)]+$', ''), '\\\\)\\\\s*,\\\\s*\\\\(')"
    part_texts = (
        "CASE WHEN fw_t = 'multipolygon' THEN split(fw_b, '\\\\)\\\\s*\\\\)\\\\s*,\\\\s*\\\\(\\\\s*\\\\(') "
        "WHEN fw_t = 'multilinestring' OR (fw_t = 'multipoint' AND fw_k = 'p') THEN split(fw_b, '\\\\)\\\\s*,\\\\s*\\\\(') "
        "WHEN fw_t = 'multipoint' THEN split(fw_b, ',') ELSE array(fw_b) END"
    )
    kind = "CASE WHEN fw_t LIKE '%point' THEN 1 WHEN fw_t LIKE '%linestring' THEN 2 ELSE 3 END"
    nums = "transform(split(trim(fw_x), '\\\\s+'), fw_n -> try_cast(fw_n AS DOUBLE))"
    coord = let(
        nums, "fw_m",
        "IF(size(fw_m) BETWEEN 2 AND 3 AND NOT exists(fw_m, fw_q -> fw_q IS NULL), "
        "named_struct('x', fw_m[0], 'y', fw_m[1], 'z', get(fw_m, 2)), CAST(NULL AS " + PT + "))",
    )
    ring = f"transform(split(fw_r, ','), fw_x -> {coord})"
    parts = f"transform({part_texts}, fw_c -> {part(kind, f'transform({rings_of}, fw_r -> {ring})')})"
    ring_ok = (
        "forall(fw_g.parts, fw_p -> forall(fw_p.rings, fw_r2 -> NOT exists(fw_r2, fw_v -> fw_v IS NULL) AND "
        "CASE fw_p.kind WHEN 1 THEN size(fw_r2) = 1 WHEN 2 THEN size(fw_r2) >= 2 "
        f"ELSE size(fw_r2) >= 4 AND {closed_ring('fw_r2')} END))"
    )
    code = " ".join(f"WHEN '{n}' THEN {c}" for n, c in TYPE_CODES.items())
    built = let(geom(f"CASE fw_t {code} END", srid, parts), "fw_g", f"IF({ring_ok}, fw_g, {NO_GEOM})")
    typed = "true" if want is None else f"fw_t = '{want}'"
    checked = let(skeleton, "fw_k", f"IF({typed} AND {shape_ok}, {built}, {NO_GEOM})")
    return let(tag, "fw_t", let(body, "fw_b", f"IF({t} IS NULL, {NO_GEOM}, {checked})"))


# ---------------------------------------------------------------- box predicates

def mbr_meets(a: str, b: str, sep: str = ".") -> str:
    a, b = a + sep, b + sep
    return f"({a}xmin <= {b}xmax AND {a}xmax >= {b}xmin AND {a}ymin <= {b}ymax AND {a}ymax >= {b}ymin)"


def mbr_inner_meets(a: str, b: str, sep: str = ".") -> str:
    a, b = a + sep, b + sep
    return f"({a}xmin < {b}xmax AND {a}xmax > {b}xmin AND {a}ymin < {b}ymax AND {a}ymax > {b}ymin)"


def mbr_inside(a: str, b: str, sep: str = ".") -> str:
    a, b = a + sep, b + sep
    return f"({a}xmin >= {b}xmin AND {a}xmax <= {b}xmax AND {a}ymin >= {b}ymin AND {a}ymax <= {b}ymax)"


def mbr_same(a: str, b: str, sep: str = ".") -> str:
    a, b = a + sep, b + sep
    return f"({a}xmin = {b}xmin AND {a}xmax = {b}xmax AND {a}ymin = {b}ymin AND {a}ymax = {b}ymax)"


def mbr_touching(a: str, b: str, sep: str = ".") -> str:
    return f"({mbr_meets(a, b, sep)} AND NOT {mbr_inner_meets(a, b, sep)})"


def mbr_overlapping(a: str, b: str, sep: str = ".") -> str:
    return (
        f"({mbr_inner_meets(a, b, sep)} AND NOT {mbr_inside(a, b, sep)} AND NOT {mbr_inside(b, a, sep)})"
    )


# ---------------------------------------------------------------- edge predicates

TOLERANCE = "1e-9D"


def orient(ax: str, ay: str, bx: str, by: str, px: str, py: str) -> str:
    """Twice the signed area of (a, b, p): positive when p lies left of a -> b."""
    return f"(({bx} - {ax}) * ({py} - {ay}) - ({by} - {ay}) * ({px} - {ax}))"


def edges_touch(e: str, f: str) -> str:
    """Closed segments share a point; works for zero-length edges too."""
    near = (
        f"greatest({e}.x1, {e}.x2) >= least({f}.x1, {f}.x2) AND least({e}.x1, {e}.x2) <= greatest({f}.x1, {f}.x2) AND "
        f"greatest({e}.y1, {e}.y2) >= least({f}.y1, {f}.y2) AND least({e}.y1, {e}.y2) <= greatest({f}.y1, {f}.y2)"
    )
    fe = [orient(f"{f}.x1", f"{f}.y1", f"{f}.x2", f"{f}.y2", f"{e}.x{i}", f"{e}.y{i}") for i in (1, 2)]
    ef = [orient(f"{e}.x1", f"{e}.y1", f"{e}.x2", f"{e}.y2", f"{f}.x{i}", f"{f}.y{i}") for i in (1, 2)]
    return f"({near} AND sign({fe[0]}) * sign({fe[1]}) <= 0 AND sign({ef[0]}) * sign({ef[1]}) <= 0)"


def any_edges_touch(es: str, fs: str) -> str:
    return f"exists({es}, et_e -> exists({fs}, et_f -> {edges_touch('et_e', 'et_f')}))"


def on_edge(px: str, py: str, e: str) -> str:
    """Point on a closed segment, within a small relative tolerance; the box is tested first."""
    off = orient(f"{e}.x1", f"{e}.y1", f"{e}.x2", f"{e}.y2", px, py)
    span = f"(1 + abs({e}.x2 - {e}.x1) + abs({e}.y2 - {e}.y1))"
    return (
        f"({py} >= least({e}.y1, {e}.y2) - {TOLERANCE} AND {py} <= greatest({e}.y1, {e}.y2) + {TOLERANCE} AND "
        f"{px} >= least({e}.x1, {e}.x2) - {TOLERANCE} AND {px} <= greatest({e}.x1, {e}.x2) + {TOLERANCE} AND "
        f"abs({off}) <= {TOLERANCE} * {span})"
    )


def locate(px: str, py: str, es: str) -> str:
    """Place of a point against polygon edges: 0 outside, 1 inside, 2 on the outline."""
    turn = orient("lo_e.x1", "lo_e.y1", "lo_e.x2", "lo_e.y2", px, py)
    crossed = f"(lo_e.y1 > {py}) <> (lo_e.y2 > {py}) AND ({turn} > 0) = (lo_e.y2 > lo_e.y1)"
    return (
        f"aggregate({es}, 0, (lo_s, lo_e) -> CASE WHEN lo_s = 2 OR {on_edge(px, py, 'lo_e')} THEN 2 "
        f"WHEN {crossed} THEN 1 - lo_s ELSE lo_s END)"
    )


def simple_ring(r: str) -> str:
    """No two edges of a vertex array meet, apart from neighbours at their common vertex."""
    n = "size(sr_s)"
    apart = f"sr_j > sr_i + 1 AND NOT ({closed_ring(r)} AND sr_i = 0 AND sr_j = {n} - 1)"
    back = (
        f"sr_j = sr_i + 1 AND {orient('sr_e.x1', 'sr_e.y1', 'sr_e.x2', 'sr_e.y2', 'sr_f.x2', 'sr_f.y2')} = 0 AND "
        "(sr_e.x2 - sr_e.x1) * (sr_f.x2 - sr_f.x1) + (sr_e.y2 - sr_e.y1) * (sr_f.y2 - sr_f.y1) < 0"
    )
    hit = f"({apart} AND {edges_touch('sr_e', 'sr_f')}) OR ({back})"
    inner = f"exists(transform(sr_s, (sr_f, sr_j) -> {hit}), sr_h -> sr_h)"
    return let(ring_edges(r), "sr_s", f"NOT exists(transform(sr_s, (sr_e, sr_i) -> {inner}), sr_k -> sr_k)")


def is_simple(g: str) -> str:
    return f"forall({rings(g)}, is_r -> {simple_ring('is_r')})"


def _rings_cross(es: str, fs: str) -> str:
    """Two edges of two edge sets cross at a point inside both."""
    e, f = "rc_e", "rc_f"
    near = (
        f"greatest({e}.x1, {e}.x2) >= least({f}.x1, {f}.x2) AND least({e}.x1, {e}.x2) <= greatest({f}.x1, {f}.x2) AND "
        f"greatest({e}.y1, {e}.y2) >= least({f}.y1, {f}.y2) AND least({e}.y1, {e}.y2) <= greatest({f}.y1, {f}.y2)"
    )
    fe = [orient(f"{f}.x1", f"{f}.y1", f"{f}.x2", f"{f}.y2", f"{e}.x{i}", f"{e}.y{i}") for i in (1, 2)]
    ef = [orient(f"{e}.x1", f"{e}.y1", f"{e}.x2", f"{e}.y2", f"{f}.x{i}", f"{f}.y{i}") for i in (1, 2)]
    return f"exists({es}, {e} -> exists({fs}, {f} -> {near} AND sign({fe[0]}) * sign({fe[1]}) < 0 AND sign({ef[0]}) * sign({ef[1]}) < 0))"


def hole_faults(p: str) -> str:
    """struct<outside, overlapping>: holes of a polygon part that lie outside their shell or across it, and that overlap an earlier hole.

    Rings may meet at points.
    """
    def spots(es: str, test) -> str:
        """Starts and middles of edges."""
        return f"exists({es}, hf_e -> {test('hf_e.x1', 'hf_e.y1')} OR {test('((hf_e.x1 + hf_e.x2) / 2)', '((hf_e.y1 + hf_e.y2) / 2)')})"

    out = f"({_rings_cross('hf_h', 'hf_r[0]')} OR {spots('hf_h', lambda px, py: locate(px, py, 'hf_r[0]') + ' = 0')})"
    within = f"({spots('hf_h', lambda px, py: locate(px, py, 'hf_k') + ' = 1')} OR {spots('hf_k', lambda px, py: locate(px, py, 'hf_h') + ' = 1')})"
    earlier = f"hf_j > 0 AND hf_j < hf_i AND ({_rings_cross('hf_h', 'hf_k')} OR {within} OR array_sort(hf_h) = array_sort(hf_k))"
    over = f"exists(transform(hf_r, (hf_k, hf_j) -> {earlier}), hf_x -> hf_x)"

    def count(test: str) -> str:
        return f"size(filter(transform(hf_r, (hf_h, hf_i) -> hf_i > 0 AND {test}), hf_y -> hf_y))"

    inner = ring_edges("hf_q")
    found = let(f"transform({p}.rings, hf_q -> {inner})", "hf_r", f"named_struct('outside', {count(out)}, 'overlapping', {count(over)})")
    return f"IF(size({p}.rings) < 2, named_struct('outside', 0, 'overlapping', 0), {found})"


def holes_fit(p: str) -> str:
    """The holes of a polygon part lie in its shell and beside each other."""
    return let(hole_faults(p), "hv_f", "hv_f.outside = 0 AND hv_f.overlapping = 0")


def is_valid(g: str) -> str:
    """Rings of polygons are closed, have four vertices or more, an area, do not cross themselves or each other, and holes lie in their shell."""
    area_ok = f"{closed_ring('iv_r')} AND size(iv_r) >= 4 AND {ring_area('iv_r')} <> 0 AND {simple_ring('iv_r')}"
    return (
        f"(size({g}.parts) > 0 AND forall({g}.parts, iv_p -> CASE iv_p.kind WHEN 3 THEN forall(iv_p.rings, iv_r -> {area_ok}) AND {holes_fit('iv_p')} "
        "WHEN 2 THEN size(iv_p.rings[0]) >= 2 ELSE true END))"
    )


def snap_to(g: str, ref: str, tolerance: str) -> str:
    """Geometry with each vertex moved to the nearest vertex of another one within a tolerance (ties: smallest x, y)."""
    none = "CAST(NULL AS STRUCT<d2: DOUBLE, x: DOUBLE, y: DOUBLE>)"
    one = "named_struct('d2', (st_w.x - st_v.x) * (st_w.x - st_v.x) + (st_w.y - st_v.y) * (st_w.y - st_v.y), 'x', st_w.x, 'y', st_w.y)"
    nearest = f"aggregate(st_t, {none}, (st_b, st_w) -> {let(one, 'st_o', 'IF(st_b IS NULL OR st_o < st_b, st_o, st_b)')})"
    moved = let(nearest, "st_n", f"IF(st_n IS NOT NULL AND st_n.d2 <= {tolerance} * {tolerance}, {vertex('st_n.x', 'st_n.y', 'st_v.z')}, st_v)")
    return let(vertices(ref), "st_t", f"IF({g} IS NULL OR {ref} IS NULL, {NO_GEOM}, {map_vertices(g, 'st_v', moved)})")


def nearest_on_edge(px: str, py: str, e: str) -> str:
    """struct<d2, x, y>: squared distance to, and place of, the nearest point of a segment."""
    dx, dy = f"({e}.x2 - {e}.x1)", f"({e}.y2 - {e}.y1)"
    len2 = f"({dx} * {dx} + {dy} * {dy})"
    t = f"IF({len2} = 0, 0D, least(1D, greatest(0D, (({px} - {e}.x1) * {dx} + ({py} - {e}.y1) * {dy}) / {len2})))"
    place = let(t, "ne_t", f"named_struct('x', {e}.x1 + ne_t * {dx}, 'y', {e}.y1 + ne_t * {dy})")
    return let(
        place, "ne_q",
        f"named_struct('d2', (ne_q.x - {px}) * (ne_q.x - {px}) + (ne_q.y - {py}) * (ne_q.y - {py}), 'x', ne_q.x, 'y', ne_q.y)",
    )


def closest(es: str, fs: str) -> str:
    """struct<d2, ax, ay, bx, by>: closest places of two edge sets whose edges do not cross.

    The minimum is reached at an end of one edge, so ends of ``es`` are measured against
    ``fs`` and the other way round.  Of equal distances the least places are taken, so the
    order of the edges doesn't matter.
    """
    none = "named_struct('d2', CAST('Infinity' AS DOUBLE), 'ax', 0D, 'ay', 0D, 'bx', 0D, 'by', 0D)"

    def side(outer: str, inner: str, tag: str, swap: bool) -> str:
        near = nearest_on_edge(f"{tag}_u.x", f"{tag}_u.y", f"{tag}_f")
        mine, other = (f"{tag}_u", f"{tag}_n")
        if swap:
            pick = f"named_struct('d2', {tag}_n.d2, 'ax', {other}.x, 'ay', {other}.y, 'bx', {mine}.x, 'by', {mine}.y)"
        else:
            pick = f"named_struct('d2', {tag}_n.d2, 'ax', {mine}.x, 'ay', {mine}.y, 'bx', {other}.x, 'by', {other}.y)"
        ends_of = (
            f"flatten(transform({outer}, {tag}_e -> array(named_struct('x', {tag}_e.x1, 'y', {tag}_e.y1), "
            f"named_struct('x', {tag}_e.x2, 'y', {tag}_e.y2))))"
        )
        # places are only looked at where distances are equal
        nearer = f"CASE WHEN {tag}_n.d2 < {tag}_b.d2 THEN {pick} WHEN {tag}_n.d2 = {tag}_b.d2 THEN least({pick}, {tag}_b) ELSE {tag}_b END"
        best = f"aggregate({inner}, {tag}_s, ({tag}_b, {tag}_f) -> {let(near, f'{tag}_n', nearer)})"
        return f"aggregate(array_distinct({ends_of}), %s, ({tag}_s, {tag}_u) -> {best})"

    return side(fs, es, "cb", True) % (side(es, fs, "ca", False) % none)


# ---------------------------------------------------------------- lines held in one row

def running(values: str) -> str:
    """Sums of an array of doubles from its start to each place, by doubling: about log2(n) rounds over the array."""
    more = "transform(ru_p, (ru_v, ru_i) -> ru_v + IF(ru_i >= shiftleft(1, ru_k), ru_p[ru_i - shiftleft(1, ru_k)], 0D))"
    return let(values, "ru_a", f"IF(size(ru_a) < 2, ru_a, aggregate(sequence(0, CAST(ceil(log2(size(ru_a))) AS INT) - 1), ru_a, (ru_p, ru_k) -> {more}))")


def _measured(g: str) -> str:
    """Edges of a line with the distance before each one."""
    step = "sqrt((ms_e.x2 - ms_e.x1) * (ms_e.x2 - ms_e.x1) + (ms_e.y2 - ms_e.y1) * (ms_e.y2 - ms_e.y1))"
    edge = (
        "named_struct('d0', IF(ms_i = 0, 0D, ms_d[ms_i - 1]), 'd1', ms_d[ms_i], 'len', ms_d[ms_i] - IF(ms_i = 0, 0D, ms_d[ms_i - 1]), "
        "'x1', ms_f.x1, 'y1', ms_f.y1, 'x2', ms_f.x2, 'y2', ms_f.y2)"
    )
    return let(ring_edges(first_ring(g)), "ms_es", let(running(f"transform(ms_es, ms_e -> {step})"), "ms_d", f"transform(ms_es, (ms_f, ms_i) -> {edge})"))


def _on(e: str, d: str) -> str:
    """Vertex at distance ``d`` on a measured edge."""
    t = f"least(1D, IF({e}.len = 0, 0D, ({d} - {e}.d0) / {e}.len))"
    return vertex(f"{e}.x1 + {t} * ({e}.x2 - {e}.x1)", f"{e}.y1 + {t} * ({e}.y2 - {e}.y1)")


def _at(m: str, d: str) -> str:
    """Vertex at distance ``d`` along measured edges ``m``: on the first edge that reaches it, or the last one."""
    hit = f"coalesce(get(filter({m}, at_e -> at_e.d1 >= {d} AND (at_e.d0 < {d} OR at_e.d0 = 0)), 0), element_at({m}, -1))"
    return let(hit, "at_h", _on("at_h", d))


def interpolate_point(g: str, fraction: str) -> str:
    """Point at a fraction (0..1) of a line's length."""
    place = let(_measured(g), "ip_m", _at("ip_m", f"({fraction} * {length(g)})"))
    built = geom(1, f"{g}.srid", f"array({part(1, f'array(array({place}))')})")
    return f"IF({g}.gtype = 2 AND {fraction} BETWEEN 0 AND 1, {built}, {NO_GEOM})"


def equidistant_points(g: str, step: str) -> str:
    """Multipoint of the places every ``step`` along a line, from its start; each edge gives its own, so the work is that of edges and places."""
    # an edge has the places beyond its start up to its end; the first one has its start, too
    first, last = f"IF(eq_e.d0 = 0 AND eq_i = 0, 0L, floor(eq_e.d0 / {step}) + 1)", f"floor(eq_e.d1 / {step})"
    place = part(1, f"array(array({_on('eq_e', f'(eq_k * {step})')}))")
    own = f"IF({first} > {last}, CAST(array() AS ARRAY<{PART}>), transform(sequence({first}, greatest({first}, {last})), eq_k -> {place}))"
    places = let(_measured(g), "eq_m", f"flatten(transform(eq_m, (eq_e, eq_i) -> {own}))")
    return f"IF({g}.gtype = 2 AND {step} > 0, {geom(4, f'{g}.srid', places)}, {NO_GEOM})"


def substring(g: str, start: str, end: str) -> str:
    """Part of a line between two fractions of its length."""
    total = length(g)
    d0, d1 = f"({start} * ss_l)", f"({end} * ss_l)"
    inner = f"filter(ss_m, ss_e -> ss_e.d0 > {d0} AND ss_e.d0 < {d1})"
    ring = (
        f"concat(array({_at('ss_m', d0)}), transform({inner}, ss_v -> {vertex('ss_v.x1', 'ss_v.y1')}), "
        f"array({_at('ss_m', d1)}))"
    )
    built = let(total, "ss_l", let(_measured(g), "ss_m", line(ring, f"{g}.srid")))
    ok = f"{g}.gtype = 2 AND {start} >= 0 AND {end} <= 1 AND {start} < {end}"
    return f"IF({ok}, {built}, {NO_GEOM})"


# ---------------------------------------------------------------- hull of one row

def hull_points(pts: str) -> str:
    """Corners (structs x, y) of the convex hull of an array of them, counter-clockwise from the lowest x, without points on its sides.

    Points are taken in order.  A chain that bends one way is seen from a point beyond its end up to one corner, so of the
    chain so far those corners stay that the next point lies left of.
    """
    def chain(points: str, tag: str) -> str:
        turn = orient(f"{tag}_s[{tag}_i - 1].x", f"{tag}_s[{tag}_i - 1].y", f"{tag}_s[{tag}_i].x", f"{tag}_s[{tag}_i].y", f"{tag}_p.x", f"{tag}_p.y")
        kept = f"IF(size({tag}_s) < 2, size({tag}_s), 1 + size(filter(sequence(1, size({tag}_s) - 1), {tag}_i -> {turn} > 0)))"
        return f"aggregate({points}, CAST(array() AS ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>), ({tag}_s, {tag}_p) -> concat(slice({tag}_s, 1, {kept}), array({tag}_p)))"

    ordered = f"array_sort(array_distinct(transform({pts}, hp_v -> named_struct('x', CAST(hp_v.x AS DOUBLE) + 0D, 'y', CAST(hp_v.y AS DOUBLE) + 0D))))"
    ring = f"IF(size(hp_o) < 3, hp_o, concat(slice({chain('hp_o', 'hl')}, 1, size({chain('hp_o', 'hl')}) - 1), slice({chain('reverse(hp_o)', 'hu')}, 1, size({chain('reverse(hp_o)', 'hu')}) - 1)))"
    return let(ordered, "hp_o", ring)


def hull_geometry(corners: str, srid: str | int = 0) -> str:
    """Point, line or polygon of hull corners; NULL for none."""
    pts = f"transform({corners}, hg_v -> {vertex('hg_v.x', 'hg_v.y')})"
    return (
        f"CASE size({corners}) WHEN 0 THEN {NO_GEOM} WHEN 1 THEN {geom(1, srid, f'array({part(1, f'array({pts})')})')} "
        f"WHEN 2 THEN {line(pts, srid)} ELSE {polygon(f'array(concat({pts}, slice({pts}, 1, 1)))', srid)} END"
    )


def convex_hull(g: str) -> str:
    """Convex hull of one geometry: a polygon, or a line or point where all vertices lie on one."""
    return let(hull_points(vertices(g)), "ch_c", f"IF({g} IS NULL, {NO_GEOM}, {hull_geometry('ch_c', f'{g}.srid')})")


# ---------------------------------------------------------------- clipping and surfaces

def clip_ring(ring: str, window: str) -> str:
    """Closed ring cut to a convex window (edges counter-clockwise); empty array when nothing is left.

    Window edge by window edge, the vertices on its left are kept and crossings added.
    """
    side_p = orient("cl_w.x1", "cl_w.y1", "cl_w.x2", "cl_w.y2", "cl_p.x", "cl_p.y")
    side_q = orient("cl_w.x1", "cl_w.y1", "cl_w.x2", "cl_w.y2", "cl_q.x", "cl_q.y")
    cross = vertex("cl_q.x + (cl_p.x - cl_q.x) * (cl_b / (cl_b - cl_a))", "cl_q.y + (cl_p.y - cl_q.y) * (cl_b / (cl_b - cl_a))")
    keep = (
        f"CASE WHEN cl_a >= 0 AND cl_b < 0 AND cl_a > 0 THEN array({cross}, {vertex('cl_p.x', 'cl_p.y')}) "
        f"WHEN cl_a >= 0 THEN array({vertex('cl_p.x', 'cl_p.y')}) "
        f"WHEN cl_b > 0 THEN array({cross}) ELSE filter(array({vertex('cl_p.x', 'cl_p.y')}), cl_z -> false) END"
    )
    before = "element_at(cl_s, IF(cl_i = 0, size(cl_s), cl_i))"
    one = let(before, "cl_q", let(side_p, "cl_a", let(side_q, "cl_b", keep)))
    open_ring = f"transform(slice({ring}, 1, greatest(size({ring}) - 1, 0)), cl_o -> {vertex('cl_o.x', 'cl_o.y')})"
    cut = f"aggregate({window}, {open_ring}, (cl_s, cl_w) -> flatten(transform(cl_s, (cl_p, cl_i) -> {one})))"
    return let(cut, "cl_r", "IF(size(cl_r) < 3, filter(cl_r, cl_y -> false), concat(cl_r, slice(cl_r, 1, 1)))")


def _half_plane(rings_: str, w: str) -> str:
    """Closed rings with the surface on their left, cut to the left of an edge: as many closed rings, again with the surface on their left.

    What lies left of the edge's line comes in chains from line to line.  Along the line the surface begins where a chain
    comes down and ends where one goes up, so a chain is followed by the one that goes up at the next place along the line, and
    the chains close to rings: a shape that falls apart becomes several, without bridges.  A vertex on the line counts as outside.
    """
    side = orient(f"{w}.x1", f"{w}.y1", f"{w}.x2", f"{w}.y2", "hp_v.x", "hp_v.y")
    sided = f"transform({rings_}, hp_r -> transform(slice(hp_r, 1, greatest(size(hp_r) - 1, 0)), hp_v -> named_struct('x', hp_v.x, 'y', hp_v.y, 's', {side})))"

    def spot(k: int, px: str, py: str) -> str:
        tau = f"(({px} - {w}.x1) * ({w}.x2 - {w}.x1) + ({py} - {w}.y1) * ({w}.y2 - {w}.y1))"
        return f"named_struct('k', {k}, 'x', {px}, 'y', {py}, 'tau', {tau})"

    def crossing(k: int, p: str, q: str) -> str:
        """Where the edge from ``p``, on the left, to ``q`` meets the line."""
        t = f"({p}.s / ({p}.s - {q}.s))"
        return f"IF({q}.s = 0, {spot(k, f'{q}.x', f'{q}.y')}, {spot(k, f'({p}.x + {t} * ({q}.x - {p}.x))', f'({p}.y + {t} * ({q}.y - {p}.y))')})"

    none = "CAST(array() AS ARRAY<STRUCT<k: INT, x: DOUBLE, y: DOUBLE, tau: DOUBLE>>)"
    step = f"CASE WHEN hp_a.s > 0 AND hp_b.s > 0 THEN array({spot(1, 'hp_a.x', 'hp_a.y')}) WHEN hp_a.s > 0 THEN array({spot(1, 'hp_a.x', 'hp_a.y')}, {crossing(2, 'hp_a', 'hp_b')}) WHEN hp_b.s > 0 THEN array({crossing(0, 'hp_b', 'hp_a')}) ELSE {none} END"
    # from an outside vertex on, so that chains aren't cut by the ring's own start
    first = "(array_position(transform(hp_q, hp_u -> hp_u.s <= 0), true) - 1)"
    walk = let(first, "hp_f", "flatten(transform(sequence(0, size(hp_q) - 1), hp_i -> " + let("hp_q[CAST((hp_f + hp_i) % size(hp_q) AS INT)]", "hp_a", let("hp_q[CAST((hp_f + hp_i + 1) % size(hp_q) AS INT)]", "hp_b", step)) + "))")
    cut = f"flatten(transform(filter(hp_s, hp_q -> exists(hp_q, hp_u -> hp_u.s > 0) AND exists(hp_q, hp_u -> hp_u.s <= 0)), hp_q -> {walk}))"
    whole = f"transform(filter(hp_s, hp_q -> size(hp_q) > 0 AND forall(hp_q, hp_u -> hp_u.s > 0)), hp_q -> concat(transform(hp_q, hp_u -> {vertex('hp_u.x', 'hp_u.y')}), transform(slice(hp_q, 1, 1), hp_u -> {vertex('hp_u.x', 'hp_u.y')})))"
    at = "filter(sequence(0, size(hp_t) - 1), hp_i -> hp_t[hp_i].k = {})"
    # at one place a chain that goes up stands before one that comes down
    ends = "array_sort(concat(transform(hp_up, (hp_p, hp_c) -> named_struct('tau', hp_t[hp_p].tau, 'k', 0, 'c', hp_c)), transform(hp_dn, (hp_p, hp_c) -> named_struct('tau', hp_t[hp_p].tau, 'k', 1, 'c', hp_c))))"
    after = "transform(hp_dn, (hp_p, hp_c) -> hp_e[CAST((array_position(transform(hp_e, hp_o -> hp_o.k = 1 AND hp_o.c = hp_c), true) - 1) AS INT) ^ 1].c)"
    lowest = "aggregate(hp_n, named_struct('at', hp_c, 'low', hp_c), (hp_g, hp_z) -> named_struct('at', hp_n[hp_g.at], 'low', least(hp_g.low, hp_n[hp_g.at]))).low"
    chain = "slice(hp_t, hp_up[{c}] + 1, hp_dn[{c}] - hp_up[{c}] + 1)"
    grow = f"IF(hp_n[hp_g.at] = hp_l OR hp_g.done, named_struct('at', hp_g.at, 'done', true, 'pts', hp_g.pts), named_struct('at', hp_n[hp_g.at], 'done', false, 'pts', concat(hp_g.pts, {chain.format(c='hp_n[hp_g.at]')})))"
    ring = f"aggregate(hp_n, named_struct('at', hp_l, 'done', false, 'pts', {chain.format(c='hp_l')}), (hp_g, hp_z) -> {grow}).pts"
    closed = f"transform(filter(transform(hp_n, (hp_z, hp_c) -> IF({lowest} = hp_c, hp_c, -1)), hp_c -> hp_c >= 0), hp_l -> transform(concat({ring}, slice({chain.format(c='hp_l')}, 1, 1)), hp_u -> {vertex('hp_u.x', 'hp_u.y')}))"
    linked = let(at.format(0), "hp_up", let(at.format(2), "hp_dn", let(ends, "hp_e", let(after, "hp_n", closed))))
    return let(sided, "hp_s", f"concat({whole}, {let(cut, 'hp_t', f'IF(size(hp_t) = 0, CAST(array() AS ARRAY<{RING}>), {linked})')})")


def clip_polygon(p: str, window: str) -> str:
    """Array of polygon parts: a polygon part cut to a convex window (edges counter-clockwise), one part per piece, with the holes left in it."""
    turned = f"transform({p}.rings, (cp_r, cp_i) -> IF(({ring_area('cp_r')} > 0) = (cp_i = 0), cp_r, reverse(cp_r)))"
    # a vertex on a line is the end of one chain and the start of the next
    once = "filter(cp_q, (cp_m, cp_n) -> cp_n = 0 OR cp_m.x <> cp_q[cp_n - 1].x OR cp_m.y <> cp_q[cp_n - 1].y)"
    kept = f"filter(transform(aggregate({window}, {turned}, (cp_k, cp_w) -> {_half_plane('cp_k', 'cp_w')}), cp_q -> {once}), cp_e -> {ring_area('cp_e')} <> 0)"
    # a vertex of the hole that isn't on the piece's border decides
    inside = f"aggregate(cp_h, 0, (cp_d, cp_v) -> IF(cp_d <> 0, cp_d, CASE {locate('cp_v.x', 'cp_v.y', 'cp_es')} WHEN 1 THEN 1 WHEN 0 THEN -1 ELSE 0 END)) = 1"
    piece = let(ring_edges("cp_s"), "cp_es", part(3, f"concat(array(cp_s), filter(cp_a, cp_h -> {ring_area('cp_h')} < 0 AND {inside}))"))
    return let(kept, "cp_a", f"transform(filter(cp_a, cp_o -> {ring_area('cp_o')} > 0), cp_s -> {piece})")


def clip_edge(e: str, window: str) -> str:
    """struct<t0, t1>: the part of an edge inside a convex window, NULL when none."""
    a = orient("le_w.x1", "le_w.y1", "le_w.x2", "le_w.y2", f"{e}.x1", f"{e}.y1")
    b = orient("le_w.x1", "le_w.y1", "le_w.x2", "le_w.y2", f"{e}.x2", f"{e}.y2")
    gone = "named_struct('t0', 1D, 't1', 0D)"
    step = let(a, "le_a", let(b, "le_b", (
        f"CASE WHEN le_a < 0 AND le_b < 0 THEN {gone} "
        "WHEN le_a < 0 THEN named_struct('t0', greatest(le_s.t0, le_a / (le_a - le_b)), 't1', le_s.t1) "
        "WHEN le_b < 0 THEN named_struct('t0', le_s.t0, 't1', least(le_s.t1, le_a / (le_a - le_b))) ELSE le_s END")))
    cut = f"aggregate({window}, named_struct('t0', 0D, 't1', 1D), (le_s, le_w) -> {step})"
    return let(cut, "le_c", "IF(le_c.t0 < le_c.t1, le_c, CAST(NULL AS STRUCT<t0: DOUBLE, t1: DOUBLE>))")


def _clip_line(ring: str, window: str) -> str:
    """Array of line vertex arrays: the pieces of a line inside a window."""
    def at(t: str) -> str:
        return vertex(f"cw_e.x1 + {t} * (cw_e.x2 - cw_e.x1)", f"cw_e.y1 + {t} * (cw_e.y2 - cw_e.y1)")

    segs = (
        f"filter(transform({ring_edges(ring)}, cw_e -> "
        + let(clip_edge("cw_e", window), "cw_c", f"IF(cw_c IS NULL, CAST(NULL AS {RING}), array({at('cw_c.t0')}, {at('cw_c.t1')}))")
        + "), cw_n -> cw_n IS NOT NULL)"
    )
    joined = (
        "IF(size(cw_s) > 0 AND element_at(element_at(cw_s, -1), -1).x = cw_g[0].x AND element_at(element_at(cw_s, -1), -1).y = cw_g[0].y, "
        "concat(slice(cw_s, 1, size(cw_s) - 1), array(concat(element_at(cw_s, -1), slice(cw_g, 2, 1)))), concat(cw_s, array(cw_g)))"
    )
    return f"aggregate({segs}, CAST(array() AS ARRAY<{RING}>), (cw_s, cw_g) -> {joined})"


def clip_geometry(g: str, window: str) -> str:
    """Geometry cut to a convex window; NULL when nothing is left."""
    poly = clip_polygon("cg_p", window)
    lines = f"transform({_clip_line('cg_p.rings[0]', window)}, cg_l -> {part(2, 'array(cg_l)')})"
    inside = f"forall({window}, cg_w -> {orient('cg_w.x1', 'cg_w.y1', 'cg_w.x2', 'cg_w.y2', 'cg_p.rings[0][0].x', 'cg_p.rings[0][0].y')} >= 0)"
    kept = (
        f"flatten(transform({g}.parts, cg_p -> CASE cg_p.kind WHEN 3 THEN {poly} WHEN 2 THEN {lines} "
        f"ELSE filter(array({part(1, 'cg_p.rings')}), cg_f -> {inside}) END))"
    )
    kind = uniform_kind("ck_g")
    typed = geom(f"CASE WHEN {kind} = 0 THEN 0 WHEN size(ck_g.parts) = 1 THEN {kind} ELSE {kind} + 3 END", "ck_g.srid", "ck_g.parts")
    return let(geom(0, f"{g}.srid", kept), "ck_g", f"IF(size(ck_g.parts) = 0, {NO_GEOM}, {typed})")


def point_on_surface(g: str) -> str:
    """struct<x, y> inside a polygon: the middle of the widest inner span at a height that misses all vertices."""
    es = edges(g)
    box = bounds(g)
    mid = "((ps_b.ymin + ps_b.ymax) / 2)"
    below = f"array_max(filter(transform(ps_e, ps_1 -> ps_1.y1), ps_2 -> ps_2 <= {mid}))"
    above = f"array_min(filter(transform(ps_e, ps_3 -> ps_3.y1), ps_4 -> ps_4 > {mid}))"
    hits = (
        "array_sort(transform(filter(ps_e, ps_f -> (ps_f.y1 > ps_y) <> (ps_f.y2 > ps_y)), "
        "ps_g -> ps_g.x1 + (ps_y - ps_g.y1) * (ps_g.x2 - ps_g.x1) / (ps_g.y2 - ps_g.y1)))"
    )
    spans = (
        "transform(sequence(1, size(ps_h) div 2), ps_i -> named_struct('w', ps_h[2 * ps_i - 1] - ps_h[2 * ps_i - 2], "
        "'x', -(ps_h[2 * ps_i - 1] + ps_h[2 * ps_i - 2]) / 2))"
    )
    best = f"named_struct('x', -array_max({spans}).x, 'y', ps_y)"
    inner = let(f"({below} + {above}) / 2", "ps_y", let(hits, "ps_h", f"IF(size(ps_h) < 2, CAST(NULL AS STRUCT<x: DOUBLE, y: DOUBLE>), {best})"))
    return let(es, "ps_e", let(box, "ps_b", inner))


def clip_to_convex(g: str, window: str) -> str:
    """Geometry cut to a polygon, which must be convex and without holes; raises otherwise."""
    outer = first_ring(window)
    ccw = f"IF({ring_area(outer)} > 0, {outer}, reverse({outer}))"
    convex = (
        "forall(cc_w, cc_e -> forall(cc_r, cc_v -> " + orient("cc_e.x1", "cc_e.y1", "cc_e.x2", "cc_e.y2", "cc_v.x", "cc_v.y") + " >= 0))"
    )
    fail = f"CAST(raise_error('the second geometry must be a convex polygon') AS {GEOM})"
    body = f"IF({window}.gtype = 3 AND size({window}.parts[0].rings) = 1 AND {convex}, {clip_geometry(g, 'cc_w')}, {fail})"
    return let(ccw, "cc_r", let(ring_edges("cc_r"), "cc_w", f"IF({g} IS NULL OR {window} IS NULL, {NO_GEOM}, {body})"))
