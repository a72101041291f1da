"""Relations of features whose outlines are too long for one row.

Outlines are joined in runs of edges.  Where edges of two features meet, each is cut, and the middle of every piece lies inside, outside or
on the border of the other feature: a bit each.  A ring or line that meets nothing of the other feature lies on one side of it as a whole,
so its first vertex stands for it; no other vertex is looked at.  Places whose side an edge doesn't tell are found in the bands of the
other polygon.  All bits of a pair are then merged by ``bit_or``, and a relation is a rule over them.

No row holds more than a run of one feature, or the edges that meet one edge; a big feature costs what its contacts cost, and features
beside it aren't touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.functions import relate as r
from lamina.operators.grid import candidate_pairs
from lamina.operators.tables import BOUNDS, PIECE_EDGES, RUN, with_bounds
from lamina.session import cut_lineage

INSIDE, OUTSIDE, BORDER = r.INSIDE, r.OUTSIDE, r.BORDER
CONTACT_RUN = 64  # edges of a run that is compared with other runs
_AREA_EDGES = "flatten(transform(filter(geom.parts, ae_p -> ae_p.kind = 3), ae_q -> flatten(transform(ae_q.rings, ae_r -> " + x.ring_edges("ae_r") + "))))"


def big(layer: DataFrame, run: int | None = None) -> DataFrame:
    """Features with more vertices than a run has edges."""
    return layer.filter(F.expr(f"{x.n_points('geom')} > {RUN if run is None else run}"))


def small(layer: DataFrame, run: int | None = None) -> DataFrame:
    return layer.filter(F.expr(f"{x.n_points('geom')} <= {RUN if run is None else run}"))


def _turned(es: str) -> str:
    """Bands stand upright: edges that run up and down more than to the sides would reach into many flat ones."""
    def way(c: str) -> str:
        return f"aggregate({es}, 0D, (tu_s, tu_e) -> tu_s + abs(tu_e.{c}2 - tu_e.{c}1))"

    return f"({way('y')} * (xmax - xmin) > {way('x')} * (ymax - ymin))"


def _features(layer: DataFrame) -> DataFrame:
    """(fid, bounds, dim, n_edges, bands, turned) of every feature."""
    bands = f"IF(size({_AREA_EDGES}) <= {PIECE_EDGES}, 1, CAST(ceil(sqrt(size({_AREA_EDGES}))) AS INT))"
    return with_bounds(layer).select("fid", *BOUNDS, F.expr(x.dimension("geom")).alias("dim"), F.expr(f"size({x.edges('geom')})").alias("n_edges"), F.expr(bands).alias("bands"), F.expr(x.let(_AREA_EDGES, "fe_es", _turned("fe_es"))).alias("turned"))


def _runs(layer: DataFrame, run: int) -> DataFrame:
    """Runs of numbered edges with their bounds, the bounds of the feature (f_*), and the line ends that lie in the run's bounds."""
    numbered = f"transform({x.edges('geom')}, (ru_e, ru_i) -> named_struct('x1', ru_e.x1, 'y1', ru_e.y1, 'x2', ru_e.x2, 'y2', ru_e.y2, 'seq', ru_i))"
    whole = with_bounds(layer).select("fid", *(F.col(c).alias(f"f_{c}") for c in BOUNDS), F.expr(x.dimension("geom")).alias("dim"), F.expr(numbered).alias("_es"), F.expr(x.ends("geom")).alias("_ends"))
    cut = whole.select(
        "fid", *(f"f_{c}" for c in BOUNDS), "dim", "_ends",
        F.expr(f"explode(transform(sequence(0, greatest(size(_es) - 1, 0) div {run}), ru_k -> slice(_es, CAST(ru_k * {run} + 1 AS INT), {run})))").alias("es")).filter("size(es) > 0")
    lo, hi = "array_min(transform(es, ru_e -> least(ru_e.{c}1, ru_e.{c}2)))", "array_max(transform(es, ru_e -> greatest(ru_e.{c}1, ru_e.{c}2)))"
    boxed = cut.select("*", *(F.expr(t.format(c=c)).alias(c + side) for c in "xy" for t, side in ((lo, "min"), (hi, "max"))))
    near = f"ru_v.x >= xmin - {x.TOLERANCE} AND ru_v.x <= xmax + {x.TOLERANCE} AND ru_v.y >= ymin - {x.TOLERANCE} AND ru_v.y <= ymax + {x.TOLERANCE}"
    return boxed.withColumn("ends", F.expr(f"filter(_ends, ru_v -> {near})")).drop("_ends")


def _in_box(es: str, side: str) -> str:
    """Edges whose boxes meet the bounds of the other run."""
    return (f"filter({es}, ib_e -> greatest(ib_e.x1, ib_e.x2) >= {side}xmin AND least(ib_e.x1, ib_e.x2) <= {side}xmax AND "
            f"greatest(ib_e.y1, ib_e.y2) >= {side}ymin AND least(ib_e.y1, ib_e.y2) <= {side}ymax)")


def _contacts(a: DataFrame, b: DataFrame, rule: str | None, run: int, options: dict) -> DataFrame:
    """(a_fid, b_fid, a_dim, b_dim, side, seq, e, at_end, inner, near): the edges of either side that meet the other one, by run pair.

    side: 1 edges of ``a``, 2 edges of ``b``; ``inner``: in this run pair two lines share a point that is an end of neither.
    """
    met = candidate_pairs(_runs(a, run), _runs(b, run), **options)
    if rule:
        met = met.filter(rule)
    met = met.withColumn("a_es", F.expr(_in_box("a_es", "b_"))).withColumn("b_es", F.expr(_in_box("b_es", "a_"))).filter("size(a_es) > 0 AND size(b_es) > 0")

    def edges(mine: str, other: str, number: int) -> str:
        at_end = f"exists({other}_ends, co_v -> co_v.x = co_e.x1 AND co_v.y = co_e.y1)"
        return (f"filter(transform({mine}_es, co_e -> named_struct('side', {number}, 'seq', co_e.seq, 'e', co_e, 'at_end', {at_end}, 'near', "
                f"filter({other}_es, co_f -> {x.edges_touch('co_e', 'co_f')}))), co_c -> size(co_c.near) > 0)")

    inner = f"a_dim = 1 AND b_dim = 1 AND {r.inner_contact(r.Side('a_'), r.Side('b_'))}"
    found = met.select("a_fid", "b_fid", "a_dim", "b_dim", F.expr(f"explode(array({inner}))").alias("inner"), F.expr(f"concat({edges('a', 'b', 1)}, {edges('b', 'a', 2)})").alias("c"))
    return found.select("a_fid", "b_fid", "a_dim", "b_dim", "inner", F.explode("c").alias("c")).select("a_fid", "b_fid", "a_dim", "b_dim", "inner", "c.*")


def _pieces(contacts: DataFrame) -> DataFrame:
    """(a_fid, b_fid, side, inner, bits, places): what the pieces of each cut edge tell, and the middles that are still to be placed."""
    whole = contacts.groupBy("a_fid", "b_fid", "a_dim", "b_dim", "side", "seq").agg(
        F.first("e").alias("e"), F.bool_or("at_end").alias("at_end"), F.bool_or("inner").alias("inner"), F.flatten(F.collect_list("near")).alias("near"))
    cross = "(e.x2 - e.x1) * (pi_f.y2 - pi_f.y1) - (e.y2 - e.y1) * (pi_f.x2 - pi_f.x1)"
    span = "(1 + abs(e.x2 - e.x1) + abs(e.y2 - e.y1)) * (1 + abs(pi_f.x2 - pi_f.x1) + abs(pi_f.y2 - pi_f.y1))"
    # only an edge along this one can hold the middle of a piece
    along = f"filter(near, pi_f -> abs({cross}) <= {x.TOLERANCE} * {span})"
    held = f"exists(along, pi_g -> {x.on_edge('pi_m.x', 'pi_m.y', 'pi_g')})"
    marked = whole.withColumn("other", F.expr("IF(side = 1, b_dim, a_dim)")).withColumn("lone", F.expr("IF(side = 1, a_dim, b_dim) = 0")).withColumn("along", F.expr(along)).withColumn(
        "mid", F.expr(f"transform({r._middles('e', 'near')}, pi_m -> named_struct('x', pi_m.x, 'y', pi_m.y, 'on', {held}))"))
    thin = f"IF(pi_k.on, IF(lone AND at_end, {BORDER}, {INSIDE}), {OUTSIDE})"
    bits = f"aggregate(mid, 0, (pi_s, pi_k) -> pi_s | IF(other = 2, IF(pi_k.on, {BORDER}, 0), {thin}))"
    places = "IF(other = 2, filter(mid, pi_k -> NOT pi_k.on), filter(mid, pi_k -> false))"
    return marked.select("a_fid", "b_fid", "side", "inner", F.expr(bits).alias("bits"), F.expr(places).alias("places"))


def _bands(layer: DataFrame) -> DataFrame:
    """(fid, band, es): polygons in bands, flat or upright, a little wider than they need be, so that rounding puts no place into a wrong one.

    Edges of upright bands have x and y exchanged, and so must the places that are held against them.
    """
    whole = with_bounds(layer).select("fid", *BOUNDS, F.expr(_AREA_EDGES).alias("_es")).filter("size(_es) > 0").withColumn("turned", F.expr(_turned("_es")))
    swapped = "transform(_es, ba_e -> named_struct('x1', ba_e.y1, 'y1', ba_e.x1, 'x2', ba_e.y2, 'y2', ba_e.x2))"
    flat = whole.select("fid", F.expr("IF(turned, xmin, ymin)").alias("lo"), F.expr("IF(turned, xmax, ymax)").alias("hi"), F.expr(f"IF(turned, {swapped}, _es)").alias("_es"))
    cut = flat.withColumn("_n", F.expr(f"IF(size(_es) <= {PIECE_EDGES}, 1, CAST(ceil(sqrt(size(_es))) AS INT))")).withColumn("band", F.expr("explode(sequence(0, _n - 1))"))
    slack, height = "(hi - lo) * 1e-9D", "(hi - lo) / _n"
    low, high = f"(lo + band * {height} - {slack})", f"(lo + (band + 1) * {height} + {slack})"
    return cut.select("fid", "band", F.expr(f"IF(_n = 1, _es, filter(_es, ba_e -> greatest(ba_e.y1, ba_e.y2) >= {low} AND least(ba_e.y1, ba_e.y2) <= {high}))").alias("es"))


def _placed(places: DataFrame, pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """(a_fid, b_fid, side, bits) of places (a_fid, b_fid, side, x, y) against the polygon on the other side."""
    out = None
    for side, other, layer in ((1, "b", b), (2, "a", a)):
        facts = pairs.select(F.col("a_fid").alias("_a"), F.col("b_fid").alias("_b"), *(F.col(f"{other}_{c}").alias(c) for c in (*BOUNDS, "bands", "turned")))
        own = places.filter(F.col("side") == side).join(facts, (F.col("a_fid") == F.col("_a")) & (F.col("b_fid") == F.col("_b"))).drop("_a", "_b")
        there = "x >= xmin AND x <= xmax AND y >= ymin AND y <= ymax"
        far = own.filter(f"NOT ({there})").select("a_fid", "b_fid", "side", F.lit(OUTSIDE).alias("bits"))
        up = "IF(turned, (x - xmin) / (xmax - xmin), (y - ymin) / (ymax - ymin))"
        band = f"IF(bands = 1, 0, CAST(least(bands - 1, greatest(0, floor({up} * bands))) AS INT))"
        bands = _bands(layer).select(F.col("fid").alias(f"{other}_fid"), "band", "es")
        near = own.filter(there).select("*", F.expr(band).alias("band"), F.expr("IF(turned, y, x)").alias("u"), F.expr("IF(turned, x, y)").alias("v")).join(bands.hint("merge"), [f"{other}_fid", "band"])
        bit = f"CASE {x.locate('u', 'v', 'es')} WHEN 1 THEN {INSIDE} WHEN 2 THEN {BORDER} ELSE {OUTSIDE} END"
        found = near.select("a_fid", "b_fid", "side", F.expr(bit).alias("bits")).unionByName(far)
        out = found if out is None else out.unionByName(found)
    return out


def pair_bits(a: DataFrame, b: DataFrame, rule: str | None = None, run: int | None = None, **options) -> DataFrame:
    """(a_fid, b_fid, a_dim, b_dim, a_bits, b_bits, met, inner) of the pairs whose boxes meet and satisfy ``rule``.

    ``a_bits``: where the outline of ``a`` lies in ``b`` (INSIDE, OUTSIDE, BORDER), ``b_bits`` the other way round; ``met``: edges meet.
    ``rule`` is an expression over a_f_xmin .. b_f_ymax.
    """
    run = CONTACT_RUN if run is None else run

    def boxed(layer: DataFrame) -> DataFrame:
        return _features(layer).select("*", *(F.col(c).alias(f"f_{c}") for c in BOUNDS))

    pairs = candidate_pairs(boxed(a), boxed(b), **options)
    if rule:
        pairs = pairs.filter(rule)
    pairs = cut_lineage(pairs.select("a_fid", "b_fid", *(f"{s}_{c}" for s in "ab" for c in (*BOUNDS, "dim", "n_edges", "bands", "turned"))))
    pieces = cut_lineage(_pieces(_contacts(a, b, rule, run, options)))

    def first_vertices(layer: DataFrame, side: int, own: str, other: str) -> DataFrame:
        tips = layer.select(F.col("fid").alias(f"{own}_fid"), F.expr(f"explode(transform({x.rings('geom')}, fv_r -> fv_r[0]))").alias("v"))
        return pairs.filter(f"{other}_dim = 2").select("a_fid", "b_fid").join(tips, f"{own}_fid").select("a_fid", "b_fid", F.lit(side).alias("side"), "v.x", "v.y")

    middles = pieces.select("a_fid", "b_fid", "side", F.explode("places").alias("p")).select("a_fid", "b_fid", "side", "p.x", "p.y")
    places = middles.unionByName(first_vertices(a, 1, "a", "b")).unionByName(first_vertices(b, 2, "b", "a"))
    told = _placed(places, pairs, a, b).select("a_fid", "b_fid", "side", "bits", F.lit(0).alias("cut"), F.lit(False).alias("inner"))
    every = told.unionByName(pieces.select("a_fid", "b_fid", "side", "bits", F.lit(1).alias("cut"), "inner"))

    def of(side: int, column: str) -> F.Column:
        return F.when(F.col("side") == side, F.col(column)).otherwise(F.lit(0))

    merged = every.groupBy("a_fid", "b_fid").agg(
        *(F.bit_or(of(s, "bits")).alias(f"_{n}") for s, n in ((1, "a"), (2, "b"))), *(F.sum(of(s, "cut")).alias(f"_n{n}") for s, n in ((1, "a"), (2, "b"))), F.bool_or("inner").alias("_inner"))
    joined = pairs.join(merged, ["a_fid", "b_fid"], "left")

    def bits(own: str, other: str) -> str:
        # an edge that meets nothing of a line or point lies outside it
        return f"coalesce(_{own}, 0) | IF({other}_dim < 2 AND coalesce(_n{own}, 0) < {own}_n_edges, {OUTSIDE}, 0)"

    return joined.select(
        "a_fid", "b_fid", "a_dim", "b_dim", F.expr(bits("a", "b")).alias("a_bits"), F.expr(bits("b", "a")).alias("b_bits"),
        F.expr("coalesce(_na, 0) > 0").alias("met"), F.expr("coalesce(_inner, false)").alias("inner"))


def holds(relation: str) -> str:
    """SQL over the columns of :func:`pair_bits`: whether a named relation holds."""
    def has(side: str, bit: int) -> str:
        return f"({side}_bits & {bit} <> 0)"

    ai, ao, bi, bo = (has(s, b) for s in "ab" for b in (INSIDE, OUTSIDE))
    dims = "(a_dim = {} AND b_dim = {})"
    if relation == "intersects":
        return f"(met OR b_dim = 2 AND a_bits & {INSIDE | BORDER} <> 0 OR a_dim = 2 AND b_bits & {INSIDE | BORDER} <> 0)"
    if relation == "within":
        return (f"CASE WHEN {dims.format(2, 2)} THEN NOT {ao} AND NOT {bi} AND ({ai} OR NOT {bo}) WHEN a_dim = 2 OR {dims.format(1, 0)} THEN false "
                f"ELSE NOT {ao} AND {ai} END")
    if relation == "contains":
        return (f"CASE WHEN {dims.format(2, 2)} THEN NOT {bo} AND NOT {ai} AND ({bi} OR NOT {ao}) WHEN b_dim = 2 OR {dims.format(0, 1)} THEN false "
                f"ELSE NOT {bo} AND {bi} END")
    if relation == "touches":
        inner = (f"CASE WHEN {dims.format(2, 2)} THEN {ai} OR {bi} OR (NOT {ao} AND NOT {bo}) WHEN {dims.format(1, 1)} THEN inner OR {ai} "
                 f"WHEN a_dim = 0 OR b_dim = 2 THEN {ai} ELSE {bi} END")
        return f"met AND NOT {inner}"
    if relation == "overlaps":
        return (f"CASE WHEN {dims.format(2, 2)} THEN IF({ao}, {ai} OR ({bo} AND {bi}), {bi} AND ({bo} OR {ai})) "
                f"WHEN a_dim = b_dim THEN {ai} AND {ao} AND {bo} ELSE false END")
    if relation == "crosses":
        return (f"CASE WHEN {dims.format(1, 1)} THEN inner AND NOT {ai} WHEN a_dim < b_dim THEN {ai} AND {ao} "
                f"WHEN a_dim > b_dim THEN {bi} AND {bo} ELSE false END")
    raise ValueError(f"unknown relation {relation}")


# what the boxes of two features must satisfy for a relation to be possible
RULES = {"within": x.mbr_inside("a_f", "b_f", "_"), "contains": x.mbr_inside("b_f", "a_f", "_")}


def related(a: DataFrame, b: DataFrame, relation: str, run: int | None = None, **options) -> DataFrame:
    """(a_fid, b_fid) of features in a named relation, by runs."""
    return pair_bits(a, b, RULES.get(relation), run, **options).filter(holds(relation)).select("a_fid", "b_fid")
