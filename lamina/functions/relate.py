"""Named spatial relations of two features, from their edge arrays.

Every edge of one feature is cut at its contacts with the edges of the other; the middle
of each piece then lies inside, outside or on the border of the other feature.  A relation
asks whether pieces of some kind exist, so most pairs are decided by the first few edges:
the cheap tests (boxes, edges that cross properly) come first and stop the evaluation.

The expressions refer to columns ``<side>es``, ``<side>dim``, ``<side>ends`` and
``<side>anchors`` as made by :func:`lamina.operators.tables.shapes`.
"""

from __future__ import annotations

from dataclasses import dataclass

from lamina.functions import exprs as x

INSIDE, OUTSIDE, BORDER = 1, 2, 4


def _near(e: str, f: str) -> str:
    """The boxes of two edges meet."""
    return (
        f"greatest({e}.x1, {e}.x2) >= least({f}.x1, {f}.x2) AND least({e}.x1, {e}.x2) <= greatest({f}.x1, {f}.x2) AND "
        f"greatest({e}.y1, {e}.y2) >= least({f}.y1, {f}.y2) AND least({e}.y1, {e}.y2) <= greatest({f}.y1, {f}.y2)"
    )


def _cuts(e: str, f: str) -> str:
    """Parameters in [0, 1] along edge ``e`` where edge ``f`` meets it."""
    dx, dy = f"({e}.x2 - {e}.x1)", f"({e}.y2 - {e}.y1)"
    fx, fy = f"({f}.x2 - {f}.x1)", f"({f}.y2 - {f}.y1)"
    gx, gy = f"({f}.x1 - {e}.x1)", f"({f}.y1 - {e}.y1)"
    det = f"({dx} * {fy} - {dy} * {fx})"
    t, u = f"(({gx} * {fy} - {gy} * {fx}) / cu_d)", f"(({gx} * {dy} - {gy} * {dx}) / cu_d)"
    len2 = f"({dx} * {dx} + {dy} * {dy})"

    def along(i: int) -> str:
        return f"(({f}.x{i} - {e}.x1) * {dx} + ({f}.y{i} - {e}.y1) * {dy}) / {len2}"

    collinear = f"({x.orient(f'{e}.x1', f'{e}.y1', f'{e}.x2', f'{e}.y2', f'{f}.x1', f'{f}.y1')} = 0)"
    none = "CAST(array() AS ARRAY<DOUBLE>)"
    return x.let(
        det, "cu_d",
        f"CASE WHEN {len2} = 0 THEN {none} "
        f"WHEN cu_d <> 0 THEN IF({t} BETWEEN 0 AND 1 AND {u} BETWEEN 0 AND 1, array({t}), {none}) "
        f"WHEN {collinear} THEN filter(array({along(1)}, {along(2)}), cu_t -> cu_t BETWEEN 0 AND 1) "
        f"ELSE {none} END",
    )


def _middles(e: str, near: str) -> str:
    """Middle of every piece of an edge cut by the edges ``near`` to it."""
    cut = f"sort_array(array_distinct(concat(array(0D, 1D), flatten(transform({near}, mi_f -> {_cuts(e, 'mi_f')})))))"
    t = "((mi_t[mi_i - 1] + mi_t[mi_i]) / 2)"
    mid = f"named_struct('x', {e}.x1 + {t} * ({e}.x2 - {e}.x1), 'y', {e}.y1 + {t} * ({e}.y2 - {e}.y1))"
    return x.let(cut, "mi_t", f"transform(sequence(1, size(mi_t) - 1), mi_i -> {mid})")


@dataclass(frozen=True)
class Side:
    """Column prefix of one feature, with its dimension (0, 1, 2) when the whole layer has the same."""

    prefix: str
    dim: int | None = None

    def __getattr__(self, name: str) -> str:
        return self.prefix + name


def _cases(*branches: tuple[list[tuple[Side, int]], str], default: str) -> str:
    """CASE over dimensions: each branch names the sides and their dimensions.

    Branches ruled out by known dimensions are left out of the text.
    """
    out = []
    for wanted, then in branches:
        if any(s.dim not in (None, d) for s, d in wanted):
            continue
        open_tests = [f"{s.prefix}dim = {d}" for s, d in wanted if s.dim is None]
        if not open_tests:
            default = then
            break
        out.append(f"WHEN {' AND '.join(open_tests)} THEN {then}")
    return f"(CASE {' '.join(out)} ELSE {default} END)" if out else f"({default})"


def _place(px: str, py: str, f: Side) -> str:
    """Bit of a point against a feature of any dimension."""
    on_line = f"exists({f.es}, pl_f -> {x.on_edge(px, py, 'pl_f')})"
    at_end = f"exists({f.ends}, pl_v -> pl_v.x = {px} AND pl_v.y = {py})"
    in_area = f"CASE {x.locate(px, py, f.es)} WHEN 1 THEN {INSIDE} WHEN 2 THEN {BORDER} ELSE {OUTSIDE} END"
    thin = f"CASE WHEN {at_end} THEN {BORDER} WHEN {on_line} THEN {INSIDE} ELSE {OUTSIDE} END"
    return _cases(([(f, 2)], in_area), default=thin)


def some(a: Side, b: Side, bit: int) -> str:
    """Some piece of ``a`` lies inside or outside ``b``.

    A vertex of ``a`` in the open inside or outside settles it; only edges near an edge of
    ``b`` can hide pieces of another kind than their vertices, so only those are cut.
    """
    def place(px: str, py: str) -> str:
        return f"{_place(px, py, b)} = {bit}"

    vertex = f"exists({a.es}, so_v -> {place('so_v.x1', 'so_v.y1')})"
    near = f"filter({b.es}, so_g -> {_near('so_e', 'so_g')})"
    cut = x.let(near, "so_n", f"size(so_n) > 0 AND exists({_middles('so_e', 'so_n')}, so_p -> {place('so_p.x', 'so_p.y')})")
    pieces = f"exists({a.es}, so_e -> {cut})"
    if bit == OUTSIDE:
        return _cases(([(a, 0)], vertex), default=f"{vertex} OR {pieces}")
    # a vertex on a line is no piece of it
    return _cases(([(a, 0)], vertex), ([(b, 2)], f"{vertex} OR {pieces}"), default=pieces)


def proper_cross(a: Side, b: Side) -> str:
    """Two edges cross at a point interior to both."""
    e, f = "pc_e", "pc_f"
    fe = [x.orient(f"{f}.x1", f"{f}.y1", f"{f}.x2", f"{f}.y2", f"{e}.x{i}", f"{e}.y{i}") for i in (1, 2)]
    ef = [x.orient(f"{e}.x1", f"{e}.y1", f"{e}.x2", f"{e}.y2", f"{f}.x{i}", f"{f}.y{i}") for i in (1, 2)]
    strict = f"sign({fe[0]}) * sign({fe[1]}) < 0 AND sign({ef[0]}) * sign({ef[1]}) < 0"
    return f"exists({a.es}, {e} -> exists({b.es}, {f} -> {_near(e, f)} AND {strict}))"


def inner_contact(a: Side, b: Side) -> str:
    """Two lines share a point that is an end point of neither."""
    def near(v: str) -> str:
        return f"abs({v}.x - ic_p.x) <= {x.TOLERANCE} AND abs({v}.y - ic_p.y) <= {x.TOLERANCE}"

    pts = (
        f"transform({_cuts('ic_e', 'ic_f')}, ic_t -> named_struct('x', ic_e.x1 + ic_t * (ic_e.x2 - ic_e.x1), "
        "'y', ic_e.y1 + ic_t * (ic_e.y2 - ic_e.y1)))"
    )
    free = f"NOT exists({a.ends}, ic_v -> {near('ic_v')}) AND NOT exists({b.ends}, ic_w -> {near('ic_w')})"
    return f"exists({a.es}, ic_e -> exists({b.es}, ic_f -> {_near('ic_e', 'ic_f')} AND exists({pts}, ic_p -> {free})))"


def _along(a: Side, b: Side) -> str:
    """Some edges of two lines run along each other: no other edge can hold the middle of a piece."""
    cross = "(al_e.x2 - al_e.x1) * (al_f.y2 - al_f.y1) - (al_e.y2 - al_e.y1) * (al_f.x2 - al_f.x1)"
    span = "(1 + abs(al_e.x2 - al_e.x1) + abs(al_e.y2 - al_e.y1)) * (1 + abs(al_f.x2 - al_f.x1) + abs(al_f.y2 - al_f.y1))"
    return f"exists({a.es}, al_e -> exists({b.es}, al_f -> abs({cross}) <= {x.TOLERANCE} * {span}))"


def holds_anchor(outer: Side, inner: Side) -> str:
    """A polygon feature holds the first vertex of some part of the other feature."""
    held = f"exists({inner.anchors}, ha_v -> {x.locate('ha_v.x', 'ha_v.y', outer.es)} > 0)"
    return _cases(([(outer, 2)], held), default="false")


def meets(a: Side, b: Side) -> str:
    """The features share a point: edges touch, or one lies wholly inside a polygon of the other."""
    return f"({x.any_edges_touch(a.es, b.es)} OR {holds_anchor(a, b)} OR {holds_anchor(b, a)})"


def _inner(a: Side, b: Side) -> str:
    """The interiors of two features meet."""
    ai, bi = some(a, b, INSIDE), some(b, a, INSIDE)
    same = f"(NOT {some(a, b, OUTSIDE)} AND NOT {some(b, a, OUTSIDE)})"
    return _cases(
        ([(a, 2), (b, 2)], f"{ai} OR {bi} OR {same}"),
        ([(a, 1), (b, 1)], f"{inner_contact(a, b)} OR {ai}"),
        ([(a, 0)], ai), ([(b, 2)], ai), default=bi)


def _within(a: Side, b: Side) -> str:
    ai, ao = some(a, b, INSIDE), some(a, b, OUTSIDE)
    area = f"NOT {ao} AND NOT {some(b, a, INSIDE)} AND ({ai} OR NOT {some(b, a, OUTSIDE)})"
    return _cases(
        ([(a, 2), (b, 2)], area), ([(a, 2)], "false"), ([(a, 1), (b, 0)], "false"), default=f"NOT {ao} AND {ai}")


def predicate(name: str, a: Side | str = "a_", b: Side | str = "b_") -> str:
    """Boolean expression of a named relation."""
    a, b = (Side(s) if isinstance(s, str) else s for s in (a, b))
    ai, bi = some(a, b, INSIDE), some(b, a, INSIDE)
    ao, bo = some(a, b, OUTSIDE), some(b, a, OUTSIDE)
    if name == "intersects":
        return meets(a, b)
    if name == "disjoint":
        return f"NOT {meets(a, b)}"
    if name == "within":
        return _within(a, b)
    if name == "contains":
        return _within(b, a)
    if name == "touches":
        return f"({x.any_edges_touch(a.es, b.es)} AND NOT {_inner(a, b)})"
    if name == "overlaps":
        # with nothing of a outside b, two areas overlap only if a reaches over a hole of b
        areas = (
            f"CASE WHEN {proper_cross(a, b)} THEN true WHEN {ao} THEN {ai} OR ({bo} AND {bi}) ELSE {bi} AND ({bo} OR {ai}) END"
        )
        thin = f"{ai} AND {ao} AND {bo}"
        return _cases(([(a, 2), (b, 2)], areas), ([(a, 1), (b, 1)], f"{_along(a, b)} AND {thin}"), ([(a, 0), (b, 0)], thin), default="false")
    if name == "crosses":
        over, under = f"{ai} AND {ao}", f"{bi} AND {bo}"
        return _cases(
            ([(a, 1), (b, 1)], f"{inner_contact(a, b)} AND NOT {ai}"), ([(a, 1), (b, 2)], over), ([(a, 2), (b, 1)], under),
            ([(a, 0), (b, 1)], over), ([(a, 0), (b, 2)], over), ([(a, 1), (b, 0)], under), ([(a, 2), (b, 0)], under),
            default="false")
    raise ValueError(f"unknown relation {name}")


# what the bounding boxes must satisfy for a relation to be possible, over a_xmin .. b_ymax
BOX_RULES = {
    "within": x.mbr_inside("a", "b", "_"),
    "contains": x.mbr_inside("b", "a", "_"),
}


def edge_key(es: str) -> str:
    """Outline as a sorted set of undirected edges: equal for any start vertex and direction."""
    flip = "(ek_e.x1 > ek_e.x2 OR (ek_e.x1 = ek_e.x2 AND ek_e.y1 > ek_e.y2))"
    one = (
        f"IF({flip}, named_struct('x1', ek_e.x2, 'y1', ek_e.y2, 'x2', ek_e.x1, 'y2', ek_e.y1), ek_e)"
    )
    return f"array_sort(array_distinct(transform({es}, ek_e -> {one})))"
