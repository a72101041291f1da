"""Layers: named sources, stored queries over them, feature requests and statistics."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.operators.ordered import dense_ids
from lamina.operators.packed import along_curve
from lamina.operators.tables import BOUNDS, with_bounds
from lamina.sources.readers import geometry_columns, read_source, typed

# fixed values: version of stored layers, and the error texts users of layer definitions look for
VERSION = 1
NO_SOURCE = "Please specify at least one source layer or a query"
NO_QUERY = "Several source layers need a query"
NO_TABLE = "Referenced table {} in query not found!"
NO_NAME = "Result column #{} has no name"
NO_GEOMETRY = "Cannot find the specified geometry field {}!"
NO_TYPE = "Can't deduce the geometry type of the geometry field"
NO_STORE = "Cannot store referenced layers"
NO_METADATA = "No metadata tables !"
BAD_VERSION = "Bad virtual layer version !"

# fixed values: type codes of the geometries that SQL functions make
MADE_TYPES = {
    "makepoint": 1, "makepointz": 1, "point": 1, "casttopoint": 1, "centroid": 1, "pointonsurface": 1, "startpoint": 1, "endpoint": 1, "pointn": 1, "line_interpolate_point": 1,
    "casttolinestring": 2, "line_substring": 2, "exteriorring": 2, "interiorringn": 2, "addpoint": 2, "setpoint": 2, "removepoint": 2, "casttopolygon": 3, "makepolygon": 3, "polygon": 3, "envelope": 3,
    "buildmbr": 3, "buildcirclembr": 3, "expand": 3, "buffer": 3, "casttomultipoint": 4, "line_interpolate_equidistant_points": 4, "casttomultilinestring": 5, "casttomultipolygon": 6, "casttogeometrycollection": 7,
}
GENERATORS = ("inline", "inline_outer", "explode", "explode_outer", "posexplode", "posexplode_outer", "stack", "json_tuple")  # name their own columns

ID_LIST_LIMIT = 10_000  # longer id lists are joined instead of being inlined in the plan


@dataclass(frozen=True)
class Source:
    """One named input: a path read with a Spark format, or a view already in the session (``ref``)."""

    name: str | None = None
    fmt: str | None = None
    path: str | None = None
    encoding: str = "UTF-8"
    options: dict = field(default_factory=dict)
    ref: str | None = None


@dataclass(frozen=True)
class LayerDef:
    """What a layer is made of; everything but the sources or the query is optional."""

    sources: tuple[Source, ...] = ()
    query: str | None = None
    uid: str | None = None
    geometry: str | None = None
    gtype: int | None = None
    srid: int | None = None
    nogeometry: bool = False

    @classmethod
    def from_url(cls, url: str) -> LayerDef:
        """From ``?layer=format:path[:name[:encoding]]&layer_ref=view[:name]&query=..&uid=..&geometry=col[:type:srid]&nogeometry``.

        Colons and other special characters inside a path are percent-encoded.  A storage path
        before the question mark is no part of the definition.  A type without srid has srid 0.
        """
        sources, kw = [], {}
        for pair in _url_parts(url)[1].split("&"):
            key, _, raw = pair.partition("=")
            if key == "layer":
                bits = raw.split(":", 3)
                if len(bits) > 1:
                    sources.append(Source(
                        name=bits[2] if len(bits) > 2 else None, fmt=bits[0], path=unquote(bits[1]),
                        encoding=bits[3] if len(bits) > 3 else "UTF-8"))
            elif key == "layer_ref":
                ref, _, name = raw.partition(":")
                sources.append(Source(name=name or None, ref=unquote(ref)))
            elif key == "geometry":
                col, *rest = raw.split(":")
                kw["geometry"] = col
                if rest:
                    code = x.TYPE_CODES.get(rest[0].lower())
                    # codes with heights or measures are the plain type and a multiple of 1000
                    kw["gtype"] = int(rest[0]) % 1000 if code is None else code
                    kw["srid"] = int(rest[1]) if len(rest) > 1 else 0
            elif key == "nogeometry":
                kw["nogeometry"] = True
            elif key in ("uid", "query"):
                kw[key] = unquote(raw)
        return cls(tuple(sources), **kw)

    def named_sources(self) -> list[Source]:
        """Sources with the default names vtab1, vtab2, ... by position."""
        return [replace(s, name=s.name or f"vtab{i}") for i, s in enumerate(self.sources, 1)]

    def check(self) -> None:
        if not self.sources and not self.query:
            raise ValueError(NO_SOURCE)
        if len(self.sources) > 1 and not self.query:
            raise ValueError(NO_QUERY)


def _url_parts(url: str) -> tuple[str, str]:
    """Storage path and settings of a layer URL; a question mark inside a setting splits nothing."""
    head, mark, rest = url.partition("?")
    if not mark:
        return ("", url) if "=" in url else (unquote(url), "")
    return ("", url) if "=" in head else (unquote(head), rest)


def attach(spark: SparkSession, source: Source) -> DataFrame:
    """Make a source readable under its name, its geometry columns with their type."""
    if source.ref is not None:
        given = spark.table(_quoted(source.ref))
    else:
        given = read_source(spark, source.fmt, source.path, source.encoding, **source.options)
    df = _with_types(given)
    if source.ref is None or source.ref != source.name or df is not given:
        df.createOrReplaceTempView(_quoted(source.name))
    return df


def _with_types(df: DataFrame) -> DataFrame:
    """Geometry columns of a source know their type and srid: from their metadata, else from one pass over the rows."""
    for c in geometry_columns(df):
        if "gtype" not in df.schema[c].metadata:
            gtype, srid = geometry_type(df, c)
            if gtype is not None:
                df = df.withColumn(c, typed(F.col(_quoted(c)), c, gtype, srid))
    return df


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(_quoted(name)) and spark.catalog.getTable(_quoted(name)).isTemporary


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _parsed(spark: SparkSession, query: str):
    """The query as Spark's parser reads it, before any name is looked up."""
    return spark._jsparkSession.sessionState().sqlParser().parsePlan(query)


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _select_list(plan) -> list:
    """Expressions of the outermost SELECT of a parsed query."""
    while True:
        if _kind(plan) == "Project":
            return _items(plan.projectList())
        if _kind(plan) == "Aggregate":
            return _items(plan.aggregateExpressions())
        below = _items(plan.children())
        if not below:
            return []
        plan = below[0]


def _function(expression) -> str | None:
    """Name of the SQL function an expression calls, without ``ST_``."""
    if _kind(expression) != "UnresolvedFunction":
        return None
    return str(_items(expression.nameParts())[-1]).lower().removeprefix("st_")


def relations(spark: SparkSession, query: str) -> list[str]:
    """Names of one part that a query reads and doesn't define itself."""
    text = _parsed(spark, query).toString()
    own = {n.strip().lower() for names in re.findall(r"CTE \[([^\]]*)\]", text) for n in names.split(",")}
    found = dict.fromkeys(re.findall(r"'UnresolvedRelation \[([^\],]+)\]", text))
    return [n for n in found if n.lower() not in own]


def run_query(spark: SparkSession, query: str) -> DataFrame:
    """Result of a query over attached layers, with the errors a layer definition reports."""
    try:
        df = spark.sql(query)
        names = df.columns
    except AnalysisException as e:
        if e.getCondition() == "TABLE_OR_VIEW_NOT_FOUND":
            name = e.getMessageParameters()["relationName"].replace("`", "")
            raise ValueError(NO_TABLE.format(name)) from e
        raise
    chosen = _select_list(_parsed(spark, query))
    stars = sum(_kind(c) == "UnresolvedStar" for c in chosen)
    width = (len(names) - len(chosen) + stars) // stars if stars else 1
    place = 1
    for c in chosen:
        # what is neither a column, a star nor given a name stands alone in the parsed plan
        if _kind(c) == "UnresolvedAlias" and _function(c.child()) not in GENERATORS:
            raise ValueError(NO_NAME.format(place))
        place += width if _kind(c) == "UnresolvedStar" else 1
    return df


def made_types(spark: SparkSession, query: str) -> dict[str, int]:
    """Type codes of the result columns that a function of known type makes."""
    out = {}
    for c in _select_list(_parsed(spark, query)):
        if _kind(c) == "Alias" and _function(c.child()) in MADE_TYPES:
            out[c.name()] = MADE_TYPES[_function(c.child())]
    return out


def pick_geometry(df: DataFrame, name: str | None = None, known: Iterable[str] = ()) -> str | None:
    """Name of the geometry column of a query result: the requested one, else the first whose type is known."""
    found = geometry_columns(df)
    if name is None:
        return next((c for c in found if c in known or "gtype" in df.schema[c].metadata), None)
    match = [c for c in found if c.lower() == name.lower()]
    if not match:
        raise ValueError(NO_GEOMETRY.format(name))
    return match[0]


class Layer:
    """A readable layer: a DataFrame, its id column and its geometry column."""

    def __init__(self, df: DataFrame, uid: str | None = None, geometry: str | None = None,
                 gtype: int | None = None, srid: int | None = None, definition: LayerDef | None = None):
        self.df, self.uid, self.geometry = df, uid, geometry
        self.gtype, self.srid, self.definition = gtype, srid, definition
        self._stats: DataFrame | None = None

    # ------------------------------------------------------------ reading

    def features(self, rect: tuple[float, float, float, float] | None = None, exact: bool = False,
                 fid=None, fids: Iterable | DataFrame | None = None, columns: list[str] | None = None,
                 geometry: bool = True, subset: str | None = None) -> DataFrame:
        """Features meeting every condition; ``fid`` and ``fids`` need an id column and give way to ``rect``."""
        df = self.df
        if subset:
            df = df.filter(subset)
        if rect is not None and self.geometry:
            df = rect_filter(df, rect, exact, self.geometry)
        elif self.uid and fid is not None:
            df = df.filter(F.col(self.uid) == fid)
        elif self.uid and fids is not None:
            df = id_filter(df, self.uid, fids)
        if columns is not None:
            keep = [self.uid] if self.uid else []
            keep += [c for c in columns if c not in keep]
            if geometry and self.geometry and self.geometry not in keep:
                keep.append(self.geometry)
            df = df.select(*keep)
        if not geometry or not self.geometry:
            df = df.drop(*geometry_columns(df))
        return df

    def with_fid(self) -> DataFrame:
        """Features with a ``fid`` column: the id column, or dense numbers in read order."""
        if self.uid:
            return self.df.withColumn("fid", F.col(self.uid).cast("long"))
        return dense_ids(self.df)

    # ------------------------------------------------------------ reports

    def stats(self) -> DataFrame:
        """One row: feature count and extent.  Computed once per layer and kept (it is one row)."""
        if self._stats is None:
            self._stats = layer_stats(self.df, self.geometry).cache()
        return self._stats

    def describe(self, name: str = "layer") -> DataFrame:
        return describe_layers({name: self.df})

    def view(self, name: str) -> None:
        self.df.createOrReplaceTempView(_quoted(name))

    # ------------------------------------------------------------ storing

    def save(self, path: str, data: bool = False) -> None:
        """Store the definition; with ``data`` also the features, laid out for rectangle requests."""
        save_layer(self, path, data)


def create_layer(spark: SparkSession, definition: LayerDef | str) -> Layer:
    """Build a layer from a definition (or its URL form).

    A URL that is a path alone reopens the layer stored there; one with a path and settings
    also stores the definition under the path.  Views of the session that have the name of a
    source keep their rows.
    """
    if isinstance(definition, str):
        path, settings = _url_parts(definition)
        if path and not settings:
            return open_layer(spark, path)
        made = create_layer(spark, LayerDef.from_url(definition))
        if path:
            save_layer(made, path)
        return made
    d = definition
    d.check()
    sources = d.named_sources()
    if d.query:
        # views that the query finds by their name are sources like others
        named = {s.name.lower() for s in sources}
        sources += [Source(name=n, ref=n) for n in relations(spark, d.query) if n.lower() not in named and _is_view(spark, n)]
        d = replace(d, sources=tuple(sources))
    held = {s.name: spark.table(_quoted(s.name)) for s in sources if (s.ref is None or s.ref == s.name) and _is_view(spark, s.name)}
    try:
        frames = [attach(spark, s) for s in sources]
        df = run_query(spark, d.query) if d.query else frames[0]
    finally:
        for name, rows in held.items():
            rows.createOrReplaceTempView(_quoted(name))

    uid = None
    if d.uid:
        match = [c for c in df.columns if c.lower() == d.uid.lower()]
        if not match:
            raise ValueError(f"Cannot find the id column {d.uid}")
        uid = match[0]
    if d.nogeometry:
        return Layer(df.drop(*geometry_columns(df)), uid, definition=d)
    made = made_types(spark, d.query) if d.query else {}
    geom = pick_geometry(df, d.geometry, made)
    if geom is None:
        return Layer(df, uid, definition=d)
    gtype, srid = d.gtype, d.srid
    if gtype is None:
        # a type is declared, known from the source, or that of the function; it isn't guessed from rows
        meta = df.schema[geom].metadata
        if "gtype" in meta:
            gtype, srid = meta["gtype"], meta["srid"]
        elif geom in made:
            gtype, srid = made[geom], geometry_type(df, geom)[1] or 0
        else:
            raise ValueError(NO_TYPE)
    others = [c for c in geometry_columns(df) if c != geom]
    named = df.select(*(typed(F.col(_quoted(c)), c, gtype, srid) if c == geom else F.col(_quoted(c)) for c in df.columns if c not in others))
    return Layer(named, uid, geom, gtype, srid, d)


def geometry_type(df: DataFrame, geom: str) -> tuple[int | None, int | None]:
    """Type and srid of a geometry column: from its metadata, else from one pass over the rows."""
    meta = df.schema[geom].metadata
    if "gtype" in meta:
        return meta["gtype"], meta["srid"]
    g = F.col(_quoted(geom))
    r = df.agg(F.min(g["gtype"]).alias("lo"), F.max(g["gtype"]).alias("hi"), F.max(g["srid"]).alias("srid")).first()
    if r.lo is None:
        return None, None
    return (r.lo if r.lo == r.hi else 0), r.srid


# ---------------------------------------------------------------- requests

def rect_filter(df: DataFrame, rect: tuple[float, float, float, float], exact: bool = False, geom: str = "geom") -> DataFrame:
    """Features whose box, or with ``exact`` whose geometry, meets a closed rectangle; corners in any order.

    Bounds columns, when the layer has them, are compared directly so that file statistics prune.
    """
    x0, x1 = sorted((float(rect[0]), float(rect[2])))
    y0, y1 = sorted((float(rect[1]), float(rect[3])))
    stored = set(BOUNDS) <= set(df.columns)
    boxed = df if stored else with_bounds(df, geom)
    near = boxed.filter((F.col("xmax") >= x0) & (F.col("xmin") <= x1) & (F.col("ymax") >= y0) & (F.col("ymin") <= y1))
    if exact:
        corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
        window = "array(" + ", ".join(
            f"named_struct('x1', {a[0]!r}D, 'y1', {a[1]!r}D, 'x2', {b[0]!r}D, 'y2', {b[1]!r}D)"
            for a, b in zip(corners, corners[1:] + corners[:1])) + ")"
        within = f"xmin >= {x0!r}D AND xmax <= {x1!r}D AND ymin >= {y0!r}D AND ymax <= {y1!r}D"
        es = x.edges(f"`{geom}`")
        held = f"({x.dimension(f'`{geom}`')} = 2 AND {x.locate(f'{x0!r}D', f'{y0!r}D', es)} > 0)"
        near = near.filter(F.expr(f"({within}) OR {x.any_edges_touch(es, window)} OR {held}"))
    return near if stored else near.select(*df.columns)


def id_filter(df: DataFrame, uid: str, ids: Iterable | DataFrame) -> DataFrame:
    """Features with one of the ids: a short list inline, a long list or a table (first column) as a semi join."""
    if not isinstance(ids, DataFrame):
        ids = list(ids)
        if len(ids) <= ID_LIST_LIMIT:
            return df.filter(F.col(uid).isin(ids))
        ids = df.sparkSession.createDataFrame([(i,) for i in ids], "id long")
    return df.join(ids.toDF(uid), uid, "left_semi")


# ---------------------------------------------------------------- reports

def layer_stats(df: DataFrame, geom: str | None = "geom") -> DataFrame:
    """One row: count and extent."""
    if not (set(BOUNDS) <= set(df.columns)) and (geom is None or geom not in df.columns):
        return df.agg(F.count(F.lit(1)).alias("n"), *(F.lit(None).cast("double").alias(c) for c in BOUNDS))
    return with_bounds(df, geom).agg(
        F.count(F.lit(1)).alias("n"), F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


def describe_layers(layers: dict[str, DataFrame] | list[tuple[str, str, DataFrame]]) -> DataFrame:
    """One row per (layer, column): type, and geometry type, dimension and srid of geometry columns.

    Pass (name, id, DataFrame) triples when names repeat: a repeated name gives way to the id.
    """
    rows = [(n, n, df) for n, df in layers.items()] if isinstance(layers, dict) else list(layers)
    names = [n for n, _, _ in rows]
    out = None
    for name, ident, df in rows:
        shown = ident if names.count(name) > 1 else name
        spark = df.sparkSession
        geoms = geometry_columns(df)
        plain = [(shown, i, f.name, f.dataType.simpleString(), None, None, None)
                 for i, f in enumerate(df.schema.fields) if f.name not in geoms]
        schema = "layer string, pos int, column string, type string, gtype int, dims string, srid int"
        part = spark.createDataFrame(plain, schema)
        for g in geoms:
            has_z = F.max(F.expr(f"IF({x.has_z(f'`{g}`')}, 1, 0)"))
            facts = df.agg(
                F.min(f"{g}.gtype").alias("lo"), F.max(f"{g}.gtype").alias("hi"),
                has_z.alias("z"), F.max(f"{g}.srid").alias("s"))
            part = part.unionByName(facts.select(
                F.lit(shown).alias("layer"), F.lit(df.columns.index(g)).alias("pos"), F.lit(g).alias("column"),
                F.lit("geometry").alias("type"), F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(0).alias("gtype"),
                F.when(F.col("z") == 1, "XYZ").otherwise("XY").alias("dims"), F.col("s").alias("srid")))
        out = part if out is None else out.unionByName(part)
    return out


def contract(df: DataFrame, uid: str | None = None, geom: str | None = None, gtype: int | None = None,
             srid: int | None = None) -> DataFrame:
    """One row per rule with the number of violations.

    unnamed_columns, uid_null, uid_duplicate (rows beyond the first of an id), geom_null, geom_type, geom_srid.
    """
    unnamed = sum(not c.strip() or "__autoGeneratedAlias" in df.schema[c].metadata for c in df.columns)
    zero = F.lit(0).cast("long")
    aggs = [F.lit(unnamed).cast("long").alias("unnamed_columns")]
    if geom:
        kind = F.col(f"{geom}.gtype")
        aggs += [
            F.count_if(F.col(geom).isNull()).alias("geom_null"),
            (F.count_if(kind != gtype) if gtype is not None else zero).alias("geom_type"),
            (F.count_if(F.col(f"{geom}.srid") != srid) if srid is not None else zero).alias("geom_srid"),
        ]
    rules = df.agg(*aggs)
    names = rules.columns
    report = rules.select(F.expr(f"stack({len(names)}, {', '.join(f'{n!r}, `{n}`' for n in names)}) AS (rule, violations)"))
    if uid:
        # one row per id instead of a global distinct, so the work is spread by id
        per = df.groupBy(F.col(uid).alias("id")).agg(F.count(F.lit(1)).alias("n"))
        ids = per.agg(
            F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), zero).alias("uid_null"),
            F.coalesce(F.sum(F.when(F.col("id").isNotNull(), F.col("n") - 1)), zero).alias("uid_duplicate"))
        report = report.unionByName(ids.select(
            F.expr("stack(2, 'uid_null', uid_null, 'uid_duplicate', uid_duplicate) AS (rule, violations)")))
    return report


# ---------------------------------------------------------------- joined layers

@dataclass(frozen=True)
class AttributeJoin:
    """Join declared on a layer: ``target`` of the layer equals ``key`` of the joined one."""

    name: str
    df: DataFrame
    target: str
    key: str
    columns: tuple[str, ...] | None = None


def denormalize(df: DataFrame, joins: list[AttributeJoin], pk: str | None = None) -> tuple[DataFrame, str]:
    """One layer with the fields of its joins as ``<layer>_<field>``, and the name of its id column.

    Without a key a dense id is added, called ``uid`` with as many ``_`` as needed to be new.
    """
    if pk is None:
        pk = "uid"
        while pk in df.columns:
            pk += "_"
        df = dense_ids(df, name=pk).select(*df.columns, pk)
    for i, j in enumerate(joins, 1):
        fields = j.columns or tuple(j.df.columns)
        side = j.df.select(F.col(j.key).alias(f"_j{i}"), *(F.col(c).alias(f"{j.name}_{c}") for c in fields))
        df = df.join(side, F.col(j.target) == F.col(f"_j{i}"), "left").drop(f"_j{i}")
    return df, pk


# ---------------------------------------------------------------- storing

def save_layer(layer: Layer, path: str, data: bool = False) -> None:
    """Write a layer's definition as a one-row JSON table under ``path``, replacing what was there.

    ``data=True`` also writes the features with their bounds in the order of a space-filling curve, cut into ranges of about as many
    features by Spark's sample, so that rectangle requests on the reopened layer skip files and row groups by statistics.  The id is
    the last key: any number of features in one place spreads over files, and an outlier moves no others.
    Views of the session cannot be stored without their data.
    """
    d = layer.definition or LayerDef()
    if not data and (any(s.ref is not None for s in d.sources) or not d.sources):
        raise ValueError(NO_STORE)
    spark = layer.df.sparkSession
    row = {
        "version": VERSION, "definition": json.dumps(asdict(d)), "uid": layer.uid, "geometry": layer.geometry,
        "gtype": layer.gtype, "srid": layer.srid, "has_data": data, "fields": layer.df.schema.json(),
    }
    if data:
        df = layer.df
        if layer.geometry:
            df = with_bounds(df, layer.geometry)
            place, _ = along_curve(df)
            plain = [c for c, t in df.dtypes if c not in geometry_columns(df) and not t.startswith(("map", "variant"))]
            keys = [F.expr(place or "0L"), F.col(_quoted(layer.uid)) if layer.uid else F.xxhash64(*map(_quoted, plain))]
            df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        df.write.mode("overwrite").parquet(f"{path}/data")
    types = "version int, definition string, uid string, geometry string, gtype int, srid int, has_data boolean, fields string"
    spark.createDataFrame([tuple(row.values())], types).coalesce(1).write.mode("overwrite").json(f"{path}/definition")


def open_layer(spark: SparkSession, path: str) -> Layer:
    """Reopen a stored layer with its fields, id and geometry."""
    types = "version int, definition string, uid string, geometry string, gtype int, srid int, has_data boolean, fields string"
    try:
        row = spark.read.schema(types).json(f"{path}/definition").first()
    except AnalysisException as e:
        raise ValueError(NO_METADATA) from e
    if row is None or row.version != VERSION:
        raise ValueError(BAD_VERSION)
    raw = json.loads(row.definition)
    d = LayerDef(**{**raw, "sources": tuple(Source(**s) for s in raw["sources"])})
    if not row.has_data:
        layer = create_layer(spark, d)
        missing = [f["name"] for f in json.loads(row.fields)["fields"] if f["name"] not in layer.df.columns]
        if missing:
            raise ValueError(f"the sources no longer give the fields {', '.join(missing)}")
        return layer
    df = spark.read.parquet(f"{path}/data")
    if row.geometry:
        df = df.select(*(typed(F.col(c), c, row.gtype, row.srid) if c == row.geometry else F.col(_quoted(c)) for c in df.columns))
    return Layer(df, row.uid, row.geometry, row.gtype, row.srid, d)


# ---------------------------------------------------------------- export

def with_wkt(df: DataFrame, name: str = "geom") -> DataFrame:
    """Replace a geometry column by its WKT text, for sinks that hold plain columns."""
    return df.withColumn(name, F.expr(x.to_wkt(f"`{name}`")))
