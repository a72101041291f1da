"""Fill-in-the-middle transformation by secondary sort.

A text of n code points is cut into prefix, middle and suffix and rearranged behind sentinels.  No task builds a rearranged text from a
whole document: the scan emits *pieces* of at most ``CHUNK`` code points, keyed by document and output position, in the order of the
source.  One shuffle deals the documents out and sorts each partition by document and output position (``repartition`` and
``sortWithinPartitions``, the DataFrame form of repartitionAndSortWithinPartitions), so a task streams the pieces of the output in order
into an incremental digest and holds one piece at a time.

Restoration reads nothing but output and form: while the output streams by, its sentinels are found and each piece is given its section
(prefix, middle, suffix) and its place in it; the partition is sorted again by those, without a second shuffle, and the pieces of the
restored text stream into a second digest.

Cuts and forms come from SHA-256 of the seed and the document's id, so a task that is run again makes the same pieces.  A document's key
is its row number in the scan: rows that share an id or a text are spread over all tasks, and no group of copies meets in one.  The
input must read the same way twice (a table or files; write a shuffled result first).

| form | output |
|---|---|
| psm | ``<P>`` prefix ``<S>`` suffix ``<M>`` middle |
| spm | ``<S>`` suffix ``<P>`` prefix ``<M>`` middle |
| plain | the text, for empty texts, texts that hold a sentinel, and the share that isn't transformed |
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.common import blocks, quoted

SENTINELS = ("<P>", "<S>", "<M>")
CHUNK = 2048  # code points of a piece
OUT_BYTES, OUT_ROWS = 2 << 20, 4096  # of a batch that is handed on
PREFIX, MIDDLE, SUFFIX = 0, 1, 2
# sections in output order, each behind its sentinel
LAYOUT = {"psm": (("<P>", PREFIX), ("<S>", SUFFIX), ("<M>", MIDDLE)), "spm": (("<S>", SUFFIX), ("<P>", PREFIX), ("<M>", MIDDLE))}

PIECES = T.StructType([T.StructField("row", T.LongType()), T.StructField("at", T.LongType()), T.StructField("piece", T.StringType()), T.StructField("id", T.LongType()), T.StructField("n", T.LongType())])
SECTIONS = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("section", T.IntegerType()), T.StructField("at", T.LongType()), T.StructField("piece", T.StringType()), T.StructField("id", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output_sha256", T.StringType())])


class _Batches:
    """Rows gathered into record batches of bounded size."""

    def __init__(self, schema: T.StructType):
        self.schema = pa.schema([(f.name, {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[f.dataType.simpleString()]) for f in schema.fields])
        self.rows, self.size = [], 0

    def add(self, *row) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += 64 + sum(len(v) for v in row if isinstance(v, str))
        if self.size > OUT_BYTES or len(self.rows) >= OUT_ROWS:
            yield from self.end()

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*self.rows), self.schema)], schema=self.schema)
        self.rows, self.size = [], 0


def plan(doc_id: int | None, text: str, seed: str = "1", fim_percent: int = 90, spm_percent: int = 20) -> tuple[str, int, int]:
    """(form, end of prefix, end of middle); a missing id counts as an empty string."""
    n = len(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    if not n or any(s in text for s in SENTINELS) or h3 % 100 >= fim_percent:
        return "plain", n, n
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return ("spm" if h4 % 100 < spm_percent else "psm"), a, b


def cut(text: str, form: str, a: int, b: int) -> Iterator[tuple[int, str]]:
    """(output position, piece) in the order of the source; a section's first piece brings its sentinel."""
    if form == "plain":
        spans = [(0, len(text), 0, "")]
    else:
        bounds = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, len(text))}
        at, starts = 0, {}
        for sentinel, section in LAYOUT[form]:
            starts[section] = (at, sentinel)
            at += len(sentinel) + bounds[section][1] - bounds[section][0]
        spans = [(*bounds[s], *starts[s]) for s in (PREFIX, MIDDLE, SUFFIX)]
    for start, end, at, sentinel in spans:
        lead = sentinel
        for k in range(start, max(end, start + bool(sentinel)), CHUNK):
            piece = lead + text[k : min(k + CHUNK, end)]
            yield at, piece
            at, lead = at + len(piece), ""


class Reader:
    """Finds the sections of an output that comes in pieces; a sentinel may be cut anywhere."""

    def __init__(self, form: str):
        self.wanted = list(LAYOUT.get(form, ()))
        self.section, self.at, self.tail = PREFIX, 0, ""
        self.size = {PREFIX: 0, MIDDLE: 0, SUFFIX: 0}

    def feed(self, piece: str, last: bool = False) -> Iterator[tuple[int, int, str]]:
        """(section, place in it, text) of what is certain by now."""
        rest = self.tail + piece
        while self.wanted and (found := rest.find(self.wanted[0][0])) >= 0:
            sentinel, section = self.wanted.pop(0)
            yield from self._text(rest[:found])
            rest, self.section, self.at = rest[found + len(sentinel) :], section, 0
        held = 0 if last or not self.wanted else min(len(rest), len(self.wanted[0][0]) - 1)
        self.tail = rest[len(rest) - held :]
        yield from self._text(rest[: len(rest) - held])

    def _text(self, text: str) -> Iterator[tuple[int, int, str]]:
        if text:
            yield self.section, self.at, text
            self.at += len(text)
            self.size[self.section] += len(text)


def pieces(df: DataFrame, id: str = "doc_id", text: str = "text", seed: str = "1", fim_percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """(row, at, piece, id, n): the output of every row in pieces, in any order.

    ``row`` is the row's number; ``at`` the piece's place in the output in code points; a row with ``at`` = -1 names form, id and n.
    """
    given = df.select(F.monotonically_increasing_id().alias("row"), F.col(quoted([id])[0]).cast("long").alias("id"), F.coalesce(F.col(quoted([text])[0]).cast("string"), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Batches(PIECES)
        for batch in batches:
            for part, texts in blocks(batch, "__text"):
                for row, doc, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts):
                    form, a, b = plan(doc, t, seed, fim_percent, spm_percent)
                    yield from out.add(row, -1, form, doc, len(t))
                    for at, piece in cut(t, form, a, b):
                        yield from out.add(row, at, piece, None, None)
        yield from out.end()

    return given.mapInArrow(run, PIECES)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):  # Python values of a slice only
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 1024).columns))


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in output order to pieces by section; a row of section -1 has the document's facts and the digest of its output."""
    out = _Batches(SECTIONS)
    head, digest, reader = None, None, None

    def close() -> Iterator[pa.RecordBatch]:
        row, form, doc, n = head
        for section, at, text in reader.feed("", last=True):
            yield from out.add(row, section, at, text, None, None, None, None, None, None)
        sizes = (None, None) if form == "plain" else (reader.size[PREFIX], reader.size[MIDDLE])
        yield from out.add(row, -1, 0, None, doc, n, form, *sizes, digest.hexdigest())

    for row, at, piece, doc, n in _rows(batches):
        if at == -1:
            if head is not None:
                yield from close()
            head, digest, reader = (row, piece, doc, n), hashlib.sha256(), Reader(piece)
            continue
        digest.update(piece.encode())
        for section, place, text in reader.feed(piece):
            yield from out.add(row, section, place, text, None, None, None, None, None, None)
    if head is not None:
        yield from close()
    yield from out.end()


def _restored(batches: Iterator[pa.RecordBatch], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Pieces in the order of the restored text to one row a document."""
    out = _Batches(schema)
    facts, digest = None, None
    for row, section, _, piece, *rest in _rows(batches):
        if section == -1:
            if facts is not None:
                yield from out.add(*facts, digest.hexdigest())
            facts, digest = rest, hashlib.sha256()
        else:
            digest.update(piece.encode())
    if facts is not None:
        yield from out.add(*facts, digest.hexdigest())
    yield from out.end()


def in_output_order(emitted: DataFrame) -> DataFrame:
    """Pieces dealt out by document, each partition sorted by document and output position."""
    return emitted.repartition("row").sortWithinPartitions("row", "at")


def transform(df: DataFrame, id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every row.

    n, prefix_chars and middle_chars count code points; the latter two are null for plain texts.  Null texts are empty; empty texts are
    plain; a null id counts as an empty string and stays null; repeated rows stay and get the same result; an empty table gives an
    empty result; other columns aren't read.  Texts of any length are streamed in pieces.
    """
    final = T.StructType([*(f for f in SECTIONS.fields if f.name not in ("row", "section", "at", "piece")), T.StructField("restored_sha256", T.StringType())])
    ordered = in_output_order(pieces(df, id, text, **settings))
    sections = ordered.mapInArrow(_assembled, SECTIONS).sortWithinPartitions("row", "section", "at")
    return sections.mapInArrow(lambda b: _restored(b, final), final).withColumnRenamed("id", id)


def texts(df: DataFrame, id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """(id, form, output): the transformed texts, each joined from its pieces in output order (a task holds one output at a time)."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("form", T.StringType()), T.StructField("output", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, head, held = _Batches(schema), None, []
        for _, at, piece, doc, _ in _rows(batches):
            if at == -1:
                if head is not None:
                    yield from out.add(*head, "".join(held))
                head, held = (doc, piece), []
            else:
                held.append(piece)
        if head is not None:
            yield from out.add(*head, "".join(held))
        yield from out.end()

    return in_output_order(pieces(df, id, text, **settings)).mapInArrow(run, schema).withColumnRenamed("id", id)
