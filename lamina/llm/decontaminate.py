"""Benchmark decontamination with DataFrame functions only.

Words: runs of letters, digits and non-ASCII letters, A-Z lower-cased.  A window is ``n`` consecutive words of a benchmark item; an
item of fewer words, but not none, is one window.  The windows form a set keyed by the hash of their first words, which is broadcast while
its measured size stays under ``broadcast_bytes``; beyond, windows and the words at each place are shuffled by the hash of the whole window.  Each position of a training text gives the hash of the words
that start there, a probe keeps the few positions whose hash is listed, and all words of the window are then compared, so the result is
exact.  Only positions that hit leave the scan; they are gathered per document before the shuffle.  A window names its items by the number
of their list; lists are looked up once for each list of a document, so a passage that stands in every item is carried as a number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import adds, quoted
from lamina.session import cut_lineage

# The letters of a word (before A-Z are lower-cased): all but the other ASCII characters, frequent ones first.
WORD = r"[a-z\x{80}-\x{10FFFF}A-Z0-9]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


HEAD = 3  # words of a window that are hashed


def words(text: Column) -> Column:
    """Words of a text as they stand."""
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD), F.lit(0))


def lowered(found: Column) -> Column:
    """Words with A-Z lower-cased."""
    return F.transform(found, lambda w: F.translate(w, UPPER, LOWER))


def windows(items: DataFrame, n: int = 13, id: str = "item_id", text: str = "text") -> DataFrame:
    """(key, words, coarse, items): the distinct windows of all items with the ids of their items."""
    at = items.select(F.col(quoted([id])[0]).alias("item"), lowered(words(F.col(quoted([text])[0]))).alias("w")).where("size(w) > 0")
    each = at.select("item", F.explode(F.expr(f"transform(sequence(1, greatest(size(w) - {n - 1}, 1)), i -> slice(w, i, {n}))")).alias("words"))
    grouped = each.groupBy("words").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    return grouped.withColumn("coarse", F.transform("words", F.lower)).select(_key(F.least(F.size("words"), F.lit(HEAD)), "coarse", F.lit(0)).alias("key"), "words", "coarse", "items")


def _key(length: Column, array: str, start: Column) -> Column:
    """Hash of the first ``length`` words from ``start`` on (HEAD at most).

    The words in ``array`` are lower-cased in full, which is quick and only coarser than A-Z: the words of a hit are compared exactly.
    """
    return F.xxhash64(length, *(F.when(length > i, F.get(array, start + i)) for i in range(HEAD)))


def _is_small(listed: DataFrame, limit: int) -> bool:
    size = listed.select(F.sum(2 * F.octet_length(F.concat_ws("", "words")) + 32 * F.size("words") + 64)).first()[0]
    return (size or 0) <= limit


def _numbered(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The windows with the number of their list of items (key, words, coarse, list), and the lists (list, items), both written."""
    found = cut_lineage(found)
    lists = cut_lineage(found.select("items").distinct().withColumn("list", F.monotonically_increasing_id()))
    return cut_lineage(found.join(lists, "items").drop("items")), lists


def _shuffled(places: DataFrame, listed: DataFrame) -> DataFrame:
    """(id, __hash, pos, own, words, list) of the places that hold a window, by a merge join on the hash of the whole window.

    Only the words at a place travel, not its text, and places that share frequent first words only don't meet.
    """
    lengths = sorted(r[0] for r in listed.select(F.size("words")).distinct().collect())
    sized = places.withColumn("n", F.explode(F.array(*(F.lit(k) for k in lengths)))).where("pos + n <= size(low)")
    keyed = sized.select("id", "__hash", "pos", F.expr("xxhash64(slice(low, pos + 1, n))").alias("key"), F.expr("slice(w, pos + 1, n)").alias("own"))
    return keyed.join(listed.select(F.xxhash64("coarse").alias("key"), "words", "list").hint("merge"), "key").where(lowered(F.col("own")) == F.col("words"))


def hits(docs: DataFrame, items: DataFrame, n: int = 13, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
         broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(id, __hash, spans, item_ids) of the documents that hold a window.

    ``spans`` are disjoint word ranges (start from 0, end) in order, ``item_ids`` the items, sorted as strings.  Rows that share id and
    text share a row here.
    """
    listed, lists = _numbered(windows(items, n, item_id, item_text))
    lengths = sorted(r[0] for r in listed.select(F.least(F.size("words"), F.lit(HEAD))).distinct().collect())  # 1 to HEAD
    key_of = F.col(quoted([id])[0])
    if not lengths:
        return docs.select(key_of.alias("id"), F.lit(0).cast("long").alias("__hash"), F.expr("CAST(array() AS array<struct<start:int,end:int>>)").alias("spans"), F.expr("CAST(array() AS array<string>)").alias("item_ids")).where("false")
    plain = F.coalesce(F.col(quoted([text])[0]).cast("string"), F.lit(""))
    split = docs.select(key_of.alias("id"), F.xxhash64(plain).alias("__hash"), words(plain).alias("w")).withColumn("low", F.transform("w", F.lower))
    places = split.select("id", "__hash", "w", "low", F.posexplode("low").alias("pos", "word"))
    if _is_small(listed, broadcast_bytes):
        if lengths == [HEAD]:
            key = F.xxhash64(F.lit(HEAD), F.col("word"), *(F.get("low", F.col("pos") + i) for i in range(1, HEAD)))
            keyed = places.select("id", "__hash", "w", "low", "pos", key.alias("key"))
        else:
            keyed = places.withColumn("head", F.explode(F.array(*(F.lit(k) for k in lengths)))).select("id", "__hash", "w", "low", "pos", _key(F.col("head"), "low", F.col("pos")).alias("key"))
        # all of this stays in generated code (no lambdas), so the words of a text are never copied for a place that doesn't hit
        near = keyed.join(F.broadcast(listed), "key").where("slice(low, pos + 1, size(coarse)) = coarse").withColumn("own", F.expr("slice(w, pos + 1, size(words))"))
    else:
        near = _shuffled(places, listed)
    place = F.struct(F.col("pos").alias("start"), F.expr("pos + size(words)").alias("end"), "own", "words", "list")
    gathered = near.groupBy("id", "__hash").agg(F.collect_set(place).alias("near"))
    exact = F.filter("near", lambda x: lowered(x["own"]) == x["words"])
    at = F.flatten(F.transform("near", lambda x: F.sequence(x["start"], x["end"] - 1)))
    held = gathered.withColumn("near", exact).where("size(near) > 0").select("id", "__hash", F.array_sort(F.array_distinct(at)).alias("at"), F.array_distinct(F.transform("near", lambda x: x["list"])).alias("lists"))
    # a range starts at a hit word behind one that isn't, and ends before the next that isn't
    starts, ends = "filter(at, (x, i) -> i = 0 OR get(at, i - 1) < x - 1)", "filter(at, (x, i) -> i = size(at) - 1 OR get(at, i + 1) > x + 1)"
    spans = F.expr(f"zip_with({starts}, {ends}, (a, b) -> named_struct('start', a, 'end', b + 1))")
    each = held.select("id", "__hash", spans.alias("spans"), F.explode("lists").alias("list"))
    size = lists.select(F.sum(F.octet_length(F.concat_ws("", "items")) + 16 * F.size("items") + 64)).first()[0]
    named = each.join(F.broadcast(lists) if (size or 0) <= broadcast_bytes else lists.hint("merge"), "list")
    return named.groupBy("id", "__hash").agg(F.any_value("spans").alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"))


def mark(docs: DataFrame, items: DataFrame, n: int = 13, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
         hit_share: int = 20, keep_text: bool = True, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """``docs`` with n_words, n_hit, spans, item_ids and contaminated (``hit_share * n_hit >= n_words`` with a hit).

    Null and empty texts have no words and no hits; an empty benchmark hits nothing; items without words are no windows; repeated rows
    stay and get the same marks; the words of an item without an id hit, but name no item; columns of ``docs`` with the added names give way.  With ``keep_text=False`` the text is left out
    before rows are shuffled.
    """
    found = hits(docs, items, n, id, text, item_id, item_text, broadcast_bytes)
    kept = [c for c in adds(docs, "n_words", "n_hit", "spans", "item_ids", "contaminated") if keep_text or c.lower() != text.lower()]
    plain = F.coalesce(F.col(quoted([text])[0]).cast("string"), F.lit(""))
    rows = docs.select(*quoted(kept), F.col(quoted([id])[0]).alias("__id"), F.xxhash64(plain).alias("__own"), F.size(words(plain)).cast("long").alias("n_words"))
    joined = rows.join(found, F.col("__id").eqNullSafe(F.col("id")) & (F.col("__own") == F.col("__hash")), "left") if "id" not in [c.lower() for c in kept] else rows.join(
        found.withColumnRenamed("id", "__fid"), F.col("__id").eqNullSafe(F.col("__fid")) & (F.col("__own") == F.col("__hash")), "left")
    n_hit = F.coalesce(F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)"), F.lit(0).cast("long"))
    out = joined.select(*quoted(kept), "n_words", n_hit.alias("n_hit"), "spans", F.coalesce("item_ids", F.expr("CAST(array() AS array<string>)")).alias("item_ids"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (hit_share * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """``docs`` without the contaminated ones; all others stay as they are."""
    return mark(docs, items, **settings).where("NOT contaminated").select(*quoted(docs.columns))


def cut_spans(docs: DataFrame, items: DataFrame, text: str = "text", mask: str = " ", **settings) -> DataFrame:
    """``docs`` with the hit words, and what stands between them, replaced by ``mask``; texts without a hit are untouched."""
    marked = mark(docs, items, text=text, **settings)
    t = quoted([text])[0]
    gaps = F.split(F.col(t), WORD, -1)
    own = F.regexp_extract_all(F.col(t), F.lit(WORD), F.lit(0))
    rows = marked.withColumn("__g", F.when(F.col("n_hit") > 0, gaps)).withColumn("__w", F.when(F.col("n_hit") > 0, own))
    inside = "exists(spans, s -> i >= s.start AND i < s.end)"
    first = "exists(spans, s -> i = s.start)"
    glued = "exists(spans, s -> i > s.start AND i < s.end)"
    body = F.expr(f"array_join(transform(sequence(0, size(__w) - 1), i -> concat(CASE WHEN {glued} THEN '' ELSE __g[i] END, CASE WHEN {first} THEN '{mask}' WHEN {inside} THEN '' ELSE __w[i] END)), '')")
    return rows.withColumn(text, F.when(F.col("n_hit") > 0, F.concat(body, F.element_at("__g", -1))).otherwise(F.col(t))).select(*quoted(docs.columns))
