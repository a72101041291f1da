"""License scans as an exact set-similarity join, with DataFrame functions only.

Base labels come from phrases: places where a phrase's words stand one behind the other.  Further labels come from templates, the texts
of notices: a *block* (``width`` consecutive words of a document, a new block every half width, so that whatever is up to half a width
long lies whole in one) holds a template if at least ``percent`` of the template's distinct words are among the block's words.

The join of blocks with templates is exact and compares no block with all templates:

1. The templates' words are counted over all documents and ranked, rarest first.  A block's set is its template words in that order;
   other words can't count towards containment.
2. *Length filter*: a template of s words asks for t = ceil(percent * s / 100) common ones, so a block of fewer than t can't hold it.
3. *Prefix filter*: the first common word of a block of b words and a template of s stands, in this order, among the first s - t + 1 of
   the template and the first b - t + 1 of the block.  Only these prefixes are joined, on the word; the template's side is broadcast while
   its measured size stays under ``broadcast_bytes`` and shuffled beyond.
4. *Positional filter*: words at places i and j leave at most 1 + min(s - 1 - i, b - 1 - j) common ones, which must reach t.
5. What is left is compared in whole.

A document is read and cut into words once; its counts, the template words it holds and the blocks that pass the length filter of the
smallest template are written.  Hits are gathered per document before they are shuffled, by id and hash of the text.  Templates are
worked on in groups of at most ``ROOM`` distinct words (or one template), so the word lists inside expressions stay bounded however many
templates there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm.common import quoted
from lamina.session import cut_lineage

# The letters of a word (before A-Z are lower-cased): all but the other ASCII characters, frequent ones first.
WORD = r"[a-z\x{80}-\x{10FFFF}A-Z0-9]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ROOM = 512  # distinct words of a group of templates

# Phrases of the base labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

# Notices as their authors ask for them to be given.
TEMPLATES = (
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("apache-notice", "Licensed under the Apache License, Version 2.0"),
    ("mit-notice", "Released under the MIT License"),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd-notice", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-notice", "Licensed under CC BY-NC 4.0"),
    ("mpl-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)


def words(text: Column) -> Column:
    """Words of a text as they stand."""
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD), F.lit(0))


def lowered(found: Column) -> Column:
    """Words with A-Z lower-cased (lower() does just that to ASCII words, and quickly)."""
    return F.transform(found, lambda w: F.when(F.octet_length(w) == F.char_length(w), F.lower(w)).otherwise(F.translate(w, UPPER, LOWER)))


def literal(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def places(low: str, phrases: tuple[tuple[str, str], ...]) -> str:
    """SQL: array of (at, label) of the places in the word array ``low`` where a phrase starts, in order."""
    split = [(p.split(), label) for p, label in phrases]
    starts = ", ".join(sorted({literal(p[0]) for p, _ in split}))
    cases = " ".join(f"WHEN slice({low}, i + 1, {len(p)}) = array({', '.join(map(literal, p))}) THEN {literal(label)}" for p, label in split)
    found = f"filter(transform(sequence(0, size({low}) - 1), i -> named_struct('at', CAST(i AS bigint), 'label', CASE WHEN {low}[i] IN ({starts}) THEN CASE {cases} END END)), p -> p.label IS NOT NULL)"
    return f"CASE WHEN size({low}) > 0 THEN {found} END"


def template_table(spark: SparkSession, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """(label, text) rows."""
    rows = ", ".join(f"named_struct('label', {literal(label)}, 'text', {literal(text)})" for label, text in templates)
    return spark.sql(f"SELECT inline(array({rows}))") if templates else spark.sql("SELECT '' AS label, '' AS text").where("false")


def _sets(templates: DataFrame, percent: int) -> DataFrame:
    """(label, tokens, s, t) of the templates that have words and a label; equal sets of a label are one."""
    sets = templates.select(F.col("label").cast("string").alias("label"), F.array_sort(F.array_distinct(lowered(words(F.col("text"))))).alias("tokens")).where("size(tokens) > 0 AND label IS NOT NULL").distinct()
    return sets.select("label", "tokens", F.size("tokens").alias("s"), F.expr(f"CAST((size(tokens) * {percent} + 99) div 100 AS int)").alias("t"))


def _groups(sets: DataFrame, room: int) -> list[tuple[set[str], int]]:
    """(words, least t) of the groups, from one row of a template after the other."""
    groups: list[tuple[set[str], int]] = []
    for r in sets.orderBy("tokens", "label").toLocalIterator():
        if groups and len(groups[-1][0] | set(r.tokens)) <= room:
            groups[-1] = (groups[-1][0] | set(r.tokens), min(groups[-1][1], r.t))
        else:
            groups.append((set(r.tokens), r.t))
    return groups


def _list(tokens) -> str:
    return f"array({', '.join(map(literal, tokens))})"


def cut(docs: DataFrame, groups: list[tuple[set[str], int]], width: int, id: str, text: str, phrases: tuple[tuple[str, str], ...]) -> DataFrame:
    """(id, hash, n_words, places, present, blocks) of every row: the only pass over the texts.

    ``present`` has the template words of the document, an array a group; ``blocks`` are (grp, tokens) with words enough for some
    template of the group.
    """
    plain = F.coalesce(F.col(quoted([text])[0]).cast("string"), F.lit(""))
    rows = docs.select(F.col(quoted([id])[0]).alias("id"), F.xxhash64(plain).alias("hash"), lowered(words(plain)).alias("low"))
    present = [f"array_intersect(low, {_list(sorted(known))})" for known, _ in groups]
    rows = rows.withColumn("present", F.expr(f"array({', '.join(present)})" if groups else "CAST(array() AS array<array<string>>)"))
    hint = f"arrays_overlap(low, {_list(sorted({p.split()[0] for p, _ in phrases}))})"
    step = width // 2
    each = [
        f"CASE WHEN size(present[{g}]) >= {t} THEN filter(transform(sequence(0, CAST(greatest(0, (size(low) - 1) div {step} - 1) AS int)), "
        f"b -> named_struct('grp', {g}, 'tokens', array_intersect(slice(low, b * {step} + 1, {width}), {_list(sorted(known))}))), x -> size(x.tokens) >= {t}) ELSE {NO_BLOCKS} END"
        for g, (known, t) in enumerate(groups)]
    blocks = f"concat({', '.join(each)})" if each else NO_BLOCKS
    found = f"CASE WHEN {hint} THEN {places('low', phrases)} END" if phrases else "CAST(NULL AS array<struct<at:bigint,label:string>>)"
    return rows.select("id", "hash", F.size("low").cast("long").alias("n_words"), F.expr(found).alias("places"), "present", F.expr(blocks).alias("blocks"))


NO_BLOCKS = "CAST(array() AS array<struct<grp:int,tokens:array<string>>>)"


def _is_small(table: DataFrame, limit: int) -> bool:
    size = table.select(F.sum(F.octet_length(F.concat_ws("", "tokens")) + 32 * F.size("tokens") + 64)).first()[0]
    return (size or 0) <= limit


def held(read: DataFrame, sets: DataFrame, groups: list[tuple[set[str], int]], broadcast_bytes: int) -> DataFrame:
    """(id, hash, label, share): the templates that blocks hold, with the largest share of each label a document."""
    # a word's rank decides how much work is done, never the result
    df = read.select(F.explode(F.flatten("present")).alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    count = {r.token: r.df for r in df.toLocalIterator()}  # template words only
    ranked = [sorted(known, key=lambda w: (count.get(w, 0), w)) for known, _ in groups]
    order = "CASE grp " + " ".join(f"WHEN {g} THEN array_intersect({_list(r)}, tokens)" for g, r in enumerate(ranked)) + " END"
    least = "CASE grp " + " ".join(f"WHEN {g} THEN {t}" for g, (_, t) in enumerate(groups)) + " END"
    blocks = read.select("id", "hash", F.explode("blocks").alias("x")).select("id", "hash", F.col("x.grp").alias("grp"), F.col("x.tokens").alias("tokens"))
    blocks = blocks.select("id", "hash", "grp", F.expr(order).alias("own"), F.expr(least).alias("least"))
    prefix = blocks.select("id", "hash", "grp", "own", F.posexplode(F.expr("slice(own, 1, size(own) - least + 1)")).alias("j", "token"))
    # the templates' prefixes, a group after the other
    heads: DataFrame | None = None
    for g in range(len(groups)):  # a template whose words lie in several groups is found in each
        own = sets.select(F.lit(g).alias("grp"), "label", "s", "t", F.expr(f"array_intersect({_list(ranked[g])}, tokens)").alias("tokens")).where("size(tokens) = s")
        heads = own if heads is None else heads.union(own)
    heads = cut_lineage(heads)
    joined = heads.select("grp", "label", "s", "t", "tokens", F.posexplode(F.expr("slice(tokens, 1, s - t + 1)")).alias("i", "token"))
    side = F.broadcast(joined) if _is_small(joined, broadcast_bytes) else joined.hint("merge")
    fits = prefix.join(side, ["grp", "token"]).where("size(own) >= t AND 1 + least(s - 1 - i, size(own) - 1 - j) >= t")
    common = fits.select("id", "hash", "label", "s", "t", F.size(F.array_intersect("own", "tokens")).alias("c")).where("c >= t")
    return common.groupBy("id", "hash", "label").agg(F.max(F.col("c") / F.col("s")).alias("share"))


def scan(docs: DataFrame, templates: DataFrame, percent: int = 90, width: int = 64, id: str = "doc_id", text: str = "text",
         phrases: tuple[tuple[str, str], ...] = PHRASES, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row of ``docs``.

    n_base counts the places of phrases, first_word and last_word are the smallest and largest of their starts (words from 0; else
    null); base_labels and labels are sorted arrays, the latter with the labels of templates (label, text) that some block holds.
    score: 1 with a base label, else the largest share of a template's words in a block that holds it, else 0.

    Null and empty texts have no words, no labels and score 0.  Templates without words or label find nothing; without templates or in
    an empty table only base labels are left.  Rows that share id and text share a result, repeated rows stay, null ids too.  Columns other than ``id`` and
    ``text`` aren't read.  ``width`` is even; texts of any length are cut into blocks in whole.
    """
    sets = cut_lineage(_sets(templates, percent))
    groups = _groups(sets, ROOM)
    read = cut_lineage(cut(docs, groups, width, id, text, phrases))
    rows = read.select(
        "id", "hash", "n_words", F.greatest(F.coalesce(F.size("places"), F.lit(0)), F.lit(0)).cast("long").alias("n_base"), F.expr("array_min(transform(places, p -> p.at))").alias("first_word"),
        F.expr("array_max(transform(places, p -> p.at))").alias("last_word"), F.expr("coalesce(array_sort(array_distinct(transform(places, p -> p.label))), array())").alias("base_labels"))
    if groups:
        found = held(read, sets, groups, broadcast_bytes).groupBy("id", "hash").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
        found = found.withColumnsRenamed({"id": "f_id", "hash": "f_hash"})
        rows = rows.join(found, F.col("id").eqNullSafe(F.col("f_id")) & (F.col("hash") == F.col("f_hash")), "left")
    else:
        rows = rows.withColumn("more", F.expr("CAST(NULL AS array<string>)")).withColumn("share", F.lit(None).cast("double"))
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("more", F.expr("CAST(array() AS array<string>)"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0)))
    return rows.select(F.col("id").alias(id), "n_words", "n_base", "first_word", "last_word", "base_labels", labels.alias("labels"), score.alias("score"))
