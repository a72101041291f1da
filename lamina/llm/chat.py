"""Chat formatting in budgeted windows, with DataFrame functions only.

A conversation's turns are laid on a line by the prefix sums of their tokens and cut into turn-aligned spans.  The room of a span is the
budget less the history and the system turn, so a window, which is the system turn, up to ``history`` tokens of the last turns of the
span before, and the span's own turns, never exceeds the budget.  The line has cells as long as the room: the turns that lie in a cell
form a span; a turn that reaches over the end of its cell joins the turns of the next one where both fit the room, else it is a span of
its own.  Only a turn longer than the room is longer than it: it stands alone, with the system turn if the budget holds both.  What is
repeated carries no loss, so every assistant turn is a target exactly once; the loss mask is a list of character ranges.

Prefix sums are added up in two steps (chunks of turns, then the chunks' totals), so a conversation of any length is summed by many
tasks; spans, merges and neighbours are found by joins on positions, from a written table without texts.  Only a window is ever gathered
into one row.

Format of a turn: ``<s>[INST]role[/INST]text</s>``.  Inside roles and texts a backslash is doubled and a control string gets a backslash
behind its first letter, so control strings mark nothing but turns, and ``unescaped`` gives back every text exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.common import quoted
from lamina.session import cut_lineage

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
CHUNK = 256  # turns that are summed together


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def tokens(text: Column) -> Column:
    """Estimate of a turn's tokens: a quarter of its UTF-8 bytes, rounded up, and 4 for its marks."""
    return (F.ceil(F.octet_length(text) / 4) + 4).cast("long")


def laid_out(df: DataFrame, budget: int, history: int, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, k, role, text, tok, sys, is_sys, p): turns in order with the tokens before them.

    ``sys`` has the tokens of the conversation's system turn if it is retained (0 else); that turn is no part of the sums.
    """
    rows = df.select(F.col(quoted([conv])[0]).alias("conv"), F.col(quoted([turn])[0]).alias("turn"), F.coalesce(F.col(quoted([role])[0]), F.lit("")).alias("role"), F.coalesce(F.col(quoted([text])[0]), F.lit("")).alias("text"))
    chunk = F.coalesce(F.floor(F.col("turn") / CHUNK).cast("long"), F.lit(-(1 << 62)))
    rows = rows.withColumn("tok", tokens(F.col("text"))).withColumn("chunk", chunk)
    in_chunk = Window.partitionBy("conv", "chunk").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chunks = rows.groupBy("conv", "chunk").agg(F.sum("tok").alias("t"), F.count("*").alias("c"), F.min_by(F.struct("role", "tok"), F.struct("turn", "role", "text")).alias("head"))
    line = Window.partitionBy("conv").orderBy("chunk")
    before, so_far = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = F.first("head").over(so_far)
    # a longer system turn is an ordinary turn: it would leave no room for others
    starts = chunks.select(F.col("conv").alias("c_conv"), F.col("chunk").alias("c_chunk"), F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("n0"),
                           F.when((head["role"] == "system") & (head["tok"] <= budget // 2 - history), head["tok"]).otherwise(0).alias("sys"))
    summed = rows.withColumn("p", F.sum("tok").over(in_chunk) - F.col("tok")).withColumn("k", F.count("*").over(in_chunk))
    placed = summed.join(starts, F.col("conv").eqNullSafe(F.col("c_conv")) & (F.col("chunk") == F.col("c_chunk")))
    k = F.col("n0") + F.col("k")
    return placed.select("conv", k.alias("k"), "role", "text", "tok", "sys", ((k == 1) & (F.col("sys") > 0)).alias("is_sys"), F.when(k == 1, 0).otherwise(F.col("t0") + F.col("p") - F.col("sys")).alias("p"))


def _beside(left: DataFrame, right: DataFrame, on: dict[str, str], how: str = "inner") -> DataFrame:
    """Join by conversation (null like any other) and the given columns; ``right`` has the conversation as ``r_conv``."""
    return left.join(right, F.col("conv").eqNullSafe(F.col("r_conv")) & F.expr(" AND ".join(f"{x} = {y}" for x, y in on.items())), how).drop("r_conv")


def dealt(line: DataFrame, budget: int, history: int) -> DataFrame:
    """(conv, k, start, again): the windows of every turn, named by the tokens before their first new turn (-1: the system turn alone)."""
    turns = line.where("NOT is_sys").withColumn("room", F.lit(budget - history) - F.col("sys"))
    turns = turns.withColumn("cell", F.expr("p div room")).withColumn("over", F.expr("p + tok > (cell + 1) * room"))
    units = turns.groupBy("conv", "cell", "over", "room", "sys").agg(F.min("p").alias("first"), F.sum("tok").alias("size"))
    # a turn over the end of its cell joins the turns of the next cell where both fit
    bodies = units.where("NOT over").select(F.col("conv").alias("r_conv"), F.col("first").alias("b_first"), F.col("size").alias("b_size"))
    merged = _beside(units.where("over").withColumn("end", F.expr("first + size")), bodies, {"end": "b_first"}).where("size + b_size <= room")
    lead = merged.select(F.col("conv").alias("r_conv"), F.col("b_first").alias("own"), F.col("first").alias("start"))
    known = _beside(units.withColumnsRenamed({"first": "own0"}), lead, {"own0": "own"}, "left").select(F.col("conv").alias("r_conv"), F.col("cell").alias("r_cell"), F.col("over").alias("r_over"), F.coalesce("start", "own0").alias("start"))
    spanned = cut_lineage(_beside(turns, known, {"cell": "r_cell", "over": "r_over"}).select("conv", "k", "p", "tok", "sys", "room", "start"))
    spans = spanned.groupBy("conv", "start", "sys", "room").agg(F.sum("tok").alias("size")).withColumn("end", F.expr("start + size"))
    follow = spans.select(F.col("conv").alias("r_conv"), F.col("start").alias("r_start"), F.col("size").alias("r_size"))
    after = _beside(spans, follow, {"end": "r_start"}).where("r_size <= room").select(F.col("conv").alias("r_conv"), F.col("start").alias("s"), "end")
    new = spanned.select("conv", "k", "start", F.lit(False).alias("again"))
    repeated = _beside(spanned, after, {"start": "s"}).where(f"end - p <= {history}").select("conv", "k", F.col("end").alias("start"), F.lit(True).alias("again"))
    # the system turn opens the first span, if both fit, and every later one it fits with; else it is a window of its own first
    system = line.where("is_sys").select("conv", "k")
    fits = spans.where(f"sys > 0 AND sys + size <= {budget}").select("conv", F.lit(1).cast("long").alias("k"), "start", (F.col("start") > 0).alias("again"))
    opened = fits.where("start = 0").select(F.col("conv").alias("r_conv"), F.col("k").alias("r_k"))
    alone = system.join(opened, F.col("conv").eqNullSafe(F.col("r_conv")), "left_anti").select("conv", "k", F.lit(-1).cast("long").alias("start"), F.lit(False).alias("again"))
    return cut_lineage(new.union(repeated).union(fits).union(alone))


def windows(df: DataFrame, budget: int = 512, history: int = 128, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, window, formatted, n_repeated, n_turns, n_tokens, loss): one row per window; their order is that of ``window``, the
    number of tokens before the window's first new turn.

    ``n_repeated`` leading turns of ``formatted`` stand in an earlier window; ``loss`` are its disjoint character ranges (from 0, end
    excluded) under the loss mask; ``n_tokens`` is at most ``budget`` unless the window is one longer turn.  Null texts and roles are
    empty; turns are ordered by turn, role and text (null first), repeated rows stay; rows with a null conversation id form one
    conversation.  The system turn is the first turn, if its role is 'system'; it is retained if it takes at most half the budget less the
    history, else it is a turn like others.  An empty table gives no windows; other columns aren't read.
    """
    if not 0 <= 4 * history <= budget:
        raise ValueError("the history is at most a quarter of the budget")
    line = laid_out(df, budget, history, conv, turn, role, text)
    where = dealt(cut_lineage(line.drop("role", "text")), budget, history)
    turns = line.select("conv", "k", "role", "text", "tok").join(where.select(F.col("conv").alias("r_conv"), F.col("k").alias("r_k"), "start", "again"), F.col("conv").eqNullSafe(F.col("r_conv")) & (F.col("k") == F.col("r_k")))
    piece = F.concat(F.lit("<s>[INST]"), escaped(F.col("role")), F.lit("[/INST]"))
    built = turns.select("conv", "start", "tok", F.struct("k", piece.alias("head"), escaped(F.col("text")).alias("body"), (~F.col("again") & (F.col("role") == "assistant")).alias("target"), "again").alias("t"))
    packed = built.groupBy("conv", "start").agg(F.array_sort(F.collect_list("t")).alias("ts"), F.sum("tok").alias("n_tokens"))
    formatted = F.array_join(F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit("</s>"))), "")
    loss = F.expr("""aggregate(ts, named_struct('at', 0, 'loss', CAST(array() AS array<struct<start:int,end:int>>)), (s, t) -> named_struct(
        'at', s.at + char_length(t.head) + char_length(t.body) + 4,
        'loss', CASE WHEN t.target THEN concat(s.loss, array(named_struct('start', s.at + char_length(t.head), 'end', s.at + char_length(t.head) + char_length(t.body)))) ELSE s.loss END)).loss""")
    return packed.select(F.col("conv").alias("conv_id"), F.col("start").alias("window"), formatted.alias("formatted"), F.expr("size(filter(ts, t -> t.again))").alias("n_repeated"), F.size("ts").alias("n_turns"), "n_tokens", loss.alias("loss"))


def parsed(formatted: Column) -> Column:
    """Turns of a formatted text as an array of (role, text), unescaped."""
    pieces = F.filter(F.split(formatted, "</s>", -1), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        unescaped(F.substring(F.substring_index(p, "[/INST]", 1), 10, 1 << 30)).alias("role"), unescaped(F.substring(p, F.instr(p, "[/INST]") + 7, F.lit(1 << 30))).alias("text")))


def read_back(formatted: DataFrame) -> DataFrame:
    """What windows say about their conversations: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    new = F.slice(parsed(F.col("formatted")), F.col("n_repeated") + 1, F.lit(1 << 30))
    rows = formatted.select("conv_id", "window", F.char_length("formatted").alias("chars"), new.alias("new"),
                            unescaped(F.expr("array_join(transform(loss, s -> substring(formatted, s.start + 1, s.end - s.start)), '')")).alias("target"))
    rows = rows.select("conv_id", "chars", F.struct("window", F.size("new").alias("n"), F.expr("array_join(transform(new, t -> concat(t.role, '\\n', t.text, '\\n')), '')").alias("said"), "target").alias("w"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("ws"), F.sum("chars").alias("formatted_chars"))
    target = F.expr("array_join(transform(ws, w -> w.target), '')")
    return whole.select("conv_id", F.expr("aggregate(ws, 0L, (n, w) -> n + w.n)").alias("n_turns"), F.sha2(F.expr("array_join(transform(ws, w -> w.said), '')"), 256).alias("turns_sha256"),
                        F.char_length(target).cast("long").alias("loss_chars"), F.sha2(target, 256).alias("loss_sha256"), "formatted_chars")
