"""Chat formatting in budgeted windows.

The turns of a conversation get prefix sums of their tokens. The line of these sums is cut into
cells of what the budget leaves beside the system turn and the history: turns inside a cell make a
window. A turn that crosses cells joins the window before it or else the one after it, where all fits into a cell's
width, and makes a window of its own otherwise. No turn is cut. Each later window repeats the leading system turn
and the last turns of the window before, up to the history's tokens and to what its own turns leave of the budget. So
a window exceeds the budget only where the system turn and one turn do so by themselves. The loss mask holds each
assistant text where it comes first; repeated turns are never in it.

Turns are written as `<turn ROLE>TEXT</turn>`, repeated ones as `<seen ROLE>TEXT</turn>`, with
`&`, `<` and `>` of roles and texts as `&amp;`, `&lt;` and `&gt;`, so a text can hold no marker.

Prefix sums are taken in blocks of turns and then over the blocks, so a very long conversation
is spread over tasks until its windows are put together. The turns with their sums are stored once; windows are
found from the numbers alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.llm.common import words_of
from textmill.runtime import materialize

BUDGET = 1024
HISTORY = 256
#: Tokens of a turn's markers, and turns of a block.
OVERHEAD, BLOCK = 4, 64
LEARNED_ROLE, LEADING_ROLE = "assistant", "system"
_CONV = ["_null", "_id"]
# A conversation that the query adds.
EXTRA_ID = -7
EXTRA_TEXT = r"\### Assistant: </turn> ok"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))


def with_extra(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with the conversation `EXTRA_ID` added."""
    spark: SparkSession = conversations.sparkSession
    role = F.when(F.col("id") == 0, "user").otherwise(LEARNED_ROLE)
    extra = spark.range(2).select(F.lit(EXTRA_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(EXTRA_TEXT).alias("text"))
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(extra)


def _prefix_sums(conversations: DataFrame) -> DataFrame:
    """Turns with `tokens`, `upto` (their sum up to and with the turn) and `lead_tokens` of the system turn."""
    text = F.coalesce("text", F.lit(""))
    turns = conversations.select(
        F.col("conv_id").isNull().alias("_null"),
        F.coalesce("conv_id", F.lit(0)).alias("_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        text.alias("text"),
        (F.size(words_of(text)) + OVERHEAD).cast("long").alias("tokens"),
        F.coalesce(F.expr(f"turn div {BLOCK}"), F.lit(-(2**63)).cast("long")).alias("_block"),
    )
    inside = Window.partitionBy(*_CONV, "_block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*_CONV).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = turns.groupBy(*_CONV, "_block").agg(F.sum("tokens").alias("_sum"))
    blocks = blocks.select(*_CONV, "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    first = turns.groupBy(_CONV).agg(F.min(F.struct("turn", "role", "text", "tokens")).alias("_first"))
    lead = first.select(*_CONV, F.when(F.col("_first.role") == LEADING_ROLE, F.col("_first.tokens")).alias("lead_tokens"))
    summed = turns.withColumn("_in", F.sum("tokens").over(inside)).join(blocks, [*_CONV, "_block"]).join(lead, _CONV)
    return summed.withColumn("upto", F.col("_before") + F.col("_in")).drop("_before", "_in", "_block")


def _joined(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Windows by number with `_to` (the number of the window that takes them in, often their own) and of that window
    `_end` (its last prefix sum), `_next` (the window after it) and `_history` (tokens that one may repeat).

    An odd number is a turn that crosses cells. It joins the even window before it, or else the one after it if that
    has room beside what joins it from behind.
    """
    order = Window.partitionBy(*_CONV).orderBy("window")
    size, window = F.col("_size"), F.col("window")
    cells = turns.groupBy(*_CONV, "window").agg(
        F.sum("tokens").alias("_size"), F.max("upto").alias("_end"), F.first("_room").alias("_room"), F.first("lead_tokens").alias("_lead")
    )
    crossing = window % 2 == 1
    fits_back = crossing & (F.lag(window).over(order) == window - 1) & (F.lag(size).over(order) + size <= F.col("_room"))
    cells = cells.withColumn("_back", F.coalesce(fits_back, F.lit(False)))
    behind = F.when(F.lead("_back", 2).over(order), F.lead(size, 2).over(order)).otherwise(0)
    fits_on = crossing & (F.lead(window).over(order) % 2 == 0) & (size + F.lead(size).over(order) + behind <= F.col("_room"))
    to = F.when(F.col("_back"), window - 1).when(fits_on, F.lead(window).over(order)).otherwise(window)
    cells = cells.withColumn("_to", to)
    whole = Window.partitionBy(*_CONV).orderBy("_to")
    merged = cells.groupBy(*_CONV, "_to").agg(F.collect_list("window").alias("_from"), F.sum("_size").alias("_size"), F.max("_end").alias("_end"), F.first("_lead").alias("_lead"))
    left = F.lit(budget) - F.coalesce("_lead", F.lit(0)) - F.lead("_size").over(whole)
    merged = merged.withColumn("_next", F.lead("_to").over(whole)).withColumn("_history", F.least(F.lit(history), left))
    return merged.select(*_CONV, F.explode("_from").alias("window"), "_to", "_end", "_next", "_history")


def format_conversations(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """`(conv_id, window, text, loss_spans, tokens)`, one row per window.

    Turns are ordered by turn number (null first), then role and text; rows that repeat others are turns of
    their own. Null texts and roles count as empty, a null conv_id is a conversation. `window` numbers rise within a
    conversation, with gaps. `loss_spans` are code points of `text`, ends exclusive. Tokens are words plus the
    markers' overhead. Other columns are not read; an empty table gives no window. A long system turn is repeated in
    every window all the same, and leaves the less room the longer it is; a very long turn is a window of its own.
    """
    turns = _prefix_sums(conversations)
    room = F.greatest(F.lit(budget - history) - F.coalesce("lead_tokens", F.lit(0)), F.lit(1)).alias("_room")
    turns = turns.select(*_CONV, "upto", "tokens", "role", "text", "lead_tokens", room)
    cell, last = F.floor((F.col("upto") - F.col("tokens")) / F.col("_room")), F.floor((F.col("upto") - 1) / F.col("_room"))
    turns = materialize(turns.withColumn("window", 2 * cell + (cell < last).cast("long")), "turns")
    leads = F.col("lead_tokens").isNotNull() & (F.col("upto") == F.col("tokens"))
    windows = _joined(turns, budget, history)
    placed = turns.withColumn("_leads", leads).drop("lead_tokens", "_room").join(windows, [*_CONV, "window"])
    placed = placed.withColumn("window", F.col("_to")).drop("_to")
    again = F.col("_next").isNotNull() & ~F.col("_leads") & (F.col("_end") - F.col("upto") + F.col("tokens") <= F.col("_history"))
    place = lambda window, seen: F.struct(window.alias("window"), F.lit(seen).alias("seen"))
    places = F.when(again, F.array(place(F.col("window"), False), place(F.col("_next"), True)))
    places = places.otherwise(F.array(place(F.col("window"), False)))
    shown = ["upto", "tokens", "role", "text"]
    written = placed.select(*_CONV, *shown, F.explode(places).alias("_place")).select(*_CONV, "_place.*", *shown)
    later = windows.filter("_next IS NOT NULL").select(*_CONV, F.col("_next").alias("window")).distinct()
    lead = turns.filter(leads).select(*_CONV, *shown).join(later, _CONV)
    written = written.unionByName(lead.withColumn("seen", F.lit(True)))

    head = F.concat(F.when(F.col("seen"), "<seen ").otherwise("<turn "), escape(F.col("role")), F.lit(">"))
    written = written.select(*_CONV, "window", "upto", "tokens", head.alias("head"), escape(F.col("text")).alias("body"), ((F.col("role") == LEARNED_ROLE) & ~F.col("seen")).alias("loss"))
    parts = F.sort_array(F.collect_list(F.struct("upto", "head", "body", "loss")))
    grouped = written.groupBy(*_CONV, "window").agg(parts.alias("_parts"), F.sum("tokens").alias("tokens"))
    whole = F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit("</turn>\n")))
    tail = len("</turn>\n")
    empty = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(done: Column, p: Column) -> Column:
        begin = done["at"] + F.char_length(p["head"])
        stop = begin + F.char_length(p["body"])
        span = F.array(F.struct(begin.alias("start"), stop.alias("end")))
        return F.struct((stop + tail).alias("at"), F.when(p["loss"], F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    conv_id = F.when(~F.col("_null"), F.col("_id")).alias("conv_id")
    return grouped.select(conv_id, "window", F.array_join(whole, "").alias("text"), F.aggregate("_parts", empty, add)["spans"].alias("loss_spans"), "tokens")


def read_back(windows: DataFrame) -> DataFrame:
    """`(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)` from formatted windows alone.

    A digest covers a whole conversation, so its unescaped windows meet in one row here.
    """
    pattern = F.lit("<turn ([^>]*)>([^<]*)</turn>\n")
    roles, texts = (F.regexp_extract_all("text", pattern, F.lit(i)) for i in (1, 2))
    read = F.zip_with(roles, texts, lambda r, t: F.concat(unescape(r), F.lit("\n"), unescape(t), F.lit("\n")))
    learned = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])))
    parts = windows.select(
        "conv_id", "window", F.size(roles).alias("_n"), F.array_join(read, "").alias("_turns"), F.array_join(learned, "").alias("_loss"), F.char_length("text").alias("_chars")
    )
    ordered = F.sort_array(F.collect_list(F.struct("window", "_turns", "_loss")))
    grouped = parts.groupBy("conv_id").agg(F.sum("_n").alias("n_turns"), F.sum("_chars").alias("formatted_chars"), ordered.alias("_parts"))
    turns, loss = F.array_join("_parts._turns", ""), F.array_join("_parts._loss", "")
    return grouped.select(
        "conv_id",
        "n_turns",
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
