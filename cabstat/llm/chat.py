"""Chat formatting in budgeted windows. DataFrame functions only.

A conversation's turns are rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``.
``&``, ``<`` and ``[`` are escaped inside texts and roles (in roles the line
feed too), so no control string can occur in them, and unescaping restores
them. Prefix sums of turn tokens cut the turns after the leading system turn
into turn-aligned spans: a span takes turns as long as they end within one
share of the budget. A window is the system turn, as many last turns before its
span as fit both the history budget and what system turn and span leave of the
budget, then the span. A window is longer than the budget only where the system
turn and a single turn of its own are. Only assistant texts of the span carry
loss; a repeated turn never does, so each assistant text is a target once.

Defined results: null text counts as empty, null role as the empty role; turns
that tie are ordered by role, then text; repeated rows are repeated turns; a
turn longer than the budget is kept whole and makes a longer window; rows with
a null conv_id form one conversation; an empty table gives an empty result;
extra columns are ignored. A conversation is one row while it is cut: its own
turns must fit a task's memory, as any whole-conversation digest demands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .pii import _running
from .quality import let

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
BUDGET, HISTORY = 512, 128
#: Character references used by the escapes, undone in reverse order.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
LINE = ("\n", "&#10;")


def escape(c: Column, role: bool = False) -> Column:
    for raw, ref in ESCAPES + ((LINE,) if role else ()):
        c = F.replace(c, F.lit(raw), F.lit(ref))
    return c


def unescape(c: Column, role: bool = False) -> Column:
    for raw, ref in reversed(ESCAPES + ((LINE,) if role else ())):
        c = F.replace(c, F.lit(ref), F.lit(raw))
    return c


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY,
            tokens: str | None = None) -> DataFrame:
    """Per window: conv_id, window, text, n_repeated (leading turns that were shown
    before) and loss: code-point spans (start, end) of the text under the mask.

    ``history`` must not exceed half the budget. ``tokens``: a column with each turn's tokens as
    formatted; without, or where it is null, a turn counts four and one for every four
    characters of its escaped text.
    """
    if not 0 <= history <= budget // 2:
        raise ValueError("history must be between 0 and half the budget")
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    head = F.concat(F.lit(OPEN), escape(role, True), F.lit("\n"))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"),
                    F.concat(head, escape(text), F.lit(CLOSE)).alias("piece"),
                    F.char_length(head).alias("head"),
                    F.coalesce(*([F.greatest(F.col(tokens), F.lit(1))] if tokens else []),
                               F.ceil(F.char_length(escape(text)) / 4) + 4).cast("long").alias("tokens"))
    turns = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns"))
    led = F.get("turns", F.lit(0))["role"] == "system"
    own = turns.select(
        "conv_id", F.when(led, F.slice("turns", 1, 1)).otherwise(F.slice("turns", 1, 0)).alias("sys"),
        F.when(led, F.slice("turns", F.lit(2), F.size("turns"))).otherwise(F.col("turns")).alias("rest"))
    spent = F.aggregate("sys", F.lit(0).cast("long"), lambda a, t: a + t["tokens"])
    room = F.lit(budget) - spent
    share = F.greatest(room - history, F.least(F.lit(history), room), F.lit(1)).alias("share")
    placed = own.select("conv_id", "sys", "rest", room.alias("room"), share, _running(
        F.transform("rest", lambda t: t["tokens"].cast("int"))).alias("before"))
    first = F.struct(F.array(F.lit(0)).alias("starts"), F.lit(0).alias("base"))
    # k turns end at before[k]; a turn that ends past its span's share starts the next span
    step = lambda a, k: F.when(
        F.get("before", k + 1) - a["base"] > F.col("share"),
        F.struct(F.concat(a["starts"], F.array(k)).alias("starts"), F.get("before", k).alias("base"))).otherwise(a)
    later = F.filter(F.sequence(F.lit(0), F.size("rest")), lambda k: (k > 0) & (k < F.size("rest")))
    starts = F.aggregate(later, first, step, lambda a: a["starts"])
    spans = placed.withColumn("starts", starts)

    def window(s, k):
        before = F.greatest(s - history, F.lit(0))  # every turn has tokens
        stop = F.coalesce(F.get("starts", k + 1), F.size("rest"))
        left = F.least(F.lit(history), F.col("room") - F.get("before", stop) + F.get("before", s))
        past = F.filter(F.transform(
            F.slice("rest", before + 1, s - before), lambda t, j: F.when(
                F.get("before", s) - F.get("before", before + j) <= left, t)), lambda t: t.isNotNull())
        return let(past, lambda p: F.struct(
            k.alias("window"), F.when(k == 0, F.lit(0)).otherwise(F.size("sys") + F.size(p)).alias("n_repeated"),
            F.concat(F.col("sys"), p, F.slice("rest", s + 1, stop - s)).alias("shown")))

    rows = spans.select("conv_id", F.explode(F.transform("starts", window)).alias("w")).select("conv_id", "w.*")
    rows = rows.withColumn("at", _running(F.transform("shown", lambda t: F.char_length(t["piece"]))))
    target = lambda t, k: F.when((t["role"] == "assistant") & (k >= F.col("n_repeated")), F.struct(
        (F.get("at", k) + t["head"]).alias("start"), (F.get("at", k + 1) - len(CLOSE)).alias("end")))
    return rows.select(
        "conv_id", "window", "n_repeated", F.array_join(F.transform("shown", lambda t: t["piece"]), "").alias("text"),
        F.filter(F.transform("shown", target), lambda x: x.isNotNull()).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, parsed from the windows' texts and masks alone: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows."""
    pattern = F.lit(r"<\|im_start\|>([^\n<]*+)\n([^<]*+)<\|im_end\|>\n")
    parsed = F.zip_with(F.regexp_extract_all("text", pattern, F.lit(1)),
                        F.regexp_extract_all("text", pattern, F.lit(2)),
                        lambda r, t: F.concat(unescape(r, True), F.lit("\n"), unescape(t), F.lit("\n")))
    fresh = F.slice(parsed, F.col("n_repeated") + 1, F.size(parsed))
    under = F.array_join(F.transform("loss", lambda x: unescape(
        F.substring("text", x["start"] + 1, x["end"] - x["start"]))), "")
    each = formatted.select(
        "conv_id", "window", F.char_length("text").cast("long").alias("chars"), F.size(fresh).alias("n"),
        F.array_join(fresh, "").alias("turns"), under.alias("loss"))
    whole = each.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.count("*").alias("n_windows"),
        F.sort_array(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"))
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join("w.turns", ""), 256).alias("turns_sha256"),
        F.char_length(F.array_join("w.loss", "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join("w.loss", ""), 256).alias("loss_sha256"), "formatted_chars", "n_windows")
