"""Conversations formatted into windows of a bounded number of tokens.

Prefix sums of the turns' tokens choose the spans: the axis of tokens is cut into strides, turns that lie
inside one stride form a window, and the turn that runs over a stride's end forms one of its own. So
where a turn goes depends on its prefix sum alone, and a conversation of any length is spread over tasks. Every
window begins with the conversation's system turn, then repeats earlier turns as far as the limit
allows, then has its own turns. The loss mask covers the assistant's own turns, never repeated ones, so
each is learnt once.

A turn is written as ``<|turn|>role, newline, text, <|end|>, newline``. Control strings inside texts get a
backslash after their first character, one more than they had.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.ranking import running_totals
from millrace.session import materialize

BEGIN, END = "<|turn|>", "<|end|>"
# Control strings of this and of other templates, none of which may appear inside a text.
CONTROL = (BEGIN, END, "<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
SYSTEM, ASSISTANT = "system", "assistant"
BUDGET, HISTORY = 1024, 256
# Tokens that the marks around a turn take.
MARKS = 4
# A run of letters, a digit, or any other visible character counts as a token.
TOKEN = r"[A-Za-z]+|[0-9]|[^ \t\n\r\f\x0BA-Za-z0-9]"
_LATER = "|".join(re.escape(c[1:]) for c in CONTROL)
ESCAPED, UNESCAPED = rf"([<\[])(\\*)({_LATER})", rf"([<\[])\\(\\*)({_LATER})"
# In roles these are written out, as a role must not hold a newline.
_ROLE = (("\\", "\\0"), ("\n", "\\1"), ("<", "\\2"), ("[", "\\3"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    for plain, written in _ROLE:
        role = F.replace(role, F.lit(plain), F.lit(written))
    return role


def unescape_role(role: Column) -> Column:
    for plain, written in reversed(_ROLE):
        role = F.replace(role, F.lit(written), F.lit(plain))
    return role


def count_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN)).cast("bigint")


def placed_turns(turns: DataFrame, tokens: Callable[[Column], Column] = count_tokens) -> DataFrame:
    """Turns with their place in the conversation, cost in tokens, and the cost of those before them.

    The conversation's order is by turn, then role, then the SHA-256 of the text; equal rows are turns of their own.
    """
    rows = materialize(turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).withColumns({
            "digest": F.sha2("text", 256), "one": F.lit(1).cast("bigint"),
            "cost": tokens(F.col("role")) + tokens(F.col("text")) + MARKS,
            # Only tells equal rows apart, so it need not be the same in another run.
            "copy": F.monotonically_increasing_id()}), "turns")
    order = ["turn", "role", "digest", "copy"]
    return running_totals(rows, ["conv_id"], order, ["cost", "one"]).select(
        "conv_id", "role", "text", "cost", F.col("before_cost").alias("before"),
        F.col("before_one").alias("place"))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY,
            tokens: Callable[[Column], Column] = count_tokens) -> DataFrame:
    """One row per window: ``conv_id``, ``window`` (rising, with gaps), ``formatted``, ``loss`` (an array of
    ``start`` and ``length`` in code points), ``repeated`` (leading turns that are not the window's own),
    ``own`` turns, ``tokens``, ``over_budget``.

    ``turns`` has conv_id, turn, role, text; other columns are ignored, a missing role or text is empty, and rows
    without conv_id form a conversation. The first turn is retained if its role is system. A turn is never cut: one too
    large for the budget gets a window that says so. A conversation of a system turn alone is one window.
    """
    rows = materialize(placed_turns(turns, tokens), "placed-turns")
    is_system = (F.col("place") == 0) & (F.col("role") == SYSTEM)
    system = rows.where(is_system).select(
        F.col("conv_id").alias("of"), F.col("cost").alias("system_cost"),
        F.col("role").alias("system_role"), F.col("text").alias("system_text"))

    def same(left: Column, right: Column) -> Column:
        return left.eqNullSafe(right)

    costs = system.select("of", "system_cost")
    stride = F.greatest(F.lit(budget - history) - F.col("system_cost"), F.lit(1).cast("bigint"))
    spread = rows.where(~is_system).join(costs, same(F.col("conv_id"), F.col("of")), "left").withColumn(
        "system_cost", F.coalesce("system_cost", F.lit(0).cast("bigint"))).withColumns({
            "from": F.col("before") - F.col("system_cost"), "stride": stride}).withColumn(
        "bucket", F.expr("`from` div stride")).withColumn(
        "window", 2 * F.col("bucket")
        + F.when(F.col("from") % F.col("stride") + F.col("cost") <= F.col("stride"), 0).otherwise(1)) \
        .select("conv_id", "role", "text", "cost", "place", "from", "stride", "bucket", "window", "system_cost")
    spans = materialize(spread.groupBy("conv_id", "window").agg(
        F.min("from").alias("begins"), F.sum("cost").alias("span"),
        F.first("system_cost").alias("system_cost")).withColumn(
            "room", F.greatest(F.lit(0), F.least(
                F.lit(history), F.lit(budget) - F.col("system_cost") - F.col("span")))), "spans")

    own = spread.select("conv_id", "window", "place", "role", "text", "cost", F.lit(True).alias("new"))
    # A turn can be repeated only by windows that begin within the history's reach of it.
    reach = F.expr(f"sequence(2 * bucket, 2 * ((`from` + {history}) div stride) + 1)")
    asked = spread.select("conv_id", "role", "text", "cost", "place", "from", F.explode(reach).alias("window"))
    heads = spans.select(F.col("conv_id").alias("of"), F.col("window").alias("at"), "begins", "room")
    earlier = asked.join(heads, same(F.col("conv_id"), F.col("of")) & (F.col("window") == F.col("at"))
                         & (F.col("from") < F.col("begins"))
                         & (F.col("begins") - F.col("from") <= F.col("room"))) \
        .select("conv_id", "window", "place", "role", "text", "cost", F.lit(False).alias("new"))
    firsts = spans.groupBy("conv_id").agg(F.min("window").alias("first"))
    whose = spans.select("conv_id", "window").join(
        firsts.withColumnRenamed("conv_id", "of"), same(F.col("conv_id"), F.col("of"))) \
        .select(F.col("conv_id").alias("owner"), "window", (F.col("window") == F.col("first")).alias("new"))
    retained = system.join(whose, same(F.col("of"), F.col("owner")), "left").select(
        F.col("of").alias("conv_id"), F.coalesce("window", F.lit(0).cast("bigint")).alias("window"),
        F.lit(-1).cast("bigint").alias("place"), F.col("system_role").alias("role"),
        F.col("system_text").alias("text"), F.col("system_cost").alias("cost"),
        F.coalesce("new", F.lit(True)).alias("new"))

    head = F.concat(F.lit(BEGIN), escape_role(F.col("role")), F.lit("\n"))
    blocks = own.unionByName(earlier).unionByName(retained).select(
        "conv_id", "window", "place", "cost", "new", "role", head.alias("head"), escape(F.col("text")).alias("body")) \
        .withColumn("block", F.concat("head", "body", F.lit(END + "\n")))
    before = Window.partitionBy("conv_id", "window").orderBy("place").rowsBetween(
        Window.unboundedPreceding, -1)
    learnt = F.col("new") & (F.col("role") == ASSISTANT) & (F.length("body") > 0)
    marked = blocks.withColumn("offset", F.coalesce(F.sum(F.length("block")).over(before), F.lit(0))).withColumn(
        "span", F.when(learnt, F.struct((F.col("offset") + F.length("head")).alias("start"),
                                        F.length("body").cast("bigint").alias("length"))))
    # A window's turns are as few as its budget allows.
    gathered = marked.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(F.struct("place", "block", "span"))).alias("parts"),
        F.count_if(~F.col("new")).alias("repeated"), F.count_if("new").alias("own"),
        F.sum("cost").alias("tokens"))
    return gathered.select(
        "conv_id", "window",
        F.array_join(F.transform("parts", lambda p: p["block"]), "").alias("formatted"),
        F.filter(F.transform("parts", lambda p: p["span"]), lambda s: s.isNotNull()).alias("loss"),
        "repeated", "own", "tokens", (F.col("tokens") > budget).alias("over_budget"))


def read_back(formatted: Column) -> Column:
    """The turns in a formatted window: an array of ``role`` and ``text``."""
    turn = F.lit(rf"(?s)\Q{BEGIN}\E(.*?)\n(.*?)\Q{END}\E\n")
    return F.zip_with(
        F.regexp_extract_all(formatted, turn, 1), F.regexp_extract_all(formatted, turn, 2),
        lambda role, text: F.struct(unescape_role(role).alias("role"), unescape(text).alias("text")))


def under_mask(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, in order."""
    return F.transform(loss, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
