"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: the formatted conversation up to
and with that turn, where only that reply is under the loss mask. Turns after the last
assistant turn (or a conversation without one) make one example without a loss.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` a turn. Inside texts and roles ``<|``
gets one backslash between its two characters (``<\\|`` gets a second one, and so on), so
no control string can occur there and one backslash less gives the text back.

Defined results: null text or role is empty; turns of equal number are ordered by role
and text; repeated rows are turns of their own; a null conv_id is a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
TARGET = "assistant"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def escape_role(c: Column) -> Column:
    """Roles end at the first newline: a newline inside becomes backslash + n, a backslash two."""
    return escape(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(c: Column) -> Column:
    """One pass over the parts between pairs of backslashes: in them a backslash + n is a newline."""
    parts = F.split(unescape(c), r"\\\\")
    return F.array_join(F.transform(parts, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, target_turn, formatted, loss_start, loss_length): one row per example.

    target_turn is the reply's place in its conversation (null: nothing to train on);
    the loss span is in code points of ``formatted``.
    """
    turns = (conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                  F.coalesce("text", F.lit("")).alias("text"))
             .groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("_t")))
    turns = turns.withColumn("_body", F.transform("_t", lambda t: escape(t["text"])))
    turns = turns.withColumn("_piece", F.zip_with("_t", "_body", lambda t, b: F.concat(
        F.lit(START), escape_role(t["role"]), F.lit("\n"), b, F.lit(END))))
    turns = turns.withColumn("_is", F.transform("_t", lambda t: t["role"] == TARGET)).withColumn("_reply", F.expr(
        "filter(transform(_is, (x, i) -> if(x, i, -1)), i -> i >= 0)"))
    # the last example reaches the end: add one without a loss where the last turn is no reply
    turns = turns.withColumn("_to", F.when(F.element_at("_is", -1), F.col("_reply")).otherwise(
        F.concat("_reply", F.array(F.size("_t") - 1))))
    one = turns.select("conv_id", "_piece", "_body", "_is", F.explode("_to").alias("_i"))
    one = one.select("conv_id", F.when(F.expr("_is[_i]"), F.col("_i")).alias("target_turn"),
                     F.array_join(F.slice("_piece", F.lit(1), F.col("_i") + 1), "").alias("formatted"),
                     F.when(F.expr("_is[_i]"), F.length(F.expr("_body[_i]"))).otherwise(0).alias("loss_length"))
    return one.withColumn("loss_start", F.length("formatted") - len(END) - F.col("loss_length"))


def read_back(found: DataFrame) -> DataFrame:
    """Per conversation: its turns, parsed from its longest example, and what the loss masks cover.

    (conv_id, turns array<struct<role, text>>, loss_text, formatted_chars)
    """
    loss = unescape(F.substring("formatted", F.col("loss_start") + 1, F.col("loss_length")))
    per = (found.withColumn("_loss", F.when(F.col("target_turn").isNotNull(), F.struct("target_turn", loss.alias("l"))))
           .groupBy("conv_id").agg(
               F.array_sort(F.collect_list("_loss")).alias("_loss"),
               F.max_by("formatted", F.length("formatted")).alias("_all"),
               F.sum(F.length("formatted")).alias("formatted_chars")))
    piece = F.expr(f"""transform(filter(split(_all, '<[|]im_end[|]>\\n'), p -> p <> ''),
                       p -> substr(p, {len(START) + 1}))""")
    return per.withColumn("_p", piece).select(
        "conv_id",
        F.transform("_p", lambda p: F.struct(
            unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.substr(p, F.locate("\n", p) + 1)).alias("text"))).alias("turns"),
        F.array_join(F.transform("_loss", lambda x: x["l"]), "").alias("loss_text"),
        "formatted_chars")


def digest(parsed: DataFrame) -> DataFrame:
    """The digest columns of the query, from what was read back."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parsed.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"))
