"""Chat formatting: turn-aligned windows under a token budget, chosen by prefix sums, with a loss mask over new answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rules import let

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    """Put one more backslash between < and | wherever only backslashes stand between them: no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """Roles end at a line break, so theirs become a control string."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<|n|>"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<|n|>"), F.lit("\n")))


def count_tokens(text: Column) -> Column:
    """Tokens of a turn for the budget: runs of up to four characters between white space."""
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]{1,4}"))


def windows(rows: DataFrame, budget: int = 384, history: int = 96, overhead: int = 4, tokens=count_tokens) -> DataFrame:
    """conv_id, part, window, formatted, n_repeated, loss of conversations given as rows conv_id, turn, role, text.

    Turns go by turn, then role and text. A turn costs its tokens and `overhead`; tokens is a function of the text or the
    name of a column of rows that a tokenizer filled (null: 0). A window holds the system turn (a first turn of that role),
    then of the turns before its first new one the longest run whose cost is at most `history`, then new turns while all fit
    the budget, one at least: a turn beyond the budget has a window of its own, whole. n_repeated counts the leading turns
    that stand in an earlier window. loss holds (start, size) in code points of formatted for each new assistant turn's text;
    repeated answers are masked. `overhead` must be positive.
    Null text or role: empty. Null turn: first. Null conv_id: each row is a conversation of its own, told apart by `part`,
    which is null elsewhere; so no key holds all such rows. Equal rows: kept each. No rows: no rows. Other columns are
    ignored. Prefix sums are window sums over a conversation's turns. A conversation is one row afterwards, as its digest
    needs; conversations are spread by conv_id.
    """
    none = F.lit("")
    text = F.coalesce(F.col("text").cast("string"), none)
    cost = tokens(text) if callable(tokens) else F.coalesce(F.col(tokens), F.lit(0))
    part = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    turns = rows.select("conv_id", part.alias("part"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), none).alias("role"), text.alias("text"), (cost + overhead).cast("long").alias("cost"))
    whole = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"), escape(F.col("text")), F.lit(END))
    turns = turns.select("conv_id", "part", "turn", "role", "text", "cost", whole.alias("whole"))
    order = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text")
    sums = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = turns.select("*", (F.row_number().over(order) - 1).alias("i"), F.sum("cost").over(sums).alias("costs"), F.sum(F.length("whole")).over(sums).alias("sizes"))
    turn = F.struct(
        "i",
        "costs",
        "sizes",
        "cost",
        "whole",
        (F.length(escape_role(F.col("role"))) + len(START) + 1).cast("long").alias("head"),
        F.length(escape(F.col("text"))).cast("long").alias("size"),
        (F.col("role") == "assistant").alias("learn"),
        (F.col("role") == "system").alias("system"),
    )
    conv = turns.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(turn)).alias("m"))
    zero = F.array(F.lit(0).cast("long"))
    conv = conv.select("*", F.when(F.col("m")[0]["system"], 1).otherwise(0).alias("sys"), F.concat(zero, F.col("m.costs")).alias("cost"), F.concat(zero, F.col("m.sizes")).alias("chars"))
    # for each turn the first turn of the history it would be shown after; a turn costs `overhead` at least, so few are looked at
    reach = history // overhead + 1
    first = F.transform(
        F.sequence(F.lit(0), F.size("m") - 1),
        lambda i: let(F.greatest(F.col("sys"), i - reach), lambda lo: F.when(i <= lo, i).otherwise(lo + F.size(F.filter(F.slice("cost", lo + 1, i - lo), lambda c: F.get("cost", i) - c > history)))),
    )
    conv = conv.select("*", first.alias("hist"))
    room = F.lit(budget) - F.when(F.col("sys") == 1, F.col("m")[0]["cost"]).otherwise(0)
    # fold over the new turns: starts of the windows so far, and the cost that the open window carries over
    empty = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).cast("long").alias("old"))

    def step(s: Column, i: Column) -> Column:
        at = F.element_at(s["starts"], -1)
        stays = (F.size(s["starts"]) > 0) & (F.get("cost", i + 1) - F.get("cost", F.when(F.size(s["starts"]) > 0, at).otherwise(0)) + s["old"] <= room)
        opened = F.struct(F.concat(s["starts"], F.array(i)).alias("starts"), F.when(F.size(s["starts"]) == 0, F.lit(0).cast("long")).otherwise(F.get("cost", i) - F.get("cost", F.get("hist", i))).alias("old"))
        return F.when(stays, s).otherwise(opened)

    body = F.when(F.size("m") > F.col("sys"), F.sequence(F.col("sys"), F.size("m") - 1)).otherwise(F.array().cast("array<int>"))
    starts = F.aggregate(body, empty, step, lambda s: F.when(F.size(s["starts"]) == 0, F.array(F.lit(1))).otherwise(s["starts"]))
    conv = conv.select("*", starts.alias("starts"))
    one = conv.select("*", F.posexplode_outer("starts").alias("window", "new"))
    one = one.withColumn("stop", F.coalesce(F.get("starts", F.col("window") + 1), F.size("m")))
    one = one.withColumn("from", F.when(F.col("window") == 0, F.col("new")).otherwise(F.get("hist", "new")))
    lead = F.when(F.col("sys") == 1, F.length(F.col("m")[0]["whole"]).cast("long")).otherwise(F.lit(0).cast("long"))
    texts = F.transform(F.concat(F.slice("m", 1, F.col("sys")), F.slice("m", F.col("from") + 1, F.col("stop") - F.col("from"))), lambda m: m["whole"])
    fresh = F.when(F.col("stop") > F.col("new"), F.sequence("new", F.col("stop") - 1)).otherwise(F.array().cast("array<int>"))
    spans = F.transform(F.filter(fresh, lambda i: F.get("m", i)["learn"]), lambda i: F.struct((lead + F.get("chars", i) - F.get("chars", F.col("from")) + F.get("m", i)["head"]).alias("start"), F.get("m", i)["size"].alias("size")))
    return one.select(
        "conv_id",
        "part",
        "window",
        F.array_join(texts, "").alias("formatted"),
        F.when(F.col("window") == 0, 0).otherwise(F.col("sys") + F.col("new") - F.col("from")).cast("int").alias("n_repeated"),
        spans.alias("loss"),
    )


def read_back(formatted: Column) -> Column:
    """Array of (role, text) of a window's turns."""
    parts = F.split(formatted, "<\\|im_end\\|>\n")
    turn = lambda p: let(F.position(F.lit("\n"), p), lambda at: F.struct(unescape_role(F.substring(p, F.lit(len(START) + 1), at - len(START) - 1)).alias("role"), unescape(F.substring(p, at + 1, F.length(p))).alias("text")))
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def digests(windows_: DataFrame) -> DataFrame:
    """Per conversation (each row without a conv_id is one), from the windows alone: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    new = let(read_back(F.col("formatted")), lambda t: F.slice(t, F.col("n_repeated") + 1, F.size(t)))
    said = F.transform(new, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learnt = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["size"].cast("int"))))
    rows = windows_.select("conv_id", "part", F.struct("window", said.alias("said"), F.array_join(learnt, "").alias("learnt"), F.length("formatted").cast("long").alias("chars")).alias("w"))
    conv = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("w")).alias("w"))
    said = F.flatten(F.transform("w", lambda w: w["said"]))
    loss = F.array_join(F.transform("w", lambda w: w["learnt"]), "")
    return conv.select(
        "conv_id",
        F.size(said).cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.aggregate("w", F.lit(0).cast("long"), lambda a, w: a + w["chars"]).alias("formatted_chars"),
    )
