r"""Chat formatting in budgeted windows, by DataFrame functions alone.

Every turn becomes ``<|turn|>role<|body|>text<|end|>``. In roles and texts a backslash is written
as ``\\`` and ``<`` as ``\l``, so no control string can stand inside a text, and reading back is
exact. Prefix sums of turn tokens cut a conversation into spans of whole turns: a new span starts
where the sum passes a multiple of the stride, which is half of what the budget leaves beside the
system turn and the history. A window is the system turn, the last turns of the span before within
the history limit, and the span. So a window stays within the budget unless one turn alone is longer
than the stride. Targets are assistant texts of the span; repeated turns are masked.

Tokens are estimated as ``ceil(characters / 4)`` of role and text, as no tokenizer runs here.

Defined results: NULL role or text is empty; NULL turns come first; turns with equal numbers are
ordered by role and text, and repeated rows are turns of their own; rows of NULL conversation form one
conversation; a conversation's system turn is its first one, if its role is ``system``; an
empty table gives no windows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """Between doubled backslashes, which are found from the left, only ``\\l`` is left to turn back."""
    parts = F.split(text, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\l"), F.lit("<"))), "\\")


def chat_windows(turns: DataFrame, budget: int = 1024, history: int = 128, system: int = 256) -> DataFrame:
    """Rows (conv_id, window, formatted, n_repeated, loss_spans) of conversations (conv_id, turn, role, text).

    ``n_repeated`` counts the leading turns that earlier windows hold already. ``loss_spans`` are
    (start, length) in characters of ``formatted``: the bodies of the targets. ``system`` is what
    the budget reserves for the system turn; a longer one is kept whole.
    """
    if budget <= history + system + 1:
        raise ValueError("the budget must exceed history and system turn")
    stride = (budget - history - system) // 2
    order = [F.asc_nulls_first("turn"), "role", "text"]
    conversation = Window.partitionBy("conv_id").orderBy(*order)
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tokens", F.ceil((F.length("role") + F.length("text")) / 4)).withColumn("position", F.row_number().over(conversation))
    rows = rows.withColumn("is_system", (F.col("position") == 1) & (F.col("role") == "system"))
    spent = F.when(F.col("is_system"), 0).otherwise(F.col("tokens"))
    rows = rows.withColumn("upto", F.sum(spent).over(conversation.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("step", F.floor(F.greatest(F.col("upto") - 1, F.lit(0)) / stride))
    rows = rows.withColumn("window", F.dense_rank().over(Window.partitionBy("conv_id").orderBy("step")))
    rows = rows.withColumn("span_end", F.max("upto").over(Window.partitionBy("conv_id", "window")))
    rows = rows.withColumn("windows", F.max("window").over(Window.partitionBy("conv_id")))
    own = F.array(F.struct(F.col("window").alias("window"), F.lit(False).alias("repeated")))
    later = lambda upto: F.transform(F.sequence(F.col("window") + 1, upto), lambda w: F.struct(w.alias("window"), F.lit(True).alias("repeated")))
    none = F.slice(own, 1, 0)
    again = (
        F.when(F.col("window") == F.col("windows"), none).when(F.col("is_system"), later(F.col("windows")))
        .when(F.col("upto") > F.col("span_end") - history, later(F.col("window") + 1)).otherwise(none)
    )
    placed = rows.select("conv_id", "position", "role", "text", F.explode(F.concat(own, again)).alias("at")).select(
        "conv_id", "position", "at.window", "at.repeated", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY)).alias("head"), escape(F.col("text")).alias("body"),
        ((F.col("role") == "assistant") & ~F.col("at.repeated")).alias("target"),
    )
    placed = placed.withColumn("piece", F.concat("head", "body", F.lit(END)))
    inside = Window.partitionBy("conv_id", "window").orderBy("position")
    placed = placed.withColumn("start", F.sum(F.length("piece")).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.length("piece") + F.length("head"))
    span = F.when(F.col("target"), F.struct(F.col("start").alias("start"), F.length("body").cast("long").alias("length")))
    turns_of = F.array_sort(F.collect_list(F.struct("position", "piece")))
    return placed.groupBy("conv_id", "window").agg(
        F.array_join(F.transform(turns_of, lambda x: x["piece"]), "").alias("formatted"), F.sum(F.col("repeated").cast("int")).alias("n_repeated"),
        F.array_sort(F.collect_list(span)).alias("loss_spans"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted windows: turns, digests of all turns and of the text under the loss mask, lengths."""
    pieces = F.slice(F.split("formatted", F.lit("<\\|end\\|>"), -1), 1, F.greatest(F.size(F.split("formatted", F.lit("<\\|end\\|>"), -1)) - 1, F.lit(0)))
    fresh = F.filter(pieces, lambda p, i: i >= F.col("n_repeated"))

    def parsed(piece: Column) -> Column:
        halves = F.split(F.substr(piece, F.lit(len(TURN) + 1)), F.lit("<\\|body\\|>"), 2)
        return F.concat(unescape(halves[0]), F.lit("\n"), unescape(halves[1]), F.lit("\n"))

    targets = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    read = windows.select(
        "conv_id", "window", F.size(fresh).alias("n"), F.array_join(F.transform(fresh, parsed), "").alias("turns"),
        F.array_join(targets, "").alias("loss"), F.length("formatted").alias("chars"),
    )
    in_order = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("window", c))), lambda x: x[c]), "")
    return read.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"), F.sha2(in_order("turns"), 256).alias("turns_sha256"), F.sum(F.length("loss")).cast("long").alias("loss_chars"),
        F.sha2(in_order("loss"), 256).alias("loss_sha256"), F.sum("chars").cast("long").alias("formatted_chars"),
    )
