"""Chat formatting in budgeted windows, with DataFrame functions only.

Prefix sums of the turns' tokens choose the windows: a turn belongs to the window its first token
falls in, so windows are turn-aligned, and no window needs the ones before it. A later window
repeats the conversation's system turn and the turns before it that fit the history budget; repeated
targets are masked, so each assistant text is under the loss mask once. Windows hold about ``budget``
tokens; a longer turn is never cut and stands in one window.

Texts are escaped, so that the template's control strings cannot occur inside one: ``&`` becomes
``&amp;``, ``<|`` becomes ``&lt;|``, and a line end in a role ``&nl;``.

Results for edge cases: null text is empty, a null role is the empty role; rows with a null
conv_id form one conversation of their own; equal turn numbers are ordered by role and text, a null
one counts as 0; repeated rows are repeated turns; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: Turns in a chunk of the two-level prefix sums.
CHUNK = 256


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def turn_tokens(role: Column, text: Column) -> Column:
    """Tokens of a turn as budgeted: a quarter of its bytes, rounded up, and four for the template."""
    return F.floor((F.octet_length(role) + F.octet_length(text) + 3) / 4) + 4


def windows(turns: DataFrame, *, budget: int = 2048, history: int = 256) -> DataFrame:
    """One row per window: conv_id, window (0, 1, ...), n_context (turns repeated in front), text,
    and loss: the spans of ``text`` under the loss mask (start and end in code points)."""
    stride = budget - history
    base = turns.select(
        "conv_id",
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("tokens", turn_tokens(F.col("role"), F.col("text")))
    # Prefix sums in two levels, so that a conversation with very many turns is many tasks.
    chunk = F.floor(F.col("turn") / CHUNK)
    order = ["turn", "role", "text"]
    within = base.withColumn("chunk", chunk).withColumn(
        "sums",
        F.struct(
            (F.sum("tokens").over(W.partitionBy("conv_id", "chunk").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)) - F.col("tokens")).alias("before"),
            F.row_number().over(W.partitionBy("conv_id", "chunk").orderBy(*order)).alias("at"),
        ),
    )
    totals = base.groupBy("conv_id", chunk.alias("chunk")).agg(F.sum("tokens").alias("chunk_tokens"))
    earlier = totals.select(
        "conv_id",
        "chunk",
        (
            F.sum("chunk_tokens").over(W.partitionBy("conv_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, 0))
            - F.col("chunk_tokens")
        ).alias("start"),
        (F.row_number().over(W.partitionBy("conv_id").orderBy("chunk")) == 1).alias("first_chunk"),
    )
    placed = (
        within.alias("a")
        .join(
            earlier.alias("b"),
            F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.chunk") == F.col("b.chunk")),
        )
        .select(
            "a.conv_id", "role", "text", "tokens", "a.chunk", "sums.at",
            (F.col("start") + F.col("sums.before")).alias("begin"),
            (F.col("first_chunk") & (F.col("sums.at") == 1) & (F.col("role") == "system")).alias("is_system"),
        )
        .withColumn("slot", F.floor(F.col("begin") / stride))
    )
    # Slots that hold a turn, numbered; where each begins, and the slot that follows.
    slots = placed.groupBy("conv_id", "slot").agg(F.min("begin").alias("slot_begin"))
    by_slot = W.partitionBy("conv_id").orderBy("slot")
    slots = slots.select(
        "conv_id",
        "slot",
        (F.row_number().over(by_slot) - 1).cast("long").alias("window"),
        F.lead("slot_begin").over(by_slot).alias("next_begin"),
    )
    system = placed.where("is_system").select("conv_id", F.struct("role", "text", "tokens").alias("system"))
    known = placed.alias("a").join(
        slots.alias("b"), F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.slot") == F.col("b.slot"))
    )
    # A turn stands in its own window, and as history in the next one if it fits the budget there.
    again = ~F.col("is_system") & (F.col("next_begin") - F.col("begin") <= history)
    copies = F.when(again, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    shown = known.select(
        "a.conv_id", "window", "chunk", "at", "role", "text", F.explode(copies).alias("repeated")
    ).withColumn("window", F.col("window") + F.col("repeated").cast("long"))
    built = shown.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(F.struct("chunk", "at", "role", "text", "repeated"))).alias("turns")
    )
    full = built.alias("a").join(
        system.alias("b"),
        F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.window") > 0),
        "left",
    )
    lead = F.when(
        F.col("system").isNotNull(),
        F.array(F.struct(F.col("system.role").alias("role"), F.col("system.text").alias("text"), F.lit(True).alias("repeated"))),
    ).otherwise(F.expr("cast(array() as array<struct<role:string,text:string,repeated:boolean>>)"))
    parts = F.concat(lead, F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"), t["repeated"].alias("repeated"))))
    marked = full.select(
        "a.conv_id",
        "window",
        F.transform(
            parts,
            lambda t: F.struct(
                F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"),
                escape(t["text"]).alias("body"),
                ((t["role"] == "assistant") & ~t["repeated"]).alias("target"),
                t["repeated"].alias("repeated"),
            ),
        ).alias("parts"),
    )
    # Where each body begins: a running sum over the window's few turns.
    zero = F.expr("named_struct('at', 0L, 'spans', cast(array() as array<struct<start:bigint,end:bigint>>))")

    def place(acc: Column, p: Column) -> Column:
        begin = acc["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        span = F.array(F.struct(begin.cast("long").alias("start"), end.cast("long").alias("end")))
        return F.struct(
            (end + len(END)).cast("long").alias("at"),
            F.when(p["target"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    return marked.select(
        "conv_id",
        "window",
        F.size(F.filter("parts", lambda p: p["repeated"])).alias("n_context"),
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("text"),
        F.aggregate("parts", zero, place)["spans"].alias("loss"),
    )


def turns_of(text: Column) -> Column:
    """The turns (role and text) that a window's text holds, repeated ones included."""
    pieces = F.split(text, "\\Q" + END + "\\E", -1)

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(START) + 1))
        cut = F.instr(body, "\n")
        return F.struct(
            unescape_role(F.substr(body, F.lit(1), cut - 1)).alias("role"),
            unescape(F.substr(body, cut + 1)).alias("text"),
        )

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def targets_of(text: Column, loss: Column) -> Column:
    """The unescaped texts under a window's loss mask, in order."""
    return F.transform(
        loss, lambda s: unescape(F.substr(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )


def digests(turns: DataFrame, *, budget: int = 2048, history: int = 256) -> DataFrame:
    """What each conversation's windows say when they are read back."""
    text = F.col("text")
    read = windows(turns, budget=budget, history=history).select(
        "conv_id",
        "window",
        F.length(text).alias("chars"),
        F.filter(turns_of(text), lambda t, i: i >= F.col("n_context")).alias("turns"),
        F.array_join(targets_of(text, F.col("loss")), "").alias("target"),
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    gathered = (
        read.select("conv_id", "window", "chars", F.size("turns").alias("n"), F.array_join(said, "").alias("said"), "target")
        .groupBy("conv_id")
        .agg(
            F.sum("n").cast("long").alias("n_turns"),
            F.array_sort(F.collect_list(F.struct("window", "said", "target"))).alias("w"),
            F.sum("chars").cast("long").alias("formatted_chars"),
        )
    )
    target = F.array_join(F.transform("w", lambda x: x["target"]), "")
    return gathered.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.transform("w", lambda x: x["said"]), ""), 256).alias("turns_sha256"),
        F.length(target).cast("long").alias("loss_chars"),
        F.sha2(target, 256).alias("loss_sha256"),
        "formatted_chars",
    )
