"""Chat formatting: conversations become windows of bounded length, with a mask for the loss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: Tokens of a window, of its new turns, and of the turns before them that it repeats at most.
BUDGET, SPAN, HISTORY = 1024, 512, 256
#: Turn numbers that one task sums up; a long conversation is spread over many.
BLOCK = 256

#: Marks of the template. Inside texts and roles each ``\``, ``<`` and ``[`` is followed by a backslash, so that no
#: mark, and no control string of the common templates, can stand there.
TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>\n"
SYSTEM, TARGET = "system", "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", "$1")


def tokens(text: Column) -> Column:
    """Words between ASCII white space, and two for the marks."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")) + 2


def numbered(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns with ``place``, the ``tokens``, the tokens ``before`` them and in ``all`` of the conversation.

    Prefix sums in two steps, within blocks of turn numbers and over the blocks, so that no task gets a whole
    conversation of many turns.
    """
    said = turns.select(
        F.col(conv).alias("conv"),
        F.floor(F.col(turn) / BLOCK).alias("block"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("tokens", tokens(F.col("text")).cast("long"))
    blocks = said.groupBy("conv", "block").agg(F.sum("tokens").alias("sum"), F.count(F.lit(1)).alias("n"))
    over = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("conv").alias("of"),
        F.col("block").alias("in"),
        F.coalesce(F.sum("sum").over(over), F.lit(0)).alias("sum_before"),
        F.coalesce(F.sum("n").over(over), F.lit(0)).alias("n_before"),
        F.sum("sum").over(W.partitionBy("conv")).alias("all"),
    )
    within = W.partitionBy("conv", "block").orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, 0)
    placed = said.withColumns({"sum": F.sum("tokens").over(within), "n": F.count(F.lit(1)).over(within)})
    met = placed.join(blocks, F.col("conv").eqNullSafe(F.col("of")) & F.col("block").eqNullSafe(F.col("in")))
    return met.select(
        "conv",
        (F.col("n_before") + F.col("n")).alias("place"),
        "role",
        "text",
        "tokens",
        (F.col("sum_before") + F.col("sum") - F.col("tokens")).alias("before"),
        "all",
    )


def windows(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    span: int = SPAN,
    history: int = HISTORY,
) -> DataFrame:
    """``conv``, ``window``, ``formatted``, ``loss`` (spans of code points), ``n_turns``, ``n_repeated``.

    The tokens before a turn, by whole multiples of ``span``, say which window it is new in. A window begins with the
    system turn (the first turn, if its role is so) and turns that were new in the window before, as many of the last
    as ``history`` and the ``budget`` allow; the mask holds only the texts of new target turns. Turns are never cut:
    a window is larger than the budget only if its system turn and new turns alone are.

    Turns are ordered by number (null first), role, text; null roles and texts are empty. Repeated rows are turns of
    their own. A null id is one conversation. Empty tables give no rows. Other columns are ignored.
    """
    if history > span or span > budget:
        raise ValueError("history <= span <= budget is needed")
    placed = numbered(turns, conv, turn, role, text)
    own = F.floor(F.col("before") / span)
    is_system = (F.col("place") == 1) & (F.col("role") == SYSTEM)
    copies = F.when(is_system, F.sequence(F.lit(0).cast("long"), F.floor(F.col("all") / span))).otherwise(
        F.when(F.col("before") >= (own + 1) * span - history, F.array(own, own + 1)).otherwise(F.array(own))
    )
    spread = placed.select("*", own.alias("own"), is_system.alias("is_system"), F.explode(copies).alias("window"))
    kind = F.when(F.col("window") == F.col("own"), 2).when(F.col("is_system"), 0).otherwise(1)
    part = F.struct(kind.alias("kind"), "place", "before", "tokens", "role", "text")
    groups = spread.groupBy("conv", "window").agg(F.sort_array(F.collect_list(part)).alias("parts"))

    def total(kind: int) -> Column:
        return F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + F.when(x["kind"] == kind, x["tokens"]).otherwise(0))

    sized = groups.select(
        "conv",
        "window",
        "parts",
        F.array_min(F.filter("parts", lambda x: x["kind"] == 2)["before"]).alias("start"),
        F.least(F.lit(history), F.lit(budget) - total(0) - total(2)).alias("room"),
    ).filter("start IS NOT NULL")
    kept = sized.select(
        "conv",
        "window",
        F.filter("parts", lambda x: (x["kind"] != 1) | (x["before"] >= F.col("start") - F.col("room"))).alias("parts"),
    )
    drawn = kept.select(
        "conv",
        "window",
        F.transform(
            "parts",
            lambda x: F.struct(
                F.concat(F.lit(TURN), escaped(x["role"]), F.lit(SAYS)).alias("head"),
                escaped(x["text"]).alias("body"),
                ((x["kind"] == 2) & (x["role"] == TARGET)).alias("target"),
                (x["kind"] != 2).alias("repeated"),
            ),
        ).alias("parts"),
    )
    whole = F.array_join(F.transform("parts", lambda x: F.concat(x["head"], x["body"], F.lit(END))), "")
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,target:boolean>>").alias("spans"))

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + F.length(x["head"])
        end = start + F.length(x["body"])
        span_ = F.struct(start.alias("start"), end.alias("end"), x["target"].alias("target"))
        return F.struct((end + len(END)).alias("at"), F.concat(a["spans"], F.array(span_)).alias("spans"))

    spans = F.filter(F.aggregate("parts", zero, step)["spans"], lambda s: s["target"])
    return drawn.select(
        F.col("conv").alias(conv),
        "window",
        whole.alias("formatted"),
        F.transform(spans, lambda s: F.struct(s["start"], s["end"])).alias("loss"),
        F.size("parts").alias("n_turns"),
        F.size(F.filter("parts", lambda x: x["repeated"])).alias("n_repeated"),
    )


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """From the windows alone: ``conv``, ``window``, ``turns`` (role and text of the new ones) and ``targets`` (texts under the mask)."""
    cut = formatted.select(conv, "window", "formatted", "loss", "n_repeated", F.split("formatted", F.lit(r"<\|turn\|>")).alias("pieces"))

    def turn(piece: Column) -> Column:
        said = F.substring_index(piece, SAYS, -1)
        return F.struct(
            unescaped(F.substring_index(piece, SAYS, 1)).alias("role"),
            unescaped(F.substring_index(said, END, 1)).alias("text"),
        )

    new = F.slice("pieces", F.col("n_repeated") + 2, F.size("pieces"))
    return cut.select(
        conv,
        "window",
        F.transform(new, turn).alias("turns"),
        F.transform("loss", lambda s: unescaped(F.substring("formatted", s["start"] + 1, s["end"] - s["start"]))).alias("targets"),
        F.length("formatted").alias("chars"),
    )
