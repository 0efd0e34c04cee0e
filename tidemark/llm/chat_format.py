"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn becomes one example: all turns before it as context, and only its own text
under the loss mask. Turns after the last assistant turn (and conversations without one) become
one more example without a trainable part, so that the output holds every turn.

A turn reads `### role: text</turn>` and a line feed. In roles and texts a backslash becomes two,
`<` becomes backslash l, `#` backslash h and `:` backslash c; no control string can then occur
inside a text, and `unescaped` takes the marks back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
#: A character and what stands for it.
MARKS = (("<", "\\l"), ("#", "\\h"), (":", "\\c"))


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for plain, mark in MARKS:
        out = F.replace(out, F.lit(plain), F.lit(mark))
    return out


def unescaped(text: Column) -> Column:
    def part(x: Column) -> Column:
        for plain, mark in MARKS:
            x = F.replace(x, F.lit(mark), F.lit(plain))
        return x

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), part), "\\")


def expand_prefixes(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", trainable: str = "assistant") -> DataFrame:
    """Examples (conv_id, example, last, text, loss_start, loss_chars); loss_start counts code points from 0.

    Turns are ordered by turn, then role, then text, so ties and repeated rows have one result and
    stay. Null role or text counts as empty; a null turn comes first; rows without conversation id
    are one conversation. Only the four named columns are read. An empty table gives no example.
    """
    rows = turns.select(
        F.col(id_col).alias("conv_id"),
        F.struct(F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).alias("t"),
    )
    talks = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    parts = F.transform("t", lambda x: F.struct((x["role"] == trainable).alias("own"), F.concat(F.lit(HEAD), escaped(x["role"]), F.lit(MIDDLE)).alias("head"), escaped(x["text"]).alias("body")))
    talks = talks.select("conv_id", parts.alias("p"))
    talks = talks.withColumn("n", F.size("p"))
    ends = F.filter(F.sequence(F.lit(1), F.col("n")), lambda i: F.get("p", i - 1)["own"] | (i == F.col("n")))
    examples = talks.select("conv_id", "p", "n", F.posexplode(ends).alias("example", "k"))
    whole = lambda p: F.array_join(F.transform(p, lambda x: F.concat(x["head"], x["body"], F.lit(END))), "")
    target = F.get("p", F.col("k") - 1)
    context = whole(F.slice("p", 1, F.col("k") - 1))
    out = examples.select("conv_id", F.col("example").cast("long").alias("example"), (F.col("k") == F.col("n")).alias("last"), context.alias("context"), target.alias("own"))
    return out.select(
        "conv_id",
        "example",
        "last",
        F.concat("context", "own.head", "own.body", F.lit(END)).alias("text"),
        (F.length("context") + F.length("own.head")).cast("long").alias("loss_start"),
        F.when(F.col("own.own"), F.length("own.body")).otherwise(0).cast("long").alias("loss_chars"),
    )


def parsed_turns(text: Column) -> Column:
    """The (role, text) pairs of a formatted text, unescaped."""
    lines = F.split(text, END, -1)
    lines = F.slice(lines, 1, F.size(lines) - 1)

    def turn(x: Column) -> Column:
        at = F.instr(x, MIDDLE)
        return F.struct(unescaped(F.substr(x, F.lit(len(HEAD) + 1), at - len(HEAD) - 1)).alias("role"), unescaped(F.substr(x, at + len(MIDDLE))).alias("text"))

    return F.transform(lines, turn)


def digests(examples: DataFrame) -> DataFrame:
    """What a conversation's examples say, read back from their formatted texts."""
    turns = parsed_turns(F.col("text"))
    loss = unescaped(F.substr("text", F.col("loss_start") + 1, F.col("loss_chars")))
    rows = examples.select(
        "conv_id",
        F.length("text").cast("long").alias("formatted"),
        F.struct("example", loss.alias("loss")).alias("x"),
        F.when(F.col("last"), F.struct(F.size(turns).cast("long").alias("n"), F.sha2(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("sha"))).alias("turns"),
    )
    out = rows.groupBy("conv_id").agg(F.max("turns").alias("turns"), F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["loss"]), "").alias("loss"), F.sum("formatted").alias("formatted_chars"))
    return out.select("conv_id", F.col("turns.n").alias("n_turns"), F.col("turns.sha").alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
