"""Chat formatting: a finite-state machine over roles and a declarative template, in Spark expressions.

Every turn becomes three segments: an opening with the role, the text, a closing. Only the text of a
trained role carries loss. Control strings inside a role or text are escaped, and ``parse`` reads the
turns back from the formatted string alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    """Marks of a turn and the allowed order of roles.

    ``control`` are the strings that must not appear inside a role or a text: each is written as the
    escape letter and its number, and the escape letter itself as the escape letter and 0. ``moves`` gives
    the roles that may follow each state; a state is the role before, ``start`` before the first turn.
    """

    opening: str = "<s>[INST] "
    header_end: str = " [/INST]"
    closing: str = "</s>"
    escape: str = "~"
    control: tuple[str, ...] = ("</s>", "[/INST]", "[INST]", "<s>")
    trained: tuple[str, ...] = ("assistant",)
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    last: tuple[str, ...] = ("assistant",)


LLAMA_LIKE = Template()


def escaped(text: Column, template: Template) -> Column:
    out = F.replace(text, F.lit(template.escape), F.lit(f"{template.escape}0"))
    for i, mark in enumerate(template.control, 1):
        out = F.replace(out, F.lit(mark), F.lit(f"{template.escape}{i}"))
    return out


def unescaped(text: Column, template: Template) -> Column:
    out = text
    for i, mark in enumerate(template.control, 1):
        out = F.replace(out, F.lit(f"{template.escape}{i}"), F.lit(mark))
    return F.replace(out, F.lit(f"{template.escape}0"), F.lit(template.escape))


def _machine(turns: Column, template: Template) -> Column:
    """Place of the first turn that the order forbids, from 0; the number of turns when the end is missing;
    NULL for a valid conversation."""
    allowed = [f"{state}>{role}" for state, roles in template.moves.items() for role in roles]
    bad = F.lit(-1)
    start = F.struct(F.lit("start").alias("state"), F.lit(0).alias("n"), bad.alias("bad"))

    def step(acc: Column, turn: Column) -> Column:
        role = F.coalesce(turn["role"], F.lit(""))
        fits = F.concat(acc["state"], F.lit(">"), role).isin(allowed)
        return F.struct(
            role.alias("state"),
            (acc["n"] + 1).alias("n"),
            F.when((acc["bad"] < 0) & ~fits, acc["n"]).otherwise(acc["bad"]).alias("bad"),
        )

    def finish(acc: Column) -> Column:
        return F.when(acc["bad"] >= 0, acc["bad"]).when(~acc["state"].isin(*template.last), acc["n"])

    return F.aggregate(turns, start, step, finish)


def conversations(
    rows: DataFrame, template: Template = LLAMA_LIKE,
    conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per conversation: (conv_id, formatted, segments array<struct<text, loss>>, valid, bad_turn).

    Turns go by ``turn``, then role and text, so ties have one order; repeated rows stay repeated turns. NULL
    texts and roles count as empty; rows without a conversation id form a conversation of their own. Roles
    out of order or unknown are formatted like any other and reported by ``bad_turn``. A conversation is one
    output value, so its own size is the most that a task has to hold.
    """
    blank = F.lit("")
    gathered = rows.groupBy(F.col(f"`{conv}`").alias("conv_id")).agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col(f"`{turn}`").alias("turn"),
                    F.coalesce(F.col(f"`{role}`"), blank).alias("role"),
                    F.coalesce(F.col(f"`{text}`"), blank).alias("text"),
                )
            )
        ).alias("turns")
    )

    def segments(t: Column) -> Column:
        head = F.concat(F.lit(template.opening), escaped(t["role"], template), F.lit(template.header_end))
        off, on = F.lit(False), t["role"].isin(*template.trained)
        return F.array(
            F.struct(head.alias("text"), off.alias("loss")),
            F.struct(escaped(t["text"], template).alias("text"), on.alias("loss")),
            F.struct(F.lit(template.closing).alias("text"), off.alias("loss")),
        )

    bad = _machine(F.col("turns"), template)
    return (
        gathered.select("conv_id", F.flatten(F.transform("turns", segments)).alias("segments"), bad.alias("bad_turn"))
        .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
        .select("conv_id", "formatted", "segments", F.col("bad_turn").isNull().alias("valid"), "bad_turn")
    )


def parse(formatted: Column, template: Template = LLAMA_LIKE) -> Column:
    """array<struct<role, text>> read back from a formatted string."""
    parts = F.filter(
        F.split(formatted, _quoted(template.closing), -1), lambda p: p.startswith(template.opening)
    )

    def turn(part: Column) -> Column:
        body = F.substring(part, len(template.opening) + 1, 2**31 - 1)
        role = F.substring_index(body, template.header_end, 1)
        text = F.substring(body, F.char_length(role) + len(template.header_end) + 1, F.lit(2**31 - 1))
        return F.struct(unescaped(role, template).alias("role"), unescaped(text, template).alias("text"))

    return F.transform(parts, turn)


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"


def loss_text(segments: Column, template: Template = LLAMA_LIKE) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    held = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(held, lambda s: unescaped(s["text"], template)), "")


def digests(made: DataFrame, template: Template = LLAMA_LIKE) -> DataFrame:
    """Counts and digests of each conversation, taken from the formatted output."""
    turns, loss = parse(F.col("formatted"), template), loss_text(F.col("segments"), template)
    lines = F.transform("__turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return made.withColumn("__turns", turns).withColumn("__loss", loss).select(
        "conv_id",
        F.size("__turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("__loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("__loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
        "valid",
        "bad_turn",
    )
