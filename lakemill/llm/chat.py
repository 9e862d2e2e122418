"""Chat formatting with Spark expressions only.

A conversation becomes one text: blocks of neighbouring turns in the same role, and in a block the texts of its turns.
The template:

    <role>text[+]text</role>        role: system, user or assistant; any other: <role:NAME>text</role:>

Control strings begin with ``<`` or ``[+``. In texts a backslash is put behind each ``<`` and ``[`` and taken out again
when the text is read, so no text can hold a control string, whatever it says.

Defined results: rows with null conv_id form one conversation; a null text is an empty text, a null role the role "";
turns are ordered by (turn, role, text), nulls first, so ties and repeated rows have a fixed order and all stay; an empty
table gives no row; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")
LEARNED = "assistant"
JOINT = "[+]"
#: A block as it is written: begin, body, end.
BLOCK = r"(?s)<([^/\\>][^>]*)>(.*?)</[^>]*>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\", "$1")


def _mark(role: Column) -> Column:
    """The name in a block's begin; a ``>`` in it would end the mark too early."""
    name = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit(">"), F.lit("%3E"))
    return F.when(role.isin(*ROLES), role).otherwise(F.concat(F.lit("role:"), name))


def _role(mark: Column) -> Column:
    name = F.regexp_replace(mark, "^role:", "")
    name = F.replace(F.replace(name, F.lit("%3E"), F.lit(">")), F.lit("%25"), F.lit("%"))
    return F.when(mark.isin(*ROLES), mark).otherwise(name)


def merge_turns(turns: Column) -> Column:
    """Merge neighbouring turns of one role: array of (role, texts)."""
    begins = F.filter(
        F.sequence(F.lit(1), F.size(turns)),
        lambda i: (i == 1) | (F.element_at(turns, i)["role"] != F.get(turns, i - 2)["role"]),
    )
    return F.transform(
        begins,
        lambda begin, k: F.struct(
            F.element_at(turns, begin)["role"].alias("role"),
            F.transform(
                F.slice(turns, begin, F.coalesce(F.get(begins, k + 1), F.size(turns) + 1) - begin), lambda t: t["text"]
            ).alias("texts"),
        ),
    )


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def _segments(block: Column) -> Column:
    mark, no = _mark(block["role"]), F.lit(False)
    end = F.when(block["role"].isin(*ROLES), mark).otherwise(F.lit("role:"))
    texts = F.transform(
        block["texts"],
        lambda text, k: F.array(
            _segment(F.when(k == 0, F.lit("")).otherwise(F.lit(JOINT)), no),
            _segment(escape(text), block["role"] == LEARNED),
        ),
    )
    return F.concat(
        F.array(_segment(F.concat(F.lit("<"), mark, F.lit(">")), no)),
        F.flatten(texts),
        F.array(_segment(F.concat(F.lit("</"), end, F.lit(">")), no)),
    )


def format_conversations(df: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted text, and its segments (text, loss) in order.

    The loss mask is true for the assistant's texts and false for all control strings. One shuffle by conversation; all
    array work is linear in the turns. A conversation is one value, and so bounds what a task must hold.
    """
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    turns = df.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    merged = turns.select("conv_id", merge_turns(F.col("turns")).alias("blocks"))
    segments = merged.select("conv_id", F.flatten(F.transform("blocks", _segments)).alias("segments"))
    return segments.select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    marks = F.regexp_extract_all(formatted, F.lit(BLOCK), F.lit(1))
    bodies = F.regexp_extract_all(formatted, F.lit(BLOCK), F.lit(2))
    return F.flatten(
        F.zip_with(
            marks,
            bodies,
            lambda mark, body: F.transform(
                F.split(body, r"\[\+\]", -1), lambda text: F.struct(_role(mark).alias("role"), unescape(text).alias("text"))
            ),
        )
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts hold: turns read back from the text, and the text under the loss mask."""
    learned = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    read = formatted.select(
        "conv_id",
        read_turns(F.col("formatted")).alias("turns"),
        F.array_join(learned, "").alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
