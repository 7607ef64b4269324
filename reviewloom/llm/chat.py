r"""Chat formatting as a relational job: Spark expressions only.

The turns of a conversation are collected as structs and sorted; neighbours of the same role are merged into runs,
each with one header and the array of its texts; the text is one concatenation of the runs. Layout, per run of turns of one role::

    ### Role:
    text</turn>text</turn>

Inside texts (and roles) a backslash becomes ``\b``, ``###`` becomes ``\h`` and ``</turn>`` becomes ``\t``, so
neither control string can occur there, and undoing the three in the order ``\t``, ``\h``, ``\b`` gives the text
back. In roles a line break becomes ``\n`` as well. ``segments`` splits the formatted text into parts with and
without loss; the loss lies on the texts of the assistant.

A null text is empty; a null role is the empty role; a null turn comes first. Equal turn numbers are ordered by
role and text, repeated rows are repeated turns. A null conversation id is a conversation. Other columns are
ignored. An empty table gives no conversation. One conversation is one value of text, hence one task's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN_END = "</turn>"
HEADER = "### "
LOSS_ROLE = "assistant"
# Read in this order when escaping, in the opposite order when reading back.
ESCAPES = (("\\", "\\b"), ("###", "\\h"), (TURN_END, "\\t"))


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _read_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def _runs(turns: Column) -> Column:
    """Neighbours of the same role merged: an array of (role, texts), from one slice a run."""
    places = F.sequence(F.lit(0), F.size(turns) - 1)
    first = F.filter(places, lambda i: (i == 0) | (F.get(turns, i - 1)["role"] != F.get(turns, i)["role"]))
    # The end of a run is the start of the next, or the end of the turns.
    bounds = F.arrays_zip(first.alias("start"), F.concat(F.slice(first, 2, F.size(turns)), F.array(F.size(turns))).alias("end"))

    def merged(bound: Column) -> Column:
        run = F.slice(turns, bound["start"] + 1, bound["end"] - bound["start"])
        texts = F.transform(run, lambda t: t["text"])
        return F.struct(F.get(run, F.lit(0))["role"].alias("role"), texts.alias("texts"))

    return F.transform(bounds, merged)


def _run_segments(run: Column) -> Column:
    """(text, loss) pieces of a merged run: its header once, then every text with its end mark."""

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    header = F.concat(F.lit(HEADER), _role(run["role"]), F.lit(":\n"))
    marked = F.transform(
        run["texts"],
        lambda t: F.array(piece(escape(t), run["role"] == LOSS_ROLE), piece(F.lit(TURN_END), F.lit(False))),
    )
    return F.concat(F.array(piece(header, F.lit(False))), F.flatten(marked))


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, segments, formatted) of each conversation in ``turns`` (conv_id, turn, role, text).

    ``segments`` is an array of (text, loss); ``formatted`` is the concatenation of their texts.
    """
    empty = F.lit("")
    row = F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    sorted_turns = turns.select("conv_id", row.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("turns")
    )

    texts = F.transform(_runs(F.col("turns")), _run_segments)
    segments = F.filter(F.flatten(texts), lambda s: s["text"] != "")
    return sorted_turns.select("conv_id", segments.alias("segments")).withColumn(
        "formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, array of (role, text), from its text alone."""

    def run_of_role(block: Column) -> Column:
        role = _read_role(F.substring_index(block, ":\n", 1))
        body = F.substring(block, F.length(F.substring_index(block, ":\n", 1)) + 3, F.length(block))
        texts = F.split(body, TURN_END, -1)
        texts = F.slice(texts, F.lit(1), F.size(texts) - 1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    blocks = F.split(formatted, HEADER, -1)
    blocks = F.slice(blocks, F.lit(2), F.greatest(F.size(blocks) - 1, F.lit(0)))
    return F.flatten(F.transform(blocks, run_of_role))


def loss_text(segments: Column) -> Column:
    """All text under the loss, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the output."""
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = formatted.select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss")
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
