r"""Chat formatting that can be read back. DataFrame functions only.

The grammar of a formatted conversation:

    conversation = turn*
    turn         = "### " role ": " text "</turn>\n"

The parser is deterministic: it cuts the text at every ``</turn>\n``, takes a turn's
role up to the first ``: `` and, in role and text, reads ``\x`` as ``x``. Roles and
texts may hold anything, so a rendered turn is parsed again and compared with its
source, and escaped further until both are the same:

* level 0 writes it as it is;
* level 1 puts a backslash before the backslashes and inside the control strings
  of the text: ``\\`` and ``<\/turn>``;
* level 2 does so in the role as well, where ``: `` becomes ``:\ ``.

Most turns stay at level 0, so ordinary text is not disfigured.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
LEVELS = 3
#: A backslash, or the place inside a control string, to put a backslash before.
_TEXT_CONTROL = r"(\\|(?<=<)(?=/turn>))"
_ROLE_CONTROL = r"(\\|(?<=<)(?=/turn>)|(?<=:)(?= ))"


def _escape(value: Column, control: str) -> Column:
    return F.regexp_replace(value, control, r"\\$1")


def _plain(value: Column) -> Column:
    return F.regexp_replace(value, r"(?s)\\(.)", "$1")


def render(role: Column, text: Column, level: int) -> Column:
    if level >= 1:
        text = _escape(text, _TEXT_CONTROL)
    if level >= 2:
        role = _escape(role, _ROLE_CONTROL)
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def blocks(formatted: Column) -> Column:
    """The turns of a formatted text as they stand there, without their ends."""
    parts = F.split(formatted, CLOSE)
    return F.slice(parts, 1, F.size(parts) - 1)


def _role_end(block: Column) -> Column:
    """Where ``: `` ends the role, as a position from 1."""
    return F.instr(block, MIDDLE)


def read_block(block: Column) -> Column:
    end = _role_end(block)
    return F.struct(
        _plain(F.substring(block, F.lit(len(OPEN) + 1), end - len(OPEN) - 1)).alias("role"),
        _plain(F.substring(block, end + len(MIDDLE), F.char_length(block))).alias("text"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted text, an array of role and text."""
    return F.transform(blocks(formatted), read_block)


def _same(rendered: Column, role: Column, text: Column) -> Column:
    turns = parse(rendered)
    return (F.size(turns) == 1) & (F.get(turns, F.lit(0)) == F.struct(role.alias("role"), text.alias("text")))


def format_turns(turns: DataFrame) -> DataFrame:
    """``turns`` with role and text not NULL, block (the rendered turn) and level."""
    tried = turns.withColumns(
        {
            "role": F.coalesce("role", F.lit("")),
            "text": F.coalesce("text", F.lit("")),
        }
    )
    tried = tried.withColumn(
        "_tries",
        F.array(*(render(F.col("role"), F.col("text"), level) for level in range(LEVELS))),
    )
    fits = [_same(F.col("_tries")[k], F.col("role"), F.col("text")) for k in range(LEVELS)]
    level = F.when(fits[0], 0)
    for k in range(1, LEVELS):
        level = level.when(fits[k], k)
    level = level.otherwise(F.raise_error(F.lit("a turn can't be read back")).cast("int"))
    return (
        tried.withColumn("level", level)
        .withColumn("block", F.get("_tries", F.col("level")))
        .drop("_tries")
    )


def format_conversations(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, and loss_spans.

    ``turns`` has conv_id, turn, role and text. Turns stand in the order of turn, then
    role, then text; a NULL turn comes first. A NULL role or text is an empty one; a
    NULL conv_id is a conversation too; repeated rows are repeated turns; other
    columns are dropped; no turns give no rows.

    ``loss_spans`` masks the loss: an array, in order, of block (the turn's number
    from 0), start and length, the code points of that turn of ``formatted`` that
    ``trained`` turns are trained on: their escaped text, nothing of the template.
    """
    made = format_turns(turns.select("conv_id", "turn", "role", "text"))
    one = F.struct("turn", "role", "text", "block")
    return (
        made.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(one)).alias("turns"))
        .select(
            "conv_id",
            F.array_join(F.transform("turns", lambda t: t["block"]), "").alias("formatted"),
            F.filter(
                F.transform(
                    "turns",
                    lambda t, k: F.when(
                        t["role"] == trained,
                        F.struct(
                            k.alias("block"),
                            (_role_end(t["block"]) + len(MIDDLE) - 1).alias("start"),
                            (
                                F.char_length(t["block"])
                                - _role_end(t["block"])
                                - len(MIDDLE)
                                - len(CLOSE)
                                + 1
                            ).alias("length"),
                        ),
                    ),
                ),
                lambda s: s.isNotNull(),
            ).alias("loss_spans"),
        )
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    parts = blocks(formatted)
    return F.array_join(
        F.transform(
            spans,
            lambda s: _plain(F.substring(F.get(parts, s["block"]), s["start"] + 1, s["length"])),
        ),
        "",
    )
