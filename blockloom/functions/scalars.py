"""Scalar rules of the chain tables, as Catalyst expressions.

Nothing here is a UDF: every function returns a ``Column`` built from Spark
built-ins, so the work stays on the JVM.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL38 = "decimal(38,0)"
DECIMAL38_DIGITS = 38

# Names of the event types, coin actions and directions by number.
EVENT_TYPES = {0: "UNKNOWN", 1: "BLOCK_ADDED", 2: "BLOCK_REMOVED"}
COIN_ACTIONS = {0: "COIN_ACTION_UNSPECIFIED", 1: "COIN_CREATED", 2: "COIN_SPENT"}
DIRECTIONS = {0: "DIRECTION_UNSPECIFIED", 1: "FORWARD", 2: "BACKWARD"}


def decimal38(text: Column) -> Column:
    """Decimal text to DECIMAL(38,0); NULL when it is not a whole number that fits.

    Unset and empty text are 0. One sign and ASCII digits are accepted, and the
    text may have at most 38 characters after one leading minus: a plus sign
    and leading zeros count.

    Once the digits are taken out only a single sign may remain; a sign in the
    wrong place, or alone, is left for ``try_cast`` to refuse. This is cheaper
    per row than a regular expression.
    """
    text = F.coalesce(text, F.lit(""))
    width = F.length(text) - F.startswith(text, F.lit("-")).cast("int")
    well_formed = F.translate(text, "0123456789", "").isin("", "-", "+")
    return F.when(text == "", F.lit(0).cast(DECIMAL38)).when(
        well_formed & (width <= DECIMAL38_DIGITS), text.try_cast(DECIMAL38)
    )


def decimal38_strict(text: Column, label: Column) -> Column:
    """Like :func:`decimal38`, but invalid text fails the job and names ``label``."""
    message = F.concat(
        F.lit("cannot convert to DECIMAL(38,0): "), text, F.lit(" (hash="), label, F.lit(")")
    )
    return F.coalesce(decimal38(text), F.raise_error(message).cast(DECIMAL38))


def null_if_empty(items: Column, built: Column | None = None) -> Column:
    """A list without elements becomes NULL, never an empty list.

    ``built`` is what to return for a list that has elements (by default the
    list itself), so that the test looks at the cheap source list.
    """
    return F.when(F.size(items) > 0, items if built is None else built)


def partition_floor(number: Column, size: int) -> Column:
    """Lower bound of the ``size``-wide bucket ``number`` falls in; 0 without a size."""
    if size < 0:
        raise ValueError(f"partition size must not be negative: {size}")
    if size == 0:
        return F.lit(0).cast("bigint")
    return number - number % F.lit(size).cast("bigint")


def default_to(value: Column, default) -> Column:
    """Unset scalars hold their default and are never NULL."""
    return F.coalesce(value, F.lit(default))


def epoch_seconds(timestamp: Column, *, ntz: bool = False) -> Column:
    """Whole seconds since 1970 UTC; unset is 0.

    ``ntz`` reads a timestamp without time zone as UTC, whatever time zone the
    session uses.
    """
    if ntz:
        seconds = (
            F.unix_date(timestamp.cast("date")).cast("bigint") * 86400
            + F.hour(timestamp) * 3600
            + F.minute(timestamp) * 60
            + F.second(timestamp)
        )
    else:
        seconds = F.unix_seconds(timestamp)
    return F.coalesce(seconds, F.lit(0).cast("bigint"))


def enum_name(value: Column, names: Mapping[int, str], *, numeric: bool = False) -> Column:
    """Enum value as its name; unset is the name of value zero.

    ``numeric`` maps numbers to names; a number without a name is its digits.
    """
    if numeric:
        named = F.lit(None).cast("string")
        for number, name in names.items():
            named = F.when(value == number, F.lit(name)).otherwise(named)
        value = F.coalesce(named, value.cast("string"))
    return F.coalesce(value, F.lit(names[0]))


def element_count(items: Column) -> Column:
    """Length of a list; 0 for an unset one."""
    return F.coalesce(F.array_size(items), F.lit(0)).cast("bigint")


# Characters written as escapes in embedded JSON.
_JSON_ESCAPES = {
    "<": "\\u003c",
    ">": "\\u003e",
    "&": "\\u0026",
    "\u2028": "\\u2028",
    "\u2029": "\\u2029",
}


def _escape_markup(json_text: Column) -> Column:
    for raw, escaped in _JSON_ESCAPES.items():
        json_text = F.replace(json_text, F.lit(raw), F.lit(escaped))
    return json_text


def _compact_json(json_text: Column) -> Column:
    """Drop the blanks between JSON tokens, keeping those inside strings.

    Raw control characters cannot occur in valid JSON, so two of them stand in
    for escaped backslashes and quotes while the text is split at its quotes:
    even pieces lie outside strings, odd ones inside.
    """
    masked = F.replace(
        F.replace(json_text, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02")
    )
    pieces = F.transform(
        F.split(masked, '"'),
        lambda piece, i: F.when(i % 2 == 0, F.translate(piece, " \t\r\n", "")).otherwise(piece),
    )
    joined = F.array_join(pieces, '"')
    restored = F.replace(
        F.replace(joined, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\")
    )
    return F.when(json_text.rlike("[ \\t\\r\\n]"), restored).otherwise(json_text)


def _json_key(key: Column) -> Column:
    quoted = F.replace(F.replace(key, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for raw, escaped in {"\n": "\\n", "\r": "\\r", "\t": "\\t"}.items():
        quoted = F.replace(quoted, F.lit(raw), F.lit(escaped))
    by_code = F.array_join(
        F.transform(
            F.split(quoted, ""),
            lambda c: F.when(
                (c >= "\x00") & (c < " ") & (F.length(c) > 0),
                F.concat(F.lit("\\u00"), F.lpad(F.lower(F.hex(F.ascii(c))), 2, "0")),
            ).otherwise(c),
        ),
        "",
    )
    quoted = F.when(quoted.rlike("[\\x00-\\x1f]"), by_code).otherwise(quoted)
    return F.concat(F.lit('"'), _escape_markup(quoted), F.lit('"'))


def metadata_json(metadata: Column) -> Column:
    """MAP<STRING, JSON text> as one JSON object; "" when nothing is in it.

    Keys are sorted, entries without a value are dropped and values are
    embedded as JSON, without blanks between tokens.
    """
    entries = F.filter(F.map_entries(metadata), lambda e: e["value"].isNotNull())
    members = F.transform(
        F.array_sort(entries),
        lambda e: F.concat(
            _json_key(e["key"]), F.lit(":"), _escape_markup(_compact_json(e["value"]))
        ),
    )
    return F.when(
        F.size(entries) > 0, F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))
    ).otherwise(F.lit(""))


def raw_payload(
    transaction: Column,
    *,
    codec: str = "json",
    message: str | None = None,
    descriptor_path: str | None = None,
) -> Column:
    """A whole transaction as bytes.

    ``json`` needs nothing else. ``protobuf`` needs Spark's protobuf module on
    the class path, and the message name and descriptor file of the transaction.
    """
    if codec == "json":
        return F.to_json(transaction).cast("binary")
    if codec == "protobuf":
        if not message or not descriptor_path:
            raise ValueError("codec 'protobuf' needs message and descriptor_path")
        from pyspark.sql.protobuf.functions import to_protobuf

        return to_protobuf(transaction, message, descriptor_path)
    raise ValueError(f"unknown codec: {codec}")


def require(failed: Column, message: Column | str) -> Column:
    """A predicate for ``where`` that keeps every row and fails the job where ``failed``.

    A check in a column that nobody selects never runs; one in a filter does.
    """
    if isinstance(message, str):
        message = F.lit(message)
    else:  # built from members that may be unset themselves
        message = F.coalesce(message, F.lit("a required member is unset"))
    return F.coalesce(F.when(failed, F.raise_error(message).cast("boolean")), F.lit(True))
