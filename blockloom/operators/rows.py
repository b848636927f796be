"""From parsed blocks to one row per block or transaction.

Two layouts are read:

* *nested*: one row per block with its transactions in an array. Unnesting is
  narrow, there is no shuffle;
* *split*: headers and transactions in two tables, keyed by (tag, height,
  hash). A block that is far larger than the others is then many rows, so Spark
  can spread it over many tasks; headers are joined only when a column asks
  for them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockloom.errors import InvalidArgument
from blockloom.functions.scalars import partition_floor, require
from blockloom.schemas.inputs import BODY, HASH, HEIGHT
from blockloom.schemas.kinds import U64_TYPES, Field, u64_type
from blockloom.schemas.tables import EVENT_FIELDS, PARTITION_BY, PARTITION_SIZE, RANGE_BY

EVENT = "event"
BLOCK_KEYS = ("tag", "height", "hash")
_POSITION = "__range_position"
_PLACE = "__place"


def require_body(blocks: DataFrame, family: str) -> DataFrame:
    """Fail the job on a block without its header (or block identifier)."""
    body = BODY[family]
    return blocks.where(require(F.col(body).isNull(), f"{body} is required"))


def choose(fields: Sequence[Field], columns: Iterable[str] | None) -> tuple[Field, ...]:
    """The fields asked for, in table order; layout and event columns are always there."""
    if columns is None:
        return tuple(fields)
    wanted = set(columns)
    unknown = wanted - {f.name for f in fields}
    if unknown:
        raise ValueError(f"unknown columns: {sorted(unknown)}")
    return tuple(f for f in fields if f.name in wanted)


def members_used(fields: Sequence[Field], parent: str) -> list[str]:
    """Members of ``parent`` that the fields read, in first-use order."""
    steps = (f.source.split(".") for f in fields)
    return list(dict.fromkeys(s[1] for s in steps if s[0] == parent and len(s) > 1))


def _element_members(blocks: DataFrame) -> list[str]:
    dtype = blocks.schema["transactions"].dataType
    assert isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)
    return dtype.elementType.fieldNames()


def unnest_transactions(
    blocks: DataFrame,
    carried: Sequence[Column],
    members: Sequence[str] | None,
    *,
    with_position: bool = False,
    spread: int | None = None,
) -> DataFrame:
    """One row per transaction, with the carried columns; no row for an empty block.

    With ``spread`` a block's transactions are cut into pieces of that many, which are
    dealt out before anything is built from them: a block with a large share of all
    transactions is read by one task, but worked on by many.

    Spark reads every member of an array of structs once two of them are used
    above an ``explode``. With ``members`` the array is first cut down to those,
    so that the scan reads no others.
    """
    transactions = F.col("transactions")
    if members is not None and set(members) != set(_element_members(blocks)):
        if members:
            transactions = F.arrays_zip(
                *[F.col("transactions")[m].alias(m) for m in members]
            )
        else:
            first = _element_members(blocks)[0]
            transactions = F.arrays_zip(F.col("transactions")[first].alias(first))
    position = "position" if with_position else None
    if spread is None:
        return unnest(blocks, transactions, "transaction", carried, position)
    pieces = _pieces(blocks, transactions, carried, spread)
    names = [name for name in pieces.columns if name != "__piece"]
    rows = unnest(pieces, "__piece.items", "transaction", [*names, F.col("__piece.before")], position)
    if position is not None:
        rows = rows.withColumn(position, F.col(position) + F.col("before"))
    return rows.drop("before")


def _pieces(
    blocks: DataFrame, transactions: Column, carried: Sequence[Column], size: int
) -> DataFrame:
    """Carried columns and ``__piece``, up to ``size`` transactions of a block, dealt out.

    All pieces of a block are cut in one go: generated one by one, each would take a copy
    of the whole block along.
    """
    if size <= 0:
        raise InvalidArgument(f"pieces must hold transactions: {size}")
    listed = blocks.select(*carried, transactions.alias("__all"))
    begins = F.sequence(F.lit(0), F.greatest(F.size("__all") - 1, F.lit(0)), F.lit(size))
    cut = F.transform(
        begins, lambda k: F.struct(k.alias("before"), F.slice("__all", k + 1, size).alias("items"))
    )
    names = [name for name in listed.columns if name != "__all"]
    return listed.select(*names, F.explode(cut).alias("__piece")).repartition(
        F.col(_POSITION), F.col("__piece.before")
    )


def unnest(
    df: DataFrame,
    items: Column | str,
    item: str,
    carried: Sequence[Column | str],
    position: str | None = None,
) -> DataFrame:
    """One row per element of a list, with the carried columns; none for an empty list.

    A NULL element is an element with nothing set, whichever of its members are read.
    From a plain ``explode`` Spark derives the filter that the list has elements
    and pushes it down to the scan. Where the list is built by an expression
    that means building it twice, the first time before any pruning. The outer
    form, with the rows of empty lists taken out again, builds it once.
    """
    place = position or _PLACE
    rows = df.select(*carried, F.posexplode_outer(items).alias(place, item))
    # Not "is not null": Spark runs such tests after others that don't use the column,
    # and the checks of callers would then see the rows of empty lists.
    rows = rows.where(F.col(place) >= 0)
    return rows if position else rows.drop(place)


def is_streamed(rows: DataFrame) -> bool:
    return EVENT in rows.columns


def height(family: str) -> Column:
    return F.col(HEIGHT[family])


def position_of(blocks: DataFrame, family: str) -> Column:
    """What rows are laid out by: the event's sequence, or the block's height."""
    return F.col(f"{EVENT}.sequence_num") if is_streamed(blocks) else height(family)


def key_columns(family: str) -> list[Column]:
    """What tells blocks apart, by the names that the split layout gives it."""
    keys = ("tag", HEIGHT[family], HASH[family])
    return [F.col(key).alias(name) for key, name in zip(keys, BLOCK_KEYS)]


def carried_columns(blocks: DataFrame, family: str) -> list[Column]:
    carried = [position_of(blocks, family).alias(_POSITION)]
    if is_streamed(blocks):
        carried.append(F.col(EVENT))
    return carried


def _refuse_wrapping(rows: DataFrame, u64: str) -> None:
    """Without ANSI casts, what is past 2^63-1 would come out negative instead of failing."""
    ansi = rows.sparkSession.conf.get("spark.sql.ansi.enabled", "true") == "true"
    if u64 == "long" and not ansi and U64_TYPES["decimal"].simpleString() in rows.schema.simpleString():
        raise InvalidArgument("unsigned values need spark.sql.ansi.enabled, or u64='decimal'")


def project(
    rows: DataFrame,
    fields: Sequence[Field],
    *,
    position: Column | None = None,
    partition_by_size: int = 0,
    u64: str = "long",
    carried: Sequence[str] = (),
) -> DataFrame:
    """The table's columns: event columns if streamed, payload, then the layout; before
    them the ``carried`` columns of ``rows``."""
    wanted = u64_type(u64)
    _refuse_wrapping(rows, u64)
    position = F.col(_POSITION) if position is None else position
    position = F.coalesce(position.cast(wanted), F.lit(0).cast(wanted))
    prefix = EVENT_FIELDS if is_streamed(rows) else ()
    columns = [
        f.column_of(u64).alias(f.name, metadata={"comment": f.comment})
        for f in (*prefix, *fields)
    ]
    return rows.select(
        *carried,
        *columns,
        partition_floor(position, partition_by_size)
        .cast(wanted)
        .alias(PARTITION_BY, metadata={PARTITION_SIZE: partition_by_size}),
        position.alias(RANGE_BY),
    )


def streamed(
    resolved: DataFrame, columns: Sequence[str], *, partition_by_size: int = 0, u64: str = "long"
) -> DataFrame:
    """Rows of a table that were built before their events were joined, in streamed form:
    the ``columns``, the event's columns, and the layout by the event's sequence."""
    position = F.col(f"{EVENT}.sequence_num")
    return project(
        resolved, (), position=position, partition_by_size=partition_by_size, u64=u64, carried=columns
    )


def join_headers(transactions: DataFrame, headers: DataFrame, block: Column) -> DataFrame:
    """Split layout: put the built ``block`` of each transaction beside it.

    Only the key and the built column of the headers are shuffled. The
    transactions are the left, splittable side, so adaptive execution can cut up
    a block that holds a large part of them. A transaction without a header
    fails the job; a filter on ``block`` further up may drop it before.
    """
    slim = headers.select(
        F.col("tag").alias("__tag"),
        F.col("height").alias("__height"),
        F.col("hash").alias("__hash"),
        block.alias("block"),
        F.lit(True).alias("__found"),
    )
    same = (
        (F.col("tag") == F.col("__tag"))
        & (F.col("height") == F.col("__height"))
        & (F.col("hash") == F.col("__hash"))
    )
    joined = transactions.join(slim, same, "left")
    message = F.concat(F.lit("header is required (hash="), F.col("hash"), F.lit(")"))
    return joined.where(require(F.col("__found").isNull(), message)).drop(
        "__tag", "__height", "__hash", "__found"
    )
