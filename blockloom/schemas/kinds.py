"""Field kinds: each knows its Spark type and how to fill it from a source column.

A table is a list of :class:`Field`. Its schema and its projection both come
from that list, so they cannot drift apart.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockloom.functions import scalars

U64_TYPES: dict[str, T.DataType] = {"long": T.LongType(), "decimal": T.DecimalType(20, 0)}


def u64_type(policy: str) -> T.DataType:
    """Spark type of an unsigned 64-bit value: ``long`` (errors past 2^63-1) or ``decimal``."""
    try:
        return U64_TYPES[policy]
    except KeyError:
        raise ValueError(f"u64 must be one of {sorted(U64_TYPES)}: {policy}") from None


class Kind:
    def dtype(self, u64: str) -> T.DataType:
        raise NotImplementedError

    def column(self, source: Column, u64: str) -> Column:
        raise NotImplementedError


class _Text(Kind):
    def dtype(self, u64):
        return T.StringType()

    def column(self, source, u64):
        return scalars.default_to(source, "")


class _U64(Kind):
    def dtype(self, u64):
        return u64_type(u64)

    def column(self, source, u64):
        wanted = u64_type(u64)
        return F.coalesce(source.cast(wanted), F.lit(0).cast(wanted))


class _Sequence(Kind):
    """Signed 64-bit, whatever the policy for unsigned ones."""

    def dtype(self, u64):
        return T.LongType()

    def column(self, source, u64):
        return F.coalesce(source.cast("bigint"), F.lit(0).cast("bigint"))


class _Flag(Kind):
    def dtype(self, u64):
        return T.BooleanType()

    def column(self, source, u64):
        return scalars.default_to(source, False)


class _Amount(Kind):
    def dtype(self, u64):
        return T.DecimalType(38, 0)

    def column(self, source, u64):
        return scalars.decimal38(source)


class _Metadata(Kind):
    def dtype(self, u64):
        return T.StringType()

    def column(self, source, u64):
        return scalars.metadata_json(source)


class _Count(Kind):
    def dtype(self, u64):
        return u64_type(u64)

    def column(self, source, u64):
        return scalars.element_count(source).cast(u64_type(u64))


class _Bytes(Kind):
    def dtype(self, u64):
        return T.BinaryType()

    def column(self, source, u64):
        return source


@dataclass(frozen=True)
class EnumName(Kind):
    names: tuple[tuple[int, str], ...]

    def dtype(self, u64):
        return T.StringType()

    def column(self, source, u64):
        return scalars.enum_name(source, dict(self.names))


TEXT = _Text()
U64 = _U64()
SEQUENCE = _Sequence()
FLAG = _Flag()
AMOUNT = _Amount()
METADATA = _Metadata()
COUNT = _Count()
BYTES = _Bytes()
EVENT_TYPE = EnumName(tuple(scalars.EVENT_TYPES.items()))
COIN_ACTION = EnumName(tuple(scalars.COIN_ACTIONS.items()))
DIRECTION = EnumName(tuple(scalars.DIRECTIONS.items()))


@dataclass(frozen=True)
class Field:
    """One output column or struct member.

    ``source`` is a dotted path below the source column; an empty path is the
    source itself.
    """

    name: str
    kind: Kind
    source: str
    comment: str

    def spark_field(self, u64: str) -> T.StructField:
        return T.StructField(self.name, self.kind.dtype(u64), True, {"comment": self.comment})

    def column(self, source: Column, u64: str) -> Column:
        for step in filter(None, self.source.split(".")):
            source = source[step]
        return self.kind.column(source, u64)

    def column_of(self, u64: str) -> Column:
        """The same from a column of the row, named by the path."""
        return self.kind.column(F.col(self.source), u64)


@dataclass(frozen=True)
class Struct(Kind):
    """Always present; the members of an unset source hold their defaults."""

    fields: tuple[Field, ...]

    def dtype(self, u64):
        return T.StructType([f.spark_field(u64) for f in self.fields])

    def column(self, source, u64):
        return F.struct(*[f.column(source, u64).alias(f.name) for f in self.fields])


@dataclass(frozen=True)
class ListOf(Kind):
    """A list; NULL when it has no elements."""

    element: Kind

    def dtype(self, u64):
        return T.ArrayType(self.element.dtype(u64), True)

    def column(self, source, u64):
        if isinstance(self.element, _Text):
            return scalars.null_if_empty(source)
        if isinstance(self.element, _U64):
            return scalars.null_if_empty(source, source.cast(self.dtype(u64)))
        return scalars.null_if_empty(
            source, F.transform(source, lambda item: self.element.column(item, u64))
        )


@dataclass(frozen=True)
class IndexedListOf(Kind):
    """A list of structs whose first member is the element's position."""

    position: Field
    fields: tuple[Field, ...]

    def dtype(self, u64):
        members = (self.position, *self.fields)
        return T.ArrayType(T.StructType([f.spark_field(u64) for f in members]), True)

    def column(self, source, u64):
        def build(item: Column, i: Column) -> Column:
            return F.struct(
                self.position.kind.column(i, u64).alias(self.position.name),
                *[f.column(item, u64).alias(f.name) for f in self.fields],
            )

        return scalars.null_if_empty(source, F.transform(source, build))


@dataclass(frozen=True)
class Prebuilt(Kind):
    """Taken as it is: built once per block, before its transactions are unnested."""

    kind: Kind

    def dtype(self, u64):
        return self.kind.dtype(u64)

    def column(self, source, u64):
        return source


@dataclass(frozen=True)
class Derived(Kind):
    """A text list taken from one member of each element of a list of structs."""

    take: Callable[[Column], Column]

    def dtype(self, u64):
        return T.ArrayType(T.StringType(), True)

    def column(self, source, u64):
        return scalars.null_if_empty(
            source, F.transform(source, lambda item: scalars.default_to(self.take(item), ""))
        )


def struct_type(fields: Sequence[Field], u64: str) -> T.StructType:
    return T.StructType([f.spark_field(u64) for f in fields])
