"""Standard blockchain tables from parsed blocks and chain events, on Spark."""

from blockloom.builders import build, register_builder
from blockloom.errors import InvalidArgument, NotFound
from blockloom.ledger import BatchQuery, Ledger, StreamQuery
from blockloom.schemas.tables import TableKey
from blockloom.sources.metadata import ChainMetadata

__all__ = [
    "BatchQuery",
    "ChainMetadata",
    "InvalidArgument",
    "Ledger",
    "NotFound",
    "StreamQuery",
    "TableKey",
    "build",
    "register_builder",
]
