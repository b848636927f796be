"""Table key -> builder. The one place that ties keys to operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from blockloom.errors import NotFound
from blockloom.operators.bitcoin import (
    bitcoin_blocks,
    bitcoin_split_transactions,
    bitcoin_transactions,
)
from blockloom.operators.evm import (
    evm_blocks,
    evm_raw_transactions,
    evm_split_transactions,
    evm_transactions,
)
from blockloom.operators.rosetta import (
    rosetta_blocks,
    rosetta_raw_transactions,
    rosetta_transactions,
)
from blockloom.schemas.tables import NATIVE, NONE, RAW, ROSETTA, TableKey, family_of, tables_of

Builder = Callable[..., DataFrame]

_EVM: dict[TableKey, Builder] = {
    TableKey("transactions"): evm_transactions,
    TableKey("blocks"): evm_blocks,
    TableKey("streamed_transactions"): evm_transactions,
    TableKey("streamed_blocks"): evm_blocks,
    TableKey("streamed_transactions", NATIVE, RAW): evm_raw_transactions,
}
_ROSETTA: dict[TableKey, Builder] = {
    TableKey("transactions", ROSETTA, NONE): rosetta_transactions,
    TableKey("blocks", ROSETTA, NONE): rosetta_blocks,
    TableKey("streamed_transactions", ROSETTA, RAW): rosetta_raw_transactions,
}
_BITCOIN: dict[TableKey, Builder] = {
    TableKey("transactions"): bitcoin_transactions,
    TableKey("blocks"): bitcoin_blocks,
}
_ADDED: dict[tuple[str, TableKey], tuple[str, Builder]] = {}


def register_builder(chain: str, key: TableKey, block_family: str, builder: Builder) -> None:
    """Add a table of one's own; ``block_family`` says which parsed blocks it reads."""
    if (chain, key) in _ADDED or key in tables_of(chain):
        raise ValueError(f"table {key} is already registered for {chain}")
    _ADDED[chain, key] = (block_family, builder)


def is_added(chain: str, key: TableKey) -> bool:
    """Whether the table was added with ``register_builder``."""
    return (chain, key) in _ADDED


def block_family(chain: str, key: TableKey) -> str:
    """Which parsed blocks a table reads."""
    if (chain, key) in _ADDED:
        return _ADDED[chain, key][0]
    return "rosetta" if key.format == ROSETTA else family_of(chain)


def build(
    chain: str,
    key: TableKey,
    blocks: DataFrame,
    *,
    partition_by_size: int = 0,
    u64: str = "long",
    **options,
) -> DataFrame:
    """The table from its blocks (streamed tables: from resolved events)."""
    options |= {"partition_by_size": partition_by_size, "u64": u64}
    if (chain, key) in _ADDED:
        return _ADDED[chain, key][1](blocks, **options)
    if key not in tables_of(chain):
        raise NotFound(f"no table {key} on chain {chain!r}")
    if key in _ROSETTA:
        return _ROSETTA[key](blocks, **options)
    if family_of(chain) == "bitcoin":
        return _BITCOIN[key](blocks, **options)
    if _EVM[key] is not evm_raw_transactions:
        options["chain"] = chain
    return _EVM[key](blocks, **options)


def is_split(chain: str, key: TableKey) -> bool:
    """Whether a table is built from transactions and headers apart, in a split store."""
    return (
        (chain, key) not in _ADDED
        and (key.format, key.encoding) == (NATIVE, NONE)
        and key.table in ("transactions", "streamed_transactions")
    )


def build_split(
    chain: str,
    key: TableKey,
    transactions: DataFrame,
    headers: DataFrame,
    *,
    partition_by_size: int = 0,
    u64: str = "long",
    **options,
) -> DataFrame:
    """The table from a split store (streamed tables: from resolved transactions)."""
    if key not in tables_of(chain) or not is_split(chain, key):
        raise NotFound(f"no split table {key} on chain {chain!r}")
    options |= {"partition_by_size": partition_by_size, "u64": u64}
    if family_of(chain) == "bitcoin":
        return bitcoin_split_transactions(transactions, headers, **options)
    return evm_split_transactions(transactions, headers, chain=chain, **options)
