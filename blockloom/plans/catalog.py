"""The tables of a chain as a catalog: keys, schemas, views."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from blockloom.errors import NotFound
from blockloom.schemas.tables import NATIVE, NONE, PARTITION_BY, TableKey, table_schema, tables_of
from blockloom.sinks.files import names

_LISTING = (
    "table_key STRING, table STRING, format STRING, encoding STRING, columns BIGINT, "
    "schema_ddl STRING, total_records BIGINT, total_bytes BIGINT"
)
# Sizes are not known before a range is asked for.
UNKNOWN_SIZE = -1


def schema_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def get_schema(
    chain: str,
    table: str,
    format: str = NATIVE,
    encoding: str = NONE,
    *,
    u64: str = "long",
) -> T.StructType:
    """Schema with column comments; an unknown table is an error."""
    return table_schema(chain, TableKey(table, format, encoding), u64)


def tables_for(chain: str, network: str) -> list[TableKey]:
    return tables_of(chain, network)


def list_tables(
    spark: SparkSession,
    chain: str,
    network: str | None = None,
    *,
    u64: str = "long",
    database: str | None = None,
    prefix: str = "",
) -> DataFrame:
    """One row per table of the chain (and network).

    With a ``database`` that :func:`create_tables` has filled, the rows and bytes are those
    of the last :func:`refresh_table`; of tables that aren't there they are unknown (-1).
    """
    rows = []
    for key in tables_of(chain, network):
        schema = table_schema(chain, key, u64)
        records = size = UNKNOWN_SIZE
        if database is not None:
            records, size = table_size(spark, f"{database}.{prefix}{view_name(key)}")
        rows.append(
            (
                str(key),
                key.table,
                key.format,
                key.encoding,
                len(schema),
                schema_ddl(schema),
                records,
                size,
            )
        )
    return spark.createDataFrame(rows, _LISTING)


def table_path(root: str, key: TableKey) -> str:
    return f"{root.rstrip('/')}/{key}"


def view_name(key: TableKey) -> str:
    parts = [key.table]
    if key.format != NATIVE:
        parts.append(key.format)
    if key.encoding != NONE:
        parts.append(key.encoding)
    return "_".join(parts)


def register_tables(
    spark: SparkSession,
    root: str,
    chain: str,
    network: str | None = None,
    *,
    prefix: str = "",
    u64: str = "long",
) -> list[str]:
    """A temporary view over each table written below ``root``; names of the views.

    Schemas are given, so no file is opened to find them out; ``u64`` is what the
    tables were written with. Tables not written yet are left out.
    """
    names = []
    for key in tables_of(chain, network):
        reader = spark.read.schema(table_schema(chain, key, u64))
        try:
            df = reader.parquet(table_path(root, key))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        names.append(prefix + view_name(key))
        df.createOrReplaceTempView(names[-1])
    return names


def create_tables(
    spark: SparkSession,
    root: str,
    chain: str,
    network: str | None = None,
    *,
    database: str = "default",
    prefix: str = "",
    u64: str = "long",
) -> list[str]:
    """A table in the session's catalog for each one written below ``root``; their names.

    Unlike :func:`register_tables` these outlast the session where its catalog does. Their
    columns keep their comments; they are partitioned by directory, so SQL that names
    ``_partition_by`` lists only those. Tables not written yet are left out; one that is
    there already is refreshed. Rows that are written later show after
    :func:`refresh_table`.
    """
    made = []
    for key in tables_of(chain, network):
        path = table_path(root, key)
        if not any(name.startswith(f"{PARTITION_BY}=") for name in names(spark, path)):
            continue
        name = f"{database}.{prefix}{view_name(key)}"
        columns, place = table_schema(chain, key, u64).toDDL(), path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"PARTITIONED BY ({PARTITION_BY}) LOCATION '{place}'"
        )
        refresh_table(spark, name)
        made.append(name)
    return made


def refresh_table(spark: SparkSession, name: str) -> None:
    """Take up directories that have come since, and count rows and bytes.

    Rows are counted without reading a column: files say in their footers how many they have.
    """
    if not spark.catalog.tableExists(name):
        raise NotFound(f"no table {name}")
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")


def table_size(spark: SparkSession, name: str) -> tuple[int, int]:
    """Rows and bytes of a table as last counted; -1 where that isn't known."""
    if not spark.catalog.tableExists(name):
        return UNKNOWN_SIZE, UNKNOWN_SIZE
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Statistics'").first()
    words = (told["data_type"] if told else "").replace(",", "").split()
    known = {unit: int(count) for count, unit in zip(words[::2], words[1::2])}
    return known.get("rows", UNKNOWN_SIZE), known.get("bytes", UNKNOWN_SIZE)
