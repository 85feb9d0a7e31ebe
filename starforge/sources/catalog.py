"""SQL catalog entries for published tables (external parquet tables)."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import urlsplit

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from .store import TableStore, list_files, touch

# Folder of the store with one file per database that registered its tables.
DATABASES = "_databases"


def column_ddl(schema: StructType) -> str:
    return ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_table_sql(database: str, name: str, schema: StructType, location: str, partition_by: Iterable[str] = ()) -> str:
    parts = list(partition_by)
    part_sql = f"\nPARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
    return (
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` (\n  {column_ddl(schema)}\n)\n"
        f"USING parquet{part_sql}\nLOCATION '{location}'"
    )


def ddl_script(store: TableStore, database: str, names: Iterable[str]) -> str:
    """The whole DDL text (database + one CREATE TABLE per published table)."""
    stmts = [f"CREATE DATABASE IF NOT EXISTS `{database}`"]
    for n in names:
        stmts.append(create_table_sql(database, n, store.read(n).schema, store.location(n), store.partition_columns(n)))
    return ";\n\n".join(stmts) + ";\n"


def register_tables(spark: SparkSession, store: TableStore, database: str, names: Iterable[str]) -> list[str]:
    """Create or re-point one external table per published table.

    An existing entry is moved to the table's current snapshot; one whose
    columns have changed is made anew (an external table: its files stay).
    The store remembers the database, so that each later publish moves the
    entries itself (``repoint``).
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    done = []
    for n in names:
        _point(spark, store, database, n)
        done.append(n)
    touch(spark, f"{store.root}/{DATABASES}/{database}")
    return done


def _point(spark: SparkSession, store: TableStore, database: str, name: str) -> None:
    entry, loc = f"`{database}`.`{name}`", store.location(name)
    schema, parts = store.read(name).schema, store.partition_columns(name)
    if spark.catalog.tableExists(f"{database}.{name}"):
        grown = _columns(spark.table(entry).schema) != _columns(schema)
        if grown or (parts and _entry_path(spark, entry) != _path(loc)):
            # partitions keep the folder they were found in, so they are found anew
            spark.sql(f"DROP TABLE {entry}")
        else:
            spark.sql(f"ALTER TABLE {entry} SET LOCATION '{loc}'")
    spark.sql(create_table_sql(database, name, schema, loc, parts))
    if parts:
        # adds new partitions and forgets those that are gone
        spark.sql(f"MSCK REPAIR TABLE {entry} SYNC PARTITIONS")
    spark.sql(f"REFRESH TABLE {entry}")


def _columns(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _path(location: str) -> str:
    """A location without its scheme (``file:/a`` and ``/a`` are one place)."""
    return "/" + urlsplit(location).path.strip("/")


def _entry_path(spark: SparkSession, entry: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {entry}").where("col_name = 'Location'").collect()
    return _path(rows[0].data_type) if rows else None


def repoint(spark: SparkSession, store: TableStore, names: Iterable[str]) -> None:
    """Move the entries of every database that registered this store.

    Only entries this session's catalog knows: a job without that catalog
    leaves them to the next ``register_tables``.
    """
    names = list(names)
    for database in list_files(spark, f"{store.root}/{DATABASES}"):
        for n in names:
            if spark.catalog.databaseExists(database) and spark.catalog.tableExists(f"{database}.{n}"):
                _point(spark, store, database, n)
