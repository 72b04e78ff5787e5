"""Catalog names for store tables, and the bootstrap-if-absent branch.

Each registered view selects a table's newest commit by path and partition
filters, so queries by name read exactly what ``LakeStore.read`` reads.
Columns are cast to the commit's types, as a partition column's type is
otherwise inferred from the folders that happen to exist.
:func:`replay_with_views` refreshes the views after a replay; readers never see
a half-written version because the view text changes only after the commit
record exists.  A view reads folders of its version, so a store that vacuums
on publish must retain the versions that views may still name.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from ..sinks.lake import SCD, SNAPSHOT, LakeStore
from ..sinks.partitioned import PartitionedStore
from ..specs import END_DATE, Registry
from .pipeline import BatchReport, load_once, replay


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def view_sql(store: LakeStore, table: str) -> str:
    """``SELECT`` over the table's newest commit (partition-pruned)."""
    head = store.head(table)
    if head is None:
        raise FileNotFoundError(f"table {table!r} has no commit under {store.root}")
    cols = ", ".join(f"CAST({_ident(c.name)} AS {c.dataType.simpleString()}) AS {_ident(c.name)}" for c in head.schema)
    path = store.table_path(table).replace("`", "``")
    if head.kind == SNAPSHOT:
        return f"SELECT {cols} FROM parquet.`{path}/seq={head.seq}`"
    where = f"seq BETWEEN {head.read_from} AND {head.seq}"
    gaps = sorted(set(range(head.read_from, head.seq)) - set(head.seqs))  # attempts that were never published
    if gaps:
        where += f" AND seq NOT IN ({', '.join(map(str, gaps))})"
    if head.kind == SCD:
        where = f"(seq = {head.seq} AND {END_DATE} IS NULL) OR ({END_DATE} IS NOT NULL AND {where})"
    return f"SELECT {cols} FROM parquet.`{path}` WHERE {where}"


def register(spark: SparkSession, store: LakeStore, tables: Iterable[str] | None = None, database: str | None = None) -> list[str]:
    """Create or replace one view per table: temporary views when no
    database is given, otherwise persistent views in ``database``."""
    names = list(tables) if tables is not None else store.tables()
    done = []
    if database and isinstance(store, PartitionedStore):
        raise ValueError("a PartitionedStore's tables are named by temporary views only (no database)")
    for t in names:
        if not store.exists(t):
            continue
        if isinstance(store, PartitionedStore):
            store.read(t).createOrReplaceTempView(t)
        elif database:
            spark.sql(f"CREATE OR REPLACE VIEW {_ident(database)}.{_ident(t)} AS {view_sql(store, t)}")
        else:
            spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {_ident(t)} AS {view_sql(store, t)}")
        done.append(t)
    return done


def replay_with_views(
    spark: SparkSession, store: LakeStore, registry: Registry, source_root: str, fact_table: str, database: str | None = None, **options
) -> list[BatchReport]:
    """:func:`replay`, then :func:`register` for every table of the registry,
    also when a batch fails: the tables loaded before it are named."""
    try:
        return replay(spark, store, registry, source_root, fact_table, **options)
    finally:
        register(spark, store, [s.target for s in registry], database)


def bootstrap_database(spark: SparkSession, store: LakeStore, registry: Registry, base_dir: str, database: str, sep: str = "|") -> bool:
    """Run the one-time load only when ``database`` does not exist yet;
    then create it and name the loaded tables in it.  True when it loaded.

    In a database that is there, tables of the store without a name in it (an
    earlier run crashed before naming them) are named."""
    present = spark.catalog.databaseExists(database)
    if not present:
        load_once(spark, store, registry, base_dir, sep)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(database)}")
    names = [s.target for s in registry]
    register(spark, store, [t for t in names if not (present and spark.catalog.tableExists(f"{_ident(database)}.{_ident(t)}"))], database)
    return not present
