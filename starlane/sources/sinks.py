"""Stage writes and the full-refresh publish."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from starlane.sources.contracts import TableContract, conform_to
from starlane.sources.versions import current_folder, names_below, new_version, remove, root_of, switch, tidy, undo


def write_stage(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    compact: bool = False,
) -> DataFrame:
    """Write a stage table as Parquet and return it read back from storage.

    The returned frame starts a fresh lineage: later steps re-read files instead
    of repeating the work, and the files' sizes tell the optimizer whether the
    table is small enough to broadcast.

    With ``partition_by`` the rows are rebalanced on those columns first, so one
    folder is written by few tasks, while AQE splits a folder that holds a large
    share of all rows over several of them. ``compact`` rebalances a result that a
    filter or lookup join has thinned out, so that thousands of scan tasks do not
    each leave a tiny file. ``sort_by`` orders the rows inside each file, which
    lets later filters on those columns skip row groups.
    """
    _write(_arranged(df, partition_by, sort_by, compact), path, mode, partition_by)
    # The schema is known, so reading back needs no job to look into a footer.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_observed(
    df: DataFrame,
    path: str,
    counts: Mapping[str, Column],
    hidden: Sequence[str] = (),
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    compact: bool = False,
) -> tuple[DataFrame, dict[str, int]]:
    """:func:`write_stage`, and aggregates over the rows that were written, taken as they were.

    ``hidden`` columns are there for the aggregates and are not written. The rows are observed
    where they are written, in the last stage, whose tasks count once however often they run.
    """
    seen = Observation()
    arranged = _arranged(df, partition_by, sort_by, compact)
    if counts:
        arranged = arranged.observe(seen, *[c.alias(name) for name, c in counts.items()])
    written = arranged.drop(*hidden)
    _write(written, path, mode, partition_by)
    return df.sparkSession.read.schema(written.schema).parquet(path), seen.get if counts else {}


def _arranged(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str], compact: bool) -> DataFrame:
    if partition_by or compact:
        df = df.hint("rebalance", *partition_by)
    return df.sortWithinPartitions(*partition_by, *sort_by) if sort_by else df


def _write(df: DataFrame, path: str, mode: str, partition_by: Sequence[str]) -> None:
    # Replacing a stage replaces all of its folders, whatever the session's default.
    out = df.write.mode(mode).option("partitionOverwriteMode", "static")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(path)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write a stage dealt into buckets by ``keys``, one sorted file each, and return it so known.

    Joins and aggregates of such stages on these keys, with equal numbers of buckets, need no
    exchange. The layout is known through the catalog only while the stage is opened. A
    key that holds a large share of all rows makes one large file, so bucket by keys that are
    spread.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *[f"`{k}`" for k in keys])
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    known = spark.table(name)
    known.schema  # resolved, so the name may go; the files stay
    spark.sql(f"DROP TABLE {name}")
    return known


def create_table(
    spark: SparkSession, contract: TableContract, table: str | None = None, location: str | None = None
) -> str:
    """Have the published table in the catalog; return its name.

    Without ``location`` it lies in the warehouse folder. The catalog of a session without
    Hive support forgets tables when the session ends, but their folders stay, so a table
    is registered again over the folder it has. A table or folder of another layout raises.
    """
    name = table or contract.name
    if spark.catalog.tableExists(name):
        check_layout(spark.table(name), contract, name)
        return name
    place = current_folder(spark, location or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}")
    if any(n.endswith(".parquet") for n in names_below(spark, place)):
        check_layout(spark.read.parquet(place), contract, place)
    _create(spark, name, contract, place)
    return name


def _create(spark: SparkSession, name: str, contract: TableContract, place: str) -> None:
    spark.sql(f"CREATE TABLE {name} ({contract.columns}) USING parquet LOCATION {_quoted(place)}")


def _quoted(place: str) -> str:
    return "'" + place.replace("'", "\\'") + "'"


class LayoutError(Exception):
    """A published table has other columns than its contract."""


def check_layout(df: DataFrame, contract: TableContract, name: str) -> None:
    """Raise unless names, order and types are the contract's (a varchar is a string in files)."""
    declared = [(f.name, "string" if isinstance(f.dataType, T.VarcharType) else f.dataType.simpleString()) for f in contract.schema]
    if df.dtypes != declared:
        raise LayoutError(f"{name} has the columns {df.dtypes}, the contract of {contract.name} has {declared}")


def read_published(spark: SparkSession, place: str, contract: TableContract | None = None) -> DataFrame:
    """The rows of a published folder, by its current version; needs no catalog.

    With the contract it was published by, no job looks into a footer for the columns.
    """
    reader = spark.read
    if contract:
        kinds = [T.StringType() if isinstance(f.dataType, T.VarcharType) else f.dataType for f in contract.schema]
        reader = reader.schema(T.StructType([T.StructField(f.name, k) for f, k in zip(contract.schema, kinds)]))
    return reader.parquet(current_folder(spark, place))


def publish_all(tables: Sequence[tuple[DataFrame, TableContract, str | None, str | None]]) -> list[DataFrame]:
    """Replace the content of several published tables, given as (rows, contract, name, location).

    Each of them is written as a new version beside the present one. Then one rename makes all
    new versions the current ones (:mod:`starlane.sources.versions`), and the catalog follows.
    Whatever fails on the way, a write, a rename or the catalog, leaves every table as it
    was. The version before stays until the next publish, for those who read it.
    """
    spark, ready = tables[0][0].sparkSession, []
    fresh, before, commit = {}, {}, None
    try:
        for df, contract, table, location in tables:
            name = create_table(spark, contract, table, location)
            before[name] = _location(spark, name)
            place = root_of(before[name])
            fresh[place] = new_version(place)
            ready.append((name, place))
        with ThreadPoolExecutor(len(tables)) as pool:
            write = inheritable_thread_target(_write_version)
            versions = [pool.submit(write, df, contract, name, fresh[place]) for (df, contract, _, _), (name, place) in zip(tables, ready)]
        for version in versions:
            version.result()
        commit = switch(spark, fresh)
        for name, place in ready:
            _locate(spark, name, fresh[place])
    except BaseException:
        if commit:
            undo(spark, commit)
        for name, place in before.items():
            if _location(spark, name) != place:
                _locate(spark, name, place)
        for version in fresh.values():
            remove(spark, version)
        raise
    for _, place in ready:
        tidy(spark, place)
    return [spark.table(name) for name, _ in ready]


def _location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"].rstrip("/")


def _locate(spark: SparkSession, name: str, place: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(place)}")
    spark.catalog.refreshTable(name)


def _write_version(df: DataFrame, contract: TableContract, name: str, place: str) -> None:
    """Write rows as a table, so that its declared lengths hold for them."""
    spark, staged = df.sparkSession, f"{name}__new_{uuid.uuid4().hex}"
    _create(spark, staged, contract, place)
    try:
        conform_to(df, contract).write.insertInto(staged, overwrite=True)
    finally:
        spark.sql(f"DROP TABLE {staged}")


def publish(
    df: DataFrame, contract: TableContract, table: str | None = None, location: str | None = None
) -> DataFrame:
    """Replace the whole content of a published table with ``df``.

    Rows are brought to the contract's layout first, and an over-long varchar
    value fails the write. Running it twice leaves the same rows as running it
    once. A table that exists already keeps its place. Check the frame
    (:mod:`starlane.operators.quality`) before publishing.
    """
    return publish_all([(df, contract, table, location)])[0]


def publish_jdbc(
    df: DataFrame,
    contract: TableContract,
    url: str,
    table: str | None = None,
    properties: Mapping[str, str] | None = None,
    batch_rows: int = 10_000,
    connections: int = 16,
) -> None:
    """Full refresh of a table in a SQL database: truncate it, keep its DDL, reload.

    ``connections`` bounds how many tasks write at once, since a database takes
    far fewer connections than a cluster has cores.
    """
    (
        conform_to(df, contract)
        .write.mode("overwrite")
        .option("truncate", "true")
        .option("batchsize", str(batch_rows))
        .option("numPartitions", str(connections))
        .jdbc(url, table or contract.name, properties=dict(properties or {}))
    )
