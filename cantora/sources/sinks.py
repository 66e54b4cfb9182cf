"""Stage outputs, model tables, exports and the optional relational database."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from cantora import schemas


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ("artist_dir",), mode: str = "overwrite") -> None:
    """Stage output as Parquet. Rows of one partition value may come from many tasks, so a
    dominant artist is written by all of them."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV export whose cells may hold line breaks and quotes, and keep their outer white space."""
    (
        df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def append_new(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Append the rows whose key is not stored yet; stored rows are never overwritten."""
    spark = df.sparkSession
    try:
        stored = spark.read.parquet(path).select(*keys)
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        df.write.parquet(path)
        return
    df.join(stored, list(keys), "left_anti").write.mode("append").parquet(path)


# ---- model tables -----------------------------------------------------------------------


def _name(database: str | None, table: str) -> str:
    return f"{database}.{table}" if database else table


def create_tables(spark: SparkSession, database: str | None = None, buckets: int | None = None) -> None:
    """Create the model tables that do not exist yet.

    With ``buckets``, tables are bucketed by the key their big joins use, so lyrics, tracks and
    word counts of one bucket meet without a shuffle. Use the same number in every write.
    """
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, schema in schemas.TABLES.items():
        recover_table(spark, table, database)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        key = schemas.BUCKET_KEYS.get(table)
        clustered = f"CLUSTERED BY ({key}) INTO {buckets} BUCKETS" if buckets and key else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(database, table)} ({columns}) USING parquet {clustered}")


def drop_tables(spark: SparkSession, database: str | None = None, confirm: bool = False) -> None:
    """Drop all model tables, children first; only when confirmed."""
    if not confirm:
        raise ValueError("drop_tables deletes every model table; pass confirm=True")
    for table in reversed(list(schemas.TABLES)):
        spark.sql(f"DROP TABLE IF EXISTS {_name(database, table)}")


def stored(spark: SparkSession, table: str, database: str | None = None) -> DataFrame:
    return spark.table(_name(database, table))


def _writer(df: DataFrame, table: str, buckets: int | None):
    """Writer of rows in the table's types; bucketed rows are hashed first, one file a bucket."""
    schema = schemas.TABLES[table]
    typed = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    key = schemas.BUCKET_KEYS.get(table)
    if not (buckets and key):
        return typed.write.format("parquet")
    return typed.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key)


def append_rows(df: DataFrame, table: str, database: str | None = None, buckets: int | None = None) -> None:
    _writer(df, table, buckets).mode("append").saveAsTable(_name(database, table))


def recover_table(spark: SparkSession, table: str, database: str | None = None) -> None:
    """Finish a replacement that stopped between its last two steps.

    The side table takes the name only after it is complete, so where the name is absent and a side
    table exists, the side table is the table.
    """
    name, side = _name(database, table), _name(database, f"{table}__new")
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(side):
        spark.sql(f"ALTER TABLE {side} RENAME TO {name}")


def replace_table(df: DataFrame, table: str, database: str | None = None, buckets: int | None = None) -> None:
    """Full refresh: the new rows go to a side table first, which then takes the name.

    ``df`` may read the very table it replaces. A crash at any point leaves the old rows or the new
    ones under one of the two names, and the next run recovers them.
    """
    spark = df.sparkSession
    recover_table(spark, table, database)
    name, side = _name(database, table), _name(database, f"{table}__new")
    spark.sql(f"DROP TABLE IF EXISTS {side}")
    _writer(df, table, buckets).saveAsTable(side)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {side} RENAME TO {name}")


# ---- relational database (the caller brings the driver) ---------------------------------


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch: int = 10_000, mode: str = "append") -> None:
    """Bulk insert through JDBC, in batches, from all tasks."""
    df.write.option("batchsize", batch).jdbc(url, table, mode=mode, properties=dict(properties))


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
    column: str | None = None, lower: int | None = None, upper: int | None = None, partitions: int | None = None,
) -> DataFrame:
    """Relational scan; with a numeric column and bounds, split over that many tasks."""
    if column is None:
        return spark.read.jdbc(url, table, properties=dict(properties))
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions, properties=dict(properties)
    )
