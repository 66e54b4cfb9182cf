"""Parquet tables in hashed partitions, of which a change rewrites only the ones it touches.

A table has a key, and the partition of a row is a hash of it modulo a fixed number. A change hands over
whole new contents of some partitions of some tables. They are written aside first, all of them, and then
take the place of the old ones folder by folder, without being written again; a run that stopped in between
is finished by the next.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART = "part"
TASK_BYTES = 16 << 20  # of stored rows


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    fs, found = _path(spark, path)
    return fs.exists(found)


def delete(spark: SparkSession, path: str) -> None:
    fs, found = _path(spark, path)
    fs.delete(found, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a path."""
    fs, found = _path(spark, path)
    return fs.getContentSummary(found).getLength()


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, found = _path(spark, source)
    place = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(place.getParent())
    if not fs.rename(found, place):
        raise OSError(f"{source} could not be moved to {target}")


@dataclass(frozen=True)
class PartitionedTables:
    """Tables below ``root``, each with the key that names its partitions (never NULL)."""

    root: str
    keys: Mapping[str, str]
    parts: int = 256

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def part(self, table: str) -> Column:
        return F.pmod(F.xxhash64(F.col(self.keys[table])), F.lit(self.parts)).cast("int")

    def placed(self, rows: DataFrame, table: str) -> DataFrame:
        """``rows`` with their partition, dealt out so that each makes one file, or a few where adaptive execution splits it."""
        return rows.withColumn(PART, self.part(table)).hint("rebalance", F.col(PART))

    def summed(self, rows: DataFrame, table: str, keys: Sequence[str], value: str) -> DataFrame:
        """Sums of ``value`` by ``keys``, the table's key among them, already placed: one shuffle for both."""
        return self.ranged(rows, table, self.path(table)).groupBy(PART, *keys).agg(F.sum(value).alias(value))

    def ranged(self, rows: DataFrame, table: str, like: str) -> DataFrame:
        """``rows`` with their partition, whole keys dealt out by ranges of both: each task holds few partitions.

        The tasks are as many as the bytes below ``like`` ask for, so that none grows with the table, nor is
        bound to the number of partitions.
        """
        spark = rows.sparkSession
        n = max(spark.sparkContext.defaultParallelism, -(-size(spark, like) // TASK_BYTES))
        return rows.withColumn(PART, self.part(table)).repartitionByRange(n, PART, self.keys[table])

    def _write(self, rows: DataFrame, table: str, path: str) -> None:
        if PART not in rows.columns:
            rows = self.placed(rows, table)
        rows.write.mode("overwrite").partitionBy(PART).parquet(path)

    def create(self, frames: Mapping[str, DataFrame]) -> None:
        """Write the tables anew. Rows with a column ``part`` are taken as placed, here and in ``replace``."""
        for table, rows in frames.items():
            self._write(rows, table, self.path(table))

    def stored(self, spark: SparkSession, table: str, touched: Sequence[int]) -> DataFrame:
        """Some partitions of a table, with their numbers: rows that lie where they are to be written need no shuffle."""
        return spark.read.parquet(self.path(table)).where(F.col(PART).isin(list(touched)))

    def read(self, spark: SparkSession, table: str, touched: Sequence[int] | None = None) -> DataFrame:
        """A table, or only some of its partitions: the filter prunes folders, not rows."""
        rows = spark.read.parquet(self.path(table))
        if touched is not None:
            rows = rows.where(F.col(PART).isin(list(touched)))
        return rows.drop(PART)

    def touched(self, keys: DataFrame, table: str) -> list[int]:
        """Partitions in which the keys lie; at most ``parts`` numbers."""
        return sorted(r[0] for r in keys.select(self.part(table)).distinct().toLocalIterator())

    def replace(self, spark: SparkSession, changes: Mapping[str, tuple[DataFrame, Sequence[int]]]) -> None:
        """Give the named partitions new contents: per table the rows and the partitions they fill or leave empty."""
        aside = f"{self.root}/next"
        delete(spark, aside)
        plan = []
        for table, (rows, touched) in changes.items():
            self._write(rows, table, f"{aside}/{table}")
            plan += [(table, int(p), exists(spark, f"{aside}/{table}/{PART}={p}")) for p in touched]
        # the folder is complete once the plan has been committed
        spark.createDataFrame(plan, "name string, part int, filled boolean").coalesce(1).write.parquet(f"{aside}/plan")
        self.recover(spark)

    def recover(self, spark: SparkSession) -> None:
        """Finish a replacement whose new contents are complete, drop one whose contents are not."""
        aside = f"{self.root}/next"
        if exists(spark, f"{aside}/plan/_SUCCESS"):
            plan = spark.read.parquet(f"{aside}/plan").collect()  # tables x partitions at most
            for table in self.keys:
                parts = [r for r in plan if r["name"] == table]
                for r in parts:
                    new, old = (f"{x}/{PART}={r['part']}" for x in (f"{aside}/{table}", self.path(table)))
                    if not r["filled"]:
                        delete(spark, old)
                    elif exists(spark, new):  # else a stopped run has moved it
                        delete(spark, old)
                        move(spark, new, old)
                if parts:
                    spark.catalog.refreshByPath(self.path(table))
        delete(spark, aside)
