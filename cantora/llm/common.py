"""Helpers the operators share: table reads, the shared scratch folder, global positions."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cantora.session import shared_folder


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared folder of the cluster, deleted when the session's JVM ends.

    Only where ``spark.checkpoint.dir`` is unset, as in tests, a temporary folder takes its place.
    """
    base = shared_folder(spark, fallback="")
    if not base:
        base = tempfile.mkdtemp(prefix="cantora-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/cantora-{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return str(path.toString())


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the scratch folder and read back.

    This cuts the lineage in a way that outlives lost executors: whatever depends on task order or on
    sampled borders is fixed from here on.
    """
    spark = df.sparkSession
    path = scratch_folder(spark) + "/rows.parquet"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_position(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """``df`` with its 0-based place in the total order of ``order`` as a long column.

    Range partitions on the whole order split any hot leading value; each task sorts its own range. The
    ranges are stored before they are counted, as sampled borders may differ from run to run. Only one
    count per partition reaches the driver.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = stored(ranged.withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted(kept.groupBy(part.alias("part")).count().toLocalIterator())
    starts, total = [], 0
    for row in counts:
        starts.append((row["part"], total))
        total += row["count"]
    offsets = spark.createDataFrame(starts, "_part long, _start long")
    return (
        kept.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # as many rows as partitions
        .withColumn(name, F.col("_start") + place)
        .drop("_at", "_part", "_start")
    )


Batches = Iterator[pa.RecordBatch] | Iterator[pa.Array]


def tidy(scan: Callable[[Batches], Batches], *caches: Callable[[], None]) -> Callable[[Batches], Batches]:
    """``scan``, with its caches emptied and unused memory given back when a task ends.

    Python workers are reused by later stages, next to which a full cache would only take room.
    """

    def run(batches: Batches) -> Batches:
        try:
            yield from scan(batches)
        finally:
            for clear in caches:
                clear()
            gc.collect()
            pa.default_memory_pool().release_unused()

    return run


def packed(data: bytes) -> bytes:
    """``data`` compressed, its length first."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else untouched."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def document_key(docs: DataFrame) -> Column:
    """Key of a row by id and text, so that rows with a NULL or repeated id stay apart."""
    return F.unhex(F.md5(F.concat_ws("\0", docs["doc_id"].cast("string"), F.lit("|"), docs["text"])))
