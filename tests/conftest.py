import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cantora.session import local_session

    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session("tests", cores="4", shuffle_partitions=4, spark__sql__warehouse__dir=str(warehouse))
    yield session
    session.stop()


@pytest.fixture()
def one(spark):
    """Evaluate column expressions over a single text value."""
    from pyspark.sql import functions as F

    def run(build, *values, types=None):
        cols = [f"c{i}" for i in range(len(values))]
        ddl = ", ".join(f"{c} {t}" for c, t in zip(cols, types or ["string"] * len(values)))
        df = spark.createDataFrame([tuple(values)], ddl)
        return df.select(build(*[F.col(c) for c in cols]).alias("r")).first()["r"]

    return run


def run_many(spark, build, values):
    """Evaluate one column expression over many texts, in order."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string").coalesce(1)
    return [r["r"] for r in df.select("i", build(F.col("x")).alias("r")).orderBy("i").collect()]
