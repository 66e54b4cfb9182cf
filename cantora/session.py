"""Session helpers. Library code never changes the settings of a session it is given."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(
    app: str = "cantora", cores: str = "8", shuffle_partitions: int = 8, **settings: str
) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own.

    ``settings`` are further options, with double underscores for the dots.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """Folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    ``fallback`` is used only where the setting is absent, as in tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if fallback is None:
        raise ValueError("spark.checkpoint.dir is not set and no fallback folder was given")
    return fallback
