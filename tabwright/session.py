"""Session settings for runs that are not handed a session by the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(
    cpus: int | str = 8, memory: str = "12g", app: str = "tabwright", settings: dict[str, str] | None = None
) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus).replace("*", "8"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for name, value in (settings or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
