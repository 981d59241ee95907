"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that results or plans depend on. Trip times are zone-less, so the session
# zone must not shift them; AQE splits skewed join partitions and sizes shuffles.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles methods above this size; past it, wide projections run faster
    # as many small generated methods than as one large interpreted one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else made."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def conf_set(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Set session settings (dots written as __) for the actions inside the block."""
    named = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in named}
    try:
        for key, value in named.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def get_session(app_name: str = "tripmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach, for sinks and checkpoints.

    It lies under ``spark.checkpoint.dir``. Only a local-mode session without that
    setting gets a folder on this machine; a cluster without it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tripmill-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
