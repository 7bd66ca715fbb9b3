"""Settings that last no longer than the work they are for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: What a comparison adapts to its tables.
TUNED = ("spark.sql.shuffle.partitions", "spark.sql.codegen.hugeMethodLimit")


@contextmanager
def restored_settings(spark: SparkSession, keys: tuple[str, ...] = TUNED) -> Iterator[None]:
    """Put these settings back as they were when the block ends."""
    before = {key: spark.conf.get(key, None) for key in keys}
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def child_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that begins with the settings of ``spark``.

    Work in parallel threads takes one each, so that none changes the settings of another.
    """
    child = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and child.conf.isModifiable(key) and child.conf.get(key, None) != value:
            child.conf.set(key, value)
    return child
