"""Spark-native curation of training data: declarative DataFrame operators over raw sources, layouts and texts."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once a Spark application, so that their Python workers can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = Path(__file__).parent
    out = Path(tempfile.mkdtemp(prefix="quillmill-")) / "quillmill.zip"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    sc.addPyFile(str(out))
    _SHIPPED.add(sc.applicationId)


def shipped(f: Callable) -> Callable:
    """``f(spark, ...)``, after :func:`ship`."""

    @functools.wraps(f)
    def run(spark: SparkSession, *args, **kwargs):
        ship(spark)
        return f(spark, *args, **kwargs)

    return run
