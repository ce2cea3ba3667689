"""Making this package importable on executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parent


def ship(spark: SparkSession | None = None) -> None:
    """Send the package to Python workers, once for each Spark context, wherever the driver found it."""
    spark = spark or SparkSession.active()
    context = spark.sparkContext
    if getattr(context, "_chalkline_sent", False):
        return
    target = Path(tempfile.mkdtemp()) / f"{_ROOT.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(_ROOT.rglob("*.py")):
            archive.write(source, source.relative_to(_ROOT.parent))
    context.addPyFile(str(target))
    context._chalkline_sent = True
