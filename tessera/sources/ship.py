"""Makes this package importable on the executors, wherever the driver was started."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Hand the package's sources to Spark once for each context; Spark serves them to every executor."""
    context = spark.sparkContext
    if getattr(context, "_tessera_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="tessera-src-")) / f"{top.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    context.addPyFile(str(target))
    context._tessera_shipped = True
