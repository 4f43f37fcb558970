"""Give the executors this package."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors of this application, once."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="spark-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
