"""Sessions: the package reaches the executors, whatever path the driver imported it from."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's modules to the executors once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="docloom-")) / "docloom.zip"
        with zipfile.ZipFile(target, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(target))
        _shipped.add(app)
    return spark


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the cluster's checkpoint folder; a temporary one only where none is configured on a local master (tests)."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.match(r"local(\[|$)", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = "file://" + tempfile.mkdtemp(prefix="docloom-")
        context.setCheckpointDir(folder)
    return df.checkpoint()
