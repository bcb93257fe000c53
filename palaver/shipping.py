"""Gets this package to the executors, whose Python need not find it by itself."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the application's Python files, once; a package that came as a file is there already."""
    context = spark.sparkContext
    home = Path(__file__).resolve().parent
    if context.applicationId in _sent or not home.is_dir():
        return
    path = Path(tempfile.mkdtemp(prefix="palaver-")) / "palaver.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(home.rglob("*.py")):
            out.write(file, Path("palaver") / file.relative_to(home))
    context.addPyFile(str(path))
    _sent.add(context.applicationId)
