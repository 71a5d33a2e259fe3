"""Give executors this package, as `spark-submit --py-files` would."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the session's Python files, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    if os.path.isdir(package):  # else it came as such a file itself
        handle, path = tempfile.mkstemp(prefix="stockweave-", suffix=".zip")
        with os.fdopen(handle, "wb") as f, zipfile.ZipFile(f, "w") as z:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, root))
        sc.addPyFile(path)  # the driver serves it as long as it runs
        atexit.register(os.remove, path)
    _SHIPPED.add(sc.applicationId)
