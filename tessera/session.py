"""What every session needs to run Python functions of this package on executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package: where they would not find it by themselves, it is sent to them once."""
    root = Path(__file__).resolve().parents[1]
    sc = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_tessera_shipped", False):
        return
    d = tempfile.mkdtemp(prefix="tessera-")  # read by executors as long as the driver runs
    atexit.register(shutil.rmtree, d, True)
    sc.addPyFile(shutil.make_archive(f"{d}/tessera-package", "zip", root, "tessera"))
    sc._tessera_shipped = True
