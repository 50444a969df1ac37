"""Sending this package to the executors, whose Python workers import it, and
giving back what a worker no longer needs."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import SparkSession

import cierre

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application: add the package's sources as a Python file.

    A package that was itself submitted as an archive is there already.
    """
    sc, root = spark.sparkContext, os.path.dirname(os.path.abspath(cierre.__file__))
    if sc.applicationId in _SHIPPED or not os.path.isdir(root):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="cierre-code-"), "cierre_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("cierre", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def give_back() -> None:
    """Return freed memory to the system at the end of a task: a worker waits for its
    next one, which may be of another stage, and counts towards its executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library, which has no such call
