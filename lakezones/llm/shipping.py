"""Make this library importable in the tasks of a session."""

from __future__ import annotations

import io
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import SparkSession

import lakezones
from lakezones import prepare_session
from lakezones.llm.text import filesystem, shared_folder
from lakezones.session import scratch_path


# Texts are long: batches for Python workers are bounded by fewer rows than usual, and in bytes.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings of the library and its code sent to the executors."""
    _send(spark.sparkContext.applicationId)
    for name, value in BATCHES.items():
        spark.conf.set(name, value)
    return prepare_session(spark)


@cache
def _send(application: str) -> None:
    """Send the package through the shared folder, once for each application."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    root = Path(lakezones.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    folder = shared_folder(spark, scratch_path(spark, "code"))
    store, name = filesystem(folder)
    store.create_dir(name, recursive=True)
    with store.open_output_stream(f"{name}/lakezones.zip", compression=None) as out:
        out.write(packed.getvalue())
    spark.sparkContext.addPyFile(f"{folder}/lakezones.zip")
