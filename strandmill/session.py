"""Session helpers shared by every operator: shipping the package, shared scratch, lineage cuts."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
import zipfile
from collections.abc import Iterable, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession

if TYPE_CHECKING:
    import pandas as pd

_shipped: dict[str, str] = {}

#: Rows of an Arrow batch. Texts are long, and a batch is held by the JVM and by its Python worker at once.
BATCH_ROWS = 1024
FILES_PER_CORE = 8


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so Python workers can import it; see to small Arrow batches."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) in (0, 10000):  # the default: nobody chose a size
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="strandmill-"), "strandmill_pkg.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped[sc.applicationId] = path


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. A temporary one only where that is unset and there is one machine alone."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share: intermediate tables are written there")
        configured = tempfile.mkdtemp(prefix="strandmill-checkpoints-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
        delete_on_exit(spark, sc.getCheckpointDir())
    return configured


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate tables when the application ends."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)


def few_files(df: DataFrame) -> DataFrame:
    """At most ``FILES_PER_CORE`` partitions for each core: intermediate tables are small, and every file costs a few system calls and processes."""
    return df.coalesce(FILES_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files behind tables that are written by now: Spark's cleaner removes them once nothing refers to them.

    To be called where the written table's origin isn't known any more, not inside the function that writes it.
    """
    for _ in range(2):  # what Python forgets is only let go of by the JVM a moment later
        gc.collect()
        spark.sparkContext._jvm.java.lang.System.gc()
        time.sleep(0.4)


def settle(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder: later steps reread it, and a lost executor loses nothing."""
    shared_dir(df.sparkSession)
    return few_files(df).checkpoint(eager=True)


def spill(df: DataFrame) -> DataFrame:
    """Like :func:`settle`, but as a compressed Parquet table in the shared folder: for large intermediate tables. It goes with the application."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/strandmill-{uuid.uuid4().hex}"
    few_files(df).write.parquet(path)
    delete_on_exit(spark, path)  # which takes only what is there
    return spark.read.schema(df.schema).parquet(path)


def object_frame(rows: Iterable[Sequence], columns: Sequence[str]) -> pd.DataFrame:
    """A frame for Arrow-batched functions whose text columns are plain Python strings, whatever pandas would infer."""
    import pandas as pd  # only workers that use frames pay for it

    return pd.DataFrame(list(rows), columns=list(columns), dtype=object)
