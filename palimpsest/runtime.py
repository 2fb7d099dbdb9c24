"""Session helpers shared by every layer: code shipping, checkpoints, sizing."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
ARROW_BYTES, MOST_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    The archive goes through the driver's file server, so executors need no shared
    folder and no particular working directory. Arrow batches are held to MOST_ARROW_BYTES,
    as each is in memory twice, in the executor and in its Python worker.
    """
    if int(spark.conf.get(ARROW_BYTES, str(MOST_ARROW_BYTES)).rstrip("b")) > MOST_ARROW_BYTES:
        spark.conf.set(ARROW_BYTES, str(MOST_ARROW_BYTES))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="palimpsest-"), "palimpsest_code.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("palimpsest", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage: `spark.checkpoint.dir`, or a fallback when unset.

    Only a local session (tests) may fall back to the machine's own temporary folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = os.path.join(tempfile.gettempdir(), "palimpsest-checkpoints")
    os.makedirs(made, exist_ok=True)
    return f"file://{made}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` once as Parquet in the shared checkpoint folder and read it back.

    A written table survives lost executors and is never recomputed, which matters for
    plans whose input is read more than once. It goes with `discard`, or when the
    application ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    held = spark.read.schema(df.schema).parquet(path)
    held._written_to = path
    return held


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing will read again; a table `materialize` didn't give is left alone."""
    for held in tables:
        path = getattr(held, "_written_to", None)
        if path:
            spark = held.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
            held._written_to = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table by name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
