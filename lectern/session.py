"""Session settings and lineage cutting."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job of this package relies on. They only steer the
# adaptive planner and the end of an execution, so they may be applied to a session somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # an execution's shuffle files go when it ends, not when the driver next collects garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "lectern", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A session without one gets
    a temporary folder only when it runs in one process (``local[...]``); that folder goes when the driver ends.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.match(r"local($|\[)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="lectern-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return context.getCheckpointDir() or folder


def cut_lineage(df: DataFrame, *folders: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, in a folder for each value of the columns ``folders``.

    It survives the loss of any executor, is computed once (a checkpoint counts its rows first and computes them again for
    the files), and later steps read single columns and know its size. ``sweep`` removes the tables.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/lectern-stage-{uuid.uuid4().hex}"
    df.write.partitionBy(*folders).parquet(path)
    spark.sparkContext.__dict__.setdefault("_lectern_stages", []).append(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._lectern_path = path
    return stored


def cut_parts(parts: Iterable[DataFrame]) -> DataFrame:
    """One table of ``cut_lineage`` from parts that are made and written one after the other."""
    stored = None
    for part in parts:
        if stored is None:
            stored = cut_lineage(part)
        else:
            part.write.mode("append").parquet(stored._lectern_path)
    whole = stored.sparkSession.read.schema(stored.schema).parquet(stored._lectern_path)
    whole._lectern_path = stored._lectern_path
    return whole


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(*tables: DataFrame | None) -> None:
    """Removes tables of ``cut_lineage`` that nothing reads any more; None is passed over."""
    for table in tables:
        if table is not None:
            spark = table.sparkSession
            spark.sparkContext._lectern_stages.remove(table._lectern_path)
            _delete(spark, table._lectern_path)


def sweep(spark: SparkSession) -> None:
    """Removes the tables that ``cut_lineage`` has written; call it when their results have been read."""
    for path in spark.sparkContext.__dict__.pop("_lectern_stages", []):
        _delete(spark, path)


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors, as ``--py-files`` would."""
    context = spark.sparkContext
    if getattr(context, "_lectern_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="lectern-")) / "lectern.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(root.rglob("*.py")):
            bundle.write(source, Path("lectern") / source.relative_to(root))
    context.addPyFile(str(archive))
    context._lectern_shipped = True
