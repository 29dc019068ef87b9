"""Session helpers: local sessions for tests and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", app: str = "tokenloom", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    A session without that setting gets a temporary folder of this machine if it is a local one,
    and an error otherwise: on a cluster every executor would write to its own disk.
    """
    conf = spark.sparkContext.getConf()
    root = spark.conf.get(_CHECKPOINT_CONF, None) or conf.get(_CHECKPOINT_CONF) or getattr(scratch_path, "_local_root", None)
    if not root:
        if not re.match(r"local(\[|$)", conf.get("spark.master", "")):
            raise ValueError(f"set {_CHECKPOINT_CONF} to a folder that the driver and all executors share")
        root = scratch_path._local_root = tempfile.mkdtemp(prefix="tokenloom-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a narrow intermediate table to the shared folder and go on from there: later plans
    neither repeat the work nor depend on executors that may be lost. The table is packed closer than by
    default, as it is written for a few reads only. The shuffle files of the finished write are removed, as
    nothing reads them again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP_CONF)
    spark.conf.set(_CLEANUP_CONF, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP_CONF, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``materialize`` returned, once all that was made of them is written itself. A table
    counts as disk for as long as it stays."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers when it is not installed there (the
    same as submitting it with ``--py-files``). Done once per Spark application."""
    sc = spark.sparkContext
    if ship_package.__dict__.get("app") == sc.applicationId:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tokenloom-ship-")) / "tokenloom.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    sc.addPyFile(str(archive))
    ship_package.app = sc.applicationId
