"""Session defaults and the shared working folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(app: str = "skeinworks", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession, package: str = "skeinworks") -> None:
    """Send a package of this repository to the executors, once in a session, for their Python workers."""
    context = spark.sparkContext
    sent = context.__dict__.setdefault("_skeinworks_sent", set())
    if package not in sent:
        sent.add(package)
        root = Path(__file__).resolve().parents[1]
        name = f"{tempfile.mkdtemp(prefix='skeinworks-code-')}/{package}"
        context.addPyFile(shutil.make_archive(name, "zip", root, package))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can see, as the cluster names it in spark.checkpoint.dir.

    Only a local master may fall back to a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="skeinworks-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path of its own below the shared folder, for one run of one job."""
    return f"{shared_folder(spark)}/skeinworks/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df):
    """Materialise `df` in the shared folder, so lost executors cost a re-read and not a re-run."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()
