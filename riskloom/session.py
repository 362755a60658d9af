"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "riskloom") -> SparkSession:
    """Session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RISKLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def compile_small_methods(spark: SparkSession) -> None:
    """Let stages whose generated code the JVM would refuse to compile run operator by operator.

    Methods above 8,000 bytes of code are interpreted for good, which costs more than fusing operators saves.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Only a session that names none (local tests) gets a temporary folder, and keeps it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="riskloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _made(spark).append(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a working folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _made(spark: SparkSession) -> list[str]:
    context = spark.sparkContext
    if not hasattr(context, "_riskloom_made"):
        context._riskloom_made = []
    return context._riskloom_made


def release(spark: SparkSession) -> int:
    """Delete what :func:`work_dir` handed out, checkpoints included, and return how many folders went.

    For the owner of a session, once nothing that was read from them is needed any more.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    gone = 0
    for path in _made(spark):
        folder = jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(folder.getFileSystem(conf).delete(folder, True))
    _made(spark).clear()
    return gone


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` at the shared folder unless the cluster did so already."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_dir(spark, "checkpoints"))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, so that Python tasks import it wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_riskloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="riskloom-")), "riskloom.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._riskloom_shipped = True


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
