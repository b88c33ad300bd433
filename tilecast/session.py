"""Session and scratch-table helpers."""

from __future__ import annotations

import atexit
import hashlib
import io
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_FOLDERS: set[str] = set()
_RECORDS: list[list[str]] = []
_SHIPPED: dict[str, str] = {}


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tilecast")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Without that setting a local session gets a fresh temporary folder, kept on the context so that
    Spark ML's own checkpoints use it too, and removed when Python ends. On a cluster every machine
    would write to a disk of its own, so a session that is not local has to name a shared folder.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if named:
        if current is None:
            sc.setCheckpointDir(named)
        return named
    if current is None:
        if not _is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="tilecast-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
        current = sc.getCheckpointDir()
    return current


def _is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


@contextmanager
def recorded() -> Iterator[list[str]]:
    """Collects the paths of the tables that ``materialize`` writes inside."""
    _RECORDS.append([])
    try:
        yield _RECORDS[-1]
    finally:
        paths = _RECORDS.pop()
        if _RECORDS:
            _RECORDS[-1].extend(paths)


def delete_tables(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables written by ``materialize``, wherever the shared folder is."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(conf).delete(path, True)


def _own_folder(spark: SparkSession) -> str:
    """The application's part of the scratch folder, which goes when this Python process ends."""
    folder = f"{scratch_dir(spark).rstrip('/')}/tilecast-{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        _FOLDERS.add(folder)
        atexit.register(_remove_folder, spark._jvm, spark._jsc.hadoopConfiguration(), folder)
    return folder


def _remove_folder(jvm, conf, folder: str) -> None:
    try:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    except (Py4JError, OSError):  # the JVM is gone: its tables stay
        pass


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Iterative fits read their input many times. A written table cuts the lineage, survives lost
    executors, is read by column, and gives Catalyst true sizes to pick join strategies from. It is
    there until ``delete_tables`` or the end of the process.
    """
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    for paths in _RECORDS[-1:]:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def send_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as a user of Spark does by --py-files."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.writestr(zipfile.ZipInfo(str(p.relative_to(root.parent))), p.read_bytes())
    folder = tempfile.mkdtemp(prefix="py-files-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = Path(folder) / f"tilecast_{hashlib.sha1(held.getvalue()).hexdigest()[:12]}.zip"
    path.write_bytes(held.getvalue())
    sc.addPyFile(str(path))
    _SHIPPED[sc.applicationId] = str(path)
