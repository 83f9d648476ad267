"""Spark session helpers: settings, the shared scratch folder, cutting lineage."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # vector means are kept per topic in one hash table, not sorted row by row
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on (UTC, AQE, Arrow)."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "topicflow", cpus: str = "*", shuffle: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters pass their own session."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
    if shuffle:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle))
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own; on a cluster a
    missing setting is an error, because a machine-local folder dies with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="topicflow-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


_OPEN: list[list[str]] = []  # what the scopes of ``scratch`` that are open have seen


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for paths in _OPEN:
        paths.append(path)
    return path


@contextmanager
def scratch() -> Iterator[list[str]]:
    """The scratch folders named while the scope is open, for ``remove`` once nothing reads them."""
    paths: list[str] = []
    _OPEN.append(paths)
    try:
        yield paths
    finally:
        _OPEN.remove(paths)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders, whichever store they are in; one that is gone already is no error."""
    context = spark.sparkContext
    for folder in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def folders(df: DataFrame) -> set[str]:
    """The folders of the files that ``df`` reads."""
    return {file.rsplit("/", 1)[0] for file in df.inputFiles()}


def materialize(df: DataFrame, name: str = "table", packed: bool = False) -> DataFrame:
    """Write a reused table once and read it back.

    This cuts the lineage in reliable storage and gives Catalyst a file size, so that the
    choice between a broadcast and a shuffled join rests on the measured size of the table.
    ``packed`` spends more time on smaller files, which pays for texts and words but not for vectors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd") if packed else df.write
    writer.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote, once nothing will read them again."""
    for df in tables:
        remove(df.sparkSession, folders(df))


def opened(uri: str) -> tuple[FileSystem, str]:
    """The store and the path in it of a file that Spark wrote to the shared folder, for a task that reads it (local, HDFS, S3 and what else Arrow opens)."""
    uri = uri.replace("s3a://", "s3://", 1)
    return FileSystem.from_uri(uri) if ":/" in uri else (LocalFileSystem(), uri)


def ship_package(spark: SparkSession) -> str:
    """Send this package to the executors of a session that cannot import it, as a zip file in the shared folder.

    Not needed where the package is installed on all machines (``pip install .``).
    """
    root, packed = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    place = f"{scratch_path(spark, 'package')}.zip"
    system, inner = opened(place)
    with system.open_output_stream(inner) as file:
        file.write(packed.getvalue())
    spark.sparkContext.addPyFile(place)
    return place


def spread(scan: DataFrame) -> DataFrame:
    """Use all cores on a table whose files give fewer partitions than there are cores.

    For a scan without shuffles. A large table has far more partitions and passes unchanged;
    filters and column pruning still reach the files below the repartitioning.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
