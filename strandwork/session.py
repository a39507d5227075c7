"""Session helpers: building a session and cutting lineage in shared storage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("strandwork")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, named by ``spark.checkpoint.dir``.

    Where the setting is absent a local master gets a temporary folder; on a
    cluster its absence is an error, as a machine's own folder would be lost
    with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    named = tempfile.mkdtemp(prefix="strandwork-")
    atexit.register(shutil.rmtree, named, True)
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def _application_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder, which its driver deletes when it ends."""
    folder = f"{shared_dir(spark)}/strandwork-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _folders.add(folder)
    return folder


_folders: set[str] = set()


def materialise(df: DataFrame, name: str = "t", count: Column | None = None, by: str | None = None) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back.

    Unlike ``checkpoint`` the plan runs once, the files are columnar and
    compressed, and their size is known to the planner, which then broadcasts
    the table only if that size permits. Any executor can be lost afterwards.
    Tables that ``discard`` has not deleted go when the application ends.
    count: a condition; the rows that meet it are counted as they are written,
    without a job of their own, and are found in ``n_counted``.
    by: a column, the last one, by whose values the rows lie in folders.
    """
    spark = df.sparkSession
    path = f"{_application_dir(spark)}/{name}-{uuid.uuid4().hex}"
    seen = Observation()
    (df if count is None else df.observe(seen, F.count_if(count).alias("n"))).write.parquet(path, partitionBy=by)
    out = spark.read.schema(df.schema).parquet(path)
    out._table_path = path
    if count is not None:
        out.n_counted = seen.get["n"]
    return out


def location(df: DataFrame) -> str:
    """Address of a materialised table, with its scheme, for readers other than Spark."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._table_path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def discard(df: DataFrame) -> None:
    """Deletes the files of a materialised table that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._table_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Makes this package importable in the Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        held = Path(tempfile.mkdtemp(prefix="strandwork-")) / "strandwork.zip"
        with zipfile.ZipFile(held, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(str(held))
        atexit.register(shutil.rmtree, held.parent, True)
        _shipped.add(sc.applicationId)
    return spark
