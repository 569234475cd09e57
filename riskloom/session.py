"""SparkSession helpers.

The library never creates machine-local scratch space on a cluster: lineage is cut
with ``DataFrame.checkpoint()`` into the shared folder named by
``spark.checkpoint.dir``. Only when that setting is absent (tests, local runs) do we
pick a folder ourselves.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "riskloom") -> SparkSession:
    """Local session for tests / bench; on a cluster use the provided session."""
    master = master or os.environ.get("RISKLOOM_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("RISKLOOM_DRIVER_MEM", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared scratch folder: ``spark.checkpoint.dir`` where the session sets it.

    Only a session whose driver and tasks run in one local process may fall back to a
    temporary folder; anywhere else a missing setting is an error, because executors
    cannot see each other's disks.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="riskloom-ckpt-")
    sc.setCheckpointDir(conf)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared scratch folder."""
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def mounted(uri: str) -> str | None:
    """The path of a URI on a mounted file system, else None."""
    u = urlparse(uri)
    return unquote(u.path) if u.scheme in ("", "file") else None


def open_output(uri: str):
    """A binary file to write on the shared storage; what is not mounted goes through
    Arrow's file systems."""
    path = mounted(uri)
    if path:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    fs, path = pa.fs.FileSystem.from_uri(uri)
    return fs.open_output_stream(path)


def read_shared(uri: str) -> pa.Buffer:
    """A file of the shared storage: memory-mapped where it is mounted."""
    path = mounted(uri)
    if path:
        with pa.memory_map(path) as f:
            return f.read_buffer()
    fs, path = pa.fs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as f:
        return f.read_buffer()


def open_shared(uri: str):
    """A file of the shared storage, to read parts of: memory-mapped where it is mounted."""
    path = mounted(uri)
    if path:
        return pa.memory_map(path)
    fs, path = pa.fs.FileSystem.from_uri(uri)
    return fs.open_input_file(path)


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package's modules, once per Spark application, so that
    tasks import them (and keep what they remember) wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_riskloom_shipped", False):
        return spark
    root = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    uri = scratch_path(spark, "riskloom") + ".zip"
    path = sc._jvm.org.apache.hadoop.fs.Path(uri)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(uri)
    sc._riskloom_shipped = True
    return spark


_built: dict = {}


def built_once(key, build):
    """``build()`` of unresolved columns, kept for the running Spark application: wide
    projections are applied to many frames, and their expressions take driver time."""
    app = SparkSession.active().sparkContext.applicationId
    if (app, key) not in _built:
        _built[app, key] = build()
    return _built[app, key]


def stored(df, label: str, partition_by=()):
    """Write ``df`` once as Parquet under the shared scratch folder and read it back.

    Cuts the lineage like a checkpoint, but later scans prune columns and push filters.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables):
    """Delete the files of tables that ``stored`` returned, once all that reads them is
    stored itself; what ``stored`` did not write stays."""
    for df in tables:
        if where := getattr(df, "_stored_at", None):
            sc = df.sparkSession.sparkContext
            path = sc._jvm.org.apache.hadoop.fs.Path(where)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df):
    """Materialise ``df`` on the shared storage (survives executor loss); what reads it
    prunes columns and pushes filters into the files."""
    return stored(df, "table")
