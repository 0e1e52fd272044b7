"""Session defaults, input tables and the shared folder that jobs may write to."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}  # fallback folder of each local application
# Of intermediate tables and of runs: texts of hex digits take about half the place that Spark's default leaves them.
CODEC = "zstd"
_OPEN = threading.local()  # the intermediate folders of the thread's open ``scratch`` blocks, innermost last


def build_session(app: str = "tarnwork", master: str | None = None, **conf: object) -> SparkSession:
    """A session with adaptive execution, UTC time and Arrow; ``conf`` overrides any default.

    ``master`` and memory are left to spark-submit unless given, so the same code runs on a cluster.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k: str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a machine-local path would lose
    data with its machine, so a missing setting is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="tarnwork-")
    return _LOCAL[app]


def run_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Intermediate folders made inside the block by this thread are removed when it ends without an error, so it must
    write whatever it means to keep. After an error they stay and the run can be looked at. A folder taken off the
    list stays. Blocks may be nested; each removes its own folders."""
    opened = getattr(_OPEN, "blocks", None)
    if opened is None:
        opened = _OPEN.blocks = []
    opened.append([])
    try:
        yield opened[-1]
    except BaseException:
        opened.pop()
        raise
    for path in opened.pop():
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def passing(path: str) -> str:
    """Note a folder as intermediate for the innermost ``scratch`` block; without one it stays."""
    if blocks := getattr(_OPEN, "blocks", None):
        blocks[-1].append(path)
    return path


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """The frame's rows, written once to the shared folder and read back: later steps do not recompute it, and a lost
    executor costs no more than its own tasks. Inside a ``scratch`` block the folder goes when the block ends."""
    path = passing(run_dir(df.sparkSession, label))
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Tables:
    """Attribute access to the parquet tables of one folder: ``Tables(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(os.path.join(self.folder, f"{name}.parquet"))
        self.__dict__[name] = df  # list the files and read the footer once
        return df
