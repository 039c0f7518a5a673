"""Session set-up, the shared work folder and size-checked broadcasting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Driver-built dimensions above this many rows are joined by shuffle instead.
BROADCAST_ROW_LIMIT = 20_000
#: Temporary folders of local applications by their id; the setting itself cannot be changed at run time.
_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app: str = "epispan", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC time; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Larger generated methods are never compiled to machine code by the JVM.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` decides. Only a local master, which has no other
    machine to share with, may fall back to a fresh temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="epispan-")
    return _LOCAL_FOLDERS[application]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts the lineage durably."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dimension(spark: SparkSession, rows: list[tuple], schema: str | StructType) -> DataFrame:
    """A DataFrame from driver-side configuration, broadcast only while it is provably small."""
    frame = spark.createDataFrame(rows, schema)
    return F.broadcast(frame) if len(rows) <= BROADCAST_ROW_LIMIT else frame


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
