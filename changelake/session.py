"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # HotSpot compiles no larger methods; wide projections then run in several.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


#: Folders of local sessions without a shared one, by application.
_OWN: dict[str, str] = {}


def build_session(app: str = "changelake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; `conf` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def small_methods(spark: SparkSession) -> None:
    """Have wide projections run in methods that HotSpot compiles, also in sessions of others."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit)) > int(DEFAULTS[limit]):
        spark.conf.set(limit, DEFAULTS[limit])


def _root(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or _OWN.get(spark.sparkContext.applicationId)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one that `spark.checkpoint.dir` names.

    A local session without that setting gets a folder of its own; a cluster
    session without it is an error, since executors share no local disk.
    """
    root = _root(spark)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        # Spark lets no running session set it.
        root = _OWN[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="changelake-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, older_than: float, root: str | None = None) -> list[str]:
    """Delete intermediate folders in which nothing was written for `older_than` seconds; their names.

    Only folders named as `scratch_dir` names them, directly below `root` (by default the one
    `scratch_dir` uses), are touched. Results read from them are lost, so the age has to exceed
    the longest job that shares the folder. A folder whose age the file system doesn't tell stays.
    """
    root = root or _root(spark)
    if not root:
        return []
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    before, gone = (time.time() - older_than) * 1000, []
    for folder in files.listStatus(path) if files.exists(path) else []:
        name = folder.getPath().getName()
        if not folder.isDirectory() or not re.fullmatch(".+-[0-9a-f]{32}", name):
            continue
        last, held = folder.getModificationTime(), files.listFiles(folder.getPath(), True)
        while last < before and held.hasNext():
            last = max(last, held.next().getModificationTime())
        if 0 < last < before and files.delete(folder.getPath(), True):
            gone.append(name)
    return sorted(gone)
