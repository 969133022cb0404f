"""Session settings and the shared folder for work that must outlive executors."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from strataflow.sources.folders import remove

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot shuffle partition even where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Call-site capture costs several round trips per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

SETTLED = "settled"

_test_folders: dict[str, str] = {}


def build_session(
    app_name: str = "strataflow",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A temporary folder stands in only where the setting is missing and the
    master is local; on a cluster a machine-local folder would lose data.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _test_folders:
        _test_folders[app] = tempfile.mkdtemp(prefix="strataflow-")
    return _test_folders[app]


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has been written to yet."""
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


#: Folders settled in each open ``freeing`` block of a thread.
_open: ContextVar[list[list[str]] | None] = ContextVar("settled", default=None)


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, as a table in the shared folder, and go on from there.

    Lost executors cost nothing, columns can be pruned on the next read, and the
    planner knows the size. A checkpoint would run the last stage twice. Whoever
    writes the final result does so in a ``freeing`` block, or can ``discard`` the table then.
    """
    path = fresh_folder(df.sparkSession, SETTLED)
    if blocks := _open.get():
        blocks[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*settled: DataFrame) -> None:
    """Delete settled tables that nothing will read again."""
    for df in settled:
        folders = {file.rsplit("/", 1)[0] for file in df.inputFiles()}
        remove(df.sparkSession, [folder for folder in folders if f"/{SETTLED}-" in folder])


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was settled in the block, also where it fails: for blocks that write their result."""
    blocks = _open.get()
    if blocks is None:
        _open.set(blocks := [])
    blocks.append([])
    try:
        yield
    finally:
        remove(spark, blocks.pop())
