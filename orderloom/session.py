"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Runtime SQL settings every operator relies on.  Timestamps are UTC, skewed
# joins are split by AQE, and repeated JSON keys resolve to the last one.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


#: Largest piece of a file that one task reads.  Packed columns grow some tenfold in memory, and a sort in the task that
#: reads them (keys are limited below the shuffle) must not spill because its piece is large.
READ_PIECE = 32 << 20
_PIECE = "spark.sql.files.maxPartitionBytes"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL defaults to a session somebody else built; smaller pieces than ours stay."""
    for key, value in SQL_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if _bytes(spark.conf.get(_PIECE)) > READ_PIECE:
        spark.conf.set(_PIECE, str(READ_PIECE))
    return spark


def _bytes(setting: str) -> int:
    """A size as Spark writes it: ``134217728b``, ``128MB``, ``32m``."""
    number = setting.strip().lower().removesuffix("b")
    power = "bkmgtp".find(number[-1]) if number[-1].isalpha() else 0
    return int(number.rstrip("kmgtp")) << 10 * power


def build_session(
    app_name: str = "orderloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build a session; cluster sizing stays with the submitter unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory under the cluster's ``spark.checkpoint.dir``.

    Only a local-mode session without that setting falls back to a temporary
    folder; on a cluster a missing setting is an error, because a folder local
    to one machine is invisible to the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="orderloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    for scope in _scopes.get():
        scope.append(path)
    return path


#: Folders handed out inside each ``stage_scope`` that is open in this thread.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("stage_scopes", default=())


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the shared folders that are handed out inside the block when it ends.

    Frames that read them are of no use afterwards: write what is to stay to a folder
    of its own, taken before the block.  Only folders of this block are touched.
    """
    scope: list[str] = []
    token = _scopes.set((*_scopes.get(), scope))
    try:
        yield
    finally:
        _scopes.reset(token)
        for folder in scope:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Runtime SQL settings that hold inside the block, and for streaming queries that start in it."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


#: Shuffle files go when the execution that made them ends, and not when the driver happens to collect its garbage.  Only for
#: what is run once, such as a write: a frame that is fetched again would miss its files.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def materialise(df, purpose: str, path: str | None = None, codec: str | None = None):
    """Write ``df`` once to the shared folder (or to ``path``) and return a frame that reads it.

    Used where several later jobs need the same expensive result: the lineage
    is cut by durable files, so a lost executor never replays the upstream.  The write's shuffles are removed with it.
    """
    path = path or shared_dir(df.sparkSession, purpose)
    with settings(df.sparkSession, DROP_SHUFFLES):
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
