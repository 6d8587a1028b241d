"""Session helpers: recommended settings, shared working folder, shuffle sizing."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


# Settings the engine runs well with; none of them changes a result.
SETTINGS = {
    # re-plan joins and partition counts from actual sizes, split skewed join partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the JIT compiler skips methods above 8000 bytes of code; the long CASE chains of the
    # rule checks then run several times slower than without whole-stage code
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # drop the checkpoints of the hot-group path once nothing refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # keep window state off the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """A session builder with :data:`SETTINGS`."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it then gets a folder
    of its own.  On a cluster a machine-local folder would lose data together
    with the executor, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="panelworks-")
    sc.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """Path of a fresh, not yet existing folder below :func:`shared_root`."""
    return f"{shared_root(spark)}/panelworks/{name}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Removes the shuffle files of a query when it ends, instead of at some later garbage collection.
_CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Folders that the operators running now have stored, innermost operator last.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read from there.

    What is computed once stays the same when an executor is lost and tasks run again.  The
    shuffle files of the query go with its end.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(_CLEAN_SHUFFLES, None)
    spark.conf.set(_CLEAN_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_SHUFFLES)
        else:
            spark.conf.set(_CLEAN_SHUFFLES, before)
    if scopes := _scopes.get():
        scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """:func:`stored`, and the rows that were written."""
    seen = Observation()
    kept = stored(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return kept, seen.get["n"]


def tidy(operator: Callable) -> Callable:
    """Decorates an operator that returns a DataFrame, or a tuple of them: folders it stored
    on the way are removed when it returns, except for those that its results read.

    What the results read belongs to the operator around it, if there is one.
    """

    @wraps(operator)
    def run(*args, **kwargs):
        own: list[str] = []
        token = _scopes.set((*_scopes.get(), own))
        try:
            result = operator(*args, **kwargs)
        finally:
            _scopes.reset(token)
        results = result if isinstance(result, tuple) else (result,)
        files = [file for x in results if isinstance(x, DataFrame) for file in x.inputFiles()]
        read = {file.rsplit("/panelworks/", 1)[-1].split("/")[0] for file in files}
        kept = [path for path in own if path.rsplit("/", 1)[-1] in read]
        for path in set(own) - set(kept):
            remove(SparkSession.active(), path)
        if scopes := _scopes.get():
            scopes[-1].extend(kept)
        return result

    return run


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_panelworks_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="panelworks-"), "panelworks_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    sc.addPyFile(archive)
    sc._panelworks_shipped = True


def remove(spark: SparkSession, path: str, only_empty: bool = False) -> None:
    """Delete a folder that this engine wrote, on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not only_empty or (system.exists(folder) and len(system.listStatus(folder)) == 0):
        system.delete(folder, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all, on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    beside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.part")
    out = system.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if system.exists(target) or not system.rename(beside, target):
        raise FileExistsError(path)


def publish(spark: SparkSession, source: str, target: str, replace: bool) -> None:
    """Make the files of the folder ``source`` those of ``target``, or add them to it."""
    origin, goal = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (source, target))
    system = origin.getFileSystem(spark._jsc.hadoopConfiguration())
    if replace:
        system.delete(goal, True)
    if not system.exists(goal):
        system.mkdirs(goal.getParent())
        moved = system.rename(origin, goal)
    else:
        files = [x.getPath() for x in system.listStatus(origin) if not x.getPath().getName().startswith(("_", "."))]
        moved = all(system.rename(x, goal) for x in files)
    if not moved:
        raise OSError(f"{source} could not be moved to {target}")
