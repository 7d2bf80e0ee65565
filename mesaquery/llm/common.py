"""Tables, scratch space in the shared folder, and joins with a checked size."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of at most this many fixed-width fields are broadcast; anything larger is shuffled.
BROADCAST_ROWS = 500_000
#: Rows and bytes of one Arrow batch, so that a batch of very long texts stays small.
BATCH_ROWS, BATCH_BYTES = 1024, 8 << 20

_own: dict[str, str] = {}
_shipped: set[str] = set()
_caches: dict[str, Callable[[], None]] = {}
_owner: list[str] = []
_paths: list[str] = []  # of tables in the shared folder that are still there


def claim(owner: str, clear: Callable[[], None] | None = None) -> None:
    """Say, in a worker, that ``owner``'s caches are in use now; those of all others are cleared.

    A worker outlives its tasks, so that stages of several operators would else add up their caches.
    """
    if clear is not None:
        _caches[owner] = clear
    if _owner != [owner]:
        for other, release in _caches.items():
            if other != owner:
                release()
        _owner[:] = [owner]
        give_back()


def give_back() -> None:
    """Return a worker's freed memory to the system; allocators would keep it for as long as it lives."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def ship(spark: SparkSession) -> None:
    """Give executors this package once for each application, wherever the driver found it."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="mesaquery-")) / "mesaquery.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent).as_posix())
        spark.sparkContext.addPyFile(str(target))
        _shipped.add(app)


def prepare(spark: SparkSession) -> None:
    """Set the session up for Python stages: the package on all executors, and small batches."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a prepared session."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path below the folder that driver and executors share.

    The folder is ``spark.checkpoint.dir``. Where that is unset, a temporary folder is used on a
    local master only, since no executor of a cluster could see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            folder = tempfile.mkdtemp(prefix="mesaquery-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            _own[app] = "file://" + folder
        shared = _own[app]
    _paths.append(f"{shared.rstrip('/')}/{tag}-{uuid.uuid4().hex}")
    return _paths[-1]


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    if path in _paths:
        _paths.remove(path)


def drop(*tables: DataFrame) -> None:
    """Delete ``saved`` tables that no later step reads."""
    for df in tables:
        if path := getattr(df, "_scratch_path", None):
            _delete(df.sparkSession, path)


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """At the end, delete what was put into the shared folder meanwhile: its results must be written by then."""
    earlier = set(_paths)
    try:
        yield
    finally:
        for path in [p for p in _paths if p not in earlier]:
            _delete(spark, path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have: ``name``, with underscores added if need be."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_small(left: DataFrame, right: DataFrame, on: list[str], how: str, rows: int | None = None) -> DataFrame:
    """Join that broadcasts ``right`` only if its counted rows are few, and else shuffles.

    ``right`` must be narrow (a few fixed-width columns) and cheap to count, such as a saved table.
    """
    n = right.count() if rows is None else rows
    return left.join(F.broadcast(right) if n <= BROADCAST_ROWS else right, on, how)
