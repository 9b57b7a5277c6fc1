"""Session settings, the shared folder, and shuffle sizing."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
SCAN_BYTES = "spark.sql.files.maxPartitionBytes"
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS_PER_SLOT = 4


@dataclass(frozen=True)
class Sizing:
    """How large tasks are, and how many at most.

    The driver tracks map tasks times shuffle partitions, hence the limits. Beyond them
    both get larger instead of more numerous, and sorts and aggregates spill what does
    not fit into memory. Raise them for a driver with more memory.
    """

    shuffle_bytes: int = 128 << 20
    max_shuffle_partitions: int = 50_000
    max_scan_tasks: int = 100_000



def use_utc(spark: SparkSession) -> SparkSession:
    """Weekday and hour follow the session time zone, so fix it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def bounded_listing(spark: SparkSession) -> SparkSession:
    """Let a task list many folders. By default each folder is a task, up to 10,000 of them, and
    their dispatch takes longer than the listing. A setting that is there already stays."""
    if spark.conf.get(LISTING_TASKS, None) is None:
        slots = spark.sparkContext.defaultParallelism
        spark.conf.set(LISTING_TASKS, LISTING_TASKS_PER_SLOT * slots)
    return spark


_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting a local session gets a temporary folder of its own; on a
    cluster a machine-local folder would be lost with its machine, so that fails.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="reviewtide-")
    return _local_roots[app]


class Workspace:
    """Written intermediates of one run: a database inside the shared folder.

    Writing an intermediate cuts its lineage (a lost executor costs one scan, not
    the stages before it), keeps it columnar, and lets several consumers read it
    without computing it again. ``drop`` removes the tables together with their files.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.name = f"reviewtide_{uuid.uuid4().hex[:16]}"
        self.location = f"{shared_root(spark)}/{self.name}"
        spark.sql(f"CREATE DATABASE {self.name} LOCATION '{self.location}'")

    def table_name(self, name: str) -> str:
        return f"{self.name}.{name}"

    def fresh(self, name: str) -> str:
        return f"{name}_{uuid.uuid4().hex[:8]}"

    def path(self, name: str) -> str:
        """A path for files (not tables) of the run; gone with ``drop``."""
        return f"{self.location}/files/{self.fresh(name)}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as a new Parquet table and return the table."""
        table = self.table_name(self.fresh(name))
        df.write.saveAsTable(table, format="parquet")
        return self.spark.table(table)

    def write_all(self, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Write several independent frames at the same time."""
        tables = concurrently(
            self.spark, *(lambda n=n, df=df: self.write(df, n) for n, df in frames.items())
        )
        return dict(zip(frames, tables))

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.name} CASCADE")


@contextmanager
def workspace(spark: SparkSession) -> Iterator[Workspace]:
    """A workspace whose tables and files do not outlive the block."""
    ws = Workspace(spark)
    try:
        yield ws
    finally:
        ws.drop()


def concurrently(spark: SparkSession, *actions: Callable[[], object]) -> list:
    """Run independent Spark actions side by side and return their results in order.

    The executors that run out of tasks at the end of one job work on the others.
    """
    with ThreadPoolExecutor(len(actions)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
        return [future.result() for future in futures]


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total file size below ``paths``; lists the files without opening any."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.load(list(paths))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def _in_bytes(size: str) -> int:
    """A byte setting such as ``134217728b`` or ``128MB`` as a number."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", size.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def partition_settings(
    total_bytes: int, before: dict[str, str], sizing: Sizing = Sizing()
) -> dict[str, str]:
    """Settings for ``total_bytes`` of input, never below those of ``before``.

    Adaptive execution merges small shuffle partitions but never adds any, so their
    starting number has to fit the data, whether it may merge them or not. The size that
    hot partitions are cut into stays as it is set.
    """
    wanted = min(-(-total_bytes // sizing.shuffle_bytes), sizing.max_shuffle_partitions)
    partitions = str(max(wanted, int(before[SHUFFLE_PARTITIONS])))
    scan = max(_in_bytes(before[SCAN_BYTES]), -(-total_bytes // sizing.max_scan_tasks))
    return {
        SHUFFLE_PARTITIONS: partitions,
        INITIAL_PARTITIONS: partitions,
        SCAN_BYTES: f"{scan}b",
    }


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Apply session settings inside the block; the previous ones return after it."""
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


@contextmanager
def sized_for(
    spark: SparkSession, total_bytes: int, sizing: Sizing = Sizing()
) -> Iterator[None]:
    """Apply :func:`partition_settings` inside the block."""
    effective = {key: spark.conf.get(key) for key in (SHUFFLE_PARTITIONS, SCAN_BYTES)}
    with settings(spark, partition_settings(total_bytes, effective, sizing)):
        yield
