"""Session settings the plans rely on, and the shared folder they write to."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Runtime settings only: they can be applied to a session somebody else made.
RUNTIME_CONF = {
    # Source timestamps carry no zone; one fixed zone keeps every cast neutral.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: skewed joins are split, rebalanced writes are cut to
    # even files, small shuffle partitions are merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM does not compile methods above 8000 bytes of bytecode at all, and
    # optimises long loops badly well before that: a wide projection fused into
    # one method ran four times slower than the same operators one by one. Past
    # this limit Spark takes the second way, with each operator compiled.
    "spark.sql.codegen.hugeMethodLimit": "4000",
}


# Applied only where the session does not say otherwise.
DEFAULT_CONF = {
    # Shuffled data per task. Rows take three to four times as much where a task sorts
    # them, as before a write by partition: 256 MB made sorts of 900 MB, which spill
    # on an executor of 10 GB with 4 cores.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    # Bytes of files per task. A scan that deals its rows to more than 200 partitions sorts
    # them in memory, where a row takes some ten times what it takes in a file: with splits
    # that grow to the usual 128 MB, that was 13 MB of memory for every MB of a split.
    "spark.sql.files.maxPartitionBytes": "32MB",
}

# Files that a task may have open at a time where it writes rows as it reads them;
# what belongs to further ones is sorted first.
OPEN_WRITERS = 100


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in DEFAULT_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


# Writes under way in `open_writers`, and the session's own setting until the last ends.
_writing = threading.Lock()
_writes: list[str | None] = []


@contextlib.contextmanager
def open_writers(spark: SparkSession) -> Iterator[None]:
    """Writes by partition keep a file open per partition, and do not sort their rows.

    Writes of other threads may see the setting too; they come to the same rows."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    with _writing:
        _writes.append(_writes[0] if _writes else spark.conf.get(key, None))
        spark.conf.set(key, OPEN_WRITERS)
    try:
        yield
    finally:
        with _writing:
            before = _writes.pop()
            if not _writes and before is None:
                spark.conf.unset(key)
            elif not _writes:
                spark.conf.set(key, before)


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tierwise")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    A temporary folder stands in for it only where the whole of Spark runs on
    this one machine; it is then remembered in the session.
    """
    key = "spark.checkpoint.dir"
    root = spark.conf.get(key, None)
    if root:
        return root.rstrip("/")
    own = "tierwise.shared.dir"
    root = spark.conf.get(own, None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{key} must name a folder that all executors share")
    root = tempfile.mkdtemp(prefix="tierwise-")
    spark.conf.set(own, root)
    return root


_made: list[tuple[SparkSession, str]] = []


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    path = f"{shared_root(spark)}/tierwise/{label}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def remove_scratch() -> None:
    """Delete what `fresh_dir` has named, once nothing reads it any more: by the
    application before it ends, or by the interpreter when it does."""
    while _made:
        spark, path = _made.pop()
        with contextlib.suppress(Exception):  # the session may be gone by now
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


atexit.register(remove_scratch)
