"""Spark session settings and the shared scratch folder.

The library never creates its own session inside an operator; callers pass
one in. ``get_session`` is for scripts, tests and the benchmark.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. ANSI mode and UTC are the Spark 4 defaults;
# they are pinned so results do not depend on cluster defaults.
BASE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parquet output of the fact may be re-read with new columns (schema drift).
    "spark.sql.parquet.mergeSchema": "false",
    # Checkpoint files of DataFrames that are no longer referenced are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Codec of the files the library stores: key hashes, which snappy leaves as they are,
# take half the bytes.
STORED_CODEC = "zstd"


# Line-sized data is shuffled in slices, and a slice's shuffle files go before the
# next: a slice stands for this many bytes of files, or for more where there
# would be too many, since each reads its input again.
SLICE_BYTES = 128 << 20
MOST_SLICES = 16


def slice_count(held: int) -> int:
    """Slices for files of ``held`` bytes."""
    return min(MOST_SLICES, max(1, -(-held // SLICE_BYTES)))


def in_slices(sizes: dict, count: int) -> list[list]:
    """The keys of ``sizes`` in about ``count`` groups of like size, in their order."""
    groups, held, share = [], 0, -(-sum(sizes.values()) // count)
    for key, n in sizes.items():
        if not groups or count > 1 and held >= share:
            groups, held = [*groups, []], 0
        groups[-1].append(key)
        held += n
    return groups


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ordermart", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster leave ``master`` as None so spark-submit decides. Locally the
    shuffle partition count should match the cores; on a cluster size it so a
    shuffle partition holds roughly 128-256 MB (AQE coalesces small ones).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in conf.items():
        # Static settings cannot change on a running session; runtime ones can.
        if not k.startswith(("spark.ui", "spark.cleaner")):
            try:
                spark.conf.set(k, v)
            except Exception:  # noqa: BLE001 - static conf on an existing session
                pass
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session, or None (remote session)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions have no context
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system path).
    Only when it is unset, as in local tests, a folder under /tmp is created
    and registered, so later calls in the same session reuse it.
    """
    sc = _context(spark)
    if sc is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return root
    current = sc.getCheckpointDir()
    if current:
        return current
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="ordermart-ckpt-", dir="/tmp")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    """(Hadoop FileSystem, Path) for ``path``, or None on a remote session."""
    sc = _context(spark)
    if sc is None:
        return None
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the Hadoop file system that serves it
    (local disk, HDFS or an object store alike)."""
    fs = _file_system(spark, path)
    if fs is not None:
        return bool(fs[0].exists(fs[1]))
    from pyspark.errors import AnalysisException
    try:
        spark.read.parquet(path).schema  # noqa: B018 - resolves the path
        return True
    except AnalysisException:
        return False


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, p = _classic_file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, p = _classic_file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file."""
    fs, p = _classic_file_system(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def modified_at(spark: SparkSession, path: str) -> float:
    """Time of the last change of a file or folder, in seconds."""
    fs, p = _classic_file_system(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000


def _classic_file_system(spark: SparkSession, path: str):
    found = _file_system(spark, path)
    if found is None:
        raise RuntimeError("tables with versions need a session with a Spark context")
    return found


def source_state(spark: SparkSession, paths: list[str]) -> tuple[list, int]:
    """What tells one state of some files from another (files, bytes and time
    of change of each path), and all their bytes."""
    seen = []
    for path in paths:
        fs, p = _classic_file_system(spark, path)
        held = fs.getContentSummary(p)
        seen.append([held.getFileCount(), held.getLength(), fs.getFileStatus(p).getModificationTime()])
    return seen, sum(s[1] for s in seen)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder the library itself wrote. Returns False when the
    session gives no file-system access (a remote session)."""
    fs = _file_system(spark, path)
    if fs is None:
        return False
    fs[0].delete(fs[1], True)
    return True


def rename_path(spark: SparkSession, src: str, dst: str) -> bool:
    """Rename a folder on its Hadoop file system (atomic on HDFS-like
    stores). Returns False when the session gives no file-system access."""
    fs = _file_system(spark, src)
    if fs is None:
        return False
    target = fs[1].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(target.rename(fs[1], spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)))


def drop_unused_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of queries that are done. It does so
    once the driver has collected their plans, which by itself may take until
    long after the disks are full (``spark.cleaner.periodicGC.interval``)."""
    sc = _context(spark)
    if sc is not None:
        sc._jvm.System.gc()


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int) -> dict[str, str]:
    """Suggested settings for a large cluster run, from the input size.

    - shuffle partitions: about 256 MB of shuffle data per partition for the
      widest shuffle (the order lines, roughly the line-item input), and at
      least two waves of tasks over all cores; AQE then coalesces small ones
      and splits skewed ones.
    - file splits of 512 MB keep scan tasks long enough to amortize start-up.
    - the broadcast threshold stays modest: only the fixed-size nation and
      region tables, and run-time small sides chosen by AQE, are broadcast.
    """
    cores = max(1, executors * cores_per_executor)
    partitions = max(2 * cores, input_bytes // (256 << 20))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.parquet.filterPushdown": "true",
    }
