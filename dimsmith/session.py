"""Session settings and the shared folder that durable intermediate results go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from dimsmith.sources.paths import drop_folder

CHECKPOINT_KEY = "spark.checkpoint.dir"
SETTLED = "settled"
_settled: dict[str, list[str]] = {}

# Settings every job here is designed around.  All are runtime SQL settings, so a
# cluster may override any of them.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when a later step could have reused the partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "dimsmith", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_for(shuffled_bytes: int, cores: int, per_task: int = 128 * 1024**2) -> dict[str, str]:
    """Settings that keep a shuffle of ``shuffled_bytes`` at about ``per_task`` bytes a task.

    Adaptive execution merges partitions that turn out small, so the number errs on the high
    side; it can split only hot ones, so too few would mean spilling.
    """
    partitions = max(cores, -(-shuffled_bytes // per_task))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(per_task),
        "spark.sql.files.maxPartitionBytes": str(per_task),
    }


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    Only a local-mode session without the setting falls back to a fresh temporary folder.
    """
    path = spark.conf.get(CHECKPOINT_KEY, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="dimsmith-")
        spark.conf.set(CHECKPOINT_KEY, path)
    return path.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else writes to."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once, so later passes read it instead of recomputing it.

    The copy is parquet: a later pass reads only the columns it needs, its size is known to the
    planner, and losing an executor costs a re-read, not a re-run.  See :func:`release`.
    """
    spark = df.sparkSession
    path = fresh_path(spark, SETTLED)
    df.write.parquet(path)
    _settled.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Drop the settled copies this session made. Call it once the results are written."""
    dropped = _settled.pop(spark.sparkContext.applicationId, [])
    for path in dropped:
        drop_folder(spark, path)
    return len(dropped)
