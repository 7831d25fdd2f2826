"""Session helpers: a local session for tests/bench and checkpoint-dir handling.

Library code never creates its own session; it takes the caller's.  The one
piece of session state the library needs is a *shared* checkpoint folder for
lineage cuts.  On a cluster that folder comes from ``spark.checkpoint.dir``
(set by the operator of the cluster); only when it is unset -- local tests --
do we point it at a scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Conf keys tuned for the workload: many small dimension joins plus one grid
# join whose cells can be skewed.  AQE re-plans joins on real sizes
# (broadcast only when the *measured* side is under the threshold) and splits
# skewed shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "blockxwalk",
                  driver_memory: str = "8g") -> SparkSession:
    """A local-mode session for tests and the benchmark."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the session names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set a scratch one only if unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value is
    always respected.  The scratch fallback is for local runs (tests, bench).
    """
    d = checkpoint_dir(spark)
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return d
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset on a cluster session; "
                           "set it to a shared (e.g. HDFS/S3) folder")
    d = tempfile.mkdtemp(prefix="bxw-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(d)
    return d


# Paths written by this process, by application: ``drop_tables`` removes them.
_WRITTEN: dict[str, list[str]] = {}


def write_table(df: DataFrame, name: str) -> str:
    """Write ``df`` as parquet under the shared checkpoint folder; return the path."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written_tables(spark: SparkSession) -> list[str]:
    """The paths of the tables that this session has written and not dropped, in order."""
    return list(_WRITTEN.get(spark.sparkContext.applicationId, []))


def drop_tables(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete tables that this session has written (all, unless some are named), once no DataFrame built on them is used any more."""
    own = _WRITTEN.get(spark.sparkContext.applicationId, [])
    gone = [p for p in own if paths is None or p in set(paths)]
    own[:] = [p for p in own if p not in set(gone)]
    for path in gone:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(gone)


def read_paths(df: DataFrame) -> set[str]:
    """The paths that a DataFrame reads files from."""
    leaves, found = df._jdf.queryExecution().analyzed().collectLeaves(), set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            roots = leaf.relation().location().rootPaths()
            found |= {roots.apply(k).toString() for k in range(roots.size())}
    return found


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and read it back.

    This cuts lineage like ``checkpoint()`` but in one job (an eager RDD
    checkpoint computes the plan twice), keeps column pruning on re-read, and
    the files survive the loss of any executor.
    """
    return df.sparkSession.read.parquet(write_table(df, name))
