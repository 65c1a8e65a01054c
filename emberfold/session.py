"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on; all can be set on a running session.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "emberfold", cpus: int | None = None, **conf: str) -> SparkSession:
    """Local session for tests and the benchmark; on a cluster pass the cluster's own session."""
    cores = cpus or 8
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        # The iterative jobs use a few hundred generated classes; keep them for the next run.
        .config("spark.sql.codegen.cache.maxEntries", "4000")
        # No source positions in error messages: they cost a stack walk per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**JOB_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings (UTC above all) to a session made elsewhere."""
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A local master without the setting gets a fresh temporary folder. A cluster without it is
    an error: a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="emberfold-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


# Paths of the scratch tables that this process has asked for and not deleted yet.
_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def scratch_tables() -> list[str]:
    """Scratch paths in use, oldest first."""
    return list(_scratch)


def delete_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that nothing lazy depends on any more; missing ones do not matter."""
    context = spark.sparkContext
    for name in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        if name in _scratch:
            _scratch.remove(name)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    A lost executor then costs no recomputation of earlier steps. Unlike a checkpoint, the table
    brings its true size: in a loop of joins the estimates a checkpoint carries along multiply
    from round to round until planning takes longer than the work.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables of ``cut_lineage``."""
    for df in tables:
        delete_scratch(df.sparkSession, [df.scratch])
