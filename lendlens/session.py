"""SparkSession helpers.

On a cluster the session is created by the platform; these helpers only fill
in settings that are still unset, so cluster configuration always wins.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for the plans in this package. Applied with
# ``setdefault`` semantics: only when the running session has no value.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Broadcast only what is proven small: 32 MiB ceiling for automatic
    # broadcast; explicit hints in this package are guarded by size checks.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}

# Settings this package needs regardless of the session's value. Constraint
# inference over the wide cleaning projections grows combinatorially (driver
# OOM when a plan is cached, checkpointed or cross-validated); no plan here
# relies on inferred constraints.
REQUIRED_CONF = {
    "spark.sql.constraintPropagation.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lendlens", extra_conf: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, no server ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LENDLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**DEFAULT_CONF, **REQUIRED_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set package defaults on an existing session where they are unset."""
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names a shared (distributed) folder there; it is read from the
    session. Only when it is unset (local tests) a scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lendlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_root(spark: SparkSession) -> str:
    """The shared folder beside the session's own checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return base.rsplit("/", 1)[0] if "/" in base else base


def materialize(df, label: str = "table"):
    """Cut lineage by writing ``df`` as Parquet into the shared folder named
    by ``spark.checkpoint.dir`` and reading it back (survives executor loss;
    used where ``Dataset.checkpoint`` is unsuitable, e.g. on union plans)."""
    import uuid
    spark = df.sparkSession
    path = f"{shared_root(spark)}/lendlens-tables/{label}-{uuid.uuid4().hex[:12]}"
    ship_package(spark)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def discard(df) -> None:
    """Delete a table made by ``materialize`` that no later plan reads."""
    path, spark = getattr(df, "_written_path", None), df.sparkSession
    if path:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors (once per context), so
    that Python functions of Arrow-batched operators import there even when
    the package is not installed on the workers."""
    import zipfile
    sc = spark.sparkContext
    if getattr(sc, "_lendlens_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="lendlens-ship-"), "lendlens.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in sorted(os.walk(root)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._lendlens_shipped = True
