"""Session construction and lineage cutting."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Window and flow stages are CPU-bound per byte: do not let AQE merge a
    # small shuffle into one or two tasks (no effect once partitions are big).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "wattgrid",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Session with the settings the operators rely on (UTC, AQE, Arrow)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(_CORE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on for a session made elsewhere, and
    make the package importable on executors (the schedule flow runs library
    code inside Python workers)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # The JVM does not compile methods over 8,000 bytes: a stage with many
    # columns (rolling features, rounding) runs faster in smaller pieces.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    ship_package(spark)
    return spark


_SHIPPED: set = set()
_ZIP: list = []


def ship_package(spark: SparkSession) -> None:
    """``addPyFile`` a zip of this package once per SparkContext - what
    ``spark-submit --py-files`` does - so Python workers import it wherever
    they run.  The zip is built once per driver process and Spark ships it
    to every executor; no data goes there."""
    import shutil
    import tempfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    if not _ZIP:
        pkg = os.path.dirname(os.path.abspath(__file__))
        out = tempfile.mkdtemp(prefix="wattgrid-pyfiles-")
        _ZIP.append(shutil.make_archive(os.path.join(out, "wattgrid"), "zip",
                                        root_dir=os.path.dirname(pkg), base_dir=os.path.basename(pkg)))
    sc.addPyFile(_ZIP[0])
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only set one where unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    target = configured or fallback
    if not target:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared folder "
            "(or pass a fallback in tests)")
    if not configured:
        os.makedirs(target, exist_ok=True)
    sc.setCheckpointDir(target)
    return target


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write a Parquet table into the shared checkpoint folder
    and read it back.

    One job (an eager ``Dataset.checkpoint`` computes the plan twice: once to
    count, once to write), columnar and compressed, with real file sizes for
    later join planning; lost executors cannot lose it."""
    base = ensure_checkpoint_dir(df.sparkSession)
    path = f"{base.rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    _TABLES.append(path)
    return df.sparkSession.read.parquet(path)


_TABLES: list[str] = []


@contextmanager
def scratch_tables(spark: SparkSession):
    """Tables that ``materialize`` writes inside the block are deleted at its
    end; results that read them must have been written or collected by then."""
    had = len(_TABLES)
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _TABLES[had:]:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
        del _TABLES[had:]
