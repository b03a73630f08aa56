"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Recording the call site of every column costs more than building large expressions.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

PARTITION_BYTES = 1 << 30
# Above this the driver's tables of map outputs cost more than smaller partitions save.
MAX_REDUCERS = 50_000


def build_session(app: str = "addrspark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with adaptive execution on; ``extra`` uses ``__`` for dots in setting names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in DEFAULTS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python steps import it.

    ``build_session`` does so by itself; call it once on a session made otherwise, unless the package is
    installed on every machine or was given to ``spark-submit --py-files``.
    """
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="addrspark-package-")) / "addrspark.zip"
    with zipfile.ZipFile(archive, "w") as zipped:
        for source in sorted(package.rglob("*.py")):
            zipped.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Set the number of shuffle partitions so that each takes about 1 GiB of the input, up to MAX_REDUCERS.

    Adaptive execution merges partitions that turn out small, but never makes more than it was given:
    the default of 200 would put 500 GB of a 100 TB input into each. Sorts and aggregates of a partition
    spill, so it need not fit into memory.
    """
    cores = spark.sparkContext.defaultParallelism
    wanted = max(cores, min(-(-input_bytes // PARTITION_BYTES), MAX_REDUCERS))
    rounded = -(-wanted // cores) * cores
    spark.conf.set("spark.sql.shuffle.partitions", str(rounded))
    return rounded


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    A local session without one gets a temporary folder, kept as its setting. On a cluster that would be
    another folder on every machine, so there the setting must be given.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("addrspark.scratch", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="addrspark-")
    spark.conf.set("addrspark.scratch", folder)
    return folder


def settled(df: DataFrame) -> DataFrame:
    """Compute a frame that is read more than once only once, in the cluster's shared checkpoint folder.

    The folder is the session's ``spark.checkpoint.dir`` (or one set on the context). Without one the
    frame stays lazy and is computed again for every reader.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder and not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return df.checkpoint() if context.getCheckpointDir() else df
