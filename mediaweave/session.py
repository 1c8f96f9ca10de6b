"""Sessions: settings that suit the engine's plans, and shipping the package to executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package, wherever they run. Sends it once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        to = Path(tempfile.mkdtemp(prefix="mediaweave-")) / "mediaweave.zip"
        with zipfile.ZipFile(to, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(to))
        _shipped.add(app)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, which the cluster names in spark.checkpoint.dir. Only a local master, whose
    executors are the driver's own process, may leave it unset: it gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="mediaweave-"))
        base = spark.sparkContext.getCheckpointDir()
    return base


#: Stored bytes under which a table may lie in fewer files than there are cores.
SMALL = 1 << 30


def spread(df: DataFrame, key: str) -> DataFrame:
    """The rows of a small table of few files over all cores, by a key; any other table as it is. A file of one row group is one task's."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores, key) if size < SMALL and len(df.inputFiles()) < cores else df


def build_session(app: str = "mediaweave", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; `settings` use underscores for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    conf |= {k.replace("_", "."): v for k, v in settings.items()}
    return ship(builder.config(map=conf).getOrCreate())
