"""Spark sessions, and the package on their executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes, by Spark's statistics, up to which a table is dealt to all cores.
SMALL = 64 << 20
_shipped: set[str] = set()


def session(master: str = "local[8]", partitions: int = 16, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC, and shuffle partitions to suit the machine; conf has further settings, with _ for a dot."""
    builder = SparkSession.builder.master(master).appName("lexloom")
    own = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in (own | {k.replace("_", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="lexloom-")) / "lexloom.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(f.relative_to(root.parent)))
    spark.sparkContext.addPyFile(str(archive))


def spread(table: DataFrame) -> DataFrame:
    """A table of at most SMALL bytes over all cores, if its scan has fewer parts than there are: a small file is one row group and so one
    task. Scans of larger tables stay as they are. Rows are sorted within the parts, so that a part that is made again has the same order."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    plan = table._jdf.queryExecution()
    if int(str(plan.optimizedPlan().stats().sizeInBytes())) > SMALL or plan.toRdd().getNumPartitions() >= cores:
        return table
    return table.repartition(cores).sortWithinPartitions(*(f"`{c}`" for c, kind in table.dtypes if "map<" not in kind))
