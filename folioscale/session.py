"""One Spark session with the settings that the operators count on."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def get_session(app: str = "folioscale", master: str | None = None, **conf: str) -> SparkSession:
    """The running session, or a new one with adaptive execution, ANSI arithmetic and UTC."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in ({"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.ansi.enabled": "true"} | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def query(spark: SparkSession, sql: str, params: list | dict | None = None):
    """SQL with bound parameters, never spliced text."""
    return spark.sql(sql, args=params) if params else spark.sql(sql)


def preview(spark: SparkSession, sql: str, rows: int = 20, width: int = 200):
    """The first rows of a statement with long cells cut, for a look at a table."""
    from pyspark.sql import functions as F

    df = spark.sql(sql).limit(rows)
    return df.select(*[F.substring(F.col(f"`{c}`").cast("string"), 1, width).alias(c) for c in df.columns])


def reset(spark: SparkSession) -> None:
    """Forget cached results."""
    spark.catalog.clearCache()


def work_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names; on one machine without that setting, a folder of the warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    return f"{work_dir(spark)}/folioscale-{spark.sparkContext.applicationId}"


def written(df, what: str):
    """Cut the lineage: write to the shared folder and read back, so that a lost executor costs nothing that is done."""
    spark = df.sparkSession
    path = f"{_own_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession) -> None:
    """Delete what this application has written in between, once its results are stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession | None = None) -> None:
    """Put this package on the executors' path, wherever the driver has it from."""
    import shutil
    import tempfile
    from pathlib import Path

    context = (spark or SparkSession.getActiveSession()).sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name))
        _SHIPPED.add(context.applicationId)
