"""Session helpers.

``get_spark`` builds a session with the settings every job in the package
assumes (UTC session time zone, AQE with skew-join splitting, Arrow batches
for the few pandas UDFs).  On a cluster the session is normally created by the
launcher; then only ``ensure_checkpoint_dir`` is needed.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "recspark") -> SparkSession:
    master = master or os.environ.get("RECSPARK_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("RECSPARK_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RECSPARK_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``recspark`` importable in the Python workers (what ``--py-files`` does).

    The pandas UDFs reference functions of this package; executors that do
    not have it installed get a zip of it through ``addPyFile`` once per
    application.  The zip is a driver-side build artifact that Spark serves
    to the executors.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    import recspark
    pkg_dir = os.path.dirname(os.path.abspath(recspark.__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="recspark-pyfiles-"), "recspark.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Without one, a scratch folder is made
    only in local mode (tests), where driver and tasks share one machine; on a
    cluster the missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if current:
        return current
    if not conf_dir and not (sc.master.startswith("local") and "cluster" not in sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    conf_dir = conf_dir or tempfile.mkdtemp(prefix="recspark-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store_rows(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet into the shared checkpoint folder and read back.

    For long, narrow tables: the columns are packed, unlike those of a checkpoint.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/recspark-rows-{uuid.uuid4().hex[:10]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read one of the driver's parquet tables.

    Timestamps in these files load as ``TIMESTAMP_NTZ``; they are cast to the
    session (UTC) ``timestamp`` type right away so watermarks and the time
    helpers accept them.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns is not None:
        df = df.select(*columns)
    casts = {f.name: df[f.name].cast("timestamp") for f in df.schema.fields
             if f.dataType.typeName() == "timestamp_ntz"}
    return df.withColumns(casts) if casts else df
