"""Writing results. Paths are shared storage: every executor writes its own part files."""

from __future__ import annotations

import tempfile
import uuid
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Tables that are written at a time: small ones leave most cores without work.
WRITERS = 4


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which all executors must see. Where it is unset, a single local
    process gets a folder of its own; a cluster must set it."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured and (context.master == "local" or context.master.startswith("local[")):
        configured = tempfile.mkdtemp(prefix="broadsheet-")
        context.setCheckpointDir(configured)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return configured.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/broadsheet-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str = "table", path: str | None = None) -> DataFrame:
    """Write a table to shared storage and go on from the files: the plan restarts there and survives lost executors."""
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a table that ``stored`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return path


def write_predictions(scored: DataFrame, path: str, prediction: str = "prediction") -> str:
    return write_csv(scored.select(
        F.col("id").cast("bigint").alias("Id"), F.col(prediction).cast("int").alias("Predicted")
    ), path)


def write_metrics(tables: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One CSV table per name under ``folder``."""
    with ThreadPool(WRITERS) as pool:  # independent jobs
        paths = pool.map(lambda name: write_csv(tables[name], f"{folder}/{name}"), list(tables), chunksize=1)
    return dict(zip(tables, paths))


def write_summary(spark: SparkSession, values: dict, path: str) -> str:
    """One JSON row with the parameters and figures of a run."""
    import json

    row = {k: v if isinstance(v, (str, int, float)) or v is None else json.dumps(v) for k, v in values.items()}
    kinds = {str: "string", int: "bigint", float: "double", bool: "boolean", type(None): "string"}
    schema = ", ".join(f"`{k}` {kinds[type(v)]}" for k, v in row.items())
    spark.createDataFrame([tuple(row.values())], schema).coalesce(1).write.mode("overwrite").json(path)
    return path
