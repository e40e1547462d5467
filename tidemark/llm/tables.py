"""What the operators share: reading tables, keys without nulls, checkpoints, shipping this package."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null id inside the operators: such a document comes after all others.
NO_ID = 2**63 - 1
#: Rows in an Arrow batch; whole texts are long.
BATCH_ROWS = 2000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Columns _id and _text without nulls (NO_ID, empty), and those of `more`; no other column can clash."""
    return docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("_id"), F.coalesce(docs[text_col], F.lit("")).alias("_text"), *more)


def unkeyed(name: str = "_id") -> Column:
    """The id as the caller gave it."""
    return F.when(F.col(name) != NO_ID, F.col(name))


def prepare(spark: SparkSession) -> None:
    """Makes Python stages ready: smaller Arrow batches, and this package on every executor (as --py-files would)."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for x in sorted(names):
                if x.endswith(".py"):
                    full = os.path.join(folder, x)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._tidemark_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a folder of our own only where it is unset, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(sc.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="tidemark-checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint, which outlives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
