"""Tables written to the folder that driver and executors share, to cut lineage; and rows that carry columns of any name."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.  Where that is unset, a local one is set in local mode only, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder as Parquet and return it as read back.

    The rows then outlive any executor, and each later use reads only the
    columns it needs instead of computing them again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as it takes to be none of df's columns (in any case of letters)."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name += "_"
        out.append(name)
    return out


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed_rows(df: DataFrame) -> DataFrame:
    """df with all its columns inside the one column row, so that helper columns may have any other name."""
    return df.select(F.struct(*[F.col(_quoted(c)) for c in df.columns]).alias("row"))


def unpacked(df: DataFrame, new: dict[str, Column] | None = None) -> list[Column]:
    """The columns of df out of row, those in new by what it gives."""
    return [(new or {}).get(c, F.col(f"row.{_quoted(c)}")).alias(c) for c in df.columns]
