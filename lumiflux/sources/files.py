"""Whole files by a path that pyarrow's file systems know (local, HDFS, S3, ...), and a folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession


def located(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def listed(path: str, endings: tuple[str, ...]) -> list[str]:
    """A file, or the files of a folder with one of the endings, in the order of their names; hidden ones are left out."""
    fs, name = located(path)
    info = fs.get_file_info(name)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == pafs.FileType.File:
        return [path]
    names = sorted(f.base_name for f in fs.get_file_info(pafs.FileSelector(name)) if f.base_name.lower().endswith(endings) and f.base_name[0] not in "._")
    if not names:
        raise FileNotFoundError(f"{path} holds no file that ends with {' or '.join(endings)}")
    return [f"{path.rstrip('/')}/{n}" for n in names]


def read_bytes(path: str) -> bytes:
    fs, name = located(path)
    with fs.open_input_file(name) as f:
        return f.read()


def write_bytes(path: str, data: bytes) -> None:
    fs, name = located(path)
    with fs.open_output_stream(name) as f:
        f.write(data)


def scratch(spark: SparkSession, label: str) -> str:
    """The URI of a new folder below spark.checkpoint.dir, or, where that is unset and one JVM does all, below one of our
    own. A cluster without the setting is an error: its executors would write to disks of their own."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster needs a folder that all executors share")
        given = f"file://{tempfile.mkdtemp(prefix='lumiflux-')}"
        spark.sparkContext.setCheckpointDir(given)
        spark.conf.set("spark.checkpoint.dir", given)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{given.rstrip('/')}/lumiflux/{label}-{uuid.uuid4().hex}")
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return f"file://{full.removeprefix('file:')}" if full.startswith("file:/") and not full.startswith("file://") else full


def stored(df: DataFrame, label: str, *by: str) -> DataFrame:
    """The table written to the shared folder, in folders by columns, and read back: a lost executor costs none of it twice."""
    path = scratch(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
