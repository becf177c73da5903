"""What the operators share: reading tables, cutting lineage, and word rules."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Separators of the word rule [^\x20\x09-\x0D]+ are exactly the bytes at which bytes.split() splits.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or where that is unset, and one JVM does all (tests),
    one of our own. A cluster without the setting is an error: its executors would write to disks of their own."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set: a cluster needs a folder that all executors share")
    own = f"file://{tempfile.mkdtemp(prefix='lumiflux-')}"
    spark.sparkContext.setCheckpointDir(own)
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def new_folder(spark: SparkSession, label: str) -> str:
    """A new folder's full URI: a bare path is one of the cluster's default file system, which workers would not know."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/lumiflux/{label}-{uuid.uuid4().hex}")
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return f"file://{full.removeprefix('file:')}" if full.startswith("file:/") and not full.startswith("file://") else full


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cuts the lineage with a table written to the shared folder, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a table that materialise() wrote and that no later plan reads."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def open_folder(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """A folder of new_folder() as a Python worker reads and writes it."""
    import pyarrow.fs

    return pyarrow.fs.FileSystem.from_uri(uri)


def with_text(docs: DataFrame) -> DataFrame:
    """doc_id and text only, a null text read as empty; other columns, whatever their names, play no part."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Arrow batches in views of fewer rows, so that what a Python worker makes of texts stays small."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


HOT = 1000


def join_hot(rows: DataFrame, keyed: DataFrame, key: str) -> DataFrame:
    """rows joined with keyed, which has one row a key, without a task for a key of many rows: keys of more than 1 / HOT
    of all rows, of which there are fewer than HOT, come by broadcast and the others by an ordinary join. rows is read
    three times, so it is a table or little."""
    many = rows.groupBy(key).agg(F.count("*").alias("__n"))
    # One row goes to the driver.
    total = rows.count()
    hot = keyed.join(F.broadcast(many.where(F.col("__n") > max(1, total // HOT)).select(key)), key)
    few = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(keyed, key)
    return rows.join(F.broadcast(hot), key).unionByName(few)
