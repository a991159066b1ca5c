"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ASCII_SPACE = r"\x20\x09-\x0D"
#: Upper-case A-Z to lower case, every other byte as it is.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Bytes of rows that a Python function in a task gets at a time; a longer row is a batch of its own.
BATCH = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or the one that ``setCheckpointDir`` was given.

    No folder is made up here: one of the driver's own disk would be missing on the executors.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def small_batches(spark: SparkSession) -> None:
    """Let the session pass rows to Python functions in batches of ``BATCH`` bytes.

    By default a batch has 10,000 rows up to 64 MB. Rows with texts or sets fill that, and a task holds a batch several times over: on
    Spark's side, as Arrow and as Python objects. Processes keep such memory for the stages after.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` through the shared folder, and let go of the shuffles that only served to build it.

    Spark removes a shuffle's files when the driver has collected the plan they belong to, by default once in half an hour. Here
    the plan is done with as soon as its table is written, so the collection is asked for.
    """
    spark = df.sparkSession
    shared_folder(spark)
    cut = df.checkpoint(eager=True)
    del df
    spark._jvm.System.gc()
    return cut


class Scratch:
    """Written tables of one job, in a folder of its own under the shared folder; each is deleted once nothing reads it."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"

    def keep(self, name: str, df: DataFrame, packed: bool = False) -> DataFrame:
        """The rows of ``df``, read back from the table ``name``; shuffles that only served to build them are let go.

        ``packed`` rows have values of megabytes. Parquet would put a hundred of them into a page and compress it at once, in buffers
        outside the heap that stay; they are written as they are, and a page ends with each.
        """
        path, schema = f"{self.folder}/{name}", df.schema
        how = {"compression": "none", "parquet.page.size.row.check.min": "1"} if packed else {}
        df.write.options(**how).parquet(path)
        del df
        self.spark._jvm.System.gc()
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables; every table made from them must be written by now."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def raw(column: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of each value of a string column, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return iter(column.cast(kind).to_pylist())


def rows_of(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def groups_of(batches: Iterable[pa.RecordBatch], weight, most: int) -> Iterator[list[pa.RecordBatch]]:
    """Slices of the batches, gathered until their rows weigh ``most`` together; one heavy row is a group of its own."""
    held, total = [], 0
    for batch in batches:
        sizes = np.asarray(weight(batch), dtype=np.int64)
        start = 0
        for i, size in enumerate(sizes):
            if total and total + size > most:
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield held
                held, total, start = [], 0, i
            total += int(size)
        if len(sizes) > start:
            held.append(batch.slice(start))
    if held:
        yield held


def text_bytes(column: str):
    """Weight of a row for ``groups_of``: the bytes of its text."""
    import pyarrow.compute as pc

    def weight(batch: pa.RecordBatch):
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        return sizes.to_numpy(zero_copy_only=False)
    return weight
