"""Helpers shared by the operators: tables, hold-out folds, bounded token memories, binary files."""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrocar.session import shared_dir

# Texts may hold a hundred kilobytes each, so batches that go to Python hold few rows.
BATCH_ROWS = 400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows that one Arrow batch carries to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def fold(key: str, folds: int) -> Column:
    """The remainder of crc32 of the id as text; a null id is in no fold."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


class Memo(dict):
    """Values by token, worked out on first use and forgotten all together beyond ``limit``."""

    def __init__(self, make: Callable, limit: int = 300_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, token):
        if len(self) >= self.limit:
            self.clear()
        value = self[token] = self.make(token)
        return value


class Seen:
    """Words with their pieces, in two generations: words not met for a generation are forgotten."""

    def __init__(self, limit: int = 250_000):
        self.young: dict = {}
        self.old: dict = {}
        self.limit = limit

    def all(self, words: set[str], make) -> dict:
        """A table that holds all of ``words``; ``make`` gives those that are new."""
        missing = words.difference(self.young)
        self.young.update((w, self.old[w]) for w in missing.intersection(self.old))
        self.young.update(make(list(missing.difference(self.old))))
        table = self.young
        if len(table) > self.limit:
            self.young, self.old = {}, table
        return table


# Spark's text writer puts a separator after each value and copies a value's bytes as they are.
# Values are written without their last byte, which must be the separator, so a file is exactly
# the concatenation of its values, and goes through Spark's commit protocol to any store.
END = "\x00"


def write_binary(df: DataFrame, path: str, per_file: int, by: tuple[str, ...] = ()) -> None:
    """Write the binary column ``body``, each value ending in a zero byte, ``per_file`` values a file."""
    trimmed = F.expr("cast(substring(body, 1, length(body) - 1) AS string)").alias("value")
    writer = df.select(trimmed, *by).write.option("lineSep", END)
    writer = writer.partitionBy(*by) if by else writer
    writer.option("maxRecordsPerFile", per_file).text(path)


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    """The files under ``path`` as (path, content), empty if there are none."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
