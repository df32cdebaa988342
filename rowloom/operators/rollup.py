"""Sum of distinct file sizes per path over the revisions of a repository, largest first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the column where the padded size starts in a long tree listing.
SIZE_START = 54


def flatten_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Take size and path from the lines of a long tree listing."""
    tail = F.ltrim(F.substring(F.col(column), SIZE_START, 1 << 30))
    fields = F.split(tail, "\t")
    return lines.select(F.get(fields, 0).alias("size"), F.get(fields, 1).alias("path"))


def flatten_revisions(revisions: DataFrame, files: str = "files") -> DataFrame:
    """Take size and path from revisions that hold an array of file structs."""
    return revisions.select(F.inline(files)).select("size", "path")


def distinct_sizes(files: DataFrame) -> DataFrame:
    """Each (size, path) once, however many revisions hold it."""
    return files.select("size", "path").distinct()


def size_number(size: Column) -> Column:
    """A size text as a number: its leading integer, or 0 where it has none.

    A ``try_cast`` would raise and catch an exception for each text without a number,
    which is slow where many files have no size.
    """
    leading = F.regexp_extract(size, r"^\s*([+-]?\d+)", 1)
    return F.coalesce(F.nullif(leading, F.lit("")).cast("long"), F.lit(0).cast("long"))


def sum_by_path(sizes: DataFrame) -> DataFrame:
    """Total size per path; sizes may be text or whole numbers."""
    is_text = isinstance(sizes.schema["size"].dataType, T.StringType)
    number = size_number(F.col("size")) if is_text else F.col("size").cast("long")
    return sizes.groupBy("path").agg(F.sum(number).alias("total"))


def largest_first(totals: DataFrame) -> DataFrame:
    """Descending by total, and by path where totals are equal."""
    return totals.orderBy(F.desc("total"), F.desc("path"))


def top_paths(files: DataFrame, count: int = 20) -> DataFrame:
    """The paths with the largest sums of distinct sizes.

    The distinct shuffles by (size, path) and the sum is partial before it shuffles by
    path, so a path with most of the rows sends each task's sum and nothing more. The
    sort and limit become one top-k per task and a merge.
    """
    return largest_first(sum_by_path(distinct_sizes(files))).limit(count)


class RollupState:
    """Distinct (size, path) pairs in a folder, to which the files of new revisions are added.

    Each batch of revisions adds the pairs that no other batch holds, and the sums of their
    sizes per path. A batch is written whole or not at all, and one that is added again
    replaces itself, so a job that was lost is simply run again. Batches are added one after
    another; adding costs one join of the new pairs with the stored ones, not a scan of old
    revisions, and totals need the sums alone.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, path: str, files: DataFrame) -> RollupState:
        """A new folder for files with the types of ``files``, none of whose rows are read."""
        state = cls(spark, path)
        none = files.select("size", "path").limit(0)
        state._write(none, sum_by_path(none), 0)
        return state

    def _write(self, pairs: DataFrame, sums: DataFrame, batch: int) -> None:
        pairs.write.mode("overwrite").parquet(f"{self.path}/pairs/batch={batch}")
        sums.write.mode("overwrite").parquet(f"{self.path}/sums/batch={batch}")

    def add(self, files: DataFrame, batch: int) -> None:
        """Add the files of a batch of revisions, numbered from 1."""
        if batch < 1:
            raise ValueError("batches are numbered from 1")
        known = self.pairs().where(F.col("batch") != batch).alias("known")
        new = distinct_sizes(files).alias("new")
        same = [F.col(f"new.{c}").eqNullSafe(F.col(f"known.{c}")) for c in ("size", "path")]
        new.join(known, same, "left_anti").write.mode("overwrite").parquet(f"{self.path}/pairs/batch={batch}")
        added = self.spark.read.parquet(f"{self.path}/pairs/batch={batch}")
        sum_by_path(added).write.mode("overwrite").parquet(f"{self.path}/sums/batch={batch}")

    def pairs(self) -> DataFrame:
        """size, path and the batch that brought them; each pair once."""
        return self.spark.read.parquet(f"{self.path}/pairs")

    def totals(self) -> DataFrame:
        """Total of distinct sizes per path over all batches."""
        sums = self.spark.read.parquet(f"{self.path}/sums")
        return sums.groupBy("path").agg(F.sum("total").alias("total"))

    def top_paths(self, count: int = 20) -> DataFrame:
        """The paths with the largest sums of distinct sizes over all batches."""
        return largest_first(self.totals()).limit(count)
