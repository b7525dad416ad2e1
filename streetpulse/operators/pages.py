"""Pages of a stored, sorted table (L1, L2, L3) without sorting it again.

The rows are written once, range-partitioned by their sort key, with a fence
index beside them: the first key and the number of rows of every part. A page by
number finds its parts from the running row counts, a page after a key (keyset
paging) from the first keys; either reads the files of the one or few parts that
hold it. Totals come from the fences alone.

The order is ascending by the key expressions; a descending column is given as
its negative (``-unix_micros(window_start)``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class PagedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @staticmethod
    def write(df: DataFrame, path: str, key: Sequence[str], rows_per_part: int = 500_000) -> "PagedTable":
        """Writes ``df`` sorted by the SQL expressions ``key``, which must tell
        rows apart (ties are in no order)."""
        keyed = df.withColumn("_key", F.struct(*[F.expr(k).alias(f"k{i}") for i, k in enumerate(key)]))
        parts = max(1, -(-df.count() // rows_per_part))
        by = [F.col(f"_key.k{i}") for i in range(len(key))]
        keyed.withColumn("part", F.lit(0)).limit(0).write.parquet(path + "/schema")   # an empty table has no other file
        (keyed.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id())
         .write.partitionBy("part").parquet(path + "/rows"))
        table = PagedTable(df.sparkSession, path)
        fences = table.rows().groupBy("part").agg(F.count("*").alias("n"), F.min("_key").alias("first"))
        fences.coalesce(1).write.parquet(path + "/fences")
        return table

    def rows(self) -> DataFrame:
        kind = self.spark.read.parquet(self.path + "/schema").schema
        return self.spark.read.schema(kind).parquet(self.path + "/rows")

    def fences(self) -> DataFrame:
        """part, n, first key, and the rows before the part; one row a part."""
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        return self.spark.read.parquet(self.path + "/fences").withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))

    def _sorted(self, parts: list[int], n: int, offset: int = 0, where=None) -> DataFrame:
        held = self.rows().where(F.col("part").isin(parts))
        held = held if where is None else held.where(where)
        return held.orderBy("_key").offset(offset).limit(n).drop("_key", "part")

    def page(self, number: int, per_page: int = 30) -> DataFrame:
        """Page ``number`` (from 1)."""
        start = (number - 1) * per_page
        near = self.fences().where((F.col("before") < start + per_page) & (F.col("before") + F.col("n") > start)).select(
            "part", "before").collect()     # the parts of one page
        if not near:
            return self._sorted([-1], per_page)
        return self._sorted([r["part"] for r in near], per_page, start - min(r["before"] for r in near))

    def after(self, key: Sequence, per_page: int = 30) -> DataFrame:
        """The page that follows the row with the given key values."""
        kinds = self.rows().schema["_key"].dataType
        last = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(key, kinds.fields)])
        fences = self.fences()
        own = F.coalesce(fences.where(F.col("first") <= last).agg(F.max("part")).scalar(), F.lit(0))
        behind = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        ahead = fences.where(F.col("part") >= own).withColumn(
            "full", F.coalesce(F.sum(F.when(F.col("part") > own, F.col("n"))).over(behind), F.lit(0)))
        near = [r[0] for r in ahead.where(F.col("full") < per_page).select("part").collect()]
        return self._sorted(near or [-1], per_page, where=F.col("_key") > last)

    def total(self, per_page: int = 30) -> DataFrame:
        """L3 from the fences."""
        return (self.spark.read.parquet(self.path + "/fences").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
                .withColumn("pages", F.ceil(F.col("total") / F.lit(per_page)).cast("long")).withColumn("per_page", F.lit(per_page)))
