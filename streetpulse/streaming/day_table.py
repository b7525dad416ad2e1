"""Keyed tables of day partitions, kept up to date by micro-batches.

    <path>/tail/query=<id>/batch_id=<n>/day=<d>/    rows as batches wrote them
    <path>/marks/query=<id>/batch_id=<n>/day=<d>/   keys marked since (S8: resolved alerts)
    <path>/data/day=<d>/fold=<version>/             folded rows, one row a key
    <path>/manifest/<n>.json                        which versions make up the table

Appending writes only the batch. Reading merges: days that neither the tail nor
the marks touch are read as they are, the others are merged with their tail.
Folding rewrites only the touched days, into folders of a new version, and then
puts a new manifest in place by one rename. The manifest's high-water marks say
which batches of each query it holds, so a batch counts once: in its tail folder
or in the data. A reader takes one manifest and its files, which later folds
leave alone until ``vacuum``; it never sees half a fold.

How the rows of a key become one is the table's rule: the version written last
(``newest``, upserts) or sums (``summed``, mergeable partial aggregates).
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from .sinks import VERSION


class _Files:
    """File operations of the table's own store, whatever it is."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self._path(path).getFileSystem(self.conf)

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def matching(self, pattern: str) -> list[str]:
        return sorted(s.getPath().toString() for s in (self.fs.globStatus(self._path(pattern)) or []))

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, path: str, text: str) -> bool:
        """Creates a whole file by one rename; False if it is there already."""
        if self.fs.exists(self._path(path)):
            return False
        part = self._path(f"{os.path.dirname(path)}/.{uuid.uuid4().hex}")
        stream = self.fs.create(part)
        stream.write(bytearray(text.encode()))
        stream.close()
        return self.fs.rename(part, self._path(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)


def newest(keys: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Upsert: the version written last."""
    def merged(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in VERSION])
        return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return merged


def summed(keys: list[str], sums: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Partial aggregates: the sums of a key's rows, with a partial step."""
    def merged(rows: DataFrame) -> DataFrame:
        others = [F.max(c).alias(c) for c in VERSION]
        return rows.groupBy(*keys, "day").agg(*[F.sum(c).alias(c) for c in sums], *others)
    return merged


@dataclass
class Snapshot:
    """One state of the table: folded days, and the batches they hold."""
    version: int = 0
    days: dict = field(default_factory=dict)      # day -> version folder
    folded: dict = field(default_factory=dict)    # "tail/<query>" or "marks/<query>" -> last batch held


class DayTable:
    """``keys`` identify a row, ``time`` is the timestamp its day comes from,
    ``rule`` merges the rows of a key; ``mark`` names a boolean column that the
    marks set."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], time: str,
                 rule: Callable[[DataFrame], DataFrame] | None = None, mark: str | None = None):
        self.spark, self.path, self.keys, self.time, self.mark = spark, path, list(keys), time, mark
        self.rule = rule or newest(self.keys)
        self.files = _Files(spark, path)

    # ------------------------------------------------------------- writing
    def _query(self) -> str:
        return self.spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"

    def _write(self, kind: str, df: DataFrame, batch_id: int, query: str | None) -> None:
        query = query or self._query()
        if batch_id <= self.snapshot().folded.get(f"{kind}/{query}", -1):
            return                      # a replay of a batch that the data already holds
        out = df.withColumn("written_at", F.current_timestamp())
        if not self._schema(kind):      # columns as they are read back
            plain = StructType([StructField(f.name, f.dataType, True) for f in out.schema.fields if f.name != "day"])
            self.files.put(f"{self.path}/{kind}.schema.json", plain.json())
        out.write.mode("overwrite").partitionBy("day").parquet(f"{self.path}/{kind}/query={query}/batch_id={int(batch_id)}")

    def append(self, df: DataFrame, batch_id: int, query: str | None = None) -> None:
        """A batch's rows; writing the same batch again replaces it."""
        self._write("tail", df.withColumn("day", F.to_date(self.time)), batch_id, query)

    def mark_keys(self, keyed: DataFrame, batch_id: int, query: str | None = None) -> None:
        """Marks rows by their keys: only keys and days are written."""
        ids = keyed.select(*self.keys).distinct()
        found = self.read().select(*self.keys, "day").join(ids, self.keys, "left_semi")
        self._write("marks", found, batch_id, query)

    # ------------------------------------------------------------- reading
    def _schema(self, kind: str) -> StructType | None:
        found = self.files.matching(f"{self.path}/{kind}.schema.json")
        return StructType.fromJson(json.loads(self.files.read(found[0]))) if found else None

    def snapshot(self) -> Snapshot:
        found = self.files.matching(f"{self.path}/manifest/*.json")
        return Snapshot(**json.loads(self.files.read(found[-1]))) if found else Snapshot()

    def _pending(self, kind: str, at: Snapshot) -> dict[str, dict[str, str]]:
        """Batch folders that a snapshot does not hold: folder -> query, batch, days."""
        out = {}
        for done in self.files.matching(f"{self.path}/{kind}/query=*/batch_id=*/_SUCCESS"):
            folder = os.path.dirname(done)
            query, batch = (part.split("=", 1)[1] for part in folder.split("/")[-2:])
            if int(batch) > at.folded.get(f"{kind}/{query}", -1):
                out[folder] = {"query": query, "batch": int(batch)}
        return out

    def _days_of(self, folders) -> set[str]:
        return {p.rsplit("day=", 1)[1] for f in folders for p in self.files.matching(f"{f}/day=*")}

    def _read_paths(self, kind: str, folder: str, paths: list[str], more: str) -> DataFrame:
        fields = [*self._schema(kind).fields, StructField("day", DateType()), *StructType.fromDDL(more).fields]
        schema = StructType(list({f.name: f for f in fields}.values()))
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{folder}").parquet(*paths)

    def _tail(self, kind: str, folders, days) -> DataFrame:
        paths = [p for f in folders for p in self.files.matching(f"{f}/day=*") if days is None or p.rsplit("day=", 1)[1] in days]
        return self._read_paths(kind, kind, paths, "query string, batch_id int")

    def _data(self, at: Snapshot, days) -> DataFrame:
        paths = [f"{self.path}/data/day={d}/fold={v}" for d, v in sorted(at.days.items()) if days is None or d in days]
        return self._read_paths("tail", "data", paths, "query string, batch_id int, fold string").drop("fold")

    def _merged(self, at: Snapshot, days: set[str], tails, marks) -> DataFrame:
        data = self._data(at, days)
        rows = self.rule(data.unionByName(self._tail("tail", tails, days).select(*data.columns)))
        if self.mark and marks:
            told = self._tail("marks", marks, days).select(*[F.col(k).alias(f"_{k}") for k in self.keys], F.lit(True).alias("_told")).distinct()
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
            rows = rows.join(told, same, "left").withColumn(
                self.mark, F.col(self.mark) | F.col("_told").isNotNull()).drop("_told", *[f"_{k}" for k in self.keys])
        return rows

    def _versions(self, at: Snapshot, only: set[str] | None) -> DataFrame:
        tails, marks = self._pending("tail", at), self._pending("marks", at)
        touched = self._days_of([*tails, *marks])
        if only is not None:
            touched &= only
        calm = self._data(at, (set(at.days) if only is None else only) - touched)
        return calm.unionByName(self._merged(at, touched, tails, marks).select(*calm.columns)) if touched else calm

    def read(self, days: list[str] | None = None, at: Snapshot | None = None) -> DataFrame:
        """The table as of now (or of a snapshot), one row a key; ``days``
        (ISO texts) restricts the files that are read."""
        rows = self._versions(at or self.snapshot(), None if days is None else {str(d) for d in days})
        return rows.drop(*VERSION)

    # ---------------------------------------------------------- maintenance
    def fold(self) -> dict:
        """Rewrites the days that pending batches touch and puts the result in
        place; returns the days and the new version."""
        at = self.snapshot()
        tails, marks = self._pending("tail", at), self._pending("marks", at)
        days = self._days_of([*tails, *marks])
        if not tails and not marks:
            return {"version": at.version, "days": []}
        name = f"{at.version + 1}-{uuid.uuid4().hex[:8]}"
        rows = self._merged(at, days, tails, marks)
        if days:
            (rows.hint("rebalance", "day").sortWithinPartitions("day", *self.keys).withColumn("fold", F.lit(name))
             .write.mode("append").partitionBy("day", "fold").parquet(f"{self.path}/data"))
        folded = dict(at.folded)
        for kind, pending in (("tail", tails), ("marks", marks)):
            for p in pending.values():
                key = f"{kind}/{p['query']}"
                folded[key] = max(folded.get(key, -1), p["batch"])
        new = {"version": at.version + 1, "days": {**at.days, **dict.fromkeys(days, name)}, "folded": folded}
        if not self.files.put(f"{self.path}/manifest/{at.version + 1:010d}.json", json.dumps(new)):
            raise RuntimeError(f"another fold has put version {at.version + 1} of {self.path} in place")
        return {"version": at.version + 1, "days": sorted(days)}

    def vacuum(self, keep: int = 2) -> None:
        """Deletes what the last ``keep`` manifests do not need."""
        manifests = self.files.matching(f"{self.path}/manifest/*.json")
        kept = [Snapshot(**json.loads(self.files.read(m))) for m in manifests[-keep:]]
        if not kept:
            return
        used = {(d, v) for s in kept for d, v in s.days.items()}
        for folder in self.files.matching(f"{self.path}/data/day=*/fold=*"):
            day, v = (part.split("=", 1)[1] for part in folder.split("/")[-2:])
            if (day, v) not in used and int(v.split("-")[0]) <= kept[-1].version:
                self.files.delete(folder)
        for kind in ("tail", "marks"):
            for folder in self.files.matching(f"{self.path}/{kind}/query=*/batch_id=*"):
                query, batch = (part.split("=", 1)[1] for part in folder.split("/")[-2:])
                if int(batch) <= kept[0].folded.get(f"{kind}/{query}", -1):
                    self.files.delete(folder)
        for manifest in manifests[:-keep]:
            self.files.delete(manifest)

    def drop_days(self, before: str) -> dict:
        """T5: whole days before an ISO date go, by a manifest without them."""
        self.fold()
        at = self.snapshot()
        new = {"version": at.version + 1, "days": {d: v for d, v in at.days.items() if d >= before}, "folded": at.folded}
        self.files.put(f"{self.path}/manifest/{at.version + 1:010d}.json", json.dumps(new))
        return {"version": at.version + 1, "days": sorted(set(at.days) - set(new["days"]))}
