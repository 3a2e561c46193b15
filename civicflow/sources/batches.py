"""Tables that grow batch by batch, with compaction.

    <path>, <path>-tail<v>   batch_id / ...   the batches since version v, a folder each
    <path>-run<n>            ...              many older batches in one folder, batch_id as a column
    <path>-manifest          version, through, runs: which of them make up the table

A batch that comes again replaces its folder.  ``compact`` writes all batches but the newest, which may still come
again, into a run, together with the newest runs as long as they are not much larger than what is merged; so a
row is written again about log(rows) times, and the number of runs grows with that logarithm only.  One appended
manifest row makes the new version visible: readers see the old one until then, and a compaction that dies before
it leaves folders that nobody reads and that the next one overwrites.  Batches and compactions come from one
writer, one after the other; readers may read at any time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.schema import BATCH
from civicflow.sources.sinks import ensure_table, write_batch

#: A run is merged again with new rows if it has at most this many times as many.
TIER = 4
RUN = T.StructType([T.StructField("run", T.LongType()), T.StructField("rows", T.LongType())])
MANIFEST = T.StructType(
    [T.StructField("version", T.LongType()), T.StructField("through", T.LongType()), T.StructField("runs", T.ArrayType(RUN))]
)


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    #: Last batch that is in a run; all later ones have a folder.
    through: int = -1
    #: (run, rows), oldest first.
    runs: tuple[tuple[int, int], ...] = ()


@dataclass(frozen=True)
class BatchTable:
    path: str
    schema: T.StructType
    within: tuple[str, ...] = ()
    #: What merged rows become, for tables whose rows can be combined.
    combine: Callable[[DataFrame], DataFrame] | None = None

    def tail(self, version: int) -> str:
        return f"{self.path}-tail{version}" if version else self.path

    def run(self, number: int) -> str:
        return f"{self.path}-run{number}"

    def manifest(self, spark: SparkSession, version: int | None = None) -> Manifest:
        """The newest manifest, or that of ``version``; no job runs for a table that was never compacted."""
        try:
            rows = spark.read.schema(MANIFEST).parquet(f"{self.path}-manifest")
        except AnalysisException:
            return Manifest()
        if version is not None:
            rows = rows.where(F.col("version") == version)
        newest = rows.agg(F.max_by(F.struct(*MANIFEST.fieldNames()), "version").alias("m")).first()["m"]
        return Manifest(newest.version, newest.through, tuple(map(tuple, newest.runs))) if newest else Manifest()

    def ensure(self, spark: SparkSession) -> None:
        ensure_table(spark, self.tail(self.manifest(spark).version), self.schema, BATCH, *self.within)

    def _folder(self, spark: SparkSession, folder: str) -> DataFrame:
        return spark.read.schema(self.schema).parquet(folder)

    def recent(self, spark: SparkSession) -> DataFrame:
        """The batches that no compaction has merged."""
        return self._folder(spark, self.tail(self.manifest(spark).version))

    def read(self, spark: SparkSession) -> DataFrame:
        now = self.manifest(spark)
        folders = [self.tail(now.version), *(self.run(n) for n, _ in now.runs)]
        return reduce(DataFrame.unionByName, (self._folder(spark, f) for f in folders))

    def has_merged(self, spark: SparkSession, batch_id: int) -> bool:
        return batch_id <= self.manifest(spark).through

    def write(self, rows: DataFrame) -> None:
        """``rows`` replace the batches that they belong to, which must be newer than the merged ones."""
        write_batch(rows, self.tail(self.manifest(rows.sparkSession).version), *self.within)

    def compact(self, spark: SparkSession) -> bool:
        """Merges all batches but the newest; says whether there were any."""
        now = self.manifest(spark)
        tail = self._folder(spark, self.tail(now.version))
        newest = tail.agg(F.max(BATCH)).first()[0]
        older = tail.where(F.col(BATCH) < newest) if newest is not None else tail
        rows = older.count()
        if newest is None or not rows:
            return False
        runs, parts, version = list(now.runs), [older], now.version + 1
        while runs and runs[-1][1] <= TIER * rows:
            number, more = runs.pop()
            parts.append(self._folder(spark, self.run(number)))
            rows += more
        merged = reduce(DataFrame.unionByName, parts)
        merged = self.combine(merged) if self.combine else merged
        out = merged.hint("rebalance", *self.within).write.mode("overwrite").option("partitionOverwriteMode", "static")
        (out.partitionBy(*self.within) if self.within else out).parquet(self.run(version))
        write_batch(tail.where(F.col(BATCH) == newest), self.tail(version), *self.within, whole=True)
        pointer = (version, newest - 1, [*runs, (version, rows)])
        spark.createDataFrame([pointer], MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}-manifest")
        return True

    def release_old(self, spark: SparkSession) -> None:
        """Empties what the version before the current one had alone, once its readers are done."""
        now = self.manifest(spark)
        if not now.version:
            return
        old = self.manifest(spark, now.version - 1)
        unused = [self.tail(old.version), *(self.run(n) for n, _ in old.runs if (n, _) not in now.runs)]
        for folder in unused:
            nothing = spark.createDataFrame([], self.schema).write.mode("overwrite")
            nothing.option("partitionOverwriteMode", "static").parquet(folder)
