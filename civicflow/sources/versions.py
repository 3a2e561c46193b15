"""Tables that are replaced as a whole without a moment in which readers find none.

A new version is written to a folder of its own, and a row appended to the pointer names it; the writer's commit
makes that one row visible or not.  Readers follow the newest pointer, so they see the old version until the new
one is complete, and a writer that dies before leaves nothing but a folder that nobody reads.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.sources.sinks import ensure_table

POINTER = T.StructType([T.StructField("version", T.LongType()), T.StructField("through", T.LongType())])


@dataclass(frozen=True)
class Versions:
    path: str

    def folder(self, version: int) -> str:
        return f"{self.path}/v{version}"

    def current(self, spark: SparkSession) -> tuple[int, int]:
        """The newest version and the last batch that it has merged; (0, -1) before the first."""
        ensure_table(spark, f"{self.path}/pointer", POINTER)
        pointers = spark.read.schema(POINTER).parquet(f"{self.path}/pointer")
        newest = pointers.agg(F.max(F.struct("version", "through")).alias("p")).first()["p"]
        return (0, -1) if newest is None else (newest["version"], newest["through"])

    def publish(self, spark: SparkSession, version: int, through: int = -1) -> None:
        spark.createDataFrame([(version, through)], POINTER).coalesce(1).write.mode("append").parquet(f"{self.path}/pointer")

    def replace(self, rows: DataFrame) -> None:
        """``rows`` become the table.  A folder that an earlier writer left unfinished is written anew."""
        spark = rows.sparkSession
        version = self.current(spark)[0] + 1
        rows.write.mode("overwrite").parquet(self.folder(version))
        self.publish(spark, version)

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        version, _ = self.current(spark)
        if not version:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self.folder(version))

    def release(self, spark: SparkSession, version: int, *tables: str) -> None:
        """Empties an old version that nobody reads any more."""
        for table in tables or ("",):
            spark.createDataFrame([], POINTER).write.mode("overwrite").parquet(f"{self.folder(version)}/{table}".rstrip("/"))
