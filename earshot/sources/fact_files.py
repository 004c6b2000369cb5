"""A fact kept as parquet files in a folder per day, whose partitions are told apart by their files alone."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class FactFiles:
    spark: SparkSession
    path: str
    schema: T.StructType
    by: str = "DIM_DateId"

    def frame(self) -> DataFrame:
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(self.path)

    def marks(self, settings: str = "") -> DataFrame:
        """(Partition, Mark) from names, sizes and times of the files; no file is opened."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        rows = []
        for folder in fs.listStatus(root):
            name = folder.getPath().getName()
            if folder.isDirectory() and name.startswith(f"{self.by}=") and name.rpartition("=")[2].lstrip("-").isdigit():
                files = sorted(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in fs.listStatus(folder.getPath()) if not s.getPath().getName().startswith(("_", ".")))
                if files:
                    rows.append((int(name.rpartition("=")[2]), f"{settings}:{hashlib.sha256('|'.join(files).encode()).hexdigest()}"))
        return self.spark.createDataFrame(rows, "Partition int, Mark string")
