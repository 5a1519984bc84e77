"""A table that micro-batches change, kept in stretches of a number (of time, mostly).

A batch that touches a stretch writes the whole stretch anew under the batch's number, and the newest version of a
stretch counts. A batch run again after a failure replaces its own versions and reads those before it, as it did the
first time. Superseded versions are removed by the batch after, when the one that superseded them is committed. So the
number of files follows the stretches in use, not the number of batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Versions:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        """`schema` names the columns besides `stretch` and `version`."""
        self.spark, self.path, self.schema = spark, path, f"{schema}, stretch bigint, version bigint"

    def listing(self) -> dict[int, list[int]]:
        """The versions of every stretch there is, in ascending order."""
        found: dict[int, list[int]] = {}
        fs, root = self._fs()
        for folder in self._children(fs, root, "stretch="):
            numbers = [int(child.getName().partition("=")[2]) for child in self._children(fs, folder, "version=")]
            if numbers:
                found[int(folder.getName().partition("=")[2])] = sorted(numbers)
        return found

    def before(self, version: int | None, stretches: set[int] | None = None) -> DataFrame:
        """The stretches as they were before a version; all there are by default, as they are now by default."""
        paths = []
        for stretch, versions in self.listing().items():
            older = [v for v in versions if version is None or v < version]
            if older and (stretches is None or stretch in stretches):
                paths.append(f"{self.path}/stretch={stretch}/version={older[-1]}")
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*paths)

    def write(self, rows: DataFrame, version: int) -> None:
        """Replaces the stretches that `rows` holds, each of which must be there as a whole."""
        (rows.withColumn("version", F.lit(version).cast("long")).repartition("stretch")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("stretch", "version").parquet(self.path))

    def tidy(self, version: int, keep_from: int | None = None) -> None:
        """Removes what no batch from `version` on will read: superseded versions, and stretches before `keep_from`."""
        fs, root = self._fs()
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        for stretch, versions in self.listing().items():
            if keep_from is not None and stretch < keep_from and versions[-1] < version:
                fs.delete(path(root, f"stretch={stretch}"), True)
                continue
            for old in [v for v in versions if v < version][:-1]:
                fs.delete(path(root, f"stretch={stretch}/version={old}"), True)

    def _fs(self):
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration()), root

    @staticmethod
    def _children(fs, folder, prefix: str) -> list:
        if not fs.exists(folder):
            return []
        return [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith(prefix)]
