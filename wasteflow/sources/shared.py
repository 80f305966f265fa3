"""The folder that driver and executors share, and small files in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only in local mode, where it is not set, a temporary folder."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local*")) and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="wasteflow-"))
    return _OWN[0]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read back: computed once, however often it is read."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Files:
    """Small files under one path of any file system that Spark reaches; used on the driver only."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark._jvm, path.rstrip("/")
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        """Names in the folder, in order; none if it does not exist."""
        at = self._at("")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Writes a file, in place of one of that name."""
        stream = self._fs.create(self._at(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def put_if_absent(self, name: str, text: str) -> bool:
        """Writes a whole file under another name and renames it; False if there is one of that name.

        The rename is the call that fails where its target exists. HDFS does that in one step; a store that does not
        needs a committer of its own.
        """
        draft = f".{name}-{uuid.uuid4().hex}"
        self.put(draft, text)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        none = self._gateway.new_array(rename, 1)
        none[0] = rename.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        try:
            context.rename(self._at(draft), self._at(name), none)
            return True
        except Exception as failed:
            if not self._fs.exists(self._at(name)):
                raise
            if "FileAlreadyExists" not in str(failed):
                raise
            return False
        finally:
            self._fs.delete(self._at(draft), False)

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
