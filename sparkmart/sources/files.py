"""Small control files and folder listings on the shared file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Thin access to the Hadoop file system the tables live on."""

    def __init__(self, spark: SparkSession):
        # The file system is the JVM's, so this needs a session in the driver's own JVM.
        self._gateway = spark.sparkContext._gateway
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _open(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        where, fs = self._open(path)
        return fs.exists(where)

    def folders(self, path: str) -> list[str]:
        """Names of the direct sub-folders, empty when there is none."""
        where, fs = self._open(path)
        if not fs.exists(where):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())

    def read_text(self, path: str) -> str | None:
        where, fs = self._open(path)
        if not fs.exists(where):
            return None
        stream = fs.open(where)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Write beside the target, then rename over it: a reader sees the old or the new text."""
        where, fs = self._open(path)
        temporary, _ = self._open(f"{path}.tmp")
        stream = fs.create(temporary, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        context.rename(fs.makeQualified(temporary), fs.makeQualified(where), options)

    def delete(self, path: str) -> None:
        where, fs = self._open(path)
        fs.delete(where, True)
