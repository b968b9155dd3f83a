"""File operations through Hadoop's own file systems, for the logs of versions and layouts."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Store:
    """The few file operations that the logs need, on the file system of a path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm = spark.sparkContext._jvm
        self.gateway = spark.sparkContext._gateway
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.files = self.path(path).getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.files.getUri(), conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none where there is no such folder."""
        place = self.path(folder)
        if not self.files.exists(place):
            return []
        return sorted(status.getPath().getName() for status in self.files.listStatus(place))

    def listing(self, name: str) -> list[tuple[str, int, int]]:
        """(name, length, time of change) of a file, or of the files in a folder, hidden ones left out."""
        found = self.files.listStatus(self.path(name))
        told = [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found if f.isFile()]
        return sorted(row for row in told if row[0][0] not in "._")

    def exists(self, name: str) -> bool:
        return self.files.exists(self.path(name))

    def write(self, name: str, text: str) -> None:
        out = self.files.create(self.path(name), False)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()

    def rename(self, source: str, target: str) -> bool:
        """Rename a file, unless the target is there already."""
        none = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        places = [self.files.makeQualified(self.path(name)) for name in (source, target)]
        try:
            self.context.rename(*places, none)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in str(error.java_exception.getClass()):
                return False
            raise
        return True

    def remove(self, name: str) -> None:
        self.files.delete(self.path(name), True)
