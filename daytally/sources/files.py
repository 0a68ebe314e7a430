"""Single files and names, through the file system they are in: journals, leases and commits of jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Files:
    """Files in and below a folder."""

    spark: SparkSession
    location: str

    def path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)

    @property
    def system(self):
        return self.path(self.location).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        """Whole paths of what is right in a folder."""
        if not self.system.exists(self.path(folder)):
            return []
        return [status.getPath().toString() for status in self.system.listStatus(self.path(folder))]

    def below(self, folder: str) -> list[str]:
        """All files, however deep."""
        found, listed = [], self.system.listFiles(self.path(folder), True)
        while listed.hasNext():
            found.append(listed.next().getPath().toString())
        return found

    def exists(self, name: str) -> bool:
        return self.system.exists(self.path(name))

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)

    def rename(self, old: str, new: str) -> bool:
        return self.system.rename(self.path(old), self.path(new))

    def create(self, name: str, text: str) -> bool:
        """Makes a file that is not there yet; of two that try at a time only one succeeds."""
        from py4j.protocol import Py4JJavaError

        try:
            out = self.system.create(self.path(name), False)
        except Py4JJavaError as error:
            if self.exists(name):
                return False
            raise error
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def overwrite(self, name: str, text: str) -> None:
        """In place, so that the name is never free; who reads meanwhile may find a part."""
        out = self.system.create(self.path(name), True)
        out.write(bytearray(text.encode()))
        out.close()

    def write(self, name: str, text: str) -> None:
        """Whole or not at all: the text gets its name when it is written."""
        self.delete(f"{name}.new")
        if not self.create(f"{name}.new", text):
            raise RuntimeError(f"could not write {name}")
        self.delete(name)
        if not self.rename(f"{name}.new", name):
            raise RuntimeError(f"could not write {name}")

    def read(self, name: str) -> str:
        opened = self.system.open(self.path(name))
        try:
            return bytes(opened.readAllBytes()).decode()
        finally:
            opened.close()
