"""Small files and listings by Hadoop's FileSystem, so that any path will do that Spark reads and writes."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """Small text files and folders by Hadoop's FileSystem."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def read(self, path: str) -> str | None:
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        fs, p = self._at(path)
        tmp = self.jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
        stream = fs.create(tmp, True)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else fs.getUri(), self.conf)
        overwrite = self.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self.jvm.java.lang.reflect.Array.newInstance(overwrite.getClass(), 1)
        options[0] = overwrite
        context.rename(fs.makeQualified(tmp), fs.makeQualified(p), options)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def names(self, path: str) -> list[str]:
        """Names in a folder; none where there is no folder."""
        fs, p = self._at(path)
        return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []

    def walk(self, path: str, suffix: str = "") -> list[str]:
        """Full paths of the files below a folder."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        out, found = [], fs.listFiles(p, True)
        while found.hasNext():
            name = found.next().getPath().toString()
            if name.endswith(suffix) and name.rpartition("/")[2][:1] not in "_.":
                out.append(name)
        return sorted(out)

    def sizes(self, path: str) -> tuple[int, int]:
        """Files and bytes below a path."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return 0, 0
        s = fs.getContentSummary(p)
        return s.getFileCount(), s.getLength()
