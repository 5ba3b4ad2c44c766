"""Numbered manifests in a shared folder, published by compare and set.

A change reads the newest manifest, works out the next one and publishes it
under the next number.  Publishing writes a file of its own and renames it to
the number, which fails when that number is taken (an atomic step on HDFS, and
on any store whose Hadoop file system renames without overwriting); the change
is then worked out again from the newer manifest.  Readers only ever see whole
manifests, and a writer that dies leaves none.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

KEEP = 20
TRIES = 100


class Folder:
    """The few file operations that commits need, through Spark's own file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self._jvm, self._gateway = path.rstrip("/"), spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._at().getFileSystem(self._conf)

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._at())] if self._fs.exists(self._at()) else []

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)

    def write(self, name: str, text: str) -> None:
        out = self._fs.create(self._at(name), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def move(self, old: str, new: str) -> bool:
        """Rename inside the folder; False when ``new`` is there already."""
        none = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        none[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        try:
            files.rename(self._fs.makeQualified(self._at(old)), self._fs.makeQualified(self._at(new)), none)
        except Exception as exc:
            if "FileAlreadyExists" in str(getattr(exc, "java_exception", exc)):
                return False
            raise
        return True


class Versions:
    def __init__(self, spark: SparkSession, path: str, keep: int = KEEP):
        self.folder, self.keep = Folder(spark, path), keep

    def numbers(self) -> list[int]:
        return sorted(int(n.partition(".")[0]) for n in self.folder.names() if n.endswith(".json") and n[0].isdigit())

    def newest(self) -> tuple[int, dict | None]:
        """Number and content of the newest manifest; 0 and None when there is none."""
        for n in reversed(self.numbers()):
            try:
                return n, json.loads(self.folder.read(f"{n:012d}.json"))
            except Exception:
                if self.folder.exists(f"{n:012d}.json"):  # else retention took it: a newer one is there
                    raise
                return self.newest()
        return 0, None

    def publish(self, number: int, content: dict) -> bool:
        """Set manifest ``number``; False when another writer was first."""
        draft = f"_{uuid.uuid4().hex}"
        self.folder.write(draft, json.dumps(content))
        if not self.folder.move(draft, f"{number:012d}.json"):
            self.folder.delete(draft)
            return False
        for old in self.numbers()[:-self.keep]:
            self.folder.delete(f"{old:012d}.json")
        return True

    def change(self, work: Callable[[dict | None], dict | None]) -> tuple[int, dict | None]:
        """Publish ``work(newest content)``; nothing when it returns None.  Repeats behind other writers."""
        for _ in range(TRIES):
            n, content = self.newest()
            new = work(content)
            if new is None:
                return n, content
            if self.publish(n + 1, new):
                return n + 1, new
        raise RuntimeError(f"{self.folder.path}: {TRIES} other writers came first")
