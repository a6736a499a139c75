"""Small files and folders through Hadoop's file system, so any store Spark reaches will do."""

from __future__ import annotations

import os
import tempfile
import uuid


class Files:
    def __init__(self, spark):
        self._spark = spark
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def mkdirs(self, path: str) -> None:
        fs, p = self._at(path)
        fs.mkdirs(p)

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def size(self, path: str) -> int:
        fs, p = self._at(path)
        return fs.getContentSummary(p).getLength()

    def delete(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.delete(p, True)

    def read_text(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_new(self, path: str, text: str) -> bool:
        """Create a file with its content in one step; False when it is there already.

        The content is written beside it and moved in place without overwriting:
        a hard link on a local disk, a rename elsewhere. Both are atomic on local
        disks and HDFS; an object store needs a lock around this.
        """
        fs, p = self._at(path)
        fs.mkdirs(p.getParent())
        aside = self._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}.tmp")
        stream = fs.create(aside, True)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        try:
            return self._move_new(fs, aside, p)
        finally:
            fs.delete(aside, False)

    def move_folder(self, source: str, target: str) -> None:
        """Make a finished folder appear under another name, all of it at once."""
        fs, src = self._at(source)
        dst = self._jvm.org.apache.hadoop.fs.Path(target)
        fs.mkdirs(dst.getParent())
        if fs.exists(dst) or not fs.rename(src, dst):
            raise OSError(f"cannot move {source} to {target}")

    def _move_new(self, fs, source, target) -> bool:
        if fs.getUri().getScheme() == "file":
            try:
                os.link(source.toUri().getPath(), target.toUri().getPath())
                return True
            except FileExistsError:
                return False
        if fs.exists(target):
            return False
        return fs.rename(source, target)


def shared_folder(spark, purpose: str) -> str:
    """A new folder every executor reaches, below the cluster's checkpoint folder.

    Only a local session may fall back to a temporary folder of the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor reaches")
        root = tempfile.mkdtemp(prefix="run-")
        spark.sparkContext.setCheckpointDir(root)
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    Files(spark).mkdirs(path)
    return path
