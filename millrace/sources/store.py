"""Files of a table's log: read, list, create exactly once.

Local paths go through the operating system (a link that fails where the name is taken), HDFS through a rename that doesn't
replace. Object stores have no such rename, so the file is created under its own name on the condition that there is none:
S3 by a conditional put, which the file system must support (it is asked for as a must, so that an older one refuses instead of
racing), Google's store by its generation check, which is what creating without overwriting does there."""

from __future__ import annotations

import os
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Locations a table may lie in (fixed list of schemes).
SCHEMES = ("s3", "s3a", "gs", "hdfs", "file")
#: Hadoop's option of a conditional create, and what a failed condition is called (fixed values).
CONDITIONAL = "fs.option.create.conditional.overwrite"
TAKEN = ("FileAlreadyExistsException", "RemoteFileChangedException")


def check_location(path: str) -> str:
    """The location, if it is an absolute path or has a known scheme and a bucket or path behind it; else raises."""
    m = re.fullmatch(r"([a-z0-9]+)://(.*)", path or "")
    if m is None and path and os.path.isabs(path):
        return path
    if m is None or m[1] not in SCHEMES:
        raise ValueError(f"unknown location {path!r}; known schemes: {', '.join(SCHEMES)}")
    if m[1] == "file":
        if not m[2].startswith("/") or len(m[2]) < 2:
            raise ValueError(f"file locations look like file:///folder, not {path!r}")
    elif not re.match(r"[A-Za-z0-9][A-Za-z0-9._:-]*(/.*)?$", m[2]):
        raise ValueError(f"no bucket in {path!r}")
    return path


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.local = self.root[len("file://") :] if self.root.startswith("file:///") else self.root[len("file:") :] if self.root.startswith("file:/") else self.root if "://" not in self.root else None

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> bytes:
        if self.local is not None:
            with open(f"{self.local}/{name}", "rb") as f:
                return f.read()
        fs, p = self._fs(self.at(name))
        stream = fs.open(p)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def names(self, folder: str) -> list[str]:
        """File names in a folder, sorted; none if it doesn't exist."""
        if self.local is not None:
            try:
                return sorted(e for e in os.listdir(f"{self.local}/{folder}") if not e.startswith("."))
            except FileNotFoundError:
                return []
        fs, p = self._fs(self.at(folder))
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if not s.getPath().getName().startswith(".")) if fs.exists(p) else []

    def create(self, name: str, content: bytes) -> bool:
        """Writes a file that isn't there yet, whole or not at all; False if somebody else has."""
        if self.local is not None:
            target = f"{self.local}/{name}"
            os.makedirs(os.path.dirname(target), exist_ok=True)
            part = f"{os.path.dirname(target)}/.{uuid.uuid4().hex}"
            with open(part, "wb") as f:
                f.write(content)
                f.flush()
                os.fsync(f.fileno())
            try:
                os.link(part, target)
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(part)
        fs, target = self._fs(self.at(name))
        scheme = self.root.partition("://")[0]
        if scheme in ("s3", "s3a", "gs"):
            return self._create_if_absent(fs, target, content, conditional=scheme != "gs")
        if fs.exists(target):
            return False
        part = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{os.path.dirname(name)}/.{uuid.uuid4().hex}")
        out = fs.create(part, False)
        out.write(bytearray(content))
        out.close()
        if fs.rename(part, target):
            return True
        fs.delete(part, False)
        return False

    @staticmethod
    def _create_if_absent(fs, target, content: bytes, conditional: bool) -> bool:
        """One request that fails where the object is there; it shows when the stream is closed."""
        try:
            if conditional:
                out = fs.createFile(target).overwrite(False).must(CONDITIONAL, True).build()
            else:
                out = fs.create(target, False)
            out.write(bytearray(content))
            out.close()
            return True
        except Py4JJavaError as e:
            cause, names = e.java_exception, []
            while cause is not None:
                names.append(cause.getClass().getSimpleName())
                cause = cause.getCause()
            if any(n in TAKEN for n in names):
                return False
            if "IllegalArgumentException" in names:
                raise ValueError(f"the file system of {target} can't create a file on condition; commits there wouldn't be safe") from e
            raise

    def tree(self, folder: str) -> list[tuple[str, int, float]]:
        """(path below the root, bytes, seconds since the epoch) of every data file below a folder."""
        out = []
        if self.local is not None:
            for base, _, files in os.walk(f"{self.local}/{folder}"):
                for f in files:
                    if not f.startswith((".", "_")):
                        s = os.stat(f"{base}/{f}")
                        out.append((os.path.relpath(f"{base}/{f}", self.local), s.st_size, s.st_mtime))
            return sorted(out)
        fs, p = self._fs(self.at(folder))
        if not fs.exists(p):
            return []
        it = fs.listFiles(p, True)
        while it.hasNext():
            s = it.next()
            path = s.getPath().toString()
            if not s.getPath().getName().startswith((".", "_")):
                out.append((path.partition(f"{self.root}/")[2] or path, s.getLen(), s.getModificationTime() / 1000))
        return sorted(out)

    def delete(self, name: str) -> None:
        if self.local is not None:
            os.unlink(f"{self.local}/{name}")
        else:
            fs, p = self._fs(self.at(name))
            fs.delete(p, False)
