"""Artefacts that several drivers may write at once.

Every attempt writes under a name of its own, so no writer touches files that
another may just be reading. An attempt becomes a commit when its pointer
``_commit-<n>`` is placed, which only one writer can do for each ``n``: the
pointer is written whole and then linked (local and mounted folders) or renamed
to its name, and both fail where the name is taken. A store whose rename is a
copy (some object stores) can let two writers both place one; each attempt is
whole by itself there too, and the pointer that stays decides.

A pointer also holds a manifest: number, bytes and a digest of the names and
lengths of the attempt's files. A commit whose files no longer agree with it
does not exist for readers and is superseded by commit ``n + 1``, never
overwritten. Names and lengths are compared, not contents.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_POINTER = "_commit-"


@dataclass(frozen=True)
class Commit:
    """Commit ``number`` at ``path``: its attempt's folder, manifest and the writer's notes."""

    path: str
    number: int
    attempt: str
    manifest: list
    notes: dict = field(default_factory=dict)

    @property
    def folder(self) -> str:
        return f"{self.path}/{self.attempt}"

    def intact(self, spark: SparkSession) -> bool:
        return manifest(spark, self.folder) == self.manifest


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001


def manifest(spark: SparkSession, folder: str) -> list:
    """``[files, bytes, digest]`` of the data files under ``folder``, in one
    aggregate over Spark's listing; no content is read and no list is collected."""
    _, p, fs = _fs(spark, folder)
    if not fs.exists(p):
        return [0, 0, 0]
    name = F.substring_index("path", f"{folder.rsplit('/', 1)[1]}/", -1)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return list(files.agg(F.count("path"), F.coalesce(F.sum("length"), F.lit(0)),
                          F.coalesce(F.bit_xor(F.xxhash64(name, "length")), F.lit(0))).first())


def commits(spark: SparkSession, path: str) -> list[Commit]:
    """All commits at ``path``, oldest first (pointers only; files are not looked at)."""
    jvm, pattern, fs = _fs(spark, f"{path}/{_POINTER}*")
    out = []
    for status in fs.globStatus(pattern) or ():
        stream = fs.open(status.getPath())
        try:
            text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        out.append(Commit(path, int(status.getPath().getName()[len(_POINTER):]), **json.loads(text)))
    return sorted(out, key=lambda c: c.number)


def latest(spark: SparkSession, path: str) -> Commit | None:
    """The newest commit at ``path`` whose files are all there."""
    return next((c for c in reversed(commits(spark, path)) if c.intact(spark)), None)


def _place(spark: SparkSession, text: str, folder: str, pointer: str) -> bool:
    """Write ``text`` to ``pointer`` as a whole; false where that name is taken."""
    jvm, draft, fs = _fs(spark, f"{folder}/_pointer")
    target = jvm.org.apache.hadoop.fs.Path(pointer)
    stream = fs.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.exists(target):
        return False
    if fs.getUri().getScheme() != "file":
        try:
            return bool(fs.rename(draft, target))
        except Exception:  # some stores raise where HDFS returns false
            if fs.exists(target):
                return False
            raise
    local = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, draft)]
    try:
        jvm.java.nio.file.Files.createLink(*local)
    except Exception:
        if fs.exists(target):
            return False
        raise
    return True


def remove(spark: SparkSession, folder: str) -> None:
    _, p, fs = _fs(spark, folder)
    fs.delete(p, True)


def new_attempt() -> str:
    return f"attempt-{uuid.uuid4().hex}"


def commit(spark: SparkSession, path: str, attempt: str, number: int,
           notes: dict | None = None) -> Commit | None:
    """Commit what was written to ``<path>/<attempt>`` as ``number``; ``None``
    where another writer already has that number. Its own files then serve
    nobody and are removed."""
    folder = f"{path}/{attempt}"
    body = {"attempt": attempt, "manifest": manifest(spark, folder), "notes": notes or {}}
    if _place(spark, json.dumps(body), folder, f"{path}/{_POINTER}{number:08d}"):
        return Commit(path, number, **body)
    remove(spark, folder)
    return None


def load_or_commit(spark: SparkSession, path: str, write: Callable[[str], object]) -> Commit:
    """The commit at ``path``; without one, ``write(folder)`` fills a folder of
    its own, which is committed. Writers at the same time all get the one that
    was placed first."""
    while True:
        found = latest(spark, path)
        if found:
            return found
        taken = max((c.number for c in commits(spark, path)), default=-1)  # a damaged commit
        attempt = new_attempt()
        write(f"{path}/{attempt}")
        done = commit(spark, path, attempt, taken + 1)
        if done:
            return done


def load_or_compute(spark: SparkSession, path: str, compute: Callable[[], DataFrame], **kw) -> DataFrame:
    """The table committed at ``path``, else ``compute()``, written there by
    :func:`~recsift.sources.store.materialize` with ``kw`` and committed."""
    from recsift.sources.store import materialize

    done = load_or_commit(spark, path, lambda folder: materialize(compute(), folder, **kw))
    return spark.read.parquet(done.folder)
