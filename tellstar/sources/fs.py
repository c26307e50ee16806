"""Thin Hadoop FileSystem access (metadata only: list, exists, rename, delete).

Works for any Hadoop-supported scheme (file, hdfs, s3a, ...) because it goes through the
JVM's FileSystem of the session, never through the driver's local disk.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return p.getFileSystem(conf), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path of a ``file:`` folder, which every machine of the session has mounted; None for
    what only Hadoop's file systems reach."""
    fs, p, _ = _fs(spark, path)
    uri = fs.makeQualified(p).toUri()
    return str(uri.getPath()) if uri.getScheme() == "file" and not uri.getAuthority() else None


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Immediate children (full URIs); [] when the folder does not exist."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [str(s.getPath().toString()) for s in fs.listStatus(p)]


def files_below(spark: SparkSession, path: str, name: str) -> list[str]:
    """Full URIs of the files with a byte or more whose name matches, by Spark's own listing (a call
    for each file, or the access rights that Hadoop's recursive listing looks up, take seconds per 1,000)."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", name).option("recursiveFileLookup", "true")
    return [r.path for r in few_tasks(reader.load(path).select("path")).collect()]


def few_tasks(scan: DataFrame) -> DataFrame:
    """A scan of small files, at most 8 tasks for each core: the planner makes a task of every few files."""
    return scan.coalesce(8 * scan.sparkSession.sparkContext.defaultParallelism)


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p, jvm = _fs(spark, src)
    d = jvm.org.apache.hadoop.fs.Path(dst)
    fs.mkdirs(d.getParent())
    return bool(fs.rename(p, d))


def renames(spark: SparkSession, pairs: list[tuple[str, str]], at_once: int = 8) -> None:
    """``rename`` of many files of one file system, several at once; the folders are made once."""
    if not pairs:
        return
    fs, _, jvm = _fs(spark, pairs[0][0])
    make = jvm.org.apache.hadoop.fs.Path
    for folder in {dst.rsplit("/", 1)[0] for _, dst in pairs}:
        fs.mkdirs(make(folder))

    def move(pair: tuple[str, str]) -> None:
        if not fs.rename(make(pair[0]), make(pair[1])):
            raise OSError(f"could not rename {pair[0]} to {pair[1]}")

    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(move, pairs))


def rename_new(spark: SparkSession, src: str, dst: str) -> None:
    """Rename to a name that must not exist yet; raises if it does or if the rename fails (never
    moves ``src`` into an existing folder)."""
    fs, p, jvm = _fs(spark, src)
    d = jvm.org.apache.hadoop.fs.Path(dst)
    fs.mkdirs(d.getParent())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context.rename(fs.makeQualified(p), fs.makeQualified(d), options)


def glob_escaped(path: str) -> str:
    """The path as a pattern that matches it alone."""
    return "".join("\\" + c if c in "\\*?[]{}" else c for c in path)


def file_names(df: DataFrame) -> DataFrame:
    """(path, percent-encoded) of every file that a file-source frame has listed, those without
    bytes too. The names stay in the JVM."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    names = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(df._jdf.inputFiles())
    found = spark._jsparkSession.createDataset(names, jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(found.toDF(), spark).toDF("path")


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    """Names that match, in any folder the session can list (one call, whatever it passes over)."""
    fs, p, _ = _fs(spark, pattern)
    return [str(s.getPath().toString()) for s in (fs.globStatus(p) or [])]


def _any(spark: SparkSession, pattern: str) -> bool:
    fs, p, _ = _fs(spark, pattern)
    return len(fs.globStatus(p) or []) > 0


def hidden_files(spark: SparkSession, path: str, suffixes: tuple[str, ...], most: int = 10) -> list[str]:
    """Up to ``most`` files with one of the suffixes that Spark's readers skip, because the file
    or a folder above it (below ``path``) begins with ``_`` or ``.``.

    The file system lists and matches inside the JVM, by a pattern for each depth and each place of
    the hidden name; the number of calls does not depend on the number of files. A folder that is
    mounted is walked instead, name by name: a pattern holds every file's status at once."""
    fs, p, _ = _fs(spark, path)
    top = fs.makeQualified(p).toUri()
    if top.getScheme() == "file" and not top.getAuthority():
        return _hidden_mounted(str(top.getPath()).rstrip("/"), suffixes, most)
    base = glob_escaped(str(fs.makeQualified(p).toString()).rstrip("/"))
    ends = "{" + ",".join(suffixes) + "}"
    found: list[str] = []
    depth = 1
    while len(found) < most and _any(spark, base + "/*" * depth):
        for at in range(depth):
            names = ["*"] * depth
            names[-1] = "*" + ends
            names[at] = "[_.]" + names[at]
            found += [f for f in _glob(spark, f"{base}/{'/'.join(names)}") if f not in found]
        depth += 1
    return sorted(found)[:most]


def _hidden_mounted(path: str, suffixes: tuple[str, ...], most: int) -> list[str]:
    """``hidden_files`` of a mounted folder. A depth at a time; only its folders are held, and the
    first ``most`` names."""
    found: list[str] = []
    folders = [(path, False)]
    while folders and len(found) < most:
        below: list[tuple[str, bool]] = []
        found = heapq.nsmallest(most, [*found, *heapq.nsmallest(most, _hidden_in(folders, suffixes, below))])
        folders = below
    return found


def _hidden_in(folders: list[tuple[str, bool]], suffixes: tuple[str, ...], below: list[tuple[str, bool]]) -> Iterator[str]:
    """What the folders (and whether they are hidden) have of hidden files; ``below`` gets their folders."""
    for folder, hidden in folders:
        try:
            entries = os.scandir(folder or "/")
        except (FileNotFoundError, NotADirectoryError):  # gone meanwhile
            continue
        with entries:
            for e in entries:
                skipped = hidden or e.name.startswith(("_", "."))
                if e.is_dir():
                    below.append((f"{folder}/{e.name}", skipped))
                if skipped and e.name.endswith(suffixes) and os.path.exists(e.path):
                    yield f"file:{folder}/{e.name}"


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.delete(p, recursive))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Small marker/pointer files only."""
    fs, p, _ = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p, jvm = _fs(spark, path)
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def create_exclusive(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create ``path`` only if absent (atomic on HDFS/local): True when this call created it."""
    fs_, p, _ = _fs(spark, path)
    try:
        out = fs_.create(p, False)
    except Exception:  # a Py4J error; only "it exists" means that another call was first
        if fs_.exists(p):
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def age_seconds(spark: SparkSession, path: str) -> float:
    """Seconds since the file was written."""
    import time

    fs_, p, _ = _fs(spark, path)
    return time.time() - fs_.getFileStatus(p).getModificationTime() / 1000


def stamp(spark: SparkSession, path: str) -> str:
    """Cheap content stamp of a folder: names, sizes and modification times of its files."""
    fs_, p, _ = _fs(spark, path)
    if not fs_.exists(p):
        return "missing"
    parts = []
    for s in fs_.listStatus(p):
        parts.append(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}")
    return "|".join(sorted(parts))
