"""Table IO without a table format: snapshots named by a small commit log.

    <table>/data-<id>/       a snapshot's Parquet files, written under their final name
    <table>/_log/00000007    one small JSON entry for each version, naming its snapshot

A writer puts its snapshot into a folder of its own, may check what it has written, and commits
by renaming a finished entry to the next version's name, which must be new. That one rename of a
small file is the commit: before it nothing of the snapshot shows, after it all does, and of two
writers that began from one version the second one gets a ``Conflict`` (``update_snapshot`` then
makes its snapshot again from the newer one). If a rename reports an error, the log tells whether
it took effect; only a writer that knows it has not deletes its files. What follows a commit
(old versions go after ``KEEP_SECONDS``) may fail without harm: it is logged and done by a later
commit. Readers take the newest entry's snapshot.
"""

from __future__ import annotations

import json
import logging
import re
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from . import fs

log = logging.getLogger(__name__)

#: Older versions, and folders that no version names, are removed only once they are this old.
KEEP_SECONDS = 24 * 3600

_VERSION = re.compile(r"/(\d{8})/?$")
_DATA = re.compile(r"/(data-[0-9a-f]{32})/?$")


class NotCommitted(OSError):
    """The commit has certainly not taken effect."""


class Conflict(NotCommitted):
    """Another writer has committed since the version that a snapshot was made from."""


class CommitUnknown(OSError):
    """The commit may have taken effect: nothing was deleted."""


@dataclass
class Entry:
    """A version of a table: its number, writer, folder (below the table's) and notes."""

    version: int
    id: str
    folder: str
    notes: dict[str, str] = field(default_factory=dict)


def _log_dir(path: str) -> str:
    return path.rstrip("/") + "/_log"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(m.group(1)) for child in fs.list_dir(spark, _log_dir(path)) if (m := _VERSION.search(child)))


def _entry(spark: SparkSession, path: str, version: int) -> Entry:
    return Entry(**json.loads(fs.read_text(spark, f"{_log_dir(path)}/{version:08d}")))


def versions(spark: SparkSession, path: str) -> list[Entry]:
    """The entries that are kept, oldest first."""
    return [_entry(spark, path, n) for n in _numbers(spark, path)]


def latest_entry(spark: SparkSession, path: str) -> Entry | None:
    numbers = _numbers(spark, path)
    return _entry(spark, path, numbers[-1]) if numbers else None


def snapshot_path(path: str, entry: Entry) -> str:
    return f"{path.rstrip('/')}/{entry.folder}"


def latest_snapshot(spark: SparkSession, path: str) -> str | None:
    entry = latest_entry(spark, path)
    return snapshot_path(path, entry) if entry else None


def latest_version(spark: SparkSession, path: str) -> int:
    """Number of the newest committed version (0: none)."""
    numbers = _numbers(spark, path)
    return numbers[-1] if numbers else 0


def table_exists(spark: SparkSession, path: str) -> bool:
    return latest_version(spark, path) > 0 or fs.exists(spark, path.rstrip("/") + "/_SUCCESS")


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Newest committed snapshot, or a plain parquet folder."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(latest_snapshot(spark, path) or path)


# ---------------------------------------------------------------- commits

def publish(spark: SparkSession, path: str, entry: Entry) -> None:
    """The commit: puts ``entry`` at its version's name if that is new and the version before is
    still the newest. Raises ``Conflict`` or ``NotCommitted`` where it has not taken effect, and
    ``CommitUnknown`` where that cannot be told."""
    target = f"{_log_dir(path)}/{entry.version:08d}"
    draft = f"{_log_dir(path)}/_draft-{entry.id}"
    try:
        fs.write_text(spark, draft, json.dumps(asdict(entry)))
        newest = latest_version(spark, path)
    except Exception as e:
        raise NotCommitted(f"could not prepare {target}") from e
    if newest != entry.version - 1:
        best_effort(fs.delete, spark, draft)
        raise Conflict(f"{target}: the newest version is {newest}")
    try:
        fs.rename_new(spark, draft, target)
    except Exception as e:
        # it may have taken effect all the same (an answer lost on its way)
        try:
            there = fs.exists(spark, target)
            ours = there and _entry(spark, path, entry.version).id == entry.id
        except Exception as unknown:
            raise CommitUnknown(f"{target}: {e}") from unknown
        if ours:
            return
        best_effort(fs.delete, spark, draft)
        if there:
            raise Conflict(f"{target} was written by another writer meanwhile") from e
        raise NotCommitted(f"could not commit {target}") from e


def best_effort(fn: Callable, *args) -> None:
    """Cleaning up: an error is logged and never raised."""
    try:
        fn(*args)
    except Exception:
        log.warning("left for a later cleanup: %s", args[1:], exc_info=True)


def write_snapshot(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    check: Callable[[DataFrame], None] | None = None,
    keep: int = 2,
    base: int | None = None,
    notes: dict[str, str] | None = None,
) -> str:
    """Write ``df`` as the next version of the table at ``path`` and return its folder.

    ``base`` is the version that ``df`` was made from (default: the newest one now); if another
    writer has committed after it, this raises ``Conflict`` and changes nothing. ``check`` is given
    the written rows before the commit; if it raises, they go."""
    spark = df.sparkSession
    path = path.rstrip("/")
    base = latest_version(spark, path) if base is None else base
    own = uuid.uuid4().hex
    entry = Entry(base + 1, own, f"data-{own}", notes or {})
    folder = snapshot_path(path, entry)
    try:
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(folder)
        if check is not None:
            check(spark.read.parquet(folder))
        publish(spark, path, entry)
    except CommitUnknown:
        raise
    except Exception:  # an interrupt leaves the folder to ``expire``
        best_effort(fs.delete, spark, folder)
        raise
    best_effort(expire, spark, path, keep)
    return folder


def update_snapshot(
    spark: SparkSession,
    path: str,
    build: Callable[[DataFrame | None], DataFrame],
    check: Callable[[DataFrame], None] | None = None,
    tries: int = 5,
) -> str:
    """Commit ``build(newest rows or None)`` and return its folder. Where another writer has
    committed meanwhile, it is built again from that writer's rows, ``tries`` times in all."""
    for attempt in range(1, tries + 1):
        entry = latest_entry(spark, path)
        old = spark.read.parquet(snapshot_path(path, entry)) if entry else None
        try:
            return write_snapshot(build(old), path, check=check, base=entry.version if entry else 0)
        except Conflict:
            if attempt == tries:
                raise
            log.info("%s: another writer was first, attempt %d", path, attempt)
    raise AssertionError("unreachable")


def expire(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Removes versions but the newest ``keep``, and data folders that no entry names, once they
    are KEEP_SECONDS old (a younger folder may belong to a writer that has yet to commit). An
    entry goes before its folder."""
    path = path.rstrip("/")
    folders = {m.group(1): child for child in fs.list_dir(spark, path) if (m := _DATA.search(child))}
    entries = versions(spark, path)
    for entry in entries[:-keep]:
        name = f"{_log_dir(path)}/{entry.version:08d}"
        if fs.age_seconds(spark, name) > KEEP_SECONDS:
            fs.delete(spark, name)
            fs.delete(spark, snapshot_path(path, entry))
    named = {entry.folder for entry in entries}
    for name, child in folders.items():
        if name not in named and fs.age_seconds(spark, child) > KEEP_SECONDS:
            fs.delete(spark, child)
