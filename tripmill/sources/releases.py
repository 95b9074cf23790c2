"""Releases: one small file names the runs that are the content of all tables below a folder.

A release is made at once or not at all: its file is written under a temporary name and
renamed to the next number, which fails if another run has taken that number. Then the
newest release is read again and the next number tried, so concurrent runs end in
releases one after the other, none lost. Readers take all tables from one release, so they never see
one table of a run beside another one of the run before.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field
from datetime import timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "releases"
LEASES = "leases"
ATTEMPTS = 100


class ReleaseConflict(RuntimeError):
    """Other runs took every number that was tried."""


@dataclass(frozen=True)
class Run:
    """The content of a table: a run's folder, and its columns as JSON text.

    With ``parts`` it is some partition folders only, and maybe those of other runs: the run
    that has each of them, by the folder's name.
    """

    run_id: str
    columns: str
    parts: Mapping[str, str] | None = None

    def folders(self, name: str) -> set[tuple[str, str, str | None]]:
        """What of table ``name`` belongs to it: (table, run, partition folder, or None for the whole run)."""
        if self.parts is None:
            return {(name, self.run_id, None)}
        return {(name, run_id, part) for part, run_id in self.parts.items()}


@dataclass(frozen=True)
class Release:
    """``seen`` is the last batch of each stream that the tables include, if they say so."""

    number: int
    tables: Mapping[str, Run]
    seen: Mapping[str, int] = field(default_factory=dict)


def file_system(spark: SparkSession, path: str):
    """A path and its file system, whichever that is."""
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a path."""
    found, system = file_system(spark, path)
    if not system.exists(found):
        return []
    return [status.getPath().getName() for status in system.listStatus(found)]


def delete(spark: SparkSession, path: str) -> None:
    found, system = file_system(spark, path)
    system.delete(found, True)


def read_text(spark: SparkSession, path: str) -> str:
    found, system = file_system(spark, path)
    stream = system.open(found)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    found, system = file_system(spark, path)
    stream = system.create(found, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with all of its content at once; False if there is one already."""
    folder = path.rpartition("/")[0]
    temporary = f"{folder}/.new-{uuid.uuid4().hex}"
    write_text(spark, temporary, text)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    source, system = file_system(spark, temporary)
    target, _ = file_system(spark, path)
    options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    try:
        context.rename(source, target, options)
    except Py4JJavaError as error:
        delete(spark, temporary)
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    # Where a rename may replace a file that appeared meanwhile, the last one to write has the number.
    return read_text(spark, path) == text


def release_numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n) for n in names_in(spark, f"{root.rstrip('/')}/{FOLDER}") if n.isdigit())


def read_release(spark: SparkSession, root: str, number: int) -> Release:
    found = json.loads(read_text(spark, _place(root, number)))
    return Release(number, {name: Run(**run) for name, run in found["tables"].items()}, found.get("seen", {}))


def last_release(spark: SparkSession, root: str) -> Release | None:
    numbers = release_numbers(spark, root)
    return read_release(spark, root, numbers[-1]) if numbers else None


def make_release(
    spark: SparkSession,
    root: str,
    runs: Mapping[str, Run],
    seen: Mapping[str, int] | None = None,
    after: int | None = None,
) -> Release:
    """Release the runs of some tables together; the other tables stay as the last release has them.

    ``after`` is the release that the runs were worked out from: if it is not the last one any more,
    there is no release but a ``ReleaseConflict``.
    """
    for _ in range(ATTEMPTS):
        last = last_release(spark, root)
        number = last.number + 1 if last else 1
        if after is not None and number != after + 1:
            raise ReleaseConflict(f"release {after} below {root} is not the last one any more")
        tables = {**(last.tables if last else {}), **runs}
        known = dict(seen if seen is not None else last.seen if last else {})
        content = {name: asdict(run) for name, run in tables.items()}
        text = json.dumps({"made": time.time(), "by": uuid.uuid4().hex, "tables": content, "seen": known})
        if create_if_absent(spark, _place(root, number), text):
            return Release(number, tables, known)
    raise ReleaseConflict(f"{ATTEMPTS} numbers below {root} were taken by other runs")


def drop_old(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Delete the releases before the last ``keep`` ones, and the runs that only they name.

    Runs that no release has named yet are another job's candidates and stay.
    """
    root = root.rstrip("/")
    numbers = release_numbers(spark, root)
    recent = [read_release(spark, root, n) for n in numbers[-max(1, keep) :]]
    kept = folders_of(recent)
    held = {(name, run_id) for name, run_id, _ in kept}
    gone = []
    for number in numbers[: -max(1, keep)]:
        for name, run_id, part in sorted(folders_of([read_release(spark, root, number)]) - kept, key=str):
            if (name, run_id, None) in kept:
                continue
            if (name, run_id) not in held:
                gone.append(f"{name}/run={run_id}")
            elif part is not None:
                gone.append(f"{name}/run={run_id}/{part}")
            else:  # of the whole run only some partitions are still in use
                below = [f for f in names_in(spark, f"{root}/{name}/run={run_id}") if "=" in f]
                gone += [f"{name}/run={run_id}/{f}" for f in below if (name, run_id, f) not in kept]
        for folder in set(gone):
            delete(spark, f"{root}/{folder}")
        delete(spark, _place(root, number))
    return sorted(set(gone))


def folders_of(releases: Iterable[Release]) -> set[tuple[str, str, str | None]]:
    """All folders that some release names."""
    return {f for release in releases for name, run in release.tables.items() for f in run.folders(name)}


def take_lease(spark: SparkSession, root: str, run_id: str) -> None:
    """Note that a run is at work below ``root`` now."""
    write_text(spark, f"{root.rstrip('/')}/{LEASES}/{run_id}", str(time.time()))


def drop_abandoned(spark: SparkSession, root: str, older: timedelta) -> list[str]:
    """Delete candidates that no release names and whose run took its last lease longer ago than ``older``.

    A run without a lease is left alone.
    """
    root = root.rstrip("/")
    released = [read_release(spark, root, n) for n in release_numbers(spark, root)]
    named = {run_id for _, run_id, _ in folders_of(released)}
    gone = []
    for run_id in names_in(spark, f"{root}/{LEASES}"):
        if run_id.startswith("."):
            continue
        age = time.time() - float(read_text(spark, f"{root}/{LEASES}/{run_id}"))
        if age <= older.total_seconds():
            continue
        if run_id not in named:
            for name in names_in(spark, root):
                if f"run={run_id}" in names_in(spark, f"{root}/{name}"):
                    gone.append(f"{name}/run={run_id}")
                    delete(spark, f"{root}/{gone[-1]}")
        delete(spark, f"{root}/{LEASES}/{run_id}")
    return sorted(gone)


def _place(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{FOLDER}/{number:012d}"
