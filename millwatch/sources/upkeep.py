"""Upkeep of stored tables: compaction that a killed run cannot spoil.

A folder's rows are first written anew beside the table, in a folder that readers do not see.
Only when that copy is complete is a journal written, and then folders are renamed. A run that
is killed before the journal leaves the table as it was; one that is killed after it is
finished by ``recover``, which every compaction calls first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from millwatch.operators.history import added_sums
from millwatch.sources.tables import DATE

TARGET_BYTES = 128 << 20
_STAGED, _JOURNAL, _OLD = "_staged-", "_swap-", "_old-"


class _Folder:
    """A folder on whatever file system it lies."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._at("")))

    def files(self, name: str) -> tuple[int, int]:
        """Data files of a folder and their bytes."""
        found = [s for s in self.fs.listStatus(self._at(name)) if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
        return len(found), sum(s.getLen() for s in found)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._at(name))

    def rename(self, old: str, new: str) -> None:
        if not self.fs.rename(self._at(old), self._at(new)):
            raise OSError(f"{self.path}: {old} could not be renamed to {new}")

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)

    def make(self, name: str) -> None:
        self.fs.mkdirs(self._at(name))

    def write_text(self, name: str, text: str) -> None:
        out = self.fs.create(self._at(name), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read_text(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def _swap(folder: _Folder, token: str, old: list[str], new: str) -> None:
    """Put the staged folder in the place of ``old`` ones; each step may have been done before."""
    folder.make(f"{_OLD}{token}")
    if folder.exists(f"{_STAGED}{token}"):
        for name in old:
            if folder.exists(name):
                folder.rename(name, f"{_OLD}{token}/{name}")
        folder.rename(f"{_STAGED}{token}", new)
    folder.delete(f"{_OLD}{token}")
    folder.delete(f"{_JOURNAL}{token}")


def recover(spark: SparkSession, path: str) -> int:
    """Finish swaps that were begun and remove copies that were not; returns how many swaps were finished."""
    folder, finished = _Folder(spark, path), 0
    for name in folder.names():
        if name.startswith(_JOURNAL):
            new, *old = folder.read_text(name).split("\n")
            _swap(folder, name.removeprefix(_JOURNAL), old, new)
            finished += 1
    for name in folder.names():
        if name.startswith(_STAGED):
            folder.delete(name)
    return finished


def _replace(spark: SparkSession, path: str, rows: DataFrame, old: list[str], new: str) -> None:
    folder, token = _Folder(spark, path), uuid.uuid4().hex
    rows.write.parquet(f"{path.rstrip('/')}/{_STAGED}{token}")
    # Written under another name first, so that a journal is whole or not there.
    folder.write_text(f"_new-{token}", "\n".join([new, *old]))
    folder.rename(f"_new-{token}", f"{_JOURNAL}{token}")
    _swap(folder, token, old, new)


def compact_dates(spark: SparkSession, path: str, *, target_bytes: int = TARGET_BYTES, least_files: int = 8) -> int:
    """Rewrite date folders of many small files; returns how many folders were rewritten.

    A folder gets one file per ``target_bytes``. Files hold ranges of machines and are sorted by
    machine and time, so a look-up of one machine opens one range of a heavy date.
    One run at a time per table; a writer that is appending to a date must not be running.
    """
    recover(spark, path)
    folder, done = _Folder(spark, path), 0
    for name in folder.names():
        if not name.startswith(f"{DATE}="):
            continue
        files, size = folder.files(name)
        wanted = max(1, -(-size // target_bytes))
        if files < least_files or files < 2 * wanted:
            continue
        rows = spark.read.parquet(f"{folder.path}/{name}")
        keys = [c for c in ("machine_id", "reading_ts") if c in rows.columns]
        rows = rows.coalesce(1) if wanted == 1 else rows.repartitionByRange(wanted, *keys)
        _replace(spark, path, rows.sortWithinPartitions(*keys), [name], name)
        done += 1
    return done


def compact_rollup(spark: SparkSession, path: str) -> int:
    """Add up the batch folders of ``ingest.rollup_stream`` but the newest, which a retry may overwrite.

    The sum takes the place of the newest folder it holds. Returns how many folders went.
    """
    recover(spark, path)
    batches = sorted(int(n.removeprefix("batch=")) for n in _Folder(spark, path).names() if n.startswith("batch="))[:-1]
    if len(batches) < 2:
        return 0
    names = [f"batch={b}" for b in batches]
    rows = added_sums(spark.read.parquet(*[f"{path.rstrip('/')}/{n}" for n in names]))
    _replace(spark, path, rows, names, names[-1])
    return len(names) - 1
