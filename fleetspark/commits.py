"""Commits by manifest: a table is what its newest commit file names.

Data files are written under names nobody reads yet; one small JSON file then
makes them visible together. A commit file is written aside and renamed to its
number, and the rename fails where the number is taken, so of two writers one
has to look again (on a file system with atomic rename; object stores need
their own conditional put). Readers never see half a commit, and what a failed
writer left behind is named by no commit.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Files:
    """The Hadoop file system calls that tables need."""

    def __init__(self, spark: SparkSession, base: str):
        sc = spark.sparkContext
        self._jvm, self._gateway, self._conf = sc._jvm, sc._gateway, sc._jsc.hadoopConfiguration()
        self.base = base.rstrip("/")
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, folder: str = "") -> list[str]:
        """Names in a folder, none where there is no folder."""
        p = self._path(folder)
        return sorted(st.getPath().getName() for st in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def size(self, name: str) -> int:
        """Bytes of a file or folder."""
        p = self._path(name)
        return int(self._fs.getContentSummary(p).getLength()) if self._fs.exists(p) else 0

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def publish(self, name: str, target: str) -> bool:
        """Rename a file to ``target``; False if that is there already."""
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        no_options = self._gateway.new_array(getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            files.rename(self._path(name), self._path(target), no_options)
            return True
        except Exception as e:  # noqa: BLE001 - py4j wraps the Java exception
            if "FileAlreadyExistsException" in str(e):
                return False
            raise

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


class CommitLog:
    """Numbered commits of a table at ``base``."""

    FOLDER = "_commits"

    def __init__(self, spark: SparkSession, base: str):
        self.files = Files(spark, base)

    def numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names(self.FOLDER) if n.endswith(".json") and n[:-5].isdigit()]

    def name(self, number: int) -> str:
        return f"{self.FOLDER}/{number:010d}.json"

    def read(self, number: int) -> dict:
        return json.loads(self.files.read(self.name(number)))

    def newest(self) -> tuple[int, dict | None]:
        """Number and contents of the newest commit; (0, None) before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, None)

    def commit(self, number: int, contents: dict) -> bool:
        """Write commit ``number``; False if another writer was first."""
        aside = f"{self.FOLDER}/.{number:010d}-{uuid.uuid4().hex[:12]}"
        self.files.write(aside, json.dumps(contents))
        done = self.files.publish(aside, self.name(number))
        if not done:
            self.files.delete(aside)
        return done

    def forget(self, number: int) -> None:
        self.files.delete(self.name(number))


class Landing:
    """A folder that grows by whole micro-batches.

    Each commit names the data folders since the last roll-up and the commit
    that ends the ones before, so a commit stays small and a reader opens one
    commit file for every ROLL micro-batches. Nothing is renamed or copied; a
    micro-batch is visible from its commit on, whole, and once: the newest
    commit holds the last epoch of every writer."""

    ROLL = 100

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self.log = CommitLog(spark, path)

    def started(self) -> bool:
        return bool(self.log.numbers())

    def folders(self) -> list[str]:
        """The visible data folders, oldest first."""
        number, state = self.log.newest()
        out: list[str] = []
        while state is not None:
            out = state["folders"] + out
            state = self.log.read(state["rolled"]) if state["rolled"] else None
        return [f"{self.path}/{f}" for f in out]

    def add(self, write, writer: str, epoch: int, replace: bool = False) -> bool:
        """Let ``write(folder)`` write a micro-batch and make it visible; False
        if the writer's epoch is there already. With ``replace`` it takes the
        place of all before; the one before it stays for its readers."""
        folder = f"data/{uuid.uuid4().hex}"
        written = False
        while True:
            number, state = self.log.newest()
            state = state or {"folders": [], "rolled": 0, "applied": {}}
            if epoch <= state["applied"].get(writer, -1):
                if written:
                    self.log.files.delete(folder)
                return False
            if not written:
                write(f"{self.path}/{folder}")
                written = True
            applied = state["applied"] | {writer: epoch}
            if replace:
                contents = {"folders": [folder], "rolled": 0, "applied": applied, "before": state["folders"]}
            elif len(state["folders"]) >= self.ROLL:
                contents = {"folders": [folder], "rolled": number, "applied": applied}
            else:
                contents = {"folders": state["folders"] + [folder], "rolled": state["rolled"], "applied": applied}
            if self.log.commit(number + 1, contents):
                for gone in state.get("before", []) if replace else []:
                    self.log.files.delete(gone)
                return True
