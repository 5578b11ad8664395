"""Tables below one folder that change together, or not at all.

New tables and files are written to a staging folder beside the old ones. When
all are there, a journal of the moves that put them in place is put into the
folder under a fixed name, by one rename: that is the moment of the change. The
moves come after it; whoever finds a journal whose writer is gone makes the rest of
them, so a run that breaks off has either changed nothing or everything. Plain
readers of a path see the usual layout whenever no journal is there.

Renames have to be atomic, as they are on HDFS and local disks.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any
from uuid import uuid4

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from weblode.files import Files
from weblode.scratch import tidy

JOURNAL = "_journal"
#: A journal of this age has been left by its writer.
GRACE_SECONDS = 60.0


class TableExists(PySparkException, FileExistsError):
    """What is to be created is there already."""

    def __init__(self, message: str):
        PySparkException.__init__(self, message=message)


def _finish(files: Files, root: str, journal: dict[str, Any]) -> None:
    """Make the moves that are left. What a move replaces is kept in the staging
    folder until the end."""
    folder = f"{root}/{journal['folder']}"
    for k, (source, target) in enumerate(journal["moves"]):
        staged, place, old = f"{folder}/{source}", f"{root}/{target}", f"{folder}/_replaced/{k}"
        if not files.exists(staged):
            continue
        if files.exists(place) and not files.exists(old):
            files.rename(place, old)
        if not files.rename(staged, place) and files.exists(staged):
            raise OSError(f"cannot move {staged} to {place}")
    files.delete(f"{root}/{JOURNAL}")
    files.delete(folder)


def settle(spark: SparkSession, root: str) -> None:
    """Before reading or writing: wait for a writer that is making its moves, or
    make them if it is gone."""
    files, journal = Files(spark, root), f"{root}/{JOURNAL}"
    while files.exists(journal):
        if files.age(journal) >= GRACE_SECONDS:
            _finish(files, root, json.loads(files.read(spark, journal)))
        else:
            time.sleep(0.2)


class Publication:
    """New content of the folder ``root``; see ``publishing``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root, Files(spark, root)
        self.folder = f"_staged-{uuid4().hex}"
        self.created: list[str] = []
        self.replaced: list[str] = []
        self.added: list[str] = []
        self.parts: list[str] = []
        self.moves: list[tuple[str, str]] = []
        self.done = False

    def _check_new(self) -> None:
        taken = [name for name in self.created if self.files.exists(f"{self.root}/{name}")]
        if taken:
            raise TableExists(f"{', '.join(taken)} in {self.root}: there already")

    def place(self, name: str, mode: str = "errorifexists") -> str:
        """Where to write the table ``name``: as a new one, in place of an old
        one (``overwrite``), as files to be added to it (``append``), or as folders
        that replace its folders of the same names (``parts``)."""
        kinds = {"errorifexists": self.created, "overwrite": self.replaced, "append": self.added, "parts": self.parts}
        kinds[mode].append(name)
        self._check_new()
        return self.staging(name)

    def put_files(self, source: str, target: str) -> None:
        """Add the files below a folder of the staging folder, written by the
        caller at ``staging(source)``, to the folder ``target``."""
        if self.files.exists(self.staging(source)):
            self.moves += [(f"{source}/{f}", f"{target}/{f}") for f in self._files_below(self.staging(source))]

    def put_text(self, name: str, text: str) -> None:
        """Add a small file."""
        source = f"_texts/{len(self.moves)}"
        self.files.write(self.staging(source), text)
        self.moves.append((source, name))

    def staging(self, name: str) -> str:
        return f"{self.root}/{self.folder}/{name}"

    def _files_below(self, path: str, below: str = "") -> Iterator[str]:
        for name, is_folder in self.files.names(f"{path}/{below}"):
            if is_folder:
                yield from self._files_below(path, f"{below}{name}/")
            elif not name.startswith((".", "_")):
                yield below + name

    def commit(self) -> None:
        for name in self.added:
            self.put_files(name, name)
        for name in self.parts:
            folders = [n for n, is_folder in self.files.names(self.staging(name)) if is_folder]
            self.moves += [(f"{name}/{n}", f"{name}/{n}") for n in folders]
        moves = [(name, name) for name in self.created + self.replaced] + self.moves
        journal = {"folder": self.folder, "moves": moves}
        draft = self.staging(JOURNAL)
        self.files.write(draft, json.dumps(journal))
        settle(self.spark, self.root)
        self._check_new()
        if self.files.exists(f"{self.root}/{JOURNAL}") or not self.files.rename(draft, f"{self.root}/{JOURNAL}"):
            raise TableExists(f"another writer is changing {self.root}")
        self.done = True
        _finish(self.files, self.root, journal)

    def drop(self) -> None:
        self.files.delete(f"{self.root}/{self.folder}")


@contextmanager
def publishing(spark: SparkSession, root: str) -> Iterator[Publication]:
    """Tables written to the places it gives change ``root`` all at once when
    the block ends; an error in it changes nothing."""
    settle(spark, root)
    publication = Publication(spark, root)
    try:
        yield publication
        if publication.created or publication.replaced or publication.added or publication.parts or publication.moves:
            publication.commit()
    except BaseException:
        if not publication.done:  # else the next reader finishes it
            publication.drop()
        raise


def as_new(df: DataFrame, publication: Publication, name: str, mode: str) -> DataFrame:
    """Write a plain parquet table into a publication and return a scan of it."""
    path = publication.place(name, mode)
    with tidy(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
