"""Pages kept as a directory of crawled files, one page per file."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblode.files import Files
from weblode.functions.urls import url_from_path
from weblode.scratch import setting
from weblode.sources.publish import Publication, TableExists, publishing, settle

# Files the site-mirroring tool leaves in the root folder.
BOILERPLATE = ("backblue.gif", "fade.gif", "index.html")
# How many tasks list paths that are given one by one; Spark makes one of each path.
LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
# Notes of packing, in a folder that readers of the table pass over.
PACKED = "_packed"
COMPLETE = "complete"


def _prefix(root: str) -> str:
    """Path of the root folder with a slash at both ends."""
    local = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", "", root)
    if not local.startswith("/"):
        raise ValueError(f"root must be an absolute path or a URI: {root}")
    if re.search(r"[*?\[\]{}]", local):
        raise ValueError(f"root must be one folder, not a pattern: {root}")
    return re.sub("/+", "/", f"/{local}/")


def _below(prefix: str, file_path: Column) -> Column:
    """Path of a file relative to the root."""
    path = _plain(_decoded(file_path))
    at = F.locate(prefix, path)
    error = F.raise_error(F.concat(F.lit("file is not below the root: "), path))
    return F.when(at == 0, error).otherwise(F.substring(path, at + len(prefix), F.length(path)))


def _files(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    reader = (
        spark.read.option("recursiveFileLookup", True)
        .option("ignoreCorruptFiles", True)
        .option("ignoreMissingFiles", True)
    )
    with setting(spark, LISTERS, str(spark.sparkContext.defaultParallelism)):
        files = reader.text(folder, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("file"), "value")


def _pages(files: DataFrame, prefix: str) -> DataFrame:
    return files.select(_pages_of(files, prefix).alias("page")).where("page IS NOT NULL").select("page.url", "page.html")


def _pages_of(files: DataFrame, prefix: str) -> Column:
    """The page in a file, null if it is boilerplate or has no URL."""
    path = _below(prefix, F.col("file"))
    url = url_from_path(path)
    page = F.struct(F.lit("page").alias("kind"), url.alias("url"), F.make_valid_utf8("value").alias("html"))
    return F.when(~path.isin(*BOILERPLATE) & (url != ""), page)


def _decoded(file_path: Column) -> Column:
    """File paths of read files come percent-encoded, those of listings do not."""
    return F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))


def _plain(path: Column) -> Column:
    """A path without its scheme, to compare with others."""
    return F.regexp_replace(path, r"\A[a-zA-Z][a-zA-Z0-9+.-]*:/*", "/")


def read_crawl(spark: SparkSession, root: str) -> DataFrame:
    """``(url, html)`` from all files below the folder ``root``.

    Bytes are read as UTF-8 whatever the page declares. Corrupt and vanished
    files are skipped (``skipped_files`` names them); being denied access fails
    the job. Files without a dotted path segment have no URL and are dropped.
    The driver lists all files: ``pack_crawl`` goes folder by folder instead.
    """
    prefix = _prefix(root)
    return _pages(_files(spark, root), prefix)


def skipped_files(spark: SparkSession, root: str) -> DataFrame:
    """``(file)``: the files below ``root`` that ``read_crawl`` cannot read.
    Reads everything once more; packing notes them as it goes, see ``skipped_in``."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        .select(_plain(F.col("path")).alias("file"))
    )
    readable = _files(spark, root).select(_plain(_decoded(F.col("file"))).alias("file"))
    return listed.join(readable, "file", "left_anti")


class _Slices:
    """Work of packing: lists of paths that hold about ``files`` files or
    ``folders`` folders at most, so that the driver never lists more at once.
    A folder with more files than that is gone into; files that lie loose in it
    count as files only."""

    def __init__(self, spark: SparkSession, folders: int, files: int):
        self.spark, self.folders, self.most = spark, folders, files

    def _items(self, folder: str) -> Iterator[tuple[str, int, bool]]:
        """(path, files below it, is a folder): whole folders where they are small enough."""
        system = Files(self.spark, folder)
        loose = []
        for name, is_folder in sorted(system.names(folder)):
            path = f"{folder}/{name}"
            if not is_folder:
                loose.append(path)
            elif (n := system.count(path)) <= self.most:
                yield path, n, True
            else:
                yield from self._items(path)
        yield from ((path, 1, False) for path in loose)

    def of(self, folder: str, done: set[str]) -> Iterator[list[str]]:
        held, size, folders = [], 0, 0
        for path, n, is_folder in self._items(folder):
            if path in done:
                continue
            if held and (folders + is_folder > self.folders or size + n > self.most):
                yield held
                held, size, folders = [], 0, 0
            held.append(path)
            size, folders = size + n, folders + is_folder
        if held:
            yield held


def _pattern(path: str) -> str:
    """Reading takes paths for patterns, so what has a meaning there is escaped."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _pack_slice(spark: SparkSession, prefix: str, paths: list[str], publication: Publication, name: str) -> None:
    """Add the pages of one slice. One scan writes two kinds of rows: pages,
    and the paths of all files that could be read; what is listed but not
    among them was skipped. Usually that is none, as their number tells; empty
    files give no row and are no pages, so with some of them it takes a look."""
    names = [_pattern(p) for p in paths]
    files = _files(spark, names)
    page, path = _pages_of(files, prefix), F.struct(F.lit("read").alias("kind"), F.col("file").alias("url"), F.lit(None).cast("string").alias("html"))
    rows = files.select(F.explode(F.array_compact(F.array(page, path))).alias("row")).select("row.*")
    rows.write.partitionBy("kind").parquet(publication.staging("slice"))
    publication.put_files("slice/kind=page", name)
    both = spark.read.schema("url string, html string, kind string").parquet(publication.staging("slice"))
    read = both.where("kind = 'read'").select(_plain(_decoded(F.col("url"))).alias("file"))
    if read.count() < len(files.inputFiles()):
        with setting(spark, LISTERS, str(spark.sparkContext.defaultParallelism)):
            listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(names)
        listed = listed.where("length > 0").select(_plain(F.col("path")).alias("file"))
        listed.join(read, "file", "left_anti").write.parquet(publication.staging("skipped"))
        publication.put_files("skipped", f"{name}/{PACKED}/skipped")
    publication.put_text(f"{name}/{PACKED}/{uuid4().hex}.json", json.dumps(paths))


def pack_crawl(spark: SparkSession, root: str, out: str, folders: int = 1000, files: int = 100_000) -> None:
    """Write the pages below ``root`` as a parquet table ``(url, html)``.

    The crawl is taken in slices of at most ``folders`` folders with about
    ``files`` files, loose ones among them; a host with more is cut too. A slice is put into
    the table together with a note of what it holds, so if packing breaks off,
    calling it again does what is left. Files that could not be read are noted
    as well, see ``skipped_in``. A table that is complete is not written again.
    """
    prefix, system = _prefix(root), Files(spark, out)
    parent, _, name = out.rstrip("/").rpartition("/")
    settle(spark, parent)
    notes = f"{out}/{PACKED}"
    if system.exists(f"{notes}/{COMPLETE}") or (system.exists(out) and not system.exists(notes)):
        raise TableExists(f"{out} is there already")
    done: set[str] = set()
    if system.exists(notes):
        for note, _ in system.names(notes):
            if note.endswith(".json"):
                done.update(json.loads(system.read(spark, f"{notes}/{note}")))
    else:
        with publishing(spark, parent) as publication:
            spark.createDataFrame([], "url string, html string").write.parquet(publication.staging("none"))
            publication.put_files("none", name)
            spark.createDataFrame([], "file string").write.parquet(publication.staging("skipped"))
            publication.put_files("skipped", f"{name}/{PACKED}/skipped")
    top = Files(spark, root).uri(root)
    for paths in _Slices(spark, folders, files).of(top, done):
        with publishing(spark, parent) as publication:
            _pack_slice(spark, prefix, paths, publication, name)
    with publishing(spark, parent) as publication:
        publication.put_text(f"{name}/{PACKED}/{COMPLETE}", "")


def skipped_in(spark: SparkSession, out: str) -> DataFrame:
    """``(file)``: the files that ``pack_crawl`` could not read, as it noted them."""
    return spark.read.schema("file string").parquet(f"{out}/{PACKED}/skipped")
