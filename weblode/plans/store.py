"""The three keyed tables that searches run on.

============ ==================================
websites     ``(website_id, url)``
inv_index    ``(word, website_id, count)``
page_rank    ``(website_id, value)``
============ ==================================

A store with ranks and words on very many pages has a fourth, ``best``: the first
``BEST_ROWS`` pages of each such word, in order, ``(word, n, website_id, pagerank,
score)``. Ids that are not computed from the URL are kept in ``own_ids`` too.

On disk each table is split into bucket folders by a hash of its lookup key and
sorted by that key inside, so a lookup opens one bucket and, by row group
statistics, little of it. Buckets are sized from row counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from weblode.functions.text import is_store_word
from weblode.functions.urls import bucket_of, website_id
from weblode.operators.ranking import first_rows
from weblode.operators.scoring import best_first, score, scored
from weblode.operators.skew import MAX_BROADCAST_KEYS
from weblode.scratch import scope, stage
from weblode.sources.keyed import check_new, check_unique, create_table, merged_parts, put_parts
from weblode.sources.publish import Publication, publishing, settle

# Schemas on disk, stated because an empty bucketed table holds no file.
SCHEMAS = {
    "websites": "website_id string, url string, bucket int",
    "inv_index": "word string, website_id string, count bigint, bucket int",
    "page_rank": "website_id string, value double, bucket int",
    "best": "word string, n bigint, website_id string, pagerank double, score double, bucket int",
}
# The columns of each table that name a row; the first one gives the bucket.
KEYS = {
    "websites": ["website_id"],
    "inv_index": ["word", "website_id"],
    "page_rank": ["website_id"],
    "best": ["word", "n"],
}
ROWS_PER_BUCKET = 50_000_000
MIN_ROWS_PER_BUCKET = 50_000
MAX_BUCKETS = 4096
# A word with more postings than this is heavy: its best pages are stored in order,
# so that a search for them reads those and not all postings and ranks.
HEAVY_POSTINGS = 100_000
BEST_ROWS = 1_000
# Only words on more pages than this are picked from in parts first: one task
# can sort the pages of any other.
SPREAD_POSTINGS = 100_000
# Rows of one file, so that no task writes, and no lookup opens, a huge one.
MAX_RECORDS_PER_FILE = 10_000_000


class Store(NamedTuple):
    """Bucket counts are zero for tables that are not laid out in buckets;
    otherwise the tables have an extra column ``bucket``."""

    websites: DataFrame
    inv_index: DataFrame
    page_rank: DataFrame
    word_buckets: int = 0
    id_buckets: int = 0
    best: DataFrame | None = None


def indexed_websites(postings: DataFrame) -> DataFrame:
    """Distinct URLs of the postings that a store takes."""
    return postings.where(is_store_word(F.col("word"))).select("url").distinct()


def website_ids(urls: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``(website_id, url)`` for distinct ``urls(url)``. URLs in ``known``
    keep the id they have, whatever it is; all others get the id computed from
    the URL, so that repeated loads agree."""
    if known is None:
        return urls.select(website_id(F.col("url")).alias("website_id"), "url")
    new_id = F.coalesce("website_id", website_id(F.col("url")))
    return urls.join(known, "url", "left").select(new_id.alias("website_id"), "url")


def stored_words(postings: DataFrame) -> DataFrame:
    """The postings that a store takes."""
    return postings.where(is_store_word(F.col("word")))


def store_postings(postings: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``inv_index``: valid words with the id of the page. Computed ids need
    no join at all."""
    valid = stored_words(postings)
    if known is not None:
        valid = valid.join(known, "url", "left")
        page_id = F.coalesce("website_id", website_id(F.col("url")))
    else:
        page_id = website_id(F.col("url"))
    return valid.select("word", page_id.alias("website_id"), "count")


def store_ranks(ranks: DataFrame, websites: DataFrame) -> DataFrame:
    """``page_rank`` of stored websites; other ranks are dropped."""
    joined = ranks.join(websites, "url")
    return joined.select("website_id", F.col("rank").alias("value"))


def build_store(
    postings: DataFrame,
    ranks: DataFrame,
    urls: DataFrame | None = None,
    known: DataFrame | None = None,
) -> Store:
    """Tables from ``postings(word, url, count)`` and ``ranks(url, rank)``.

    ``urls(url)``, if given, lists the distinct URLs in ``postings`` and saves
    looking for them in the much larger ``postings``. ``known(website_id,
    url)`` are websites stored before.
    """
    websites = website_ids(indexed_websites(postings) if urls is None else urls, known)
    return Store(websites, store_postings(postings, known), store_ranks(ranks, websites))


def _buckets(df: DataFrame) -> int:
    """Enough buckets for their size to stay bounded, and for all cores to
    share the work on a small table."""
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    by_size, by_cores = -(-rows // ROWS_PER_BUCKET), min(cores, rows // MIN_ROWS_PER_BUCKET)
    return max(1, min(MAX_BUCKETS, max(by_size, by_cores)))


def _layout(spark: SparkSession, path: str) -> Row:
    return spark.read.parquet(f"{path}/layout").first()


def _read(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{path}/{table}")


def _bucketed(df: DataFrame, table: str, buckets: int) -> DataFrame:
    return df.withColumn("bucket", bucket_of(F.col(KEYS[table][0]), buckets))


def _write(df: DataFrame, table: str, buckets: int, publication: Publication, mode: str) -> DataFrame:
    """Adaptive execution splits a bucket that is too large for one task, such
    as that of a word on every page, and joins small ones. Postings are sorted by
    word only, which lookups go by. Those that have the URL and no id yet get the
    computed one, which is shuffled as 16 bytes. Returns a scan of what was written."""
    keys = ["bucket", *KEYS[table]]
    order = keys[:2] if table == "inv_index" else keys
    compute = "website_id" in KEYS[table] and "website_id" not in df.columns
    if compute:
        df = df.select("word", F.unhex(website_id(F.col("url"))).alias("website_id"), "count")
    balanced = _bucketed(df, table, buckets).hint("rebalance", F.col("bucket")).sortWithinPartitions(*order)
    if compute:
        balanced = balanced.withColumn("website_id", F.lower(F.hex("website_id")))
    path = publication.place(table, mode)
    create_table(
        balanced, path, keys, MAX_RECORDS_PER_FILE,
        partition_by=["bucket"], checked=True,
    )
    return df.sparkSession.read.schema(SCHEMAS[table]).parquet(path)


def check_append(spark: SparkSession, path: str, **tables: DataFrame | None) -> None:
    """Fail if a row of ``inv_index`` or ``page_rank`` has a key that is stored
    already. Nothing is written before all checks have passed."""
    layout = _layout(spark, path)
    for table, rows in tables.items():
        if rows is not None and (table != "page_rank" or has_ranks(spark, path)):
            buckets = layout["word_buckets" if table == "inv_index" else "id_buckets"]
            check_new(_bucketed(rows, table, buckets), _read(spark, path, table), ["bucket", *KEYS[table]])


class _Changes:
    """What is written to a store in one go, on top of what it has."""

    def __init__(self, spark: SparkSession, path: str, publication: Publication, mode: str):
        self.spark, self.path, self.publication, self.mode = spark, path, publication, mode
        self.written: dict[str, DataFrame] = {}
        self.buckets: Row | None = None
        self.by_url: tuple[DataFrame, DataFrame] | None = None

    def layout(self) -> Row:
        return self.buckets or _layout(self.spark, self.path)

    def table(self, name: str) -> DataFrame | None:
        """A table as it will be, or ``None`` if there will be none."""
        new = self.written.get(name)
        if new is not None and self.mode != "append":
            return new
        if not exists(self.spark, f"{self.path}/{name}"):
            return new
        stored = _read(self.spark, self.path, name)
        return stored if new is None else stored.unionByName(new)

    def put_index(
        self, websites: DataFrame, inv_index: DataFrame, word_buckets: int | None = None, id_buckets: int | None = None,
    ) -> None:
        websites = stage(websites)  # read several times
        if self.mode == "append":
            word_buckets, id_buckets = self.layout()
            websites = websites.join(self._stored(websites), "website_id", "left_anti")
        else:
            word_buckets = word_buckets or _buckets(inv_index)
            id_buckets = id_buckets or _buckets(websites)
        self.written["websites"] = _write(websites, "websites", id_buckets, self.publication, self.mode)
        self.written["inv_index"] = _write(inv_index, "inv_index", word_buckets, self.publication, self.mode)
        self._put_own_ids()
        self.buckets = Row(word_buckets=word_buckets, id_buckets=id_buckets)
        if self.mode != "append":
            layout = self.spark.range(1).select(
                F.lit(word_buckets).alias("word_buckets"), F.lit(id_buckets).alias("id_buckets"))
            layout.write.parquet(self.publication.place("layout", self.mode))

    def _stored(self, ids: DataFrame) -> DataFrame:
        """Those of some website ids that are stored. Only their buckets are
        read; of those there are ``MAX_BUCKETS`` at most."""
        wanted = _bucketed(ids, "websites", self.layout()["id_buckets"]).select("bucket", "website_id")
        buckets = [row["bucket"] for row in wanted.select("bucket").distinct().collect()]
        stored = _read(self.spark, self.path, "websites").where(F.col("bucket").isin(buckets))
        return stored.join(wanted, ["bucket", "website_id"], "left_semi").select("website_id")

    def ranks_of_known(self, ranks: DataFrame, own: DataFrame | None) -> DataFrame:
        """``page_rank`` of the websites that are stored or come along, looked
        up by id and not by URL in all websites."""
        rows = website_ids(ranks.select("url"), own).join(ranks, "url")
        rows = stage(rows.select("website_id", F.col("rank").alias("value")))
        known = self._stored(rows)
        if "websites" in self.written:
            known = known.unionByName(self.written["websites"].select("website_id"))
        return rows.join(known, "website_id", "left_semi")

    def _put_own_ids(self) -> None:
        """Websites whose id is not computed, if there are any, once more in a
        table of their own: later loads look ids up there, not in all websites."""
        own = own_ids(self.written["websites"].drop("bucket"))
        if own is not None:
            own.write.parquet(self.publication.place("own_ids", self.mode))
        elif self.mode == "overwrite" and exists(self.spark, f"{self.path}/own_ids"):
            self.spark.createDataFrame([], own_ids_schema()).write.parquet(self.publication.place("own_ids", self.mode))

    def put_ranks(self, page_rank: DataFrame) -> None:
        self.written["page_rank"] = _write(page_rank, "page_rank", self.layout()["id_buckets"], self.publication, self.mode)

    def merge_ranks(self, page_rank: DataFrame) -> None:
        """Set ranks: only buckets with one of them are written again."""
        rows = stage(_bucketed(page_rank, "page_rank", self.layout()["id_buckets"]))
        stored = _read(self.spark, self.path, "page_rank")
        put_parts(merged_parts(rows, stored, KEYS["page_rank"]), self.publication, "page_rank", KEYS["page_rank"], MAX_RECORDS_PER_FILE)
        self.written["page_rank"] = stored.join(rows, ["bucket", "website_id"], "left_anti").unionByName(
            rows.select(*stored.columns))

    def from_urls(self, postings: DataFrame, ranks: DataFrame) -> None:
        """What the written index and ranks were made from, with computed ids:
        ``postings(word, url, count)`` and ``ranks(url, rank)``."""
        self.by_url = postings, ranks

    def _best_by_url(self, heavy_postings: int) -> DataFrame:
        """``best_rows`` with postings and ranks joined by URL, of which rows are
        shuffled in a third of the bytes that they take with the written ids."""
        postings, ranks = self.by_url
        ranks = ranks.join(self.written["websites"].select("url"), "url").select("url", F.col("rank").alias("value"))
        counted = _counted_words(self.written["inv_index"].drop("bucket"), heavy_postings)
        return _best_of(postings, counted, lambda hits: scored_by_url(hits, ranks))

    def put_best(self, heavy_postings: int) -> None:
        """Renew the best pages of heavy words: after any change of postings or
        ranks, from the tables as they will be."""
        websites, page_rank = self.table("websites"), self.table("page_rank")
        stored = exists(self.spark, f"{self.path}/best")
        # a word has one posting per website at most
        few = websites.limit(heavy_postings + 1).count() <= heavy_postings
        if page_rank is None or few:
            if stored:
                none = self.spark.createDataFrame([], SCHEMAS["best"])
                none.write.partitionBy("bucket").parquet(self.publication.place("best", "overwrite"))
            return
        word_buckets, id_buckets = self.layout()
        if self.by_url:
            rows = self._best_by_url(heavy_postings)
        else:
            rows = best_rows(self.table("inv_index"), page_rank, heavy_postings, id_buckets)
        mode = "overwrite" if stored else "errorifexists"
        _write(rows, "best", word_buckets, self.publication, mode)


@contextmanager
def changing(
    spark: SparkSession, path: str, mode: str = "errorifexists", heavy_postings: int = HEAVY_POSTINGS
) -> Iterator[_Changes]:
    """Tables put into a store inside of it are found there together at the end,
    or not at all."""
    with scope(spark), publishing(spark, path) as publication:
        changes = _Changes(spark, path, publication, mode)
        yield changes
        if changes.written:
            changes.put_best(heavy_postings)


def write_index(
    websites: DataFrame,
    inv_index: DataFrame,
    path: str,
    mode: str = "errorifexists",
    word_buckets: int | None = None,
    id_buckets: int | None = None,
    checked: bool = False,
    heavy_postings: int = HEAVY_POSTINGS,
) -> None:
    """Write ``websites`` and ``inv_index``, both or none. Mode
    ``append`` adds to a stored index and fails, before it writes, if that has
    one of the postings already (``checked``: the caller has seen to it);
    websites that are stored already are left as they are."""
    spark = inv_index.sparkSession
    with changing(spark, path, mode, heavy_postings) as changes:
        if mode == "append" and not checked:
            check_append(spark, path, inv_index=inv_index)
        changes.put_index(websites, inv_index, word_buckets, id_buckets)


def write_ranks(
    page_rank: DataFrame, path: str, mode: str = "errorifexists", checked: bool = False,
    heavy_postings: int = HEAVY_POSTINGS,
) -> None:
    """Write ``page_rank`` next to a stored index."""
    spark = page_rank.sparkSession
    with changing(spark, path, mode, heavy_postings) as changes:
        if mode == "append" and not checked:
            check_append(spark, path, page_rank=page_rank)
        changes.put_ranks(page_rank)


def merge_ranks(page_rank: DataFrame, path: str, heavy_postings: int = HEAVY_POSTINGS) -> None:
    """Set ranks in a store that has some: known pages get the new one, others
    are added. The files of buckets without a changed rank stay as they are."""
    spark = page_rank.sparkSession
    with changing(spark, path, "overwrite", heavy_postings) as changes:
        check_unique(page_rank, KEYS["page_rank"])
        changes.merge_ranks(page_rank)


def write_store(store: Store, path: str, mode: str = "errorifexists", heavy_postings: int = HEAVY_POSTINGS) -> None:
    with changing(store.inv_index.sparkSession, path, mode, heavy_postings) as changes:
        changes.put_index(store.websites, store.inv_index)
        changes.put_ranks(store.page_rank)


def heavy_words(inv_index: DataFrame, heavy_postings: int) -> DataFrame:
    """Words with more postings than that."""
    counts = _counted_words(inv_index, heavy_postings)
    return counts.drop("postings")


def _counted_words(inv_index: DataFrame, heavy_postings: int) -> DataFrame:
    keys = [c for c in ("bucket", "word") if c in inv_index.columns]
    counts = inv_index.groupBy(*keys).agg(F.count("*").alias("postings"))
    return counts.where(F.col("postings") > heavy_postings)


def best_rows(
    inv_index: DataFrame, page_rank: DataFrame, heavy_postings: int = HEAVY_POSTINGS, id_buckets: int = 0
) -> DataFrame:
    """``(word, n, website_id, pagerank, score)``: the first pages of heavy words."""
    def with_scores(hits: DataFrame) -> DataFrame:
        hits = hits.select("word", "website_id", "count")
        if id_buckets:
            hits = hits.withColumn("bucket", bucket_of(F.col("website_id"), id_buckets))
        return scored(hits, page_rank)

    return _best_of(inv_index, _counted_words(inv_index, heavy_postings), with_scores)


def scored_by_url(hits: DataFrame, ranks: DataFrame) -> DataFrame:
    """``scored`` for ``hits(word, url, count)`` and ``ranks(url, value)``."""
    ranked = hits.join(ranks, "url", "left")
    return ranked.select("word", website_id(F.col("url")).alias("website_id"), F.col("value").alias("pagerank"),
                         score(F.col("value"), F.col("count")).alias("score"))


def _best_of(postings: DataFrame, counted: DataFrame, with_scores: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The first pages of the ``counted`` words. What the tasks keep of a word is
    sorted in parts before it comes together only for words that are too much for
    one task."""
    counted, found = stage(counted), []
    many = F.col("postings") > SPREAD_POSTINGS
    sizes = counted.agg(F.count_if(~many), F.count_if(many)).first()
    for n_words, own, spread_by in ((sizes[0], ~many, None), (sizes[1], many, "website_id")):
        if not n_words and (found or spread_by is None):
            continue
        words = counted.where(own).drop("postings")
        if n_words <= MAX_BROADCAST_KEYS:
            words = F.broadcast(words)
        rows = first_rows(with_scores(postings.join(words, words.columns)), ["word"], best_first(), BEST_ROWS, spread_by)
        found.append(rows.select("word", F.col("n").cast("bigint").alias("n"), "website_id", "pagerank", "score"))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def read_websites(spark: SparkSession, path: str) -> DataFrame:
    """Websites stored before, to keep their ids."""
    return _read(spark, path, "websites").select("website_id", "url")


def own_ids(websites: DataFrame) -> DataFrame | None:
    """The websites whose id is not the computed one; ``None`` if there are
    none, which saves a join of all postings with all websites."""
    own = websites.where(F.col("website_id") != website_id(F.col("url")))
    return None if own.isEmpty() else own


def own_ids_schema() -> str:
    return "website_id string, url string"


def stored_own_ids(spark: SparkSession, path: str) -> DataFrame | None:
    """``own_ids`` of a store, from the small table that holds nothing else."""
    if not exists(spark, f"{path}/own_ids"):
        return None
    own = spark.read.schema(own_ids_schema()).parquet(f"{path}/own_ids")
    return None if own.isEmpty() else own


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def has_ranks(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/page_rank")


def read_store(spark: SparkSession, path: str) -> Store:
    """The stored tables; without ranks, as long as none are loaded, the table
    of ranks is empty and every page comes without one."""
    settle(spark, path)
    ranks = (
        _read(spark, path, "page_rank") if has_ranks(spark, path)
        else spark.createDataFrame([], SCHEMAS["page_rank"])
    )
    best = _read(spark, path, "best") if exists(spark, f"{path}/best") else None
    tables = (_read(spark, path, "websites"), _read(spark, path, "inv_index"), ranks)
    return Store(*tables, *_layout(spark, path), best)
