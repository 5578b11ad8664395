"""Word search: rank plus a capped term count, best pages first.

Pages of equal score are ordered by website id, as a keyed store returns them.
That lets the cut to the top rows come before the join that adds their URLs.
Rows carry their ``position`` from 1, whatever the limit.

How many rows a search reads follows from its limit: the best pages of heavy
words are stored in order, and of other words there are few postings. Only
limits above ``BEST_ROWS`` read, rank and number all pages of a heavy word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weblode.functions.limits import DEFAULT_LIMIT, resolve_limit, resolve_limits
from weblode.functions.urls import bucket_of
from weblode.operators.ranking import first_rows, row_numbers
from weblode.operators.skew import MAX_BROADCAST_KEYS
from weblode.operators.scoring import best_first
from weblode.operators.scoring import scored as _scored
from weblode.plans.store import BEST_ROWS, HEAVY_POSTINGS, Store, heavy_words
from weblode.scratch import stage

# Largest table of hits or results that is broadcast; 100,000 ids take 8 MB.
MAX_BROADCAST_ROWS = 100_000
# Up to so many rows are picked by one task from the best of every task;
# more are numbered range by range. The rows are the same.
MAX_PICKED_ROWS = 1_000


def word_postings(store: Store, word: Column) -> DataFrame:
    """``(website_id, count)`` of one word. A stored index is read in the
    word's bucket only."""
    index = store.inv_index
    if store.word_buckets:
        index = index.where(F.col("bucket") == bucket_of(word, store.word_buckets))
    return index.where(F.col("word") == word).select("website_id", "count")


def _placed(rows: DataFrame, store: Store) -> DataFrame:
    """Rows with the storage bucket of their website, if the store has any, so
    that joins by website read and join bucket by bucket."""
    if not store.id_buckets:
        return rows
    return rows.withColumn("bucket", bucket_of(F.col("website_id"), store.id_buckets))


def _hits(store: Store, word: Column) -> tuple[DataFrame, Store]:
    """The hits of one word, and the store with ranks cut to them. Looking up a
    word in a stored index is cheap, so its hits are counted, and if they are
    few the ranks are filtered in place instead of shuffled."""
    hits = _placed(word_postings(store, word), store)
    if not store.word_buckets or hits.count() > MAX_BROADCAST_ROWS:
        return hits, store
    keys = [c for c in hits.columns if c != "count"]
    near = store.page_rank.join(F.broadcast(hits.select(*keys)), keys, "left_semi")
    return hits, store._replace(page_rank=near)


def _best(store: Store, word: Column, n_rows: int | None) -> DataFrame | None:
    """The first pages of a heavy word as they are stored, ``None`` if they are
    not, or not so many. The filters on word and number reach the scan of one
    bucket, which is sorted by them."""
    if store.best is None or n_rows is None or n_rows > BEST_ROWS:
        return None
    of_word = store.best.where((F.col("bucket") == bucket_of(word, store.word_buckets)) & (F.col("word") == word))
    if of_word.where("n = 1").isEmpty():
        return None
    return of_word.where(F.col("n") <= n_rows).select("website_id", "pagerank", "score", "n")


def _with_url(rows: DataFrame, store: Store, few: bool) -> DataFrame:
    """Add ``url``, null if the website is not stored. The websites of a ``few``
    rows are filtered in place before the join."""
    rows = _placed(rows, store)
    keys, websites = [c for c in ("bucket", "website_id") if c in rows.columns], store.websites
    if few:
        websites = websites.join(F.broadcast(rows.select(*keys)), keys, "left_semi")
    return rows.join(websites, keys, "left")


def search(
    store: Store, word: str | None, limit: int | float | str | None = DEFAULT_LIMIT
) -> DataFrame:
    """``(position, url, pagerank)`` of the best pages for one word, in order."""
    n_rows = resolve_limit(limit)
    if word is None:
        n_rows = 0
    top = _best(store, F.lower(F.lit(word or "")), n_rows)
    if top is None:
        hits, cut = _hits(store, F.lower(F.lit(word or "")))
        rows = _scored(hits, cut.page_rank)
        if n_rows is not None and n_rows <= MAX_PICKED_ROWS:
            top = rows.orderBy(*best_first()).limit(n_rows)
            top = top.withColumn("n", F.row_number().over(Window.orderBy(*best_first())))
        else:
            top = row_numbers(rows, [], best_first())
            if n_rows is not None:
                top = top.where(F.col("n") <= n_rows)
    few = n_rows is not None and n_rows <= MAX_BROADCAST_ROWS
    found = _with_url(top, store, few).orderBy("n")
    return found.select(F.col("n").cast("bigint").alias("position"), "url", "pagerank")


def search_json(
    store: Store, word: str | None, limit: int | float | str | None = DEFAULT_LIMIT
) -> DataFrame:
    """``(position, json)``: lines that, in order, are one JSON document
    ``{"results": [{"url": …, "pagerank": …}, …]}``, whatever the limit.

    The first line opens the document, each further one holds a page, the last
    one closes it, so ``write.text`` of the ``json`` column gives the document
    however long it is.
    """
    found = stage(search(store, word, limit))
    page = F.to_json(F.struct("url", "pagerank"))
    pages = found.select(
        "position", F.when(F.col("position") == 1, page).otherwise(F.concat(F.lit(","), page)).alias("json")
    )
    line = lambda position, text: (position.cast("bigint").alias("position"), F.lit(text).alias("json"))
    begin = found.sparkSession.range(1).select(*line(F.lit(0), '{"results":['))
    end = found.agg(F.count("*").alias("n")).select(*line(F.col("n") + 1, "]}"))
    return begin.unionByName(pages).unionByName(end).orderBy("position")


def _bucketed_words(words: DataFrame, store: Store) -> DataFrame:
    return words.withColumn("bucket", bucket_of(F.col("word"), store.word_buckets)) if store.word_buckets else words


def _word_hits(store: Store, words: DataFrame, with_url: bool = False) -> DataFrame:
    """Scored hits of ``words(word, most)``. With their ``url`` ranks and websites
    are brought together first, which have a row per page: all hits are then
    shuffled once for both."""
    keys = [c for c in ("bucket", "word") if c in words.columns]
    hits = _placed(store.inv_index.join(words, keys).drop("bucket"), store)
    if not with_url:
        return _scored(hits, store.page_rank)
    site = [c for c in ("bucket", "website_id") if c in hits.columns]
    return _scored(hits, store.page_rank.join(store.websites, site, "full"), "url")


def _numbered_words(store: Store, words: DataFrame, heavy_postings: int) -> list[DataFrame]:
    """``(word, n, url, pagerank, score)`` with the first ``most`` pages
    of ``words(word, most)``, all of them where that is null.

    The words are told apart by how many pages they are on and how many are
    asked for, and each kind that occurs is read by itself: a word with few
    pages is numbered by one task, after every task has kept no more of it
    than are asked for. Of a heavy one the best are stored, or kept by every task
    and then by some; only if more are asked for its pages are numbered range
    by range.
    """
    index_keys = [c for c in ("bucket", "word") if c in words.columns]
    asked = words.select(*index_keys)
    if words.count() <= MAX_BROADCAST_KEYS:
        asked = F.broadcast(asked)
    heavy = stage(heavy_words(store.inv_index.join(asked, index_keys, "left_semi"), heavy_postings))
    words = stage(words.join(heavy.select("word", F.lit(True).alias("heavy")), "word", "left").select(
        *words.columns, F.coalesce("heavy", F.lit(False)).alias("heavy"),
        F.coalesce(F.col("most") <= BEST_ROWS, F.lit(False)).alias("limited")))
    most = {(r["heavy"], r["limited"]): r["most"] for r in words.groupBy("heavy", "limited").agg(F.max("most").alias("most")).collect()}
    found = []
    for (is_heavy, limited), bound in most.items():
        own = words.where((F.col("heavy") == is_heavy) & (F.col("limited") == limited)).drop("heavy", "limited")
        if is_heavy and limited and store.best is not None:
            rows = store.best.join(own, index_keys)
        elif limited:
            spread_by = "website_id" if is_heavy else None
            rows = first_rows(_word_hits(store, own), ["word"], best_first(), bound, spread_by)
        elif is_heavy:
            rows = row_numbers(_word_hits(store, own, True), ["word"], best_first())
        else:
            number = F.row_number().over(Window.partitionBy("word").orderBy(*best_first()))
            rows = _word_hits(store, own, True).withColumn("n", number)
        rows = rows.where("most IS NULL OR n <= most")
        if limited:  # few are left of them, so their URLs are looked up now
            rows = _with_url(rows.drop("bucket"), store, False)
        found.append(rows.select("word", F.col("n").cast("bigint").alias("n"), "url", "pagerank", "score"))
    return found


def search_batch(store: Store, queries: DataFrame, heavy_postings: int = HEAVY_POSTINGS) -> DataFrame:
    """``(query_id, position, url, pagerank, score)`` for ``queries(query_id,
    word, limit)``.

    Pages of a word are numbered once however many queries ask for it, and no
    further than the largest limit asks. Words with more than
    ``heavy_postings`` pages are numbered by many tasks; their best pages are
    read where the store has them.
    """
    asked = stage(queries.select(
        "query_id", F.lower("word").alias("word"), resolve_limits(F.col("limit")).alias("k")
    ).where("word IS NOT NULL AND (k IS NULL OR k > 0)"))
    words = stage(_bucketed_words(asked.groupBy("word").agg(
        F.when(F.count("*") == F.count("k"), F.max("k")).alias("most")), store))
    parts = _numbered_words(store, words, heavy_postings)
    schema = "word string, n bigint, url string, pagerank double, score double"
    winners = parts[0] if parts else asked.sparkSession.createDataFrame([], schema)
    for part in parts[1:]:
        winners = winners.unionByName(part)
    found = winners.join(asked, "word").where("k IS NULL OR n <= k")
    return found.select("query_id", F.col("n").alias("position"), "url", "pagerank", "score")


def batch_counts(store: Store, queries: DataFrame) -> DataFrame:
    """``(query_id, hits)`` for ``queries(query_id, word)``: how many pages hold
    the word, 0 for an unknown or missing one."""
    asked = queries.select("query_id", F.lower("word").alias("word"))
    words = _bucketed_words(asked.where("word IS NOT NULL").select("word").distinct(), store)
    keys = [c for c in ("bucket", "word") if c in words.columns]
    counts = store.inv_index.join(words, keys).groupBy("word").agg(F.count("*").alias("hits"))
    return asked.join(counts, "word", "left").select(
        "query_id", F.coalesce("hits", F.lit(0)).alias("hits")
    )
