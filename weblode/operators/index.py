"""Pages to an inverted index.

Pages are ``(url, html)``, plain documents ``(url, text)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblode.functions.html import body_html, body_links, text_of
from weblode.functions.text import count_word, extract_words, has_word
from weblode.operators.skew import group_in_parts

# Longest packed list: about 8 MB of text at 80 bytes per entry.
ENTRIES_PER_LIST = 100_000


def parsed(pages: DataFrame) -> DataFrame:
    """Pages ``(url, html)`` as ``(url, text, hrefs)``: the body is cut out of
    a page once for both. Parsed pages are returned as they are, so what takes
    pages also takes a stored table of parsed ones."""
    if "html" not in pages.columns:
        return pages
    bodies = pages.select("url", body_html(F.col("html")).alias("body"))
    return bodies.select(
        "url", text_of(F.col("body")).alias("text"), body_links(F.col("body")).alias("hrefs")
    )


def page_text(pages: DataFrame) -> DataFrame:
    return parsed(pages).select("url", "text")


def words(documents: DataFrame) -> DataFrame:
    """One row ``(word, url)`` per occurrence.

    The outer form of explode, with the filter after it, keeps the optimizer
    from testing for empty arrays first, which would extract the words twice.
    """
    word = F.explode_outer(extract_words(F.col("text"))).alias("word")
    found = documents.select("url", word).where("word IS NOT NULL")
    return found.select(F.lower("word").alias("word"), "url")


def term_counts(documents: DataFrame) -> DataFrame:
    """``(word, url, count)``. Occurrences are counted before the shuffle and
    the shuffle key holds the URL, so a word on every page spreads evenly. Documents
    that are partitioned by URL are not shuffled at all."""
    return words(documents).groupBy("word", "url").agg(F.count("*").alias("count"))


def counts_of(documents: DataFrame, word: str) -> DataFrame:
    """The rows of ``term_counts`` for one word. All texts are read, but no other
    words are taken out of them. Pages without it go after the sums: a filter
    before them would count twice."""
    word = word.lower()
    sums = documents.groupBy("url").agg(F.sum(count_word(F.col("text"), word)).alias("count"))
    return sums.where("count > 0").select(F.lit(word).alias("word"), "url", "count")


def inverted_index(pages: DataFrame) -> DataFrame:
    """Postings ``(word, url, count)`` of HTML pages."""
    return term_counts(page_text(pages))


def indexed_urls(pages: DataFrame) -> DataFrame:
    """URLs that own at least one posting, read off the pages: one row per
    page reaches the shuffle instead of one per posting."""
    any_word = F.bool_or(has_word(F.col("text"))).alias("any_word")
    return page_text(pages).groupBy("url").agg(any_word).where("any_word").select("url")


def posting_lists(postings: DataFrame, per_list: int = ENTRIES_PER_LIST) -> DataFrame:
    """``(word, part, parts, postings)`` with postings packed as
    ``url|count|url|count…``.

    A word with more than ``per_list`` pages gets several rows, numbered by
    ``part`` from 0 to ``parts - 1``, so no list grows with the corpus.
    ``postings`` is read twice; pass a stored table.
    """
    entries = F.array_sort(F.collect_list(F.struct("url", "count")))
    packed = F.transform(
        entries, lambda e: F.concat_ws("|", e["url"], e["count"].cast("string"))
    )
    lists = group_in_parts(postings, "word", "url", per_list)
    return lists.agg(F.array_join(packed, "|").alias("postings"))
