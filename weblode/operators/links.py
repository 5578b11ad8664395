"""Pages to a link graph ``edges(src, dst)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblode.functions.urls import (
    domain_of,
    is_valid_ref,
    normalize_link,
    strip_html_ext,
)
from weblode.operators.index import ENTRIES_PER_LIST, parsed
from weblode.operators.skew import group_in_parts


def raw_links(pages: DataFrame) -> DataFrame:
    """``(url, pos, href)``: every body link in document order. Targets are
    read off inside the array, so that filters on ``href`` do not repeat that.
    (The outer form of explode for the reason given in ``index.words``.)"""
    link = F.posexplode_outer("hrefs").alias("pos", "href")
    return parsed(pages).select("url", link).where("href IS NOT NULL")


def valid_links(pages: DataFrame) -> DataFrame:
    return raw_links(pages).where(is_valid_ref(F.col("href")))


def link_graph(pages: DataFrame, strip_targets: bool = False) -> DataFrame:
    """Distinct ``(src, dst)``. Page URLs carry no ``.html`` but targets do,
    unless ``strip_targets`` removes it there as well."""
    dst = normalize_link(domain_of(F.col("url")), F.col("href"))
    if strip_targets:
        dst = strip_html_ext(dst)
    return valid_links(pages).select(F.col("url").alias("src"), dst.alias("dst")).distinct()


def graph_nodes(edges: DataFrame) -> DataFrame:
    """Every link source and target once, from a single scan of the edges."""
    return edges.select(F.explode(F.array("src", "dst")).alias("url")).distinct()


def out_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src").agg(F.count("*").alias("out_degree"))


def adjacency_lists(edges: DataFrame, per_list: int = ENTRIES_PER_LIST) -> DataFrame:
    """``(src, part, parts, links)`` with links packed as ``url|url…``; a source
    with more than ``per_list`` links gets several rows, numbered by ``part``
    from 0 to ``parts - 1``. ``edges`` is read twice; pass a stored table."""
    links = F.array_join(F.array_sort(F.collect_set("dst")), "|")
    lists = group_in_parts(edges, "src", "dst", per_list)
    return lists.agg(links.alias("links"))
