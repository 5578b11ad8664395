"""The registered queries again, in DuckDB SQL over the same tables."""

from __future__ import annotations

from weblode.registered import SEARCH_WORD, SHORT_LIST, STEPS

_BLOCK = (
    "address|article|aside|audio|blockquote|body|br|canvas|caption|center|col|colgroup|"
    "dd|del|details|div|dl|dt|fieldset|figcaption|figure|footer|form|frame|frameset|"
    "h[1-6]|head|header|hgroup|hr|html|ins|li|link|main|math|menu|meta|nav|noframes|"
    "noscript|ol|p|plaintext|pre|script|section|style|svg|table|tbody|td|template|"
    "tfoot|th|thead|title|tr|ul|video"
)
# References that occur in the tables; a name may lack its semicolon.
_ENTITIES = {"quot": '"', "copy": "©", "middot": "·", "lt": "<", "gt": ">", "nbsp": " "}


def _decoded(text: str) -> str:
    for name, char in (*_ENTITIES.items(), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name}(;|\\b)', '{char}', 'g')"
    return text


_BODY = r"""
    regexp_replace(regexp_replace(regexp_replace(html,
        '(?s)<!--.*?-->', '', 'g'),
        '(?is)<(script|style)\b.*?</(script|style)\s*>', ' ', 'g'),
        '(?is)^.*?<body[^>]*>', '')
"""
_TEXT = _decoded(
    rf"""
    regexp_replace(regexp_replace({_BODY},
        '(?i)</?({_BLOCK})\b[^>]*>', ' ', 'g'),
        '<[^>]*>', '', 'g')
"""
)
_SELF = r"replace(regexp_replace(url, 'http://|https://|\?.*', '', 'g'), '.html', '')"

_DELETED = r"""["''\[\]()$#?!*¿¡%+]"""
_TOKENS = rf"""
    select url, trim(token, (select string_agg(chr(i::int), '') from range(1, 33) r(i))) as token
    from (select url, unnest(string_split_regex(
              regexp_replace(text, '{_DELETED}', '', 'g'), '[ ,.\-_;]')) as token
          from body_text)
"""
_WORDS = """
    select lower(token) as word, url from tokens
    where regexp_full_match(token, '[a-zA-Z0-9]+')
"""
_TERM_COUNTS = "select word, url, count(*) as count from words group by word, url"
_LINKS = rf"""
    select url, (i - 1)::int as pos, {_decoded("trim(regexp_extract(tag, " + chr(39)
    + r"(?i)\shref\s*=\s*(\"[^\"]*\"|''[^'']*''|[^\s>\"'']+)" + chr(39)
    + ", 1), chr(34) || chr(39))")} as href
    from (select url, unnest(tags) as tag, generate_subscripts(tags, 1) as i
          from (select {_SELF} as url,
                       regexp_extract_all({_BODY}, '(?i)<a\b[^>]*>') as tags from pages))
"""
_VALID = r"""
    select url, pos, href, starts_with(href, 'http') as is_absolute from raw_links
    where regexp_full_match(href, '(http|/|[a-zA-Z0-9])[^\n\r\x{85}\x{2028}\x{2029}]*')
"""
_EDGES = r"""
    select distinct url as src, regexp_replace(
        case when is_absolute then href
             when starts_with(href, '/') then split_part(url, '/', 1) || href
             else split_part(url, '/', 1) || '/' || href end,
        'http://|https://|\?.*', '', 'g') as dst
    from valid_links
"""
_PART_EDGES = """
    select distinct a.l_partkey::varchar as src, b.l_partkey::varchar as dst
    from lineitem a join lineitem b
      on a.l_orderkey = b.l_orderkey and b.l_linenumber = a.l_linenumber + 1
"""

_CTES = {
    "body_text": rf"select {_SELF} as url, trim(regexp_replace({_TEXT}, '\s+', ' ', 'g')) as text"
    " from pages",
    "tokens": _TOKENS,
    "words": _WORDS,
    "term_counts": _TERM_COUNTS,
    "raw_links": _LINKS,
    "valid_links": _VALID,
    "edges": _EDGES,
}
_INDEX = ("body_text", "tokens", "words", "term_counts")
_GRAPH = ("raw_links", "valid_links", "edges")


def _with(ctes: dict[str, str], query: str) -> str:
    parts = ", ".join(f"{name} as materialized ({sql})" for name, sql in ctes.items())
    return f"with {parts} {query}"


def _over(names: tuple[str, ...], query: str, **extra: str) -> str:
    return _with({**{n: _CTES[n] for n in names}, **extra}, query)


def _rank_ctes(steps: int) -> dict[str, str]:
    """Unrolled PageRank over a CTE ``edges``; the last one is ``ranks``."""
    ctes = {
        "degrees": "select src, count(*) as out_degree from edges group by src",
        "nodes": "select src as url from edges union select dst from edges",
        "rank_0": "select src as url, 1.0::double as rank from degrees",
    }
    for i in range(1, steps + 1):
        ctes[f"rank_{i}"] = f"""
            select n.url, 1 - 0.85::double + 0.85::double * coalesce(s.received, 0) as rank
            from nodes n left join (
                select e.dst, sum(r.rank / d.out_degree) as received
                from edges e join degrees d using (src) join rank_{i - 1} r on r.url = e.src
                group by e.dst) s on s.dst = n.url"""
    ctes["ranks"] = f"select * from rank_{steps}"
    return ctes


_ID = "substr(sha256(url), 1, 32)"
_ROUNDED_RANKS = "select url, round(rank, 6) as rank from ranks"
_SCORED = f"""
    select w.word, w.url, {_ID.replace("url", "w.url")} as website_id, r.rank as pagerank,
           r.rank + least(w.count, 20) / 20.0::double as score
    from term_counts w left join ranks r on r.url = w.url
"""
_BEST_FIRST = "score desc nulls last, website_id"


def _search(limit: int | None) -> str:
    cut = "" if limit is None else f"limit {limit}"
    return _over(
        _INDEX + _GRAPH,
        f"""select position, url, round(pagerank, 6) as pagerank from (
                select *, row_number() over (order by {_BEST_FIRST}) as position
                from scored where word = lower('{SEARCH_WORD}') order by position {cut})""",
        **_rank_ctes(STEPS),
        scored=_SCORED,
    )


_BATCH = f"""
    select word as query_id, n as position, url, round(pagerank, 6) as pagerank, round(score, 6) as score
    from (select *, row_number() over (partition by word order by {_BEST_FIRST}) as n,
                 case length(word) % 4 when 0 then 10 when 1 then 3 when 2 then 0 else -1 end as k
          from scored)
    where k = -1 or n <= k
"""
_PART_RANKS = _with({"edges": _PART_EDGES, **_rank_ctes(STEPS)}, _ROUNDED_RANKS)
_DANGLING_RANKS = _with(
    {
        "part_edges": _PART_EDGES,
        "edges": "select * from part_edges where src not in "
        "(select p_partkey::varchar from part where p_type = 'SMALL')",
        **_rank_ctes(STEPS),
    },
    _ROUNDED_RANKS,
)
_DOCUMENT_COUNTS = {
    "body_text": "select doc_id::varchar as url, text from documents",
    **{n: _CTES[n] for n in ("tokens", "words", "term_counts")},
}
_LINKED = {
    "part_edges": _PART_EDGES,
    "edges": "select * from part_edges",
    **_rank_ctes(STEPS),
    "body_text": "select (doc_id * 3)::varchar as url, text from documents",
    **{n: _CTES[n] for n in ("tokens", "words", "term_counts")},
    "nine": "select url, round(rank, 9) as rank from ranks",
    "scored": _SCORED.replace("join ranks r", "join nine r"),
}


def _search_linked(limit: int | None) -> str:
    cut = "" if limit is None else f"limit {limit}"
    return _with(
        _LINKED,
        f"""select position, url, round(pagerank, 6) as pagerank from (
                select *, row_number() over (order by {_BEST_FIRST}) as position
                from scored where word = lower('{SEARCH_WORD}') order by position {cut})""",
    )


def _part_of(column: str, parts: object) -> str:
    return f"(('0x' || substr(md5({column}), 1, 8))::bigint % ({parts}))"


_JSON = f"""
    select 0::bigint as position, '{{"results":[' as json
    union all select position, case when position > 1 then ',' else '' end || '{{"url":"' || url || '"'
        || coalesce(',"pagerank":' || pagerank, '') || '}}' from found
    union all select count(*) + 1, ']}}' from found
"""
_MERGED = """
    select c_custkey, case when c_custkey % 3 = 0 then lower(c_name) else c_name end as c_name, c_nationkey
    from customer
    union all select c_custkey + 10000000, c_name, null from customer where c_custkey % 7 = 0
"""
_TERM_COUNT_ROWS = _over(_INDEX, "select * from term_counts")
_EDGE_ROWS = _over(_GRAPH, "select * from edges")
_ONE_STEP = _over(_GRAPH, _ROUNDED_RANKS, **_rank_ctes(1))

ORACLE = {
    "body_text": _over(("body_text",), "select * from body_text"),
    "tokens": _over(
        ("body_text", "tokens"),
        "select url, token, count(*) as n from tokens group by url, token",
    ),
    "words": _over(("body_text", "tokens", "words"), "select * from words"),
    "term_counts": _TERM_COUNT_ROWS,
    "term_counts_documents": _with(_DOCUMENT_COUNTS, "select * from term_counts"),
    "posting_lists": _over(
        _INDEX,
        "select word, 0::int as part, 1::int as parts,"
        " string_agg(url || '|' || count, '|' order by url) as postings"
        " from term_counts group by word",
    ),
    "posting_lists_split": _over(
        _INDEX,
        f"""select word, {_part_of("url", "parts")}::int as part, parts,
                string_agg(url || '|' || count, '|' order by url) as postings
            from term_counts join (select word, ceil(count(*) / {SHORT_LIST})::int as parts
                from term_counts group by word) using (word) group by word, part, parts""",
    ),
    "path_urls": r"""select page_id, path, replace(regexp_extract(path,
            '(?s)(?:^|/)([^/]*\.[^/]*(?:/.*)?)$', 1), '.html', '') as url
        from (select page_id, 'crawl/' || regexp_replace(url, 'https?://', '', 'g') as path from pages)""",
    "link_rules": _over(
        ("raw_links",),
        r"""select url, pos, href, is_valid, starts_with(href, 'http') as is_absolute,
                case when is_valid then dst end as dst,
                case when is_valid then replace(dst, '.html', '') end as dst_stripped
            from (select *, regexp_full_match(href, '(http|/|[a-zA-Z0-9])[^\n\r\x{85}\x{2028}\x{2029}]*') as is_valid,
                    regexp_replace(case when starts_with(href, 'http') then href
                        when starts_with(href, '/') then split_part(url, '/', 1) || href
                        else split_part(url, '/', 1) || '/' || href end,
                        'http://|https://|\?.*', '', 'g') as dst
                from (select url, pos, case pos % 8 when 0 then 'http://x.example' || href
                        when 1 then substr(href, 2) when 2 then href || '?q=1' when 3 then href || '#s'
                        when 4 then href || '.html' when 5 then 'mailto:a@b.c' when 6 then '../' || href
                        else '//cdn.example' || href end as href from raw_links))""",
    ),
    "page_urls": f"select url as address, {_SELF} as url, split_part({_SELF}, '/', 1) as domain"
    " from pages",
    "raw_links": _over(("raw_links",), "select * from raw_links"),
    "valid_links": _over(("raw_links", "valid_links"), "select * from valid_links"),
    "edges": _EDGE_ROWS,
    "edges_strip_ext": _over(
        _GRAPH, "select distinct src, replace(dst, '.html', '') as dst from edges"
    ),
    "adjacency_lists": _over(
        _GRAPH,
        "select src, 0::int as part, 1::int as parts,"
        " string_agg(dst, '|' order by dst) as links, 1.0::double as rank"
        " from edges group by src",
    ),
    "out_degree": _over(_GRAPH, "select src, count(*) as out_degree from edges group by src"),
    "graph_nodes": _over(_GRAPH, "select src as url from edges union select dst from edges"),
    "pagerank_step": _ONE_STEP,
    "pagerank_pages": _over(_GRAPH, _ROUNDED_RANKS, **_rank_ctes(STEPS)),
    "pagerank_cyclic": _PART_RANKS,
    "pagerank_dangling": _DANGLING_RANKS,
    "pagerank_resumed": _DANGLING_RANKS,
    "pagerank_restarted": _PART_RANKS,
    "websites": _over(
        _INDEX, f"select {_ID} as website_id, url from (select distinct url from term_counts)"
    ),
    "store_postings": _over(_INDEX, f"select word, {_ID} as website_id, count from term_counts"),
    "store_ranks": _over(
        _INDEX + _GRAPH,
        f"select {_ID} as website_id, round(rank, 6) as value from ranks"
        " where url in (select url from term_counts)",
        **_rank_ctes(STEPS),
    ),
    "store_words": _over(
        _INDEX,
        f"""select word, {_ID} as website_id, count from (
                select case length(word) % 3 when 0 then word || '-' || word when 1 then word
                    else '_' || word end as word, url, count from term_counts)
            where regexp_full_match(word, '[a-zA-Z0-9][a-zA-Z0-9-]*')""",
    ),
    "store_appended": _over(
        _INDEX,
        f"""select t.word, t.count, t.url, case when t.url in (
                select url from term_counts where {_part_of("word", 2)} = 0 and {_part_of("url", 5)} = 0)
                then 'own-' || t.url else {_ID.replace("url", "t.url")} end as website_id
            from term_counts t""",
    ),
    "store_merged": _MERGED,
    "store_merged_in_place": _MERGED,
    "crawl_roundtrip": _with(
        {
            "pages": f"""select split_part({_SELF}, '/', 1) || '/' || page_id || '.html' as url, html
                from pages where html is not null""",
            **{n: _CTES[n] for n in _INDEX + _GRAPH},
            **_rank_ctes(STEPS),
        },
        "select t.word, t.url, t.count, round(r.rank, 6) as rank from term_counts t left join ranks r using (url)",
    ),
    "search_word": _search(10),
    "search_all_limit": _search(None),
    "search_stored": _search(25),
    "search_batch": _over(_INDEX + _GRAPH, _BATCH, **_rank_ctes(STEPS), scored=_SCORED),
    "search_linked": _search_linked(None),
    "search_linked_limit": _search_linked(50),
    "search_batch_linked": _with(_LINKED, _BATCH),
    "search_top": _search_linked(50),
    "search_batch_top": _with(_LINKED, _BATCH),
    "search_batch_counts": _over(
        _INDEX,
        """select word as query_id, count(*) as hits from term_counts group by word
            union all select distinct 'no ' || word, 0 from term_counts""",
    ),
    "search_json": _over(
        _INDEX + _GRAPH,
        _JSON,
        **_rank_ctes(STEPS),
        scored=_SCORED,
        found=f"""select *, row_number() over (order by {_BEST_FIRST}) as position
            from scored where word = lower('{SEARCH_WORD}') order by position limit 10""",
    ),
    "packed_postings_roundtrip": _TERM_COUNT_ROWS,
    "packed_ranks_roundtrip": _ONE_STEP,
    "packed_edges_roundtrip": _EDGE_ROWS,
}
