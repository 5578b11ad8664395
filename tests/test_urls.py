import hashlib

import pytest
from pyspark.sql import functions as F

from weblode.functions import urls

NORMALIZED = {
    "/a/b": "example.com/a/b",
    "about.html": "example.com/about.html",
    "9/z": "example.com/9/z",
    "http://x.org/p?q=1": "x.org/p",
    "https://x.org/p#s": "x.org/p#s",
    "//cdn.org/x": "example.com//cdn.org/x",
    "mailto:a@b.c": "example.com/mailto:a@b.c",
    "javascript:void(0)": "example.com/javascript:void(0)",
    "HTTP://X.org": "example.com/HTTP://X.org",
    "httpd/doc": "httpd/doc",
    "/go?u=http://b.org": "example.com/go",
    "/r/http://b.org": "example.com/r/b.org",
}
REJECTED = ["#top", "../x", "./y", "?p=1", "", "a\nb", "a b", "a\n", " /x"]


def test_link_goldens(values):
    resolve = lambda href: F.when(
        urls.is_valid_ref(href), urls.normalize_link(F.lit("example.com"), href)
    )
    assert values(resolve, NORMALIZED) == list(NORMALIZED.values())
    assert values(resolve, REJECTED) == [None] * len(REJECTED)


PATHS = {
    "crawl/example.com/a/b.html": "example.com/a/b",
    "example.com/index.html": "example.com/index",
    "crawl/example.com/a.htm": "example.com/a.htm",
    "crawl/example.com/v.html5/p.html": "example.com/v5/p",
    "hdfs://n1.local:8020/web/example.com/x.html": "n1.local:8020/web/example.com/x",
    "crawl/nohost/page": "",
    "example.com": "example.com",
    ".html": "",
}


def test_path_goldens(values):
    assert values(urls.url_from_path, PATHS) == list(PATHS.values())


@pytest.mark.parametrize(
    ("function", "value", "expected"),
    [
        (urls.domain_of, "a.org/b/c", "a.org"),
        (urls.domain_of, "a.org", "a.org"),
        (urls.domain_of, "/b", ""),
        (urls.self_url, "https://a.org/b.html?c#d", "a.org/b"),
        (urls.self_url, "http://A.org/b/#top", "A.org/b/#top"),
        (urls.is_absolute, "https://a", True),
        (urls.is_absolute, "Http://a", False),
        (urls.website_id, "a.org", hashlib.sha256(b"a.org").hexdigest()[:32]),
    ],
)
def test_url_functions(function, value, expected, values):
    assert values(function, [value]) == [expected]
