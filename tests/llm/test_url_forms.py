"""Forms of one address share their decisions, also where their link is a loop."""

from __future__ import annotations

from fxtape.llm import url_filter
from fxtape.llm.queries import URL_RULES


def test_forms_of_an_address(spark):
    urls = ["http://b.net/es", "http://b.net/es/", "http://c.net/fr", "https://d.net:443/es#x", "http://e.net/es", "http://g.org/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    edges = spark.createDataFrame(
        [("http://b.net/es", "http://b.net/es/"), ("http://c.net/fr", "http://c.net/fr/"), ("https://d.net:443/es#x", "http://d.net/es/")],
        "url string, target string",
    )
    found = [(r.verdict, r.source) for r in url_filter.filtered(pages, edges, URL_RULES).orderBy("page_id").collect()]
    assert found == [
        ("block", "alias"), ("block", "rule"), ("block", "alias"), ("block", "alias"), ("allow", "default"), ("allow", "default"),
    ]
    alone = url_filter.filtered(pages, edges.where("false"), URL_RULES).orderBy("page_id").collect()
    assert [r.verdict for r in alone] == ["block", "block", "allow", "allow", "allow", "allow"]
