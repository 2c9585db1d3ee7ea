"""Wrappers of hosts whose pages name their elements page by page."""

import json

from depotline.llm import wrappers


def _pages(n):
    slug = [f"{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}title" for i in range(n)]
    return [(i, f"http://h/{i}", f'<div id="item-{i}" class="{slug[i]}"><article id="post-{i}" class="{slug[i]}">'
             f'<p id="{slug[i]}">text {i}</p></article></div><footer>F</footer>') for i in range(n)]


def _nodes(node):
    return 1 + sum(map(_nodes, node[5]))


def test_wrappers_do_not_grow_with_page_specific_names(spark):
    for n in (20, 200):
        frame = spark.createDataFrame(_pages(n), "page_id long, url string, html string").repartition(4)
        found = wrappers.wrappers(frame).collect()
        whole = json.loads(found[0].wrapper)
        assert len(found) == 1 and _nodes(whole) == 4
        assert wrappers.article_paths(whole) == [["div.0.item", "article.0.post"]]
        assert {r.page_id: r.text for r in wrappers.extracted(frame).collect()} == {
            i: f"text {i}" for i in range(n)}


def test_names_that_many_pages_have_stay(spark):
    rows = [(i, "http://h/x", f'<div class="left-{i}">a</div><div class="right">b</div>') for i in range(60)]
    rows.append((60, "http://h/x", '<div class="single">c</div>'))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert wrappers.frequent_names(frame).collect()[0].names == "0 left right"


def test_broadcast_is_bounded_by_bytes(spark, monkeypatch):
    frame = spark.createDataFrame(_pages(20), "page_id long, url string, html string")
    monkeypatch.setattr(wrappers, "BROADCAST_BYTES", 10)
    assert not wrappers._small(wrappers.frequent_names(frame), "host", "names")
    assert {r.text for r in wrappers.extracted(frame).collect()} == {f"text {i}" for i in range(20)}


def test_layout_classes_do_not_take_the_article_away(spark):
    """Names that hold a mark's word without being one; a block of one heading and one paragraph."""
    pages = {
        "sidebar": "<article><h1>T</h1><div class='content has-sidebar'><p>{} body</p></div>"
                   "<div class='sidebar'>S</div></article>",
        "header": "<div class='site-header'>Site</div><article><div class='post-header'><h1>T</h1></div>"
                  "<p>{} body</p></article>",
        "share": "<article><h1>T</h1><p class='share-of-market'>{} body</p><div class='share-bar'>F</div></article>",
        "plain": "<div class='x'><div class='y'><h1>T</h1><p>{} body " + "that goes on " * 20 + "</p></div></div>"
                 "<div class='menu'>M</div>",
        "comments": "<article><h1>T</h1><p>{} body</p><div class='post comments'>" + "c " * 200 + "</div></article>",
    }
    rows = [(f"{k}{i}", f"http://{k}/{i}", f"<html><body>{v.format('w' + str(i))}</body></html>")
            for k, v in pages.items() for i in range(3)]
    frame = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = {r.page_id: r.text for r in wrappers.extracted(frame).collect()}
    for k in pages:
        for i in range(3):
            tail = (" " + "that goes on " * 20).rstrip() if k == "plain" else ""
            assert got[f"{k}{i}"] == f"T w{i} body{tail}", k
