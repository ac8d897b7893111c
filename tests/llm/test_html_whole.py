"""Whole articles: split over siblings, on hosts of several templates, nested very deeply."""

from __future__ import annotations

import time
from collections import defaultdict

from starloom.llm import html_extract

S = "id long, url string, page string"
WORDS = "the harbour was quiet when a small boat came in with the last light of day".split()


def para(k: int, n: int) -> str:
    return " ".join(WORDS[(k + i * 7) % len(WORDS)] for i in range(n)) + f" {k}."


def texts(spark, rows):
    out = html_extract.main_text(spark.createDataFrame(rows, S), page_html="page")
    return {r.id: r.main_text for r in out.collect()}


def plain(rows):
    """The vote and the second pass in plain Python."""
    ballot = defaultdict(lambda: defaultdict(float))
    for _, url, page in rows:
        for path, share in html_extract.Page(page or "").votes():
            ballot[url.split("/")[2]][path] += share
    best = {h: sorted(v, key=lambda p: (-round(v[p], 6), p))[: html_extract.PATHS_PER_HOST] for h, v in ballot.items()}
    return {i: html_extract.extract(page or "", best.get(url.split("/")[2])) for i, url, page in rows}


def split(k: int) -> tuple[str, list[str]]:
    lead, copy = [para(k, 30)], [para(k + 1, 35), para(k + 2, 35)]
    body = "".join(f"<p>{p}</p>" for p in copy)
    return f"<html><body><nav><a href=/>Home</a></nav><div class=wrap><div class=lead>{lead[0]}</div><div class=copy>{body}</div></div><footer>end</footer></body></html>", lead + copy


def test_article_in_several_siblings(spark):
    pages = {k: split(k) for k in range(12)}
    rows = [(k, f"http://one.example/{k}", page) for k, (page, _) in pages.items()] + [(100, "http://alone.example/x", pages[3][0])]
    got = texts(spark, rows)
    assert got == {**{k: "\n".join(want) for k, (_, want) in pages.items()}, 100: "\n".join(pages[3][1])}
    assert got == plain(rows)


def test_a_path_of_the_host_must_hold_the_story(spark):
    """Most pages have their text in one place; on some that place holds a teaser only."""
    rows = [(k, f"http://many.example/{k}", f"<body><div class=box><p>{para(k, 120)}</p></div></body>") for k in range(20)]
    story = [para(k, 60) for k in range(6)]
    body = "".join(f"<p>{p}</p>" for p in story)
    rows.append((50, "http://many.example/s", f"<body><div class=box><p>Teaser line here.</p></div><div class=long>{body}</div></body>"))
    got = texts(spark, rows)
    assert all(got[k] == para(k, 120) for k in range(20))
    assert got[50] == "\n".join(story) and got == plain(rows)


def test_four_templates_of_a_host(spark):
    rows = [(10 * t + k, f"http://four.example/{t}/{k}", f"<body><div class=t{'abcd'[t]}><p>{para(k, 90)}</p></div></body>") for t in range(4) for k in range(5 - t)]
    assert texts(spark, rows) == {i: para(i % 10, 90) for i, _, _ in rows}


def test_an_article_is_not_widened(spark):
    page = f"<body><div class=x><p>{para(1, 40)}</p></div><article><p>{para(2, 80)}</p></article></body>"
    assert texts(spark, [(1, "http://a.example/", page)]) == {1: para(2, 80)}


def test_deep_nesting_takes_linear_time():
    def seconds(depth, close="</div>"):
        page = "".join(f"<div class=c{'ab'[k % 2]}>w{k}" for k in range(depth)) + close * depth
        start = time.perf_counter()
        text = html_extract.extract(page, [p for p, _ in html_extract.Page(page).votes()])
        assert text.count("w") == depth
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(50_000) < 20 * max(seconds(10_000), 0.02)
    assert seconds(50_000, "</p></b>") < 30
