"""A branch of a host is judged alike however much the host has elsewhere."""

import pytest

from tallyloom.llm.url_templates import UrlRule, judge_urls

RULES = (
    UrlRule("block", "h.net", "/spam/a"), UrlRule("allow", "h.net", "/news/1"), UrlRule("block", "h.net", "/few/x"),
    UrlRule("allow", "h.net", "/clean"),
)
LETTERS = str.maketrans("0123456789", "ghijklmnop")


def word(i):
    return str(i).translate(LETTERS)


def judged(spark, urls):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {r["url"]: r["verdict"] for r in judge_urls(pages, rules=RULES).collect()}


@pytest.mark.parametrize("section", ["other", "clean"])  # small sections without labels, or labelled clean
def test_branch_on_a_small_and_a_very_large_host(spark, section):
    spam = [f"http://h.net/spam/{c}{word(i)}/" for c in "ab" for i in range(100 if c == "a" else 9)]
    few = [f"http://h.net/few/{c}{word(i)}/" for c in "xy" for i in range(30 if c == "x" else 9)]  # less than OWN urls
    news = [f"http://h.net/news/{i}" for i in range(300)]
    sections = [f"http://h.net/{section}{word(k)}/p{i}" for k in range(400) for i in range(25)]
    small, large = judged(spark, spam + few + news), judged(spark, spam + few + news + sections)
    assert {large[u] for u in spam} == {"block"} and {large[u] for u in few if "/few/x" in u} == {"block"}
    assert {u: large[u] for u in spam + few} == {u: small[u] for u in spam + few}
    assert {large[u] for u in news + sections} == {"allow"}


def test_branches_below_the_fourth_segment(spark):
    """One long chain, and branches that differ only in their sixth segment."""
    rules = (UrlRule("block", "h.net", "/a/b/c/d/e/bad/x"), UrlRule("allow", "h.net", "/a/b/c/d/e/good/x"))
    urls = [f"http://h.net/a/b/c/d/e/{s}/{c}{word(i)}" for s in ("bad", "good") for c in "xy" for i in range(100)]
    urls += ["http://g.net/" + "/".join(word(i) for i in range(200))]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = {r["url"]: r["verdict"] for r in judge_urls(pages, rules=rules).collect()}
    assert len(out) == len(urls)
    assert all(v == ("block" if "/bad/" in u else "allow") for u, v in out.items())
