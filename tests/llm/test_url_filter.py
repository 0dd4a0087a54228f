"""Wildcard automaton against regular expressions, the query against SQL and a plain loop."""

import random
import re

import pytest
from reelweave.llm import url_filter as uf
from reelweave.llm.queries import QUERIES, URL_RULES


def pattern(glob):
    parts = []
    for s in uf.symbols(glob):
        parts.append({uf.ONE: "[^/]", uf.RUN: "[^/]*", uf.ANY: ".*"}.get(s) or re.escape(s))
    return re.compile("".join(parts), re.DOTALL)


def plain(rules, urls):
    patterns = [pattern(r.glob) for r in rules]
    out = []
    for url in urls:
        fits = [(rules[k].length, -k) for k, p in enumerate(patterns) if p.fullmatch(url)]
        out.append(-max(fits)[1] if fits else None)
    return out


def test_globs_against_regular_expressions():
    rng = random.Random(1)
    letters = "ab./é\n😀"
    globs = ["", "*", "**", "?", "a*b", "**/a?", "*.a/**", "\\*a", "a\\?b", "ab**", "***a", "**a**b**", "a" * 70 + "*b", "a" * 64, "😀?é"]
    globs += ["".join(rng.choice(letters + "**??") for _ in range(rng.randint(0, 12))) for _ in range(120)]
    rules = [uf.Rule(f"r{k}", g, "block", rng.randint(0, 5)) for k, g in enumerate(globs)]
    urls = ["", "a" * 70 + "aab", "a" * 64, "a?b", "*a", "😀xé", "/", "." * 300]
    urls += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    assert uf.WildcardAutomaton(rules).words > 10
    assert uf.WildcardAutomaton(rules).match(urls) == plain(rules, urls)
    for k in range(0, len(rules), 9):  # each alone, and in one word
        assert uf.WildcardAutomaton(rules[k : k + 1]).match(urls) == plain(rules[k : k + 1], urls)
    with pytest.raises(ValueError):
        uf.symbols("a\\")


def test_slices_and_long_urls(monkeypatch):
    rules = [uf.prefix_rule("block", "b.org", "/x"), uf.Rule("end", "**.exe", "block", 3)]
    urls = [".a.b.org/x" + "y" * 50_000, ".b.org/x", ".b.org/", "." + "z/" * 20_000 + ".exe", ".b.orgx/x", ""]
    want = [0, 0, None, 1, None, None]
    assert uf.WildcardAutomaton(rules).match(urls) == want
    monkeypatch.setattr(uf, "SLICE_CHARACTERS", 3)
    assert uf.WildcardAutomaton(rules).match(urls) == want
    monkeypatch.setattr(uf, "SLICE_WORDS", 1)
    assert uf.WildcardAutomaton(rules).match(urls) == want
    monkeypatch.setattr(uf, "MAX_BITS", 5)
    with pytest.raises(ValueError):
        uf.WildcardAutomaton(rules)


def judged(url):
    """Host, path, rule and verdict of the query by plain string handling."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        rest = re.split(r"[?#]", rest, maxsplit=1)[0]
        host, slash, tail = rest.partition("/")
        host, path = re.sub("[A-Z]", lambda m: m.group().lower(), host), slash + tail
    fits = []
    for verdict, h, p in [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h + p), h + p, verdict))
    rule, verdict = max(fits)[1:] if fits else (None, "allow")
    return host, path, rule, verdict


def test_query_against_a_plain_loop(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = QUERIES["op11_url_filter"](spark, folder).collect()
        urls = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
        assert {r.page_id: tuple(r)[1:] for r in rows} == {k: judged(u) for k, u in urls.items()}
        assert len({r.rule for r in rows}) > 3


def test_odd_urls(table, values):
    urls = [
        None, "", "no scheme", "://", "http://", "x://ORG/", "http://EXAMPLE.ORG/es/é", "http://É.org", "http://É.org/", "a://b?c://d/e",
        "http://x.com/x.example.org/es/", "http://.org/", "http://org", "http://xorg/", "h://example.org/en/1?x#y", "h://example.org#/es/",
        "h://u@example.org:80/es/", "h://a\nb.org/\n/", "h://de.com/de/" + "x" * 100_000, "mailto:a@b", "h:///es/", "h://example.org//es/",
    ]
    rows = table("page_id BIGINT, url STRING, host STRING, rule INT, key STRING", *[(k, u, "x", 1, "k") for k, u in enumerate(urls)], (None, "h://a.org/", "", 1, ""), (0, None, "", 1, ""))
    found = values(uf.judge_urls(rows, URL_RULES))
    want = [(k, *judged(u)) for k, u in [*enumerate(urls), (None, "h://a.org/"), (0, None)]]
    assert found == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))
    assert uf.judge_urls(rows.limit(0), URL_RULES).count() == 0
    assert values(uf.judge_urls(rows.where("page_id = 5"), [], key="key", default="block")) == [("k", "org", "/", None, "block")]
