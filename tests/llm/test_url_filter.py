import re

import duckdb

from tessera.llm import url_filter as uf
from tessera.llm.queries import op6_url_filter


def brute(url):
    u = re.sub("[A-Z]", lambda m: m[0].lower(), url or "")
    hit = [t for t in uf.VOCABULARY if re.search(f"(?<![a-z0-9]){t}(?![a-z0-9])", u)]
    strict = sum(uf.VOCABULARY[t] >= 1 for t in hit)
    return strict, len(hit) - strict


URLS = [None, "", "http://", "no scheme casino", "http://A.Example.COM/en/x?y#z", "https://example.com", "x://example.com/en/",
        "http://www.example.com/en/1", "http://a.www.example.com/en/", "http://notexample.com/en/", "http://b.net/es/casino",
        "http://b.net/de/cheap-pills", "http://b.net/de/cheap/cheap", "http://b.org/spamming", "http://b.org/a.spam?x",
        "http://ü.org/freeü-win", "http://c.org://d.net/fr/", "http://c.org?u=http://d.net/fr/", "HTTP://C.NET/es/Q",
        "http://c.net/es", "http://k.org/" + "free-" * 5000 + "bet", "http://line.org/a\nb/adult/ads", "freebetx casino"]


def test_automaton_against_expressions():
    a = uf.Automaton(sorted(uf.VOCABULARY))
    terms = sorted(uf.VOCABULARY)
    found = a.hits([(u or "").encode() for u in URLS])
    for u, row in zip(URLS, found):
        hit = {t for t, x in zip(terms, row) if x}
        strict = sum(uf.VOCABULARY[t] >= 1 for t in hit)
        assert (strict, len(hit) - strict) == brute(u), u


def test_overlapping_terms():
    a = uf.Automaton(["a-b", "b", "b-c", "a"])
    assert a.hits([b"a-b-c"]).tolist() == [[True, True, True, True]]
    assert a.hits([b"xa-b-c"]).tolist() == [[False, True, True, False]]


def test_contract_and_sql(spark):
    rows = list(enumerate(URLS)) + [(None, "http://x.org/spam"), (4, "http://q.com/")]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 AS host", "2 AS verdict", "3 AS html")
    got = uf.judge(df).collect()
    assert len(got) == len(rows)
    by = {(r.page_id, r.host): r for r in got}
    r = by[4, "a.example.com"]
    assert (r.path, r.rule, r.verdict) == ("/en/x", "example.com/en/", "block")
    assert by[7, "www.example.com"].rule == "www.example.com/en/" and by[8, "a.www.example.com"].verdict == "allow"
    assert by[5, "example.com"].rule is None and by[9, "notexample.com"].rule == "com/"
    assert by[10, "b.net"].verdict == "block" and by[11, "b.net"].verdict == "block"
    assert by[12, "b.net"].verdict == "allow"  # one soft term, twice
    assert by[3, ""].verdict == "block" and by[0, ""].verdict == "allow"
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    want = con.execute(uf.sql()).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(map(str, (tuple(r[n] for n in names) for r in got))) == sorted(map(str, want))
    assert uf.judge(df.where("false")).count() == 0


def test_query_covers_all_pages(spark, sf):
    assert op6_url_filter(spark, sf).count() == spark.read.parquet(f"{sf}/pages.parquet").count()
