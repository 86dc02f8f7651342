from nearkin.llm import urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def judge(spark, rows, rules=RULES):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, verdict string")
    table = spark.createDataFrame(rules, "host string, path string, action string")
    found = urls.judge(pages, table, urls.page_links(pages)).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}, len(found)


def page(i, url, html=None):
    return (i, url, html, "other", None)


def test_rules_hosts_and_paths(spark):
    rows = [
        page(0, "http://A.Example.NET/en/x?q=/de/"), page(1, "https://example.net/fr/"), page(2, "http://example.net"), page(3, None),
        page(4, "no scheme/de/"), page(5, "http://notexample.com/de/"), page(6, "http://x.example.com/de/#a"), page(7, "x://y.org/fr/é"),
        page(8, "http://net/"), page(9, "http://example.com/d\ne/"), page(10, ""), page(10, ""), page(11, "http://example.com/de?x"),
    ]
    found, n = judge(spark, rows)
    assert n == len(rows)
    assert found == {
        0: ("a.example.net", "/en/x", "example.net/en/", "allow"), 1: ("example.net", "/fr/", "net/", "block"),
        2: ("example.net", "", None, "allow"), 3: ("", "", None, "allow"), 4: ("", "", None, "allow"),
        5: ("notexample.com", "/de/", None, "allow"), 6: ("x.example.com", "/de/", "example.com/de/", "block"),
        7: ("y.org", "/fr/é", "org/fr/", "allow"), 8: ("net", "/", "net/", "block"),
        9: ("example.com", "/d\ne/", None, "allow"), 10: ("", "", None, "allow"), 11: ("example.com", "/de", None, "allow"),
    }


def test_blocks_pass_along_links_and_allows_come_first(spark):
    canonical = '<head><link rel="canonical" href="{}"></head>'
    refresh = "<META HTTP-EQUIV=refresh content='0; URL={}'>"
    rows = [
        page(0, "http://a.com/1", canonical.format("http://b.com/2#frag")),
        page(1, "http://b.com/2", refresh.format("/3?x=1&amp;y=2")),
        page(2, "http://b.com/3?x=1&y=2", canonical.format("//c.net/spam")),  # a blocked URL that is no page here
        page(3, "http://d.com/1", canonical.format("http://e.net/x")),
        page(4, "http://e.net/x", canonical.format("http://f.org/fr/ok")),  # an allowed alias
        page(5, "http://g.org/fr/", canonical.format("http://c.net/spam")),  # a rule of its own
        page(6, "http://h.com/dir/x", canonical.format("y")), page(7, "http://h.com/dir/y"), page(8, "http://i.com/"),
        page(9, "http://a.com/1#there"), page(None, "http://a.com/1"),
    ]
    found, _ = judge(spark, rows)
    verdicts = {i: v[3] for i, v in found.items()}
    # g.org/fr/ is an alias of c.net/spam and allowed by rule, so that group is not blocked
    assert verdicts == {0: "allow", 1: "allow", 2: "allow", 3: "allow", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "allow", 9: "allow", None: "allow"}
    found, _ = judge(spark, [r for r in rows if r[0] != 5])
    assert [found[i][3] for i in (0, 1, 2, 9, None)] == ["block"] * 5 and found[8][3] == "allow"
    assert judge(spark, rows, [("h.com", "/dir/y", "block")])[0][6][3] == "block"


def test_longest_rule_and_empty_tables(spark):
    rules = [("com", "/a", "block"), ("x.com", "/", "allow"), ("com", "/ab/", "block"), ("x.com", "/ab", "block"), ("x.com", "/ab", "allow")]
    found, _ = judge(spark, [page(0, "http://x.com/ab/"), page(1, "http://y.com/abc")], rules)
    assert (found[0][2:], found[1][2:]) == (("x.com/ab", "allow"), ("com/a", "block"))
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    table = spark.createDataFrame(rules, "host string, path string, action string")
    assert urls.judge(pages, table, urls.page_links(pages)).count() == 0
    one = spark.createDataFrame([(1, "http://x.com/ab/", None)], "page_id bigint, url string, html string")
    assert urls.judge(one, table.where("false"), urls.page_links(one)).first().verdict == "allow"
