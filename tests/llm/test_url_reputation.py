from tidemark.llm import url_reputation as urls

PAGES = "page_id long, url string, html string"
OUTCOMES = "page_id long, good int"


def test_hosts_paths_and_rules(spark):
    given = {
        "HTTP://WWW.Example.ORG/en/1?x": ("www.example.org", "/en/1", "example.org/en/1", "block"),
        "http://example.org/en/2#a?b": ("example.org", "/en/2", "org/", "allow"),
        "http://a.example.org/es/x": ("a.example.org", "/es/x", "example.org/es/", "block"),
        "http://notexample.org": ("notexample.org", "", None, None),
        "http://b.com?u=http://c.org/": ("b.com", "", None, None),
        "http://b.com/de/": ("b.com", "/de/", "com/de/", "block"),
        "http://com/fr/x": ("com", "/fr/x", "com/fr/", "allow"),
        "http://xcom/fr/x": ("xcom", "/fr/x", None, None),
        "x/y": ("", "", None, None),
        None: ("", "", None, None),
        "://ÄB.de:80/p": ("Äb.de:80", "/p", None, None),
    }
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(given)], PAGES)
    none = spark.createDataFrame([], OUTCOMES)
    got = urls.judge_urls(pages, none, urls.RULES).orderBy("page_id").collect()
    assert len(got) == len(given)
    for row, (host, path, rule, verdict) in zip(got, given.values()):
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict if rule else row.verdict in ("allow", "block")


def test_levels_of_a_host(spark):
    pages = spark.createDataFrame(
        [(i, f"http://{h}/", "") for i, h in enumerate(["a.b.co.uk", "b.co.uk", "x.y.com:8080", "localhost"])], PAGES)
    got = [tuple(r) for r in urls.with_parts(pages).orderBy("page_id").select("suffix", "domain").collect()]
    assert got == [("co.uk", "b.co.uk"), ("co.uk", "b.co.uk"), ("com", "y.com"), ("localhost", "localhost")]


def test_bad_hosts_are_blocked_and_unknown_ones_shrunk(spark):
    rows, outcomes = [], []
    for host, good, bad in (("a.good.com", 60, 2), ("b.good.com", 1, 0), ("a.bad.net", 3, 60), ("b.bad.net", 0, 0),
                            ("c.good.com", 0, 1)):
        for k in range(good + bad + 1):
            rows.append((len(rows), f"http://{host}/p", ""))
            if k < good + bad:
                outcomes.append((len(rows) - 1, int(k < good)))
    pages = spark.createDataFrame(rows + [rows[0]], PAGES)
    known = spark.createDataFrame(outcomes + [(5, None)], OUTCOMES)
    got = {(r.host, r.verdict): r.good_bound for r in urls.judge_urls(pages, known, []).collect()}
    verdicts = dict(got.keys())
    assert verdicts["a.good.com"] == "allow" and verdicts["a.bad.net"] == verdicts["b.bad.net"] == "block"
    bound = {h: b for (h, _), b in got.items()}
    assert bound["a.good.com"] > bound["b.good.com"] > bound["c.good.com"] > bound["a.bad.net"]
    assert urls.judge_urls(pages, known, []).count() == len(rows) + 1


def test_main_path_has_no_python(spark):
    pages = spark.sql("SELECT 1L AS page_id, 'http://a.org/' AS url, '' AS html")
    known = spark.sql("SELECT 1L AS page_id, 1 AS good")
    plan = urls.judge_urls(pages, known, urls.RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
