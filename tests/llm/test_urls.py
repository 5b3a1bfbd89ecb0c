"""List rules and host reputations."""

import pytest

from skygrid.llm import queries, urls

SCHEMA = "page_id long, url string, host string, rule int"


def test_rules_and_parts(spark):
    rows = [
        (1, "https://WWW.Example.ORG/es/1?x"), (2, "http://example.org/en/12#a"), (3, "http://example.org/en/2"), (4, "http://badexample.org/es/1"),
        (5, "x.com/fr/"), (6, None), (7, "s://a.com/de/x"), (8, "s://a.com/de"), (9, "http://org"), (10, "http://É.com/FR/"), (11, "a://b://c.com/fr/1"), (1, "https://WWW.Example.ORG/es/1?x"),
    ]
    pages = spark.createDataFrame([(*r, "h", 1) for r in rows], SCHEMA)
    none = spark.createDataFrame([], "page_id long, bad int")
    out = urls.judge(pages, none, queries.URL_RULES).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out}
    assert len(out) == 12
    assert got[1] == ("www.example.org", "/es/1", "example.org/es/", "block")
    assert got[2] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[3] == ("example.org", "/en/2", "org/", "allow")
    assert got[4] == ("badexample.org", "/es/1", "org/", "allow")
    assert got[5] == got[6] == ("", "", None, "allow")
    assert got[7] == ("a.com", "/de/x", "com/de/", "block")
    assert got[8] == ("a.com", "/de", None, "allow")
    assert got[9] == ("org", "", None, "allow")
    assert got[10] == ("É.com", "/FR/", None, "allow")
    assert got[11][:2] == ("b:", "//c.com/fr/1")


def test_bad_hosts_are_shrunk_towards_their_parents(spark):
    hosts = [(f"h{i}.good.net", 200, 10 + i % 5) for i in range(40)] + [("spam.bad.net", 200, 190), ("tiny.good.net", 1, 1), ("new.bad.net", 0, 0), ("", 0, 0)]
    out = {r.host: r for r in urls.reputations(spark.createDataFrame(hosts, "host string, n long, bad long")).collect()}
    assert len(out) == len(hosts)
    assert out["spam.bad.net"].bad_low > 0.8
    assert out["tiny.good.net"].bad_mean < 0.5  # one bad page says little
    assert out["new.bad.net"].bad_mean > out["tiny.good.net"].bad_mean  # its domain is bad
    assert 0 <= out[""].bad_mean <= 1
    assert all(r.alpha > 0 and r.beta > 0 for r in out.values())


def test_reputation_blocks_pages(spark):
    rows = [(i, f"http://spam.example.net/x/{i}") for i in range(60)] + [(100 + i, f"http://fine{i % 7}.example.net/x/{i}") for i in range(200)]
    pages = spark.createDataFrame([(*r, "h", 1) for r in rows], SCHEMA)
    bad = spark.createDataFrame([(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(150)] + [(7, None)], "page_id long, bad int")
    out = {r.page_id: r.verdict for r in urls.judge(pages, bad, ()).collect()}
    assert all(out[i] == "block" for i in range(60)) and all(out[100 + i] == "allow" for i in range(200))


def test_no_pages(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert urls.judge(none, spark.createDataFrame([], "page_id long, bad int"), queries.URL_RULES).count() == 0
    assert urls.outcomes_by_host(none, spark.createDataFrame([], "page_id long, bad int")).count() == 0


@pytest.mark.parametrize("rules", [(), queries.URL_RULES])
def test_longest_rule_is_one_expression(spark, rules):
    from pyspark.sql import functions as F

    row = spark.range(1).select(urls.longest_rule(F.lit("a.org"), F.lit("/x"), rules).alias("r")).first()
    assert (row.r.rule if row.r else None) == ("org/" if rules else None)


def test_sites_under_a_shared_suffix_are_apart(spark):
    from pyspark.sql import functions as F

    want = {"a.b.co.uk": ("co.uk", "b.co.uk"), "co.uk": ("co.uk", "co.uk"), "me.github.io": ("github.io", "me.github.io"), "x.a.com": ("com", "a.com"), "com": ("com", "com"), "": ("", "")}
    rows = spark.createDataFrame([(h,) for h in want], "host string").select("host", urls.suffix_of(F.col("host")).alias("s"), urls.domain_of(F.col("host")).alias("d"))
    assert {r.host: (r.s, r.d) for r in rows.collect()} == want
    given = spark.createDataFrame([("w.x.y.z",)], "host string").select(urls.domain_of(F.col("host"), ["y.z"]).alias("d"), urls.domain_of(F.col("host"), ["x.y.z", "y.z"]).alias("e")).first()
    assert tuple(given) == ("x.y.z", "w.x.y.z")
    # A bad site under co.uk says as little about another there as under a suffix of one label.
    for suffix in ("co.uk", "net"):
        hosts = [(f"www.s{i}.{suffix}", 200, 10 + i % 5) for i in range(40)] + [(f"h{i}.spam.{suffix}", 200, 190) for i in range(5)] + [(f"new.spam.{suffix}", 0, 0), (f"new.{suffix}", 0, 0)]
        out = {r.host: r.bad_mean for r in urls.reputations(spark.createDataFrame(hosts, "host string, n long, bad long")).collect()}
        assert out[f"new.spam.{suffix}"] > 0.8 and out[f"new.{suffix}"] < 0.3, suffix


def test_repeated_pages_and_outcomes_count_once(spark):
    """A page of fifty rows, whose outcome has fifty rows, is one outcome."""
    pages = spark.createDataFrame([(1, "a.com")] * 50 + [(2, "a.com"), (3, "a.com"), (None, "a.com"), (4, "b.org")], "page_id long, host string")
    outcomes = spark.createDataFrame([(1, 1)] * 50 + [(2, 0), (2, 0), (3, 0), (3, 1), (None, 1), (4, None)], "page_id long, bad int")
    found = {r.host: (r.n, r.bad) for r in urls.outcomes_by_host(pages, outcomes).collect()}
    assert found == {"a.com": (3, 2), "b.org": (0, 0)}
