import pytest

from sitelens.llm import url_rules


def judged(spark, urls, **options):
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'own' AS host", "'own' AS token")
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge_urls(frame, **options).collect()}


CASES = [
    ("http://A.Example.NET/en/1?x#y", ("a.example.net", "/en/1", "example.net/en/", "allow")),
    ("http://example.net/EN/1", ("example.net", "/EN/1", "net/", "block")),
    ("http://notexample.net/en/", ("notexample.net", "/en/", "net/", "block")),
    ("http://example.com/de/", ("example.com", "/de/", "example.com/de/", "block")),
    ("http://example.com/de", ("example.com", "/de", None, "allow")),
    ("http://x.org/fr/a/http://y.net/", ("x.org", "/fr/a/http://y.net/", "org/fr/", "allow")),
    ("http://a.net", ("a.net", "", None, "allow")),
    ("http://a.net?q=/", ("a.net", "", None, "allow")),
    ("http://a.net:80/", ("a.net:80", "/", None, "allow")),
    ("http://xnet/", ("xnet", "/", None, "allow")),
    ("http://net/", ("net", "/", "net/", "block")),
    ("http://cheap-pills.example.com/x", ("cheap-pills.example.com", "/x", None, "block")),
    ("http://cheap-pills.example.org/fr/x", ("cheap-pills.example.org", "/fr/x", "org/fr/", "allow")),
    ("http://example.com/pills", ("example.com", "/pills", None, "allow")),
    ("http://pillsbury.example.com/", ("pillsbury.example.com", "/", None, "allow")),
    ("HTTP:/a.net/", ("", "", None, "allow")), ("", ("", "", None, "allow")), (None, ("", "", None, "allow")),
    ("://É.net/é", ("É.net", "/é", "net/", "block")), ("http://", ("", "", None, "allow")),
]


def test_cases(spark):
    got = judged(spark, [u for u, _ in CASES] * 2)
    assert [got[i] for i in range(2 * len(CASES))] == [w for _, w in CASES] * 2


def test_rules_without_a_whole_token_still_run(spark):
    rules = [url_rules.site_rule("example.com/en", "block"), url_rules.Rule("any-digit", "[0-9]", "block", (), 0),
             url_rules.site_rule("com", "allow")]
    got = judged(spark, ["http://example.com/english", "http://example.com/x", "http://b.de/7", "http://b.de/"], rules=rules)
    assert [got[i][2:] for i in range(4)] == [("example.com/en", "block"), ("com", "allow"), (None, "block"), (None, "allow")]


@pytest.mark.parametrize("rules", [None, []])
def test_empty(spark, rules):
    assert judged(spark, [], rules=rules) == {}
    assert judged(spark, ["http://a.net/"], rules=[])[0] == ("a.net", "/", None, "allow")


def test_rarest_token(spark):
    rules = url_rules.rule_table(spark, [url_rules.site_rule("example.net/en/", "allow")])
    counts = spark.createDataFrame([("example", 9), ("net", 5), ("en", 7)], "token string, n long")
    assert url_rules.rule_index(rules, counts).first()["token"] == "net"


def test_other_letters_end_tokens_and_words(spark):
    got = judged(spark, ["http://ads\u212a.com/", "http://ads\u00e9.com/", "http://adsk.com/", "http://\u00c9.NET/"])
    assert [got[i][0] for i in range(4)] == ["ads\u212a.com", "ads\u00e9.com", "adsk.com", "\u00c9.net"]
    assert [got[i][3] for i in range(4)] == ["block", "block", "allow", "block"]


def test_rules_from_a_table(spark):
    texts = [*url_rules.SITE_RULES, ("Example.ORG/A\\Eb", "block"), ("com", "block"), ("example.com/en", "allow"), ("\u65e5\u672c/", "block")]
    table = spark.createDataFrame([*texts, (None, "block"), ("", "block"), ("com", "allow")], "rule string, verdict string")
    made = {r["rule_name"]: (r["regex"], r["rule_verdict"], r["weight"], tuple(r["tokens"])) for r in url_rules.site_rules(table).collect()}
    own = [url_rules.site_rule(*x) for x in texts]
    assert made == {r.name: (r.regex, r.verdict, r.weight, r.tokens) for r in own}
    urls = [u for u, _ in CASES] + ["http://example.org/A\\Ebc", "http://x.com/", "http://x.com/english", "http://example.com/english",
                                    "http://\u65e5\u672c/x"]
    got = judged(spark, urls, rules=url_rules.site_rules(table))
    assert got == judged(spark, urls, rules=own)
    assert [got[len(CASES) + i][2] for i in range(5)] == ["Example.ORG/A\\Eb", "com", "com", "example.com/en", "\u65e5\u672c/"]
    assert set(judged(spark, urls, rules=url_rules.site_rules(table.limit(0))).values()) >= {("a.net", "", None, "allow")}
