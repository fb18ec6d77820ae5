import edge  # noqa: F401
import pytest

from ledgerline.llm import linkgraph as G

SCHEMA = "page_id long, url string, html string, host int, trust string, kind long"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "x", 2) for i, (u, h) in enumerate(rows)], SCHEMA)


def judged(spark, rows):
    return {r.page_id: r for r in G.verdicts(pages(spark, rows)).collect()}


CASES = [
    ("https://WWW.Example.NET/en/a?x#y", "www.example.net", "/en/a", "example.net/en/", "allow"),
    ("https://example.net/de/", "example.net", "/de/", "net/", "block"),
    ("http://a.net", "a.net", "", None, None),
    ("http://internet/", "internet", "/", None, None),
    ("http://x.example.com/de/1", "x.example.com", "/de/1", "example.com/de/", "block"),
    ("http://notexample.com/de/1", "notexample.com", "/de/1", None, None),
    ("http://b.org/fr/?q", "b.org", "/fr/", "org/fr/", "allow"),
    ("http://org#/fr/", "org", "", None, None),
    ("ftp://u@H:80/p://q", "u@h:80", "/p://q", None, None),
    ("no scheme/net/", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
    ("ÄÖ://ÄÖ.Org/fr/ü", "ÄÖ.org", "/fr/ü", "org/fr/", "allow"),
]


def test_rules(spark):
    rows = judged(spark, [(c[0], None) for c in CASES])
    for i, (_, host, path, rule, verdict) in enumerate(CASES):
        r = rows[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), CASES[i]
        assert r.verdict == (verdict or r.verdict) and (rule or host or r.verdict == "allow")


def link(*hosts):
    return " ".join(f"<a href='http://{h}/'>x</a>" for h in hosts)


def test_distrust_flows_back_and_trust_flows_on(spark):
    rows = [
        ("http://bad.net/", link("innocent.com")),
        ("http://friend.com/", '<a href="https://bad.net/x">x</a>'),
        ("http://friend2.com/", "<A HREF = //Friend.com/y>x</A>"),
        ("http://good.org/fr/", link("praised.com", "mixed.com")),
        ("http://innocent.com/", None), ("http://praised.com/", "<a href='/local'>x</a>"),
        ("http://mixed.com/", link("bad.net")), ("http://alone.com/", ""), ("http://fan.com/", link("good.org")),
    ]
    found = judged(spark, rows)
    # friend.com links to a blocked host and friend2.com to that; mixed.com does, too, but is recommended.
    assert [found[i].verdict for i in range(9)] == ["block", "block", "block", "allow", "allow", "allow", "allow", "allow", "allow"]
    assert (found[1].trust, found[1].distrust) == (0, 1) and (found[6].trust, found[6].distrust) == (1, 1)
    assert found[4].distrust == 0 and (found[7].trust, found[7].distrust) == (0, 0)


def test_many_linkers_of_a_blocked_host(spark):
    """Distrust does not grow thin by being shared; who is linked by them is innocent."""
    n = 30
    rows = [("http://bad.net/", None), *[(f"http://f{i}.com/", link("bad.net", f"i{i}.com")) for i in range(n)], *[(f"http://i{i}.com/", None) for i in range(n)]]
    found = judged(spark, rows)
    assert {found[1 + i].verdict for i in range(n)} == {"block"}
    assert {found[1 + n + i].verdict for i in range(n)} == {"allow"}


def test_a_blocked_section_does_not_condemn_the_host(spark):
    rows = [("http://example.com/de/", None), *[(f"http://example.com/{i}", None) for i in range(3)], ("http://l.com/", link("example.com"))]
    found = judged(spark, rows)
    assert [found[i].verdict for i in range(5)] == ["block", "allow", "allow", "allow", "allow"] and found[4].distrust == 0.25


def test_shares_against_solved_equations(spark):
    """Verdicts of random graphs from the linear equations of both walks."""
    import random

    import numpy as np

    rnd = random.Random(1)
    kinds = ["a.net/", "b.net/", "c.org/fr/", "d.org/fr/", "example.com/de/", "example.com/x"] + [f"h{i}.com/" for i in range(9)]
    hosts = sorted({k.split("/")[0] for k in kinds})
    linked = {k: [h for h in rnd.sample(hosts, rnd.randrange(4)) if h != k.split("/")[0]] for k in kinds}
    found = judged(spark, [(f"http://{k}", link(*linked[k])) for k in kinds])
    edges = {(k.split("/")[0], t) for k, ts in linked.items() for t in ts}
    seed = {"a.net": (0, 1, 0), "b.net": (0, 1, 0), "c.org": (1, 0, 0), "d.org": (1, 0, 0), "example.com": (0, 0.5, 0.5)}
    at = {h: i for i, h in enumerate(hosts)}
    base = np.array([seed.get(h, (0, 0, 0)) for h in hosts])

    def shares(pairs):
        m = np.zeros((len(hosts), len(hosts)))
        for a, b in pairs:
            m[at[b], at[a]] = G.DAMPING / sum(x == a for x, _ in pairs)
        score = np.linalg.solve(np.eye(len(hosts)) - m, base)
        return score / np.maximum(score.sum(1, keepdims=True), 1e-300)

    trust, distrust = shares(edges)[:, 0], shares({(b, a) for a, b in edges})[:, 1]
    for i, k in enumerate(kinds):
        h = at[k.split("/")[0]]
        assert found[i].trust == pytest.approx(trust[h], abs=2e-3) and found[i].distrust == pytest.approx(distrust[h], abs=2e-3)
        if found[i].rule is None and abs(distrust[h] - trust[h] - G.MARGIN) > 5e-3:
            assert found[i].verdict == ("block" if distrust[h] - trust[h] >= G.MARGIN else "allow")


def test_very_long_html(spark):
    found = judged(spark, [("http://bad.net/", None), ("http://long.com/", "<p>text</p>\n" * 200_000 + link("bad.net"))])
    assert found[1].verdict == "block"


def test_plan_has_no_python(spark):
    plan = G.verdicts(pages(spark, [("http://a.net/", "")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_repeated_and_empty(spark):
    rows = judged(spark, [("http://half.com/de/", None)] * 2)
    assert len(rows) == 2 and G.verdicts(pages(spark, []).where("false")).collect() == []
