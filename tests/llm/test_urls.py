from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from brokerflow.llm import urls
from brokerflow.llm.queries import RULES

SCHEMA = "page_id long, url string, html string, gram string, host int, rule long, row string, score int"
ODD = [
    None, "", "no address", "http://", "://", "https://example.org", "https://example.org?x=/es/", "https://EXAMPLE.org/es/A#b", "https://example.org/ES/", "ftp://a.b.org/x",
    "http://org/", "http://norg/fr/", "http://x.com/fr/é\U0001f600?q", "http://com/de/", "http://a.example.org/en/1", "http://example.org/en/2", "a://b://c.org/", "http://u@x.com:80/fr/",
    "http://Straße.COM/fr/\n/x\n?y", "x" * 3000, "http://x.net/" + "a/" * 4000,
]


def frame(spark, held):
    return spark.createDataFrame([(i, u, "<p>", "g", 1, 2, "r", 3) for i, u in held], SCHEMA).repartition(3)


def slow_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = next((rest[:k] for k, c in enumerate(rest) if c in "/?#"), rest)
    path = rest[len(host) :]
    path = next((path[:k] for k, c in enumerate(path) if c in "?#"), path)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def slow_rule(host, path, rules):
    best = (None, None)
    for said, rule in rules:
        own, begin = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == own or host.endswith("." + own)) and path.startswith(begin) and len(rule) > len(best[0] or ""):
            best = (rule, said)
    return best


def slow_model(texts, order):
    """Probability of a character after a context, from counts of all context lengths."""
    after = defaultdict(Counter)
    for t in texts:
        marked = urls.BEFORE * order + t + urls.AFTER
        for i in range(order, len(marked)):
            for k in range(order + 1):
                after[marked[i - k : i]][marked[i]] += 1

    def p(context, char):
        shorter = p(context[1:], char) if context else urls.UNKNOWN
        seen = after.get(context)
        return (seen[char] + len(seen) * shorter) / (sum(seen.values()) + len(seen)) if seen else shorter

    return p


def slow_score(text, allow, block, order):
    marked = urls.BEFORE * order + text + urls.AFTER
    each = [math.log(allow(marked[i - order : i], marked[i])) - math.log(block(marked[i - order : i], marked[i])) for i in range(order, len(marked))]
    return sum(each) / len(each)


def addresses(n, seed=1):
    r = random.Random(seed)
    host = lambda: r.choice(["", "www.", "m."]) + r.choice(["tion", "therr", "example", "shop"]) + r.choice([".org", ".com", ".net", ".example.org"])
    return [(i, f"http://{host()}/{r.choice(['en', 'es', 'de', 'fr'])}/{r.randrange(3000)}{r.choice(['', '.html', '?page=2', '#top'])}") for i in range(n)]


def check(spark, held, order=urls.ORDER, **given):
    got = urls.judge(frame(spark, held), RULES, order=order, **given).collect()
    told = [(i, u or "", *slow_parts(u), *slow_rule(*slow_parts(u), RULES)) for i, u in held]
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in got) == Counter((i, h, p, rule) for i, _, h, p, rule, _ in told)
    share = given.get("held", urls.HELD)
    fold = {r["url"]: r["own"] for r in spark.createDataFrame([(u,) for u in {t[1] for t in told}], "url string").select("url", (F.pmod(F.xxhash64("url"), F.lit(100)) < share).alias("own")).collect()}
    learned = {k: [u for _, u, _, _, _, said in told if said == k and not fold[u]] for k in ("allow", "block")}
    allow, block = slow_model(learned["allow"], order), slow_model(learned["block"], order)
    scores = {u: slow_score(u, allow, block, order) for _, u, _, _, _, said in told if said is None or fold[u]}
    url_of = defaultdict(list)
    for i, u, *_ in told:
        url_of[i].append(u)
    for r in got:
        if r["score"] is not None:
            assert any(math.isclose(r["score"], scores.get(u, math.nan), rel_tol=1e-9, abs_tol=1e-9) for u in url_of[r["page_id"]])
    limit = slow_threshold([(scores[u], said) for _, u, _, _, _, said in told if said and fold[u]])
    said_of = {(i, u): said or ("allow" if scores[u] >= limit else "block") for i, u, _, _, _, said in told}
    assert Counter((r["page_id"], r["verdict"]) for r in got) == Counter((i, said_of[(i, u)]) for i, u, *_ in told)
    return got, limit


def slow_threshold(judged, step=urls.STEP):
    cells = sorted({math.floor(s / step) for s, _ in judged})
    allow, block = (sum(said == k for _, said in judged) for k in ("allow", "block"))
    if not allow or not block:
        return 0.0
    gain = lambda cell: sum((said == "block") / block - (said == "allow") / allow for s, said in judged if math.floor(s / step) < cell)
    best = min(((-round(gain(b), 9), b, a) for a, b in zip(cells, cells[1:], strict=False)), default=None)
    return 0.0 if best is None or best[0] >= 0 else step * (best[2] + 1 + best[1]) / 2


@pytest.mark.parametrize("order", [0, 2, 4])
def test_verdicts_equal_brute_force(spark, order):
    held = addresses(150) + [(1000 + i, u) for i, u in enumerate(ODD)] + [(None, "http://a.net/"), (3, "http://same.id.net/"), (4, None)] + addresses(20)
    got, limit = check(spark, held, order)
    assert order == 0 or limit != 0
    assert {r["verdict"] for r in got if r["rule"] is None} == {"allow", "block"}


def test_a_table_of_ratios_that_cannot_be_broadcast(spark, no_broadcast):
    check(spark, addresses(60) + [(500 + i, "http://hot.net/en/5") for i in range(60)], 2)


def test_verdicts_of_held_out_addresses(spark):
    got = urls.judge(frame(spark, addresses(3000)), RULES).where("rule is not null and score is not null").collect()
    right = [(r["score"] > 0) == (r["verdict"] == "allow") for r in got]
    assert len(right) > 200 and sum(right) / len(right) > 0.9


def test_longest_rule_counts_and_rules_are_the_callers(spark):
    rules = (("allow", "net/"), ("block", "b.net/x"), ("block", "b.net/"), ("allow", "b.net/x/y"))
    held = [(1, "http://b.net/x/y/z"), (2, "http://a.b.net/xx"), (3, "http://c.net/"), (4, "http://b.net/"), (5, "http://b.nets/")]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(frame(spark, held), rules).collect()}
    assert got[1] == ("b.net/x/y", "allow") and got[2] == ("b.net/x", "block") and got[3] == ("net/", "allow") and got[4] == ("b.net/", "block") and got[5][0] is None


def test_one_kind_alone_or_none(spark):
    assert urls.judge(frame(spark, []), RULES).count() == 0
    assert {r["verdict"] for r in urls.judge(frame(spark, [(1, "http://a.net/"), (2, None)]), RULES).collect()} <= {"allow", "block"}
    only = [(i, f"http://a.org/en/{i}") for i in range(30)] + [(99, "http://a.net/en/1")]
    assert urls.judge(frame(spark, only), RULES).where("page_id = 99").first()["verdict"] in ("allow", "block")


def test_no_python_in_the_plan(spark):
    plan = urls.judge(frame(spark, addresses(30)), RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
