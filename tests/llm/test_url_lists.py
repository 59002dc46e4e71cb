import datetime as dt
import random

from meterline.llm import queries, url_lists
from tests.conftest import SF01
from tools.check_oracles import compare, duck

D = dt.date
EVENTS = "list_name string, policy string, kind string, pattern string, action string, day date"
CAPTURE = "n int, url string, fetched_on date, blocked string, kind string"


def judge(captures, events):
    """Every capture against every active entry."""
    spans = {}
    for name, policy, kind, pattern, action, day in events:
        if pattern is not None and day is not None and action in ("add", "remove"):
            days = spans.setdefault((name, policy, kind, pattern), {})
            days[day] = days.get(day, True) and action == "add"
    out = []
    for n, url, day, *_ in captures:
        hits = []
        host = None
        if url is not None and "://" in url:
            host = url.split("://", 1)[1].split("/")[0].split("?")[0].split("#")[0].split("@")[-1].split(":")[0].lower() or None
        for (name, policy, kind, pattern), days in spans.items():
            if day is None or not any(d <= day for d in days):
                continue
            before = max(d for d in days if d <= day)
            match = kind == "url" and url is not None and url.split("#")[0] == pattern or kind == "domain" and host and (host == pattern or host.endswith("." + pattern))
            if match and days[before]:
                hits.append((kind == "url", len(pattern), policy == "allow", name, pattern))
        top = max(hits, default=None)
        out.append((n, bool(top) and not top[2], top and top[3], top and top[4]))
    return sorted(out, key=str)


def test_against_all_pairs(spark):
    rng = random.Random(4)
    hosts = ["a.example", "b.a.example", "c.b.a.example", "example", "x.test", "A.Example"]
    urls = [f"http://{h}/{p}" for h in hosts for p in ("", "p?q=1", "q#frag")] + ["https://user:pw@x.test:8080/p", None, "", "no url", "http:///x", "http://" + "l." * 300 + "example/"]
    days = [D(2024, 1, 1) + dt.timedelta(k) for k in range(20)]
    events = [(rng.choice(["l1", "l2"]), "block", "domain", rng.choice(hosts[:5]), rng.choice(["add", "remove"]), rng.choice(days)) for _ in range(60)]
    events += [("ok", "allow", "domain", "b.a.example", "add", days[3]), ("ok", "allow", "domain", "b.a.example", "remove", days[15]),
               ("l3", "block", "url", "http://a.example/q", "add", days[5]), ("l3", "block", "url", None, "add", days[5]), ("l3", "block", "domain", "x.test", "add", None),
               ("l3", "block", "domain", "x.test", "other", days[0])]
    captures = [(n, rng.choice(urls), rng.choice([*days, None]), "old", "k") for n in range(300)]
    got = url_lists.filter_captures(spark.createDataFrame(captures, CAPTURE), spark.createDataFrame(events, EVENTS))
    assert got.columns == ["n", "url", "fetched_on", "kind", "blocked", "matched_list", "matched_pattern", "listed_from"]
    assert sorted([(r.n, r.blocked, r.matched_list, r.matched_pattern) for r in got.collect()], key=str) == judge(captures, events)


def test_empty(spark):
    captures = spark.createDataFrame([(1, "http://a.example/", D(2024, 1, 1), "", "")], CAPTURE)
    none = spark.createDataFrame([], EVENTS)
    assert [r.blocked for r in url_lists.filter_captures(captures, none).collect()] == [False]
    assert url_lists.filter_captures(captures.limit(0), none).count() == 0


def test_query_equals_its_oracle(spark):
    df = queries.QUERIES["op7_url_lists"](spark, SF01)
    cur = duck(SF01).execute(queries.ORACLES["op7_url_lists"])
    assert compare([tuple(r) for r in df.collect()], df.columns, cur.fetchall(), [d[0] for d in cur.description]) is None
