import inspect
import itertools
import math
import re
from collections import Counter

from finledger.llm import queries, urls


def plain_rule(host, path):
    best = (None, None)
    for verdict, name, start in urls.RULES:
        if (host == name or host.endswith("." + name)) and path.startswith(start):
            if best[0] is None or len(name + start) > len(best[0]):
                best = (name + start, verdict)
    return best


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def test_parts_and_rules(spark):
    links = [
        None, "", "no scheme", "http://", "HTTP://A.Com", "http://a.com/", "https://EXAMPLE.com/en/x?y#z", "x://example.com/en",
        "http://www.example.com/en/1", "http://m.www.example.com/en/", "http://notexample.com/en/", "ftp://b.net/es/?q=://c.com/",
        "http://net/fr/", "http://a.net/fr", "http://É.net/de/#://", "http://a.com?x=/en/", "http://user@h.com:80/p\nq/r", "http://xcom/",
    ]
    pages = spark.createDataFrame([(i, u, "<p>word</p>", i) for i, u in enumerate(links)], "page_id long, url string, html string, host int")
    for r in urls.judge(pages).collect():
        host, path = plain_parts(links[r.page_id])
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)


def test_viterbi_against_all_splits():
    counts = {"the": 50, "re": 9, "th": 20, "there": 2, "rein": 4, "in": 30}
    total, unknown = sum(counts.values()), 9.0
    for label in ["therein", "thein", "xthe", "zzz", "therex", "", "rethin"]:
        known = {
            (a, b): -math.log(counts[label[a:b]] / total)
            for a, b in itertools.combinations(range(len(label) + 1), 2)
            if label[a:b] in counts
        }
        best = math.inf
        for cuts in itertools.product((0, 1), repeat=max(0, len(label) - 1)):
            marks = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(label)]
            cost = sum(known.get(s, unknown * (s[1] - s[0])) for s in itertools.pairwise(marks)) if label else 0
            best = min(best, cost)
        found = urls.best_split(label, known, unknown)
        assert "".join(found) == label
        at, cost = 0, 0.0
        for word in found:
            cost += known.get((at, at + len(word)), unknown * len(word))
            at += len(word)
        assert abs(cost - best) < 1e-9


def test_query_against_plain_bayes(spark, data_dir):
    rows = {r.page_id: r for r in spark.read.parquet(f"{data_dir}/pages.parquet").collect()}
    counts = Counter()
    for r in rows.values():
        counts.update(w for w in re.split("[^a-z]+", re.sub("<[^>]*>", " ", r.html).lower()) if 0 < len(w) <= 15)
    total = sum(counts.values())
    bags, ruled = {}, {}
    for key, r in rows.items():
        host, path = plain_parts(r.url)
        words = []
        for label in re.split(r"[.\-]", host):
            spans = itertools.combinations(range(len(label) + 1), 2)
            known = {(a, b): -math.log(counts[label[a:b]] / total) for a, b in spans if label[a:b] in counts}
            words += ["host:" + w for w in urls.best_split(label, known, math.log(total) * 1.5)]
        shape = re.sub("[0-9]+", "0", path.lower())
        bags[key] = words + ["path:" + w for w in re.split("[^a-z0-9]+", shape) if w]
        ruled[key] = plain_rule(host, path)[1]
    seen = {v: Counter() for v in ("allow", "block")}
    for key, verdict in ruled.items():
        if verdict:
            seen[verdict].update(bags[key])
    size = len({w for bag in bags.values() for w in bag})
    sums = {v: sum(c.values()) for v, c in seen.items()}
    urls_of = Counter(ruled.values())
    for r in queries.QUERIES["op7_url_filter"](spark, data_dir).collect():
        score = math.log(urls_of["block"] / urls_of["allow"])
        for w in bags[r.page_id]:
            score += math.log((seen["block"][w] + 1) / (sums["block"] + size)) - math.log((seen["allow"][w] + 1) / (sums["allow"] + size))
        assert abs(r.score - score) < 1e-6
        assert r.verdict == (ruled[r.page_id] or ("block" if score > 0 else "allow"))


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, w double"
    pages = spark.createDataFrame([(None, "http://a.com/x", None, 1.0), (1, None, None, 2.0), (1, None, None, 2.0)], schema)
    assert sorted((r.page_id or 0, r.verdict) for r in urls.judge(pages).collect()) == [(0, "allow"), (1, "allow"), (1, "allow")]
    assert urls.judge(pages.limit(0)).collect() == []
    blocked = spark.createDataFrame([(1, "http://a.net/es/", "x", 0.0), (2, "http://b.org", "y", 0.0)], schema)
    assert {r.verdict for r in urls.judge(blocked).collect()} == {"block"}


def test_long_words_of_a_host_stay_whole(spark):
    word = "internationalization"
    html = f"<p>{word} {word} of the guide in nation and inter</p>"
    pages = spark.createDataFrame([(1, f"http://{word}guide.org/", html)], "page_id long, url string, html string")
    hosts = spark.createDataFrame([(f"{word}guide.org",)], "host string")
    limit = inspect.signature(urls.judge).parameters["longest"].default
    counts = urls.word_counts(pages, "html", limit)
    assert urls.segmented(hosts, counts, limit).first().words[:2] == [word, "guide"]


def test_very_long_host(spark):
    """A label of two hundred thousand letters is split like any other: words across the stretches are found."""
    words = ["river", "stone", "bridge", "q"]
    name = "".join(words[i * i * 7 % 11 % 4] for i in range(50000))
    hosts = spark.createDataFrame([(f"www.{name}.com",), ("riverstone.net",), ("",)], "host string")
    counts = spark.createDataFrame([("river", 30), ("stone", 20), ("bridge", 10), ("www", 5)], "word string, n long")
    found = {r.host: r.words for r in urls.segmented(hosts, counts, urls.LABEL).collect()}
    assert found["riverstone.net"] == ["river", "stone", "net"]
    long = found[f"www.{name}.com"]
    assert "".join(long) == f"www{name}com" and long[0] == "www" and long[-1] == "com"
    assert Counter(long)["bridge"] == sum(i * i * 7 % 11 % 4 == 2 for i in range(50000))
    total = 65
    known = {(m.start(), m.end()): -math.log(n / total) for w, n in (("river", 30), ("stone", 20), ("bridge", 10)) for m in re.finditer(w, name[:3000])}
    part = urls.best_split(name[:3000], known, math.log(total) * 1.5)
    assert long[1 : len(part) - 2] == part[: len(part) - 3]
