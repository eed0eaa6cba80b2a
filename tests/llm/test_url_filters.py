"""URL verdicts against a plain Python tree."""

import math
import re
from collections import defaultdict

import pytest

from tidemark.llm import url_filters as uf
from tidemark.llm.catalog import URL_RULES

SMALL = "/root/testdata/sf0.01"


def _split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def _rule(host, path):
    best = None
    for kind, h, p in URL_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[1]):
                best = (kind, h + p)
    return best or (None, None)


def _form(segment):
    m = re.search(r"\.[A-Za-z][A-Za-z0-9]{0,4}$", segment)
    ending = m[0] if m else ""
    stem = segment[: len(segment) - len(ending)]
    digits = len(re.sub("[^0-9]", "", stem))
    if re.match(r"[0-9]+([-_.][0-9]+)*\Z", stem):
        return "{n}" + ending.lower()
    if re.match(r"[0-9a-fA-F-]{8,}\Z", stem) and digits:
        return "{hex}" + ending.lower()
    if len(stem) >= 12 and digits >= 3:
        return "{id}" + ending.lower()
    return segment


def _log_likelihood(good, n):
    return sum(part * math.log(part / n) for part in (good, n - good) if part)


def _templates(counted):
    """Template of every (host, path), level by level; ``counted`` has labels and good ones."""
    forms = {key: [_form(s) for s in key[1].split("/") if s] for key in counted}
    prefix = {key: "" for key in counted}
    for depth in range(uf.DEPTH):
        nodes = defaultdict(lambda: defaultdict(lambda: [0, 0]))
        for key, (labelled, good) in counted.items():
            if len(forms[key]) > depth:
                cell = nodes[key[0], prefix[key]][forms[key][depth]]
                cell[0] += labelled
                cell[1] += good
        named = {}
        for node, branches in nodes.items():
            all_n = sum(n for n, _ in branches.values())
            all_good = sum(g for _, g in branches.values())
            bar = math.log(2 * max(sum(n > 0 for n, _ in branches.values()), 1) / uf.ALPHA)
            for segment, (n, g) in branches.items():
                apart = _log_likelihood(g, n) + _log_likelihood(all_good - g, all_n - n)
                ratio = apart - _log_likelihood(all_good, all_n)
                literal = segment.startswith("{") or (0 < n < all_n and ratio >= bar)
                named[node, segment] = segment if literal else "*"
        for key in counted:
            if len(forms[key]) > depth:
                node = key[0], prefix[key]
                prefix[key] += "/" + named[node, forms[key][depth]]
    return {key: (prefix[key] or "/") + ("/**" if len(forms[key]) > uf.DEPTH else "")
            for key in counted}


def _plain(pages, labels):
    good = {}
    for page_id, g in labels:
        if g is not None:
            good[page_id] = min(good.get(page_id, True), g)
    counted = defaultdict(lambda: [0, 0])
    for page_id, url in pages:
        cell = counted[_split(url)]
        cell[0] += page_id in good
        cell[1] += good.get(page_id, False)
    templates = _templates(counted)

    def template(host, path):
        return templates[host, path]

    per, hosts, total = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0]), [0, 0]
    for page_id, url in pages:
        if page_id in good:
            host, path = _split(url)
            for cell in (per[(host, template(host, path))], hosts[host], total):
                cell[0] += 1
                cell[1] += good[page_id]
    whole = total[1] / total[0] if total[0] else 1.0
    out = []
    for page_id, url in pages:
        host, path = _split(url)
        kind, rule = _rule(host, path)
        name = template(host, path)
        prior = (hosts[host][1] + uf.WEIGHT * whole) / (hosts[host][0] + uf.WEIGHT)
        purity = (per[(host, name)][1] + uf.WEIGHT * prior) / (per[(host, name)][0] + uf.WEIGHT)
        verdict = kind or ("block" if purity < uf.PURITY else "allow")
        out.append((page_id, host, path, rule, verdict, name, round(purity, 9)))
    return sorted(out, key=repr)


def _check(pages, labels):
    got = [(*tuple(r)[:6], round(r["purity"], 9)) for r in
           uf.judge(pages, labels, URL_RULES).collect()]
    expected = _plain([(r["page_id"], r["url"]) for r in pages.collect()],
                      [(r["page_id"], r["good"]) for r in labels.collect()])
    assert sorted(got, key=repr) == expected
    return got


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    labels = uf.labels_by_path(pages, spark.read.parquet(f"{SMALL}/labels.parquet"))
    got = _check(pages, labels)
    assert {r[3] for r in got} <= {"net/", "example.net/en/", "example.com/de/", "org/fr/", None}


def test_bad_branches_are_split_off_and_blocked(spark):
    rows = [(i, f"http://h.com/{'spam' if i % 4 == 0 else 'news'}/{i}.html") for i in range(400)]
    rows += [(1000 + i, f"http://h.com/tag{chr(97 + i % 26)}/x{i}") for i in range(52)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 4 != 0) for i in range(0, 400, 3)],
                                   "page_id long, good boolean")
    got = {r[0]: r for r in _check(pages, labels)}
    assert got[0][4] == "block" and got[0][5] == "/spam/{n}.html"
    assert got[1][4] == "allow"
    assert got[1000][5] == "/*/*"


def test_bad_sections_of_a_wide_host_are_blocked(spark):
    """Two hundred sections of equal size, forty of them all bad."""
    rows = [(i, f"http://h.com/section{i % 200}-x/{i}", i % 200 >= 40) for i in range(4000)]
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "page_id long, good boolean")
    got = {r[0]: r[4] for r in _check(pages, labels)}
    assert all(got[i] == ("allow" if good else "block") for i, _, good in rows)


def test_what_hangs_below_merged_branches_is_judged_together(spark):
    """Sixty folders, each with four bad pages in one place and four good ones in another."""
    rows = [
        (i, f"http://h.com/user{chr(97 + i % 60 // 8)}{chr(97 + i % 60 % 8)}/"
            f"{'spam' if i % 2 else 'news'}/p{i}.x", i % 2 == 0)
        for i in range(480)
    ]
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "page_id long, good boolean")
    got = {r[0]: r for r in _check(pages, labels)}
    assert all(got[i][4] == ("allow" if good else "block") for i, _, good in rows)
    assert got[1][5].startswith("/*/spam/")


def test_few_labels_split_nothing(spark):
    rows = [(i, f"http://h.com/{'ab'[i % 2]}/x") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(0, True), (1, False), (2, True), (3, False)],
                                   "page_id long, good boolean")
    assert {r[5] for r in _check(pages, labels)} == {"/*/*"}


def test_deep_paths_end_in_one_wildcard(spark):
    rows = [(i, "http://h.com/" + "/".join("abcdefghij"[: i + 1])) for i in range(10)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(1, True)], "page_id long, good boolean")
    got = {r[0]: r[5] for r in _check(pages, labels)}
    assert got[5] == "/*" * 6 and got[6] == got[9] == "/*" * 6 + "/**"


HARD = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.NET/en/x", "http://net/en/1?q",
    "http://example.net/en", "http://example.net/en/", "http://a.example.com/de/#t",
    "http://xexample.com/de/1", "http://org/fr/", "http://x.org/fr/a?b://c/d", "a://b://c/d/e",
    "http://ÄÖ.org/fr/é/12.html", "http://x.org?p=/fr/", "http://x.com//a///b", "x://h/{n}/y",
    "http://h/deadbeef01/" + "y" * 5000, "http://h/2024-01-02/article-123456789.HTML",
]


@pytest.mark.parametrize("labelled", [True, False])
def test_hard_urls(spark, labelled):
    rows = [(i, u, "x", "y") for i, u in enumerate(HARD)] + [(3, "://", "x", "y"), (None, None, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    marks = [(i, None if i == 5 else bool(i % 3)) for i in range(len(HARD))] + [(2, False)]
    labels = spark.createDataFrame(marks if labelled else [], "page_id long, good boolean")
    _check(pages, labels)


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    labels = spark.createDataFrame([(1, True)], "page_id long, good boolean")
    assert uf.judge(pages, labels, URL_RULES).isEmpty()


def test_no_python_in_the_plan(spark, plan):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    labels = uf.labels_by_path(pages, spark.read.parquet(f"{SMALL}/labels.parquet"))
    text = plan(uf.judge(pages, labels, URL_RULES))
    assert not re.search("Python|Pandas|Arrow|Cartesian", text)
