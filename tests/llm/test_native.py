"""URL filters and quality rules: SQL twins on the given tables, brute force on edge rows."""

import random
import re
from collections import Counter

import pytest
from compare import connect, differences
from support import docs_frame, rows_of

from tidegate.llm import quality_rules, url_filters
from tidegate.llm.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None


# --- URL filters ------------------------------------------------------------------

RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
    ("a.b.org", "/fr/x", "block"), ("tie.io", "/", "allow"), ("tie.io", "/", "block"), (None, "/", "block"), ("", "/p", "block"), ("x", "", "block"),
]


def slow_verdict(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(raw) :], re.S)[0]
        host = raw.translate({c: c + 32 for c in range(65, 91)})
    best = (-1, False, None)
    for h, p, verdict in RULES:
        if h is not None and (host == h or host.endswith("." + h) or (h == "" and host.endswith("."))) and path.startswith(p):
            best = max(best, (len(h + p), verdict == "block", h + p), key=lambda x: x[:2])
    return host, path, best[2], "allow" if best[2] is None else "block" if best[1] else "allow"


def urls():
    rng = random.Random(6)
    fixed = [None, "", "no scheme", "://", "http://", "http://NET", "http://net/", "http://x.Net/en/", "HTTP://Example.NET/en/1?q#f", "http://example.net?/en/",
             "http://notexample.com/de/", "http://w.example.com/de/\nx", "http://a.b.org/fr/xyz", "http://tie.io/", "http://É.net/É", "ftp://u:p@h.net:80/p", "http://x", "http://q.x/p",
             "http://" + "a." * 3000 + "net/" + "p/" * 3000, "http:///p", "http://a..net/x#://b.org/fr/"]
    hosts = ["net", "a.net", "example.net", "z.example.com", "b.org", "a.b.org", "c.a.b.org", "tie.io"]
    made = [f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/en/', '/de/1', '/fr/x', '/fr', '?a', '#/fr/'])}" for _ in range(150)]
    return fixed + made


def test_verdicts_against_definition(spark):
    data = [(k % 120, url) for k, url in enumerate(urls())] + [(None, "http://a.net/"), (5, "same"), (5, "same")]
    pages = spark.createDataFrame(data, "page_id bigint, url string").selectExpr("*", "1 AS host", "'x' AS verdict", "2 AS key", "3 AS best", "4 AS copies")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = rows_of(url_filters.judge(pages, rules))
    assert Counter(got) == Counter((page, *slow_verdict(url)) for page, url in data)


def test_no_rules_and_no_pages(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    assert rows_of(url_filters.judge(pages, rules.limit(0))) == [(1, "a.net", "/", None, "allow")]
    assert rows_of(url_filters.judge(pages.limit(0), rules)) == []


# --- quality rules ----------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_measures(text):
    text = text or ""
    words = WORD.findall(text)
    places = {}
    for k in range(len(words) - 2):
        places.setdefault(tuple(words[k : k + 3]), []).append(k)
    covered = {k + d for own in places.values() if len(own) > 1 for k in own for d in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n, repeats = len(words), len(covered)
    failed = n < 50 or 100 * repeats > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeats, failed


def texts():
    rng = random.Random(8)
    out = [None, "", " \n\t", "a", "a b c", "a b c a b c", "x\x0by\x0cz\r\n", "a\n\na\n a\na ", "\xa0 \x85", "漢字 😀 é́", "#*$%&|<>", "w " * 20_000, "one two three " * 30]
    for _ in range(60):
        out.append("".join(rng.choice(["a", "b", "cc", "\n", " ", "  ", "\t", "|", "é"]) + rng.choice(["", " "]) for _ in range(rng.randint(1, 200))))
    return out


def test_measures_against_definition(spark):
    data = [(k, t) for k, t in enumerate(texts())] + [(3, "a"), (None, "b")]
    docs = docs_frame(spark, [(k, t, f"s{(k or 0) % 3}") for k, t in data], "doc_id bigint, text string, source string")
    got = quality_rules.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(rows_of(got)) == Counter((k, *slow_measures(t)) for k, t in data)


def test_host_verdicts(spark):
    good = " ".join(f"word{k}" for k in range(60))
    noisy = " ".join(f"#w{k}#" for k in range(60))  # passes the base rules, fails the symbol rule
    rows = [(k, good, "clean") for k in range(40)] + [(100 + k, noisy, "junk") for k in range(30)] + [(200, good, "junk")]
    rows += [(300, noisy, "small"), (301, noisy, None), (302, good, None), (303, "few words", "clean")]
    for h in range(12):
        rows += [(1000 + 10 * h + k, good, f"host{h}") for k in range(10)]
    got = {r["doc_id"]: r for r in quality_rules.judge(docs_frame(spark, rows, "doc_id bigint, text string, source string")).collect()}
    assert not any(got[k]["kept"] for k in [*range(100, 130), 200]) and got[200]["host_blocked"]
    assert all(got[k]["kept"] for k in [*range(40), 301, 302]) and not got[303]["kept"]


def test_one_document_does_not_condemn_a_host(spark):
    """Shrinking: a host of one failing document is pulled to the corpus."""
    good, noisy = " ".join(f"word{k}" for k in range(60)), " ".join(f"#w{k}#" for k in range(60))
    rows = [(1000 + 10 * h + k, good, f"host{h}") for h in range(30) for k in range(10)]
    rows += [(5000 + h, noisy, f"host{h}") for h in range(0, 30, 3)] + [(9000, noisy, "single")]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs_frame(spark, rows, "doc_id bigint, text string, source string")).collect()}
    assert got[9000] and all(got.values())


def test_beta_prior():
    assert quality_rules.beta_prior(0, 0, 0, 0.0) == (0.5, 0.5)
    alpha, beta = quality_rules.beta_prior(10, 1000, 200, 1000 * 0.04 + 1.6)
    assert abs(alpha / (alpha + beta) - 0.2) < 1e-9 and 1 <= alpha + beta <= 1000
    low, high = quality_rules.beta_prior(10, 1000, 200, 1000 * 0.04 + 100.0), quality_rules.beta_prior(10, 1000, 200, 1000 * 0.04)
    assert sum(low) < sum(high) == 1000


def test_empty_documents(spark):
    docs = docs_frame(spark, [], "doc_id bigint, text string, source string")
    assert rows_of(quality_rules.judge(docs)) == []
