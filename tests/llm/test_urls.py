import random
import re

import pytest

from medallion.llm.urls import Index, Rule, blocks, judge, token_counts

SITES = [
    Rule("block", "net/", site=True), Rule("allow", "example.net/en/", site=True),
    Rule("block", "example.com/de/", site=True), Rule("allow", "org/fr/", site=True),
    Rule("allow", "a.b.example.com/de/x", site=True), Rule("block", "org", site=True),
]
PATTERNS = [
    Rule("block", "||ads."), Rule("block", "/banner/*.html|"), Rule("allow", "||ads.good^"),
    Rule("block", "*"), Rule("allow", "|example."), Rule("block", "^casino^"),
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def fits_site(rule, host, path):
    name, slash, rest = rule.text.partition("/")
    return bool(host) and (host == name or host.endswith("." + name)) and path.startswith(slash + rest)


def fits_pattern(rule, host, path):
    """Matching from left to right, a set of places at a time."""
    text, address = rule.text, host + path
    if text.startswith("||"):
        body = text[2:]
        places = {0} | {i + 1 for i, c in enumerate(address) if c == "." and "/" not in address[:i]}
    elif text.startswith("|"):
        body, places = text[1:], {0}
    else:
        body, places = text, set(range(len(address) + 1))
    end = body.endswith("|")
    for c in body.rstrip("|"):
        if c == "*":
            places = set(range(min(places), len(address) + 1)) if places else set()
        elif c == "^":
            places = {p + 1 for p in places if p < len(address) and not re.match(r"[A-Za-z0-9_.%-]", address[p])} | (
                places & {len(address)}
            )
        else:
            places = {p + 1 for p in places if p < len(address) and address[p] == c}
    return bool(places) if not end else len(address) in places


def brute(rows, rules):
    out = []
    for i, url in rows:
        host, path = split(url)
        best = {}
        for rule in rules:
            fits = fits_site if rule.site else fits_pattern
            if fits(rule, host, path) and (rule.site not in best or len(rule.text) > len(best[rule.site].text)):
                best[rule.site] = rule
        site, pattern = best.get(True), best.get(False)
        verdict = (site or pattern).action if site or pattern else "allow"
        out.append((i, host, path, site and site.text, pattern and pattern.text, verdict))
    return sorted(out, key=repr)


def addresses():
    rng = random.Random(1)
    hosts = ["example.net", "EXAMPLE.net", "x.example.com", "a.b.example.com", "example.org", "org", "notorg", "ads.good",
             "www.ads.bad.com", "ads.goodies", "bads.com", "net", "example.net:80", "", "casino", "exämple.net", "x.org"]
    paths = ["", "/", "/en/", "/en", "/de/x/banner/a.html", "/banner/a.html", "/banner/a.html/b", "/fr/casino/", "/de/xyz",
             "/casino-x", "/fr/\n/x", "/a://b/en/"]
    tails = ["", "?q=/en/", "#top", "?a#b"]
    rows = [(i, f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(tails)}") for i in range(300)]
    return rows + [(900, None), (901, ""), (902, "example.net/en/"), (903, "://"), (904, "x://y://example.net/en/"),
                   (None, "http://net/"), (5, rows[5][1]), (905, "http://" + "a." * 5000 + "net/" + "y" * 20000)]


@pytest.mark.parametrize("rules, limit", [(SITES, 1000), (SITES + PATTERNS, 1000), (PATTERNS[:3] + PATTERNS[4:] + SITES, 20)])
def test_against_brute_force(spark, rules, limit):
    rows = addresses()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, host string, rule string")
    found = judge(df.repartition(3), rules, block_bytes=limit)
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.pattern, r.verdict) for r in found.collect()), key=repr)
    assert got == brute(rows, rules)


def test_rules_are_filed_under_their_rarest_token(spark):
    rows = spark.createDataFrame([("example.net", "/en/1")] * 9 + [("example.org", "/fr/2")], "host string, path string")
    counts = token_counts(rows, SITES[:4])
    assert counts == {"net": 9, "example": 10, "en": 9, "com": 0, "de": 0, "org": 1, "fr": 1}
    index = Index(list(enumerate(SITES[:4] + [PATTERNS[3]])), counts)
    assert {t: [r.text for _, r in found] for t, found in index.by_token.items()} == {
        "net": ["net/"], "en": ["example.net/en/"], "com": ["example.com/de/"], "fr": ["org/fr/"],
    }
    assert [r.text for _, r in index.everywhere] == ["*"]


def test_parts_of_tokens_are_not_literal():
    assert Rule("block", "ads*track.x").tokens == []
    assert Rule("block", "/ads/tr*").tokens == ["ads"]
    assert Rule("block", "example.net/fr", site=True).tokens == ["example", "net"]
    assert [len(b) for b in blocks(SITES, 12)] == [1, 1, 1, 1, 1, 1]


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert judge(df.filter("false"), SITES).collect() == []
    assert [r.verdict for r in judge(df, []).collect()] == ["allow"]
