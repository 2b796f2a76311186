import re

import pytest

from basketmart.llm.url_rules import WRITTEN, described, judge_urls, match_rules, mine_rules, op4_association_rules, parted


def brute(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p) for _, h, p in WRITTEN if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None


URLS = [
    None, "", "no address", "http://", "http://Example.ORG", "http://example.org/", "https://a.example.org/es/1?x=1#y",
    "http://example.org/en/12", "http://xorg/en/1", "http://x.com/fr/", "ftp://X.com?a=://b/fr/", "http://x.com#/fr/",
    "a://b://c/d", "http://É.com/de/ä", "http://x.com/de", "http://x.com/de/\n2", "http://com/de/" + "z" * 50_000,
]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "x") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")


def test_parts_and_written_rules(spark):
    rows = described(pages(spark, URLS)).collect()
    assert [(r.host, r.path, r.rule) for r in sorted(rows, key=lambda r: r.page_id)] == [brute(u) for u in URLS]
    assert parted(pages(spark, URLS)).count() == len(URLS)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = op4_association_rules(spark, folder).collect()
    assert sorted(r.page_id for r in rows) == sorted(urls)
    for r in rows:
        assert (r.host, r.path, r.rule) == brute(urls[r.page_id])
        assert r.verdict in ("allow", "block")
        if r.rule:
            assert r.verdict == next(v for v, h, p in WRITTEN if h + p == r.rule)


def brute_rules(rows, support, confidence):
    """All token sets by counting every subset."""
    from itertools import combinations

    whole, by_class = {}, {}
    for tokens, verdict in rows:
        for k in range(1, len(tokens) + 1):
            for own in combinations(sorted(tokens), k):
                whole[own] = whole.get(own, 0) + 1
                by_class[own, verdict] = by_class.get((own, verdict), 0) + 1
    least = support * len(rows)
    sure = {key: n / whole[key[0]] for key, n in by_class.items() if n >= least}
    out = {}
    for (own, verdict), c in sure.items():
        parents = [sure[p, verdict] for p in combinations(own, len(own) - 1) if (p, verdict) in sure]
        if c >= confidence and all(c > p for p in parents):
            out[own, verdict] = (c, by_class[own, verdict])
    return out


def test_rules_and_matches_agree_with_brute_force(spark):
    import random

    rng = random.Random(9)
    rows = []
    for _ in range(200):
        tokens = sorted(rng.sample("abcdefg", rng.randint(1, 5)))
        bad = ("a" in tokens and "b" in tokens) or rng.random() < 0.1
        rows.append((tokens, "block" if bad else "allow"))
    frame = spark.createDataFrame(rows + [(["a"], None), ([], "block")], "tokens array<string>, verdict string")
    rules = mine_rules(frame, 0.03, 0.7)
    want = brute_rules(rows, 0.03, 0.7)
    got = {(tuple(r.tokens), r.verdict): (r.confidence, r.n) for r in rules.collect()}
    assert got == want and all(r.anchor in r.tokens for r in rules.collect())
    matched = {tuple(r.tokens): r.mined for r in match_rules(frame.select("tokens").distinct(), rules).collect()}
    for tokens, _ in rows:
        fits = [(c, n, len(own), " ".join(own), v) for (own, v), (c, n) in want.items() if set(own) <= set(tokens)]
        assert matched.get(tuple(tokens)) == (max(fits)[-1] if fits else None)


@pytest.mark.parametrize("n", [0, 1])
def test_empty_tables(spark, n):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    own = pages(spark, URLS[:n] + ["http://x.net/en/1"] * n)
    rows = judge_urls(own, labels).collect()
    assert len(rows) == 2 * n and all(r.verdict == "allow" for r in rows)


def test_labels_teach(spark):
    urls = [f"http://bad{i % 3}.example.net/en/{i}" for i in range(60)] + [f"http://good{i % 3}.example.net/fr/{i}" for i in range(60)]
    own = pages(spark, urls + ["http://bad1.example.net/en/77", "http://good2.example.net/fr/9"])
    labels = spark.createDataFrame([(i, int(i >= 60), 0) for i in range(120)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    verdicts = {r.page_id: r.verdict for r in judge_urls(own, labels).collect()}
    assert verdicts[120] == "block" and verdicts[121] == "allow"
