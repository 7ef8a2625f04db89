from collections import Counter
from math import log2
from zlib import crc32

import pytest

from tripwire.llm import url_ratio as u

URLS = [
    "http://a.example.net/en/x?y=1", "HTTP://A.Example.NET/de/x", "https://b.example.org/fr/1", "https://b.example.org/en/1",
    "ftp://net/x", "ftp://net", "https://sub.example.com/de/7#z", "https://notnet/de", "no scheme", None, "", "://", "http://x.com/a\nb",
    "https://example.net/en", "https://shop.example.com/en/2", "https://shop.example.com/es/3",
]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, url) for i, url in enumerate(URLS + URLS[:4] * 3)]
    return {r.page_id: r for r in u.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}


def test_rules(judged):
    got = {URLS[i]: (judged[i].host, judged[i].path, judged[i].rule) for i in range(len(URLS))}
    assert got[URLS[0]] == ("a.example.net", "/en/x", "example.net/en/")
    assert got[URLS[1]] == ("a.example.net", "/de/x", "net/") and judged[1].verdict == "block"
    assert got[URLS[2]] == ("b.example.org", "/fr/1", "org/fr/") and judged[2].verdict == "allow"
    assert got[URLS[3]][2] is None and got[URLS[4]] == ("net", "/x", "net/") and got[URLS[5]] == ("net", "", None)
    assert got[URLS[6]][2] == "example.com/de/" and got[URLS[7]] == ("notnet", "/de", None)
    assert got["no scheme"] == got[None] == got[""] == got["://"] == ("", "", None)
    assert got["http://x.com/a\nb"] == ("x.com", "/a\nb", None) and got[URLS[13]][2] == "net/"
    assert judged[9].score == 0.0


def models(texts, order):
    """Witten-Bell smoothed models of both classes, by dictionaries."""
    counts = [[Counter() for _ in range(order + 1)] for _ in "ab"]
    for text, n_a, n_b in texts:
        padded = "\x01" * order + text
        for i in range(order, len(padded)):
            for k in range(order + 1):
                for c, n in ((0, n_a), (1, n_b)):
                    if n:
                        counts[c][k][padded[i - k:i + 1]] += n

    def p(c, gram):
        if not gram:
            return 1 / u.SYMBOLS
        k = len(gram) - 1
        after = {g: n for g, n in counts[c][k].items() if g[:-1] == gram[:-1]}
        shorter = p(c, gram[1:])
        n = sum(after.values())
        return (counts[c][k][gram] + len(after) * shorter) / (n + len(after)) if n else shorter

    return p


def test_scores_equal_models_in_plain_python(spark):
    texts = [("abcab", 2, 0), ("abd", 1, 0), ("xyzxy", 0, 3), ("abxy", 0, 0), ("ab", 0, 1)]
    p = models(texts, 2)
    got = {r.text: r.score for r in u.score_texts(spark.createDataFrame(texts, "text string, a long, b long"), 2).collect()}
    for text, *_ in texts:
        padded = "\x01\x01" + text
        grams = [padded[i - 2:i + 1] for i in range(2, len(padded))]
        want = sum(log2(p(1, g) / p(0, g)) for g in grams) / len(grams)
        assert got[text] == pytest.approx(want)


def test_threshold(spark):
    rows = [(-1.0, 5, 0), (-0.5, 4, 1), (0.5, 1, 4), (1.0, 0, 5)]
    scored = spark.createDataFrame(rows, "score double, accepted long, rejected long")
    assert u.threshold(scored) == pytest.approx(-0.48)
    assert u.threshold(scored.filter("accepted = 0")) == 0.0 and u.threshold(scored.limit(0)) == 0.0


def test_held_out_urls(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    got = u.judge_urls(pages).collect()
    assert len(got) == pages.count()
    ruled = [r for r in got if r.rule and crc32((r.host + r.path).encode()) % 2]
    by_model = [(r.score > 0) == (r.verdict == "block") for r in ruled]
    assert sum(by_model) / len(by_model) > 0.9


def test_no_pages(spark):
    assert u.judge_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []
