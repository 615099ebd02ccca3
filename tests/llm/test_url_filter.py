import random
import re
from math import log2

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm import url_filter as U
from tablewright.llm.queries import URL_RULES
from tablewright.llm.url_filter import ALLOW, BLOCK, FEATURES, FORM, Rule, form, trained, url_verdicts
from tests.llm.support import CLASHES

ODD = [
    None, "", "no scheme/com/", "://", "http://", "http://com", "http://com/", "HTTP://A.COM/x", "http://xcom/",
    "http://example.com/en", "http://example.com/en/", "http://EXAMPLE.com/en/a?b#c", "http://www.example.com/en/1",
    "http://a.www.example.com/en/1", "http://example.com/EN/", "http://x.net/es/", "http://x.net/es", "http://net/fr/",
    "http://x.org/a://b.net/fr/", "http://x.org?u=http://y.net/fr/", "http://x.net#/fr/", "http://x.net/fr/\nline",
    "http://É.COM/ü", "http://a.com:80/", "x://u@b.com/", "http://x.net/" + "a/" * 30_000, "http://.com/",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match("([^/?#]*)([^?#]*)", url.partition("://")[2], re.S).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule_of(url, rules):
    host, path = parts(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text)) if fits else None


def frame(spark, rows):
    names = [c for c in (*CLASHES, "html", "host", "path", "rule", "label", "suffix_1", "seen", "score", "form")]
    schema = T.StructType(
        [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
         *(T.StructField(c, T.StringType()) for c in names)]
    )
    full = [(*row, *["x" if i % 2 else None] * len(names)) for i, row in enumerate(rows)]
    return spark.createDataFrame(full, schema).repartition(3)


def web(rng, n):
    """Hosts whose blocked ones look alike: digits, hyphens, deep paths, many parameters."""
    out = []
    for _ in range(n):
        bad = rng.random() < 0.4
        if bad:
            host = f"{rng.choice(('win', 'pills', 'bet'))}-{rng.randrange(10**6)}.{rng.choice(('top', 'com', 'org'))}"
            path = "/" + "/".join(str(rng.randrange(10**4)) for _ in range(rng.randrange(1, 5)))
            tail = "?" + "&".join(f"p{i}={rng.randrange(99)}" for i in range(rng.randrange(1, 5)))
        else:
            host = "".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(5, 12))) + rng.choice((".com", ".org"))
            path = "/" + "/".join(rng.choice(("news", "about", "story", "en")) for _ in range(rng.randrange(0, 3)))
            tail = rng.choice(("", "", "?page=2", "#top"))
        out.append((f"http://{host}{path}{tail}", int(bad)))
    return out


def test_rules_and_parts_against_plain_python(spark):
    rng = random.Random(1)
    rows = [(i, u) for i, u in enumerate(ODD)] + [(None, "http://b.com/"), (3, "http://b.com/"), (3, "http://b.com/")]
    rows += [(100 + i, "http://hot.net/fr/1") for i in range(60)]
    rows += [(200 + i, u) for i, (u, _) in enumerate(web(rng, 60))]
    found = url_verdicts(frame(spark, rows), URL_RULES)
    assert found.columns == ["page_id", "url", "host", "path", "rule", "verdict", "score"]
    expected = []
    for key, url in rows:
        rule = rule_of(url, URL_RULES)
        expected.append((key, url, *parts(url), rule and rule.text, rule and rule.verdict))
    got = found.collect()
    assert all(0 <= r.score <= 1 and r.verdict in (ALLOW, BLOCK) for r in got)
    assert all(r.verdict == (BLOCK if r.score >= 0.5 else ALLOW) for r in got if r.rule is None)
    plain = [(*tuple(r)[:5], r.verdict if r.rule else None) for r in got]
    assert sorted(plain, key=repr) == sorted(expected, key=repr)


def test_longest_rule_wins_whatever_the_order(spark):
    rules = [Rule(BLOCK, "a.b/x/"), Rule(ALLOW, "b/"), Rule(BLOCK, "b/x/y/z/"), Rule(ALLOW, "b")]
    rows = [(1, "h://a.b/x/y/z/"), (2, "h://a.b/x/q"), (3, "h://b/x/"), (4, "h://b"), (5, "h://c.b/x/y/z/1"), (6, "h://bb/")]
    for order in (rules, rules[::-1]):
        got = {r.page_id: r.rule for r in url_verdicts(frame(spark, rows), order).collect()}
        assert got == {1: "b/x/y/z/", 2: "a.b/x/", 3: "b/", 4: "b", 5: "b/x/y/z/", 6: None}


def test_form():
    url, host, path = "https://a.bb-c.com/x1/y22.html?p=1&q=%20;;r#f", "a.bb-c.com", "/x1/y22.html"
    got = dict(zip(FORM, form(url, host, path), strict=True))
    assert got["depth"] == 2 and got["host_labels"] == 3 and got["longest_label"] == 4 and got["hyphens"] == 1
    assert got["params"] == 3 and got["fragment"] == 1 and got["escapes"] == 1 and got["extension"] == 4
    assert got["path_digits"] == 3 / len(path) and got["host_digits"] == 0 and got["query_length"] == 12
    expected = -sum(host.count(c) / len(host) * log2(host.count(c) / len(host)) for c in set(host))
    assert got["host_entropy"] == pytest.approx(expected)
    assert form(None, "", "") == (0.0,) * len(FORM)


def test_statistics_leave_out_the_own_fold(spark):
    rows = [(f"http://h{i}.{'bad' if i % 3 else 'com'}/", int(i % 3 > 0)) for i in range(90)]
    known = U.with_parts(spark.createDataFrame(rows, "url string, label int")).withColumn("fold", U._fold("host"))
    tables = {k: U.suffix_statistics(known, k) for k in U.SUFFIX_LABELS}
    folds = [(r.url, r.label, r.suffix_1, r.fold) for r in known.collect()]
    for training in (True, False):
        for r in U.with_features(known, tables, 0.5, training).collect():
            others = [x[1] for x in folds if x[2] == r.suffix_1 and not (training and x[3] == r.fold)]
            assert r.blocked_1 == pytest.approx((sum(others) + 10) / (len(others) + 20))
            assert all(getattr(r, name) is not None for name in FEATURES)


def test_held_out_accuracy(spark):
    rng = random.Random(4)
    labelled = spark.createDataFrame(web(rng, 1500), "url string, label int")
    model = trained(labelled)
    test = spark.createDataFrame(web(random.Random(5), 800), "url string, label int")
    scored = model.scored(U.with_parts(test)).select("label", "score").collect()
    assert sum((r.score >= 0.5) == (r.label == 1) for r in scored) / len(scored) > 0.97


def test_the_sample_is_bounded_and_statistics_are_not(spark, monkeypatch):
    sizes = []
    real = U.stage

    def counting(df, name, *more):
        path = real(df, name, *more)
        sizes.append((name, spark.read.parquet(path)))
        return path

    monkeypatch.setattr(U, "stage", counting)
    counts = {}

    def counted(spark, path):
        counts.update({name: df.count() for name, df in sizes if path in df.inputFiles()[0]})

    monkeypatch.setattr(U, "drop_staged", counted)
    rng = random.Random(6)
    labelled = spark.createDataFrame(web(rng, 3000), "url string, label int")
    model = trained(labelled, sample_urls=500)
    assert 400 < counts["urls"] < 600
    seen = model.statistics[1].select(F.explode("seen").alias("n")).agg(F.sum("n")).first()[0]
    assert seen == 3000


def test_labels_of_one_kind_or_none(spark):
    rows = [(1, "http://a.org/"), (2, None)]
    assert {r.verdict for r in url_verdicts(frame(spark, rows), URL_RULES).collect()} == {ALLOW}
    only = spark.createDataFrame([("http://x.org/", 1), (None, 0), ("http://y.org/", None)], "url string, label int")
    assert {r.verdict for r in url_verdicts(frame(spark, rows), URL_RULES, only).collect()} == {BLOCK}
    assert url_verdicts(frame(spark, []), URL_RULES).count() == 0
