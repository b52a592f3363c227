import itertools
import re

from pyspark.sql import functions as F

from sievekit.llm.queries import URL_RULES
from sievekit.llm.urls import judge_urls, mine_rules, url_parts, url_tokens


def parts(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def listed(u, rules):
    host, path = parts(u)
    fits = [(len(r), v == "block", r, v) for v, r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits)[2:] if fits else (None, None)


URLS = [None, "", "no scheme.org/x", "http://A.Example.ORG/es/1", "http://example.org/en/12?x=http://b.com/de/", "ftp://x.com/fr/1://y", "https://xcom/de/2", "https://com/de/2",
        "https://ÄB.com/de/#f", "http://a.net", "http://a.net?q=/de/", "http://a.org#x", "http://org/", "http://notexample.org/es/2", "://b.com/fr/9", "http://user@b.com:80/de/3"]


def test_parts_and_list_rules(spark):
    df = spark.createDataFrame([(k, u, "x", "x") for k, u in enumerate(URLS)], "page_id bigint, url string, tokens string, row string")
    got = {r["page_id"]: r for r in judge_urls(df, URL_RULES).collect()}
    assert len(got) == len(URLS)
    for k, u in enumerate(URLS):
        rule, verdict = listed(u, URL_RULES)
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (*parts(u), rule), u
        assert got[k]["verdict"] == verdict if verdict else got[k]["verdict"] in ("allow", "block")


def brute_rules(rows, support, confidence, longest):
    n, found = len(rows), {}
    for label in ("allow", "block"):
        items = sorted({t for ts, _ in rows for t in ts})
        for k in range(1, longest + 1):
            for combo in itertools.combinations(items, k):
                has = [lab for ts, lab in rows if set(combo) <= set(ts)]
                both = has.count(label)
                if both and both / n >= support - 1e-12 and both / len(has) >= confidence - 1e-12:
                    found[combo, label] = both / len(has)
    return {k for k, c in found.items() if not any(found.get((p, k[1]), 0) >= c for m in range(1, len(k[0])) for p in itertools.combinations(k[0], m))}


def test_mined_rules_equal_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(60)
    host, path = url_parts(F.col("url"))
    rows = [(r["t"], "block" if "path0:de" in r["t"] or {"path0:en", "path1^1"} <= set(r["t"]) else "allow")
            for r in pages.select(url_tokens(F.col("url"), host, path).alias("t")).collect()]
    rows = [([t for t in ts if not t.startswith("host:th")], lab) for ts, lab in rows]
    got = mine_rules(spark.createDataFrame(rows, "tokens array<string>, label string"), 0.05, 0.9, 3)
    assert {(tuple(r["antecedent"]), r["label"]) for r in got.collect()} == brute_rules(rows, 0.05, 0.9, 3)


def test_verdicts_by_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    host, path = url_parts(F.col("url"))
    tokens = {r["page_id"]: r["t"] for r in pages.select("page_id", url_tokens(F.col("url"), host, path).alias("t")).collect()}
    got = judge_urls(pages, URL_RULES).collect()
    labelled = [(tokens[r["page_id"]], r["verdict"]) for r in got if r["rule"]]
    rules = mine_rules(spark.createDataFrame(labelled, "tokens array<string>, label string")).collect()
    for r in got:
        if not r["rule"]:
            fits = [(m["confidence"], m["support"], m["label"], " ".join(m["antecedent"])) for m in rules if set(m["antecedent"]) <= set(tokens[r["page_id"]])]
            assert (r["verdict"], r["mined"]) == (max(fits)[2:] if fits else ("allow", None))


def test_empty_and_nothing_listed(spark):
    df = spark.createDataFrame([(1, "http://a.net/x"), (None, None), (1, "http://a.net/x")], "page_id bigint, url string")
    assert judge_urls(df.where("false"), URL_RULES).count() == 0
    assert [r["verdict"] for r in judge_urls(df, URL_RULES).collect()] == ["allow"] * 3
