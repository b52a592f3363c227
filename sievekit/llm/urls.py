"""URL filters: list rules first, then association rules mined by FP-growth.

A list rule names a host and a path beginning; it fits the host and all its
subdomains, and the longest fitting rule decides.  The URLs that list rules
judge are the labelled ones: Spark's FP-growth mines combinations of URL
tokens together with the label from them.  Rules "tokens => block" and
"tokens => allow" are pruned by support, by confidence and by more general
rules that are as confident.  A rule is indexed under its rarest token; a URL
looks its tokens up there and the rule fits if the URL has all its tokens.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def list_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule of a short list of (verdict, "host/path") as a
    struct of rule and verdict, or null; of equally long ones a blocking one."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block")):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: the last host label, host words, path parts by depth,
    beginnings of numbers, file endings and query keys."""
    labels = F.split(host, r"\.")
    words = F.filter(F.split(host, r"[.\-_]+"), lambda w: w != "")
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    number = lambda p: p.rlike("^[0-9]+")
    by_depth = F.transform(parts, lambda p, i: F.concat(F.lit("path"), F.least(i, F.lit(3)).cast("string"), F.when(number(p), F.concat(
        F.lit("^"), F.substring(p, 1, 1))).otherwise(F.concat(F.lit(":"), F.translate(p, _UPPER, _LOWER)))))
    keys = F.transform(F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda q: q != ""),
                       lambda q: F.concat(F.lit("key:"), F.substring_index(q, "=", 1)))
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)
    return F.array_distinct(F.filter(F.concat(
        F.array(F.concat(F.lit("top:"), F.element_at(labels, -1))), F.transform(words, lambda w: F.concat(F.lit("host:"), w)), by_depth, keys,
        F.array(F.when(ending != "", F.concat(F.lit("ending:"), ending)))), lambda t: t.isNotNull() & (F.char_length(t) <= 100)))


def mine_rules(labelled: DataFrame, min_support: float = 0.01, min_confidence: float = 0.9, longest: int = 3) -> DataFrame:
    """Pruned rules of transactions with ``tokens`` and a ``label``: antecedent
    (sorted), label, confidence, support.  A rule holds for ``min_support`` of
    the transactions, so their number depends on that bound and on how many
    tokens a URL has, not on the number of URLs."""
    mark = "label="
    rows = labelled.select(F.concat("tokens", F.array(F.concat(F.lit(mark), "label"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(rows)
    rules = model.associationRules.where((F.size("antecedent") <= longest) & F.startswith(F.col("consequent")[0], F.lit(mark))).select(
        F.array_sort("antecedent").alias("antecedent"), F.substring(F.col("consequent")[0], len(mark) + 1, 1000).alias("label"), "confidence", "support")
    rules = stored(rules.where(~F.exists("antecedent", lambda t: F.startswith(t, F.lit(mark)))), "rules")
    # a rule goes if a part of its tokens says the same with no less confidence
    general = rules.select(F.col("antecedent").alias("part"), "label", F.col("confidence").alias("general"))
    parts = rules.select("antecedent", "label", "confidence", F.explode(_proper_parts("antecedent", longest)).alias("part"))
    beaten = parts.join(general, ["part", "label"]).where("general >= confidence").select("antecedent", "label").distinct()
    return rules.join(beaten, ["antecedent", "label"], "left_anti")


def _proper_parts(items: str, longest: int) -> Column:
    """All non-empty proper sub-arrays of a sorted array of ``longest`` items at most."""
    with_item = lambda out, k: F.transform(out, lambda p: F.concat(p, F.array(F.get(items, F.lit(k)))))
    out = F.array(F.array().cast("array<string>"))
    for k in range(longest):
        out = F.when(F.size(items) > k, F.concat(out, with_item(out, k))).otherwise(out)
    return F.filter(out, lambda p: (F.size(p) > 0) & (F.size(p) < F.size(items)))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", min_support: float = 0.01,
               min_confidence: float = 0.9, default: str = "allow") -> DataFrame:
    """One row for each row of ``pages``: page_id, host, path, rule (the list
    rule or null), verdict (the list rule's, else that of the most confident
    mined rule, then best supported, else ``default``) and mined (the mined
    rule's tokens, or null).

    Null URLs and URLs without ``://`` have an empty host and path, and no
    tokens but those of their query.  Repeated rows and null keys give a row
    each; an empty table gives none; if list rules judge no URL, nothing is
    mined.  Only the key and the URL are read.

    The labels are the list rules' verdicts on all rows.  The join with the
    rule index repeats a URL only for rules under its own tokens; the index is
    small (see ``mine_rules``), and Spark picks the join by its stored size."""
    url = F.col("url")
    host, path = url_parts(url)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")).select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("list", list_rule(F.col("host"), F.col("path"), rules))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "page_id", "host", "path", F.col("list.rule").alias("rule"),
                       F.col("list.verdict").alias("label"), url_tokens(url, F.col("host"), F.col("path")).alias("tokens"))
    rows = stored(rows, "urls")
    labelled = rows.where("label IS NOT NULL").select("tokens", "label")
    out = rows.select("row", "page_id", "host", "path", "rule", "label")
    if labelled.isEmpty():
        return out.select("page_id", "host", "path", "rule", F.coalesce("label", F.lit(default)).alias("verdict"), F.lit(None).cast("string").alias("mined"))
    mined = mine_rules(labelled, min_support, min_confidence)
    often = labelled.select(F.explode("tokens").alias("token")).groupBy("token").count()
    rarest = Window.partitionBy("antecedent", "label").orderBy("count", "token")
    index = stored(mined.withColumn("token", F.explode("antecedent")).join(often, "token").withColumn("nth", F.row_number().over(rarest))
                   .where("nth = 1").select("token", "antecedent", F.col("label").alias("says"), "confidence", "support"), "index")
    hits = (rows.where("label IS NULL").select("row", "tokens", F.explode("tokens").alias("token")).join(index, "token")
            .where(F.size(F.array_except("antecedent", "tokens")) == 0)
            .groupBy("row").agg(F.max(F.struct("confidence", "support", "says", F.array_join("antecedent", " ").alias("mined"))).alias("best")))
    return out.join(hits, "row", "left").select("page_id", "host", "path", "rule", F.coalesce("label", "best.says", F.lit(default)).alias("verdict"),
                                                F.col("best.mined").alias("mined"))
