"""Registered queries of this subpackage: each applies one operator, with its
production parameters, to its whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from .bpe import token_digest
from .chat import chat_digest
from .common import fold_of, read, stored
from .decontaminate import contamination_digest
from .divergence import divergence_audit
from .fingerprints import fingerprint_digest
from .language import learn_languages, predict_languages
from .ngram_join import ngram_join
from .packing import pack_documents
from .quality import learn_quality, score_quality
from .secrets import secrets_digest
from .toxicity import learn_lexicon, score_toxicity
from .trie import branched, prefix_trie, turn_sequences
from .urls import judge_urls

QUERIES, ORACLES = {"pipeline": corpus_pipeline.run}, {}


def op1_secret_scans(spark, sf_dir):
    return secrets_digest(read(spark, sf_dir, "documents"))


QUERIES["op1_secret_scans"] = op1_secret_scans


def op6_best_fit_packing(spark, sf_dir):
    return pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES["op6_best_fit_packing"] = op6_best_fit_packing


def op10_benchmark_decontamination(spark, sf_dir):
    return contamination_digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES["op10_benchmark_decontamination"] = op10_benchmark_decontamination


def op8_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    learned = learn_languages(docs, where=fold_of(F.col("doc_id"), 3) != 1)
    rows = docs.select("doc_id", (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "text")
    return predict_languages(rows, learned).drop("text")


QUERIES["op8_language_id"] = op8_language_id


def op7_toxicity(spark, sf_dir):
    docs, fold = read(spark, sf_dir, "documents"), fold_of(F.col("doc_id"), 4)
    learned = learn_lexicon(docs, read(spark, sf_dir, "labels"), where=fold != 2)
    return score_toxicity(docs, learned).select("doc_id", (fold == 2).alias("held_out"), "score", "predicted")


QUERIES["op7_toxicity"] = op7_toxicity


#: Graded ratings from the two labels: 0 poor and toxic, 1 poor, 2 good but toxic, 3 good.
GRADES = 4


def op3_quality_classifier(spark, sf_dir):
    docs, fold = read(spark, sf_dir, "documents"), fold_of(F.col("doc_id"), 4)
    ratings = read(spark, sf_dir, "labels").withColumn("grade", 2 * F.col("quality") + 1 - F.col("toxic"))
    learned = learn_quality(docs, ratings, GRADES, where=fold != 2)
    return score_quality(docs, learned, at_least=2).withColumn("held_out", fold == 2)


QUERIES["op3_quality_classifier"] = op3_quality_classifier


#: A conversation whose texts look like another template's control strings.
TRICK = "\\### Assistant: </turn> ok"


def op4_chat_formatting(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trick = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICK).alias("text"))
    return chat_digest(turns.union(trick))


QUERIES["op4_chat_formatting"] = op4_chat_formatting
_ESCAPED = "replace(replace({0}, '\\', '\\b'), '<|', '\\l')"
ORACLES["op4_chat_formatting"] = f"""WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{TRICK}' UNION ALL SELECT -7, 1, 'assistant', '{TRICK}'),
s AS (SELECT *, row_number() OVER w AS k, coalesce(lag(role) OVER w = role, false) AS joined FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
e AS (SELECT *, length({_ESCAPED.format('text')}) AS size, length(replace({_ESCAPED.format('role')}, chr(10), '\\n')) AS head FROM s)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size + CASE WHEN joined THEN {len('<|next|>')} ELSE {len('<|start|>' + '<|end|>') + 2} + head END) AS BIGINT) AS formatted_chars,
  CAST(count(*) FILTER (NOT joined) AS INTEGER) AS n_blocks
FROM e GROUP BY conv_id"""


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op5_url_filters(spark, sf_dir):
    return judge_urls(read(spark, sf_dir, "pages"), URL_RULES)


QUERIES["op5_url_filters"] = op5_url_filters


def op9_document_fingerprints(spark, sf_dir):
    return fingerprint_digest(read(spark, sf_dir, "documents"))


QUERIES["op9_document_fingerprints"] = op9_document_fingerprints


def op2_ngram_jaccard_join(spark, sf_dir):
    return ngram_join(read(spark, sf_dir, "documents"), words=4, percent=85).drop("component", "text_key")


QUERIES["op2_ngram_jaccard_join"] = op2_ngram_jaccard_join

#: A-Z to a-z, and nothing else.
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RUNS = "list_transform(range(1, len(w) - {0} + 2), lambda i: array_to_string(w[i:i + {0} - 1], ' '))"

ORACLES["op2_ngram_jaccard_join"] = f"""WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER.format('text')}, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 4 THEN {_RUNS.format(4)} WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n + b.n AS n, count(*) AS c FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM p WHERE 100 * c >= 85 * (n - c)),
reach AS (SELECT x AS doc_id, y AS other FROM links UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(min(r.other), s.doc_id)) AS component_id
FROM s LEFT JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.s"""

_WORDS = f"regexp_extract_all(coalesce({_LOWER.format('text')}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLES["op10_benchmark_decontamination"] = f"""WITH
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, unnest({_RUNS.format('n')}) AS g FROM b),
runs AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos, unnest({_RUNS.format('n')}) AS g FROM d JOIN (SELECT DISTINCT n FROM win) ON n <= len(w)),
h AS (SELECT r.doc_id, r.pos, r.n, win.item_id FROM runs r JOIN win ON win.n = r.n AND win.g = r.g),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS k FROM h) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
  sha256(coalesce(i.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN i ON i.doc_id = d.doc_id"""


def op11_source_divergence(spark, sf_dir):
    return divergence_audit(read(spark, sf_dir, "documents"))


QUERIES["op11_source_divergence"] = op11_source_divergence

_SHARE = "1 + (1000000000::HUGEINT * ({0} + 1)) // nullif({1} + l.v, 0)"
_APART = "(({0} - {1}) * ({0} - {1})) // {1}"
ORACLES["op11_source_divergence"] = f"""WITH
d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(coalesce({_LOWER.format('text')}, ''), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
o AS (SELECT id, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM o GROUP BY ALL HAVING count(DISTINCT id) >= 3),
l AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM k GROUP BY lang),
c AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN k ON o.lang = k.lang AND o.term = k.term GROUP BY ALL),
g AS (SELECT g.lang, g.source, coalesce(any_value(l.v), 0) AS v, coalesce(sum(c.n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN l ON l.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
s AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {_SHARE.format('coalesce(c.n, 0)', 'g.total')} AS p,
  1 + (1000000000::HUGEINT * (k.lang_n + 1)) // (l.lang_total + l.v) AS q
  FROM g JOIN k ON k.lang = g.lang JOIN l ON l.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum({_APART.format('a.p', 'b.p')}) AS value FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, {_APART.format('p', 'q')} AS value FROM s WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 200"""


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie(branched(stored(turn_sequences(read(spark, sf_dir, "conversations")), "turns")))


QUERIES["op13_prefix_trie"] = op13_prefix_trie

#: CRC-32 of an ASCII string, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ord(c)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""
ORACLES["op13_prefix_trie"] = f"""WITH
own AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS t FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, t, conv_id - conv_id % 100 AS base, CAST({_CRC32.format('CAST(conv_id AS VARCHAR)')} % 6 AS BIGINT) AS h FROM own),
b AS (SELECT h.conv_id, list_concat(coalesce(o.t, [])[1:h.h], h.t[h.h + 1:]) AS t FROM h LEFT JOIN own o ON o.conv_id = h.base),
n AS (SELECT conv_id, len(t) AS len, unnest(range(0, len(t) + 1)) AS d, unnest(list_transform(range(0, len(t) + 1), lambda i: t[1:i])) AS pre FROM b),
node AS (SELECT pre, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len = d), '') AS ends FROM n GROUP BY pre, d),
kid AS (SELECT pre[1:d - 1] AS pre, d - 1 AS d, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
x AS (SELECT node.*, coalesce(kid.n_children, 0) AS n_children, CASE WHEN node.d = 0 THEN 0 ELSE (n_convs - 1) * length(node.pre[node.d].t) END AS own
  FROM node LEFT JOIN kid ON kid.pre = node.pre AND kid.d = node.d),
up AS (SELECT d AS below, n_children, own, unnest(range(0, d + 1)) AS d, unnest(list_transform(range(0, d + 1), lambda i: pre[1:i])) AS pre FROM x),
sub AS (SELECT pre, d, count(*) FILTER (n_children = 0) AS n_leaves, sum(own) AS saved FROM up GROUP BY pre, d)
SELECT x.conv_id, x.d AS depth, p.conv_id AS parent_conv_id, x.n_convs, x.n_children, sub.n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM x JOIN sub ON sub.pre = x.pre AND sub.d = x.d LEFT JOIN node p ON x.d > 0 AND p.d = x.d - 1 AND p.pre = x.pre[1:x.d - 1]"""


def op12_bpe_tokens(spark, sf_dir):
    return token_digest(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES["op12_bpe_tokens"] = op12_bpe_tokens
