"""The registered queries of this subpackage, each with DuckDB SQL for its rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.llm import decontam, filter_audit, licenses, line_dedup, packing, pieces, quality, simhash, spelling, suffix_dedup, tokens, topk, urls

Job = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Job], Job]:
    def add(fn: Job) -> Job:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# op1: suffix-array dedup

@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), least=400)
    text = F.call_function("make_valid_utf8", F.col("kept").cast("string"))  # cuts may fall inside a character
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
                      F.length("kept").cast("long").alias("n_kept"), text.alias("text"))


# op2: line dedup

LINE_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS pos FROM documents),
sized AS (SELECT doc_id, pos, trim(line) AS line, length(trim(line)) + 1 AS size FROM lines),
placed AS (SELECT *, sum(size) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM sized),
forward AS (
  SELECT doc_id, min(pos) OVER w AS a, max(pos) OVER w AS b, list(line) OVER w AS body, max(upto) OVER w - min(upto - size) OVER w AS chars
  FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY upto - size RANGE BETWEEN CURRENT ROW AND 39 FOLLOWING)),
backward AS (
  SELECT doc_id, min(pos) OVER w AS a, max(pos) OVER w AS b, list(line) OVER w AS body, max(upto) OVER w - min(upto - size) OVER w AS chars
  FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 39 PRECEDING AND CURRENT ROW)),
windows AS (SELECT doc_id, a, b, array_to_string(body, chr(10)) AS body
            FROM (SELECT * FROM forward UNION SELECT * FROM backward) WHERE chars >= 40),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY body ORDER BY doc_id, a) AS nth FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS pos FROM ranked WHERE nth > 1),
marked AS (SELECT l.doc_id, l.pos, l.line, g.pos IS NOT NULL AS out FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos)
SELECT doc_id, count(*) AS n_lines, sum(out::BIGINT)::BIGINT AS n_removed,
       md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT out), '')) AS text_md5
FROM marked GROUP BY doc_id"""


@query("op2_line_dedup", LINE_SQL)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), least=40)
    return kept.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


# op3: quality classifier

@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


# op4: license scans

PHRASES = [
    licenses.phrase("cc-by", "cc by"), licenses.phrase("gpl", "general public license"),
    licenses.phrase("reserved", "all rights reserved"),
]


def sql_starts(words: tuple[str, ...], first: int, key: range) -> str:
    """DuckDB list of the starts (from 0) of a template whose key phrase stands at its place."""
    tests = " AND ".join(f"w[i + {j - first + 1}] = '{words[j]}'" for j in key)
    return f"list_transform(list_filter(range(len(w)), lambda i: {tests} AND i >= {first}), lambda i: i - {first})"


def license_sql() -> str:
    base = [f"{sql_starts(t.words, 0, range(len(t.words)))} AS p{k}" for k, t in enumerate(PHRASES)]
    share = []
    for k, t in enumerate(licenses.TEMPLATES):
        hits = " + ".join(f"coalesce((s + {j + 1} >= 1 AND w[s + {j + 1}] = '{word}')::INT, 0)" for j, word in enumerate(t.words))
        share.append(f"coalesce(list_max(list_transform({sql_starts(t.words, t.key[0], range(*t.key))}, "
                     f"lambda s: ({hits}) / {float(len(t.words))}::DOUBLE)), 0.0::DOUBLE) AS s{k}")
    every = "p0 || p1 || p2"
    labels = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{t.label}' END" for k, t in enumerate(PHRASES))
    own = ", ".join(f"CASE WHEN s{k} >= 0.7 THEN '{t.label}' END" for k, t in enumerate(licenses.TEMPLATES))
    best = ", ".join(f"CASE WHEN s{k} >= 0.7 THEN s{k} ELSE 0.0::DOUBLE END" for k in range(len(licenses.TEMPLATES)))
    join = lambda items: f"coalesce(array_to_string(list_sort(list_distinct(list_filter([{items}], lambda x: x IS NOT NULL))), ','), '')"
    return f"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
hits AS (SELECT doc_id, len(w) AS n_words, {', '.join(base)}, {', '.join(share)} FROM words)
SELECT doc_id, n_words, len({every}) AS n_base, list_min({every}) AS first_word, list_max({every}) AS last_word,
       {join(labels)} AS base_labels, {join(labels + ', ' + own)} AS labels,
       CASE WHEN len({every}) > 0 THEN 1.0::DOUBLE ELSE greatest({best}) END AS score
FROM hits"""


@query("op4_license_scan", license_sql())
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), PHRASES).drop("places")


# op5: token counts

@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


# op6: exact top-k search

TOP_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""


@query("op6_top_k", TOP_SQL)
def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


# op7: packing

@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, most=4096)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


# op8: URL filters

RULES = [
    urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"), urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"), urls.Rule("block", "com", "/de/"),
]
# Everyone may register below these, so reputations go by the label before them.
SUFFIXES = ("example.com", "example.net", "example.org")
# The pages' paths name the document they show: /language/number.
SHOWN = r"://[^/?#]*/[a-z]+/([0-9]{1,18})"

URL_SQL = """
WITH pages_ AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path,
         try_cast(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]{1,18})', 1) AS BIGINT) AS shown FROM pages),
marks AS (
  SELECT p.page_id, l.quality AS good FROM pages_ p JOIN labels l ON l.doc_id = p.shown WHERE l.quality IS NOT NULL),
seen AS (SELECT p.host, m.good FROM pages_ p LEFT JOIN marks m ON m.page_id = p.page_id),
hosts0 AS (SELECT host, count(good) AS n, coalesce(sum(good), 0) AS k FROM seen GROUP BY host),
hosts1 AS (
  SELECT *, CASE WHEN regexp_matches(host, '(^|\\.)example\\.(com|net|org)$') THEN regexp_extract(host, 'example\\.(com|net|org)$')
            ELSE regexp_extract(host, '[^.]*$') END AS suffix FROM hosts0),
hosts AS (
  SELECT *, CASE WHEN length(host) > length(suffix)
                 THEN concat(regexp_extract(left(host, length(host) - length(suffix) - 1), '[^.]*$'), '.', suffix) ELSE host END AS domain FROM hosts1),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain, suffix),
tops AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix),
whole AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS base, sum(n) AS wn FROM tops),
groups AS (
  SELECT 's' AS kind, n, k FROM tops UNION ALL SELECT 'd', n, k FROM domains UNION ALL SELECT 'h', n, k FROM hosts),
sums AS (
  SELECT kind, sum(n)::DOUBLE AS nn, sum(k)::DOUBLE AS kk, count(*)::DOUBLE AS g, sum(k::DOUBLE * k / n) AS kkn, sum(n::DOUBLE * n) AS n2
  FROM groups WHERE n > 0 GROUP BY kind),
rhos AS (
  SELECT kind, (kkn - kk * kk / nn - (kk / nn) * (1 - kk / nn) * (g - 1)) AS over,
         (kk / nn) * (1 - kk / nn) * (nn - n2 / nn - (g - 1)) AS under FROM sums),
held AS (
  SELECT kind, least(greatest(coalesce(CASE WHEN under = 0 THEN NULL ELSE over / under END, 0.0), 1 / 10001), 0.5) AS rho FROM rhos),
c AS (
  SELECT coalesce(max((1 - rho) / rho) FILTER (kind = 's'), 10000) AS cs, coalesce(max((1 - rho) / rho) FILTER (kind = 'd'), 10000) AS cd,
         coalesce(max((1 - rho) / rho) FILTER (kind = 'h'), 10000) AS ch FROM held),
tops1 AS (SELECT suffix, (k + cs * base) / (n + cs) AS m FROM tops, c, whole),
domains1 AS (SELECT d.domain, (d.k + cd * t.m) / (d.n + cd) AS m FROM domains d JOIN tops1 t USING (suffix), c),
post AS (SELECT h.host, h.k + ch * d.m AS a, h.n - h.k + ch * (1 - d.m) AS b FROM hosts h JOIN domains1 d USING (domain), c),
rates AS (
  SELECT host, a / (a + b) AS rate, CASE WHEN wn = 0 THEN 1 ELSE least(1.0, a / (a + b) + 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))) END AS upper
  FROM post, whole),
rules(rule, verdict, h, p) AS (VALUES ('org/', 'allow', 'org', '/'), ('example.org/es/', 'block', 'example.org', '/es/'),
  ('example.org/en/1', 'block', 'example.org', '/en/1'), ('com/fr/', 'allow', 'com', '/fr/'), ('com/de/', 'block', 'com', '/de/')),
fit AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM pages_) q, rules r
  WHERE (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p) GROUP BY host, path)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, CASE WHEN r.upper < 0.8 THEN 'block' ELSE 'allow' END) AS verdict,
  round(r.rate, 6) AS rate, round(r.upper, 6) AS upper
FROM pages_ p LEFT JOIN fit f ON f.host = p.host AND f.path = p.path LEFT JOIN rates r ON r.host = p.host"""


@query("op8_url_filter", URL_SQL)
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    shown = F.regexp_extract("url", SHOWN, 1).try_cast("long").alias("shown")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("good"))
    outcomes = pages.select("page_id", shown).join(labels, F.col("shown") == F.col("doc_id")).select("page_id", "good")
    return urls.judge_urls(pages, outcomes, RULES, SUFFIXES).withColumns({c: F.round(c, 6) for c in ("rate", "upper")})


# op9: benchmark decontamination

@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# op10: SimHash near-dedup

@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3)


# op11: spelling variant grouping

# The checksum is worked out bit by bit: a list has each byte, then seven zeros.
SPELLING_SQL = """
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
keyed AS (SELECT concat(doc_id, ':', run) AS key, run, count(*) AS n FROM runs GROUP BY ALL),
bits AS (
  SELECT run, n, flatten(list_transform(flatten(list_transform(string_split(key, ''),
    lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [192 + ord(c) // 64, 128 + ord(c) % 64] END)), lambda b: [b, 0, 0, 0, 0, 0, 0, 0])) AS b FROM keyed),
summed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b::BIGINT[]),
    lambda h, x: xor(xor(h, x) >> 1, 3988292384::BIGINT * (xor(h, x) & 1))), 4294967295::BIGINT) AS h FROM bits),
damaged AS (
  SELECT CASE WHEN h % 97 = 0 THEN concat(substring(run, 1, (h % length(run))::INT), substring(run, (h % length(run))::INT + 2)) ELSE run END AS word, n FROM summed),
v AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, n, p, concat(substring(word, 1, p), substring(word, p + 2)) AS rest FROM (SELECT word, n, unnest(range(length(word)))::INT AS p FROM v)),
shorter AS (SELECT DISTINCT c.word AS long, c.n AS long_n, v.word AS short, v.n AS short_n FROM cut c JOIN v ON v.word = c.rest),
near AS (
  SELECT a.word, b.word AS form, b.n AS form_n FROM cut a JOIN cut b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT long, short, short_n FROM shorter UNION ALL SELECT short, long, long_n FROM shorter),
best AS (
  SELECT word, count(*) AS n_near, first(form ORDER BY form_n DESC, encode(form)) AS form, max(form_n) AS form_n FROM near GROUP BY word),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * v.n THEN form END AS form,
         CASE WHEN form_n >= 2 * v.n THEN form_n END AS form_n FROM v LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS root, 0 AS step FROM forms
  UNION ALL SELECT w.word, f.form, step + 1 FROM walk w JOIN forms f ON f.word = w.root WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(root, step) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""


def damaged(doc_id: Column, run: Column) -> Column:
    """The run, without one of its letters where 97 divides the checksum of id and run."""
    mark = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (mark % F.length(run)).cast("int")
    return F.when(mark % 97 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


@query("op11_spelling_variants", SPELLING_SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"), least_letters=5, least_count=3, damage=damaged)
    return spelling.group_variants(words, times=2)


# op12: SentencePiece encoding and decoding

@query("op12_sentencepiece")
def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                        F.sha2("text", 256).alias("decoded_sha256"))


# op13: filter interaction audit

AUDITED = {
    "A": lambda text, words: F.size(words) < 200,
    "B": lambda text, words: F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
    "C": lambda text, words: (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))) * 100 > F.length(text) * 3,
    "D": lambda text, words: text.rlike("[#$%&*|]"),
}

AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, min(doc_id) OVER (PARTITION BY t) AS lowest FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
         + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(w.doc_id > lowest, false)::INT AS mask,
         coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
k AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
f(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (
  SELECT concat(a.f, b.f, c.f, d.f, e.f) AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM f a, f b, f c, f d, f e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step::INT AS step, bits[step] AS bit, list_sum(bits[1:step])::INT AS upto FROM o, range(1, 6) r(step)),
r AS (
  SELECT part, filter_order, step, bit, sum(n) FILTER (mask & upto = 0) AS kept, sum(n) FILTER (mask & upto = bit) AS removed,
         sum(n) FILTER (mask & bit <> 0) AS failing, sum(n) FILTER (mask = bit) AS unique_fails,
         sum(good) FILTER (mask & upto = bit) AS good_lost, sum(toxic) FILTER (mask & upto = bit) AS toxic_lost
  FROM k, s GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  (coalesce(failing, 0) - coalesce(removed, 0))::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM r"""


@query("op13_filter_audit", AUDIT_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), AUDITED, repeats="E")
