"""Registered queries of the operators, with their DuckDB SQL where SQL can say it.

Each query is thin: it reads its whole table, calls the operator with its production
parameters, and derives the contract's columns.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import read_table, ship_package
from tierline.llm.conversation_repair import repair_conversations
from tierline.llm.exact_dedup import exact_dedup
from tierline.llm.line_dedup import line_dedup
from tierline.llm.minhash import near_duplicates
from tierline.llm.mixing import mix_sources
from tierline.llm.packing import pack_documents
from tierline.llm.quotes import reply_ordered
from tierline.llm.substring_dedup import substring_dedup
from tierline.llm.token_counts import token_counts
from tierline.llm.topk_search import top_k
from tierline.llm.toxicity import learn, score
from tierline.llm.url_rules import CONFIDENCE, SUPPORT, ListedRule, judge_urls
from tierline.llm.whitening import whiten

MIX_WEIGHTS = {"domain": {"crawl": 1, "curated": 3}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.6, 2, 17

#: The listed rules of op12.
URL_RULES = (ListedRule("block", "net/"), ListedRule("allow", "example.net/en/"),
             ListedRule("block", "example.com/de/"), ListedRule("allow", "org/fr/"))


def mix_levels() -> dict:
    """domain, language, source: the hot source ``src0`` is the crawl, others are curated."""
    domain = F.when(F.col("source") == "src0", "crawl").when(F.col("source").isNotNull(), "curated")
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def held_out() -> Column:
    """The rows whose labels nothing is learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, read_table(spark, sf_dir, "documents"), keep="max")


def op2_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_ordered(spark, read_table(spark, sf_dir, "conversations")).drop("own_text")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, read_table(spark, sf_dir, "documents"), percent=85)


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark, read_table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, k=5)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(spark, read_table(spark, sf_dir, "documents")).drop("kept_text")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spark, read_table(spark, sf_dir, "documents"), window=13, keep_text=False).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mixed = mix_sources(spark, docs, mix_levels(), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    return mixed.select("doc_id", F.col("mix_epoch").alias("epoch"), F.col("mix_domain").alias("domain"),
                        F.col("mix_lang").alias("lang"), F.col("mix_source").alias("source"),
                        F.col("mix_tokens").alias("tokens"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark, read_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = learn(spark, docs, read_table(spark, sf_dir, "labels"), ~held_out())
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_matches", "n_words")


def damaged(rows: DataFrame) -> DataFrame:
    """The rows that op11 repairs, by a checksum of conversation and turn: 0 drops a row
    (it stays as ``absent``), 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4
    makes its role user.  NULLs count as one space."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    drawn = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("_kind"))
    return drawn.select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
            F.col("text")).alias("text"), (F.col("_kind") == 0).alias("absent"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(read_table(spark, sf_dir, "conversations"))
    return repair_conversations(spark, rows, absent=F.col("absent"))


def op12_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark, read_table(spark, sf_dir, "pages"), URL_RULES)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark, read_table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: _shipped(f) for f in (
    op1_exact_dedup, op2_quote_threads, op3_minhash, op4_topk, op5_line_dedup, op6_substring_dedup, op7_mixing,
    op8_packing, op9_token_counts, op10_toxicity, op11_conversation_repair, op12_url_rules, op13_whitening)}

_OP2 = r"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
lined AS (
  SELECT conv_id, turn, uid, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls
  FROM (SELECT *, row_number() OVER () AS uid FROM (SELECT DISTINCT conv_id, turn, text FROM base
    WHERE conv_id IS NOT NULL AND turn IS NOT NULL))),
numbered AS (
  SELECT conv_id, turn, uid, unnest(range(1, len(ls) + 1)) AS n, ls FROM lined),
parsed AS (
  SELECT conv_id, turn, uid, n,
    CASE WHEN regexp_matches(ls[n], '^[^>]*\b(wrote|writes|schrieb|escribió|écrit)[ \t]*:[ \t]*$')
              AND regexp_matches(coalesce(ls[n + 1], ''), '^[ \t]*>') THEN -1
         ELSE length(regexp_replace(regexp_extract(ls[n], '^((?:[ \t]*>)+)', 1), '[^>]', '', 'g')) END AS level,
    lower(trim(regexp_replace(regexp_replace(ls[n], '^((?:[ \t]*>)+)', ''), '\s+', ' ', 'g'))) AS norm
  FROM numbered),
marked AS (
  SELECT *, sum(CAST(turned AS INT)) OVER w AS passage, sum(CAST(turned OR norm = '' AS INT)) OVER w AS paragraph
  FROM (SELECT *, coalesce(level <> lag(level) OVER (PARTITION BY uid ORDER BY n), true) AS turned FROM parsed)
  WINDOW w AS (PARTITION BY uid ORDER BY n)),
worded AS (
  SELECT conv_id, turn, uid, n, level, norm,
    string_agg(norm, ' ' ORDER BY n) OVER (PARTITION BY uid, paragraph) AS para,
    string_agg(norm, ' ' ORDER BY n) OVER (PARTITION BY uid, passage) AS whole,
    string_agg(norm, ' ' ORDER BY n) OVER (PARTITION BY uid, level) AS all_of_level
  FROM marked WHERE norm <> '' AND level >= 0),
own_units AS (
  SELECT DISTINCT conv_id, turn, unnest([norm, para, all_of_level]) AS unit FROM worded WHERE level = 0),
quoted AS (
  SELECT conv_id, turn, uid, n, level, unnest(list_distinct([norm, para, whole])) AS unit FROM worded WHERE level > 0),
found AS (
  SELECT q.conv_id, q.turn, q.uid, q.n, q.level, q.unit, max(o.turn) AS origin FROM quoted q
  LEFT JOIN own_units o ON o.conv_id = q.conv_id AND o.unit = q.unit AND o.turn < q.turn GROUP BY ALL),
links AS (
  SELECT conv_id, turn, uid, n, max(origin) AS origin FROM found GROUP BY ALL),
votes AS (
  SELECT c.conv_id, c.turn, c.origin, count(DISTINCT (f.uid, f.n)) AS v
  FROM (SELECT DISTINCT conv_id, turn, origin FROM found WHERE level = 1 AND origin IS NOT NULL) c
  JOIN found f ON f.conv_id = c.conv_id AND f.turn = c.turn AND f.level = 1
  JOIN own_units o ON o.conv_id = c.conv_id AND o.turn = c.origin AND o.unit = f.unit GROUP BY ALL),
parents AS (
  SELECT conv_id, turn, origin AS parent_turn FROM votes
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY v DESC, origin DESC) = 1),
paths AS (
  SELECT conv_id, turn, parent_turn AS up, 1 AS steps FROM parents
  UNION ALL
  SELECT w.conv_id, w.turn, p.parent_turn, w.steps + 1 FROM paths w
  JOIN parents p ON p.conv_id = w.conv_id AND p.turn = w.up),
roots AS (
  SELECT conv_id, turn, min(up) AS root_turn, max(steps) AS depth FROM paths GROUP BY conv_id, turn),
counts AS (
  SELECT conv_id, turn, count(*) AS n_quoted, count(origin) AS n_linked FROM links GROUP BY conv_id, turn),
own AS (
  SELECT b.conv_id, b.turn, b.role, CASE WHEN contains(b.text, '>') THEN trim(array_to_string(list_filter(
      list_transform(range(1, len(ls) + 1), lambda i: CASE WHEN regexp_matches(ls[i], '^[ \t]*>') OR
        (regexp_matches(ls[i], '^[^>]*\b(wrote|writes|schrieb|escribió|écrit)[ \t]*:[ \t]*$')
         AND regexp_matches(coalesce(ls[i + 1], ''), '^[ \t]*>')) THEN NULL ELSE ls[i] END),
      lambda x: x IS NOT NULL), chr(10))) ELSE b.text END AS own_text
  FROM (SELECT *, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM base) b)
SELECT o.conv_id, o.turn, o.role, p.parent_turn, coalesce(r.root_turn, o.turn) AS root_turn,
  CAST(coalesce(r.depth, 0) AS BIGINT) AS depth, CAST(coalesce(c.n_quoted, 0) AS BIGINT) AS n_quoted,
  CAST(coalesce(c.n_linked, 0) AS BIGINT) AS n_linked, sha256(own_text) AS own_sha256
FROM own o LEFT JOIN parents p ON p.conv_id = o.conv_id AND p.turn = o.turn
LEFT JOIN roots r ON r.conv_id = o.conv_id AND r.turn = o.turn
LEFT JOIN counts c ON c.conv_id = o.conv_id AND c.turn = o.turn
"""

_OP6 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
pos AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
win AS (
  SELECT doc_id, i, ws[i] AS word,
    CASE WHEN i + 12 <= len(ws) THEN array_to_string(ws[i:i + 12], ' ') END AS key FROM pos),
flagged AS (
  SELECT doc_id, i, word,
    CASE WHEN key IS NOT NULL AND min(doc_id) OVER (PARTITION BY key) < doc_id THEN 1 ELSE 0 END AS hit FROM win),
cover AS (
  SELECT doc_id, i, word, max(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone
  FROM flagged),
kept AS (
  SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed,
    coalesce(string_agg(CASE WHEN gone = 0 THEN word END, ' ' ORDER BY i), '') AS kept FROM cover GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""


def _repair_sql() -> str:
    """The four states as (cost, audit, output) structs, one recursion step per row."""
    def least(*states: str) -> str:
        return f"list_min([{', '.join(states)}])"

    def add(state: str, cost: str, letter: str, row: str | None = None) -> str:
        out = f"{state}.o" + (f" || chr(10) || {row}" if row else "")
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {out}}} END"

    def keep(state: str, initial: str) -> str:
        return f"CASE WHEN NOT must AND initial = '{initial}' THEN {add(state, 'extra', 'K', chr(39) * 2 + ' || role || ' + chr(39) + ':' + chr(39) + ' || text')} END"

    def rerole(state: str, to: str) -> str:
        return f"CASE WHEN NOT must THEN {add(state, '1 + extra', 'R', f'{chr(39)}{to}:{chr(39)} || text')} END"

    def insert(state: str, to: str) -> str:
        return add(state, "5", "I", f"'{to}:'")

    opened = f"""least2 AS t2, {least("s3", insert("least2", "assistant"))} AS t3"""
    closure = least("s2", insert("s0", "user"), insert("s1", "user"), insert("s3", "user"))
    return rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
drawn AS (
  SELECT *, xor(list_reduce(list_transform(range(0, len(s)), lambda i: CAST(ascii(s[i + 1]) AS BIGINT)),
      lambda acc, b: list_reduce([xor(acc, b)] || range(0, 8), lambda r, z: xor(r >> 1, 3988292384 * (r & 1))),
      4294967295), 4294967295) % 20 AS kind FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM drawn),
numbered AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(len(role) || ':' || role || text), copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM damaged),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS clash FROM numbered),
moves AS (
  SELECT conv_id, i, role, text, initial, fault IN ('blank', 'duplicate') AS must,
    CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS extra FROM faulty),
steps AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'a': '', 'o': ''}} AS s0,
    CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR)) AS s1, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR)) AS s2,
    CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR)) AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {add("s0", "2", "D")}, {least(add("s1", "2", "D"), keep("s0", "s"))},
    {least(add("t2", "2", "D"), keep("s0", "u"), keep("s1", "u"), keep("t3", "u"), rerole("s0", "user"), rerole("s1", "user"), rerole("t3", "user"))},
    {least(add("t3", "2", "D"), keep("t2", "a"), rerole("t2", "assistant"))}
  FROM (SELECT *, {opened} FROM (
    SELECT s.conv_id, m.i, m.role, m.text, m.initial, m.must, m.extra, s0, s1, s3, {closure} AS least2
    FROM steps s JOIN moves m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.i = s.i + 1))),
facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (clash) AS illegal FROM faulty GROUP BY conv_id),
ended AS (
  SELECT s.conv_id, f.gaps, f.blank, f.duplicate, f.truncated, f.illegal,
    {least("s0", least("s3", insert(closure, "assistant")))} AS best
  FROM steps s LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM s.conv_id WHERE s.i = coalesce(f.n, 0))
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit,
  sha256(substr(best.o, 2)) AS repaired_sha256 FROM ended
"""


def _url_sql() -> str:
    """Every token combination of every decided URL, counted; then the winning rule."""
    fits = {r: f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))" for r in URL_RULES}
    ranked = sorted(URL_RULES, key=lambda r: -len(r.text))
    rule, verdict = ("CASE " + " ".join(f"WHEN {fits[r]} THEN '{v(r)}'" for r in ranked) + " END"
                     for v in (lambda r: r.text, lambda r: r.verdict))
    return rf"""
WITH split AS (
  SELECT page_id, url, coalesce(contains(url, '://'), false) AS full_url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
pieces AS (
  SELECT *, string_split(host, '.') AS ls, string_split(path, '/') AS ps, {rule} AS rule, {verdict} AS listed,
    list_sort(list_distinct(list_transform(string_split(coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), ''), '&'),
      lambda p: string_split(p, '=')[1]))) AS ks FROM split),
judged AS (
  SELECT row_number() OVER () AS uid, page_id, host, path, rule, listed, CASE WHEN full_url THEN list_sort(list_filter([
      'scheme:' || nullif(translate(regexp_extract(url, '(?s)^(.*?)://', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''),
      'tld:' || nullif(ls[-1], ''), CASE WHEN len(ls) >= 2 THEN 'site:' || ls[-2] || '.' || ls[-1] END,
      CASE WHEN len(ls) >= 3 THEN 'name:' || nullif(ls[-3], '') END,
      CASE WHEN len(ls) >= 4 THEN 'sub:' || nullif(array_to_string(ls[1:len(ls) - 3], '.'), '') END,
      CASE WHEN contains(host, '-') THEN 'hyphen:yes' END, CASE WHEN len(ps) > 1 THEN 'dir:' || nullif(ps[2], '') END,
      CASE WHEN len(ps) > 2 THEN 'page:' || nullif(regexp_replace(ps[3], '[0-9]+', '#', 'g'), '') END,
      'ext:' || nullif(regexp_extract(path, '\.([A-Za-z0-9]{{1,5}})$', 1), ''),
      'keys:' || nullif(array_to_string(ks, ','), ''),
      CASE WHEN contains(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '#') THEN 'frag:yes' END],
      lambda t: t IS NOT NULL)) ELSE [] END AS toks FROM pieces),
total AS (SELECT count(*) AS n FROM judged j JOIN (SELECT 1) ON listed IS NOT NULL),
combos AS (
  SELECT listed, list_filter(toks, lambda t, i: (m >> (i - 1)) & 1 = 1) AS items
  FROM (SELECT listed, toks, unnest(range(1, 1 << len(toks))) AS m FROM judged WHERE listed IS NOT NULL)),
both_ AS (SELECT items, listed AS label, count(*) AS n FROM combos GROUP BY ALL),
rules AS (
  SELECT items, label, n, n / sum(n) OVER (PARTITION BY items) AS confidence FROM both_
  QUALIFY n >= ceil({SUPPORT} * (SELECT n FROM total)) AND n / sum(n) OVER (PARTITION BY items) >= {CONFIDENCE}),
hits AS (
  SELECT uid, r.* FROM (SELECT uid, toks FROM judged WHERE listed IS NULL) j JOIN rules r ON list_has_all(j.toks, r.items)
  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY confidence DESC, r.n DESC, len(items), items, label) = 1)
SELECT page_id, host, path, rule, coalesce(listed, label, 'allow') AS verdict,
  CASE WHEN listed IS NULL THEN array_to_string(items, ' ') END AS evidence,
  CASE WHEN listed IS NULL THEN confidence END AS confidence FROM judged LEFT JOIN hits USING (uid)
"""


def _mix_sql() -> str:
    """The water levels of the three tree levels, then the seeded prefix of each leaf."""
    def weight(level: str) -> str:
        cases = "".join(f" WHEN '{v}' THEN {w}" for v, w in MIX_WEIGHTS.get(level, {}).items())
        return f"CASE {level}{cases} ELSE 1 END" if cases else "1"

    ctes, names, parent = [], ["domain", "lang", "source"], None
    for depth, level in enumerate(names):
        path, above = ", ".join(names[:depth + 1]), ", ".join(names[:depth])
        over = f"PARTITION BY {above} " if above else ""
        target = "(SELECT CAST(floor(sum(size) * CAST(0.6 AS DOUBLE)) AS BIGINT) FROM leaves)" if not depth else "p.budget"
        join = f" JOIN {parent} p USING ({above})" if above else ""
        ctes.append(f"""
n{depth} AS (
  SELECT {path}, sum(capacity) AS capacity, {weight(level)} AS weight, any_value(target) AS target
  FROM (SELECT leaves.*, {target} AS target FROM leaves{join}) GROUP BY {path}),
r{depth} AS (
  SELECT *, CAST(target - coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS rise
  FROM n{depth} WINDOW w AS ({over}ORDER BY CAST(capacity AS DOUBLE) / weight, {level})),
l{depth} AS (
  SELECT *, max(CASE WHEN CAST(capacity AS DOUBLE) / weight > rise THEN rise END) OVER ({over}) AS water FROM r{depth}),
b{depth} AS (
  SELECT {path}, CAST(greatest(0, CASE WHEN water IS NULL THEN capacity
    ELSE least(capacity, floor(water * weight)) END) AS BIGINT) AS budget FROM l{depth})""")
        parent = f"b{depth}"
    return f"""
WITH slim AS (
  SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS BIGINT) AS tokens,
    CASE WHEN source = 'src0' THEN 'crawl' WHEN source IS NOT NULL THEN 'curated' ELSE '(none)' END AS domain,
    coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source FROM documents),
leaves AS (
  SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS size, CAST(sum(tokens) * {MIX_EPOCHS} AS BIGINT) AS capacity
  FROM slim GROUP BY domain, lang, source),{",".join(ctes)},
plan AS (
  SELECT domain, lang, source, budget // size AS whole, budget - (budget // size) * size AS rest
  FROM b2 JOIN leaves USING (domain, lang, source) WHERE size > 0),
keyed AS (
  SELECT s.*, whole, rest, md5(concat_ws('-', '{MIX_SEED}', CAST(whole AS VARCHAR), CAST(doc_id AS VARCHAR))) AS k
  FROM slim s JOIN plan USING (domain, lang, source)),
run AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY k RANGE UNBOUNDED PRECEDING) AS through FROM keyed),
taken AS (SELECT *, whole + CASE WHEN rest > 0 AND through <= rest THEN 1 ELSE 0 END AS times FROM run)
SELECT doc_id, unnest(range(0, CAST(times AS BIGINT))) AS epoch, domain, lang, source, tokens FROM taken
"""


ORACLE: dict[str, str] = {
    "op1_exact_dedup": """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""",
    "op2_quote_threads": _OP2,
    "op4_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score FROM s QUALIFY rank <= 5""",
    "op6_substring_dedup": _OP6,
    "op7_mixing": _mix_sql(),
    "op11_conversation_repair": _repair_sql(),
    "op12_url_rules": _url_sql(),
}
