"""The registered corpus queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scale import durable
from . import chat, decontaminate, html_text, language, mixing, quality, recompression, repair, run_index, simhash, spelling, toxicity, url_filter
from .common import residue, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


#: Shares by water-filling without a loop: sorted by clamp over weight, the clamped sources are the first k.
_MIX = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST(('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '?')), 1, 15)) AS BIGINT) AS h, md5(coalesce(text, '')) AS t
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w
  FROM totals),
used AS (SELECT *, 2.0::DOUBLE * source_size AS cap FROM ranked WHERE source_size > 0),
steps AS (
  SELECT cap / w AS ratio, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS k,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM used WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (SELECT level FROM steps WHERE ratio > level ORDER BY k LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN source_size > 0 THEN least(2.0::DOUBLE * source_size, w * coalesce((SELECT level FROM water), 'infinity'::DOUBLE)) ELSE 0.0 END AS target
  FROM ranked),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
laid AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS extra, s.source,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.size, s.t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST((whole + CASE WHEN extra > 0 AND before + size / 2.0::DOUBLE <= extra THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM laid"""


@query(_MIX)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 3, 1, 2 over the sources, 150% of all words, two epochs at most."""
    return mixing.mix_report(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, coalesce(role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text), FALSE) AS joined,
         regexp_replace(text, '([<\[])(\\*)(/?(s>|INST\]|JOIN\]))', '\1\2\\\3', 'g') AS safe_text,
         regexp_replace(role, '([<\[])(\\*)(/?(s>|INST\]|JOIN\]))', '\1\2\\\3', 'g') AS safe_role
  FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(length(safe_text) + CASE WHEN joined THEN 6 ELSE 20 + length(safe_role) END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id"""


@query(_CHAT)
def op3_format_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back, and one whose texts are full of marks."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    mark = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", mark), (-7, 1, "assistant", mark)], rows.schema)
    return chat.format_digest(chat.format_conversations(rows.union(extra)))


@query()
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages learned from four fifths of the documents, told for all of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = residue(F.col("doc_id"), 5) == 0
    net = language.fit_language(docs.filter(~held_out))
    told = docs.select("doc_id", held_out.alias("held_out"), language.language_of(net, F.col("text")).alias("r"))
    return told.select("doc_id", "held_out", "r.lang_pred", "r.score")


@query()
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and distances to the languages' histograms."""
    return quality.judge_quality(table(spark, sf_dir, "documents"))


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity learned from two thirds of the rows, scored for all documents."""
    docs, held_out = table(spark, sf_dir, "documents"), residue(F.col("doc_id"), 3) == 1
    model = toxicity.fit_toxicity(docs.filter(~held_out), table(spark, sf_dir, "labels").filter(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.toxicity_of(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query()
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    text = html_text.main_text(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


#: Word windows of documents against word windows of items, joined on the words themselves.
_DECONTAMINATE = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
items AS (SELECT item_id, w, len(w) AS n, least(len(w), 13) AS size FROM iw WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(w, s, s + size - 1), ' ') AS k FROM (SELECT *, unnest(range(1, n - size + 2)) AS s FROM items)),
sizes AS (SELECT DISTINCT size FROM items),
places AS (SELECT doc_id, size, s, array_to_string(list_slice(w, s, s + size - 1), ' ') AS k
           FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM dw, sizes)),
hits AS (SELECT doc_id, item_id, s, p.size FROM places p JOIN wins USING (size, k)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)"""


@query(_DECONTAMINATE)
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against all 13-word windows of the benchmark."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


@query()
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints over three-word shingles, linked at two differing bits."""
    return simhash.simhash_report(table(spark, sf_dir, "documents"))


@query()
def op10_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 50-word windows that smaller documents have."""
    return recompression.dedup_report(table(spark, sf_dir, "documents"))


@query()
def op8_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 200-byte strings that stand elsewhere too."""
    return run_index.dedup_report(table(spark, sf_dir, "documents"))


#: crc32 over a list of bytes: the table by its rule, then one step a byte.
_CRC_TABLE = """crc AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)))"""


def _crc32(text: str) -> str:
    """SQL for the crc32 of a text whose code points lie below 256."""
    code = (
        f"flatten(list_transform(string_split({text}, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]"
        " WHEN unicode(x) < 192 THEN [194, unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END))"
    )
    return f"xor(list_reduce(list_prepend(4294967295, {code}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


_SPELLING = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents),
counted AS (SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, c, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM counted, crc),
words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS form FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.form = b.form AND a.i = b.i WHERE a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.form = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.form = w.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS top FROM near GROUP BY word),
told AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 5 * w.n THEN other END AS form, CASE WHEN top >= 5 * w.n THEN top END AS form_n
  FROM words w LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS at FROM told UNION ALL SELECT k.word, t.form FROM walk k JOIN told t ON k.at = t.word WHERE t.form IS NOT NULL),
roots AS (SELECT k.word, k.at AS root FROM walk k JOIN told t ON k.at = t.word WHERE t.form IS NULL)
SELECT word, n, n_near, form, form_n, root FROM told JOIN roots USING (word)"""


@query(_SPELLING)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, some damaged on purpose, with their near words, forms and roots."""
    words = durable(spelling.count_words(table(spark, sf_dir, "documents")))
    return spelling.variant_forms(words).select("word", "n", "n_near", "form", "form_n", "root")


def _edit(value: str, cost: str, letter: str, row: str = "''") -> str:
    """A node's value behind one more edit. A value is cost (nine digits), audit, a mark and the repaired lines."""
    return (
        f"(lpad(CAST(CAST(substr({value}, 1, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || '{letter}' || substr(split_part({value}, chr(1), 1), 10)"
        f" || chr(1) || {row} || substr({value}, instr({value}, chr(1)) + 1))"
    )


def _row_edits(s: int) -> str:
    """The least value of state ``s`` before row r without insertions, of the values b.v0 to b.v3 behind it."""
    to, role = ("b.v3", "assistant") if s == 2 else ("b.v2", "user")
    steps = {0: {"s": "b.v1", "u": "b.v2"}, 1: {"u": "b.v2"}, 2: {"a": "b.v3"}, 3: {"u": "b.v2"}}[s]
    line = "r.role || ':' || r.text || chr(10)"
    keep = "".join(f" WHEN substr(r.role, 1, 1) = '{i}' THEN {_edit(v, 'r.cut', 'K', line)}" for i, v in steps.items())
    rename = _edit(to, "2 + r.cut", "R", f"'{role}:' || r.text || chr(10)")
    return f"least({_edit(f'b.v{s}', '3', 'D')}, CASE WHEN r.doomed THEN NULL{keep} END, CASE WHEN NOT r.doomed THEN {rename} END)"


_NOTHING = "('000000000' || chr(1))"
_ADD_USER, _ADD_ASSISTANT = (lambda v, role=role: _edit(v, "2", "I", f"'{role}:' || chr(10)") for role in ("user", "assistant"))
_REPAIR = rf"""
WITH RECURSIVE {_CRC_TABLE},
named AS (
  SELECT coalesce(CAST(conv_id AS VARCHAR), ' ') AS k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
  FROM conversations, crc),
damaged AS (
  SELECT k, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS again FROM named) WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (
  SELECT *, lag(role) OVER (PARTITION BY k ORDER BY i) AS before,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault
  FROM placed),
rows AS (SELECT k, i, role, text, fault IN ('b', 'd') AS doomed, CASE WHEN fault = 't' THEN 1 ELSE 0 END AS cut FROM judged),
found AS (
  SELECT k, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (before IS NOT NULL AND substr(before, 1, 1) || substr(role, 1, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY k),
best AS (
  SELECT k, n + 1 AS i, {_NOTHING} AS v0, {_ADD_USER(_ADD_ASSISTANT(_NOTHING))} AS v1, {_ADD_ASSISTANT(_NOTHING)} AS v2, {_NOTHING} AS v3 FROM found
  UNION ALL
  SELECT k, i, least(v0, {_ADD_USER("w2")}), least(v1, {_ADD_USER("w2")}), w2, w3
  FROM (
    SELECT *, least(v2, {_ADD_ASSISTANT("v3")}) AS w2, least(v3, {_ADD_USER("v2")}) AS w3
    FROM (SELECT r.k, r.i, {_row_edits(0)} AS v0, {_row_edits(1)} AS v1, {_row_edits(2)} AS v2, {_row_edits(3)} AS v3 FROM best b JOIN rows r ON r.k = b.k AND r.i = b.i - 1))),
final AS (SELECT k, v0 FROM best WHERE i = 1)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(substr(v0, 1, 9), '0') AS BIGINT) AS cost, coalesce(substr(split_part(v0, chr(1), 1), 10), '') AS audit,
       sha256(coalesce(regexp_replace(substr(v0, instr(v0, chr(1)) + 1), '\n$', ''), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), ' ') AS k FROM conversations) LEFT JOIN found USING (k) LEFT JOIN final USING (k)"""


@query(_REPAIR)
def op12_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by rule, brought into order again."""
    found = repair.repair_conversations(repair.damage(table(spark, sf_dir, "conversations")))
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    return found.withColumn("repaired_sha256", F.sha2(lines, 256)).drop("repaired")


#: Fixed values of the contract: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]

_URLS = """
WITH cut AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
won AS (
  SELECT host, path, first({r: rule_host || rule_path, v: rule_verdict} ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS best
  FROM (SELECT DISTINCT host, path FROM cut) JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY ALL)
SELECT page_id, host, path, best.r AS rule, coalesce(best.v, 'allow') AS verdict FROM cut LEFT JOIN won USING (host, path)"""


@query(_URLS)
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url under the five rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)
