"""Registered queries of the subpackage: ``opN_<name>(spark, folder)``, and their SQL twins."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm import (
    conversations, decontaminate, extract, jaccard, packing, quality, rules, search, secrets, simhash,
    toxicity, warc, wavelet,
)
from shelfwise.llm.common import table


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    index = warc.write(table(spark, folder, "pages"))
    return warc.read(index).drop("url", "payload")


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, folder, "labels")))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.judged(table(spark, folder, "documents"))
    return found.drop("lost_chars", "cleaned")


def op6_extract(spark: SparkSession, folder: str) -> DataFrame:
    return extract.extract(table(spark, folder, "pages"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op8_tokens(spark: SparkSession, folder: str) -> DataFrame:
    shards = wavelet.write_shards(
        table(spark, folder, "documents"), tokenizer("word_bpe_49k.json")
    )
    return wavelet.read_documents(shards).drop("ids")


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def op11_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near(table(spark, folder, "documents"))


def op12_conversations(spark: SparkSession, folder: str) -> DataFrame:
    faulty = conversations.damaged(table(spark, folder, "conversations"))
    return conversations.repair(faulty, present="present")


def op13_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_decontamination": op2_decontamination,
    "op3_warc": op3_warc,
    "op4_quality": op4_quality,
    "op5_quality_rules": op5_quality_rules,
    "op6_extract": op6_extract,
    "op7_toxicity": op7_toxicity,
    "op8_tokens": op8_tokens,
    "op9_packing": op9_packing,
    "op10_secrets": op10_secrets,
    "op11_jaccard": op11_jaccard,
    "op12_conversations": op12_conversations,
    "op13_search": op13_search,
}


_LINE = "{{'c': {0}.c + {1}, 'a': '{2}' || {0}.a, 't': list_prepend({3}, {0}.t)}}"


def _least(*options: str) -> str:
    return f"list_min(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))"


def _put_in(vector: str) -> str:
    """Each state's best with an inserted turn in front allowed; states are v0 to v3."""
    after = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))
    return ", ".join(
        _least(f"{vector}{q}", _LINE.format(f"{vector}{n}", 3, "I", f"'{role}:'")) + f" AS v{q}"
        for q, (n, role) in enumerate(after)
    )


def _used_up(q: int) -> str:
    """The best of state ``q`` that uses up row ``r``, from the states v0 to v3 after it."""
    kept = {0: (("s", 1), ("u", 2)), 1: (("u", 2),), 2: (("a", 3),), 3: (("u", 2),)}[q]
    fitted, role = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))[q]
    own, made = "r.role || ':' || r.text", f"'{role}:' || r.text"
    options = [f"{{'c': v{q}.c + 4, 'a': 'D' || v{q}.a, 't': v{q}.t}}"]
    options += [
        f"CASE WHEN fault NOT IN (1, 2) AND r.initial = '{i}' THEN "
        + _LINE.format(f"v{n}", "CASE fault WHEN 3 THEN 3 ELSE 0 END", "K", own) + " END"
        for i, n in kept
    ]
    options.append(
        "CASE WHEN fault NOT IN (1, 2) THEN "
        + _LINE.format(f"v{fitted}", "CASE fault WHEN 3 THEN 6 ELSE 3 END", "R", made) + " END"
    )
    return _least(*options)


_END = "{'c': CAST(0 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])}"
_FAR = "{'c': CAST(1000 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])}"

ORACLES = {
    "op11_jaccard": r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT r, doc_id, list_sort(list_distinct(CASE
      WHEN w IS NULL OR len(w) = 0 THEN []
      WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1),
                          lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS s
  FROM d
), class AS (
  SELECT s, md5(array_to_string(s, chr(10))) AS h, min(doc_id) AS least FROM s WHERE len(s) > 0 GROUP BY s
), shingle AS (SELECT h, len(s) AS n, unnest(s) AS x FROM class),
pair AS (
  SELECT a.h AS a, b.h AS b
  FROM shingle a JOIN shingle b ON a.x = b.x AND a.h <> b.h AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.h, b.h, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
  SELECT h AS a, h AS b FROM class
  UNION
  SELECT reach.a, pair.b FROM reach JOIN pair ON reach.b = pair.a
), root AS (SELECT a AS h, min(least) AS component_id FROM reach JOIN class ON b = h GROUP BY a)
SELECT doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
       CASE WHEN len(s.s) = 0 THEN doc_id ELSE component_id END AS component_id
FROM s LEFT JOIN class ON s.s = class.s LEFT JOIN root USING (h)
""",
    "op12_conversations": rf"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
), lot AS (
  SELECT *, xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(
      range(8 * length(k)),
      lambda i: CAST((ascii(substr(k, CAST(i // 8 + 1 AS INT), 1)) >> CAST(i % 8 AS INT)) & 1 AS BIGINT))),
    lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384))) % 20 AS lot
  FROM src
), hurt AS (
  SELECT conv_id, turn, CASE lot WHEN 4 THEN 'user' ELSE role END AS role,
         CASE lot WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE lot WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM lot WHERE lot <> 0
), placed AS (
  SELECT *, row_number() OVER (
      PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, CAST('0x' || substr(md5(role || ':' || text), 1, 15) AS BIGINT), copy
    ) AS i, substr(role, 1, 1) AS initial
  FROM hurt
), judged AS (
  SELECT *, CASE
      WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS former
  FROM placed
), counted AS (
  SELECT conv_id, max(i) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (former IS NOT NULL AND former || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), step AS (
  SELECT conv_id, n AS i, {_put_in("v")} FROM (
    SELECT conv_id, n, {_put_in("v")} FROM (
      SELECT conv_id, n, {_END} AS v0, {_FAR} AS v1, {_FAR} AS v2, {_END} AS v3 FROM counted
    )
  )
  UNION ALL
  SELECT conv_id, i, {_put_in("v")} FROM (
    SELECT conv_id, i, {_put_in("v")} FROM (
      SELECT s.conv_id, s.i - 1 AS i, {_used_up(0)} AS v0, {_used_up(1)} AS v1,
             {_used_up(2)} AS v2, {_used_up(3)} AS v3
      FROM step s JOIN judged r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i
    )
  )
), best AS (SELECT conv_id, v0 FROM step WHERE i = 0)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps,
       CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
       CAST(coalesce(v0.c, 0) AS BIGINT) AS cost, coalesce(v0.a, '') AS audit,
       sha256(coalesce(array_to_string(v0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counted c ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON a.conv_id IS NOT DISTINCT FROM b.conv_id
""",
    "op13_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), held AS (SELECT r, doc_id, len(w) AS n, w FROM d WHERE len(w) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM held),
tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM held) GROUP BY r, term
), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
item AS (
  SELECT DISTINCT i, item_id, unnest(w) AS term FROM (
    SELECT row_number() OVER () AS i, item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM benchmark)
), weighed AS (
  SELECT i, item_id, term,
         CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM item JOIN df USING (term), total
), scored AS (
  SELECT i, item_id, r, doc_id,
         CAST(sum(weighed.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // length)))) AS BIGINT) AS score
  FROM weighed JOIN tf USING (term) JOIN held USING (r), total GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
""",
    "op3_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS h
  FROM pages
), f AS (SELECT h, min(page_id) AS least FROM p WHERE n >= 100 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN least IS NOT NULL AND least IS DISTINCT FROM page_id THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN least IS DISTINCT FROM page_id THEN least END AS refers_to
FROM p LEFT JOIN f USING (h)
""",
    "op5_quality_rules": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d
), cut AS (
  SELECT r, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i
  FROM d
), line AS (
  SELECT r, i, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw,
         row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS again,
         regexp_matches(line, '[__STOPS__…:;]["''”’)»\]]*([\x20\x09-\x0D]|$)') AS ended,
         sum(CASE WHEN regexp_matches(line, '__GOES_ON__') THEN 0 ELSE 1 END)
           OVER (PARTITION BY r ORDER BY i) AS run
  FROM cut
), wrapped AS (
  SELECT *, bool_or(ended) OVER (PARTITION BY r, run ORDER BY i DESC) AS ends FROM line
), sized AS (
  SELECT r, line, lw, again, ends, len(lw) AS n, length(array_to_string(lw, '')) AS chars,
         length(regexp_replace(line, '[^|»›•·]', '', 'g')) AS separators,
         length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS symbols
  FROM wrapped WHERE len(lw) > 0
), judged AS (
  SELECT r, again, chars,
    again
    OR separators >= 3 AND n <= 6 * separators
    OR 10 * symbols > chars
    OR n >= 3 AND NOT regexp_matches(line, '\p{Ll}') AND regexp_matches(line, '\p{Lu}')
    OR n >= 4 AND NOT ends
    OR n >= 8 AND 3 * len(list_distinct(lw)) < n
    OR n <= 20 AND regexp_matches(line, '__BOILERPLATE__') AS fails
  FROM sized
), lost AS (
  SELECT r, count(*) FILTER (again) AS dup, coalesce(sum(chars) FILTER (fails), 0) AS lost
  FROM judged GROUP BY r
), windows AS (
  SELECT r, i, list_slice(w, i, i + 4) AS five
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)
), many AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, five) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM many, (SELECT unnest(range(5)) AS k) GROUP BY r
), f AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM w LEFT JOIN lost USING (r) LEFT JOIN covered USING (r)
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost <= 30 * word_chars AS kept
FROM b
""".replace("__BOILERPLATE__", rules.BOILERPLATE)
    .replace("__STOPS__", re.escape(rules.STOPS))
    .replace("__GOES_ON__", rules.GOES_ON.replace("'", "''")),
}
