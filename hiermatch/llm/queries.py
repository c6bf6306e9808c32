"""Registered queries of this subpackage: thin wrappers over the operators, with SQL where SQL can say it."""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import functions as F

from . import bpe
from .common import save, table
from .contamination import contamination
from .exact import exact_dedup
from .lines import line_dedup
from .packing import pack
from .pii import pii
from .quality import quality
from .repair import damage, repair, repaired_digests
from .secrets import joined, secrets
from .simhash import simhash_dedup
from .substring import substring_dedup
from .trie import numbered, prefix_trie, share_openings
from .warc import round_trip

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f
    return add


@query("op1_simhash")
def op1(spark, sf_dir):
    return simhash_dedup(table(spark, sf_dir, "documents"), shingle=3, distance=3)


_WORDS = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"


@query("op2_contamination", f"""
WITH b AS (SELECT DISTINCT item_id, text, {_WORDS.format('text')} AS w FROM benchmark),
i AS (SELECT DISTINCT item_id, text, least(5, len(w)) AS k, array_to_string(w[p:p + least(5, len(w)) - 1], ' ') AS g
      FROM (SELECT *, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
s AS (SELECT doc_id, k, array_to_string(w[p:p + k - 1], ' ') AS g
      FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM i))),
n AS (SELECT item_id, text, count(*) AS n_shingles FROM i GROUP BY ALL),
f AS (SELECT doc_id, item_id, text, count(DISTINCT g) AS n_found FROM s JOIN i USING (k, g) GROUP BY ALL)
SELECT doc_id, item_id, n_shingles, n_found, n_found / n_shingles AS containment
FROM f JOIN n USING (item_id, text) WHERE n_found >= ceil(0.8 * n_shingles - 1e-9)""")
def op2(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=5, threshold=0.8)


@query("op3_exact", """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""")
def op3(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"), keep="max")


@query("op4_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS x FROM pages),
q AS (SELECT page_id, strlen(html) AS payload_bytes, x, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(x, 1 + 5 * (i // 4), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM q""")
def op4(spark, sf_dir):
    return round_trip(spark, table(spark, sf_dir, "pages"), min_revisit_bytes=0)


@query("op5_substring", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, p, sha256(array_to_string(w[p:p + 12], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d)),
m AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY g) AS first_id FROM s) WHERE first_id < doc_id),
x AS (SELECT doc_id, list_distinct(flatten(list(range(p, p + 13)))) AS gone FROM m GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(coalesce(array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT coalesce(list_contains(gone, i), false)), lambda i: w[i]), ' '), '')) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id)""")
def op5(spark, sf_dir):
    return substring_dedup(table(spark, sf_dir, "documents"), window=13)


@query("op6_pii")
def op6(spark, sf_dir):
    out = pii(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                      joined(F.col("found")).alias("spans"))


@query("op7_secrets")
def op7(spark, sf_dir):
    out = secrets(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                      joined(F.col("found")).alias("spans"), "n_random")


@query("op8_packing")
def op8(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))


@query("op9_quality")
def op9(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


@query("op10_lines", """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS w FROM documents),
s AS (SELECT doc_id, p, array_to_string(w[p:p + 2], chr(10)) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d)),
m AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) AS nth FROM s) WHERE nth > 1),
x AS (SELECT doc_id, list_distinct(flatten(list(range(p, p + 3)))) AS gone FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(w), 0) AS n_lines, coalesce(len(gone), 0) AS n_removed,
       sha256(coalesce(array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT coalesce(list_contains(gone, i), false)), lambda i: w[i]), chr(10)), '')) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id)""")
def op10(spark, sf_dir):
    return line_dedup(table(spark, sf_dir, "documents"), min_lines=3)


@query("op10_lines_production", r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS w FROM documents),
s AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], chr(10)) AS g, len(regexp_extract_all(array_to_string(w[p:p + n - 1], chr(10)), '[^\x20\x09-\x0D]+')) AS n_words
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT unnest([1, 2, 3]) AS n))),
c AS (SELECT n, g, min((doc_id, p)) AS f, count(DISTINCT doc_id) AS n_docs FROM s GROUP BY n, g),
m AS (SELECT doc_id, n, p FROM s JOIN c USING (n, g) WHERE (doc_id, p) <> f AND (n = 3 OR n_words >= 50 OR (n_words >= 1 AND n_docs >= 10 AND n = 1))),
x AS (SELECT doc_id, list_distinct(flatten(list(range(p, p + n)))) AS gone FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(w), 0) AS n_lines, coalesce(len(gone), 0) AS n_removed,
       sha256(coalesce(array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT coalesce(list_contains(gone, i), false)), lambda i: w[i]), chr(10)), '')) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id)""")
def op10_production(spark, sf_dir):
    return line_dedup(table(spark, sf_dir, "documents"), min_lines=3, min_words=50, min_docs=10)


#: crc32 of an ASCII string, bit by bit.
_CRC = """CAST(xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({}, ''), lambda x: CAST(ord(x) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT)] || [0, 0, 0, 0, 0, 0, 0]), lambda v, _: xor(v >> 1, 3988292384 * (v & 1))))) AS BIGINT)"""

_TRIE = rf"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_CRC.format("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS part, p, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND p < h
      UNION ALL SELECT conv_id, 1, p, role, text FROM t JOIN c USING (conv_id) WHERE p >= h),
s AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS d, sha256(length(role) || ':' || role || ':' || text) AS k,
             len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM r),
path AS (SELECT conv_id, d, words, sha256(array_to_string(list(k) OVER (PARTITION BY conv_id ORDER BY d), ',')) AS g FROM s UNION ALL SELECT conv_id, 0, 0, '' FROM c),
node AS (SELECT min(conv_id) AS rep, d, g, count(*) AS n, any_value(words) AS words FROM path GROUP BY d, g),
spot AS (SELECT path.conv_id, d, rep FROM path JOIN node USING (d, g)),
kin AS (SELECT node.rep, node.d, n, words, up.rep AS parent FROM node LEFT JOIN spot AS up ON up.conv_id = node.rep AND up.d = node.d - 1),
kid AS (SELECT parent AS rep, d - 1 AS d, count(*) AS n_children FROM kin WHERE parent IS NOT NULL GROUP BY ALL),
cnt AS (SELECT kin.*, coalesce(n_children, 0) AS n_children FROM kin LEFT JOIN kid USING (rep, d)),
sub AS (SELECT spot.rep, spot.d, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n - 1) * words) AS saved FROM cnt JOIN spot ON spot.conv_id = cnt.rep AND spot.d <= cnt.d GROUP BY ALL),
fin AS (SELECT rep, d, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM spot JOIN (SELECT conv_id, max(d) AS d FROM path GROUP BY conv_id) USING (conv_id, d) GROUP BY ALL)
SELECT rep AS conv_id, CAST(d AS BIGINT) AS depth, parent AS parent_conv_id, n AS n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM cnt JOIN sub USING (rep, d) LEFT JOIN fin USING (rep, d)"""


@query("op11_trie", _TRIE)
def op11(spark, sf_dir):
    return prefix_trie(*share_openings(numbered(table(spark, sf_dir, "conversations")), every=20, most=4))


# The lattice row by row: w holds the cheapest, then ASCII-least edits to each place after the first i rows.
_REPAIR = rf"""
WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations),
dam AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
        FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) FROM raw WHERE kind <> 0)),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
               rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM dam),
flt AS (SELECT *, CASE WHEN body = '' THEN 'b' WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault, left(role, 1) AS r,
               lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM num),
cnt AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
               count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM flt GROUP BY conv_id),
ins AS (SELECT * FROM (VALUES (0, 0, '', ''), (1, 1, '', ''), (2, 2, '', ''), (3, 3, '', ''), (0, 2, 'I', 'u'), (1, 2, 'I', 'u'), (3, 2, 'I', 'u'), (2, 3, 'I', 'a'), (0, 3, 'II', 'ua'), (1, 3, 'II', 'ua')) t(q, z, e, x)),
arc AS (SELECT conv_id, i, q, z, e, c, l FROM (
          SELECT f.conv_id, f.i, s.q, CASE k WHEN 'D' THEN s.q WHEN 'R' THEN CASE s.q WHEN 2 THEN 3 ELSE 2 END
                   ELSE CASE WHEN r = 's' AND s.q = 0 THEN 1 WHEN r = 'u' AND s.q IN (0, 1, 3) THEN 2 WHEN r = 'a' AND s.q = 2 THEN 3 END END AS z, k AS e,
                 CASE k WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN k <> 'D' AND fault = 't' THEN 5 ELSE 0 END AS c,
                 CASE k WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text] ELSE [CASE s.q WHEN 2 THEN 'assistant' ELSE 'user' END || ':' || text] END AS l
          FROM flt f, (SELECT unnest([0, 1, 2, 3]) AS q) s, (SELECT unnest(['D', 'K', 'R']) AS k) WHERE k = 'D' OR fault IN ('', 't')) WHERE z IS NOT NULL),
w AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, n, 0 AS q, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM cnt
      UNION ALL
      SELECT conv_id, i, any_value(n), z, min(cost), arg_min(audit, (cost, audit)), arg_min(lines, (cost, audit)) FROM (
        SELECT w.conv_id, w.i + 1 AS i, w.n, arc.z, w.cost + 5 * length(ins.e) + arc.c AS cost, w.audit || ins.e || arc.e AS audit,
               w.lines || list_transform(string_split(ins.x, ''), lambda y: CASE y WHEN 'u' THEN 'user:' ELSE 'assistant:' END)[1:length(ins.x)] || arc.l AS lines
        FROM w JOIN ins ON ins.q = w.q JOIN arc ON arc.conv_id IS NOT DISTINCT FROM w.conv_id AND arc.i = w.i + 1 AND arc.q = ins.z) GROUP BY conv_id, i, z),
fin AS (SELECT conv_id, cost + 5 * length(ins.e) AS cost, audit || ins.e AS audit, lines || list_transform(string_split(ins.x, ''), lambda y: CASE y WHEN 'u' THEN 'user:' ELSE 'assistant:' END)[1:length(ins.x)] AS lines
        FROM w JOIN ins ON ins.q = w.q WHERE w.i = n AND ins.z IN (0, 3)),
best AS (SELECT conv_id, min(cost) AS cost, arg_min(audit, (cost, audit)) AS audit, arg_min(lines, (cost, audit)) AS lines FROM fin GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN cnt ON cnt.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id"""


@query("op12_repair", _REPAIR)
def op12(spark, sf_dir):
    all_turns = table(spark, sf_dir, "conversations")
    turns = damage(all_turns)
    audits = save(repair(turns), "repair-audits")
    found = audits.join(repaired_digests(turns, audits).withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    every = all_turns.select(F.col("conv_id").alias("c")).distinct()
    out = every.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(F.col("c").alias("conv_id"), *found.columns[1:])
    return out.fillna(0, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]).fillna({"audit": "", "repaired_sha256": sha256(b"").hexdigest()})


@query("op13_bpe")
def op13(spark, sf_dir):
    out = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("text", 256).alias("decoded_sha256"))
