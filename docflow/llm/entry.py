"""The queries of this subpackage, by name, and the SQL that gives their rows where SQL can."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers

from . import bpe, decontam, euclid_lsh, importance, langid, multi_index, order_minhash, prefix_trie, repeats, sharding, substring, token_files, toxicity
from .common import table


def op1_order_minhash(spark, sf_dir):
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_inverted_multi_index(spark, sf_dir):
    return multi_index.search(table(spark, sf_dir, "embeddings"))


def op3_suffix_array_dedup(spark, sf_dir):
    return repeats.dedup(table(spark, sf_dir, "documents"))


def op4_ordinal_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_vector_bin_packing(spark, sf_dir):
    return sharding.pack(table(spark, sf_dir, "documents"))


def op6_template_decontamination(spark, sf_dir):
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("th")


def op7_bit_plane_tokens(spark, sf_dir):
    return token_files.token_file(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_word_first_language(spark, sf_dir):
    return langid.language_id(table(spark, sf_dir, "documents"))


def op9_doubling_substring_dedup(spark, sf_dir):
    return substring.dedup(table(spark, sf_dir, "documents"))


def op10_distinct_word_bpe(spark, sf_dir):
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_p_stable_near_dedup(spark, sf_dir):
    return euclid_lsh.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_prefix_doubling_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_hashed_importance(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries():
    own = (op1_order_minhash, op2_inverted_multi_index, op3_suffix_array_dedup, op4_ordinal_toxicity, op5_vector_bin_packing, op6_template_decontamination, op7_bit_plane_tokens, op8_word_first_language, op9_doubling_substring_dedup, op10_distinct_word_bpe, op11_p_stable_near_dedup, op12_prefix_doubling_trie, op13_hashed_importance)
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


OP9_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), starts AS (
  SELECT doc_id, unnest(range(len(ws) - 49)) AS p, ws FROM w WHERE len(ws) >= 50
), win AS (
  SELECT doc_id, p, md5(array_to_string(ws[p + 1:p + 50], ' ')) AS h FROM starts
), later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY h) AS first FROM win) WHERE doc_id > first
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM later
), per AS (
  SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id
), kept AS (
  SELECT w.doc_id, w.ws, per.gone, unnest(range(len(w.ws))) AS i FROM w LEFT JOIN per USING (doc_id)
), joined AS (
  SELECT k.doc_id, string_agg(k.ws[k.i + 1], ' ' ORDER BY k.i) AS s FROM kept k ANTI JOIN gone g ON k.doc_id = g.doc_id AND k.i = g.i GROUP BY k.doc_id
), runs AS (
  SELECT doc_id, count(*) AS n FROM gone a WHERE NOT EXISTS (SELECT 1 FROM gone b WHERE b.doc_id = a.doc_id AND b.i = a.i - 1) GROUP BY doc_id
)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(len(per.gone), 0)::BIGINT AS n_removed, sha256(coalesce(joined.s, '')) AS kept_sha256, coalesce(runs.n, 0)::BIGINT AS n_spans
FROM w LEFT JOIN per USING (doc_id) LEFT JOIN joined USING (doc_id) LEFT JOIN runs USING (doc_id)
"""

OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), win AS (
  SELECT doc_id, p, md5(substr(x, 2 * p + 1, 200)) AS h FROM (SELECT doc_id, x, unnest(range(len(x) // 2 - 99)) AS p FROM d WHERE len(x) >= 200)
), later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY h ORDER BY doc_id, p) AS n FROM win) WHERE n > 1
), spans AS (
  SELECT doc_id, min(p) AS a, max(p) + 100 AS b
  FROM (SELECT doc_id, p, sum(cut) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM (SELECT doc_id, p, CASE WHEN p - lag(p, 1, -1000) OVER (PARTITION BY doc_id ORDER BY p) > 100 THEN 1 ELSE 0 END AS cut FROM later))
  GROUP BY doc_id, g
), gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS s, a AS e FROM spans
  UNION ALL
  SELECT d.doc_id, coalesce(m.b, 0), len(d.x) // 2 FROM d LEFT JOIN (SELECT doc_id, max(b) AS b FROM spans GROUP BY doc_id) m USING (doc_id)
), kept AS (
  SELECT g.doc_id, string_agg(substr(d.x, 2 * g.s + 1, 2 * (g.e - g.s)), '' ORDER BY g.s) AS x FROM gaps g JOIN d USING (doc_id) GROUP BY g.doc_id
), sums AS (
  SELECT doc_id, sum(b - a) AS n, count(*) AS m FROM spans GROUP BY doc_id
)
SELECT d.doc_id, (len(d.x) // 2)::BIGINT AS n_bytes, coalesce(sums.n, 0)::BIGINT AS n_removed, coalesce(sums.m, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.x, ''))) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


#: The rules as SQL of their own: what they say must agree with the operator's, so a wrong one shows.
UNITS_SQL = (
    "percent|gallons|seconds|minutes|inches|meters|metres|meter|metre|pounds|liters|litres|ounces|gallon|degrees|dollars|second|minute|kilograms|kilogram|months|inch|feet|foot|yards|yard|miles|mile|"
    "grams|gram|tonnes|tons|ton|ounce|pound|liter|litre|pints|pint|cups|cup|hours|hour|days|day|weeks|week|month|years|year|volts|volt|amps|amp|joules|joule|kcal|cents|cent|euros|euro|dollar|degree|"
    "km/h|mph|kmh|mhz|ghz|khz|hz|min|sec|usd|eur|bar|psi|cal|mm|cm|km|in|ft|yd|mi|mg|kg|oz|lbs|lb|ml|cl|ms|hr|kw|mw|kj|pa|m|g|t|l|s|h|w|v"
)


def _canonical_sql(x):
    x = f"regexp_replace({x}, '[0-9]+([.,][0-9]+)*', '0n', 'g')"
    x = rf"regexp_replace({x}, '(0n ?)({UNITS_SQL})\b', '\10u', 'g')"
    return rf"lower(regexp_replace({x}, '(^|[^\p{{L}}\p{{N}}])\p{{Lu}}\p{{L}}*\p{{Ll}}\p{{L}}*', '\10a', 'g'))"


def _words_sql(x):
    return rf"""string_split_regex(trim(translate({x}, '.,;:!?"''()[]{{}}', ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+')"""


def op6_sql():
    slot = "contains(x, '0n') OR contains(x, '0u') OR contains(x, '0a')"
    return f"""
WITH it AS (
  SELECT row_number() OVER () AS r, item_id, {_words_sql(_canonical_sql('text'))} AS w, {_words_sql(_canonical_sql('lower(text)'))} AS low, {_words_sql('lower(text)')} AS raw FROM benchmark WHERE text IS NOT NULL
), sized AS (
  SELECT *, least(8, len(w)) AS size FROM it WHERE len(w) >= 5
), ex AS (
  SELECT r, item_id, size, w, low, raw, unnest(range(len(w) - size + 1)) AS ipos FROM sized
), bw0 AS (
  SELECT r, item_id, size, ipos, w[ipos + 1:ipos + size] AS win, low[ipos + 1:ipos + size] AS lowwin, raw[ipos + 1:ipos + size] AS vals FROM ex
), bw1 AS (
  SELECT * FROM bw0 WHERE len(list_filter(win, lambda x: NOT ({slot}))) >= 4
), exact AS (
  SELECT item_id, least(8, len(raw)) AS size, raw, unnest(range(len(raw) - least(8, len(raw)) + 1)) AS ipos FROM it WHERE raw <> [''] AND r NOT IN (SELECT r FROM bw1)
), bw AS (
  SELECT FALSE AS exact, item_id, size, ipos, win, vals, array_to_string(win, ' ') AS k FROM bw1 UNION SELECT FALSE, item_id, size, ipos, lowwin, vals, array_to_string(lowwin, ' ') FROM bw1
  UNION SELECT TRUE, item_id, size, ipos, raw[ipos + 1:ipos + size], raw[ipos + 1:ipos + size], array_to_string(raw[ipos + 1:ipos + size], ' ') FROM exact
), tot AS (
  SELECT item_id, count(DISTINCT ipos) AS n_windows FROM bw GROUP BY item_id
), dd AS (
  SELECT doc_id, md5(text) AS th, {_words_sql(_canonical_sql('text'))} AS w, {_words_sql('lower(text)')} AS raw FROM documents WHERE text IS NOT NULL
), dx AS (
  SELECT doc_id, th, exact, CASE WHEN exact THEN raw ELSE w END AS w, raw, size, unnest(range(len(w) - size + 1)) AS pos FROM dd, (SELECT DISTINCT exact, size FROM bw) s WHERE len(w) >= size
), dw AS (
  SELECT doc_id, th, exact, size, pos, array_to_string(w[pos + 1:pos + size], ' ') AS k, raw[pos + 1:pos + size] AS got FROM dx
), hit AS (
  SELECT doc_id, th, pos, item_id, ipos, n_windows, win, vals, got FROM dw JOIN bw USING (exact, size, k) JOIN tot USING (item_id)
), slots AS (
  SELECT doc_id, th, item_id, pos - ipos AS shift, ipos, type, of_, to_ FROM (SELECT doc_id, th, item_id, pos, ipos, unnest(win) AS type, unnest(vals) AS of_, unnest(got) AS to_ FROM hit)
  WHERE {slot.replace('(x,', '(type,')}
), bad AS (
  SELECT DISTINCT doc_id, th, item_id, shift FROM slots GROUP BY doc_id, th, item_id, shift, type, of_ HAVING count(DISTINCT to_) > 1
  UNION SELECT DISTINCT doc_id, th, item_id, shift FROM slots WHERE contains(type, '0a') GROUP BY doc_id, th, item_id, shift, type, to_ HAVING count(DISTINCT of_) > 1
), moved AS (
  SELECT DISTINCT s.doc_id, s.th, s.item_id, s.shift, s.ipos FROM slots s JOIN bad b ON s.doc_id IS NOT DISTINCT FROM b.doc_id AND s.th = b.th AND s.item_id = b.item_id AND s.shift = b.shift WHERE of_ <> to_
), good AS (
  SELECT h.* FROM hit h ANTI JOIN moved b ON h.doc_id IS NOT DISTINCT FROM b.doc_id AND h.th = b.th AND h.item_id = b.item_id AND h.pos - h.ipos = b.shift AND h.ipos = b.ipos
), kept AS (
  SELECT s.* FROM slots s ANTI JOIN bad b ON s.doc_id IS NOT DISTINCT FROM b.doc_id AND s.th = b.th AND s.item_id = b.item_id AND s.shift = b.shift
  UNION ALL SELECT s.* FROM slots s JOIN bad b ON s.doc_id IS NOT DISTINCT FROM b.doc_id AND s.th = b.th AND s.item_id = b.item_id AND s.shift = b.shift
    WHERE of_ = to_ AND EXISTS (SELECT 1 FROM good g WHERE g.doc_id IS NOT DISTINCT FROM s.doc_id AND g.th = s.th AND g.item_id = s.item_id AND g.pos - g.ipos = s.shift)
), changed AS (
  SELECT DISTINCT doc_id, th, item_id, shift FROM kept WHERE of_ <> to_
), clash AS (
  SELECT DISTINCT doc_id, th, item_id FROM (SELECT doc_id, th, item_id FROM kept GROUP BY doc_id, th, item_id, type, of_ HAVING count(DISTINCT to_) > 1)
  UNION SELECT DISTINCT doc_id, th, item_id FROM (SELECT doc_id, th, item_id FROM kept WHERE contains(type, '0a') GROUP BY doc_id, th, item_id, type, to_ HAVING count(DISTINCT of_) > 1)
), one AS (
  SELECT g.doc_id, g.th, g.item_id, g.n_windows, g.pos - g.ipos AS shift, count(DISTINCT g.ipos) AS n, bool_or(c.shift IS NOT NULL) AS changed
  FROM good g LEFT JOIN changed c ON g.doc_id IS NOT DISTINCT FROM c.doc_id AND g.th = c.th AND g.item_id = c.item_id AND g.pos - g.ipos = c.shift GROUP BY ALL
), best AS (
  SELECT doc_id, th, item_id, max(n) AS n, max(n * 2 + changed::INT) % 2 = 1 AS best_changed, bool_or(changed) AS any_changed FROM one GROUP BY ALL
), covered AS (
  SELECT doc_id, th, item_id, n_windows, count(DISTINCT ipos) AS n FROM good GROUP BY ALL
), held AS (
  SELECT v.doc_id, v.item_id, v.n_windows, CASE WHEN k.item_id IS NULL THEN v.n ELSE b.n END AS n_matched, CASE WHEN k.item_id IS NULL THEN b.any_changed ELSE b.best_changed END AS reparameterised
  FROM covered v JOIN best b ON v.doc_id IS NOT DISTINCT FROM b.doc_id AND v.th = b.th AND v.item_id = b.item_id
  LEFT JOIN clash k ON v.doc_id IS NOT DISTINCT FROM k.doc_id AND v.th = k.th AND v.item_id = k.item_id
)
SELECT doc_id, item_id, n_matched, n_windows, reparameterised FROM held
WHERE n_matched >= ceil(n_windows * 0.5) OR n_matched >= 13
"""


#: CRC-32 of the bytes of x, by the polynomial's table t of 256 numbers (tab).
CRC_TABLE_SQL = "SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT) AS c FROM range(256) r(i))"


def _crc_sql(x):
    return f"xor(list_reduce(list_transform(range(1, 2 * octet_length(encode({x})), 2), lambda i: ('0x' || substr(hex(encode({x})), i, 2))::BIGINT), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295)"


OP11_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.95
), reach AS (
  SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), of AS (
  SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id) AS n_links, least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id FROM embeddings
)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM of
"""


def op12_sql():
    return f"""
WITH tab AS ({CRC_TABLE_SQL}), r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), t AS (
  SELECT conv_id, octet_length(encode(text)) AS b, sha256(length(role) || ':' || role || text) AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) - 1 AS place FROM r
), i AS (
  SELECT conv_id, n, h, conv_id - conv_id % 5 AS base FROM (SELECT conv_id, n, {_crc_sql("conv_id::VARCHAR")} % 9 AS h FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id), tab)
), g AS (
  SELECT i.*, least(i.h, coalesce(o.n, 0)) AS taken FROM i LEFT JOIN i o ON o.conv_id = i.base
), re AS (
  SELECT g.conv_id, place, x, b FROM g JOIN t ON t.conv_id = g.base AND place < h UNION ALL SELECT conv_id, place - h + taken, x, b FROM g JOIN t USING (conv_id) WHERE place >= h
), ls AS (
  SELECT g.conv_id, coalesce(list(x ORDER BY place) FILTER (x IS NOT NULL), []) AS xs, coalesce(list(b ORDER BY place) FILTER (x IS NOT NULL), []) AS bs FROM g LEFT JOIN re USING (conv_id) GROUP BY g.conv_id
), pre AS (
  SELECT conv_id, d, len(xs) AS size, md5(array_to_string(xs[1:d], ' ')) AS k, CASE WHEN d > 0 THEN bs[d] ELSE 0 END AS b FROM (SELECT *, unnest(range(len(xs) + 1)) AS d FROM ls)
), node AS (
  SELECT d, k, min(conv_id) AS owner, count(*) AS n, any_value(b) AS b, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = size), '')) AS e FROM pre GROUP BY d, k
), up AS (
  SELECT node.*, o.k AS pk, o.d AS pd FROM node LEFT JOIN pre o ON o.conv_id = node.owner AND o.d = node.d - 1
), kids AS (
  SELECT pd AS d, pk AS k, count(*) AS n_children FROM up WHERE pk IS NOT NULL GROUP BY ALL
), below AS (
  SELECT p.d, p.k, count(*) FILTER (kids.k IS NULL) AS n_leaves, sum((node.n - 1) * node.b) AS saved FROM node LEFT JOIN kids USING (d, k) JOIN pre p ON p.conv_id = node.owner AND p.d <= node.d GROUP BY ALL
)
SELECT up.owner AS conv_id, up.d::BIGINT AS depth, o.owner AS parent_conv_id, up.n AS n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved::BIGINT AS saved_tokens, up.e AS ends_sha256
FROM up LEFT JOIN kids USING (d, k) JOIN below USING (d, k) LEFT JOIN node o ON o.d = up.pd AND o.k = up.pk
"""


def op13_sql():
    def words(table_):
        return rf"SELECT *, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table_}"

    def grams(source, key):
        return f"SELECT {key}, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM {source}"

    return f"""
WITH tab AS ({CRC_TABLE_SQL}), d AS ({words("documents")}), b AS ({words("benchmark")}),
df AS ({grams("d", "doc_id")}), bf AS ({grams("b", "item_id")}),
hashed AS (SELECT f, {_crc_sql("f")} % 10000 AS bucket FROM (SELECT f FROM df UNION SELECT f FROM bf), tab),
s AS (SELECT bucket, count(*) AS s FROM df JOIN hashed USING (f) GROUP BY bucket),
tt AS (SELECT bucket, count(*) AS t FROM bf JOIN hashed USING (f) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM df) + 10000)::DOUBLE / ((s + 1)::DOUBLE * ((SELECT count(*) FROM bf) + 10000)::DOUBLE)))::BIGINT AS g
  FROM s LEFT JOIN tt USING (bucket)
),
weighed AS (SELECT doc_id, count(*) AS n_features, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM df JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS long,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weighed USING (doc_id)
),
drawn AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE long)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN place <= 25 * (SELECT count(*) FROM scored WHERE long) // 100 THEN place END AS rank
FROM scored LEFT JOIN drawn USING (doc_id)
"""


def oracle_sql():
    own = {"op11_p_stable_near_dedup": OP11_SQL, "op12_prefix_doubling_trie": op12_sql(), "op13_hashed_importance": op13_sql(), "op3_suffix_array_dedup": OP3_SQL, "op6_template_decontamination": op6_sql(), "op9_doubling_substring_dedup": OP9_SQL}
    return own | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
