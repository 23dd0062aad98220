"""The registered queries of this subpackage and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import decontaminate, language, licenses, manifest, mixing, ngram_join, pii, scratch, site_tree, substring_dedup, suffix_dedup, topk, variants, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op3_substring_dedup(spark, sf):
    return substring_dedup.kept_digest(substring_dedup.remove_repeats(table(spark, sf, "documents")))


ORACLE["op3_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), windows AS (
  SELECT r, doc_id, p, array_to_string(list_slice(w, p + 1, p + 13), ' ') AS k
  FROM (SELECT *, unnest(range(len(w) - 12)) AS p FROM d WHERE len(w) >= 13)
), origins AS (
  SELECT k, min(doc_id) AS first_doc FROM windows GROUP BY k HAVING count(*) > 1
), gone AS (
  SELECT r, list(DISTINCT i) AS places FROM (
    SELECT r, unnest(range(p + 1, p + 14)) AS i FROM windows JOIN origins USING (k) WHERE first_doc < doc_id
  ) GROUP BY r
), kept AS (
  SELECT doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
    CASE WHEN places IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(places, i)) END AS k
  FROM d LEFT JOIN gone USING (r)
)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256
FROM kept
"""


@query
def op8_suffix_dedup(spark, sf):
    return suffix_dedup.kept_digest(suffix_dedup.remove_repeats(table(spark, sf, "documents")))


@query
def op7_benchmark_decontamination(spark, sf):
    return decontaminate.contaminated(decontaminate.overlaps(table(spark, sf, "documents"), table(spark, sf, "benchmark")))


@query
def op10_language_id(spark, sf):
    return language.identify(table(spark, sf, "documents"))


@query
def op1_pii(spark, sf):
    return pii.digest(pii.find(table(spark, sf, "documents")))


@query
def op9_exact_top_k(spark, sf):
    vectors = topk.integers(table(spark, sf, "embeddings"))
    return topk.search(vectors.where(F.col("vec_id") % 20 == 0), vectors, k=20)


ORACLE["op9_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op6_warc_packages(spark, sf):
    records = warc.round_trip(table(spark, sf, "pages"), scratch.new_folder(spark, "warc"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op6_warc_packages"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first_page FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((((strpos('0123456789abcdef', substr(h, (5 * i // 4 + 1)::INT, 1)) - 1) * 16
      + strpos('0123456789abcdef', substr(h, (5 * i // 4 + 2)::INT, 1)) - 1) >> (3 - 5 * i % 4)::INT) & 31)::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM f
"""


@query
def op2_source_mix(spark, sf):
    return mixing.mix(table(spark, sf, "documents"))


ORACLE["op2_source_mix"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k
  FROM documents
), s AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)
), levels AS (
  SELECT 0::DOUBLE AS now
  UNION ALL
  SELECT then_ FROM (
    SELECT now, (SELECT (sum(source_size) - sum(CASE WHEN 3 * source_size < now * weight THEN 3 * source_size ELSE 0 END))::DOUBLE
      / sum(CASE WHEN 3 * source_size < now * weight THEN 0 ELSE weight END) FROM s) AS then_ FROM levels
  ) WHERE then_ > now
), t AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, (SELECT max(now) FROM levels) * weight) AS target FROM s
), b AS (
  SELECT *, floor(target)::BIGINT // greatest(source_size, 1) AS epochs, floor(target)::BIGINT % greatest(source_size, 1) AS rest FROM t
), r AS (
  SELECT d.*, source_size, target, epochs, rest, coalesce(sum(size) OVER (
    PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target, (epochs * size + least(greatest(rest - before, 0), size))::BIGINT AS taken FROM r
"""


@query
def op4_license_scan(spark, sf):
    return licenses.scan(table(spark, sf, "documents"))


def _notices() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    return ", ".join(f"({quoted(k)}, {i}, {quoted(t)})" for k, texts in licenses.TEMPLATES.items() for i, t in enumerate(texts))


ORACLE["op4_license_scan"] = rf"""
WITH n AS (
  SELECT license, template, string_split(trim(lower(regexp_replace(notice, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))), ' ') AS w
  FROM (VALUES {_notices()}) AS v(license, template, notice)
), t AS (
  SELECT license, template, len(w) - 1 AS m, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS g FROM n
), d AS (
  SELECT doc_id, unnest(list_distinct(list_concat(list_concat(string_split(text, chr(10)), string_split_regex(text, '\n[ \t\r]*\n')), [text]))) AS segment
  FROM documents WHERE text IS NOT NULL
), s AS (
  SELECT doc_id, segment, string_split(trim(lower(regexp_replace(segment, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))), ' ') AS w
  FROM d WHERE regexp_matches(segment, '[\p{{L}}\p{{N}}]')
), c AS (
  SELECT doc_id, segment, len(w) - 1 AS n, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS h FROM s WHERE len(w) BETWEEN 2 AND 1000
), hits AS (
  SELECT doc_id, license, template, segment, round(2.0 * len(list_intersect(h, g)) / (n + m), 6) AS dice
  FROM c JOIN t ON least(n, m) * 3 >= greatest(n, m) * 2 - 0.001
)
SELECT doc_id, license, dice::DOUBLE AS dice, template, segment FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, license ORDER BY dice DESC, template, segment) AS place FROM hits WHERE dice >= 0.8
) WHERE place = 1
"""


@query
def op5_ngram_jaccard_join(spark, sf):
    return ngram_join.join(table(spark, sf, "documents"))


ORACLE["op5_ngram_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), g AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d
), n AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY x, y
), links AS (
  SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)
), edges AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM d
  UNION
  SELECT reach.doc_id, edges.y FROM reach JOIN edges ON reach.other = edges.x
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)
"""


#: One row: the remainders of one byte, for checksums.
_CRC = "crc AS (SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY i) AS remainders FROM range(256) t(i))"


def _crc32(text: str) -> str:
    """Checksum of a non-NULL text, byte by byte; reads the row of ``crc``."""
    bytes_ = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), (2 * i + 1)::INT, 2))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295], {bytes_}), lambda c, b: xor(c >> 8, remainders[(xor(c, b) & 255) + 1])), 4294967295)"


@query
def op11_merkle_manifest(spark, sf):
    return manifest.proofs(manifest.manifest(table(spark, sf, "documents")))


def _field(column: str) -> str:
    return f"coalesce(octet_length(encode({column}::VARCHAR)) || ':' || {column}::VARCHAR, '-')"


ORACLE["op11_merkle_manifest"] = rf"""
WITH RECURSIVE {_CRC}, d AS (
  SELECT doc_id, source, {" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))} AS front, text,
    CASE WHEN doc_id IS NOT NULL THEN {_crc32("coalesce(doc_id::VARCHAR, '')")} % 2 = 0 ELSE false END AS picked FROM documents CROSS JOIN crc
), h AS (
  SELECT doc_id, source, sha256(front || {_field("text")}) AS leaf,
    CASE WHEN picked THEN sha256(front || {_field("replace(text, chr(10), '')")}) END AS changed FROM d
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, changed NULLS FIRST) - 1 AS pos FROM h
), nodes AS (
  SELECT source, 0 AS level, pos, leaf AS x, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT source, level + 1, pos // 3, sha256(string_agg(x, '' ORDER BY pos)), (max(n) + 2) // 3 FROM nodes WHERE n > 1 GROUP BY source, level, pos // 3
), subroots AS (
  SELECT source, x AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM nodes WHERE n = 1
), upper_nodes AS (
  SELECT 0 AS level, pos, subroot AS x, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(x, '' ORDER BY pos)), (max(n) + 2) // 3 FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 3
), siblings AS (
  SELECT a.source, a.level, a.pos, coalesce(string_agg(b.x, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.x, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM nodes a JOIN nodes b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY a.source, a.level, a.pos
), upper_siblings AS (
  SELECT a.level, a.pos, coalesce(string_agg(b.x, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.x, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM upper_nodes a JOIN upper_nodes b ON a.level = b.level AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY a.level, a.pos
), folded AS (
  SELECT source, pos, 0 AS level, pos AS place, '' AS proof, coalesce(changed, leaf) AS x FROM leaves
  UNION ALL
  SELECT f.source, f.pos, f.level + 1, f.place // 3, f.proof || s.l || s.r, sha256(s.l || f.x || s.r)
  FROM folded f JOIN siblings s ON f.source IS NOT DISTINCT FROM s.source AND f.level = s.level AND f.place = s.pos
), below AS (
  SELECT source, pos, arg_max(proof, level) AS proof, arg_max(x, level) AS x FROM folded GROUP BY source, pos
), climbed AS (
  SELECT b.source, b.pos, 0 AS level, s.pos AS place, b.proof, b.x FROM below b JOIN subroots s ON b.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT c.source, c.pos, c.level + 1, c.place // 3, c.proof || s.l || s.r, sha256(s.l || c.x || s.r)
  FROM climbed c JOIN upper_siblings s ON c.level = s.level AND c.place = s.pos
), ends AS (
  SELECT source, pos, arg_max(proof, level) AS proof, arg_max(x, level) AS x FROM climbed GROUP BY source, pos
)
SELECT l.doc_id, l.leaf, s.subroot, u.x AS root, sha256(e.proof) AS proof_sha256, e.x AS folded_root, e.x = u.x AS verified
FROM leaves l JOIN ends e ON l.source IS NOT DISTINCT FROM e.source AND l.pos = e.pos JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
CROSS JOIN (SELECT x FROM upper_nodes WHERE n = 1) u
"""


@query
def op12_html_main_text(spark, sf):
    return site_tree.extract(table(spark, sf, "pages"))


@query
def op13_spelling_variants(spark, sf):
    return variants.grouped(table(spark, sf, "documents"))


ORACLE["op13_spelling_variants"] = rf"""
WITH RECURSIVE {_CRC}, runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), d AS (
  SELECT doc_id, run, count(*) AS k FROM runs GROUP BY doc_id, run
), h AS (
  SELECT run, k, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM d CROSS JOIN crc
), spelt AS (
  SELECT k, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM h
), words AS (
  SELECT word, sum(k)::BIGINT AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
), cut AS (
  SELECT word, i, substr(word, 1, (i - 1)::INT) || substr(word, (i + 1)::INT) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, a.rest FROM cut a SEMI JOIN words w ON a.rest = w.word
  UNION
  SELECT a.rest, a.word FROM cut a SEMI JOIN words w ON a.rest = w.word
), best AS (
  SELECT p.word, count(*) AS n_near, arg_min(other, (-w.n, encode(other))) AS form, max(w.n) AS form_n FROM pairs p JOIN words w ON p.other = w.word GROUP BY p.word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 2 * w.n THEN form END AS form, CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), path AS (
  SELECT word, word AS root FROM formed
  UNION ALL
  SELECT p.word, f.form FROM path p JOIN formed f ON p.root = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, p.root, f.n, f.n_near, f.form_n
FROM formed f JOIN path p ON f.word = p.word JOIN formed r ON p.root = r.word WHERE r.form IS NULL
"""
