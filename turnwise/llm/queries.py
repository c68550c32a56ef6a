"""The training-data queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from turnwise.llm import caps, decontaminate, exact, language, lines, merkle, near, packing, pii, repair, secrets, sharding, token_counts
from turnwise.llm.registry import ORACLES, QUERIES, documents, query

__all__ = ["ORACLES", "QUERIES"]

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_BLANK = r"[\x20\x09-\x0D]"

LINES_SQL = rf"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
    keyed AS (SELECT *, translate(regexp_replace(line, '^{_BLANK}+|{_BLANK}+$', '', 'g'), '{_UP}', '{_LOW}') AS k FROM lines),
    often AS (SELECT k, max(doc_id) AS keep_id FROM keyed WHERE length(k) >= 20
              GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
    marked AS (SELECT doc_id, line, pos, keep_id IS NOT NULL AND doc_id <> keep_id AS gone
               FROM keyed LEFT JOIN often USING (k))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept_text
    FROM marked GROUP BY doc_id"""


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words_sql(table: str, key: str) -> str:
    return rf"""(SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{_WORD}') AS w
                 FROM {table})"""


CONTAMINATION_SQL = f"""
    WITH d AS {_words_sql("documents", "doc_id")},
    b AS {_words_sql("benchmark", "item_id")},
    sized AS (SELECT item_id, w, least(13, len(w)) AS size FROM b WHERE len(w) > 0),
    phrases AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
                FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM sized)),
    wins AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase
           FROM (SELECT doc_id, w, size, unnest(range(1, greatest(len(w) - size + 2, 1))) AS i
                 FROM d, (SELECT DISTINCT size FROM sized))),
    met AS (SELECT doc_id, i, wins.size, item_id FROM wins JOIN phrases USING (phrase)),
    hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit
             FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM met) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(listed, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query("op3_line_dedup", f"SELECT doc_id, n_lines, n_dropped, sha256(kept_text) AS kept_sha256 FROM ({LINES_SQL})")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.dedup_lines(documents(spark, sf_dir))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op8_exact_dedup", f"""
    WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UP}', '{_LOW}')) AS text_sha256 FROM documents),
    g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size,
                 count(*) FILTER (doc_id <= mid) > 0 AND count(*) FILTER (doc_id > mid) > 0 AS in_history
          FROM d, (SELECT (min(doc_id) + max(doc_id)) // 2 AS mid FROM documents) GROUP BY text_sha256)
    SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256, in_history
    FROM d JOIN g USING (text_sha256)""")
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.dedup(documents(spark, sf_dir))


@query("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(documents(spark, sf_dir))
    base = F.filter("pii", lambda x: x["rank"] < pii.BASE)
    counts = [F.size(F.filter("pii", pii.of_kind(r))).cast("bigint").alias(f"n_{kind.name}")
              for r, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"),
                        pii.listed(F.col("pii")).alias("spans"),
                        F.transform("pii", lambda x: x["score"]).alias("scores"))


@query("op10_decontamination", CONTAMINATION_SQL)
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark_contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "loss_tokens", "segment")


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir)).select(
        "doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


@query("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard_table(documents(spark, sf_dir))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def _of_kind(kind: str):
    return lambda x: x["kind"] == kind


@query("op7_secrets")
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir))
    counts = [F.size(F.filter("secrets", _of_kind(kind))).cast("bigint").alias(f"n_{kind}") for kind in secrets.KINDS]
    base = F.filter("secrets", lambda x: x["kind"] != secrets.KINDS[secrets.BASE])
    return found.select("doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"),
                        pii.listed(F.col("secrets")).alias("spans"), F.transform("secrets", lambda x: x["ratio"]).alias("ratios"))


NEAR_SQL = rf"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
    sized AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
    grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
    pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM grams a JOIN grams b USING (g)
              WHERE a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM pairs JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
              WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
    both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT doc_id, doc_id AS least FROM sized UNION SELECT e.b, r.least FROM reach r JOIN both_ways e ON e.a = r.doc_id)
    SELECT doc_id, any_value(n) AS n_shingles, min(least) AS component_id FROM reach JOIN sized USING (doc_id) GROUP BY doc_id"""


@query("op4_near_duplicates", NEAR_SQL)
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(documents(spark, sf_dir))


# The vocabulary's ids end at 49407, so this one stands for the end of a document only.
FREE_ID = 49408


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), FREE_ID)


def _run_sql(rows: str, out: str) -> str:
    """Levels of trees over ``rows`` (t, i, n, h): every three consecutive nodes become their hash."""
    return f"""{out} AS (
        SELECT t, 0 AS lv, i, n, h FROM {rows}
        UNION ALL
        SELECT t, any_value(lv) + 1, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
        FROM {out} WHERE n > 1 GROUP BY t, i // 3)"""


def _walk_sql(start: str, levels: str, out: str) -> str:
    """Each start (id, t, i, n, h, proof) folded up to its tree's root."""
    return f"""{out} AS (
        SELECT id, t, 0 AS lv, i, n, h, proof FROM {start}
        UNION ALL
        SELECT w.id, any_value(w.t), any_value(w.lv) + 1, any_value(w.i) // 3, (any_value(w.n) + 2) // 3,
               sha256(string_agg(CASE WHEN l.i = w.i THEN w.h ELSE l.h END, '' ORDER BY l.i)),
               any_value(w.proof) || coalesce(string_agg(l.h, '' ORDER BY l.i) FILTER (l.i <> w.i), '')
        FROM {out} w JOIN {levels} l ON l.t = w.t AND l.lv = w.lv AND l.i // 3 = w.i // 3 WHERE w.n > 1 GROUP BY w.id)"""


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit (the polynomial is a fixed value)."""
    return f"""xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
        list_transform(range(1, length({text}) + 1), lambda k: CAST(ascii(substr({text}, k, 1)) AS BIGINT))),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


_HEAD_SQL = " || ".join(_field_sql(c) for c in merkle.FIELDS[:-1])


MERKLE_SQL = f"""
    WITH RECURSIVE d AS (
        SELECT row_number() OVER () AS id, doc_id, coalesce('=' || source, '') AS t, sha256({_HEAD_SQL} || {_field_sql("text")}) AS leaf,
               sha256({_HEAD_SQL} || {_field_sql(f"CASE WHEN {_crc32_sql('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")}) AS changed
        FROM documents),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY t) AS n FROM d),
    first_rows AS (SELECT t, i, n, leaf AS h FROM leaves),
    {_run_sql("first_rows", "nodes")},
    subs AS (SELECT t AS sub, 0 AS t, row_number() OVER (ORDER BY t) - 1 AS i, count(*) OVER () AS n, h FROM nodes WHERE n = 1),
    {_run_sql("subs", "tops")},
    starts AS (SELECT id, t, i, n, changed AS h, '' AS proof FROM leaves),
    {_walk_sql("starts", "nodes", "walk")},
    arrived AS (SELECT w.id, 0 AS t, s.i, s.n, w.h, w.proof, s.h AS subroot FROM walk w JOIN subs s ON s.sub = w.t WHERE w.n = 1),
    {_walk_sql("arrived", "tops", "climb")}
    SELECT doc_id, leaf, subroot, r.h AS root, sha256(c.proof) AS proof_sha256, c.h AS folded_root, c.h = r.h AS verified
    FROM climb c JOIN arrived USING (id) JOIN leaves USING (id), (SELECT h FROM tops WHERE n = 1) r WHERE c.n = 1"""


@query("op11_merkle_manifest", MERKLE_SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(documents(spark, sf_dir))


VECTORS_SQL = f"""
    WITH RECURSIVE v AS (
        SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
    good AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(e, lambda x: x <> 0)) > 0),
    links AS (SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
              WHERE list_cosine_similarity(a.e, b.e) >= {caps.SIMILARITY}),
    reach AS (SELECT r, vec_id AS least FROM v UNION SELECT l.b, x.least FROM reach x JOIN links l ON l.a = x.r),
    groups AS (SELECT r, min(least) AS component_id FROM reach GROUP BY r),
    degrees AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
    FROM v JOIN groups USING (r) LEFT JOIN degrees USING (r)"""


@query("op12_embedding_near_dedup", VECTORS_SQL)
def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


_SAID = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

# States: 0 nothing yet, 1 system, 2 user, 3 assistant. An edit step is some inserts and one row's edit.
REPAIR_SQL = rf"""
    WITH RECURSIVE given AS (
        SELECT *, {_crc32_sql("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind FROM conversations),
    kept AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
                    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
                    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM given WHERE kind <> 0),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos, rtrim(text, {_SAID}) AS bare FROM kept),
    marked AS (SELECT *, substr(role, 1, 1) AS c, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS dup,
                      right(bare, 1) NOT IN ('.', '!', '?') AS cut, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS p FROM placed),
    counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
                      count(*) FILTER (dup) AS duplicate, count(*) FILTER (NOT blank AND NOT dup AND cut) AS truncated,
                      count(*) FILTER (p IS NOT NULL AND p || c NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n FROM marked GROUP BY conv_id),
    inserts AS (SELECT * FROM (VALUES (0, 0, 0, []), (1, 0, 1, []), (2, 0, 2, []), (3, 0, 3, []), (0, 1, 2, ['user:']), (1, 1, 2, ['user:']),
                (2, 1, 3, ['assistant:']), (3, 1, 2, ['user:']), (0, 2, 3, ['user:', 'assistant:']), (1, 2, 3, ['user:', 'assistant:'])) AS t(s, k, s2, said)),
    steps AS (SELECT s, k, s2, said, edit, c, CASE WHEN edit = 'D' THEN s2 WHEN edit = 'K' AND c = 's' THEN 1 WHEN s2 = 2 THEN 3 ELSE 2 END AS s3
              FROM inserts, (VALUES ('D', NULL), ('R', NULL), ('K', 's'), ('K', 'u'), ('K', 'a')) AS e(edit, c)
              WHERE edit <> 'K' OR (c = 's' AND s2 = 0) OR (c = 'u' AND s2 <> 2) OR (c = 'a' AND s2 = 2)),
    ways AS (
        SELECT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS s, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'said': CAST([] AS VARCHAR[])}} AS best FROM counts
        UNION ALL
        SELECT w.conv_id, any_value(m.pos), t.s3, min({{
            'cost': w.best.cost + 5 * t.k + CASE t.edit WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN t.edit <> 'D' AND m.cut THEN 5 ELSE 0 END,
            'audit': w.best.audit || repeat('I', t.k) || t.edit,
            'said': w.best.said || CAST(t.said AS VARCHAR[]) || CASE t.edit WHEN 'D' THEN CAST([] AS VARCHAR[]) WHEN 'K' THEN [m.role || ':' || m.text]
                    ELSE [CASE t.s3 WHEN 2 THEN 'user:' ELSE 'assistant:' END || m.text] END}})
        FROM ways w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.pos = w.pos + 1
        JOIN steps t ON t.s = w.s AND (t.edit = 'D' OR (NOT m.blank AND NOT m.dup AND (t.edit = 'R' OR t.c = m.c)))
        GROUP BY w.conv_id, t.s3),
    done AS (SELECT w.conv_id, min({{'cost': w.best.cost + 5 * t.k, 'audit': w.best.audit || repeat('I', t.k), 'said': w.best.said || CAST(t.said AS VARCHAR[])}}) AS best
             FROM ways w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.pos JOIN inserts t ON t.s = w.s AND t.s2 IN (0, 3) GROUP BY w.conv_id)
    SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, coalesce(d.best.cost, 0) AS cost, coalesce(d.best.audit, '') AS audit,
           sha256(coalesce(array_to_string(d.best.said, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
    LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM e.conv_id"""


@query("op13_conversation_repair", REPAIR_SQL)
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
