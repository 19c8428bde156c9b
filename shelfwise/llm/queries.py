"""The operators bound to the given tables, one query each, with oracle SQL
where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import decontaminate, extract, fill_middle, jaccard, language, mixing, neighbours, packing, prefix_trie, quality, rans, shards, token_counts
from shelfwise.llm.common import reachable


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return reachable(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(_table(spark, sf_dir, "pages"))


def op2_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"))


def op3_context_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.held_out_identification(_table(spark, sf_dir, "documents"))


def op4_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.held_out_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op6_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op7_range_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.encoded_digest(_table(spark, sf_dir, "documents"))


def op8_vertical_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(_table(spark, sf_dir, "documents"))


def op9_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(_table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_in_middle_digest(_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), with_ids=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_page_differencing,
        op2_collision_counting,
        op3_context_trees,
        op4_factorisation_machine,
        op5_token_counts,
        op6_pivotal_mixing,
        op7_range_coding,
        op8_vertical_join,
        op9_ring_shards,
        op10_decontaminate,
        op11_fill_in_middle,
        op12_prefix_trie,
        op13_packing,
    )
}

_WORDS = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL: dict[str, str] = {
    "op10_decontaminate": f"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format(text="coalesce(text, '')")} AS w FROM benchmark
), win AS (
  SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS run
  FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM item WHERE len(w) > 0)
), doc AS (
  SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents
), spot AS (
  SELECT d.rid, size, i, array_to_string(w[i : i + size - 1], ' ') AS run
  FROM (SELECT rid, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM doc, (SELECT DISTINCT size FROM win) WHERE len(w) >= size) d
), hit AS (
  SELECT s.rid, s.i, s.size, win.item FROM spot s JOIN win ON s.size = win.size AND s.run = win.run
), words AS (
  SELECT rid, count(DISTINCT pos) AS n_hit
  FROM (SELECT DISTINCT rid, unnest(generate_series(i, i + size - 1)) AS pos FROM (SELECT DISTINCT rid, i, size FROM hit)) GROUP BY rid
), items AS (
  SELECT rid, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS names FROM hit WHERE item IS NOT NULL GROUP BY rid
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
""",
    "op11_fill_in_middle": r"""
WITH doc AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents
), draw AS (
  SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         list_transform([1, 9, 17, 25], lambda i : CAST('0x' || substr(hex, i, 8) AS BIGINT)) AS h FROM doc
), shape AS (
  SELECT rid, doc_id, text, u, CAST(len(u) AS BIGINT) AS n,
         least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
              WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM draw
), part AS (
  SELECT *, array_to_string(u[1 : a], '') AS p, array_to_string(u[a + 1 : b], '') AS m, array_to_string(u[b + 1 :], '') AS s FROM shape
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM part
""",
    "op12_prefix_trie": r"""
WITH turn AS (
  SELECT conv_id AS c, octet_length(encode(coalesce(text, ''))) AS bytes, t.turn,  coalesce(role, '') AS role,
         sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations t WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, bytes, k, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, k) AS i FROM turn
), talk AS (
  SELECT c, c - c % 5 AS b, count(*) AS n,
         xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
           lambda x : [CAST(ord(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda s, x : CASE WHEN x >= 0 THEN xor(s, x) WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END)) % 9 AS h
  FROM own GROUP BY c
), built AS (
  SELECT talk.c, own.i AS d, bytes, k FROM talk JOIN own ON own.c = talk.b AND own.i <= h
  UNION ALL
  SELECT talk.c, own.i - h + least(h, coalesce(base.n, 0)), bytes, k FROM talk JOIN own ON own.c = talk.c AND own.i > h LEFT JOIN (SELECT c AS b, n FROM talk) base ON base.b = talk.b
), path AS (
  SELECT c, 0 AS d, 0 AS bytes, '' AS key, NULL AS up FROM talk
  UNION ALL
  SELECT c, d, bytes, coalesce(up, '') || k, coalesce(up, '')
  FROM (SELECT *, string_agg(k, '') OVER (PARTITION BY c ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS up FROM built)
), size AS (
  SELECT c, max(d) AS n FROM path GROUP BY c
), node AS (
  SELECT key, any_value(up) AS up, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) * (count(*) - 1) AS saves FROM path GROUP BY key
), kids AS (
  SELECT up AS key, count(*) AS n_children FROM node WHERE up IS NOT NULL GROUP BY up
), below AS (
  SELECT path.key, sum(node.saves) AS saved_tokens, count(*) FILTER (kids.key IS NULL) AS n_leaves
  FROM node LEFT JOIN kids USING (key) JOIN path ON path.c = node.conv_id AND path.d <= node.depth GROUP BY path.key
), ended AS (
  SELECT key, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS names FROM path JOIN size USING (c) WHERE d = n GROUP BY key
)
SELECT node.conv_id, CAST(node.depth AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(names, '')) AS ends_sha256
FROM node JOIN below USING (key) LEFT JOIN kids USING (key) LEFT JOIN ended USING (key) LEFT JOIN node parent ON parent.key = node.up
""",
}
