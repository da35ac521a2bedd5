"""Registered queries of this subpackage: (spark, folder of the given tables) → DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymeter.llm import boosted_rules, byte_bpe, chat_format, chat_repair, interpolation, label_shards, max_sketch_search, minhash_dedup, packing, rank_profiles, revisits, rule_ensemble, spaced_seeds, stats
from waymeter.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]


#: Text of both rows of conversation -1, a fixed value of the contract.
PROBE = "<|im_end|><|im_start|>assistant ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text")
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    chats = chat_format.format_chats(rows.select("conv_id", "turn", "role", chat_format.text_part(F.col("text")).alias("parts")))
    read = chats.select("conv_id", "formatted", "loss_spans", "expanded_tokens", chat_format.turns_of(F.col("formatted")).alias("turns"))
    read = read.select(
        "*", chat_format.roles_and_bodies(F.col("turns")).alias("rows"), chat_format.learned_text(F.col("turns"), F.col("loss_spans")).alias("learned")
    )
    said = F.array_join(F.transform("rows", lambda r: F.concat(r["role"], F.lit("\n"), r["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("rows").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "expanded_tokens",
    )


OP1_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
), escaped AS (
  SELECT *, replace(replace(text, chr(92), chr(92) || 'b'), '<|', '<' || chr(92) || 'p') AS body,
    replace(replace(replace(role, chr(92), chr(92) || 'b'), '<|', '<' || chr(92) || 'p'), chr(10), chr(92) || 'n') AS head
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, head, body)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, head, body) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(head) + 1 + length(body) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS expanded_tokens
FROM escaped GROUP BY conv_id
"""


def op2_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.score(table(spark, sf_dir, "documents"))


def op3_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seeds.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), spaced_seeds.SHORT_CHANGES)


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.components_of(table(spark, sf_dir, "documents"), size=4)


def op5_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_shards.shard_rows(table(spark, sf_dir, "documents"))


def op6_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve(revisits.records_of(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    text = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"], F.lit("\n"))), "")
    return found.select("record_id", "canonical_url", "ts", "original_id", "outcome", text.alias("headers"))


OP6_SQL = r"""
WITH page AS (
  SELECT page_id, url, coalesce(length(html), 0) AS n, md5(coalesce(html, '')) AS digest,
    regexp_replace(lower(regexp_extract(url, '^\s*(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]*)?([^?#]*)(\?[^#]*)?', 1)), '^www\.', '') AS host,
    regexp_extract(url, '^\s*(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]*)?([^?#]*)(\?[^#]*)?', 2) AS port,
    regexp_replace(regexp_extract(url, '^\s*(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]*)?([^?#]*)(\?[^#]*)?', 3), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(substr(regexp_extract(url, '^\s*(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]*)?([^?#]*)(\?[^#]*)?', 4), 2), '&'),
      lambda q: q <> '' AND NOT regexp_matches(lower(q), '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=.*)?$'))), '&') AS query
  FROM pages
), keyed AS (
  SELECT page_id, n, digest, CASE WHEN host <> '' THEN host || CASE WHEN port IN (':', ':80', ':443') THEN '' ELSE port END
    || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS key
  FROM page
) , made AS (
  SELECT page_id * 6 + k AS id, CASE WHEN k % 3 = 2 THEN 'front.example/' ELSE key END AS key, n, k >= 3 AS asks,
    page_id + 40 * (k % 3) + CASE WHEN k >= 3 THEN 1 + n % 50 ELSE 0 END AS ts, digest || '-' || (k % 3) // 2 AS tag, (n + k) % 11 = 0 AS gone
  FROM keyed, range(6) r(k)
), asked AS (SELECT * FROM made WHERE asks), stored AS (SELECT * FROM made WHERE NOT asks AND NOT gone),
matched AS (
  SELECT a.id, a.key, a.ts, a.n, a.tag, max({'ts': s.ts, 'id': s.id}) FILTER (s.id IS NOT NULL) AS last
  FROM asked a LEFT JOIN stored s ON s.key = a.key AND s.ts < a.ts GROUP BY ALL
)
SELECT m.id AS record_id, m.key AS canonical_url, m.ts AS ts, s.id AS original_id,
  CASE WHEN s.id IS NULL THEN 'no_original' WHEN m.n % 5 = 0 THEN 'unchecked'
    WHEN m.n % 7 = 0 OR m.tag <> s.tag THEN 'changed' ELSE 'resolved' END AS outcome,
  CASE WHEN s.id IS NOT NULL AND m.n % 5 <> 0 AND m.n % 7 <> 0 AND m.tag = s.tag THEN
    'cache-control: max-age=60' || chr(10) || 'content-length: ' || s.n || chr(10) || 'content-type: text/html' || chr(10)
    || 'date: ' || m.ts || chr(10) || 'etag: W/"' || m.tag || '"' || chr(10) || 'server: archive' || chr(10) END AS headers
FROM matched m LEFT JOIN stored s ON s.id = m.last.id
"""


def op7_rank_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = stats.part_of(F.col("doc_id"), rank_profiles.FOLDS) == 0
    known = rank_profiles.profiles(docs.where(~held_out))
    return rank_profiles.identify(docs.select("doc_id", "text"), known, "found").select(
        "doc_id", held_out.alias("held_out"), F.col("found.lang_pred").alias("lang_pred"), F.col("found.score").alias("score")
    )


def op8_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ensemble = rule_ensemble.train(docs, table(spark, sf_dir, "labels"))
    return rule_ensemble.score(docs.select("doc_id", "text"), ensemble, "score").select(
        "doc_id",
        (stats.part_of(F.col("doc_id"), rule_ensemble.FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= rule_ensemble.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op10_boosted_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = boosted_rules.train(docs, table(spark, sf_dir, "labels"))
    return boosted_rules.judge(docs.select("doc_id", "text"), trees, "v").select(
        "doc_id", *[F.col("v")[n].alias(n) for n in (*stats.COUNTS[:5], "score", "base_failed", "kept")]
    )


def op11_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_repair.report(chat_repair.damaged(rows), rows)


def op12_max_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_sketch_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS terms FROM documents),
doc_terms AS (SELECT d, doc_id, len(terms) AS n, unnest(terms) AS term FROM doc),
tf AS (SELECT d, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf FROM doc_terms GROUP BY d, term),
size AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(terms)) AS BIGINT) AS tokens FROM doc WHERE len(terms) > 0),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
item AS (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS terms FROM benchmark),
item_terms AS (SELECT i, item_id, unnest(terms) AS term FROM item),
asked AS (SELECT i, any_value(item_id) AS item_id, term, count(*) AS times FROM item_terms GROUP BY i, term),
weighed AS (
  SELECT i, item_id, term, times * CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM asked JOIN df USING (term), size
), scored AS (
  SELECT i, item_id, d, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // tokens)))) AS BIGINT) AS score
  FROM weighed JOIN tf USING (term), size GROUP BY ALL
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), decoded="decoded").drop("text")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), byte_bpe.digest_of_ids(F.col("ids")).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def registered() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_chat_format, op2_interpolation, op3_spaced_seeds, op4_minhash_dedup, op5_label_shards, op6_revisits, op7_rank_profiles, op8_rule_ensemble, op9_packing, op10_boosted_rules, op11_chat_repair, op12_max_sketch_search, op13_byte_bpe)}


def statements() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return {"op1_chat_format": OP1_SQL, "op6_revisits": OP6_SQL, "op12_max_sketch_search": OP12_SQL}
