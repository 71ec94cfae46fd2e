"""The registered query of each operator, with production parameters, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalume.llm import audit, chat, exact, grid, html, jaccard, language, mixing, packing, quality, search, token_store, toxicity
from catalume.llm.common import scratch, table


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and kept of every vector. Null, zero and non-finite vectors link with nothing; equal vectors link; ties of component_id cannot be, as it is a minimum. An empty table gives no rows."""
    return grid.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of 2048 ids. Null texts are empty, which is the end id alone; repeated rows are packed as often as they come; pieces of equal length are interchangeable. An empty table gives no rows."""
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer())


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document, read back from the store's files. Null texts are empty, which is the end id alone; of rows that share a doc_id, the smaller text comes first. An empty table gives no rows."""
    path = scratch(spark, "token_store")
    token_store.write(table(spark, sf_dir, "documents", "doc_id", "text"), path, tokenizer())
    return token_store.read_documents(spark, path)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document. Null texts and those without a letter are `und`; of languages that score alike, the first by code point is taken. An empty table gives no rows."""
    return language.identified(table(spark, sf_dir, "documents", "doc_id", "text", "lang")).select("doc_id", "held_out", "lang_pred", "score")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical messages of every turn, validated against the schemas of production. Null texts, roles and turns stay null; turns that share a key keep a row each. An empty table gives no rows."""
    return chat.formatted(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"), chat.SCHEMAS)


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over conversations with calls and results: the raw table has none."""
    return chat.formatted(chat.with_tools(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")), chat.SCHEMAS)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document. Null texts and those without words have an empty set and link with nothing; equal sets link. An empty table gives no rows."""
    return jaccard.linked(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document. Null and empty texts get the score of a ratio of 0; repeated rows are scored alike. An empty table gives no rows."""
    return toxicity.judged(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic")).select("doc_id", "held_out", "score", "predicted")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, base and verdict of every document. Null and empty texts have no words and fail the base; repeated rows are judged alike. An empty table gives no rows."""
    return quality.judged(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "quality.*")


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes. Null texts have size 0, null is a source of its own; repeated rows are taken or left together. An empty table gives no rows."""
    return mixing.mixed(table(spark, sf_dir, "documents", "doc_id", "text", "source")).select("doc_id", "mix.*")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page. Null and empty html, and pages without an article, have an empty text; repeated rows give equal results. An empty table gives no rows."""
    return html.extracted(table(spark, sf_dir, "pages", "page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every item. Null texts have no terms, and an item without any that a document holds has no rows; equal scores go by doc_id, null last. Empty tables give no rows."""
    return search.searched(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, size and whether it stays of every document. Null texts are empty; of equal texts the smallest doc_id stays, null ids last, one row where ids repeat. An empty table gives no rows."""
    return exact.deduplicated(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every step of every order of five filters keeps, removes and loses in each source. Null texts are empty, null sources the part of the empty string; documents that labels name twice count once. An empty table gives no rows."""
    return audit.audited(table(spark, sf_dir, "documents", "doc_id", "text", "source"), table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


QUERIES = {
    "op1_grid_join": op1_grid_join,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_token_store": op3_token_store,
    "op4_language_id": op4_language_id,
    "op5_chat_format": op5_chat_format,
    "op5_tool_calls": op5_tool_calls,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_toxicity": op7_toxicity,
    "op8_quality_rules": op8_quality_rules,
    "op9_source_mixing": op9_source_mixing,
    "op10_html_extraction": op10_html_extraction,
    "op11_ranked_search": op11_ranked_search,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_filter_audit": op13_filter_audit,
}

#: Components of `links` (a, b: both ways) over the documents or vectors of `nodes` (id), by all that can be reached.
_REACHED = "reached(id, other) AS (SELECT id, id FROM nodes UNION SELECT r.id, l.b FROM reached r JOIN links l ON l.a = r.other)"

#: What SQL can express. The texts of conversations hold no tool calls, so op5_chat_format's message is its content and role; op5_tool_calls adds calls.
ORACLES: dict[str, str] = {
    "op1_grid_join": f"""WITH RECURSIVE vectors AS (SELECT vec_id AS id, row_number() OVER () AS row, CAST(embedding AS DOUBLE[]) AS x, coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND len(list_filter(embedding, lambda y: y <> 0)) > 0, false) AS good FROM embeddings),
  pairs AS (SELECT a.id AS a, b.id AS b FROM vectors a JOIN vectors b ON a.row <> b.row AND a.good AND b.good AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
  links AS (SELECT DISTINCT a, b FROM pairs), nodes AS (SELECT id FROM vectors), {_REACHED},
  least AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id), counted AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT v.id AS vec_id, coalesce(c.n, 0) AS n_links, l.component_id, v.id = l.component_id AS kept FROM vectors v JOIN least l ON l.id = v.id LEFT JOIN counted c ON c.a = v.id""",
    "op6_jaccard_join": f"""WITH RECURSIVE words AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
  sets AS (SELECT id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4])) END AS s FROM words),
  flat AS (SELECT id, len(s) AS n, hash(unnest(s)) AS h FROM sets),
  links AS (SELECT a.id AS a, b.id AS b FROM flat a JOIN flat b ON a.h = b.h AND a.id <> b.id GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
  nodes AS (SELECT id FROM words), {_REACHED}
SELECT s.id AS doc_id, len(s.s) AS n_shingles, r.component_id FROM sets s JOIN (SELECT id, min(other) AS component_id FROM reached GROUP BY id) r ON r.id = s.id""",
    "op5_chat_format": """SELECT conv_id, turn, role, '{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || '}' AS message,
  turn AS order_turn, CAST(0 AS INTEGER) AS order_step, CAST(0 AS INTEGER) AS n_calls, CAST(0 AS INTEGER) AS n_valid, CAST(NULL AS BOOLEAN) AS linked FROM conversations""",
    "op5_tool_calls": """WITH base AS (SELECT *, CAST(turn AS VARCHAR) AS t, ((conv_id * 3 + turn) % 6 + 6) % 6 AS kind, ((turn % 4) + 4) % 4 >= 2 AS two, ((conv_id + turn) % 7 = 0) AS gone, ((conv_id + turn) % 5 = 0) AS early,
    coalesce(CAST(to_json(text) AS VARCHAR), 'null') AS content FROM conversations),
  calls AS (SELECT *, CASE WHEN kind < 3 THEN 'search' WHEN kind < 5 THEN 'convert' ELSE 'delete' END AS name,
    CASE kind WHEN 0 THEN '{"limit":' || t || ',"query":"q' || t || '"}' WHEN 1 THEN '{"limit":"12","query":"q' || t || '"}' WHEN 2 THEN '{"limit":3}' WHEN 3 THEN '{"exact":true,"unit":"m","value":' || t || '}' WHEN 4 THEN '{"unit":5,"value":1.5}' ELSE '{}' END AS arguments FROM base WHERE role = 'assistant')
SELECT conv_id, turn * 4 AS turn, role, '{"content":' || content || ',"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || '}' AS message, turn * 4 AS order_turn, CAST(0 AS INTEGER) AS order_step, CAST(0 AS INTEGER) AS n_calls, CAST(0 AS INTEGER) AS n_valid, CAST(NULL AS BOOLEAN) AS linked
FROM base WHERE role IS DISTINCT FROM 'assistant'
UNION ALL
SELECT conv_id, turn * 4, role, '{"content":' || content || ',"model":"m-1","role":"assistant","tool_calls":[{"arguments":' || CAST(to_json(arguments) AS VARCHAR) || ',"id":"c' || t || 'a","name":"' || name || '","type":"function"}' ||
  CASE WHEN two THEN ',{"function":{"arguments":"{\\"unit\\":\\"km\\",\\"value\\":2.5}","name":"convert"},"id":"c' || t || 'b","type":"function"}' ELSE '' END || ']}', turn * 4, 0, CASE WHEN two THEN 2 ELSE 1 END, CASE WHEN kind IN (0, 3) THEN 1 ELSE 0 END + CASE WHEN two THEN 1 ELSE 0 END, NULL
FROM calls
UNION ALL
SELECT conv_id, CASE WHEN early THEN turn * 4 - 1 ELSE turn * 4 + 2 END, 'tool', '{"content":' || content || ',"is_error":' || CASE WHEN kind = 2 THEN 'true' ELSE 'false' END || ',"role":"tool","tool_call_id":"' || CASE WHEN gone THEN 'gone' WHEN two THEN 'c' || t || 'b' ELSE 'c' || t || 'a' END || '"}',
  CASE WHEN early AND gone THEN turn * 4 - 1 WHEN early THEN turn * 4 ELSE turn * 4 + 2 END, CASE WHEN early AND NOT gone THEN CASE WHEN two THEN 2 ELSE 1 END ELSE 0 END, 0, 0, NOT gone
FROM calls""",
    "op11_ranked_search": search.ORACLE,
    "op12_exact_dedup": exact.ORACLE,
    "op13_filter_audit": audit.ORACLE,
}
