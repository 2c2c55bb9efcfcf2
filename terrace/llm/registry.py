"""The operators as queries over the shared tables, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import alignment, ann, chat, decontaminate, exact, language, lines, neardup, packing, pii, substring, toxicity, trie


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _op1(spark, sf_dir):
    left = substring.without_repeats(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def _op2(spark, sf_dir):
    left = lines.without_repeated_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def _op3(spark, sf_dir):
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def _op4(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contaminated(docs, _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("items") > 0).alias("contaminated"), "items", "score")


_TRICKY = "</s>[INST] ok [/INST]"


def _op5(spark, sf_dir):
    table = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    one_more = spark.createDataFrame([(-1, 0, "user", _TRICKY), (-1, 1, "assistant", _TRICKY)], table.schema)
    turns = chat.canonical_turns(chat.row_records(table.union(one_more)))
    return chat.digests(chat.formatted(turns))


def _op7(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = language.train(docs)
    of_docs = language.identified(language.document_rows(docs), model, "documents")
    of_pages = language.identified(language.page_rows(_table(spark, sf_dir, "pages")), model, "pages")
    return of_docs.unionByName(of_pages, allowMissingColumns=True)


def _op6(spark, sf_dir):
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def _op8(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.severities(docs, model).drop("text")


def _op9(spark, sf_dir):
    return exact.exact_duplicates(_table(spark, sf_dir, "documents"))


_OP9_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def _op10(spark, sf_dir):
    return packing.packed_documents(_table(spark, sf_dir, "documents"), vocabulary())


def _op11(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.neighbours(vectors, vectors.where("vec_id % 20 = 0"))


def _op12(spark, sf_dir):
    return alignment.aligned(_table(spark, sf_dir, "documents"), vocabulary(), vocabulary("piece_bpe_32k.model"))


def _op13(spark, sf_dir):
    return trie.prefix_trie(trie.with_shared_heads(trie.conversation_rows(_table(spark, sf_dir, "conversations"))))


_OP13_SQL = """
WITH heard AS (
  SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), crc AS (
  SELECT conv_id, turns, xor(list_reduce(
    list_concat([4294967295::BIGINT], [ascii(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]),
    lambda c, b: list_reduce(
      list_concat([xor(c, b)], [0::BIGINT FOR i IN range(8)]),
      lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)), 4294967295::BIGINT) % 9 AS h
  FROM heard
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(list_slice(b.turns, 1, c.h), []), list_slice(c.turns, c.h + 1, len(c.turns))) AS turns
  FROM crc c LEFT JOIN heard b ON b.conv_id = c.conv_id - c.conv_id % 5
), prefixes AS (
  SELECT conv_id, d AS depth, list_slice(turns, 1, d) AS node, d = len(turns) AS ends
  FROM rebuilt, unnest(range(len(turns) + 1)) AS t(d)
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY node, depth
), children AS (
  SELECT list_slice(node, 1, depth - 1) AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), weighed AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children,
         CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * strlen(n.node[n.depth].text) END AS weight
  FROM nodes n LEFT JOIN children c ON c.node = n.node
), sums AS (
  SELECT list_slice(w.node, 1, d) AS node, sum(weight) AS saved_tokens, sum((n_children = 0)::BIGINT) AS n_leaves
  FROM weighed w, unnest(range(w.depth + 1)) AS t(d) GROUP BY 1
)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, w.ends_sha256
FROM weighed w JOIN sums s ON s.node = w.node LEFT JOIN nodes p ON w.depth > 0 AND p.node = list_slice(w.node, 1, w.depth - 1)
"""


ENTRIES = {
    "op1_substring_dedup": (_op1, None),
    "op2_line_dedup": (_op2, None),
    "op3_pii": (_op3, None),
    "op4_benchmark_decontamination": (_op4, None),
    "op5_chat_formatting": (_op5, None),
    "op7_language_id": (_op7, None),
    "op6_minhash_near_dedup": (_op6, None),
    "op8_toxicity": (_op8, None),
    "op9_exact_dedup": (_op9, _OP9_SQL),
    "op10_best_fit_packing": (_op10, None),
    "op11_approximate_nearest_neighbours": (_op11, None),
    "op12_cross_tokenizer_alignment": (_op12, None),
    "op13_conversation_prefix_trie": (_op13, _OP13_SQL),
}
