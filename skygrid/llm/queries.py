"""Registered queries of the training-data operators, with their oracle SQL.

Each query applies one operator with production parameters to its whole
table and derives the contract's columns from the operator's output.
"""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.llm import (bpe, centroids, chat, decontam, embedding_dedup, exact_dedup, langid, lm, merkle, pii,
                         simhash, token_counts, toxicity)
from skygrid.llm.common import fold, table

RANKS = "byte_bpe_50k.tiktoken"
# A deployment passes its own secret; a fixed one keeps the query's results comparable.
PII_KEY = "skygrid-demo-key"
TOKENIZER = "byte_bpe_50k.json"


def op1_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold("doc_id", 5) == 0
    model = toxicity.learn(docs.where(~held_out), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, [F.col("doc_id"), held_out.alias("held_out")])


def op3_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm.learn_and_score(docs, fold("doc_id", 7) == 2)


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 3) == 1
    dictionaries = langid.learn_dictionaries(docs.where(~held_out))
    return langid.identify(docs, dictionaries, [F.col("doc_id"), held_out.alias("held_out")])


def op6_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS),
                                  public_tokenizers.PATTERN, [F.col("doc_id")])


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER),
                                     [F.col("doc_id")], limit=512)


def op8_pii_surrogates(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_personal_data(docs, PII_KEY, count_col="n_entities")


def op9_chat_format(spark, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    formatted = chat.format_conversations(turns.unionByName(extra))
    return chat.read_back_digests(formatted, in_order=True)


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    return decontam.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_centroid_clustering(spark, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = table(spark, sf_dir, "documents").select(*fields)
    columns = [F.col(c) for c in fields]
    tampered = merkle.leaf_digest([*columns[:-1], F.replace(F.col("text"), F.lit("\n"), F.lit(""))])
    leaf = merkle.leaf_digest(columns)
    leaves = docs.select("doc_id", "source", leaf.alias("leaf"),
                         F.when(fold("doc_id", 2) == 0, tampered).otherwise(leaf).alias("presented"))
    proved = merkle.prove(leaves, keep=["presented"])
    return merkle.folded(proved, "presented", ["doc_id", "leaf", "subroot", "root"])


def op13_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup.equal_texts(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {
        "op1_embedding_dedup": op1_embedding_dedup,
        "op2_toxicity": op2_toxicity,
        "op3_simhash_dedup": op3_simhash_dedup,
        "op4_lm_scoring": op4_lm_scoring,
        "op5_language_id": op5_language_id,
        "op6_byte_bpe": op6_byte_bpe,
        "op7_token_counts": op7_token_counts,
        "op8_pii_surrogates": op8_pii_surrogates,
        "op9_chat_format": op9_chat_format,
        "op10_decontamination": op10_decontamination,
        "op11_centroid_clustering": op11_centroid_clustering,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_exact_dedup": op13_exact_dedup,
        "pipeline": corpus_pipeline.run,
    }


def _clustering_sql() -> str:
    """Ten rounds of plain k-means: every vector against every centroid."""
    parts = ["""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE len(embedding) = 64
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k, q FROM v
  ORDER BY sha256('3:' || vec_id) LIMIT 8)"""]
    for r in range(11):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, q, k, d FROM (
  SELECT vec_id, v.q, k, d, row_number() OVER (PARTITION BY vec_id ORDER BY d, k) AS place FROM (
    SELECT v.vec_id, v.q, c.k, CAST(list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM v, c{r} c) v) WHERE place = 1)""")
        if r < 10:
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.q, c.q) AS q FROM c{r} c LEFT JOIN (
  SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS q FROM (
    SELECT k, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
      SELECT k, unnest(q) AS x, unnest(range(64)) AS pos FROM a{r}) GROUP BY k, pos) GROUP BY k) m ON c.k = m.k)""")
    return "WITH " + ",\n".join(parts) + """
SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.q, ',')) AS centroid_sha256 FROM a10 a JOIN c10 c ON a.k = c.k"""


def _manifest_sql(levels: int = 12) -> str:
    """The tree level by level, every proof from the nodes of all levels; for up to 3^levels rows or sources."""
    def part(column: str) -> str:
        text = f"CAST({column} AS VARCHAR)"
        return f"coalesce(strlen({text}) || ':' || {text}, '-')"

    def tree(name: str, lowest: str) -> list[str]:
        """``{name}(grp, lvl, i, d)``: the nodes of all levels below the top, and the top itself."""
        out = [f"{name}0 AS MATERIALIZED ({lowest})"]
        out += [f"""{name}{k + 1} AS MATERIALIZED (SELECT grp, i // 3 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d
  FROM {name}{k} WHERE grp IN (SELECT grp FROM {name}{k} GROUP BY grp HAVING count(*) > 1) GROUP BY grp, i // 3)"""
                for k in range(levels)]
        every = " UNION ALL ".join(f"SELECT grp, {k} AS lvl, i, d FROM {name}{k}" for k in range(levels + 1))
        return [*out, f"{name} AS MATERIALIZED ({every})",
                f"{name}_top AS MATERIALIZED (SELECT grp, max(lvl) AS height, arg_max(d, lvl) AS d FROM {name} GROUP BY grp)"]

    def steps(name: str) -> str:
        """For every lowest node and level: the digests left and right of its path."""
        power = "CAST(pow(3, l.lvl) AS BIGINT)"
        return f"""{name}_s AS MATERIALIZED (SELECT b.grp, b.i, l.lvl,
    coalesce(string_agg(s.d, '' ORDER BY s.i) FILTER (WHERE s.i < b.i // {power}), '') AS lft,
    coalesce(string_agg(s.d, '' ORDER BY s.i) FILTER (WHERE s.i > b.i // {power}), '') AS rgt
  FROM {name}0 b JOIN {name}_top t ON t.grp = b.grp CROSS JOIN (SELECT unnest(range({levels})) AS lvl) l
  JOIN {name} s ON s.grp = b.grp AND s.lvl = l.lvl AND s.i // 3 = b.i // ({power} * 3)
  WHERE l.lvl < t.height GROUP BY b.grp, b.i, l.lvl)"""
    crc = """list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""
    first = " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars"))
    plain, cut = part("text"), part("replace(text, chr(10), '')")
    chain = ["f0 AS (SELECT l.doc_id, n0.grp, n0.i AS pos, g, presented AS d FROM l JOIN n0 ON n0.doc_id = l.doc_id JOIN gr ON gr.grp_name = n0.grp)"]
    for k in range(2 * levels):
        tree_name, lvl, keys = ("n", k, "s.grp = f.grp AND s.i = f.pos") if k < levels else ("m", k - levels, "s.i = f.g")
        chain.append(f"""f{k + 1} AS MATERIALIZED (SELECT f.doc_id, f.grp, f.pos, f.g,
  CASE WHEN s.lvl IS NULL THEN f.d ELSE sha256(s.lft || f.d || s.rgt) END AS d
  FROM f{k} f LEFT JOIN {tree_name}_s s ON {keys} AND s.lvl = {lvl})""")
    parts = [f"""l AS MATERIALIZED (SELECT doc_id, source, sha256({first} || {plain}) AS leaf,
  CASE WHEN {crc} & 1 = 1 THEN sha256({first} || {cut}) ELSE sha256({first} || {plain}) END AS presented FROM documents)""",
             *tree("n", """SELECT doc_id, coalesce('=' || source, '-') AS grp, leaf AS d,
  row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i FROM l""")]
    parts += [*tree("m", "SELECT '' AS grp, grp AS grp_name, row_number() OVER (ORDER BY encode(grp)) - 1 AS i, d FROM n_top"),
              "gr AS MATERIALIZED (SELECT grp_name, i AS g FROM m0)", steps("n"), steps("m"), *chain,
              """p AS MATERIALIZED (SELECT grp, i, string_agg(lft || rgt, '' ORDER BY lvl) AS p FROM n_s GROUP BY grp, i),
q AS MATERIALIZED (SELECT i, string_agg(lft || rgt, '' ORDER BY lvl) AS q FROM m_s GROUP BY i)"""]
    return "WITH " + ",\n".join(parts) + f"""
SELECT l.doc_id, l.leaf, t.d AS subroot, r.d AS root, sha256(coalesce(p, '') || coalesce(q, '')) AS proof_sha256,
       f.d AS folded_root, f.d = r.d AS verified
FROM f{2 * levels} f JOIN l ON l.doc_id = f.doc_id JOIN n_top t ON t.grp = f.grp CROSS JOIN m_top r
LEFT JOIN p ON p.grp = f.grp AND p.i = f.pos LEFT JOIN q ON q.i = f.g"""


def oracle_sql() -> dict[str, str]:
    shingles = """list_distinct(CASE WHEN len({w}) = 0 THEN [] WHEN len({w}) < 5 THEN [array_to_string({w}, ' ')]
       ELSE list_transform(range(1, len({w}) - 3), lambda i: array_to_string(list_slice({w}, i, i + 4), ' ')) END)"""
    return {
        "op1_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
       AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x),
n AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON c.x = vec_id LEFT JOIN n ON n.x = vec_id""",
        # Escaping puts one backslash before every backslash, ### and </turn>.
        "op9_chat_format": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (SELECT *, length(regexp_replace(text, '\\|###|</turn>', 'x\0', 'g')) AS escaped,
             length(regexp_replace(role, '\\|###|</turn>|\n', 'x\0', 'g')) AS escaped_role FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(escaped + escaped_role + 14) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id""",
        # Items of fewer than five words are looked up by the run of all their words.
        "op10_decontamination": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
i AS (SELECT DISTINCT item_id, text, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM benchmark),
it AS (SELECT item_id, text, {shingles.format(w="w")} AS ss, least(5, len(w)) AS k FROM i WHERE len(w) > 0),
need AS (SELECT item_id, text, len(ss) AS n, unnest(ss) AS s, k FROM it),
ds AS (SELECT DISTINCT doc_id, k, s FROM (
  SELECT doc_id, k, unnest(list_transform(range(1, CAST(len(w) - k + 2 AS BIGINT)),
         lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS s
  FROM d CROSS JOIN (SELECT DISTINCT k FROM it) ks WHERE len(w) >= k))
SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_found,
       CAST(count(*) AS DOUBLE) / CAST(n AS DOUBLE) AS containment
FROM ds JOIN need USING (s, k) GROUP BY doc_id, item_id, text, n HAVING 5 * count(*) >= 4 * n""",
        "op11_centroid_clustering": _clustering_sql(),
        "op12_merkle_manifest": _manifest_sql(),
        "op13_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    }
