"""Registered queries of the training-data operators, over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payx.llm import bottomk, bpe, cnn, langid, licenses, linerules, packing, pitmanyor, repair, simple8b, syncmers, variants, warc
from payx.llm.common import crc_mod, table

TOKENIZER = "byte_bpe_50k.json"


def vocabulary(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_captures(table(spark, sf_dir, "pages"))


def op3_linerules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linerules.filtered(table(spark, sf_dir, "documents")).drop("cleaned")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op5_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    held = crc_mod(F.col("doc_id"), 3) == 1
    net = cnn.learn(docs.join(labels.where("quality is not null"), "doc_id").where(~held))
    scored = docs.select("doc_id", held.alias("held_out"), cnn.score(F.col("text"), net).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), packing.tokens_and_end(F.col("text"), vocabulary()))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 4) == 2
    samples = langid.learn(docs.where(~held).select("doc_id", "text", "lang"))
    judged = docs.select("doc_id", held.alias("held_out"), langid.judge(F.col("text"), samples).alias("l"))
    return judged.select("doc_id", "held_out", "l.lang_pred", "l.score")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op10_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.document_index(table(spark, sf_dir, "documents"), vocabulary())


def op11_pitmanyor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitmanyor.scored(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 7) == 2)


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelled(table(spark, sf_dir, "documents"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.audited(conversations, repair.damaged(conversations))


def queries() -> dict:
    return {f.__name__: f for f in (op1_syncmers, op2_warc, op3_linerules, op4_bpe, op5_cnn, op6_packing, op7_near_dedup, op8_langid, op9_licenses, op10_simple8b, op11_pitmanyor, op12_variants, op13_repair)}


OP2_SQL = """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body, coalesce(html, '') AS html FROM pages),
    h AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(html) AS hexed, max(page_id) OVER (PARTITION BY html) AS first_id FROM p),
    d AS (SELECT *, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([32768, 1024, 32, 1],
      lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hexed, (i * 5 + 1)::INT, 5))::BIGINT // s) % 32 + 1)::INT, 1)), '')), '') AS payload_digest FROM h)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN first_id <> page_id THEN first_id END AS refers_to, true AS has_request, true AS has_metadata, CASE WHEN first_id = page_id THEN true END AS digest_ok FROM d
"""

#: By comparison of all pairs that share a shingle: for small tables only.
OP7_SQL = r"""
    WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
    win AS (SELECT doc_id, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS s FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
      UNION ALL SELECT doc_id, array_to_string(words, ' ') FROM w WHERE len(words) BETWEEN 1 AND 2),
    sets AS (SELECT DISTINCT doc_id, s FROM win), size AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
    twoway AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach(doc_id, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, b FROM reach JOIN twoway ON a = seen),
    comp AS (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY 1)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM comp LEFT JOIN size USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": OP2_SQL, "op3_linerules": linerules.oracle(), "op7_near_dedup": OP7_SQL, "op9_licenses": licenses.oracle(), "op12_variants": variants.SQL, "op13_repair": repair.SQL}
