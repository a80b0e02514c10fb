"""The queries of this subpackage over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txscore.llm.alignment import align_tokens
from txscore.llm.circulant import near_duplicates
from txscore.llm.decontaminate import contamination
from txscore.llm.forest import nearest_neighbours
from txscore.llm.langid import identify
from txscore.llm.pieces import decode, encode
from txscore.llm.repair import round_trip
from txscore.llm.pii import find_personal_data, learn_field
from txscore.llm.registry import ORACLES, QUERIES, query, table
from txscore.llm.rotations import near_vectors
from txscore.llm.runs import periodic_runs
from txscore.llm.secrets import find_secrets, learn_formats
from txscore.llm.sharding import place
from txscore.llm.suffixes import remove_repeats

__all__ = ["ORACLES", "QUERIES"]


def tokenizer_file(name: str) -> str:
    """Where the public tokenizers' files are, on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_model() -> str:
    return tokenizer_file("piece_bpe_32k.model")


def _words_of(name: str, key: str, kept: str) -> str:
    """Lower-cased words of a table in SQL; only A to Z have another case here."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"SELECT {key}, regexp_extract_all({low}, '{kept}') AS w FROM {name}"


_SPACED, _ALNUM = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

NEAR_SQL = f"""
WITH RECURSIVE docs AS ({_words_of("documents", "doc_id", _SPACED)}),
sized AS (SELECT doc_id, w, least(4, len(w)) AS k FROM docs WHERE len(w) > 0),
sets AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
         FROM sized),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
          FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS id, doc_id AS other FROM documents
          UNION SELECT id, b FROM reach JOIN links ON other = a)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id,
       doc_id = min(other) AS kept
FROM reach JOIN documents ON id = doc_id LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""

CONTAMINATION_SQL = f"""
WITH docs AS ({_words_of("documents", "doc_id", _ALNUM)}),
items AS ({_words_of("benchmark", "item_id", _ALNUM)}),
sized AS (SELECT item_id, w, least(13, len(w)) AS k FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k,
                   unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g FROM sized),
starts AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
           FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k),
hits AS (SELECT doc_id, i, s.k, item_id FROM starts s JOIN windows v ON v.k = s.k AND v.g = w[i:i + s.k - 1]),
places AS (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hits),
covered AS (SELECT doc_id, count(*) AS n FROM places GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(f.n, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered c USING (doc_id) LEFT JOIN found f USING (doc_id)"""


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


@query("op1_repair")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query("op2_grammar_inference")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = find_secrets(documents, learn_formats(documents))
    base = F.filter("spans", lambda s: ~s["kind"].startswith("like_"))
    return found.select(
        "doc_id", *(kind_count(F.col("spans"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


@query("op3_circulant_minhash", NEAR_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_prefix_forest")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


@query("op5_winnowing", CONTAMINATION_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_jump_hash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place(table(spark, sf_dir, "documents"))


@query("op7_difference_cover")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query("op8_semi_markov")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = find_personal_data(documents, learn_field(documents))
    return found.select(
        "doc_id", *(kind_count(F.col("base"), k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")),
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


@query("op9_rank_order_profiles")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@query("op10_merge_dropout")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = piece_model()
    back = decode(encode(table(spark, sf_dir, "documents"), path), path)
    raw = F.col("text").cast("binary")
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.crc32(F.array_join("ids", ",").cast("binary")).alias("ids_crc32"),
        F.sha2(raw, 256).alias("text_sha256"),
        ((F.crc32(raw) == F.col("text_crc32")) & (F.length(raw) == F.col("n_bytes"))).alias("lossless"))


@query("op11_rotation_codes")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op12_block_convolution")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), planted=True).drop("runs", "collapsed")


@query("op13_exact_text_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), piece_model())
