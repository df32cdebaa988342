"""The registered queries of these operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import bytepairs, quality, toxicity
from rowloom.llm.common import read_table
from rowloom.llm.fingerprints import edited_pairs
from rowloom.llm.jaccard import link_classes
from rowloom.llm.linededup import deduplicate_lines
from rowloom.llm.mixing import mix
from rowloom.llm.negatives import hard_negatives, integer_rows
from rowloom.llm.packing import pack, piece_digest
from rowloom.llm.pages import main_texts
from rowloom.llm.periods import looped, periodic_runs, run_digest
from rowloom.llm.topk import integer_vectors, top_k
from rowloom.llm.wavelet import document_digest, token_store


def tokenizer_path() -> str:
    """The public tokenizer file that the token queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(read_table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate_lines(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))
    rejected = (scored["severity"] >= toxicity.REJECT).alias("rejected")
    return scored.select("doc_id", "severity", "grade", "p1", "p2", "p3", rejected)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digest(pack(read_table(spark, sf_dir, "documents"), tokenizer_path()))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_pairs(read_table(spark, sf_dir, "documents"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_classes(read_table(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(read_table(spark, sf_dir, "pages"))


def op10_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_digest(token_store(read_table(spark, sf_dir, "documents"), tokenizer_path()))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = integer_rows(read_table(spark, sf_dir, "embeddings"), moved)
    return hard_negatives(rows, rows.where("vec_id % 100 = 0"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bytepairs.encode(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bytepairs.token_digest(bytepairs.decode(encoded, ranks))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(periodic_runs(looped(read_table(spark, sf_dir, "documents"))))


QUERIES = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_line_dedup": op2_line_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_source_mixing": op5_source_mixing,
    "op6_packing": op6_packing,
    "op7_fingerprints": op7_fingerprints,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_html_text": op9_html_text,
    "op10_wavelet_tokens": op10_wavelet_tokens,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op1_exact_top_k": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
        ), ranked AS (
            SELECT query_id, vec_id, score,
                   CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op11_hard_negatives": """
        WITH whole AS (
            SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                   CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
            FROM whole a JOIN whole c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(a.v) = len(c.v)
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
                   row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
            FROM scored WHERE same
        ), ranked AS (
            SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
                   CAST(row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
            FROM positives p JOIN scored n
              ON p.place <= 5 AND n.anchor_id = p.anchor_id AND NOT n.same
             AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
    """,
    "op2_line_dedup": r"""
        WITH lined AS (
            SELECT *, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), numbered AS (
            SELECT doc_id, i, trim(lines[i], E' \t\r\v\f') AS line
            FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM lined)
            WHERE trim(lines[i], E' \t\r\v\f') <> ''
        ), ordered AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k,
                   lead(line, 1) OVER (PARTITION BY doc_id ORDER BY i) AS line2,
                   lead(line, 2) OVER (PARTITION BY doc_id ORDER BY i) AS line3
            FROM numbered
        ), placed AS (
            SELECT doc_id, k, row_number() OVER (PARTITION BY line, line2, line3 ORDER BY doc_id, k) AS nth
            FROM ordered WHERE line3 IS NOT NULL
        ), covered AS (
            SELECT DISTINCT o.doc_id, o.i
            FROM placed p JOIN ordered o ON p.nth > 1 AND o.doc_id = p.doc_id AND o.k BETWEEN p.k AND p.k + 2
        ), rest AS (
            SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text
            FROM (SELECT doc_id, i, lines[i] AS line
                  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM lined)) l
            ANTI JOIN covered c ON c.doc_id = l.doc_id AND c.i = l.i
            GROUP BY l.doc_id
        ), touched AS (
            SELECT DISTINCT doc_id FROM covered
        )
        SELECT d.doc_id,
               CASE WHEN t.doc_id IS NULL THEN d.text ELSE coalesce(r.text, '') END AS text,
               d.lang, d.source,
               CASE WHEN t.doc_id IS NULL THEN d.n_chars ELSE length(coalesce(r.text, '')) END AS n_chars
        FROM documents d LEFT JOIN touched t ON t.doc_id = d.doc_id LEFT JOIN rest r ON r.doc_id = d.doc_id
    """,
}
