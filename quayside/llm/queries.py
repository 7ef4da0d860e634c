"""Queries of this subpackage, one per operator, over the whole of their tables, and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import quayside
from quayside.llm.bitsliced import top_products
from quayside.llm.island_packing import pack_fewest
from quayside.llm.island_packing import piece_digests as fewest_digests
from quayside.llm.language_id import identify_languages
from quayside.llm.lm_scoring import cross_entropy_difference
from quayside.llm.ngram_join import jaccard_components
from quayside.llm.packing import digests, pack_documents
from quayside.llm.phrases import mine_phrases
from quayside.llm.posting_lists import nearest_vectors
from quayside.llm.quality import score_quality
from quayside.llm.sentence_pieces import piece_digests
from quayside.llm.token_counts import count_tokens
from quayside.llm.toxicity import score_toxicity
from quayside.llm.vector_codes import encode_vectors
from quayside.sources.paths import join_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


#: Bytes of an Arrow batch between Spark and its Python workers.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


#: Of one query, and of the stages of a pipeline, whose buffers add up in executors that run one after another.
QUERY_BATCH, STAGE_BATCH = 8 << 20, 1 << 20


def prepare(spark: SparkSession, batch: int = QUERY_BATCH) -> None:
    """Let Python workers find this package where the driver has it, and take texts in batches of ``batch`` bytes.

    What the session has been told already holds, unless it comes from here. On a cluster the package
    is installed on every machine or given by --py-files.
    """
    if spark.conf.get(BATCH, None) in (None, str(64 << 20), "64MB", "67108864b", str(QUERY_BATCH), str(STAGE_BATCH)):
        spark.conf.set(BATCH, str(batch))
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(quayside.__file__).parent.parent))


def query(function: Query) -> Query:
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(join_path(sf_dir, f"{name}.parquet"))


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against those labelled as good."""
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), good)


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(pack_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json")))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


@query
def op5_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_vectors(table(spark, sf_dir, "embeddings"))


@query
def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


# Equal sets stand for one another; candidates share a shingle that at most a few sets have, or any.
ORACLE["op7_ngram_join"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, CASE
        WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
    FROM words
),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id
        AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 75
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reach(x, y) AS (
    SELECT doc_id, doc_id FROM sets
    UNION
    SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT s.doc_id, any_value(len(s.s)) AS n_shingles, min(r.y) AS component_id
FROM sets s JOIN reach r ON s.doc_id = r.x
GROUP BY s.doc_id
"""


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_bitsliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"))


ORACLE["op9_bitsliced"] = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 50 = 0
),
ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
"""


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_vectors(table(spark, sf_dir, "embeddings"))


def _vector_codes_sql(rounds: int = 6) -> str:
    """Rounds of means over the eight parts of all vectors; c<k> are the codebooks after k rounds."""
    steps = [
        """
        kept AS (
            SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
                list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v, len(embedding) // 8 AS w
            FROM embeddings
            WHERE embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ),
        pieces AS MATERIALIZED (SELECT r, p, v[p * w + 1:p * w + w] AS x FROM kept, range(8) t(p)),
        c0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM pieces WHERE r <= 16)"""
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""
        a{k} AS MATERIALIZED (
            SELECT s.r, s.p, min({{
                'd': list_sum(list_transform(list_zip(s.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': c.e
            }}) AS near
            FROM pieces s JOIN c{k} c ON s.p = c.p GROUP BY s.r, s.p
        )"""
        )
        if k < rounds:
            steps.append(
                f"""
        m{k} AS (
            SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS x
            FROM (
                SELECT a.p, a.near.e AS e, t.i, sum(s.x[t.i])::HUGEINT AS s, count(*)::HUGEINT AS n
                FROM a{k} a JOIN pieces s ON a.r = s.r AND a.p = s.p, unnest(range(1, len(s.x) + 1)) t(i)
                GROUP BY ALL
            ) GROUP BY p, e
        ),
        c{k + 1} AS MATERIALIZED (
            SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN m{k} m ON c.p = m.p AND c.e = m.e
        )"""
            )
    return f"""
    WITH {",".join(steps)},
    coded AS (
        SELECT r, string_agg(printf('%02x', near.e), '' ORDER BY p) AS code, sum(near.d)::BIGINT AS error
        FROM a{rounds} GROUP BY r
    ),
    books AS (
        SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds}
    )
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM kept JOIN coded ON kept.r = coded.r, books
    """


ORACLE["op11_vector_codes"] = _vector_codes_sql()


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(table(spark, sf_dir, "documents"))


# Phrases of all lengths, each with the counts of the parts of its cuts.
ORACLE["op12_phrases"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
spans AS (
    SELECT lang, unnest(flatten(list_transform(range(1, 6), lambda m:
        list_transform(range(1, len(w) - m + 2), lambda i: w[i:i + m - 1])))) AS words
    FROM lists
),
counts AS (SELECT lang, words, count(*) AS f FROM spans GROUP BY ALL),
frequent AS (SELECT * FROM counts WHERE f >= 100),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang),
inner_parts AS (
    SELECT lang, words[2:] AS words, f FROM frequent UNION SELECT lang, words[:len(words) - 1], f FROM frequent
),
kept AS (
    SELECT c.lang, c.words, c.f AS a FROM frequent c
    ANTI JOIN inner_parts i ON c.lang = i.lang AND c.words = i.words AND c.f = i.f
    WHERE len(c.words) >= 2
),
cuts AS (SELECT *, unnest(range(1, len(words))) AS k FROM kept),
scored AS (
    SELECT c.lang, c.words, c.a, k, l.f AS l, r.f AS r, n,
        ((1000 * c.a::HUGEINT * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM cuts c JOIN totals t ON c.lang = t.lang
    JOIN frequent l ON l.lang = c.lang AND l.words = c.words[:k]
    JOIN frequent r ON r.lang = c.lang AND r.words = c.words[k + 1:]
),
best AS (
    SELECT *, row_number() OVER (PARTITION BY lang, words ORDER BY score, k) AS place,
        array_to_string(words, ' ') AS phrase
    FROM scored
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank,
    phrase, a, l, r, n, score
FROM best WHERE place = 1
QUALIFY rank <= 2000
"""


@query
def op13_island_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fewest_digests(pack_fewest(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json")))
