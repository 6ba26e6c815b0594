"""The registered queries of the operators in this subpackage, and their SQL."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.embedding_dedup import link_vectors

    return link_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op2_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.quotations import link_quotations

    return link_quotations(table(spark, sf_dir, "conversations"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.jaccard_join import jaccard_components

    found = jaccard_components(table(spark, sf_dir, "documents"), width=3, similarity=Fraction(9, 10))
    return found.select("doc_id", "n_shingles", "component_id")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.token_counts import count_tokens

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, tokenizer_path()).drop("text")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), window=2048, end_id=1)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.token_files import token_file_digest

    return token_file_digest(table(spark, sf_dir, "documents"), tokenizer_path(), length=2048, end_id=2)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.quality import score_quality, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score_quality(docs.select("doc_id", "text", "source", "lang"), model, keep_text=False)
    return scored.select("doc_id", "p_text", "host_mean", "path_mean", "p_quality", "accepted")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.decontaminate import benchmark_hits

    return benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.langid import identify, train

    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    prototypes = train(docs.where(fold != 0))
    held_out = F.coalesce(fold == 0, F.lit(False)).alias("held_out")
    return identify(docs.select("doc_id", held_out, "text"), prototypes).drop("text")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.url_filter import filter_urls, labelled_urls, train

    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES, train(labelled_urls(spark)))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.collocations import mine_collocations

    return mine_collocations(table(spark, sf_dir, "documents"), longest=3, least=10, top=2000)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.hard_negatives import mine_hard_negatives

    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine_hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), vec_id % 50 == 0)


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.bestfit import best_fit_documents

    return best_fit_documents(table(spark, sf_dir, "documents"), tokenizer_path(), window=2048, end_id=0)


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_quotation_links": op2_quotation_links,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_token_counts": op4_token_counts,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_token_files": op7_token_files,
    "op8_decontamination": op8_decontamination,
    "op9_language_id": op9_language_id,
    "op10_url_filter": op10_url_filter,
    "op11_collocations": op11_collocations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_best_fit": op13_best_fit,
}

#: All pairs, and what links reach from every row: for tables as small as the tests'.
ORACLE_SQL: dict[str, str] = {
    "op1_embedding_dedup": """WITH RECURSIVE x AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM x WHERE label IS NOT NULL AND e IS NOT NULL AND NOT list_bool_or(list_transform(e, lambda c: c IS NULL OR NOT isfinite(c))) AND list_sum(list_transform(e, lambda c: abs(c))) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT u, v FROM links UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
low AS (SELECT u, min(v) AS v FROM reach GROUP BY 1), n AS (SELECT u, count(*) AS n FROM links GROUP BY 1)
SELECT x.vec_id, coalesce(n.n, 0) AS n_links, least(x.vec_id, coalesce(l.v, x.vec_id)) AS component_id, coalesce(l.v, x.vec_id) >= x.vec_id AS kept FROM x LEFT JOIN n ON n.u = vec_id LEFT JOIN low l ON l.u = vec_id""",
    "op3_jaccard_join": r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM w),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM shared JOIN z a ON a.doc_id = u JOIN z b ON b.doc_id = v WHERE 100 * shared.n >= 90 * (a.n + b.n - shared.n)),
reach AS (SELECT u, v FROM links UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
low AS (SELECT u, min(v) AS v FROM reach GROUP BY 1)
SELECT w.doc_id, coalesce(z.n, 0) AS n_shingles, least(w.doc_id, coalesce(l.v, w.doc_id)) AS component_id FROM w LEFT JOIN z USING (doc_id) LEFT JOIN low l ON l.u = w.doc_id""",
    "op11_collocations": r"""WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
g AS (SELECT lang, 1 AS size, unnest(w) AS phrase FROM w
UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: array_to_string(w[i : i + 1], ' '))) FROM w
UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' '))) FROM w),
f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY 1, 2, 3),
n AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY 1),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
k AS (SELECT lang, phrase, f AS a, 1 AS k, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM c
UNION ALL SELECT lang, phrase, f, 2, array_to_string(w[:2], ' '), w[3] FROM c WHERE size = 3),
s AS (SELECT k.lang, k.phrase, a, k, l.f AS l, r.f AS r, 1000000 * a::HUGEINT * a // (l.f::HUGEINT * r.f) AS score
FROM k JOIN f l ON l.lang = k.lang AND l.phrase = x JOIN f r ON r.lang = k.lang AND r.phrase = y),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, p AS phrase, max(f) AS longer FROM (SELECT lang, f, unnest([array_to_string(w[:2], ' '), array_to_string(w[2:], ' ')]) AS p FROM c WHERE size = 3) GROUP BY 1, 2),
o AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, score
FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT o.lang, rank, o.phrase, a, l, r, CAST(n.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM o JOIN n ON n.lang = o.lang WHERE rank <= 2000""",
    "op12_hard_negatives": """WITH x AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
r AS (SELECT vec_id, label, list_transform(e, lambda c: floor(256 * c)) AS q FROM x WHERE label IS NOT NULL AND e IS NOT NULL AND NOT coalesce(list_bool_or(list_transform(e, lambda c: c IS NULL OR NOT isfinite(c))), false)),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM s JOIN p USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
}
