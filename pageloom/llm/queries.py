"""One query for each operator, over whole tables with production parameters, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm import (
    collocations, decontaminate, jaccard_join, mixing, pii, quality_gam, quality_rules, ranked_search, recurrent_lm, sharding, suffix_dedup,
    token_store, url_filter,
)
from pageloom.sources import scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Domain of each source of the tables; other sources belong to "other".
DOMAINS = {"web": range(0, 5), "news": range(5, 10), "books": range(10, 15), "forums": range(15, 20)}
WEIGHTS = {
    "domain": {"web": 0.4, "news": 0.25, "books": 0.2, "forums": 0.15, "other": 0.05},
    "lang": {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1},
}


#: Verdict, host and path.
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def with_domain(docs: DataFrame) -> DataFrame:
    """Documents with the domain of their source."""
    domain = F.lit("other")
    for name, numbers in DOMAINS.items():
        domain = F.when(F.col("source").isin([f"src{k}" for k in numbers]), name).otherwise(domain)
    return docs.withColumn("domain", domain)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms of every document."""
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    model = url_filter.train(url_filter.default_table(spark))
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES, model)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and tokens taken from each leaf of the domain, language and source tree."""
    return mixing.mix(with_domain(table(spark, sf_dir, "documents")), WEIGHTS)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op5_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_gam.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.assign(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and the verdict of the weighed rules."""
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"]
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(*columns)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items held in documents, with their exact containment."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, number and checksum of every document's token ids, read back from the files."""
    import public_tokenizers

    path = scratch.new_path(spark, "token-ids")
    return token_store.read(token_store.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json")))


def op10_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under the counts and under the recurrent model."""
    return recurrent_lm.score(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked_search.search(ranked_search.build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that every document loses to strings found earlier, and the digest of the rest."""
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 collocations."""
    return collocations.mine(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_url_filter": op2_url_filter,
    "op3_mixing": op3_mixing,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_quality_gam": op5_quality_gam,
    "op6_sharding": op6_sharding,
    "op7_quality_rules": op7_quality_rules,
    "op8_decontaminate": op8_decontaminate,
    "op9_token_store": op9_token_store,
    "op10_recurrent_lm": op10_recurrent_lm,
    "op11_ranked_search": op11_ranked_search,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_collocations": op13_collocations,
}

_SHINGLES = """
    SELECT DISTINCT {key}, array_to_string(w[i:i + 4], ' ') AS shingle
    FROM (SELECT {key}, w, unnest(range(1, len(w) - 3)) AS i
          FROM (SELECT {key}, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM {table})
          WHERE len(w) >= 5)
"""

ORACLES: dict[str, str] = {
    "op8_decontaminate": f"""
        WITH item AS ({_SHINGLES.format(key="item_id", table="benchmark")}),
             doc AS ({_SHINGLES.format(key="doc_id", table="documents")}),
             total AS (SELECT item_id, count(*) AS n_shingles FROM item GROUP BY item_id)
        SELECT item_id, doc_id, n_shingles, count(*) AS n_shared, count(*) / n_shingles AS containment
        FROM item JOIN doc USING (shingle) JOIN total USING (item_id)
        GROUP BY item_id, doc_id, n_shingles HAVING count(*) >= 0.8 * n_shingles
    """,
    "op11_ranked_search": r"""
        WITH doc AS (SELECT row_number() OVER () AS r, doc_id,
                            regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS w FROM documents),
             tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM doc) GROUP BY r, term),
             df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
             total AS (SELECT count(*) AS n_docs, sum(len(w)) AS n_terms FROM doc WHERE len(w) > 0),
             size AS (SELECT r, doc_id, 10 + CAST((90 * CAST(len(w) AS HUGEINT) * n_docs) // n_terms AS BIGINT) AS m FROM doc, total WHERE len(w) > 0),
             item AS (SELECT DISTINCT item_id, term FROM (
                 SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark)),
             weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM df, total),
             scored AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
                        FROM item JOIN weight USING (term) JOIN tf USING (term) JOIN size USING (r) GROUP BY item_id, r, doc_id)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
        FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
        WHERE rank <= 10
    """.replace("{UPPER}", "ABCDEFGHIJKLMNOPQRSTUVWXYZ").replace("{LOWER}", "abcdefghijklmnopqrstuvwxyz").replace(
        "{TERM}", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"),
    "op13_collocations": r"""
        WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
             words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
             total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
             place AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
             run AS (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
                     FROM place, (SELECT unnest(range(1, 6)) AS size) WHERE i + size - 1 <= len(w)),
             known AS (SELECT lang, size, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM run GROUP BY lang, size, phrase HAVING count(*) >= 100),
             cut AS (SELECT lang, size, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
                     FROM known, (SELECT unnest(range(1, 5)) AS k) WHERE k < size),
             scored AS (SELECT c.lang, c.phrase, a, h.f AS l, t.f AS r, n, k,
                               CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(h.f AS HUGEINT) * t.f) AS BIGINT) AS score
                        FROM cut c JOIN known h ON h.lang = c.lang AND h.phrase = c.head JOIN known t ON t.lang = c.lang AND t.phrase = c.rest
                             JOIN total ON total.lang = c.lang),
             best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS low FROM scored) WHERE low = 1),
             inner_ AS (SELECT o.lang, array_to_string(o.w[s:s + z - 1], ' ') AS phrase, max(o.f) AS most
                        FROM known o, (SELECT unnest(range(1, 5)) AS s), (SELECT unnest(range(2, 5)) AS z)
                        WHERE z < o.size AND s + z - 1 <= o.size GROUP BY 1, 2),
             kept AS (SELECT b.* FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.most IS NULL OR 100 * i.most < 100 * b.a)
        SELECT lang, rank, phrase, a, l, r, n, score
        FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept) WHERE rank <= 2000
    """,
}
