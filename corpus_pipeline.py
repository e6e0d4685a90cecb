"""A training-data pipeline over `documents`: each stage works on what its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a frame; between stages the frame is written as Parquet and read
again. All but the last return the columns of `documents`. Rows are told apart by id and text: rows that
agree in both are copies, of which the near-duplicate stage keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import decontaminate, jaccard_join, langid, pii
from tripflow.llm.common import free_name, session, stored
from tripflow.llm.queries import encoded

# A document is rejected when a smaller share of its n-grams is known in the language it fits best. A text of one
# letter has no n-gram to measure and stays.
LEAST_KNOWN_SHARE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have letters and whose n-grams, where they have any, belong to a known language."""
    session(spark)
    added = tuple(free_name(docs.columns, x) for x in ("lang_pred", "score", "n_grams"))
    found = langid.predict(docs, langid.fit(docs), keep=tuple(docs.columns), added=added)
    known = (F.col(added[0]) != langid.UNKNOWN) & ((F.col(added[1]) >= LEAST_KNOWN_SHARE) | (F.col(added[2]) == 0))
    return found.where(known).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id; texts without words all stay."""
    session(spark)
    groups = stored(jaccard_join.labelled(docs), "groups")
    # One row of each group: its smallest id, and the smallest text hash where that id has several texts. Groups are
    # told apart by their label: those without ids, and those that begin with the same id, share a component_id.
    heads = groups.where((F.col("n_shingles") > 0) & F.col("doc_id").eqNullSafe(F.col("component_id")))
    heads = heads.groupBy("component", F.col("component_id").alias("_id")).agg(F.min("text_key").alias("_key"))
    heads = stored(heads.select("_id", "_key"), "heads")
    empty = groups.where("n_shingles = 0").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    # With the number of rows that agree in id and text: only these are shuffled to keep one of them.
    rows = groups.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.count("*").alias("_n"))
    chosen = heads.unionByName(empty.distinct()).withColumnsRenamed({"_id": "_i", "_key": "_k"})
    same = rows["_id"].eqNullSafe(chosen["_i"]) & (rows["_key"] == chosen["_k"])
    wanted = stored(rows.join(chosen, same, "left_semi"), "wanted")
    kept = _of_list(docs, wanted.where("_n = 1"))
    repeated = wanted.where("_n > 1")
    if repeated.isEmpty():
        return kept
    return kept.unionByName(_of_list(docs, repeated).dropDuplicates(["doc_id", "text"]))


def _of_list(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of `docs` whose id and text hash are listed. A list of checked size goes to all executors and leaves the
    texts in place; a longer one is shuffled."""
    wanted = wanted.select("_id", "_key")
    same = docs["doc_id"].eqNullSafe(wanted["_id"]) & (F.xxhash64(docs["text"]) == wanted["_key"])
    wanted = F.broadcast(wanted) if wanted.count() <= jaccard_join.BROADCAST_ROWS else wanted
    return docs.join(wanted, same, "left_semi")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any phrase of the benchmark."""
    session(spark)
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    hits = decontaminate.exact_hits(decontaminate.build_index(docs), benchmark).where("n_hit > 0")
    hits = stored(hits.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "hits")
    leaked = docs["doc_id"].eqNullSafe(hits["_id"]) & (F.xxhash64(docs["text"]) == hits["_key"])
    hits = F.broadcast(hits) if hits.count() <= jaccard_join.BROADCAST_ROWS else hits
    return docs.join(hits, leaked, "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and n_chars brought up to date."""
    session(spark)
    return pii.mask_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, their count, and digests of the ids and of what they decode to."""
    import public_tokenizers as public

    session(spark)
    # Executors still hold what earlier stages needed: the encoder remembers less and takes longer.
    return encoded(docs, public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN, "ids", share=0.25)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("byte_bpe", byte_bpe),
]

# SQL can express neither the language filters nor the tokenizer; tests/llm checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
