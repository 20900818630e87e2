"""A corpus from raw documents to packed sequences.

``STAGES`` are applied in order; each works on all that its predecessor kept,
written as Parquet and read again.  Every stage but the last returns the columns
of ``documents`` (and any others that there are).

In every stage a null text counts as empty.  Quality, secrets and packing take each
row by its own text; near-duplicates and benchmark passages decide over ids, so rows
of one ``doc_id`` stay or go together there, and rows without an id stay.  Repeated
rows are kept or dropped alike.  An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, packing, quality, scratch, secrets, simhash
from tidemark.llm.components import apart
from tidemark.llm.tables import table, unused

#: Scores below it go.
GOOD = 0.5
#: A compressed text, a majority of bits and a k-step walk have no SQL form; tests hold a brute-force version.
ORACLE_SQL = None


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, learned from the labels, scores as good."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score_column(model) >= GOOD)


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose id is not in ``ids``; those are written first, so the join knows how many they are."""
    gone = scratch.materialise(ids.where("doc_id is not null").distinct())
    return docs.join(apart(gone, gone.count()), "doc_id", "left_anti").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of linked fingerprints."""
    found = simhash.near_duplicates(docs)
    return _without(docs, found.where("doc_id <> component_id").select("doc_id"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return _without(docs, decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and ``n_chars`` counted anew where they were."""
    path, blob, findings = unused(docs.columns, "path", "blob", "findings")
    found, _ = secrets.scan(docs, path_col="doc_id")
    hits = found.where(F.size("findings") > 0).select(F.col("path").alias(path), F.col("blob").alias(blob), F.col("findings").alias(findings)).distinct()
    # Texts that can't hold a finding stay where they are; the few others meet theirs.
    may = secrets.hinted(F.coalesce("text", F.lit("")))
    some = docs.where(may)
    same = some["doc_id"].eqNullSafe(F.col(path)) & (secrets.address(some["text"]) == F.col(blob))
    joined = some.join(hits, same, "left")
    text = F.when(F.col(findings).isNull(), F.col("text")).otherwise(secrets.redact(F.col("text"), F.col(findings)))
    clean = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.col(findings).isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind)))
    return docs.where(~may).unionByName(clean.select(*docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of the corpus's mixture."""
    return packing.digest(packing.pack(docs))


STAGES = [
    ("quality classifier", drop_low_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("secret scans", redact_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.materialise(docs)
    return docs
