"""A training corpus from raw documents: stages over the operators of ``pictolytics.llm``.

Every stage works on all that the stage before it kept, and its decisions take effect: toxic documents
go, one document of each group of near copies stays, documents that hold benchmark items go, secrets are
struck out of the texts, and what is left is packed. Stages are written as Parquet and read again, so a
lost executor never costs more than a stage.

All stages take any further columns, whatever these are named, and give them back unchanged. An empty table stays
empty throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pictolytics.llm import decontamination, jaccard, packing, secrets, toxicity
from pictolytics.llm.common import by_name, by_place, landed, table
from pictolytics.llm.queries import CATEGORIES

#: The classifiers, the joins and the packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject.

    Each row is judged by its text: rows without an id too, repeated ones alike. A null or empty text has no toxic word.
    """
    placed, (key, text) = by_place(docs, "doc_id", "text")
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", key)
    chain = toxicity.fit_chain(placed, labels, CATEGORIES, key, text)
    scored = toxicity.score_chain(placed, chain, text)
    return by_name(scored.where(F.col("p_toxic") < chain.thresholds["toxic"]), docs.columns)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    Texts without words are no copies of each other and stay. Where rows lack an id or share one, all rows are
    numbered first, and a group keeps one row, the first by id, then number; ids are preferred to none.
    """
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.where("doc_id IS NULL OR n > 1").isEmpty():
        groups = jaccard.similar_components(docs.select("doc_id", "text"))
        others = groups.where("component_id <> doc_id").select("doc_id")
        others = landed(others, "near-copies")  # ids only; their number decides how they are joined
        return docs.join(others, "doc_id", "left_anti").select(*docs.columns)
    placed, (key, text) = by_place(docs, "doc_id", "text")
    rows = landed(placed.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    groups = jaccard.similar_components(rows.select("_row", text), "_row", text)
    first = F.min(F.struct(F.col(key).isNull(), F.col(key), F.col("_row"))).alias("first")
    kept = rows.select("_row", key).join(groups, "_row").groupBy("component_id").agg(first)
    return by_name(rows.join(landed(kept.select("first._row"), "kept-rows"), "_row", "left_semi"), docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item; repeated rows go or stay together, null and empty texts stay."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets struck out and ``n_chars`` counted anew where that changed it.

    Each row by its text, with or without an id; null texts stay null.
    """
    placed, (key, text, n_chars) = by_place(docs, "doc_id", "text", "n_chars")
    found = secrets.find_secrets(placed, key, text)
    struck = found.withColumn(text, secrets.redact(F.col(text), F.col("spans")))
    length = F.when(F.size("spans") > 0, F.char_length(text)).otherwise(F.col(n_chars))
    return by_name(struck.withColumn(n_chars, length.cast(docs.schema["n_chars"].dataType)), docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 ids; a null text is packed as an empty one, each row by itself."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near copies", near_copies_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
