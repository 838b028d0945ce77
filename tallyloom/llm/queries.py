"""Queries of the problems of language-model data, with their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import garbled, packing, subjects, tokens
from tallyloom.sources.tables import table


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "stored_files", "file_no", "filename")
    catalogue = table(spark, sf_dir, "kess_files", "entry_no", "display_name")
    return files.select(F.lit("stored_files").alias("table_name"), F.col("file_no").alias("row_id"), F.col("filename").alias("name")).unionByName(
        catalogue.select(F.lit("kess_files").alias("table_name"), F.col("entry_no").alias("row_id"), F.col("display_name").alias("name"))
    )


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled.find_garbled(_names(spark, sf_dir)).select("table_name", "row_id")


def p4_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled.find_garbled(_names(spark, sf_dir))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_texts(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    sizes = tokens.token_counts(documents, "doc_id", "text")
    return packing.pack(sizes, "doc_id", table(spark, sf_dir, "container_sizes"), documents.count())


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers of each kind are."""
    return packing.fill(p7_containers(spark, sf_dir))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "subject_labels", "doc_id", "subject", "annotator")
    names = sorted(r.subject for r in table(spark, sf_dir, "subject_areas", "subject").filter("subject is not null").distinct().collect())
    return subjects.assign(documents, "doc_id", "text", subjects.train(documents, labels, "doc_id", "text", names))


def p8_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The make-up of the corpus by language and subject."""
    return subjects.composition(p8_found(spark, sf_dir), table(spark, sf_dir, "documents", "doc_id", "lang"), "doc_id", "lang")


QUERIES = {"p4_found": p4_found, "p4_restored": p4_restored, "p6_ids": p6_ids, "p7_containers": p7_containers, "p7_fill": p7_fill, "p8_found": p8_found, "p8_composition": p8_composition}
SQL: dict[str, str] = {}
