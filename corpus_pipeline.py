"""The text pipeline: quality rules, near-duplicates, decontamination, secrets, packing.

Each stage takes the table the stage before wrote. All but the last give the columns of documents,
whatever further ones there are and whatever their names. An empty table stays empty in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import decontaminate, packing, rules, secrets, simhash
from shelfwise.llm.common import table
from shelfwise.llm.queries import tokenizer
from shelfwise.session import staged


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rejected documents go, those without text among them; the others lose the lines that fail.
    Repeated rows are judged each, rows with a null id like any other."""
    return rules.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each near-duplicate component stays: that with the smallest id, null last;
    of repeated rows with that id, one with the smallest fingerprint, then the smallest text hash.
    Texts without words, null ones included, are one component."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a benchmark item go. Those without text stay, repeated rows go or stay
    together, and items without text are in no document."""
    return decontaminate.cleaned(docs, table(spark, folder, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; all documents stay, repeated ones too. Spans
    that overlap are replaced once, and a null text stays null."""
    return secrets.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents' tokens as pieces of training sequences. A document without text is its end id
    alone; repeated rows are packed each."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

# SQL has neither the hash of the near-duplicates nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written and read again."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
