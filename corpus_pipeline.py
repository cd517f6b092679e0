"""The corpus pipeline: quality rules, near-duplicates, recurring passages, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; all but the last return the columns of ``documents``.
``run`` writes every stage's rows as Parquet in the shared folder and rereads them, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from policylens.llm import host_rules, mixing, packing, setsketch, substring
from policylens.llm.queries import tokenizer_path
from policylens.llm.text import Scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return host_rules.reject(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return setsketch.one_of_each(docs)


def recurring_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.Repeats(docs, docs["doc_id"], docs["text"]).cleaned(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, docs["doc_id"], docs["text"], packing.Packing(tokenizer_path()))


STAGES = [("quality rules", quality_rules), ("near-duplicates", near_duplicates), ("recurring passages", recurring_passages),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: Sketches, automata, bisection and token ids are not SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.put(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
