"""A training corpus from the documents: quality, near copies, repeated lines, benchmark passages, packing.

Each stage takes what the one before it kept, written as Parquet and read again. Stages keep the columns of
`documents`; the last gives the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from traceops.llm import decontam, jaccard, line_dedup, packing, quality
from traceops.llm.storage import checkpointed
from traceops.llm.text import spare


def keep_good(spark, docs, sf_dir):
    """Documents that the quality ranking rejects go."""
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_one_of_each(spark, docs, sf_dir):
    """One document of each group of near copies stays, the one with the smallest id."""
    return jaccard.one_of_each(docs)


def cut_repeats(spark, docs, sf_dir):
    """Repeated passages go but for the first; the number of characters follows the text."""
    places, = spare(docs, "_places")
    rows = line_dedup.dedup_lines(docs, removed=places).drop(places)
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else rows


def drop_leaks(spark, docs, sf_dir):
    """Documents with a passage of the benchmark go."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark, docs, sf_dir):
    """Pieces of sequences of 1024 ids."""
    return packing.pack_documents(docs)


STAGES = [("quality", keep_good), ("near_copies", keep_one_of_each), ("repeated_lines", cut_repeats),
          ("benchmark", drop_leaks), ("packing", pack)]

#: SQL has no tokenizer, ranking or alignment: tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
