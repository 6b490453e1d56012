"""A training corpus from raw documents: quality, near duplicates, decontamination, PII, packing.

Each stage works on all documents that its predecessor kept. All but the last return
the columns of ``documents``.

Defined results: null and empty texts have fewer than 50 words, so quality drops them;
given to a later stage they have no near duplicates, no benchmark passage and no
personal values, and are packed as their separator. Null ids stay and are documents like
others; a null language is a language of its own. Of rows with equal id and text one
stays in near duplicates; of a group whose rows have ids the one with the least. Texts
are read whole, whatever their length. An empty table stays empty. Columns that
``documents`` has besides its own, under any names, go through all stages but the last
as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from medallion.llm.common import written
from medallion.llm.decontamination import uncontaminated
from medallion.llm.jaccard import one_of_each
from medallion.llm.packing import pack
from medallion.llm.pii import pseudonymized
from medallion.llm.quality import measure
from medallion.llm.queries import PII_KEY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the count rules or the perplexity band of their language go."""
    # any column may have the name of a count or of the verdict
    names = {c: f"_d{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    found = measure(renamed, names["doc_id"], names["text"], names["lang"], carry=tuple(names.values()))
    return found.filter("kept").select(*[F.col(n).alias(c) for c, n in names.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the least id."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values are replaced; n_chars follows the text where it changed."""
    finds = "_found"
    while finds in {c.lower() for c in docs.columns}:
        finds = f"_{finds}"
    found = pseudonymized(docs, PII_KEY, finds_column=finds)
    n_chars = F.when(F.size(finds) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", n_chars).select(*[F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenized documents in sequences of 2048 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), derive={"ids_crc32": F.crc32("ids")})


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]

#: perplexities and components are not for SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
