"""Queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op10_best_fit_packing(spark, folder):
    import public_tokenizers

    from .packing import pack

    return pack(
        table(spark, folder, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        derive={"ids_crc32": F.crc32("ids")},
    )


@query
def op8_benchmark_decontamination(spark, folder):
    from .decontamination import contamination

    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", _covered("spans").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


@query
def op5_quality_rules(spark, folder):
    from .quality import measure

    return measure(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _covered(spans: str):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])


@query
def op2_substring_dedup(spark, folder):
    from .substrings import without_earlier

    return without_earlier(table(spark, folder, "documents")).select(
        "doc_id", "n_words", _covered("spans").alias("n_removed"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


@query
def op6_suffix_array_dedup(spark, folder):
    from .suffixes import without_repeats

    return without_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", _covered("spans").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op4_ngram_jaccard_join(spark, folder):
    from .jaccard import near_duplicates

    return near_duplicates(table(spark, folder, "documents"))


@query
def op7_warc_archive(spark, folder):
    from .warc import read_archives, write_archives

    return read_archives(write_archives(table(spark, folder, "pages"))).select(
        F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query
def op1_url_filter(spark, folder):
    from .urls import Rule, judge

    rules = [
        Rule("block", "net/", site=True),
        Rule("allow", "example.net/en/", site=True),
        Rule("block", "example.com/de/", site=True),
        Rule("allow", "org/fr/", site=True),
        Rule("block", "||spam-farm."),
        Rule("block", "||ads-track."),
        Rule("allow", "||spam-farm.*/en/7*.html|"),
        Rule("block", "^casino^"),
    ]
    return judge(table(spark, folder, "pages"), rules)

#: stands for a secret that a real run reads from its own settings
PII_KEY = "example key"


@query
def op3_pii_pseudonyms(spark, folder):
    from .pii import pseudonymized

    found = pseudonymized(table(spark, folder, "documents").select("doc_id", "text"), PII_KEY, finds_column="found")
    return found.select("doc_id", "text", F.size("found").cast("long").alias("n_found"), F.array_join("found", ",").alias("kinds"))


def document_paths(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: the shorter a text, the nearer to the top of its source."""
    depth = F.when(F.col("n_chars") < 400, F.array("source")).when(
        F.col("n_chars") < 1500, F.array("source", "lang")
    ).otherwise(F.array(F.col("source"), F.col("lang"), F.expr("cast(doc_id div 1000 AS string)")))
    return docs.select(
        "doc_id", "text", F.concat(F.array_join(depth, "/"), F.lit("/"), F.col("doc_id"), F.lit(".txt")).alias("path")
    )


@query
def op9_license_scan(spark, folder):
    from .licenses import scan

    return scan(document_paths(table(spark, folder, "documents")))


@query
def op12_sentencepiece(spark, folder):
    import public_tokenizers

    from .pieces import encode

    coded = encode(
        table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), round_trip=True
    )
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op11_merkle_manifest(spark, folder):
    from .manifest import manifest

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(tampered, F.translate("text", upper, lower)).otherwise(F.col("text"))
    return manifest(table(spark, folder, "documents"), claimed={"text": text}).proofs()


@query
def op13_phrase_collocations(spark, folder):
    from .phrases import phrase_graph

    return phrase_graph(table(spark, folder, "documents")).collocations()
