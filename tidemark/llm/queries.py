"""opN_<name>: each operator with production parameters over its whole table, and the digests its contract names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .collocations import collocations
from .decontamination import contamination
from .hidden_markov import score_held_out
from .invertible_sketch import fingerprints
from .jaccard_join import near_classes
from .language_id import identify
from .license_scan import scan_licenses
from .packing import pack
from .periodic_runs import periodic_runs
from .substring_dedup import remove_repeats
from .threshold_topk import top_products
from .token_store import write_store
from .url_filter import judge


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents")).drop("templates")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "pages"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(_table(spark, sf_dir, "documents"))


def op5_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_held_out(_table(spark, sf_dir, "documents"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents")).drop("changed", "changed_next")


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = write_store(_table(spark, sf_dir, "documents"))
    # Every key is looked up through the index files; its ids come from the shard files.
    rows = store.read(store.entries.select("doc_id", "copy"))
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.col("offset").cast("long").alias("offset"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    hit = F.aggregate(F.zip_with("starts", "stops", lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"),
                      lambda x, y: x + y)
    named = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return out.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(named, 256).alias("items_sha256"), (F.size("starts") > 0).alias("contaminated"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


def op11_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(_table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs(_table(spark, sf_dir, "documents"), looped_tails=True)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period", "exponent_milli",
                      F.sha2(F.concat_ws("", line), 256).alias("runs_sha256"),
                      F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_url_filter": op3_url_filter,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_hidden_markov": op5_hidden_markov,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_token_store": op7_token_store,
    "op8_packing": op8_packing,
    "op9_decontamination": op9_decontamination,
    "op10_language_id": op10_language_id,
    "op11_threshold_topk": op11_threshold_topk,
    "op12_collocations": op12_collocations,
    "op13_periodic_runs": op13_periodic_runs,
}
