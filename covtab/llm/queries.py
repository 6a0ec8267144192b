"""The operators as registered queries over the whole given tables, and their
DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covtab.llm import (
    exact_dedup, lm_scoring, matrix_output, page_diff, pattern_packing, phrase_tries, piece_bpe, quality_rules, quotation_links,
    secret_scan, simhash, substring_dedup, vector_codes,
)
from covtab.llm.common import read_table


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Losses of each document, in millionths of a nat, under models of the
    documents labelled good and of all documents."""
    good = read_table(spark, sf_dir, "labels").where("quality = 1")
    micro = lambda c: F.round(F.col(c) * 1e6).cast("long").alias(c)
    return lm_scoring.score(read_table(spark, sf_dir, "documents"), good).select(
        "doc_id", "n_tokens", *map(micro, ("target_loss", "background_loss", "difference")))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each document, less those in repeated windows."""
    return substring_dedup.removed_words(read_table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of each document and of the text decoded from them."""
    return piece_bpe.digests(read_table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of each document, and whether it stays."""
    groups = exact_dedup.duplicate_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of each document and the group that links lead to."""
    groups = simhash.near_duplicate_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as mails: above its own text each message quotes the
    one before it, and at a second level the one before that; of messages with
    one turn, the first by text is quoted."""
    messages = read_table(spark, sf_dir, "conversations")
    text = F.coalesce("text", F.lit(""))
    quote = lambda mark, c: F.regexp_replace(c, "(?m)^", mark)
    back = lambda n: messages.groupBy("conv_id", (F.col("turn") + n).alias("turn")).agg(F.min(text).alias(f"_{n}"))
    return messages.join(back(1), ["conv_id", "turn"], "left").join(back(2), ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", F.concat_ws("\n", quote("> > ", F.col("_2")), quote("> ", F.col("_1")), text).alias("text"))


def op6_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each message of the mails, its parent and path, the tree it is in and its place there, and its text without quotes."""
    linked = quotation_links.formatted(quotation_links.link_replies(_mails(spark, sf_dir), positions=True))
    return linked.select("conv_id", "turn", "role", F.col("parent_turn").cast("string"), F.array_join("path", "/").alias("path"),
                         "root_turn", "position",
                         "n_quoted", "n_linked", F.sha2("text", 256).alias("text_sha256"), F.sha2("chat", 256).alias("chat_sha256"))


def op7_matrix_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the packed matrix, ids and positions as checksums."""
    rows = matrix_output.pack_rows(read_table(spark, sf_dir, "documents"))
    return rows.select("row_id", F.crc32("ids").alias("ids_crc32"), F.crc32("positions").alias("positions_crc32"),
                       "cu_seqlens", "segments")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of each document."""
    found = secret_scan.scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "n_random",
                        F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of each document."""
    return quality_rules.judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in the packed sequences."""
    return pattern_packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op11_phrase_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language."""
    return phrase_tries.collocations(read_table(spark, sf_dir, "documents"))


def op12_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page."""
    return page_diff.extract(read_table(spark, sf_dir, "pages"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of each vector, its error, and that of its label."""
    found, books = vector_codes.compress(read_table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                        F.lit(vector_codes.codebooks_sha256(books)).alias("codebooks_sha256"))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_quotation_linking": op6_quotation_linking,
    "op7_matrix_output": op7_matrix_output,
    "op8_secret_scan": op8_secret_scan,
    "op9_quality_rules": op9_quality_rules,
    "op10_pattern_packing": op10_pattern_packing,
    "op11_phrase_tries": op11_phrase_tries,
    "op12_page_diff": op12_page_diff,
    "op13_vector_codes": op13_vector_codes,
}
