"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowgraph.llm import collocations, exact_dedup, jaccard, licenses, line_dedup, mixing, packing, quality, resampling, suffix_tree, token_files, topk, toxicity
from flowgraph.llm.common import table
from flowgraph.plans.sizing import shared_path


def op1_importance_resampling(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_topk_search(spark, sf_dir):
    return topk.topk(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op3_pack_buckets(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op5_license_sentences(spark, sf_dir):
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op6_toxic_clauses(spark, sf_dir):
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), suffix_tree.held_out(2, 4))


def op7_suffix_tree(spark, sf_dir):
    return suffix_tree.score(table(spark, sf_dir, "documents"), suffix_tree.held_out(0, 10))


def op8_jaccard_join(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=90, count_links=False).select("doc_id", "n_shingles", "component_id")


def op8_jaccard_links(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=90).select("doc_id", "cls", "n_shingles", "component_id", "n_links")


def op9_mix_sources(spark, sf_dir):
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "deleted_lines")


def op11_token_files(spark, sf_dir):
    import public_tokenizers

    folder = shared_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_tokens(spark, folder).select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op12_target_resampling(spark, sf_dir):
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES = {f.__name__: f for f in (op1_importance_resampling, op2_topk_search, op3_pack_buckets, op4_exact_dedup, op5_license_sentences, op6_toxic_clauses, op7_suffix_tree, op8_jaccard_join, op8_jaccard_links, op9_mix_sources, op10_line_dedup, op11_token_files, op12_target_resampling, op13_collocations)}
ORACLE = {"op2_topk_search": topk.ORACLE, "op4_exact_dedup": exact_dedup.ORACLE, "op8_jaccard_join": jaccard.ORACLE, "op9_mix_sources": mixing.ORACLE, "op12_target_resampling": resampling.ORACLE, "op13_collocations": collocations.ORACLE}
