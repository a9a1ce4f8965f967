"""The registered queries of the text operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (best_position, cap_filters, exact_dedup, hyperplane_tree, language_id, line_dedup, masked_lm, mixing,
               ngram_join, packing, repetition, secret_scan, token_counts)
from .common import table

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_token_counts(spark, sf_dir):
    """Histogram of encoded lengths with suffix sums for every context limit."""
    return token_counts.context_table(token_counts.length_histogram(table(spark, sf_dir, "documents")))


@query
def op2_mixing(spark, sf_dir):
    """Words taken of each document when sources weigh 3, 1, 2, ... and share 150 % of all words, 2 epochs at most."""
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


@query
def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query
def op7_secret_scan(spark, sf_dir):
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


@query
def op6_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op10_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


@query
def op9_masked_lm(spark, sf_dir):
    return masked_lm.pseudo_likelihood(table(spark, sf_dir, "documents"))


@query
def op8_cap_filters(spark, sf_dir):
    return cap_filters.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op5_ngram_join(spark, sf_dir):
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


@query
def op4_line_dedup(spark, sf_dir):
    return line_dedup.line_groups(table(spark, sf_dir, "documents"))


@query
def op11_repetition(spark, sf_dir):
    """Base figures, words in maximal repeats and the verdict of the suffix arrays."""
    return repetition.repetition(table(spark, sf_dir, "documents")).drop("n_maximal", "longest_repeat")


@query
def op12_hyperplane_tree(spark, sf_dir):
    """Hard negatives of the anchors (ids divisible by 100), where every seventh row has the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hyperplane_tree.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


@query
def op13_best_position(spark, sf_dir):
    """The 50 best documents for every benchmark item."""
    return best_position.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def pipeline(spark, sf_dir):
    """Language ID, line de-duplication, n-gram join, mixing, packing over ``documents``."""
    from corpus_pipeline import run
    return run(spark, sf_dir)
