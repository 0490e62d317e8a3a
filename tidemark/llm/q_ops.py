"""The registered queries: each applies its operator, with production
parameters, to the whole of its table."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import decontaminate, mixing, neardup, passages, pii, ppm, prefixtrie, quality, secrets, structure, tokencount, topk, toxicity
from .common import table


def op1_quality(spark, sf_dir):
    """doc_id, held_out, score, predicted of every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_neardup(spark, sf_dir):
    """doc_id, class_id, class_size of every document."""
    return neardup.classes(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark, sf_dir):
    """doc_id, item_id, containment of every document that holds a benchmark item."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_secrets(spark, sf_dir):
    """Counts, digest and spans of the secrets of every document."""
    return secrets.report(table(spark, sf_dir, "documents"))


def op4_mix(spark, sf_dir):
    """The documents that fill the budgets of the domain-language-source tree."""
    return mixing.production(spark, table(spark, sf_dir, "documents"))


def op7_tokens(spark, sf_dir, name="byte_bpe_50k.json"):
    """Token counts of every document by the public byte-level BPE."""
    import public_tokenizers
    return tokencount.report(table(spark, sf_dir, "documents"), public_tokenizers.path(name))


def op8_pii(spark, sf_dir):
    """Counts, digest and spans of the personal data of every document."""
    return pii.report(table(spark, sf_dir, "documents"))


def op2_ppm(spark, sf_dir):
    """Base and model log10 probabilities of every document."""
    return ppm.score(table(spark, sf_dir, "documents"))


def op6_topk(spark, sf_dir):
    """The 20 greatest integer inner products of every 20th vector."""
    return topk.topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_passages(spark, sf_dir):
    """The passages of 50 words or more that repeat across documents."""
    return passages.repeats(table(spark, sf_dir, "documents"))


def op12_toxicity(spark, sf_dir):
    """doc_id, held_out, score, predicted of every document."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_structure(spark, sf_dir):
    """Faults, cheapest edits and repaired hash of every damaged conversation."""
    return structure.report(table(spark, sf_dir, "conversations"))


def op11_prefixtrie(spark, sf_dir):
    """One row for each node of the prefix trie of the rebuilt conversations."""
    return prefixtrie.nodes(table(spark, sf_dir, "conversations"))


QUERIES = {"op11_prefixtrie": op11_prefixtrie, "op13_structure": op13_structure, "op12_toxicity": op12_toxicity, "op5_passages": op5_passages, "op6_topk": op6_topk, "op2_ppm": op2_ppm, "op8_pii": op8_pii, "op7_tokens": op7_tokens, "op4_mix": op4_mix, "op1_quality": op1_quality, "op3_neardup": op3_neardup, "op10_decontaminate": op10_decontaminate, "op9_secrets": op9_secrets}
SQL = {"op11_prefixtrie": prefixtrie.oracle_sql(), "op13_structure": structure.oracle_sql(), "op4_mix": mixing.oracle_sql(), "op6_topk": topk.oracle_sql()}
