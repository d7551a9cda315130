"""The queries of this folder and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, fingerprint, language, neardup, pagetext, passages, pieces, pii, records, secret_scan, variants, whitening


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_spotsigs_fingerprint": fingerprint.op1,
    "op2_language_mixture": language.op2,
    "op3_forced_boundary_bpe": bpe.op3,
    "op4_binary_records": records.op4,
    "op5_pii_spans": pii.op5,
    "op6_minhash_tensored": neardup.op6,
    "op7_page_differencing": pagetext.op7,
    "op8_secret_entropy": secret_scan.op8,
    "op9_gear_chunk_dedup": passages.op9,
    "op10_wu_manber_decontamination": decontaminate.op10,
    "op11_distinct_chunk_pieces": pieces.op11,
    "op12_bit_sliced_whitening": whitening.op12,
    "op13_trie_variants": variants.op13,
    "pipeline": pipeline,
}
SQL = {
    "op10_wu_manber_decontamination": decontaminate.OP10_SQL,
}
