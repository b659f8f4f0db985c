"""The subpackage's named queries: each applies one operator to its whole table."""

from __future__ import annotations

import corpus_pipeline

from . import exactdedup, htmltext, langid, licenses, linededup, media, mixing, neardup, packing, tokencount
from .shared import read

QUERIES: dict = {
    "op1_media_columns": lambda spark, sf_dir: media.op1(read(spark, sf_dir, "documents")),
    "op2_language_id": lambda spark, sf_dir: langid.op2(read(spark, sf_dir, "documents")),
    "op3_token_counts": lambda spark, sf_dir: tokencount.op3(read(spark, sf_dir, "documents")),
    "op4_best_fit_packing": lambda spark, sf_dir: packing.op4(read(spark, sf_dir, "documents")),
    "op5_mix_sources": lambda spark, sf_dir: mixing.op5(read(spark, sf_dir, "documents")),
    "op6_html_text": lambda spark, sf_dir: htmltext.op6(read(spark, sf_dir, "pages")),
    "op7_exact_dedup": lambda spark, sf_dir: exactdedup.op7(read(spark, sf_dir, "documents")),
    "op8_license_scan": lambda spark, sf_dir: licenses.op8(read(spark, sf_dir, "documents")),
    "op9_minhash_near_dedup": lambda spark, sf_dir: neardup.op9(read(spark, sf_dir, "documents")),
    "op10_line_dedup": lambda spark, sf_dir: linededup.op10(read(spark, sf_dir, "documents")),
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op7_exact_dedup": exactdedup.OP7_SQL,
    "op8_license_scan": licenses.OP8_SQL,
    "op9_minhash_near_dedup": neardup.OP9_SQL,
    "op10_line_dedup": linededup.OP10_SQL,
}
