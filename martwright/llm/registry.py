"""The subpackage's queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, collocations, exact_dedup, html_extract, lexical_search, license_scan, line_dedup, minhash_dedup,
               packing, quality_knn, quality_rules, substring_dedup, topk_search)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extract": html_extract.op1_html_extract,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_quality_classifier": quality_knn.op3_quality_classifier,
    "op4_bpe": bpe.op4_bpe,
    "op5_license_scan": license_scan.op5_license_scan,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_exact_topk": topk_search.op8_exact_topk,
    "op9_minhash_dedup": minhash_dedup.op9_minhash_dedup,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_collocations": collocations.op11_collocations,
    "op12_lexical_search": lexical_search.op12_lexical_search,
    "op13_exact_dedup": exact_dedup.op13_exact_dedup,
}

ORACLE: dict[str, str] = {
    "op2_line_dedup": line_dedup.oracle(),
    "op8_exact_topk": topk_search.oracle(),
    "op10_quality_rules": quality_rules.oracle(),
    "op11_collocations": collocations.oracle(),
    "op12_lexical_search": lexical_search.oracle(),
    "op13_exact_dedup": exact_dedup.oracle(),
}
