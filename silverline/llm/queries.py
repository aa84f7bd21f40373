"""The registered queries of this package, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from silverline.llm.best_fit_packing import op13_best_fit_packing
from silverline.llm.bpe import op6_bpe
from silverline.llm.filter_audit import op11_filter_audit
from silverline.llm.fingerprints import op10_fingerprints
from silverline.llm.jaccard_join import op8_ngram_jaccard
from silverline.llm.license_scan import op7_license_scan
from silverline.llm.lm_scoring import op4_lm_scoring
from silverline.llm.pii import op3_pii_spans
from silverline.llm.quality_classifier import op1_quality_classifier
from silverline.llm.quality_rules import op5_quality_rules
from silverline.llm.ranked_search import op12_ranked_search
from silverline.llm.source_mix import op9_source_mix
from silverline.llm.suffix_dedup import op2_suffix_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_pii_spans": op3_pii_spans,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_quality_rules": op5_quality_rules,
    "op6_bpe": op6_bpe,
    "op7_license_scan": op7_license_scan,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_source_mix": op9_source_mix,
    "op10_fingerprints": op10_fingerprints,
    "op11_filter_audit": op11_filter_audit,
    "op12_ranked_search": op12_ranked_search,
    "op13_best_fit_packing": op13_best_fit_packing,
}
