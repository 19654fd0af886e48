"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from changefold.llm.centroids import OP13_SQL, op13_centroid_clusters
from changefold.llm.decontamination import op9_decontamination
from changefold.llm.divergence import OP11_SQL, op11_source_divergence
from changefold.llm.language import op10_language_id
from changefold.llm.language_model import op8_lm_scores
from changefold.llm.license import OP6_SQL, op6_license_scans
from changefold.llm.ngram_join import op2_ngram_jaccard_join
from changefold.llm.packing import op4_best_fit_packing
from changefold.llm.pii import op3_pii_spans
from changefold.llm.quality import OP7_SQL, op7_quality_rules
from changefold.llm.substring import op5_substring_dedup
from changefold.llm.url_rules import OP12_SQL, op12_url_filters
from changefold.llm.warc import OP1_SQL, op1_warc_revisits

QUERIES = {
    "op1_warc_revisits": op1_warc_revisits,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_pii_spans": op3_pii_spans,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_license_scans": op6_license_scans,
    "op7_quality_rules": op7_quality_rules,
    "op8_lm_scores": op8_lm_scores,
    "op9_decontamination": op9_decontamination,
    "op10_language_id": op10_language_id,
    "op11_source_divergence": op11_source_divergence,
    "op12_url_filters": op12_url_filters,
    "op13_centroid_clusters": op13_centroid_clusters,
}
ORACLE = {
    "op1_warc_revisits": OP1_SQL,
    "op6_license_scans": OP6_SQL,
    "op7_quality_rules": OP7_SQL,
    "op11_source_divergence": OP11_SQL,
    "op12_url_filters": OP12_SQL,
    "op13_centroid_clusters": OP13_SQL,
}
