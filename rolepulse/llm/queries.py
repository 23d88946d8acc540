"""The registered queries of this subpackage, and their SQL where there is any."""

from __future__ import annotations

from rolepulse.llm.centroid_clustering import OP11_SQL, op11_centroid_clustering
from rolepulse.llm.decontamination import op3_benchmark_decontamination
from rolepulse.llm.embedding_dedup import OP12_SQL, op12_embedding_near_dedup
from rolepulse.llm.filter_audit import OP13_SQL, op13_filter_audit
from rolepulse.llm.html_text import op6_html_extraction
from rolepulse.llm.near_dedup import op5_minhash_near_dedup
from rolepulse.llm.packing import op2_packing
from rolepulse.llm.pii import op9_pii
from rolepulse.llm.quality_classifier import op7_quality_classifier
from rolepulse.llm.quality_rules import op1_quality_rules
from rolepulse.llm.substring_dedup import op10_substring_dedup
from rolepulse.llm.url_filters import op4_url_filters
from rolepulse.llm.warc import op8_warc

QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_packing, op3_benchmark_decontamination, op4_url_filters, op5_minhash_near_dedup, op6_html_extraction,
    op7_quality_classifier, op8_warc, op9_pii, op10_substring_dedup, op11_centroid_clustering,
    op12_embedding_near_dedup, op13_filter_audit)}
ORACLES: dict[str, str] = {"op11_centroid_clustering": OP11_SQL, "op12_embedding_near_dedup": OP12_SQL, "op13_filter_audit": OP13_SQL}
