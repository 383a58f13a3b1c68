"""The registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from millrace.llm import chat_trees, hamming_search, html_text, jaccard_join, language_id, licenses, mixing, packing, periodic_runs, quality_rules, secrets, turn_repair, url_filter

QUERIES = {
    "op1_html_extraction": (html_text.query, None),
    "op2_hamming_search": (hamming_search.query, hamming_search.SQL),
    "op3_packing": (packing.query, None),
    "op4_chat_trees": (chat_trees.query, chat_trees.SQL),
    "op5_license_scans": (licenses.query, None),
    "op6_ngram_jaccard_join": (jaccard_join.query, None),
    "op7_mixing": (mixing.query, mixing.SQL),
    "op8_language_id": (language_id.query, None),
    "op8_language_id_pages": (language_id.pages_query, None),
    "op9_quality_rules": (quality_rules.query, None),
    "op10_url_filter": (url_filter.query, None),
    "op11_secret_scans": (secrets.query, None),
    "op12_conversation_repair": (turn_repair.query, turn_repair.SQL),
    "op13_periodic_runs": (periodic_runs.query, None),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
