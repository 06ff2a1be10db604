"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from buyerlens.llm.centroids import OP11_SQL, op11_centroid_clustering
from buyerlens.llm.chat_format import OP8_SQL, op8_chat_format
from buyerlens.llm.decontaminate import op4_decontaminate
from buyerlens.llm.exact_dedup import OP9_SQL, op9_exact_dedup
from buyerlens.llm.lm_score import op7_lm_score
from buyerlens.llm.ngram_join import op1_ngram_jaccard_join
from buyerlens.llm.packing import op3_packing
from buyerlens.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from buyerlens.llm.quality import op6_quality_classifier
from buyerlens.llm.secrets import op10_secret_scan
from buyerlens.llm.substring_dedup import op5_substring_dedup
from buyerlens.llm.suffix_dedup import op12_suffix_dedup
from buyerlens.llm.url_filter import OP2_SQL, op2_url_filter

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_url_filter": op2_url_filter,
    "op3_packing": op3_packing,
    "op4_decontaminate": op4_decontaminate,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_lm_score": op7_lm_score,
    "op8_chat_format": op8_chat_format,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES = {
    "op2_url_filter": OP2_SQL,
    "op8_chat_format": OP8_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op11_centroid_clustering": OP11_SQL,
    "op13_prefix_trie": OP13_SQL,
}
