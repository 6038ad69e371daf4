"""The queries of this subpackage by name."""

from __future__ import annotations

from podium.llm.conversations import PREFIX_TRIE_SQL, op13_prefix_trie
from podium.llm.decontaminate import op8_benchmark_decontamination
from podium.llm.html_text import op5_html_extraction
from podium.llm.licenses import op2_license_scan
from podium.llm.mixing import op12_source_mixing
from podium.llm.mtree import op6_mtree_top_k
from podium.llm.packing import op4_packing
from podium.llm.quality import op10_quality_classifier
from podium.llm.runs import op11_periodic_runs
from podium.llm.secrets import op1_secret_scan
from podium.llm.simhash import op7_simhash_near_dedup
from podium.llm.simple8b import op9_token_id_output
from podium.llm.token_counts import op3_token_counts

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_license_scan": op2_license_scan,
    "op3_token_counts": op3_token_counts,
    "op4_packing": op4_packing,
    "op5_html_extraction": op5_html_extraction,
    "op6_mtree_top_k": op6_mtree_top_k,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_token_id_output": op9_token_id_output,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_source_mixing": op12_source_mixing,
    "op13_prefix_trie": op13_prefix_trie,
}
#: The others have no form that DuckDB runs on whole tables: they train models, call tokenizers, walk
#: metric and bit trees or draw by Spark's hashes.  Each is tested against brute force.
ORACLES: dict[str, str] = {"op13_prefix_trie": PREFIX_TRIE_SQL}
