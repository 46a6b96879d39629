"""Queries and DuckDB SQL of this subpackage."""

from __future__ import annotations

from kilnspark.llm.decontaminate import op5_decontaminate
from kilnspark.llm.licenses import op10_license_scan
from kilnspark.llm.line_rules import OP8_SQL, op2_quality, op8_line_dedup
from kilnspark.llm.lm_score import op3_lattice_score
from kilnspark.llm.near_dup import op1_near_dup
from kilnspark.llm.packing import op9_pack
from kilnspark.llm.pii import op6_pii
from kilnspark.llm.prefix_trie import OP12_SQL, op12_prefix_trie
from kilnspark.llm.suffix_dedup import op4_suffix_dedup
from kilnspark.llm.token_counts import op7_token_counts
from kilnspark.llm.turn_repair import OP13_SQL, op13_turn_repair
from kilnspark.llm.vantage_tree import OP11_SQL, op11_nearest

QUERIES = {
    "op1_near_dup": op1_near_dup,
    "op2_quality": op2_quality,
    "op3_lattice_score": op3_lattice_score,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_pii": op6_pii,
    "op7_token_counts": op7_token_counts,
    "op8_line_dedup": op8_line_dedup,
    "op9_pack": op9_pack,
    "op10_license_scan": op10_license_scan,
    "op11_nearest": op11_nearest,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_turn_repair": op13_turn_repair,
}
ORACLES = {"op8_line_dedup": OP8_SQL, "op11_nearest": OP11_SQL, "op12_prefix_trie": OP12_SQL, "op13_turn_repair": OP13_SQL}
