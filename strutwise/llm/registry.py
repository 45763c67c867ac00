"""Queries of this subpackage, by name, and their SQL where SQL can say it."""

from __future__ import annotations

from strutwise.llm.chat import OP1_SQL, op1_chat_windows
from strutwise.llm.divergence import OP13_SQL, op13_divergence
from strutwise.llm.forest import OP5_SQL, op5_forest_join
from strutwise.llm.imatch import op6_imatch
from strutwise.llm.langid import op7_ecoc_language
from strutwise.llm.mih import OP2_SQL, op2_mih_top_k
from strutwise.llm.mixing import op3_cube_mix
from strutwise.llm.pieces import op9_pieces
from strutwise.llm.sharding import OP8_SQL, op8_feistel_shards
from strutwise.llm.substrings import OP10_SQL, op10_fm_repeats
from strutwise.llm.suffixes import OP11_SQL, op11_suffix_family
from strutwise.llm.tokenio import op4_huffman_ids
from strutwise.llm.tries import OP12_SQL, op12_prefix_trie

QUERIES = {
    "op1_chat_windows": op1_chat_windows,
    "op2_mih_top_k": op2_mih_top_k,
    "op3_cube_mix": op3_cube_mix,
    "op4_huffman_ids": op4_huffman_ids,
    "op5_forest_join": op5_forest_join,
    "op6_imatch": op6_imatch,
    "op7_ecoc_language": op7_ecoc_language,
    "op8_feistel_shards": op8_feistel_shards,
    "op9_pieces": op9_pieces,
    "op10_fm_repeats": op10_fm_repeats,
    "op11_suffix_family": op11_suffix_family,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_divergence": op13_divergence,
}

ORACLE_SQL: dict[str, str] = {
    "op1_chat_windows": OP1_SQL,
    "op2_mih_top_k": OP2_SQL,
    "op5_forest_join": OP5_SQL,
    "op8_feistel_shards": OP8_SQL,
    "op10_fm_repeats": OP10_SQL,
    "op11_suffix_family": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_divergence": OP13_SQL,
}
