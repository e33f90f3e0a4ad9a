"""Queries of this package: name -> callable, and the SQL of those that SQL can express."""

from trolley.llm.bpe import op3_byte_bpe
from trolley.llm.chat import op8_chat
from trolley.llm.divergence import SQL as DIVERGENCE_SQL, op13_source_divergence
from trolley.llm.exact_dedup import SQL as EXACT_SQL, op1_exact_dedup
from trolley.llm.language import op4_language
from trolley.llm.line_dedup import SQL as LINE_SQL, op10_line_dedup
from trolley.llm.near_dedup import op9_near_dedup
from trolley.llm.neighbours import op6_neighbours
from trolley.llm.packing import op2_packing
from trolley.llm.prefix_trie import SQL as TRIE_SQL, op12_prefix_trie
from trolley.llm.recurrent_lm import op5_recurrent_lm
from trolley.llm.secrets import op11_secret_scan
from trolley.llm.toxicity import op7_toxicity

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_packing": op2_packing,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_language": op4_language,
    "op5_recurrent_lm": op5_recurrent_lm,
    "op6_neighbours": op6_neighbours,
    "op7_toxicity": op7_toxicity,
    "op8_chat": op8_chat,
    "op9_near_dedup": op9_near_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_secret_scan": op11_secret_scan,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_source_divergence": op13_source_divergence,
}

ORACLES = {
    "op1_exact_dedup": EXACT_SQL,
    "op10_line_dedup": LINE_SQL,
    "op12_prefix_trie": TRIE_SQL,
    "op13_source_divergence": DIVERGENCE_SQL,
}
