"""The opN_ queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from .decontamination import OP11_SQL, op11_decontamination
from .divergence import OP13_SQL, op13_divergence
from .exact_dedup import OP2_SQL, op2_exact_dedup
from .line_dedup import OP3_SQL, op3_line_dedup
from .mixing import OP5_SQL, op5_mixing
from .near_dedup import OP8_SQL, op8_minhash_dedup
from .neighbours import OP6_SQL, op6_neighbours
from .packing import op9_packing
from .prefix_trie import OP12_SQL, op12_prefix_trie
from .quality import op10_quality
from .token_output import op4_token_output
from .toxicity import op1_toxicity
from .warc import op7_warc

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_token_output": op4_token_output,
    "op5_mixing": op5_mixing,
    "op6_neighbours": op6_neighbours,
    "op7_warc": op7_warc,
    "op8_minhash_dedup": op8_minhash_dedup,
    "op9_packing": op9_packing,
    "op10_quality": op10_quality,
    "op11_decontamination": op11_decontamination,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_divergence": op13_divergence,
}

ORACLE_SQL = {
    "op2_exact_dedup": OP2_SQL,
    "op3_line_dedup": OP3_SQL,
    "op5_mixing": OP5_SQL,
    "op6_neighbours": OP6_SQL,
    "op8_minhash_dedup": OP8_SQL,
    "op11_decontamination": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_divergence": OP13_SQL,
}
