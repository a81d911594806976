"""The registered queries of the operators and of the pipeline, with their SQL."""

from __future__ import annotations

from .bpe_codec import op13_bpe_codec
from .chat_format import OP6_SQL, op6_chat_format
from .hard_negatives import OP11_SQL, op11_hard_negatives
from .line_dedup import OP2_SQL, op2_line_dedup
from .mixing import op5_mixing
from .neighbours import op9_nearest_neighbours
from .quality_classifier import op8_quality_classifier
from .quality_rules import OP1_SQL, op1_quality_rules
from .sentencepiece_codec import op3_sentencepiece
from .simhash import op10_simhash_near_dedup
from .source_audit import OP12_SQL, op12_source_divergence
from .substring_dedup import op7_substring_dedup
from .token_counts import op4_token_counts

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_line_dedup": op2_line_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_token_counts": op4_token_counts,
    "op5_mixing": op5_mixing,
    "op6_chat_format": op6_chat_format,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_source_divergence": op12_source_divergence,
    "op13_bpe_codec": op13_bpe_codec,
}

#: The other operators are tested against brute force, the tokenizers' libraries or held-out labels.
ORACLE_SQL = {"op1_quality_rules": OP1_SQL, "op2_line_dedup": OP2_SQL, "op6_chat_format": OP6_SQL,
              "op11_hard_negatives": OP11_SQL, "op12_source_divergence": OP12_SQL}
