"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from raretide.llm import op3_decontamination, op5_mixing, op12_conversation_repair as op12, op13_lexical_search as op13
from raretide.llm.op1_fingerprints import op1_minhash_fingerprints
from raretide.llm.op2_toxicity import op2_toxicity
from raretide.llm.op3_decontamination import op3_benchmark_decontamination
from raretide.llm.op4_url_rules import op4_url_rules
from raretide.llm.op5_mixing import op5_source_mixing
from raretide.llm.op6_token_counts import op6_token_counts
from raretide.llm.op7_token_files import op7_token_files
from raretide.llm.op8_near_duplicates import op8_near_duplicates
from raretide.llm.op9_quality import op9_quality
from raretide.llm.op10_language import op10_language_id
from raretide.llm.op11_bpe_codec import op11_bpe_codec
from raretide.llm.op12_conversation_repair import op12_conversation_repair
from raretide.llm.op13_lexical_search import op13_lexical_search

QUERIES = {f.__name__: f for f in (
    op1_minhash_fingerprints, op2_toxicity, op3_benchmark_decontamination, op4_url_rules, op5_source_mixing,
    op6_token_counts, op7_token_files, op8_near_duplicates, op9_quality, op10_language_id,
    op11_bpe_codec, op12_conversation_repair, op13_lexical_search)}

SQL = {"op3_benchmark_decontamination": op3_decontamination.SQL, "op5_source_mixing": op5_mixing.SQL,
       "op12_conversation_repair": op12.SQL, "op13_lexical_search": op13.SQL}
