"""The registered queries of this package and the SQL of those that SQL can express."""

import corpus_pipeline
from sheafline.llm import (
    alignment,
    conversations,
    decontamination,
    exact_dedup,
    fixity,
    packing,
    personal,
    quality,
    secret_links,
    set_join,
    toxicity,
    wavelet,
    windows_dedup,
)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_secrets": secret_links.op2_secrets,
    "op3_decontamination": decontamination.op3_decontamination,
    "op4_jaccard_join": set_join.op4_jaccard_join,
    "op5_fixity_audit": fixity.op5_fixity_audit,
    "op6_repeated_passages": windows_dedup.op6_repeated_passages,
    "op7_personal_data": personal.op7_personal_data,
    "op8_quality": quality.op8_quality,
    "op9_packing": packing.op9_packing,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_alignment": alignment.op11_alignment,
    "op12_wavelet_matrix": wavelet.op12_wavelet_matrix,
    "op13_conversation_repair": conversations.op13_conversation_repair,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op4_jaccard_join": set_join.OP4_SQL,
    "op5_fixity_audit": fixity.OP5_SQL,
    "op6_repeated_passages": windows_dedup.OP6_SQL,
    "op10_exact_dedup": exact_dedup.OP10_SQL,
}

if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
