"""Queries of these operators and the SQL that gives the same rows, where there is one."""

import corpus_pipeline
from cellsheaf.llm.op01_quality import op1_quality
from cellsheaf.llm.op02_warc import ORACLE as OP2_SQL
from cellsheaf.llm.op02_warc import op2_warc
from cellsheaf.llm.op03_toxicity import op3_toxicity
from cellsheaf.llm.op04_exact_dedup import ORACLE as OP4_SQL
from cellsheaf.llm.op04_exact_dedup import op4_exact_dedup
from cellsheaf.llm.op05_licence import op5_licence
from cellsheaf.llm.op06_near_dedup import op6_near_dedup
from cellsheaf.llm.op07_token_store import op7_token_store
from cellsheaf.llm.op08_pii import op8_pii
from cellsheaf.llm.op09_pack import op9_pack
from cellsheaf.llm.op10_decontaminate import op10_decontaminate
from cellsheaf.llm.op11_spelling import op11_spelling
from cellsheaf.llm.op12_embeddings import ORACLE as OP12_SQL
from cellsheaf.llm.op12_embeddings import op12_embeddings
from cellsheaf.llm.op13_divergence import ORACLE as OP13_SQL
from cellsheaf.llm.op13_divergence import op13_divergence

QUERIES = {
    "op1_quality": op1_quality,
    "op2_warc": op2_warc,
    "op3_toxicity": op3_toxicity,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_licence": op5_licence,
    "op6_near_dedup": op6_near_dedup,
    "op7_token_store": op7_token_store,
    "op8_pii": op8_pii,
    "op9_pack": op9_pack,
    "op10_decontaminate": op10_decontaminate,
    "op11_spelling": op11_spelling,
    "op12_embeddings": op12_embeddings,
    "op13_divergence": op13_divergence,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {"op2_warc": OP2_SQL, "op4_exact_dedup": OP4_SQL, "op12_embeddings": OP12_SQL, "op13_divergence": OP13_SQL}
