"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from .language import op10_language
from .lm import op1_lm
from .neardup import op9_neardup
from .packing import op4_packing
from .pieces import op5_pieces
from .secrets import op8_secrets
from .sharding import op6_sharding
from .slack import op12_slack
from .spelling import op13_spelling
from .substrings import op7_substrings
from .trie import op11_trie
from .vectors import OP3_SQL, op2_neighbours, op3_topk


def pipeline(spark, sf_dir: str):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    ops = (op1_lm, op2_neighbours, op3_topk, op4_packing, op5_pieces, op6_sharding, op7_substrings, op8_secrets, op9_neardup, op10_language, op11_trie, op12_slack, op13_spelling, pipeline)
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return {"op3_topk": OP3_SQL}
