"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import decontam, negatives
from .decontam import op5_decontaminate
from .langid import op7_langid_ranks
from .mixing import op6_mix_pivotal
from .negatives import op13_strassen_negatives
from .packing import op12_pack_cuts
from .pii import op9_pii
from .quality import op10_quality_vectors
from .repair import op11_repair_grammar
from .simhash import op2_simhash_pivots
from .spotsigs import op1_spotsigs
from .suffixes import op8_suffixes
from .urls import op4_url_models
from .wrappers import op3_wrappers

QUERIES = {f.__name__: f for f in (
    op1_spotsigs, op2_simhash_pivots, op3_wrappers, op4_url_models, op5_decontaminate, op6_mix_pivotal,
    op7_langid_ranks, op8_suffixes, op9_pii, op10_quality_vectors,
    op11_repair_grammar, op12_pack_cuts, op13_strassen_negatives)}
SQL: dict[str, str] = {"op5_decontaminate": decontam.SQL, "op13_strassen_negatives": negatives.SQL}
