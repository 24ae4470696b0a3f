"""Queries of this subpackage, by name.  None has an oracle: each is tested against brute force, a round trip or held-out rows."""

from __future__ import annotations

from .compaction import op11_compaction
from .dedup import op6_minhash_dedup
from .edits import op12_edit_fingerprints
from .language import op2_language_id
from .lm import op10_lm_scoring
from .media import op3_media_columns
from .mixing import op8_mixing
from .packing import op5_packing
from .quality import op4_quality_outliers
from .substrings import op9_suffix_dedup
from .tokencounts import op1_token_counts
from .toxicity import op7_toxicity
from .variants import op13_spelling_variants

QUERIES = {
    f.__name__: f
    for f in (op1_token_counts, op2_language_id, op3_media_columns, op4_quality_outliers, op5_packing, op6_minhash_dedup, op7_toxicity, op8_mixing, op9_suffix_dedup, op10_lm_scoring, op11_compaction, op12_edit_fingerprints, op13_spelling_variants)
}
ORACLE_SQL: dict[str, str] = {}
