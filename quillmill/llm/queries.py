"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from quillmill import shipped
from quillmill.llm.bpe import op7_bpe
from quillmill.llm.mixing import op1_mix
from quillmill.llm.language import op4_language
from quillmill.llm.near_dedup import OP9_SQL, op9_near_dedup
from quillmill.llm.neighbours import OP10_SQL, op10_neighbours
from quillmill.llm.repeats import op5_repeats
from quillmill.llm.secrets import op6_secrets
from quillmill.llm.tiff import op8_tiff
from quillmill.llm.token_codes import op3_token_codes
from quillmill.llm.toxicity import op2_toxicity

QUERIES = {
    "op1_mix": op1_mix,
    "op2_toxicity": op2_toxicity,
    "op3_token_codes": op3_token_codes,
    "op4_language": op4_language,
    "op5_repeats": op5_repeats,
    "op6_secrets": op6_secrets,
    "op7_bpe": op7_bpe,
    "op8_tiff": op8_tiff,
    "op9_near_dedup": op9_near_dedup,
    "op10_neighbours": op10_neighbours,
}

QUERIES = {n: shipped(f) for n, f in QUERIES.items()}

ORACLES: dict[str, str] = {"op9_near_dedup": OP9_SQL, "op10_neighbours": OP10_SQL}
