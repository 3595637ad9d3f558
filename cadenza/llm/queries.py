"""The registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from .decontaminate import OP9_SQL, op9_decontamination
from .html_extract import op1_html_extraction
from .line_dedup import op7_line_dedup
from .nearest import OP6_SQL, op6_nearest_neighbours
from .pieces import op2_sentencepiece
from .simhash import op3_simhash
from .substring_dedup import OP4_SQL, op4_substring_dedup
from .token_store import op8_token_store
from .toxicity import op10_toxicity
from .url_filter import op5_url_filters

QUERIES = {
    f.__name__: f
    for f in (op1_html_extraction, op2_sentencepiece, op3_simhash, op4_substring_dedup, op5_url_filters, op6_nearest_neighbours, op7_line_dedup, op8_token_store, op9_decontamination, op10_toxicity)
}
ORACLE_SQL = {"op4_substring_dedup": OP4_SQL, "op6_nearest_neighbours": OP6_SQL, "op9_decontamination": OP9_SQL}
