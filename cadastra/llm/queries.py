"""Queries of the training-data operators, and the SQL that they are checked against."""

from __future__ import annotations

from .decontamination import op8_decontamination
from .language_id import op2_language_id
from .mixing import op4_mixing
from .negatives import OP12_SQL, op12_negatives
from .ngram_join import op6_ngram_join
from .packing import op11_packing
from .quality_model import op7_quality_model
from .quality_rules import OP5_SQL, op5_quality_rules
from .secret_scan import OP3_SQL, op3_secret_scan
from .substring_dedup import op10_substring_dedup
from .suffix_dedup import op9_suffix_dedup
from .url_filter import OP1_SQL, op1_url_filter
from .whitening import op13_whitening

QUERIES = {f.__name__: f for f in (op1_url_filter, op2_language_id, op3_secret_scan, op4_mixing, op5_quality_rules, op6_ngram_join, op7_quality_model, op8_decontamination, op9_suffix_dedup, op10_substring_dedup, op11_packing, op12_negatives, op13_whitening)}
ORACLE_SQL = {"op1_url_filter": OP1_SQL, "op3_secret_scan": OP3_SQL, "op5_quality_rules": OP5_SQL, "op12_negatives": OP12_SQL}
