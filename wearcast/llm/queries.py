"""Registered queries of the corpus operators and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from .collocations import OP11_SQL, op11_collocations
from .decontamination import OP4_SQL, op4_decontamination
from .jaccard_join import op3_ngram_jaccard
from .language_id import op7_language_id
from .merkle import OP12_SQL, op12_merkle_manifest
from .packing import op2_best_fit_packing
from .pii import op5_pii
from .quality_classifier import op10_quality_classifier
from .quality_rules import op1_quality_rules
from .simhash_join import op13_simhash_neardup
from .token_files import op6_token_output
from .url_filters import op8_url_filters
from .warc import op9_warc

QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_best_fit_packing, op3_ngram_jaccard, op4_decontamination, op5_pii, op6_token_output, op7_language_id, op8_url_filters, op9_warc, op10_quality_classifier,
                                  op11_collocations, op12_merkle_manifest, op13_simhash_neardup)}
ORACLE_SQL: dict[str, str] = {"op4_decontamination": OP4_SQL, "op11_collocations": OP11_SQL, "op12_merkle_manifest": OP12_SQL}
