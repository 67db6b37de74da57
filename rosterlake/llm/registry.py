"""Queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from rosterlake.llm.archives import OP5_SQL, op5_warc_packages
from rosterlake.llm.collocations import OP13_SQL, op13_collocations
from rosterlake.llm.divergence import OP11_SQL, op11_source_divergence
from rosterlake.llm.fingerprints import op8_fingerprints
from rosterlake.llm.language_id import op2_language_id
from rosterlake.llm.licences import OP4_SQL, op4_license_scan
from rosterlake.llm.mixing import OP6_SQL, op6_source_mixing
from rosterlake.llm.near_duplicates import op10_near_duplicates
from rosterlake.llm.packing import op3_best_fit_packing
from rosterlake.llm.personal_data import op7_personal_data
from rosterlake.llm.quality import op9_quality_rules
from rosterlake.llm.sharding import OP12_SQL, op12_sharding
from rosterlake.llm.token_counts import op1_token_counts

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_language_id": op2_language_id,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_license_scan": op4_license_scan,
    "op5_warc_packages": op5_warc_packages,
    "op6_source_mixing": op6_source_mixing,
    "op7_personal_data": op7_personal_data,
    "op8_fingerprints": op8_fingerprints,
    "op9_quality_rules": op9_quality_rules,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_source_divergence": op11_source_divergence,
    "op12_sharding": op12_sharding,
    "op13_collocations": op13_collocations,
}
ORACLE: dict[str, str] = {
    "op4_license_scan": OP4_SQL,
    "op5_warc_packages": OP5_SQL,
    "op6_source_mixing": OP6_SQL,
    "op11_source_divergence": OP11_SQL,
    "op12_sharding": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
