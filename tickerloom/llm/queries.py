"""The queries of this subpackage and, where SQL can express them on whole tables, the SQL."""

from __future__ import annotations

from tickerloom.llm import sql
from tickerloom.llm.decontaminate import op3_decontaminate
from tickerloom.llm.filter_audit import op13_filter_audit
from tickerloom.llm.language_id import op7_language_id
from tickerloom.llm.lm_score import op5_lm_score
from tickerloom.llm.media import op8_media
from tickerloom.llm.order_minhash import op12_order_minhash
from tickerloom.llm.packing import op6_packing
from tickerloom.llm.periodic_runs import op11_periodic_runs
from tickerloom.llm.quality import op4_quality
from tickerloom.llm.secret_scan import op1_secret_scan
from tickerloom.llm.simhash_dedup import op2_simhash_dedup
from tickerloom.llm.substring_dedup import op9_substring_dedup
from tickerloom.llm.token_counts import op10_token_counts

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality": op4_quality,
    "op5_lm_score": op5_lm_score,
    "op6_packing": op6_packing,
    "op7_language_id": op7_language_id,
    "op8_media": op8_media,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_order_minhash": op12_order_minhash,
    "op13_filter_audit": op13_filter_audit,
}

#: The others hash with XXH64, learn models, tokenize or transform samples, which SQL can't express.
ORACLE_SQL: dict[str, str] = {
    "op3_decontaminate": sql.DECONTAMINATE,
    "op9_substring_dedup": sql.SUBSTRING_DEDUP,
    "op13_filter_audit": sql.FILTER_AUDIT,
}
