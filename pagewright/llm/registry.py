"""The subpackage's queries, and the SQL for those that SQL can express on whole tables."""

from pagewright.llm.decontam import op5_decontamination
from pagewright.llm.exact_topk import OP10_SQL, op10_exact_topk
from pagewright.llm.license_scan import op4_license_scan
from pagewright.llm.line_dedup import op8_line_dedup
from pagewright.llm.near_dedup import op3_near_dedup
from pagewright.llm.packing import op2_packing
from pagewright.llm.pii import op1_pii
from pagewright.llm.secrets import op6_secrets
from pagewright.llm.token_counts import op9_token_counts
from pagewright.llm.toxicity import op7_toxicity

QUERIES = {f.__name__: f for f in (op1_pii, op2_packing, op3_near_dedup, op4_license_scan, op5_decontamination, op6_secrets, op7_toxicity, op8_line_dedup, op9_token_counts, op10_exact_topk)}
SQL = {"op10_exact_topk": OP10_SQL}
