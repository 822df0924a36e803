"""The operators' queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from .decontam import op1_decontaminate
from .langid import op2_langid
from .mixing import op11_mix_sources
from .packing import op6_pack
from .phrases import SQL as PHRASES_SQL
from .phrases import op13_collocations
from .pii import op5_pii
from .quality import op3_quality
from .rules import op7_quality_rules
from .secrets import SQL as SECRETS_SQL
from .secrets import op10_secrets
from .simhash import op8_simhash
from .spelling import SQL as SPELLING_SQL
from .spelling import op12_spelling_variants
from .substrings import op4_substring_dedup
from .toxicity import op9_toxicity

QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_langid, op3_quality, op4_substring_dedup, op5_pii, op6_pack, op7_quality_rules,
    op8_simhash, op9_toxicity, op10_secrets, op11_mix_sources, op12_spelling_variants, op13_collocations)}

#: the others are models, walks and packings, tested against brute force, accuracy or round trips
SQL: dict[str, str] = {"op10_secrets": SECRETS_SQL, "op12_spelling_variants": SPELLING_SQL,
                       "op13_collocations": PHRASES_SQL}
