"""cardwatch: a Spark-native card-fraud warehouse.

Daily feeds (transactions, passport blacklist, terminal snapshots) land in
Parquet tables; a versioned (SCD type 2) terminal history is kept; four fraud
rules raise alerts that accumulate into an exportable report, with load audit
counts per feed and day. Every building block is a DataFrame transformation,
so the same code runs over one batch, over all days at once, or inside a
Structured Streaming ``foreachBatch``.
"""

from cardwatch.config import Semantics, RuleConfig  # noqa: F401
from cardwatch.session import get_session, checkpoint_dir  # noqa: F401
