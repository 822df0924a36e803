"""Column helpers: built-in Spark expressions only (JVM side, codegen)."""

from cardwatch.functions.timefn import (  # noqa: F401
    cut_ts, date_plus_seconds, epoch_seconds, seconds_between, sentinel_ts, day_start,
)
from cardwatch.functions.text import (  # noqa: F401
    fio, parse_amount, date_from_file_name, feed_of_file_name, date_text_before_blank,
)
