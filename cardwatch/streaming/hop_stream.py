"""Rule 3 on a stream: an operation in another city than the card's previous one, within the gap.

The one-hour lookback is an interval join of the stream with itself on the card, bounded by event time on both sides,
so the state holds the operations of one gap (plus the allowed lateness) and no more: whatever the watermark has passed
is dropped. Of all earlier operations within the gap the last one counts; it is found by an aggregation that closes when
the watermark passes the operation. Both steps emit in append mode, so every pair comes out once, however late its
rows came within the watermark, and in whichever micro-batch.

Terminal versions are joined as of the operation's day from the stored history (a static side). The result has the
rows of ``rules.city_hop_pair`` over the same operations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.config import DEFAULT, RuleConfig
from cardwatch.functions.timefn import seconds_between
from cardwatch.operators import rules
from cardwatch.operators.lookback import runs_covering


def city_hops(operations: DataFrame, hist: DataFrame, runs: DataFrame, cfg: RuleConfig = DEFAULT,
              late: str = "2 hours") -> DataFrame:
    """Streaming ``operations`` (fact columns) to the pairs of rule 3; ``late`` is how late a row may come.

    ``runs`` are the batch days whose lookback slices count (static). Event time is the operation's time; the
    watermark needs a zoned timestamp, so it is kept in one (UTC) beside the zone-less column.
    """
    w = operations.filter(F.col("opertype") == "WITHDRAW").select("trans_id", "card_num", "transe_date", "terminal")
    t = rules.with_terminal(w, hist, True)
    at = F.to_utc_timestamp(F.col("transe_date").cast("timestamp"), "UTC")
    t = t.select("trans_id", "card_num", "transe_date", "terminal_city", at.alias("at"))
    now = t.withWatermark("at", late)
    before = t.select(F.col("trans_id").alias("b_id"), F.col("card_num").alias("b_card"), F.col("at").alias("b_at"),
                      F.col("transe_date").alias("b_date"), F.col("terminal_city").alias("b_city")).withWatermark("b_at", late)
    gap = F.expr(f"INTERVAL {cfg.city_max_gap_s} SECONDS")
    earlier = F.struct("b_at", "b_id", "b_city") < F.struct("at", "trans_id", "terminal_city")
    j = now.join(before, (F.col("card_num") == F.col("b_card")) & (F.col("b_at") >= F.col("at") - gap)
                 & (F.col("b_at") <= F.col("at")) & earlier)
    # the last earlier operation; the window only carries the event time that closes the group
    g = j.groupBy(F.window("at", f"{cfg.city_max_gap_s} seconds"), "trans_id", "card_num", "transe_date", "terminal_city") \
        .agg(F.max(F.struct("b_at", "b_id", "b_city", "b_date")).alias("b"))
    x = g.select("card_num", "trans_id", "transe_date", "terminal_city", F.col("b.b_city").alias("prev_city"),
                 F.col("b.b_date").alias("prev_transe_date"))
    x = x.withColumn("gap_s", seconds_between("transe_date", "prev_transe_date"))
    x = x.filter((F.col("prev_city") != F.col("terminal_city")) & (F.col("gap_s") <= cfg.city_max_gap_s))
    x = runs_covering(x, runs, cfg.city_cut_s, "prev_transe_date", "transe_date")
    return x.select("run_date", "card_num", "trans_id", "transe_date", "terminal_city", "prev_city", "prev_transe_date",
                    "gap_s")
