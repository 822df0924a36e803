"""Write fixture feeds as the daily files the loader expects (test scaffolding, tiny data)."""

import os

from pyspark.sql import functions as F

from cardwatch.plans.context import Inputs

TX_HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal"


def write_feeds(spark, sf_dir, folder, last_day):
    x = Inputs(spark, sf_dir)
    t = 0

    def touch(path):
        nonlocal t
        t += 10
        os.utime(path, (1_700_000_000 + t, 1_700_000_000 + t))

    tx = x.tx.filter(F.col("file_date") <= F.lit(last_day)).toPandas()
    bl = x.bl_feed.filter(F.col("file_date") <= F.lit(last_day)).toPandas()
    sn = x.snap.filter(F.col("snap_date") <= F.lit(last_day)).toPandas()
    days = sorted(set(tx.file_date) | set(bl.file_date) | set(sn.snap_date))
    for d in days:
        tag = d.strftime("%d%m%Y")
        part = bl[bl.file_date == d]
        if len(part):
            p = os.path.join(folder, f"passport_blacklist_{tag}.csv")
            with open(p, "w") as f:
                f.write("date,passport\n")
                for r in part.itertuples():
                    f.write(f"{r.source_date},{r.passport_num}\n")
            touch(p)
        part = sn[sn.snap_date == d]
        if len(part):
            p = os.path.join(folder, f"terminals_{tag}.csv")
            part[["terminal_id", "terminal_type", "terminal_city", "terminal_address"]].to_csv(p, index=False)
            touch(p)
        part = tx[tx.file_date == d]
        if len(part):
            p = os.path.join(folder, f"transactions_{tag}.txt")
            with open(p, "w") as f:
                f.write(TX_HEADER + "\n")
                for r in part.itertuples():
                    amt = str(r.amt)
                    if int(r.trans_id) % 3 == 0:
                        amt = amt.replace(".", ",")
                    f.write(";".join([r.trans_id, r.transe_date.strftime("%Y-%m-%d %H:%M:%S"), amt, r.card_num,
                                      r.opertype, r.oper_result, r.terminal]) + "\n")
            touch(p)
    return days
