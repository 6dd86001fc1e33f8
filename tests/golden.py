"""Hand-written tape and snapshots with values worked out independently."""

from datetime import datetime

from pyspark.sql import functions as F

from tickerloom.settings import AnalysisSettings

SETTINGS = AnalysisSettings(as_of=datetime(2024, 7, 1))

TAPE_CSV = """\
^GSPC,2019-07-02,2950.0,0.0
^GSPC,2019-07-05,3000.0,0.0
^GSPC,2020-06-15,3060.0,0.0
^GSPC,2021-06-15,4200.0,0.0
^GSPC,2022-06-15,3800.0,0.0
^GSPC,2023-06-15,4400.0,0.0
^GSPC,2024-06-03,5280.0,0.0
^GSPC,2024-06-14,5430.0,0.0
^GSPC,2024-06-28,5460.0,0.0
^TNX,2019-07-05,2.0,0.0
^TNX,2024-06-28,4.3,0.0
AAA,2016-06-15,50.0,1.0
AAA,2017-06-15,55.0,1.05
AAA,2018-06-15,60.0,1.1
AAA,2019-06-15,65.0,1.2
AAA,2020-06-15,70.0,1.3
AAA,2021-06-15,75.0,1.4
AAA,2022-06-15,80.0,1.5
AAA,2023-06-15,85.0,1.65
AAA,2019-07-05,66.0,0.0
AAA,2024-06-03,90.0,0.0
AAA,2024-06-14,92.0,0.45
AAA,2024-06-28,91.0,0.0
BBB,2018-06-15,20.0,0.5
BBB,2019-06-15,21.0,0.6
BBB,2020-06-15,22.0,0.7
BBB,2021-06-15,23.0,0.8
BBB,2022-06-15,24.0,0.9
BBB,2023-03-15,24.5,0.5
BBB,2023-06-15,25.0,0.5
BBB,2024-06-03,27.0,0.0
BBB,2024-06-28,26.0,0.0
CCC,2016-06-15,30.0,1.0
CCC,2017-06-15,30.0,1.1
CCC,2018-06-15,30.0,1.2
CCC,2019-06-15,30.0,1.3
CCC,2020-06-15,30.0,1.4
CCC,2021-06-15,30.0,1.5
CCC,2022-06-15,30.0,1.0
CCC,2023-06-15,30.0,1.2
CCC,2024-06-28,30.0,0.0
EEE,2022-06-15,10.0,0.0
EEE,2023-06-15,12.0,0.0
EEE,2024-06-03,15.0,0.0
EEE,2024-06-28,14.0,0.0
AAA,2024-06-28,91.0,0.0
"""


def tape_rows():
    rows = (line.split(",") for line in TAPE_CSV.splitlines())
    return [(t, datetime.fromisoformat(d), float(p), float(v)) for t, d, p, v in rows]


def raw_tape(spark, rows=None):
    return spark.createDataFrame(
        tape_rows() if rows is None else rows,
        "ticker string, date timestamp, adj_close double, dividends double",
    )


SNAPSHOT_MEMBERS = {
    "2024-06-27 00:00:00": ["AAA", "BBB", "CCC", "^TNX", "^GSPC"],
    "2024-06-28 00:00:00": ["AAA", "BBB", "CCC", "EEE", "^TNX", "^GSPC"],
    "2024-07-01 00:00:00": ["AAA", "BBB", "EEE", "FFF", "^TNX", "^GSPC"],
}


def snapshots(spark, runs=3):
    times = list(SNAPSHOT_MEMBERS)[:runs] if runs else []
    rows = [
        (s, f"{s} at {t[:10]}", f"sector {s}", f"industry {s}", t)
        for t in times
        for s in SNAPSHOT_MEMBERS[t]
    ]
    return spark.createDataFrame(
        rows,
        "symbol string, security string, gics_sector string, gics_sub_industry string, t string",
    ).select("*", F.col("t").cast("timestamp").alias("updated_at")).drop("t")


def companies(spark):
    return spark.createDataFrame(
        [(t, f"{t} Inc", "s", "i") for t in ("AAA", "BBB", "CCC", "EEE")],
        "ticker string, name string, sector string, industry string",
    )


def by_ticker(df, *names):
    return {r["ticker"]: tuple(r[n] for n in names) if len(names) > 1 else r[names[0]]
            for r in df.collect()}
