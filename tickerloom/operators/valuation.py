"""Fair value by the capital asset pricing model and Gordon's constant growth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.numeric import ratio


def gordon_value(report: DataFrame, rates: DataFrame, market: str, risk_free: str) -> DataFrame:
    """Required return, next year's dividend and the price that they justify.

    k = rf + beta * (rm - rf), D1 = last dividend * payments * (1 + g),
    P = D1 / (k - g); no price unless k exceeds g.
    """
    market_rate = rates.filter(F.col("ticker") == market).select(F.max("rate")).scalar()
    risk_free_rate = rates.filter(F.col("ticker") == risk_free).select(F.max("rate")).scalar()
    growth = F.col("five_year_cagr")
    return (
        report.withColumns({"_market": market_rate, "_risk_free": risk_free_rate})
        .select(
            "ticker",
            growth,
            (F.col("_risk_free") + F.col("beta") * (F.col("_market") - F.col("_risk_free")))
            .alias("required_return"),
            (F.col("last_dividend") * F.col("dividend_frequency") * (1 + growth))
            .alias("next_dividend"),
        )
        .select(
            "ticker", "required_return", "next_dividend",
            F.when(
                F.col("required_return") > growth,
                ratio(F.col("next_dividend"), F.col("required_return") - growth),
            ).alias("fair_price"),
        )
    )
