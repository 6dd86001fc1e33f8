"""Relations the library reads and writes."""

from pyspark.sql import types as T

# Daily price and dividend rows. `source_rank` orders copies of the same
# (ticker, date): the lowest rank wins.
TAPE = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("date", T.TimestampType()),
    T.StructField("adj_close", T.DoubleType()),
    T.StructField("dividends", T.DoubleType()),
    T.StructField("source_rank", T.LongType()),
])

# One row per symbol and collection run.
SNAPSHOT = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("security", T.StringType()),
    T.StructField("gics_sector", T.StringType()),
    T.StructField("gics_sub_industry", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
])

WORKLIST = T.StructType([
    T.StructField("New_Tickers", T.ArrayType(T.StringType())),
    T.StructField("Old_Tickers", T.ArrayType(T.StringType())),
])

PRICE_POINT = T.StructType([
    T.StructField("date", T.TimestampType()),
    T.StructField("adj close", T.DoubleType()),
])

DIVIDEND_POINT = T.StructType([
    T.StructField("date", T.TimestampType()),
    T.StructField("dividends", T.DoubleType()),
])

# Field names of the published document are part of its contract.
COMPANY = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("consecutiveGrowthYears", T.IntegerType()),
    T.StructField("dividendFrequency", T.LongType()),
    T.StructField("beta", T.DoubleType()),
    T.StructField("fiveYearCAGR", T.DoubleType()),
    T.StructField("lastDividend", T.DoubleType()),
    T.StructField("lastPrice", T.DoubleType()),
    T.StructField("priceHistory", T.ArrayType(PRICE_POINT)),
    T.StructField("dividendHistory", T.ArrayType(DIVIDEND_POINT)),
])

BENCHMARK = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("rate", T.DoubleType()),
])

DOCUMENT = T.StructType([
    T.StructField("companies", T.ArrayType(COMPANY)),
    T.StructField("benchmarks", T.ArrayType(BENCHMARK)),
    T.StructField("lastUpdated", T.TimestampType()),
])
