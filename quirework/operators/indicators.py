"""Volume indicators and ratios, from their documented formulas.

Bars have (symbol, day, open, high, low, close, volume).  One row per symbol and day is a
pre-aggregated, date-bounded series, so a window per symbol stays small however many trades
made the bars.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _by_day():
    return Window.partitionBy("symbol").orderBy("day")


def _so_far():
    return _by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def bars(trades: DataFrame, symbol: str, ts: str, seq: str, price: str) -> DataFrame:
    """Daily bars; volume is the number of trades.  First and last price by (ts, seq)."""
    at = F.struct(ts, seq)
    return trades.groupBy(F.col(symbol).alias("symbol"), F.to_date(ts).alias("day")).agg(
        F.min_by(price, at).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, at).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )


def _prev(column: str) -> Column:
    return F.lag(column).over(_by_day())


def _change() -> Column:
    return F.try_divide(F.col("close") - _prev("close"), _prev("close"))


def obv(b: DataFrame) -> DataFrame:
    """On-balance volume: volume signed by the direction of the close, cumulated."""
    step = b.withColumn("__s", F.coalesce(F.signum(F.col("close") - _prev("close")).cast("long"), F.lit(0)) * F.col("volume"))
    return step.select("symbol", "day", F.sum("__s").over(_so_far()).alias("obv"))


def vpt(b: DataFrame) -> DataFrame:
    """Volume-price trend: volume times relative change of the close, cumulated."""
    step = b.withColumn("__s", F.coalesce(F.col("volume") * _change(), F.lit(0.0)))
    return step.select("symbol", "day", F.sum("__s").over(_so_far()).alias("vpt"))


def vwap(trades: DataFrame, keys: list[str], price: str, volume: str) -> DataFrame:
    return trades.groupBy(*keys).agg(F.try_divide(F.sum(F.col(price) * F.col(volume)), F.sum(volume)).alias("vwap"))


def volume_indexes(b: DataFrame) -> DataFrame:
    """Positive / negative volume index: change of the close summed over days with rising /
    falling volume."""
    up = F.when(F.col("volume") > _prev("volume"), _change())
    down = F.when(F.col("volume") < _prev("volume"), _change())
    step = b.withColumn("__u", F.coalesce(up, F.lit(0.0))).withColumn("__d", F.coalesce(down, F.lit(0.0)))
    return step.select("symbol", "day", F.sum("__u").over(_so_far()).alias("pvi"), F.sum("__d").over(_so_far()).alias("nvi"))


def wad(b: DataFrame) -> DataFrame:
    """Accumulation / distribution from the true range, cumulated."""
    prev = F.col("__p")
    step = b.withColumn("__p", _prev("close")).withColumn(
        "__s",
        F.when(F.col("close") > prev, F.col("close") - F.least(prev, F.col("low")))
        .when(F.col("close") < prev, F.col("close") - F.greatest(prev, F.col("high")))
        .otherwise(F.lit(0.0)),
    )
    return step.select("symbol", "day", F.sum("__s").over(_so_far()).alias("wad"))


def wvad(b: DataFrame) -> DataFrame:
    share = F.try_divide(F.col("close") - F.col("open"), F.col("high") - F.col("low"))
    return b.select("symbol", "day", (share * F.col("volume")).alias("wvad"))


def facilitation(b: DataFrame) -> DataFrame:
    return b.select("symbol", "day", F.try_divide(F.col("high") - F.col("low"), F.col("volume")).alias("mfi"))


def ease_of_movement(b: DataFrame) -> DataFrame:
    """Move of the midpoint over the box ratio (volume / range)."""
    mid = (F.col("high") + F.col("low")) / 2
    step = b.withColumn("__m", mid).withColumn("__box", F.try_divide(F.col("volume"), F.col("high") - F.col("low")))
    return step.select("symbol", "day", F.try_divide(F.col("__m") - F.lag("__m").over(_by_day()), F.col("__box")).alias("emv"))


def volume_norm(b: DataFrame, days: int = 20, bands: float = 2.0) -> DataFrame:
    """Volume relative to its moving average, with deviation bands and cumulated change."""
    frame = _by_day().rowsBetween(-(days - 1), Window.currentRow)
    mean, dev = F.avg("volume").over(frame), F.stddev_pop("volume").over(frame)
    return b.select(
        "symbol", "day",
        F.try_divide(F.col("volume") * 100.0, mean).alias("pct_volume"),
        (mean + dev * bands).alias("upper"),
        (mean - dev * bands).alias("lower"),
        (F.col("volume") - F.first("volume").over(_so_far())).alias("cum_change"),
    )


def tick_money_flow(trades: DataFrame, symbol: str, day: Column, order: str, price: str, volume: Column, bucket: Column) -> DataFrame:
    """Price times volume of upticks minus that of downticks, per symbol and day."""
    from quirework.plans.ordered import Previous, ordered_scan

    placed = trades.withColumn("__day", day).withColumn("__v", volume)
    prev = ordered_scan(placed, [symbol, "__day"], bucket, [order], Previous("__prev", F.col(price)))
    sign = F.signum(F.col(price) - F.col("__prev"))
    return prev.groupBy(F.col(symbol).alias("symbol"), F.col("__day").alias("day")).agg(
        F.sum(F.coalesce(sign * F.col(price) * F.col("__v"), F.lit(0.0))).alias("money_flow")
    )


def cap_weighted_volume(members: DataFrame) -> DataFrame:
    """Volume weighted by each member's share of the day's capitalisation (symbol, day,
    capital, volume), summed per day, split by the direction of the close."""
    weighed = F.col("capital") * F.col("volume")

    def part(value: Column) -> Column:
        return F.try_divide(F.sum(value), F.sum("capital"))

    return members.groupBy("day").agg(
        part(weighed).alias("weighted_volume"),
        part(F.when(F.col("direction") > 0, weighed).otherwise(F.lit(0.0))).alias("up_volume"),
        part(F.when(F.col("direction") < 0, weighed).otherwise(F.lit(0.0))).alias("down_volume"),
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator)


def statement_ratios(s: DataFrame) -> DataFrame:
    """Profitability and liquidity ratios of statement rows (revenue, net_income,
    interest_after_tax, assets, equity, current_assets,
    current_liabilities, inventory, liabilities, interest, tax)."""
    c = F.col
    return s.withColumns(
        {
            "roa": ratio(c("net_income") + c("interest_after_tax"), c("assets")),
            "margin": ratio(c("net_income") + c("interest_after_tax"), c("revenue")),
            "asset_turnover": ratio(c("revenue"), c("assets")),
            "roce": ratio(c("net_income"), c("equity")),
            "leverage": ratio(c("assets"), c("equity")),
            "current_ratio": ratio(c("current_assets"), c("current_liabilities")),
            "quick_ratio": ratio(c("current_assets") - c("inventory"), c("current_liabilities")),
            "liabilities_to_assets": ratio(c("liabilities"), c("assets")),
            "liabilities_to_equity": ratio(c("liabilities"), c("equity")),
            "interest_coverage": ratio(c("net_income") + c("interest") + c("tax"), c("interest")),
        }
    )
