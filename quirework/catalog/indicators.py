"""Documented volume formulas on daily bars built from events (symbol = event type)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirework.catalog.registry import query
from quirework.operators import indicators as ind
from quirework.plans.ordered import id_bucket
from quirework.sources.tables import table

_BARS = """WITH b AS (SELECT event_type AS symbol, ts::DATE AS day, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
      arg_max(value, (ts, event_id)) AS close, count(*) AS volume FROM events GROUP BY ALL),
    p AS (SELECT *, lag(close) OVER w AS pc, lag(volume) OVER w AS pv, lag((high + low) / 2) OVER w AS pm FROM b WINDOW w AS (PARTITION BY symbol ORDER BY day))
    """
_KEY = "symbol, strftime(day, '%Y-%m-%d') AS day"
_RUN = "OVER (PARTITION BY symbol ORDER BY day ROWS UNBOUNDED PRECEDING)"


def _bars(spark, folder):
    return ind.bars(table(spark, folder, "events", "event_id", "ts", "event_type", "value"), "event_type", "ts", "event_id", "value")


def _shown(df, *columns, digits=6):
    """Day as text, values rounded where the order of a floating sum could show."""
    values = [F.round(c, digits).alias(c) if digits else F.col(c) for c in columns]
    return df.select("symbol", F.date_format("day", "yyyy-MM-dd").alias("day"), *values)


@query(_BARS + f"SELECT {_KEY}, (sum(CASE WHEN pc IS NULL THEN 0 ELSE sign(close - pc) * volume END) {_RUN})::BIGINT AS obv FROM p")
def ind_obv(spark, folder):
    return _shown(ind.obv(_bars(spark, folder)), "obv")


@query(_BARS + f"SELECT {_KEY}, round(sum(coalesce(volume * (close - pc) / pc, 0)) {_RUN}, 6) AS vpt FROM p")
def ind_vpt(spark, folder):
    return _shown(ind.vpt(_bars(spark, folder)), "vpt")


@query(
    """SELECT l_suppkey, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS vwap FROM lineitem GROUP BY l_suppkey"""
)
def ind_vwap(spark, folder):
    lines = table(spark, folder, "lineitem", "l_suppkey", "l_extendedprice", "l_quantity")
    return ind.vwap(lines, ["l_suppkey"], "l_extendedprice", "l_quantity").select("l_suppkey", F.round("vwap", 4).alias("vwap"))


@query(
    _BARS
    + f"""SELECT {_KEY}, round(sum(CASE WHEN volume > pv THEN (close - pc) / pc ELSE 0 END) {_RUN}, 6) AS pvi,
    round(sum(CASE WHEN volume < pv THEN (close - pc) / pc ELSE 0 END) {_RUN}, 6) AS nvi FROM p"""
)
def ind_pvi_nvi(spark, folder):
    return _shown(ind.volume_indexes(_bars(spark, folder)), "pvi", "nvi")


@query(
    _BARS
    + f"""SELECT {_KEY}, round(sum(CASE WHEN close > pc THEN close - least(pc, low) WHEN close < pc THEN close - greatest(pc, high) ELSE 0 END) {_RUN}, 6) AS wad FROM p"""
)
def ind_wad(spark, folder):
    return _shown(ind.wad(_bars(spark, folder)), "wad")


@query(_BARS + f"SELECT {_KEY}, CASE WHEN high <> low THEN (close - open) / (high - low) * volume END AS wvad FROM p")
def ind_wvad(spark, folder):
    return _shown(ind.wvad(_bars(spark, folder)), "wvad", digits=None)


@query(_BARS + f"SELECT {_KEY}, (high - low) / volume AS mfi FROM p")
def ind_mfi(spark, folder):
    return _shown(ind.facilitation(_bars(spark, folder)), "mfi", digits=None)


@query(_BARS + f"SELECT {_KEY}, CASE WHEN high <> low THEN ((high + low) / 2 - pm) / (volume / (high - low)) END AS emv FROM p")
def ind_emv(spark, folder):
    return _shown(ind.ease_of_movement(_bars(spark, folder)), "emv", digits=None)


@query(
    _BARS
    + f""", n AS (SELECT *, avg(volume) OVER f AS m, stddev_pop(volume) OVER f AS s, first_value(volume) OVER (PARTITION BY symbol ORDER BY day) AS v0 FROM p
      WINDOW f AS (PARTITION BY symbol ORDER BY day ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
    SELECT {_KEY}, round(volume * 100.0 / m, 6) AS pct_volume, round(m + 2 * s, 6) AS upper, round(m - 2 * s, 6) AS lower, volume - v0 AS cum_change FROM n"""
)
def ind_volume_norm(spark, folder):
    rows = ind.volume_norm(_bars(spark, folder))
    return _shown(rows, "pct_volume", "upper", "lower", "cum_change")


@query(
    """WITH t AS (SELECT event_type AS symbol, ts::DATE AS day, value, event_id % 100 + 1 AS v, lag(value) OVER (PARTITION BY event_type, ts::DATE ORDER BY event_id) AS pv FROM events)
    SELECT symbol, strftime(day, '%Y-%m-%d') AS day, round(sum(coalesce(sign(value - pv) * value * v, 0)), 4) AS money_flow FROM t GROUP BY symbol, day"""
)
def ind_money_flow(spark, folder):
    events = table(spark, folder, "events", "event_id", "ts", "event_type", "value")
    rows = ind.tick_money_flow(
        events, "event_type", F.to_date("ts"), "event_id", "value", F.col("event_id") % 100 + 1, id_bucket("event_id")
    )
    return rows.select("symbol", F.date_format("day", "yyyy-MM-dd").alias("day"), F.round("money_flow", 4).alias("money_flow"))


@query(
    """WITH m AS (SELECT o_orderdate::DATE AS day, o_totalprice AS capital, l_quantity AS volume, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN -1 ELSE 0 END AS direction
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
    s AS (SELECT *, capital / sum(capital) OVER (PARTITION BY day) * volume AS w FROM m)
    SELECT strftime(day, '%Y-%m-%d') AS day, round(sum(w), 6) AS weighted_volume, round(sum(CASE WHEN direction > 0 THEN w ELSE 0 END), 6) AS up_volume,
      round(sum(CASE WHEN direction < 0 THEN w ELSE 0 END), 6) AS down_volume FROM s GROUP BY day"""
)
def ind_cap_weight(spark, folder):
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_quantity", "l_returnflag")
    orders = table(spark, folder, "orders", "o_orderkey", "o_totalprice", "o_orderdate").withColumnRenamed("o_orderkey", "l_orderkey")
    members = lines.join(orders, "l_orderkey").select(
        F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("capital"), F.col("l_quantity").alias("volume"),
        F.when(F.col("l_returnflag") == "R", F.lit(1)).when(F.col("l_returnflag") == "A", F.lit(-1)).otherwise(F.lit(0)).alias("direction"),
    )
    rows = ind.cap_weighted_volume(members)
    return rows.select(F.date_format("day", "yyyy-MM-dd").alias("day"), *[F.round(c, 6).alias(c) for c in ("weighted_volume", "up_volume", "down_volume")])


@query(
    """WITH s AS (SELECT l_suppkey, sum(l_extendedprice) AS rev, sum(l_extendedprice * l_discount) AS ni, sum(l_quantity) * 1000 AS assets, sum(l_quantity) * 400 AS eq, sum(l_tax * l_extendedprice) AS tax,
      sum(l_quantity) * 300 AS ca, sum(l_quantity) * 120 AS inv, sum(l_quantity) * 600 AS debt, (sum(l_quantity) * 200 + sum(l_tax * l_extendedprice)) AS cl FROM lineitem GROUP BY 1)
    SELECT l_suppkey, round((ni + tax * 0.1) / assets, 6) AS roa, round((ni + tax * 0.1) / rev, 6) AS margin, round(rev / assets, 6) AS asset_turnover, round(ni / eq, 6) AS roce,
      round(assets / eq, 6) AS leverage, round(ca / cl, 6) AS current_ratio, round((ca - inv) / cl, 6) AS quick_ratio,
      round(debt / assets, 6) AS liabilities_to_assets, round(debt / eq, 6) AS liabilities_to_equity, round((ni + tax * 0.5 + tax) / (tax * 0.5), 6) AS interest_coverage FROM s"""
)
def ind_statement_ratios(spark, folder):
    lines = table(spark, folder, "lineitem", "l_suppkey", "l_extendedprice", "l_discount", "l_quantity", "l_tax")
    s = lines.groupBy("l_suppkey").agg(
        F.sum("l_extendedprice").alias("revenue"), F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("net_income"),
        (F.sum("l_quantity") * 1000).alias("assets"), (F.sum("l_quantity") * 400).alias("equity"), F.sum(F.col("l_tax") * F.col("l_extendedprice")).alias("tax"),
    )
    pieces = F.col("assets") / 1000
    s = s.withColumns(
        {"interest_after_tax": F.col("tax") * 0.1, "interest": F.col("tax") * 0.5, "current_assets": pieces * 300,
         "inventory": pieces * 120, "liabilities": pieces * 600, "current_liabilities": pieces * 200 + F.col("tax")}
    )
    names = (
        "roa", "margin", "asset_turnover", "roce", "leverage", "current_ratio", "quick_ratio", "liabilities_to_assets",
        "liabilities_to_equity", "interest_coverage",
    )
    return ind.statement_ratios(s).select("l_suppkey", *[F.round(c, 6).alias(c) for c in names])
