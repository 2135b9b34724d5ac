"""Clustering, islands, tiers and regions, on events and on layouts derived from tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirework.catalog.registry import query
from quirework.operators import layout
from quirework.plans.anchored import anchored_runs
from quirework.plans.ordered import id_bucket, micros, time_bucket
from quirework.session import materialize
from quirework.sources.tables import table

MINUTE = 60_000_000


@query(
    """WITH e AS (SELECT event_id, user_id, epoch_us(ts) AS a, epoch_us(ts) + CAST(round(value * 100) AS BIGINT) * 600000 AS b FROM events),
    r AS (SELECT *, max(b) OVER (PARTITION BY user_id ORDER BY a, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e),
    i AS (SELECT *, sum(CASE WHEN a <= reach + 27000000000 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY a, event_id ROWS UNBOUNDED PRECEDING) AS island FROM r)
    SELECT user_id, island::BIGINT AS island, min(a) AS first_at, max(b) AS last_end, count(*)::BIGINT AS events FROM i GROUP BY user_id, island"""
)
def gap_islands(spark, folder):
    """Stretches of a user's events: each lasts ``value`` minutes, 450 idle minutes end a
    stretch."""
    events = table(spark, folder, "events", "event_id", "ts", "user_id", "value")
    spans = events.select(
        "event_id", "user_id", micros("ts").alias("a"), (micros("ts") + F.round(F.col("value") * 100).cast("long") * 600_000).alias("b")
    )
    found = layout.islands(
        spans, ["user_id"], F.floor(F.col("a") / (1440 * MINUTE)).cast("long"), ["a", "event_id"], F.col("a"), F.col("b"), 450 * MINUTE
    )
    return found.groupBy("user_id", "island").agg(
        F.min("a").alias("first_at"), F.max("b").alias("last_end"), F.count(F.lit(1)).alias("events")
    )


@query(
    """WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    w AS (SELECT user_id, event_id, n, t AS anchor, 1::BIGINT AS run FROM e WHERE n = 1
      UNION ALL SELECT e.user_id, e.event_id, e.n, CASE WHEN e.t > w.anchor + 172800000000 THEN e.t ELSE w.anchor END,
        CASE WHEN e.t > w.anchor + 172800000000 THEN w.run + 1 ELSE w.run END
      FROM w JOIN e ON e.user_id = w.user_id AND e.n = w.n + 1)
    SELECT user_id, event_id, run FROM w"""
)
def anchored_sessions(spark, folder):
    """Sessions of a user's events that last two days from their first event."""
    events = table(spark, folder, "events", "event_id", "ts", "user_id").withColumn("t", micros("ts"))
    runs = anchored_runs(events, ["user_id"], time_bucket("ts", 5 * 86_400), ["t", "event_id"], F.col("t"), F.col("t"), 2 * 1440 * MINUTE)
    return runs.select("user_id", "event_id", "run")


@query(
    """WITH c AS (SELECT p_size, count(*) AS n, min(p_partkey) AS f FROM part GROUP BY p_size),
    b AS (SELECT p_size AS body FROM c ORDER BY n DESC, f LIMIT 1)
    SELECT p_size, n::BIGINT AS uses, 'h' || least(dense_rank() OVER (ORDER BY p_size DESC), 3) AS tier FROM c WHERE p_size > (SELECT body FROM b)"""
)
def heading_tiers(spark, folder):
    """Heading tiers from part sizes taken as font sizes."""
    return layout.heading_tiers(table(spark, folder, "part", "p_partkey", "p_size"), "p_size", "p_partkey")


@query(
    """WITH f AS (SELECT conv_id, turn, role <> 'user' AND length(text) >= 12 AS flag FROM conversations),
    l AS (SELECT *, lag(flag) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM f)
    SELECT conv_id, count(*) FILTER (flag AND NOT coalesce(before, false))::BIGINT AS blocks FROM l GROUP BY conv_id"""
)
def prose_islands(spark, folder):
    """Stretches of consecutive replies per conversation."""
    turns = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    flag = (F.col("role") != "user") & (F.length("text") >= 12)
    return layout.flag_islands(turns, ["conv_id"], id_bucket("turn", 10_000), ["turn"], flag, "blocks")


# A page layout derived from the lines: page = supplier, a line's quantity and price place
# its box.  Every seventh part key makes a caption.
_BOXES = """WITH b AS (SELECT l_suppkey AS page, l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS id, l_partkey % 7 = 0 AS cap,
      80.0 + (l_orderkey * 37 + l_partkey) % 640 AS top, 20.0 + l_quantity * 4 AS x0, 20.0 + l_quantity * 4 + 20 + l_linenumber * 15 AS x1,
      10.0 + l_linenumber * 6 AS h, l_returnflag FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_partkey, l_linenumber, l_quantity, l_returnflag FROM lineitem)),
    o AS (SELECT page, id, cap, max(top) AS top, max(x0) AS x0, max(x1) AS x1, max(h) AS h FROM b GROUP BY ALL)"""


def _boxes(spark, folder):
    lines = table(spark, folder, "lineitem", "l_suppkey", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    boxes = lines.select(
        F.col("l_suppkey").alias("page"),
        (F.col("l_orderkey") * 1_000_000 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("id"),
        (F.col("l_partkey") % 7 == 0).alias("cap"),
        (F.lit(80.0) + (F.col("l_orderkey") * 37 + F.col("l_partkey")) % 640).alias("top"),
        (F.lit(20.0) + F.col("l_quantity") * 4).alias("x0"),
        (F.lit(40.0) + F.col("l_quantity") * 4 + F.col("l_linenumber") * 15).alias("x1"),
        (F.lit(10.0) + F.col("l_linenumber") * 6).alias("h"),
    )
    one = boxes.groupBy("page", "id", "cap").agg(
        F.max("top").alias("top"), F.max("x0").alias("x0"), F.max("x1").alias("x1"), F.max("h").alias("h")
    )
    return materialize(one)


@query(
    _BOXES
    + """, g AS (SELECT *, top + h AS bottom FROM o WHERE NOT cap),
    r AS (SELECT *, max(bottom) OVER (PARTITION BY page ORDER BY top, x0, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM g),
    i AS (SELECT *, sum(CASE WHEN top <= reach + 45 THEN 0 ELSE 1 END) OVER (PARTITION BY page ORDER BY top, x0, id ROWS UNBOUNDED PRECEDING) AS c FROM r)
    SELECT page, c::BIGINT AS cluster_no, min(x0) AS x0, min(top) AS top, max(x1) AS x1, max(bottom) AS bottom, count(*)::BIGINT AS objects FROM i GROUP BY page, c"""
)
def layout_clusters(spark, folder):
    """Vertical clusters of the boxes of each page."""
    boxes = _boxes(spark, folder).filter(~F.col("cap")).withColumn("bottom", F.col("top") + F.col("h"))
    return layout.cluster_objects(boxes, ["page"], "id")


@query(
    _BOXES
    + """, c AS (SELECT page, id AS caption_id, top, top + 12 AS bottom, coalesce(lag(top + 12) OVER (PARTITION BY page ORDER BY top, id), 70.0) AS lower FROM o WHERE cap),
    d AS (SELECT page, x0, x1, top, top + h AS bottom FROM o WHERE NOT cap AND x1 - x0 >= 24 AND h >= 16 AND top >= 65),
    m AS (SELECT c.page, caption_id, c.top AS ct, min(d.x0) AS a, min(d.top) AS b, max(d.x1) AS e, max(d.bottom) AS f FROM c JOIN d ON d.page = c.page
      AND d.top >= c.lower - 10 AND d.bottom <= c.top + 3 GROUP BY ALL),
    x AS (SELECT page, caption_id, greatest(45, a - 18) AS x0, greatest(75, b - 22) AS y0, least(612, e + 18) AS x1, least(ct - 4, f + 18) AS y1 FROM m)
    SELECT page, caption_id, round_even(x0, 1) AS x0, round_even(y0, 1) AS y0, round_even(x1, 1) AS x1, round_even(y1, 1) AS y1 FROM x WHERE y1 > y0 + 40"""
)
def layout_regions(spark, folder):
    """Figure regions above the captions of each page."""
    boxes = _boxes(spark, folder).withColumn("bottom", F.col("top") + F.when(F.col("cap"), F.lit(12.0)).otherwise(F.col("h")))
    captions = boxes.filter("cap").select(
        "page", F.col("id").alias("caption_id"), "top", "bottom", F.concat(F.lit("Figure "), F.col("id").cast("string")).alias("text")
    )
    drawings = boxes.filter("NOT cap").select("page", F.col("id").alias("drawing_id"), "x0", "x1", "top", "bottom")
    return layout.figure_regions(captions, drawings, ["page"]).select("page", "caption_id", "x0", "y0", "x1", "y1")


@query(
    _BOXES
    + """, c AS (SELECT page, id AS caption_id, top, coalesce(max(top + 12) OVER (PARTITION BY page ORDER BY top, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS prev FROM o WHERE cap),
    d AS (SELECT c.page, c.caption_id, d.id, d.x0, d.x1, d.top, d.top + d.h AS bottom FROM c JOIN o d ON d.page = c.page AND NOT d.cap AND d.top >= greatest(110, prev + 2) AND d.top + d.h <= c.top + 4),
    r AS (SELECT *, max(bottom) OVER (PARTITION BY page, caption_id ORDER BY top, x0, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM d),
    i AS (SELECT *, sum(CASE WHEN top <= reach + 45 THEN 0 ELSE 1 END) OVER (PARTITION BY page, caption_id ORDER BY top, x0, id ROWS UNBOUNDED PRECEDING) AS k FROM r),
    g AS (SELECT page, caption_id, k, min(x0) AS x0, min(top) AS top, max(x1) AS x1, max(bottom) AS bottom, count(*) AS n FROM i GROUP BY ALL),
    s AS (SELECT *, row_number() OVER (PARTITION BY page, caption_id ORDER BY bottom DESC, k) AS pick FROM g WHERE x1 - x0 >= 80 AND bottom - top >= 30 AND n >= 2),
    z AS (SELECT c.page, c.caption_id, s.x0 IS NOT NULL AS found,
        CASE WHEN s.x0 IS NULL THEN 20.0 ELSE greatest(0, s.x0 - 50) END AS x0, CASE WHEN s.x0 IS NULL THEN greatest(60, prev + 4, c.top - 260) ELSE greatest(0, s.top - 25) END AS y0,
        CASE WHEN s.x0 IS NULL THEN 592.0 ELSE least(612, s.x1 + 35) END AS x1, CASE WHEN s.x0 IS NULL THEN least(792, c.top - 6) ELSE least(792, c.top - 6, s.bottom + 50) END AS y1
      FROM c LEFT JOIN s ON s.page = c.page AND s.caption_id = c.caption_id AND s.pick = 1)
    SELECT page, caption_id, round_even(x0, 2) AS x0, round_even(y0, 2) AS y0, round_even(x1, 2) AS x1, round_even(y1, 2) AS y1 FROM z WHERE y1 - y0 >= 40 AND (NOT found OR x1 - x0 >= 80)"""
)
def layout_crop_boxes(spark, folder):
    """Crop box above each caption, from the lowest useful cluster or a fixed band."""
    boxes = _boxes(spark, folder).withColumn("bottom", F.col("top") + F.when(F.col("cap"), F.lit(12.0)).otherwise(F.col("h")))
    captions = boxes.filter("cap").select("page", F.col("id").alias("caption_id"), "top", "bottom")
    objects = boxes.filter("NOT cap").select("page", F.col("id").alias("object_id"), "x0", "x1", "top", "bottom")
    return layout.crop_boxes(captions, objects, ["page"], 612.0, 792.0)


@query(
    """WITH RECURSIVE w AS (SELECT o_custkey // 20 AS page, o_orderkey AS id, 60000 + (o_orderkey * 7919) % 640000 AS top, 20000 + (o_orderkey * 104729) % 500000 AS x0 FROM orders),
    n AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY top, x0, id) AS n FROM w),
    r AS (SELECT page, id, n, top AS anchor, 1::BIGINT AS line_no FROM n WHERE n = 1
      UNION ALL SELECT n.page, n.id, n.n, CASE WHEN n.top > r.anchor + 3000 THEN n.top ELSE r.anchor END, CASE WHEN n.top > r.anchor + 3000 THEN r.line_no + 1 ELSE r.line_no END
      FROM r JOIN n ON n.page = r.page AND n.n = r.n + 1)
    SELECT n.page, r.line_no, min(n.top) / 1000 AS top, min(n.x0) / 1000 AS x0, string_agg('w' || n.id, ' ' ORDER BY n.top, n.x0, n.id) AS text FROM n JOIN r ON r.page = n.page AND r.id = n.id GROUP BY n.page, r.line_no"""
)
def layout_lines(spark, folder):
    """Words placed from order keys grouped into the lines of a page per twenty customers."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey")
    key = F.col("o_orderkey")
    words = orders.select(
        F.floor(F.col("o_custkey") / 20).alias("page"),
        key.alias("id"),
        ((60_000 + (key * 7919) % 640_000) / 1000).alias("top"),
        ((20_000 + (key * 104_729) % 500_000) / 1000).alias("x0"),
        F.concat(F.lit("w"), key.cast("string")).alias("text"),
    ).withColumn("bottom", F.col("top") + 10).withColumn("x1", F.col("x0") + 30)
    return layout.group_lines(words, ["page"], "id").select("page", "line_no", "top", "x0", "text")


@query(
    """WITH b AS (SELECT user_id AS page, event_id, event_type, (event_id * 13) % 300 AS y0, CASE WHEN event_type = 'click' THEN '12 Running header' WHEN event_type = 'view' AND event_id % 3 = 0 THEN event_id % 900 || ''
        WHEN event_type = 'error' THEN '> x <- ' || event_id ELSE 'Text ' || event_id END AS text FROM events),
    k AS (SELECT * FROM b WHERE NOT (regexp_matches(text, '^[0-9]{1,4}$') OR (y0 <= 78 AND regexp_matches(text, '^[0-9]+ [^ ].+$'))))
    SELECT event_id, 'p' || page || '_t' || (row_number() OVER (PARTITION BY page ORDER BY event_id) - 1) AS unit_id, event_type = 'error' AS is_listing FROM k"""
)
def layout_block_ids(spark, folder):
    """Ids of the text blocks that survive the header filter; listings take a number."""
    events = table(spark, folder, "events", "event_id", "user_id", "event_type")
    key, kind = F.col("event_id").cast("string"), F.col("event_type")
    text = (
        F.when(kind == "click", F.lit("12 Running header"))
        .when((kind == "view") & (F.col("event_id") % 3 == 0), (F.col("event_id") % 900).cast("string"))
        .when(kind == "error", F.concat(F.lit("> x <- "), key))
        .otherwise(F.concat(F.lit("Text "), key))
    )
    blocks = events.select(
        F.col("user_id").alias("page"), "event_id", F.lit("text").alias("type"), ((F.col("event_id") * 13) % 300).alias("y0"), text.alias("text")
    )
    ids = layout.text_block_ids(blocks, ["page"], "event_id", "page")
    return ids.select("event_id", "unit_id", "is_listing")
