import random

import pytest
from pyspark.sql import functions as F

from quirework.operators import layout
from quirework.plans import ordered

WORDS = "page int, id long, top double, bottom double, x0 double, x1 double, text string"


def test_lines_are_anchored_not_chained(spark):
    rows = [(1, i, t, t + 8, x, x + 5, w) for i, (t, x, w) in enumerate([(100.0, 1.0, "a"), (102.5, 20.0, "b"), (104.0, 40.0, "c"), (103.0, 9.0, "d")])]
    out = layout.group_lines(spark.createDataFrame(rows, WORDS), ["page"], "id").orderBy("line_no").collect()
    assert [(r.text, r.top, r.bottom, r.x0, r.x1) for r in out] == [("a b d", 100.0, 111.0, 1.0, 25.0), ("c", 104.0, 112.0, 40.0, 45.0)]


def test_clusters_follow_the_running_bottom(spark):
    boxes = [(1, 1, 100.0, 300.0, 0.0, 50.0), (1, 2, 110.0, 120.0, 60.0, 70.0), (1, 3, 344.0, 350.0, 0.0, 9.0), (1, 4, 396.0, 400.0, 0.0, 9.0)]
    df = spark.createDataFrame(boxes, "page int, id long, top double, bottom double, x0 double, x1 double")
    out = layout.cluster_objects(df, ["page"], "id").orderBy("cluster_no").collect()
    assert [(r.top, r.bottom, r.objects, r.x1) for r in out] == [(100.0, 350.0, 3, 70.0), (396.0, 400.0, 1, 9.0)]


@pytest.mark.parametrize("width", [2, 500])
def test_islands_match_a_walk(spark, width):
    rng = random.Random(width)
    rows, at = [], 0
    for i in range(200):
        at += rng.randint(0, 12)
        rows.append((i, at, at + rng.randint(0, 20)))
    df = spark.createDataFrame(rows, "i long, a long, b long").repartition(4)
    out = layout.islands(df, [], F.floor(F.col("a") / width), ["a", "i"], F.col("a"), F.col("b"), 5)
    island, reach, want = 0, None, {}
    for i, a, b in rows:
        if reach is None or a > reach + 5:
            island += 1
        reach = b if reach is None else max(reach, b)
        want[i] = island
    assert {r.i: r.island for r in out.collect()} == want


def walk_clusters(boxes, gap):
    """(first top, last bottom, objects) of each cluster of a page, by a walk in order."""
    found, reach = [], None
    for top, _, _, bottom in sorted(boxes, key=lambda b: (b[0] is not None, b[0] or 0.0, b[1], b[2])):
        end = max(x for x in (bottom, top) if x is not None)
        if top is None or reach is None or top > reach + gap:
            found.append([top, bottom, 0])
        found[-1][0] = top if found[-1][0] is None else found[-1][0]
        found[-1][1] = max(found[-1][1], bottom)
        found[-1][2] += 1
        reach = end if reach is None else max(reach, end)
    return [tuple(f) for f in found]


@pytest.mark.parametrize("shape", ["spread", "one_height", "long_boxes"])
def test_one_page_holds_all_boxes(spark, monkeypatch, shape):
    monkeypatch.setattr(ordered, "BUCKET_ROWS", 40)
    rng, boxes = random.Random(7), []
    for i in range(1500):
        top = {"spread": rng.randint(0, 40_000) * 1.0, "one_height": 50.0, "long_boxes": rng.randint(0, 60_000) * 1.0}[shape]
        high = rng.choice([5.0, 9_000.0]) if shape == "long_boxes" and rng.random() < 0.01 else 5.0
        missing = i % 300 == 7
        boxes.append((None if missing else top, rng.randint(0, 99) * 1.0, i, 5.0 if missing else top + high))
    df = spark.createDataFrame([(7, t, b, x, x + 3, i) for t, x, i, b in boxes], "page int, top double, bottom double, x0 double, x1 double, id long")
    placed = layout.by_height(df.withColumn("__top", layout.scaled("top")).withColumn("__x", layout.scaled("x0")), ["page"], ["__top", "__x", "id"])
    sizes = [r["count"] for r in placed.groupBy("__even").count().collect()]
    assert sum(sizes) == 1500 and max(sizes) < 160 and (shape != "one_height" or len(sizes) > 10)
    falls = placed.selectExpr("struct(__top, __x, id) o", "__even").orderBy("o").collect()
    assert all(a["__even"] <= b["__even"] for a, b in zip(falls, falls[1:]))
    out = layout.cluster_objects(df, ["page"], "id", 20.0).orderBy("cluster_no").collect()
    assert [r.cluster_no for r in out] == list(range(1, len(out) + 1))
    assert [(r.top, r.bottom, r.objects) for r in out] == walk_clusters(boxes, 20.0)
    lines = layout.group_lines(df.filter("top IS NOT NULL").withColumn("text", F.lit("w")), ["page"], "id").orderBy("line_no").collect()
    tops, anchor = [], None
    for t in sorted(t for t, *_ in boxes if t is not None):
        if anchor is None or t > anchor + 3.0:
            anchor = t
            tops.append(t)
    assert [r.top for r in lines] == tops


def test_clusters_take_one_scan(spark):
    df = spark.range(10).selectExpr("1 AS page", "id", "id * 50.0D AS top", "id * 50.0D AS bottom", "0.0D AS x0", "1.0D AS x1")
    assert layout.cluster_objects(df, ["page"], "id").count() == 10
    assert layout.cluster_objects(df.filter("id < 0"), ["page"], "id").count() == 0


def test_tiers(spark):
    sizes = [10] * 5 + [20, 18, 18, 14, 8, 12] + [12] * 4
    df = spark.createDataFrame(list(enumerate(sizes)), "seq long, size int")
    # 10 and 12 are equally frequent; 10 comes first, so it is the body.
    assert {r["size"]: r.tier for r in layout.heading_tiers(df, "size", "seq").collect()} == {20: "h1", 18: "h2", 14: "h3", 12: "h3"}


def test_regions(spark):
    captions = spark.createDataFrame(
        [(1, 1, 300.0, 312.0, "Figure 1"), (1, 2, 500.0, 512.0, "Figure 2"), (1, 3, 540.0, 550.0, "Figure 3")],
        "page int, caption_id long, top double, bottom double, text string",
    )
    drawings = spark.createDataFrame(
        [
            (1, 1, 100.0, 150.0, 200.0, 250.0),
            (1, 2, 90.0, 180.0, 300.0, 280.0),
            (1, 3, 100.0, 330.0, 110.0, 400.0),   # too narrow
            (1, 4, 100.0, 320.0, 900.0, 460.0),
            (1, 5, 100.0, 518.0, 200.0, 535.0),   # too flat a region
        ],
        "page int, drawing_id long, x0 double, top double, x1 double, bottom double",
    )
    out = {r.caption: (r.x0, r.y0, r.x1, r.y1) for r in layout.figure_regions(captions, drawings, ["page"]).collect()}
    assert out == {"Figure 1": (72.0, 128.0, 318.0, 296.0), "Figure 2": (82.0, 298.0, 612.0, 478.0)}
    regions = layout.figure_regions(captions, drawings, ["page"])
    tied = {r.caption_id: r.region is not None for r in layout.region_of_caption(captions, regions, ["page"]).collect()}
    assert tied == {1: True, 2: True, 3: False}


def test_crop_boxes(spark):
    captions = spark.createDataFrame([(1, 1, 400.0, 412.0), (1, 2, 600.0, 612.0)], "page int, caption_id long, top double, bottom double")
    objects = spark.createDataFrame(
        [
            (1, 1, 100.0, 200.0, 300.0, 260.0), (1, 2, 120.0, 250.0, 280.0, 340.0),  # one cluster above the first caption
            (1, 3, 100.0, 30.0, 300.0, 90.0),                                          # header area
            (1, 4, 100.0, 500.0, 150.0, 520.0),                                        # too small for the second
        ],
        "page int, object_id long, x0 double, top double, x1 double, bottom double",
    )
    out = {r.caption_id: (r.x0, r.y0, r.x1, r.y1) for r in layout.crop_boxes(captions, objects, ["page"], 612.0, 792.0).collect()}
    assert out == {1: (50.0, 175.0, 335.0, 390.0), 2: (20.0, 416.0, 592.0, 594.0)}
    lines = spark.createDataFrame(
        [(1, 1, 150.0, 250.0, 170.0, 180.0, "A short title"), (1, 2, 150.0, 250.0, 150.0, 160.0, "A sentence. Not a title.")],
        "page int, line_no long, x0 double, x1 double, top double, bottom double, text string",
    )
    titled = {r.caption_id: r.y0 for r in layout.crop_boxes(captions, objects, ["page"], 612.0, 792.0, lines).collect()}
    assert titled == {1: 162.0, 2: 416.0}


def test_caption_blocks_grow(spark):
    lines = [
        (1, 1, 90.0, 100.0, "Fig. 9.9. too high"),
        (1, 2, 200.0, 210.0, "Fig. 3.1. First words"),
        (1, 3, 215.0, 225.0, "go on here"),
        (1, 4, 230.0, 240.0, "Fig. 3.2. Second"),
        (1, 5, 260.0, 270.0, "far below"),
        (1, 6, 300.0, 310.0, "as we can see in the text of Fig. 4.1 again"),
    ]
    df = spark.createDataFrame(lines, "page int, line_no long, top double, bottom double, text string")
    out = {r.number: (r.text_en, r.top, r.bottom) for r in layout.caption_blocks(df, ["page"]).collect()}
    assert out["3.1"] == ("Fig. 3.1. First words go on here", 200.0, 225.0)
    assert out["3.2"] == ("Fig. 3.2. Second", 230.0, 240.0)
    assert "9.9" not in out


def test_block_ids_count_survivors(spark):
    rows = [
        (3, 0, "text", 50.0, "12 Some header"), (3, 1, "text", 200.0, "Words"), (3, 2, "image", 1.0, ""), (3, 3, "text", 300.0, "17"),
        (3, 4, "text", 310.0, "> x <- 1"), (3, 5, "text", 60.0, "Index"), (3, 6, "text", 400.0, " More "),
    ]
    df = spark.createDataFrame(rows, "page int, pos long, type string, y0 double, text string")
    out = layout.text_block_ids(df, ["page"], "pos", "page", titles_pattern="Index|Preface").orderBy("pos").collect()
    assert [(r.unit_id, r.src, r.is_listing) for r in out] == [("p3_t0", "Words", False), ("p3_t1", "> x <- 1", True), ("p3_t2", "More", False)]


def test_prose_lines(value):
    assert value(layout.is_prose_line(F.lit("This is a line of running text"))) is True
    for line in ("Fig. 3 shows it all in one", "12 plot(x, y, longer_name)", "1 2 3 4 5 6", "44 3 Returns and Risk", ""):
        assert value(layout.is_prose_line(F.lit(line))) is False, line
