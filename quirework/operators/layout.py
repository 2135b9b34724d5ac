"""Page layout: lines, clusters, islands, heading tiers, figure regions, crop boxes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import code as cx
from quirework.functions import rules as rx
from quirework.functions import text as tx
from quirework.functions import titles
from quirework.plans.anchored import anchored_runs
from quirework.plans.ordered import LastKnown, MaxBefore, Opener, Previous, RowNumber, RunningSum, even_buckets, id_bucket, ordered_scan
from quirework.session import materialize

# --- fixed values (points; origin at the top of the page) ----------------------------
LINE_TOLERANCE = 3.0
CLUSTER_GAP = 45.0
HEADER_LIMIT = 78.0
CAPTION_LINE_GAP = 13
CAPTION_TOP, CAPTION_FLOOR = 100, 620
NOTICE_STARTS = ("©", "Springer", "DOI ")
FIGURE_MENTIONS = ("seefig.", "of fig.", "offig.", "infig.")
SCALE = 1000  # thousandths of a point, so positions are whole numbers
# ----------------------------------------------------------------------------------


def scaled(column: str | Column) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value * SCALE).cast("long")


def by_height(rows: DataFrame, page: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add the bucket ``__even``: 200 points of the first order column, cut at row ranks where a page has too many rows there."""
    return even_buckets(rows, page, F.floor(F.col(order[0]) / (200 * SCALE)), order)


def group_lines(words: DataFrame, page: Sequence[str], word: str, tolerance: float = LINE_TOLERANCE) -> DataFrame:
    """Words (top, bottom, x0, x1, text) grouped into lines.

    A word joins the line while its top is within ``tolerance`` of the line's first top
    (the anchor, not the previous word)."""
    order = ["__top", "__x", word]
    placed = by_height(words.withColumn("__top", scaled("top")).withColumn("__x", scaled("x0")), page, order)
    lined = anchored_runs(
        placed, page, F.col("__even"), order,
        F.col("__top"), F.col("__top"), int(tolerance * SCALE), "line_no",
    )
    spelled = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__top", "__x", word, "text"))), lambda w: w["text"]), " ")
    return lined.groupBy(*page, "line_no").agg(
        F.min("top").alias("top"),
        F.max("bottom").alias("bottom"),
        F.min("x0").alias("x0"),
        F.max("x1").alias("x1"),
        tx.clean_text(spelled, typography=True).alias("text"),
    )


def open_islands(
    rows: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[str], start: Column, end: Column, gap, name: str = "island"
) -> DataFrame:
    """Name the cluster of overlapping or near intervals by the order columns of its first row: a row opens a new one
    when it starts more than ``gap`` after everything before it has ended.  One scan, which carries the greatest end
    and the last opening from bucket to bucket.  Starts do not decrease along the order; rows without a start have a bucket of
    their own, and each is a cluster."""
    return ordered_scan(rows, keys, bucket, order, Opener(name, start, end, gap))


def merged_islands(
    rows: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    start: Column,
    end: Column,
    gap,
    measures: Mapping[str, tuple[Callable[[Column], Column], Column]],
    name: str = "island",
) -> DataFrame:
    """Clusters as rows (keys, 1-based number, measures); a measure is a column and an aggregate that
    merges its own results, as min, max and sum do.

    The rows are read once and shrink to the clusters of each bucket before anything else moves: these are intervals
    again, so the scan across buckets joins them by the same rule.
    """
    keys, order = list(keys), list(order)
    place = [*keys, "__in"]
    inner = [f"__o{i}" for i in range(len(order))]
    inside = Window.partitionBy(*place).orderBy(*inner)
    marked = rows.select(
        *keys, bucket.alias("__in"), *[F.col(c).alias(i) for c, i in zip(order, inner)], start.alias("__start"), end.alias("__end"),
        *[column.alias(f"__m_{m}") for m, (_, column) in measures.items()],
    ).withColumn("__reach", F.max("__end").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    marked = marked.withColumn("__opens", ~F.coalesce(F.col("__start") <= F.col("__reach") + gap, F.lit(False)))
    marked = marked.withColumn("__local", F.count_if("__opens").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # Values of the opening row one by one: a struct would take the aggregate out of its hash map.
    opening = [F.max(F.when(F.col("__opens"), F.col(c))).alias(c) for c in (*inner, "__start")]
    local = materialize(
        marked.groupBy(*place, "__local").agg(*opening, F.max("__end").alias("__end"), *[f(F.col(f"__m_{m}")).alias(m) for m, (f, _) in measures.items()])
    )
    named = open_islands(local, keys, F.col("__in"), inner, F.col("__start"), F.col("__end"), gap, "__island")
    whole = named.groupBy(*keys, "__island").agg(F.min("__in").alias("__b"), *[f(F.col(m)).alias(m) for m, (f, _) in measures.items()])
    opened = whole.select(*keys, "__b", "__island.*", *measures)
    return ordered_scan(opened, keys, F.col("__b"), inner, RowNumber(name)).select(*keys, name, *measures)


def islands(
    rows: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    start: Column,
    end: Column,
    gap,
    name: str = "island",
) -> DataFrame:
    """Number the clusters of overlapping or near intervals: a row opens a new one when it
    starts more than ``gap`` after everything before it has ended."""
    marked = rows.withColumn("__start", start).withColumn("__end", end)
    # Two scans in a row: the first is written, else the second would run it twice.
    reach = materialize(ordered_scan(marked, keys, bucket, order, MaxBefore("__reach", F.col("__end"))))
    opens = F.when(F.col("__start") <= F.col("__reach") + gap, F.lit(0)).otherwise(F.lit(1))
    numbered = ordered_scan(reach.withColumn("__opens", opens), keys, bucket, order, RunningSum(name, F.col("__opens").cast("long")))
    return numbered.select(*rows.columns, name)


def cluster_objects(objects: DataFrame, page: Sequence[str], obj: str, gap: float = CLUSTER_GAP) -> DataFrame:
    """Bounding box and size of the vertical clusters of graphic objects."""
    order = ["__top", "__x", obj]
    placed = by_height(objects.withColumn("__top", scaled("top")).withColumn("__x", scaled("x0")), page, order)
    measures = {
        "x0": (F.min, F.col("x0")),
        "top": (F.min, F.col("top")),
        "x1": (F.max, F.col("x1")),
        "bottom": (F.max, F.col("bottom")),
        "objects": (F.sum, F.lit(1)),
    }
    return merged_islands(
        placed, page, F.col("__even"), order, F.col("top"), F.greatest("bottom", "top"), gap, measures, "cluster_no"
    )


def flag_islands(
    rows: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[str], flag: Column, name: str = "islands"
) -> DataFrame:
    """Count of maximal stretches of flagged rows per key."""
    marked = rows.withColumn("__flag", F.coalesce(flag, F.lit(False)))
    scanned = ordered_scan(marked, keys, bucket, order, Previous("__before", F.col("__flag")))
    starts = F.col("__flag") & ~F.coalesce("__before", F.lit(False))
    return scanned.groupBy(*keys).agg(F.count_if(starts).alias(name))


def is_prose_line(line: Column) -> Column:
    """A source line of running text: enough letters, no header, caption or code."""
    value = tx.squash(line)
    letters = tx.latin_count(value)
    return (
        (value != "")
        & ~rx.is_source_header(value)
        & ~value.rlike(r"\A(?:Fig\.|Figure|Table)\s+[0-9]")
        & ~value.rlike(r"\A[0-9]+\s+[A-Za-z_][A-Za-z0-9_.]*\s*(?:=|<-|\(|,)")
        & (letters >= 12)
        & (letters / F.greatest(F.length(value), F.lit(1)) > 0.35)
    )


def is_opening_line(line: Column) -> Column:
    """A line that may stand above a section title at the top of a page."""
    value = tx.squash(line)
    short_words = value.rlike("[A-Za-z]") & (F.length(value) <= 80) & ~value.rlike(r"[=(){}\[\];.,]")
    return value.rlike(r"\A(?:[0-9]{1,2}|[A-Z])\z") | short_words


def is_running_header(text: Column, y0: Column, titles_pattern: str | None = None) -> Column:
    """Blank, a page number, or a header line near the top edge."""
    value = tx.squash(text)
    named = value.rlike(rf"(?i)\A(?:[0-9]+\s+)?(?:{titles_pattern})\z") if titles_pattern else F.lit(False)
    return (value == "") | value.rlike(r"\A[0-9]{1,4}\z") | ((y0 <= HEADER_LIMIT) & (named | value.rlike(r"\A[0-9]+\s+\S.+\z")))


def text_block_ids(blocks: DataFrame, page: Sequence[str], pos: str, page_no: str, titles_pattern: str | None = None) -> DataFrame:
    """Surviving text blocks (page, pos, type, y0, text) with ids counted from 0 per page.
    Listings take a number too; they are marked, not removed."""
    kept = blocks.filter((F.col("type") == "text") & ~is_running_header(F.col("text"), F.col("y0"), titles_pattern))
    numbered = ordered_scan(kept, page, id_bucket(pos, 10_000), [pos], RowNumber("__n"))
    return (
        numbered.withColumn("unit_id", F.format_string("p%d_t%d", page_no, F.col("__n") - 1))
        .withColumn("src", tx.strip(F.col("text")))
        .withColumn("is_listing", cx.code_like_lines(F.col("text")))
        .drop("__n")
    )


def heading_tiers(sizes: DataFrame, size: str, seq: str | Column) -> DataFrame:
    """Tier of each size above the body size: largest h1, next h2, all others h3.

    The body size is the most frequent one, the earliest on a tie.  Sizes are counted
    first; the sizes that decide (body, two largest) come in as scalar subqueries.
    """
    counted = sizes.groupBy(size).agg(F.count(F.lit(1)).alias("__n"), F.min(seq).alias("__first"))
    body = counted.orderBy(F.desc("__n"), "__first").limit(1).select(size)
    larger = counted.filter(F.col(size) > body.scalar())
    top = larger.orderBy(F.desc(size)).limit(2).agg(F.sort_array(F.collect_list(size), asc=False)).scalar()
    return larger.withColumn("__top", top).select(
        size,
        F.col("__n").alias("uses"),
        F.when(F.col(size) == F.get("__top", F.lit(0)), F.lit("h1"))
        .when(F.col(size) == F.get("__top", F.lit(1)), F.lit("h2"))
        .otherwise(F.lit("h3"))
        .alias("tier"),
    )


def assign_to_caption(
    items: DataFrame, captions: DataFrame, page: Sequence[str], item: str, caption: str, slack: float, bottom: str = "bottom", top: str = "top"
) -> DataFrame:
    """Each item with the first caption below it (``caption.top >= item.bottom - slack``).

    One pass from the bottom of the page upwards instead of an inequality join.  Caption
    columns come back prefixed with ``cap_``.
    """
    carried = [c for c in captions.columns if c not in page]
    marks = captions.select(
        # Of captions at the same height the first one, met last on the way up, is taken.
        *page, (-scaled(top)).alias("__at"), F.lit(0).alias("__side"), (-F.col(caption).cast("long")).alias("__id"),
        F.struct(*carried).alias("__cap"),
    )
    own = [c for c in items.columns if c not in page]
    placed = items.select(
        *page, (-(scaled(bottom) - int(slack * SCALE))).alias("__at"), F.lit(1).alias("__side"),
        F.col(item).cast("long").alias("__id"), F.struct(*own).alias("__own"),
    )
    order = ["__at", "__side", "__id"]
    both = by_height(placed.unionByName(marks, allowMissingColumns=True), page, order)
    found = ordered_scan(both, page, F.col("__even"), order, LastKnown("__hit", F.col("__cap"))).filter("__side = 1")
    return found.select(
        *page, *[F.col("__own")[c].alias(c) for c in own], *[F.col("__hit")[c].alias(f"cap_{c}") for c in carried]
    )


def figure_regions(captions: DataFrame, drawings: DataFrame, page: Sequence[str], page_width: float = 612.0) -> DataFrame:
    """Region above each caption (caption_id, top, bottom, text) that its drawings
    (drawing_id, x0, top, x1, bottom) fill.

    Small drawings are ignored; a drawing counts between the previous caption and this one.
    """
    order = ["__top", "caption_id"]
    placed = by_height(captions.withColumn("__top", scaled("top")), page, order)
    bounded = ordered_scan(placed, page, F.col("__even"), order, Previous("__prev", F.col("bottom")))
    bounded = bounded.withColumn("lower", F.coalesce("__prev", F.lit(70.0))).drop("__prev", "__top", "__even")
    large = drawings.filter((F.col("x1") - F.col("x0") >= 24) & (F.col("bottom") - F.col("top") >= 16) & (F.col("top") >= 65))
    inside = assign_to_caption(large, bounded, page, "drawing_id", "caption_id", 3.0).filter(F.col("top") >= F.col("cap_lower") - 10)
    boxes = inside.groupBy(*page, F.col("cap_caption_id").alias("caption_id")).agg(
        F.max("cap_top").alias("caption_top"),
        F.max("cap_text").alias("caption"),
        F.greatest(F.lit(45.0), F.min("x0") - 18).alias("x0"),
        F.greatest(F.lit(75.0), F.min("top") - 22).alias("y0"),
        F.least(F.lit(page_width), F.max("x1") + 18).alias("x1"),
        F.max("bottom").alias("__low"),
    )
    y1 = F.least(F.col("caption_top") - 4, F.col("__low") + 18)
    return (
        boxes.withColumn("y1", y1)
        .filter(F.col("y1") > F.col("y0") + 40)
        .select(*page, "caption_id", "caption", *[F.bround(c, 1).alias(c) for c in ("x0", "y0", "x1", "y1")])
    )


def region_of_caption(captions: DataFrame, regions: DataFrame, page: Sequence[str], text: str = "caption") -> DataFrame:
    """Captions with their region, by page and caption text; the last region of a text wins."""
    one = regions.groupBy(*page, F.trim(F.col(text)).alias("__text")).agg(
        F.max_by(F.struct("x0", "y0", "x1", "y1"), "caption_id").alias("region")
    )
    return captions.withColumn("__text", F.trim(F.col("text"))).join(one, [*page, "__text"], "left").drop("__text")


def caption_blocks(lines: DataFrame, page: Sequence[str], line: str = "line_no") -> DataFrame:
    """Figure captions of a page's lines (line_no, top, bottom, text), grown downwards while
    lines follow closely and no new caption or notice begins."""
    marker = r"\bFig\.\s*([0-9]+(?:[.-][0-9A-Za-z]+)*)\.?"
    text = F.col("text")
    heads = text.rlike(titles.FIGURE_CAPTION)
    squeezed = F.replace(F.lower(text), F.lit(" "), F.lit(""))
    mention = tx.contains_any(squeezed, FIGURE_MENTIONS)
    before = F.length(F.regexp_extract(text, r"(?s)\A(.*?)\bFig\.\s*[0-9]", 1))
    late = before >= F.greatest(F.lit(12), F.floor(F.length(text) / 3))
    inline = text.rlike(marker) & ~mention & late
    number = F.when(heads, F.regexp_extract(text, titles.FIGURE_CAPTION, 2)).otherwise(F.regexp_extract(text, marker, 1))

    place = id_bucket(line, 10_000)
    above = ordered_scan(lines, page, place, [line], Previous("__above", F.col("bottom")))
    stop = (
        (F.col("top") - F.col("__above") > CAPTION_LINE_GAP)
        | text.rlike(r"\A(?:" + "|".join(rf"\Q{x}\E" for x in NOTICE_STARTS) + ")")
        | heads
        | (F.col("top") > CAPTION_FLOOR)
    )
    runs = ordered_scan(
        materialize(above).withColumn("__stop", F.coalesce(stop, F.lit(True)).cast("long")), page, place, [line], RunningSum("__run", F.col("__stop"))
    )
    seeds = runs.filter((heads | inline) & (F.col("top") >= CAPTION_TOP)).select(*page, "__run", F.col(line).alias("caption_line"), number.alias("number"))
    grown = seeds.join(runs.select(*page, "__run", line, "top", "bottom", "text"), [*page, "__run"]).filter(F.col(line) >= F.col("caption_line"))
    words = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(line, "text"))), lambda s: s["text"]), " ")
    return grown.groupBy(*page, "caption_line", "number").agg(
        tx.clean_text(words, typography=True).alias("text_en"), F.min("top").alias("top"), F.max("bottom").alias("bottom")
    )


def crop_boxes(
    captions: DataFrame,
    objects: DataFrame,
    page: Sequence[str],
    width: float,
    height: float,
    lines: DataFrame | None = None,
) -> DataFrame:
    """Crop box above each caption (caption_id, top, bottom).

    Objects (object_id, x0, top, x1, bottom) between the previous caption and this one are
    clustered; the lowest cluster of useful size gives the box, with room for a nearby
    title taken from ``lines`` (line_no, x0, x1, top, bottom, text).  Without a cluster a
    fixed band above the caption is used.
    """
    order = ["__top", "caption_id"]
    ordered = by_height(captions.withColumn("__top", scaled("top")), page, order)
    bounded = ordered_scan(ordered, page, F.col("__even"), order, MaxBefore("__prev", F.col("bottom")))
    bounded = bounded.withColumn("previous", F.coalesce("__prev", F.lit(0.0))).drop("__prev", "__top", "__even")
    bounded = materialize(bounded)
    visible = objects.filter((F.col("x1") - F.col("x0") >= 1) | (F.col("bottom") - F.col("top") >= 1))
    near = assign_to_caption(visible, bounded, page, "object_id", "caption_id", 4.0).filter(
        F.col("top") >= F.greatest(F.lit(110.0), F.col("cap_previous") + 2)
    )
    clusters = cluster_objects(materialize(near).withColumnRenamed("cap_caption_id", "caption_id"), [*page, "caption_id"], "object_id")
    useful = clusters.filter((F.col("x1") - F.col("x0") >= 80) & (F.col("bottom") - F.col("top") >= 30) & (F.col("objects") >= 2))
    chosen = useful.groupBy(*page, "caption_id").agg(
        F.max_by(F.struct("x0", "top", "x1", "bottom"), F.struct("bottom", -F.col("cluster_no"))).alias("box")
    )
    joined = bounded.join(chosen, [*page, "caption_id"], "left")
    if lines is not None:
        joined = joined.join(_title_tops(joined, lines, page), [*page, "caption_id"], "left")
    else:
        joined = joined.withColumn("title_top", F.lit(None).cast("double"))
    box = F.col("box")
    found = F.struct(
        F.greatest(F.lit(0.0), box["x0"] - 50).alias("x0"),
        F.greatest(F.lit(0.0), F.coalesce(F.col("title_top") - 8, box["top"] - 25)).alias("y0"),
        F.least(F.lit(width), box["x1"] + 35).alias("x1"),
        F.least(F.lit(height), F.col("top") - 6, box["bottom"] + 50).alias("y1"),
    )
    band = F.struct(
        F.lit(20.0).alias("x0"),
        F.greatest(F.lit(60.0), F.col("previous") + 4, F.col("top") - 260).alias("y0"),
        F.lit(width - 20.0).alias("x1"),
        F.least(F.lit(height), F.col("top") - 6).alias("y1"),
    )
    crop = F.when(box.isNotNull(), found).otherwise(band)
    enough = (crop["y1"] - crop["y0"] >= 40) & (box.isNull() | (crop["x1"] - crop["x0"] >= 80))
    return joined.filter(enough).select(*page, "caption_id", *[F.bround(crop[c], 2).alias(c) for c in ("x0", "y0", "x1", "y1")])


def _title_tops(captions: DataFrame, lines: DataFrame, page: Sequence[str]) -> DataFrame:
    """Top of the highest title-like line just above the chosen cluster."""
    bin_of = lambda value: F.floor(value / 70.0)
    wanted = captions.filter("box IS NOT NULL").select(
        *page, "caption_id", "previous", "box",
        F.explode(F.sequence(bin_of(F.col("box")["top"] - 65), bin_of(F.col("box")["top"] + 2))).alias("__bin"),
    )
    words = F.size(F.split(F.trim("text"), r"\s+"))
    equation = F.col("text").contains("=")
    plausible = lines.filter(
        (F.trim("text") != "") & (F.length(F.trim("text")) <= 90) & ~rx.is_source_header(F.trim("text"), sections=False)
        & (equation | ((words <= 9) & ~F.col("text").contains(".")))
    ).select(*page, F.col("x0").alias("l0"), F.col("x1").alias("l1"), F.col("top").alias("lt"), bin_of(F.col("bottom")).alias("__bin"), F.col("bottom").alias("lb"))
    box = F.col("box")
    gap = box["top"] - F.col("lb")
    overlap = F.least("l1", box["x1"]) - F.greatest("l0", box["x0"])
    center = (F.col("l0") + F.col("l1")) / 2
    aligned = (overlap >= F.least(F.lit(120.0), (box["x1"] - box["x0"]) * 0.25)) | center.between(box["x0"], box["x1"])
    return (
        wanted.join(plausible, [*page, "__bin"])
        .filter(gap.between(-2, 65) & (F.col("lt") > F.greatest(F.lit(35.0), F.col("previous") + 2)) & aligned)
        .groupBy(*page, "caption_id")
        .agg(F.min("lt").alias("title_top"))
    )
