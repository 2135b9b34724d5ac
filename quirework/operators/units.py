"""Units: page intervals, joins into them, pairing, hierarchy, captions, slugs."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.functions import text as tx
from quirework.functions import titles
from quirework.plans.ordered import Following, GroupLast, LastKnown, RowNumber, RunningSum, id_bucket, ordered_scan, same_keys
from quirework.session import cut_lineage, materialize


def unit_intervals(
    starts: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    start: str,
    last: str,
    boundary: Column | None = None,
    keep_boundary: bool = False,
) -> DataFrame:
    """Closed intervals that end just before the next start; the last ends at ``last``.

    Rows matching ``boundary`` (a table of contents) are no units.  By default they are
    dropped first, so the unit before absorbs their pages; with ``keep_boundary`` they
    still end the unit before them.
    """
    rows = starts
    if boundary is not None and not keep_boundary:
        rows = rows.filter(~boundary)
    rows = ordered_scan(rows, keys, bucket, order, Following("__next", F.col(start)))
    if boundary is not None and keep_boundary:
        rows = rows.filter(~boundary)
    end = F.greatest(F.col(start), F.coalesce(F.col("__next") - 1, F.col(last)))
    return rows.withColumn("unit_end", end).drop("__next")


def locate(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    point: str,
    point_id: str,
    start: str,
    end: str,
    bucket,
    carry: Sequence[str],
) -> DataFrame:
    """Left join of points to disjoint closed intervals, as one ordered pass.

    Both sides are laid out along the position; each point takes the latest interval that
    started and keeps it if it has not ended.  No pair is formed that is not a result, and
    a hot key is cut into buckets.  ``bucket`` maps a position column to its bucket.
    """
    payload = F.struct(F.col(end).alias("__end"), *carry)
    marks = intervals.select(
        *keys, F.col(start).alias("__at"), F.lit(0).alias("__side"), F.lit(None).cast("long").alias("__pid"), payload.alias("__unit")
    )
    kind = marks.schema["__unit"].dataType
    laid = points.select(
        *keys,
        F.col(point).alias("__at"),
        F.lit(1).alias("__side"),
        F.col(point_id).cast("long").alias("__pid"),
        F.lit(None).cast(kind).alias("__unit"),
    ).unionByName(marks)
    found = ordered_scan(
        laid.withColumn("__pid", F.coalesce("__pid", F.lit(-1))),
        keys,
        bucket(F.col("__at")),
        ["__at", "__side", "__pid"],
        LastKnown("__hit", F.col("__unit")),
    ).filter("__side = 1")
    inside = F.col("__hit")["__end"] >= F.col("__at")
    return found.select(
        *keys,
        F.col("__pid").alias(point_id),
        F.col("__at").alias(point),
        *[F.when(inside, F.col("__hit")[c]).alias(c) for c in carry],
    )


#: Nodes of one level are this many bits finer than those of the next.
NODE_BITS = 4


def _pieces(start: Column, end: Column, levels: int) -> Column:
    """(level, node) pieces that make up a closed interval: at each level the nodes that fit
    into it and into no node of the next level, at most 30 of them."""
    low = [-F.shiftright(-start, NODE_BITS * level) for level in range(levels)]
    high = [F.shiftright(end + 1, NODE_BITS * level) for level in range(levels)]

    def nodes(level: int, first: Column, stop: Column) -> Column:
        run = F.when(first < stop, F.sequence(first, stop - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(run, lambda n: F.struct(F.lit(level).alias("level"), n.alias("node")))

    parts = [nodes(levels - 1, low[-1], high[-1])]
    for level in range(levels - 1):
        wider = low[level + 1] < high[level + 1]
        parts.append(nodes(level, low[level], F.when(wider, F.shiftleft(low[level + 1], NODE_BITS)).otherwise(high[level])))
        parts.append(nodes(level, F.when(wider, F.shiftleft(high[level + 1], NODE_BITS)).otherwise(high[level]), high[level]))
    return F.flatten(F.array(*parts))


def interval_levels(intervals: DataFrame, start: str, end: str) -> int:
    """Levels that the widest interval needs: at the top one it has fewer than 16 nodes."""
    width = (F.col(end).cast("decimal(20,0)") - F.col(start).cast("decimal(20,0)") + 1).alias("w")
    widest = intervals.select(width).agg(F.max("w")).first()[0]
    return max(1, -(-int(widest or 1).bit_length() // NODE_BITS))


def first_match(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    point: str,
    point_id: str,
    start: str,
    end: str,
    rank: str,
    carry: Sequence[str],
) -> DataFrame:
    """Left join of points to closed whole-number intervals that may overlap; the match
    with the lowest ``rank`` wins.  A null key is one more key; a null point, or an interval with a null end, matches nothing.

    The number line is a tree of 16 children a node, as high as the widest interval needs.  An interval is cut into
    the few nodes that make it up, at most 30 a level, and of each node only the best interval is kept.  A
    point looks up its node of each level that is in use: one equality join a level, no copy of the point.
    Ends lie below the largest 64-bit number.
    """
    best_of = F.struct(F.col(rank).alias("__rank"), *[F.col(c).alias(f"__{i}") for i, c in enumerate(carry)])
    levels = interval_levels(intervals, start, end)
    pieces = _pieces(F.col(start).cast("long"), F.col(end).cast("long"), levels)
    cut = intervals.filter(F.col(start) <= F.col(end)).select(F.struct(*keys).alias("__key"), best_of.alias("__best"), F.explode(pieces).alias("__piece"))
    nodes = materialize(
        cut.groupBy("__key", F.col("__piece.level").alias("__level"), F.col("__piece.node").alias("__node")).agg(F.min_by("__best", "__best.__rank").alias("__best"))
    )
    used = sorted(r[0] for r in nodes.select("__level").distinct().collect())  # 16 at most
    found = points.select("*", F.struct(*keys).alias("__key"), F.lit(None).cast(nodes.schema["__best"].dataType).alias("__best"))
    for level in used:
        here = nodes.filter(F.col("__level") == level).select("__key", "__node", F.col("__best").alias("__more"))
        place = F.shiftright(F.col(point).cast("long"), NODE_BITS * level)
        found = found.withColumn("__node", place).join(here, ["__key", "__node"], "left")
        better = F.col("__best").isNull() | (F.col("__more.__rank") < F.col("__best.__rank"))
        best = F.when(F.col("__more").isNotNull() & better, F.col("__more")).otherwise(F.col("__best"))
        found = found.withColumn("__best", best).drop("__node", "__more")
    return found.select(*[F.col(c) for c in points.columns], *[F.col("__best")[f"__{i}"].alias(c) for i, c in enumerate(carry)])


def expand(intervals: DataFrame, start: str, end: str, name: str = "page", step: int = 4096) -> DataFrame:
    """One row per position of each interval; long ones are first cut into stretches so no
    row carries a large array.  Overlapping intervals yield their positions twice."""
    cut = intervals.withColumn("__from", F.explode(F.sequence(F.col(start), F.col(end), F.lit(step).cast("long"))))
    upto = F.least(F.col("__from") + F.lit(step - 1), F.col(end))
    return cut.withColumn(name, F.explode(F.sequence(F.col("__from"), upto))).drop("__from")


def pair_by_ordinal(
    rows: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    left: Column,
    right: Column,
    right_id: Column,
    clamp: bool = False,
    name: str = "paired_id",
) -> DataFrame:
    """k-th left row of a key with its k-th right row.

    Both kinds come in one table so one scan numbers them.  Surplus left rows get NULL,
    or with ``clamp`` the last right row, which travels with the scan's summaries rather
    than through a join on the (possibly hot) key.
    """
    ranked = ordered_scan(
        rows.withColumn("__left", left).withColumn("__right", right).withColumn("__rid", right_id),
        keys,
        bucket,
        order,
        RunningSum("__ln", F.col("__left").cast("long")),
        RunningSum("__rn", F.col("__right").cast("long")),
        GroupLast("__last", F.when(F.col("__right"), F.col("__rid"))),
    )
    lefts = ranked.filter("__left").withColumn("ordinal", F.col("__ln"))
    rights = ranked.filter("__right").select(*keys, F.col("__rn").alias("ordinal"), F.col("__rid").alias("__match"))
    joined = same_keys(lefts, rights, [*keys, "ordinal"], "left")
    chosen = F.coalesce("__match", "__last") if clamp else F.col("__match")
    return joined.withColumn(name, chosen).select(*rows.columns, "ordinal", name)


def pair_by_key(
    left: DataFrame, right: DataFrame, keys: Sequence[str], right_id: str, right_order: str, name: str = "paired_id"
) -> DataFrame:
    """Left rows with the last right row of the same key; the right side is reduced to one
    row per key before the join."""
    last = right.groupBy(*keys).agg(F.max_by(F.col(right_id), F.col(right_order)).alias(name))
    return same_keys(left, last, keys, "left")


def flatten_tree(nodes: DataFrame, node: str, parent: str, sibling: str, unreached: bool = False) -> DataFrame:
    """Depth and path of every node of an adjacency list, level by level.

    One join per level; the frontier of each level is checkpointed, so neither the plan nor
    the recomputation grows with the depth.  The path sorts in pre-order.  The walk ends when a
    level is empty.  A node in a cycle, below one, or below a parent that does not exist hangs below no root: it is
    left out, or with ``unreached`` comes out with a null depth and path.
    """
    base = nodes.select(F.col(node).alias("__n"), F.col(parent).alias("__p"), F.col(sibling).alias("__o"))
    level = cut_lineage(
        base.filter("__p IS NULL").select("__n", F.lit(0).alias("depth"), F.array("__o").alias("path"))
    )
    levels = [level]
    for depth in itertools.count(1):
        below = base.alias("c").join(level.alias("p"), F.col("c.__p") == F.col("p.__n"))
        level = cut_lineage(
            below.select(F.col("c.__n"), F.lit(depth).alias("depth"), F.concat(F.col("p.path"), F.array("c.__o")).alias("path"))
        )
        if level.isEmpty():
            break
        levels.append(level)
    flat = levels[0]
    for more in levels[1:]:
        flat = flat.unionByName(more)
    return nodes.join(flat.withColumnRenamed("__n", node), node, "left" if unreached else "inner")


#: Errors of an outline, and of an entry in it.
NO_LIST, NO_ENTRY = "no list", "neither item nor list"


def outline_nodes(documents: DataFrame, key: str, outline: str, read: Mapping[str, Callable[[Column], Column]] | None = None) -> tuple[DataFrame, DataFrame]:
    """Items of nested outlines, and what could not be read.

    An outline is a JSON list of items (objects) and lists.  A list holds the children of the last item before it in
    the list around it, or, where none is before it, of the item that list belongs to.  Items: ``key, path,
    parent_path, level, value`` (a VARIANT), where ``path`` is the positions on the way and sorts in reading order.  Errors: ``key,
    path, error`` for an outline that is no list and for an entry that is neither item nor list; what stands beside it stays.
    ``read`` (name to function of the VARIANT) names what to keep of an item in place of ``value``, so that no more is written.

    One pass a level over the lists of that level, each written in the shared folder, until there are none: no bound on the depth.
    The owner of a list is found in the list around it, one value of one row, so nothing moves between the passes.
    """
    listed = "array<variant>"
    read = read or {"value": lambda value: value}
    level = documents.select(
        key, F.array().cast("array<int>").alias("path"), F.lit(None).cast("array<int>").alias("owner"),
        F.try_variant_get(F.try_parse_json(outline), "$", listed).alias("entries"), F.monotonically_increasing_id().alias("row"),
    )
    items, errors = [], None
    for depth in itertools.count():
        entries = level.select(key, "row", "path", "owner", F.posexplode(_told_entries(F.col("entries"))).alias("at", "told"))
        place = F.when(F.col("told.kind") == NO_LIST, F.col("path")).otherwise(F.concat("path", F.array("at")))
        owner = F.when(F.col("told.last").isNotNull(), F.concat("path", F.array("told.last"))).otherwise(F.col("owner"))
        kept = [use(F.col("told.value")).alias(name) for name, use in read.items()]
        entries = materialize(entries.select(key, "row", "told.kind", place.alias("path"), owner.alias("owner"), *kept, "told.inner"))
        found = entries.filter("kind = 'item'")
        items.append(found.select(key, "row", "path", F.col("owner").alias("parent_path"), F.lit(depth).alias("level"), *read))
        wrong = entries.filter(~F.col("kind").isin("item", "list")).select(key, "path", F.col("kind").alias("error"))
        errors = wrong if errors is None else errors.unionByName(wrong)
        level = entries.filter("kind = 'list'").select(key, "row", "path", "owner", F.col("inner").alias("entries"))
        if level.isEmpty():
            break
    flat = items[0]
    for more in items[1:]:
        flat = flat.unionByName(more)
    return flat, errors


def _told_entries(entries: Column) -> Column:
    """(kind, value, inner, last) of the entries of a list: the value of an item, the entries of an inner list and the position of the
    last item before it.  What is no list (null) has one entry of that kind."""

    def judge(value: Column) -> Column:
        def of(inner: Column) -> Column:
            item = inner.isNull() & F.schema_of_variant(value).startswith("OBJECT")
            kind = F.when(inner.isNotNull(), "list").when(item, "item").otherwise(NO_ENTRY)
            return tx.bind(kind, lambda k: F.struct(k.alias("kind"), F.when(k == "item", value).alias("value"), inner.alias("inner")))

        return tx.bind(F.try_variant_get(value, "$", "array<variant>"), of)

    def last_before(at: Column, places: Column) -> Column:
        def passed(found: Column, step: Column) -> Column:
            return F.when((found + step <= F.size(places)) & (F.get(places, found + step - 1) < at), found + step).otherwise(found)

        return F.get(places, F.reduce(F.array(*[F.lit(2**b) for b in range(30, -1, -1)]), F.lit(0), passed) - 1)

    def told(judged: Column, places: Column) -> Column:
        def one(x: Column, at: Column) -> Column:
            last = F.when(F.get(judged, at - 1)["kind"] == "item", at - 1).otherwise(last_before(at, places))  # mostly just before
            return F.struct(x["kind"].alias("kind"), x["value"].alias("value"), x["inner"].alias("inner"), F.when(x["kind"] == "list", last).alias("last"))

        return F.transform(judged, one)

    def placed(judged: Column) -> Column:
        places = F.filter(F.transform(judged, lambda x, at: F.when(x["kind"] == "item", at)), lambda at: at.isNotNull())
        return tx.bind(places, lambda found: told(judged, found))

    null = F.struct(
        F.lit(NO_LIST).alias("kind"), F.lit(None).cast("variant").alias("value"), F.lit(None).cast("array<variant>").alias("inner"), F.lit(None).cast("int").alias("last")
    )
    return F.when(entries.isNull(), F.array(null)).otherwise(tx.bind(F.transform(entries, judge), placed))


def flatten_outline(documents: DataFrame, key: str, outline: str) -> tuple[DataFrame, DataFrame]:
    """``key, seq, id, parent_id, level, title_en, pdf_page`` of every item in reading order, and the errors.

    A page that is no whole number is null.  Ids count the items of an outline.  Rows that repeat a key have outlines of their own.
    An outline is one value of one row to begin with, so the windows over its items share one shuffle by row.
    """
    read = {
        "title_en": lambda value: tx.clean_text(F.coalesce(F.try_variant_get(value, "$.title", "string"), F.lit(""))),
        "pdf_page": lambda value: F.try_variant_get(value, "$.page", "string").try_cast("int"),
    }
    nodes, errors = outline_nodes(documents, key, outline, read)
    numbered = nodes.withColumn("seq", F.row_number().over(Window.partitionBy("row").orderBy("path")).cast("long"))
    # In reading order the first child follows its parent: what stands between an item and its children is below it as well.
    first = F.min("seq").over(Window.partitionBy("row", "parent_path"))
    parent = F.when(F.col("parent_path").isNotNull(), first - 1)
    named = F.format_string("outline-%04d", "seq")
    rows = numbered.withColumn("parent", parent)
    parent_id = F.when(F.col("parent").isNotNull(), F.format_string("outline-%04d", "parent"))
    return rows.select(key, "seq", named.alias("id"), parent_id.alias("parent_id"), "level", "title_en", "pdf_page"), errors


def children(rows: DataFrame, parent: str, order: str, value: str, name: str = "children") -> DataFrame:
    """Ordered array of the children's values per parent."""
    packed = F.sort_array(F.collect_list(F.struct(order, value)))
    return rows.groupBy(parent).agg(F.transform(packed, lambda s: s[value]).alias(name))


def sections_of(units: DataFrame, outline: DataFrame, need_page: bool) -> DataFrame:
    """Units with the array of their direct child sections; ``need_page`` drops children
    that have no page."""
    kids = outline.filter(F.col("parent_id").isNotNull())
    if need_page:
        kids = kids.filter(F.col("pdf_page").isNotNull())
    packed = F.sort_array(F.collect_list(F.struct(F.col("seq"), "title_en", "pdf_page", "slug", "level")))
    grouped = kids.groupBy(F.col("parent_id").alias("outline_id")).agg(
        F.transform(packed, lambda s: F.struct(s["title_en"].alias("title_en"), s["pdf_page"].alias("pdf_page"), s["slug"].alias("slug"), s["level"].alias("level"))).alias("sections")
    )
    return units.join(grouped, "outline_id", "left")


def outline_units(outline: DataFrame, page_count: int, keep_boundary: bool, book: str = "book") -> DataFrame:
    """Units of a book from its outline (book, seq, id, parent_id, level, title_en, pdf_page,
    slug, kind)."""
    tops = outline.filter((F.col("level") == 0) & (F.col("pdf_page") > 0)).withColumn("last_page", F.lit(page_count))
    units = unit_intervals(
        tops, [book], ["seq"], id_bucket("seq"), "pdf_page", "last_page",
        boundary=F.col("kind") == "contents", keep_boundary=keep_boundary,
    )
    numbered = ordered_scan(units, [book], id_bucket("seq"), ["seq"], RowNumber("unit_no"))
    named = numbered.select(
        book,
        F.format_string("unit-%03d", "unit_no").alias("id"),
        F.col("id").alias("outline_id"),
        "kind", "title_en", "slug",
        F.col("pdf_page").alias("pdf_page_start"),
        F.col("unit_end").alias("pdf_page_end"),
    )
    return sections_of(named, outline, need_page=keep_boundary)


def clip_units(specs: DataFrame, page_count: int) -> DataFrame:
    """Known page ranges of a book cut to the pages it really has."""
    return specs.filter(F.col("pdf_page_start") <= page_count).withColumn(
        "pdf_page_end", F.least(F.col("pdf_page_end"), F.lit(page_count))
    )


def unique_slugs(rows: DataFrame, keys: Sequence[str], base: str, seq: str, bucket: Column, name: str = "unique_slug") -> DataFrame:
    """Unique names in sequence: the first taker of a base keeps it, later ones get the
    lowest free ``-2``, ``-3`` ...; a name taken by another base is skipped.

    Rows are numbered by a distributed scan.  Only bases that can meet another base's
    suffixed name are settled together, on one pre-aggregated row per distinct base.
    """
    keys = list(keys)
    ranked = materialize(ordered_scan(rows, [*keys, base], bucket, [seq], RowNumber("__nth")))
    bases = ranked.groupBy(*keys, base).agg(F.count(F.lit(1)).alias("__count"), F.min(seq).alias("__first"))
    # A base such as "x-2" is a child of the base "x".
    child = bases.withColumn("__parent", F.regexp_replace(base, r"-[0-9]+\z", "")).withColumn(
        "__k", F.regexp_extract(base, r"-([1-9][0-9]*)\z", 1).try_cast("long")
    )
    child = child.filter((F.col("__parent") != F.col(base)) & (F.col("__k") >= 2))
    parents = bases.select(*keys, F.col(base).alias("__parent"))
    met = child.join(parents, [*keys, "__parent"])
    # How many rows the parent had before the child first appeared: one more ordered pass.
    markers = met.select(*keys, F.col("__parent").alias(base), F.col("__first").alias(seq), F.lit(0).alias("__w"), F.col(base).alias("__child"))
    involved = met.select(*keys, F.col("__parent").alias(base)).distinct()
    counted = ranked.join(involved, [*keys, base], "left_semi").select(
        *keys, base, seq, F.lit(1).alias("__w"), F.lit("").alias("__child")
    )
    before = ordered_scan(
        counted.unionByName(markers), [*keys, base], bucket, [seq, "__child"], RunningSum("__before", F.col("__w").cast("long"))
    ).filter("__child <> ''")
    facts = (
        met.withColumnRenamed("__parent", "__par")
        .join(
            before.select(*keys, F.col(base).alias("__par"), F.col("__child").alias(base), "__before"), [*keys, "__par", base]
        )
        .select(*keys, base, F.col("__par").alias("parent"), F.col("__k").alias("k"), F.col("__before").alias("ahead"))
        .withColumn("family", F.regexp_replace(base, r"(-[0-9]+)+\z", ""))
    )
    settled_schema = T.StructType(
        [ranked.schema[c] for c in [*keys, base]]
        + [T.StructField("__taken", T.BooleanType()), T.StructField("__blocks", T.ArrayType(T.LongType()))]
    )

    def settle(group: pd.DataFrame) -> pd.DataFrame:
        """Which bases lose their plain name, and which numbers each base must skip."""
        taken: dict[str, bool] = {}
        blocks: dict[str, list[int]] = {}
        rows_of = {parent: part.sort_values("k") for parent, part in group.groupby("parent")}
        for parent in sorted(rows_of, key=lambda p: (p.count("-"), p)):
            lost = taken.get(parent, False)
            skipped: list[int] = []
            for k, ahead, name_ in zip(rows_of[parent]["k"], rows_of[parent]["ahead"], rows_of[parent][base]):
                suffixed_ahead = int(ahead) if lost else max(int(ahead) - 1, 0)
                if suffixed_ahead >= k - 1 - len(skipped):
                    taken[name_] = True
                else:
                    skipped.append(int(k))
            blocks[parent] = skipped
        names = sorted(set(taken) | set(blocks))
        out = {c: [group[c].iloc[0]] * len(names) for c in keys}
        out[base] = names
        out["__taken"] = [taken.get(n, False) for n in names]
        out["__blocks"] = [blocks.get(n, []) for n in names]
        return pd.DataFrame(out)

    settled = facts.groupBy(*keys, "family").applyInPandas(settle, settled_schema)
    place = F.col("__nth") - F.when(F.coalesce("__taken", F.lit(False)), F.lit(0)).otherwise(F.lit(1))
    number = F.aggregate(
        F.coalesce("__blocks", F.array().cast("array<bigint>")),
        (place + 1).cast("long"),
        lambda n, blocked: F.when(blocked <= n, n + 1).otherwise(n),
    )
    return (
        ranked.join(settled, [*keys, base], "left")
        .withColumn(name, F.when(place == 0, F.col(base)).otherwise(F.concat(F.col(base), F.lit("-"), number.cast("string"))))
        .select(*rows.columns, name)
    )


def find_captions(
    lines: DataFrame,
    keys: Sequence[str],
    page: str,
    pos: str,
    text: str,
    patterns: Sequence[str] = (titles.EXHIBIT_CAPTION,),
    stops: Sequence[str] = (titles.WORDED_CHAPTER,),
    join_below: int = 140,
    width: int = 10_000,
) -> DataFrame:
    """Caption lines of a page's lines; a short one takes the next non-blank line along
    unless that line is a caption or matches ``stops``."""
    clean = lines.withColumn("__line", tx.clean_text(F.col(text))).filter("__line <> ''")
    nexted = ordered_scan(clean, [*keys, page], id_bucket(pos, width), [pos], Following("__next", F.col("__line")))
    line, after = F.col("__line"), F.col("__next")
    label = F.coalesce(*[F.nullif(F.regexp_extract(line, p, 1), F.lit("")) for p in patterns])
    number = F.coalesce(*[F.nullif(F.regexp_extract(line, p, 2), F.lit("")) for p in patterns])
    stopped = tx.matches_any(after, [*patterns, *stops])
    joined = F.when((F.length(line) < join_below) & ~stopped, F.concat(line, F.lit(" "), after))
    return (
        nexted.filter(tx.matches_any(line, patterns))
        .withColumn("label_type", label)
        .withColumn("number", number)
        .withColumn("text_en", F.coalesce(joined, line))
        .select(*[c for c in lines.columns if c != text], "label_type", "number", "text_en")
    )


def page_payload(
    pages: DataFrame, key: str, parts: dict[str, tuple[DataFrame, Column]], bucket: Column, order: Sequence[str]
) -> DataFrame:
    """What belongs to a page, as rows (key, part, position, value): the page itself at
    position 0, then each part (captions, images, sections) numbered in its order.

    Parts are stacked, not joined, so they never multiply each other, and a page with very
    many items is numbered in pieces instead of being packed into one array.  ``parts`` maps
    a name to its rows and the text value of a row.
    """
    stacked = None
    for name, (rows, value) in parts.items():
        one = rows.select(key, *order, F.lit(name).alias("part"), value.alias("value"))
        stacked = one if stacked is None else stacked.unionByName(one)
    inner = stacked.join(pages.select(key), key, "left_semi")
    numbered = ordered_scan(inner, [key, "part"], bucket, [*order, "value"], RowNumber("position"))
    own = pages.select(key, F.lit("page").alias("part"), F.lit(0).cast("long").alias("position"), F.lit(None).cast("string").alias("value"))
    return own.unionByName(numbered.select(key, "part", "position", "value"))


def source_text(pages: DataFrame, unit: Sequence[str], page: str, text: str) -> DataFrame:
    """A unit's text as ordered page rows with their page mark.  The rows are the file: the
    sink sorts and writes them, so no unit is gathered into one value."""
    body = tx.strip(F.coalesce(F.col(text), F.lit("")))
    return pages.select(
        *unit,
        page,
        F.concat(F.lit("<!-- pdf_page: "), F.col(page).cast("string"), F.lit(" -->\n\n"), body, F.lit("\n")).alias("chunk"),
        (body == "").alias("is_empty"),
    )


def first_known(lookups: Sequence[Column], fallback: Column) -> Column:
    """First non-empty title of a chain of lookups."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in lookups], fallback)


#: Why a title was not taken, in the order in which the candidates are tried.
MAPPED, WRONG_NUMBER, UNTRANSLATED = "mapped", "wrong number", "untranslated"


def section_titles(sections: DataFrame, slug_titles: DataFrame, title_titles: DataFrame, common_titles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``sections(*keys, slug, title_en)`` with ``title``, the ``source`` it comes from and why others were ``rejected``.

    Candidates, the first valid one wins: the title known for the slug, valid if it begins with the section's number and, where a
    common title is known, is translated; the title known for the whole English title, asked only where the slug is not known;
    the common title of the words after the number (``common_titles(words, title)``), with the number before it; the English title.
    ``slug_titles(slug, title)`` and ``title_titles(title_en, title)``: of several titles the least counts.
    """
    def one(titles_: DataFrame, by: str, name: str) -> DataFrame:
        return titles_.groupBy(by).agg(F.min("title").alias(name))

    number = F.regexp_extract("title_en", titles.NUMBERED_TITLE, 1)
    numbered = sections.select(
        "*", number.alias("__number"),
        F.lower(tx.strip(F.when(number == "", F.col("title_en")).otherwise(F.regexp_extract("title_en", titles.NUMBERED_TITLE, 2)))).alias("__words"),
    )
    known = numbered.join(one(slug_titles, "slug", "__slug"), "slug", "left").join(one(title_titles, "title_en", "__title"), "title_en", "left")
    known = known.join(one(common_titles.withColumnRenamed("words", "__words"), "__words", "__common"), "__words", "left")
    has_slug, has_common = F.col("__slug").isNotNull(), F.col("__common").isNotNull()
    fits = titles.has_expected_number(F.col("__slug"), F.col("title_en"), F.coalesce("slug", F.lit("")))
    translated = ~has_common | F.col("__slug").rlike(tx.CJK)
    common = F.concat(F.when(F.col("__number") != "", F.concat("__number", F.lit(" "))).otherwise(F.lit("")), F.col("__common"))
    candidates = [
        ("slug", F.col("__slug"), has_slug & fits & translated),
        ("title", F.col("__title"), ~has_slug & F.col("__title").isNotNull()),
        ("common", common, has_common),
        ("english", F.col("title_en"), F.lit(True)),
    ]
    ranked = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(n).alias("source"), t.alias("title"), v.alias("valid")) for i, (n, t, v) in enumerate(candidates)])
    chosen = F.array_min(F.filter(ranked, lambda c: c["valid"]))
    why = F.when(has_slug & ~fits, WRONG_NUMBER).when(has_slug & ~translated, UNTRANSLATED)
    return known.select(*keys, "slug", "title_en", chosen["title"].alias("title"), chosen["source"].alias("source"), why.alias("rejected"))


def merge_title_maps(maps: Sequence[DataFrame], key: str, title: str) -> DataFrame:
    """Union of title maps; the earliest map that knows a key wins."""
    tagged = [m.select(key, title, F.lit(i).alias("__p")) for i, m in enumerate(maps)]
    merged = tagged[0]
    for more in tagged[1:]:
        merged = merged.unionByName(more)
    return merged.groupBy(key).agg(F.min_by(title, "__p").alias(title))


def match_headings(
    headings: DataFrame, sections: DataFrame, keys: Sequence[str], text: str, section_titles: Sequence[str], rank: str, along: Sequence[str] = ()
) -> DataFrame:
    """First section of the unit one of whose titles reads like the heading: an equality
    join on the canonical form instead of comparing every pair.  Its columns ``along`` come too."""
    forms = sections.select(
        *keys, rank, "slug", *along, F.explode(F.array_distinct(F.array(*[titles.canonical_heading(F.col(c)) for c in section_titles]))).alias("__form")
    ).filter("__form <> ''")
    first = forms.groupBy(*keys, "__form").agg(
        F.min_by("slug", rank).alias("section_slug"), *[F.min_by(name, rank).alias(name) for name in along]
    )
    return same_keys(headings.withColumn("__form", titles.canonical_heading(F.col(text))), first, [*keys, "__form"], "left").drop("__form")
