"""Interval, pairing, hierarchy, slug and caption queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirework.catalog.registry import query
from quirework.functions import text as tx
from quirework.operators import units
from quirework.plans.ordered import GroupMax, RowNumber, id_bucket, ordered_scan, time_bucket
from quirework.sources.tables import table

# Turns of a conversation and events of a user are numbered densely; these widths bound a
# task's share of one key.
TURN_WIDTH = 10_000
EVENT_WIDTH = 250_000


def _turn_units(spark, folder, keep_boundary):
    """Units opened by user and system turns; system turns are the contents boundary."""
    turns = table(spark, folder, "conversations", "conv_id", "turn", "role")
    turns = ordered_scan(turns, ["conv_id"], id_bucket("turn", TURN_WIDTH), ["turn"], GroupMax("last", F.col("turn")))
    starts = turns.filter(F.col("role").isin("user", "system"))
    return units.unit_intervals(
        starts, ["conv_id"], ["turn"], id_bucket("turn", TURN_WIDTH), "turn", "last",
        boundary=F.col("role") == "system", keep_boundary=keep_boundary,
    ).select("conv_id", F.col("turn").alias("unit_start"), "unit_end")


@query(
    """WITH s AS (SELECT conv_id, turn, role, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations)
    SELECT conv_id, turn AS unit_start, greatest(turn, coalesce(lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) - 1, last)) AS unit_end
    FROM s WHERE role = 'user'"""
)
def unit_intervals(spark, folder):
    """Closed intervals; a boundary is dropped first, so the unit before absorbs it."""
    return _turn_units(spark, folder, keep_boundary=False)


@query(
    """WITH s AS (SELECT user_id, event_id, event_type, max(event_id) OVER (PARTITION BY user_id) AS last FROM events),
    l AS (SELECT *, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt FROM s WHERE event_type IN ('signup', 'error'))
    SELECT user_id, event_id AS unit_start, greatest(event_id, coalesce(nxt - 1, last)) AS unit_end FROM l WHERE event_type <> 'error'"""
)
def unit_intervals_keep_boundary(spark, folder):
    """Signups open units; errors are boundaries that still end the unit before them."""
    events = table(spark, folder, "events", "user_id", "event_id", "event_type")
    bucket = id_bucket("event_id", EVENT_WIDTH)
    known = ordered_scan(events, ["user_id"], bucket, ["event_id"], GroupMax("last", F.col("event_id")))
    starts = known.filter(F.col("event_type").isin("signup", "error"))
    found = units.unit_intervals(
        starts, ["user_id"], ["event_id"], id_bucket("event_id", EVENT_WIDTH), "event_id", "last",
        boundary=F.col("event_type") == "error", keep_boundary=True,
    )
    return found.select("user_id", F.col("event_id").alias("unit_start"), "unit_end")


@query(
    """WITH s AS (SELECT user_id, event_id AS a, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt FROM events WHERE event_type = 'signup'),
    u AS (SELECT user_id, a, CASE WHEN nxt IS NULL OR nxt - a > 2000 THEN a + 2000 ELSE nxt - 1 END AS b FROM s)
    SELECT e.event_id, e.user_id, u.a AS unit_start FROM events e LEFT JOIN u ON u.user_id = e.user_id AND e.event_id BETWEEN u.a AND u.b"""
)
def page_to_unit(spark, folder):
    """Events placed in their user's signup interval; those outside any keep NULL."""
    events = table(spark, folder, "events", "user_id", "event_id", "event_type")
    bucket = lambda at: id_bucket(at, EVENT_WIDTH)
    signups = events.filter("event_type = 'signup'").withColumn("last", F.col("event_id") + 2000)
    spans = units.unit_intervals(signups, ["user_id"], ["event_id"], bucket(F.col("event_id")), "event_id", "last")
    spans = spans.select(
        "user_id", F.col("event_id").alias("unit_start"), F.least("unit_end", F.col("event_id") + 2000).alias("unit_end")
    )
    points = events.select("user_id", "event_id", F.col("event_id").alias("at"))
    placed = units.locate(points, spans, ["user_id"], "at", "event_id", "unit_start", "unit_end", bucket, ["unit_start"])
    return placed.select("event_id", "user_id", "unit_start")


@query(
    """WITH u AS (SELECT user_id, event_id, event_id AS a, event_id + 500 + (event_id % 4) * 1000 AS b FROM events WHERE event_type = 'signup'),
    p AS (SELECT e.event_id, u.event_id AS unit_id, row_number() OVER (PARTITION BY e.event_id ORDER BY u.event_id) AS r
      FROM events e LEFT JOIN u ON u.user_id = e.user_id AND e.event_id BETWEEN u.a AND u.b)
    SELECT event_id, unit_id FROM p WHERE r = 1"""
)
def page_to_first_unit(spark, folder):
    """Events and overlapping intervals: the first interval in order wins."""
    events = table(spark, folder, "events", "user_id", "event_id", "event_type", spread="event_id")
    spans = events.filter("event_type = 'signup'").select(
        "user_id", F.col("event_id").alias("unit_id"), F.col("event_id").alias("a"),
        (F.col("event_id") + 500 + (F.col("event_id") % 4) * 1000).alias("b"),
    )
    points = events.select("user_id", "event_id", F.col("event_id").alias("at"))
    found = units.first_match(points, spans, ["user_id"], "at", "event_id", "a", "b", "unit_id", ["unit_id"])
    return found.select("event_id", "unit_id")


@query(
    """WITH s AS (SELECT conv_id, turn, max(turn) OVER (PARTITION BY conv_id) AS last, role FROM conversations),
    u AS (SELECT conv_id, turn AS a, greatest(turn, coalesce(lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) - 1, last)) AS b FROM s WHERE role = 'user')
    SELECT conv_id, a AS unit_start, unnest(range(a, b + 1)) AS page FROM u"""
)
def unit_page_expand(spark, folder):
    """Every position of every unit."""
    spans = _turn_units(spark, folder, keep_boundary=False)
    return units.expand(spans, "unit_start", "unit_end").select("conv_id", "unit_start", "page")


@query(
    """WITH s AS (SELECT conv_id, turn, max(turn) OVER (PARTITION BY conv_id) AS last, role FROM conversations),
    u AS (SELECT conv_id, turn AS a, greatest(turn, coalesce(lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) - 1, last)) AS b FROM s WHERE role = 'user'),
    p AS (SELECT conv_id, unnest(range(a, b + 1)) AS turn FROM u)
    SELECT conv_id, turn FROM p WHERE (conv_id, turn) NOT IN (SELECT (conv_id, turn) FROM conversations WHERE length(text) > 40)"""
)
def expected_minus_done(spark, folder):
    """Expected positions that have no finished page yet."""
    expected = units.expand(_turn_units(spark, folder, keep_boundary=False), "unit_start", "unit_end", "turn")
    done = table(spark, folder, "conversations", "conv_id", "turn", "text").filter(F.length("text") > 40)
    return expected.select("conv_id", "turn").join(done.select("conv_id", "turn"), ["conv_id", "turn"], "left_anti")


_PAIR = """WITH e AS (SELECT *, CAST(epoch_us(ts) // 86400000000 AS BIGINT) AS day FROM events WHERE event_type IN ('click', 'purchase')),
    c AS (SELECT event_id, user_id, day, row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS k FROM e WHERE event_type = 'click'),
    p AS (SELECT event_id, user_id, day, row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS k,
      count(*) OVER (PARTITION BY user_id, day) AS n FROM e WHERE event_type = 'purchase'),
    m AS (SELECT DISTINCT user_id, day, n FROM p)"""


def _pairs(spark, folder, clamp):
    events = table(spark, folder, "events", "event_id", "ts", "user_id", "event_type")
    rows = events.filter(F.col("event_type").isin("click", "purchase")).withColumn("day", time_bucket("ts"))
    kind = F.col("event_type")
    paired = units.pair_by_ordinal(
        rows, ["user_id", "day"], time_bucket("ts", 900), ["ts", "event_id"], kind == "click", kind == "purchase", F.col("event_id"), clamp
    )
    return paired.select("event_id", "user_id", "ordinal", "paired_id")


@query(_PAIR + " SELECT c.event_id, c.user_id, c.k AS ordinal, p.event_id AS paired_id FROM c LEFT JOIN p USING (user_id, day, k)")
def ordinal_pair(spark, folder):
    """k-th click of a user's day with the k-th purchase; surplus clicks stay alone."""
    return _pairs(spark, folder, clamp=False)


@query(
    _PAIR
    + """ SELECT c.event_id, c.user_id, c.k AS ordinal, p.event_id AS paired_id FROM c LEFT JOIN m USING (user_id, day)
    LEFT JOIN p ON p.user_id = c.user_id AND p.day = c.day AND p.k = least(c.k, m.n)"""
)
def ordinal_pair_clamped(spark, folder):
    """The same, surplus clicks reuse the last purchase."""
    return _pairs(spark, folder, clamp=True)


_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


@query(
    f"""WITH p AS (SELECT user_id, {_K} AS k, max(event_id) AS paired_id FROM events WHERE event_type = 'purchase' GROUP BY ALL)
    SELECT event_id, user_id, e.k AS k, paired_id FROM (SELECT *, {_K} AS k FROM events WHERE event_type = 'click') e LEFT JOIN p USING (user_id, k)"""
)
def keyed_pair_last_wins(spark, folder):
    """Clicks with the last purchase of the same user and key."""
    events = table(spark, folder, "events", "event_id", "user_id", "event_type", "props")
    keyed = events.withColumn("k", F.from_json("props", "k bigint")["k"])
    clicks = keyed.filter("event_type = 'click'").select("event_id", "user_id", "k")
    purchases = keyed.filter("event_type = 'purchase'").select("user_id", "k", "event_id")
    return units.pair_by_key(clicks, purchases, ["user_id", "k"], "event_id", "event_id")


@query(
    """SELECT r_regionkey, string_agg(n_name, '|' ORDER BY n_nationkey) AS children, count(*)::BIGINT AS n
       FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey"""
)
def parent_children(spark, folder):
    """Ordered children of each parent (a fixed, small table)."""
    nations = table(spark, folder, "nation")
    kids = units.children(nations, "n_regionkey", "n_nationkey", "n_name")
    return kids.select(
        F.col("n_regionkey").alias("r_regionkey"), F.array_join("children", "|").alias("children"), F.size("children").cast("long").alias("n")
    )


@query(
    """WITH RECURSIVE n AS (
      SELECT 'r' || r_regionkey AS id, NULL::VARCHAR AS parent, r_regionkey::BIGINT AS o FROM region
      UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_nationkey FROM nation
      UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_custkey FROM customer),
    t AS (SELECT id, 0 AS depth, [o] AS path FROM n WHERE parent IS NULL
      UNION ALL SELECT n.id, t.depth + 1, list_append(t.path, n.o) FROM n JOIN t ON n.parent = t.id)
    SELECT id, depth, row_number() OVER (ORDER BY path)::BIGINT AS position FROM t"""
)
def tree_flatten(spark, folder):
    """Pre-order position and depth of the region / nation / customer tree; both are null for a row below no region."""
    def node(kind, key, up, parent):
        above = F.concat(F.lit(up), F.col(parent).cast("string")) if up else F.lit(None).cast("string")
        return [F.concat(F.lit(kind), F.col(key).cast("string")).alias("id"), above.alias("parent"), F.col(key).cast("long").alias("o")]

    nodes = (
        table(spark, folder, "region").select(*node("r", "r_regionkey", None, None))
        .unionByName(table(spark, folder, "nation").select(*node("n", "n_nationkey", "r", "n_regionkey")))
        .unionByName(table(spark, folder, "customer", "c_custkey", "c_nationkey").select(*node("c", "c_custkey", "n", "c_nationkey")))
    )
    flat = units.flatten_tree(nodes, "id", "parent", "o", unreached=True)
    # Buckets follow the path: region, nation, then a range of customers.
    at = lambda i: F.coalesce(F.get("path", F.lit(i)), F.lit(-1))
    bucket = F.struct(at(0), at(1), F.floor(at(2) / 100_000))
    placed = ordered_scan(flat.filter("path IS NOT NULL"), [], bucket, ["path"], RowNumber("position")).select("id", "depth", "position")
    return placed.unionByName(flat.filter("path IS NULL").select("id", "depth", F.lit(None).cast("long").alias("position")))


@query(
    """WITH s AS (SELECT p_partkey, replace(p_name, ' ', '-') AS base FROM part),
    r AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY p_partkey) AS k FROM s)
    SELECT p_partkey, CASE WHEN k = 1 THEN base ELSE base || '-' || k END AS unique_slug FROM r"""
)
def unique_slug_suffix(spark, folder):
    """Unique slugs of the part names, few and hot."""
    parts = table(spark, folder, "part", "p_partkey", "p_name").withColumn("base", tx.slugify_words(F.col("p_name")))
    return units.unique_slugs(parts, [], "base", "p_partkey", id_bucket("p_partkey")).select("p_partkey", "unique_slug")


_CAPTION_LINES = """SELECT o_custkey AS page, o_orderkey AS pos, CASE o_orderstatus WHEN 'F' THEN 'Table ' || o_orderkey || '.' || (o_orderkey % 7) || ' ' || o_orderpriority
    WHEN 'O' THEN 'figure ' || o_orderkey || ': ' || o_orderpriority ELSE CASE WHEN o_orderkey % 5 = 0 THEN 'Chapter ' || o_orderkey ELSE o_orderpriority END END AS line FROM orders"""


@query(
    f"""WITH l AS ({_CAPTION_LINES}), n AS (SELECT *, lead(line) OVER (PARTITION BY page ORDER BY pos) AS nxt FROM l)
    SELECT page, pos, split_part(line, ' ', 1) AS label_type, regexp_extract(line, '([0-9]+([.-][0-9A-Za-z]+)*)', 1) AS number,
      CASE WHEN nxt IS NULL OR nxt LIKE 'Table %' OR nxt LIKE 'figure %' OR nxt LIKE 'Chapter %' THEN line ELSE line || ' ' || nxt END AS text_en
    FROM n WHERE line LIKE 'Table %' OR line LIKE 'figure %'"""
)
def order_captions(spark, folder):
    """Captions among page lines built from orders (page = customer)."""
    orders = table(spark, folder, "orders", "o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", spread="o_orderkey")
    key = F.col("o_orderkey").cast("string")
    line = (
        F.when(
            F.col("o_orderstatus") == "F",
            F.concat(F.lit("Table "), key, F.lit("."), (F.col("o_orderkey") % 7).cast("string"), F.lit(" "), "o_orderpriority"),
        )
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("figure "), key, F.lit(": "), "o_orderpriority"))
        .when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("Chapter "), key))
        .otherwise(F.col("o_orderpriority"))
    )
    lines = orders.select(F.col("o_custkey").alias("page"), F.col("o_orderkey").alias("pos"), line.alias("line"))
    return units.find_captions(lines, [], "page", "pos", "line", width=1_000_000)


@query(
    """WITH c AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey AS v, 'captions' AS part FROM lineitem WHERE l_returnflag = 'R'
      UNION ALL SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey, 'images' FROM lineitem WHERE l_returnflag = 'A')
    SELECT o_orderkey, 'page' AS part, 0::BIGINT AS position, NULL::VARCHAR AS value FROM orders
    UNION ALL SELECT l_orderkey, part, row_number() OVER (PARTITION BY l_orderkey, part ORDER BY l_linenumber, v), l_linenumber || ':' || v
      FROM c WHERE l_orderkey IN (SELECT o_orderkey FROM orders)"""
)
def page_payload(spark, folder):
    """Orders as pages with their returned lines as captions and accepted ones as images."""
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    lines = lines.withColumnRenamed("l_orderkey", "o_orderkey")

    def part(flag, key):
        rows = lines.filter(F.col("l_returnflag") == flag).select("o_orderkey", "l_linenumber", F.col(key).alias("v")).distinct()
        return rows, F.concat_ws(":", F.col("l_linenumber").cast("string"), F.col("v").cast("string"))

    return units.page_payload(
        table(spark, folder, "orders", "o_orderkey"), "o_orderkey",
        {"captions": part("R", "l_partkey"), "images": part("A", "l_suppkey")},
        F.struct("l_linenumber", F.floor(F.col("v") / 100_000)), ["l_linenumber", "v"],
    )


@query(
    """SELECT conv_id, turn, '<!-- pdf_page: ' || turn || ' -->' || chr(10) || chr(10) || trim(text, ' ' || chr(10) || chr(9) || chr(13)) || chr(10) AS chunk,
       trim(text, ' ' || chr(10) || chr(9) || chr(13)) = '' AS is_empty FROM conversations"""
)
def unit_source_text(spark, folder):
    """Source text of each conversation as ordered page rows."""
    turns = table(spark, folder, "conversations", "conv_id", "turn", "text")
    return units.source_text(turns, ["conv_id"], "turn", "text")


@query(
    """SELECT conv_id, sum(length(trim(text, ' ' || chr(10) || chr(9) || chr(13))))::BIGINT AS chars, count(*)::BIGINT AS pages,
       min(turn) AS first_page, max(turn) AS last_page FROM conversations GROUP BY conv_id"""
)
def unit_source_stats(spark, folder):
    """Characters, pages and page range of each unit."""
    turns = table(spark, folder, "conversations", "conv_id", "turn", "text")
    return turns.groupBy("conv_id").agg(
        F.sum(F.length(tx.strip(F.col("text")))).cast("long").alias("chars"),
        F.count(F.lit(1)).alias("pages"),
        F.min("turn").alias("first_page"),
        F.max("turn").alias("last_page"),
    )


@query(
    """WITH h AS (SELECT p_partkey, p_brand, p_name || ' ' || (p_partkey % 300) AS heading FROM part),
    s AS (SELECT p_brand, min(p_partkey) AS section_key, regexp_replace(p_name, '[^a-z]', '', 'g') AS form FROM part WHERE p_size <= 25 GROUP BY ALL)
    SELECT p_partkey, 'section-' || section_key AS section_slug FROM h LEFT JOIN s ON s.p_brand = h.p_brand
      AND s.form = regexp_replace(heading, '[^a-z]', '', 'g')"""
)
def heading_sections(spark, folder):
    """Headings matched to the first section of their unit that reads the same."""
    parts = table(spark, folder, "part", "p_partkey", "p_brand", "p_name", "p_size")
    heads = parts.select(
        "p_partkey", "p_brand", F.concat(F.upper("p_name"), F.lit(" "), (F.col("p_partkey") % 300).cast("string")).alias("heading")
    )
    sections = parts.filter("p_size <= 25").select(
        "p_brand", "p_partkey", F.concat(F.lit("section-"), F.col("p_partkey").cast("string")).alias("slug"), "p_name"
    ).withColumnRenamed("p_partkey", "rank")
    return units.match_headings(heads, sections, ["p_brand"], "heading", ["p_name"], "rank").select("p_partkey", "section_slug")


_LINE_NUMBER = "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)"
_OUTLINE_SQL = f"""WITH o AS (SELECT o_custkey AS book, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, o_orderpriority AS title, NULL::INTEGER AS page FROM orders),
    l AS (SELECT o.book, o.n, {_LINE_NUMBER} AS m, 'Part ' || l_partkey AS title, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber END AS page FROM lineitem JOIN o ON o.k = l_orderkey),
    i AS (SELECT book, 0 AS n, 0 AS m, 0 AS level, c_name AS title, c_nationkey AS page FROM customer JOIN (SELECT DISTINCT book FROM o) ON book = c_custkey
      UNION ALL SELECT book, n, 0, 1, title, page FROM o UNION ALL SELECT book, n, m, 2, title, page FROM l),
    s AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY n, m) AS seq FROM i),
    d AS (SELECT *, 'outline-' || lpad(seq::VARCHAR, greatest(4, length(seq::VARCHAR))::INTEGER, '0') AS id FROM s)
    SELECT d.book, d.seq, d.id, p.id AS parent_id, d.level, d.title AS title_en, d.page AS pdf_page FROM d LEFT JOIN d p ON p.book = d.book AND p.level = d.level - 1
      AND p.n = CASE d.level WHEN 2 THEN d.n ELSE 0 END AND p.m = 0"""


@query(_OUTLINE_SQL)
def outline_flatten(spark, folder):
    """Outline of every customer's book, read from nested lists: the customer, its orders, their items."""
    def entry(title, page):
        return F.to_json(F.struct(title.alias("title"), page.cast("string").alias("page")))

    def listed(parts):
        return F.concat(F.lit("["), F.array_join(parts, ","), F.lit("]"))

    def ordered(*by):
        return F.transform(F.sort_array(F.collect_list(F.struct(*by, "json"))), lambda x: x["json"])

    order = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    items = table(spark, folder, "lineitem", "l_orderkey", "l_returnflag", *order)
    page = F.when(F.col("l_returnflag") == "R", F.lit("none")).otherwise(F.col("l_linenumber").cast("string"))
    items = items.withColumn("json", entry(F.concat(F.lit("Part "), F.col("l_partkey").cast("string")), page))
    items = items.groupBy("l_orderkey").agg(listed(ordered(*order)).alias("items"))
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderpriority").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    head = entry(F.col("o_orderpriority"), F.lit(None).cast("string"))
    orders = orders.withColumn("json", F.concat_ws(",", head, "items")).groupBy("o_custkey").agg(listed(ordered("o_orderkey")).alias("orders"))
    books = table(spark, folder, "customer", "c_custkey", "c_name", "c_nationkey").join(orders, F.col("c_custkey") == F.col("o_custkey"))
    outline = listed(F.array(entry(F.col("c_name"), F.col("c_nationkey")), "orders"))
    found, _ = units.flatten_outline(books.select(F.col("c_custkey").alias("book"), outline.alias("outline")), "book", "outline")
    return found


_SECTIONS_SQL = """WITH s AS (SELECT p_partkey, (p_partkey % 9 + 1) || '.' || p_size AS number, p_brand, p_type, p_size,
      'section-' || (p_partkey % 9 + 1) || '-' || p_size AS slug, CASE WHEN p_retailprice < 905 THEN p_name ELSE (p_partkey % 9 + 1) || '.' || p_size || ' ' || upper(left(p_name, 1)) || substr(p_name, 2) END AS title_en, p_name FROM part),
    a AS (SELECT slug, min(CASE WHEN p_brand < 'Brand#15' THEN number || ' ' || p_type WHEN p_brand < 'Brand#2' THEN number || ' ' || '章 ' || p_type ELSE '第' || p_size || '章' END) AS t FROM s WHERE p_type < 'P' GROUP BY slug),
    b AS (SELECT title_en, min('题 ' || p_type) AS t FROM s WHERE p_size < 25 GROUP BY title_en),
    c AS (SELECT p_name AS words, min('译 ' || p_type) AS t FROM part WHERE p_name LIKE 's%' OR p_name LIKE '%r' GROUP BY p_name),
    j AS (SELECT s.*, a.t AS ta, b.t AS tb, c.t AS tc, regexp_extract(s.title_en, '\\A([A-Z]?[0-9]*(?:\\.[0-9]+)+|[A-Z]\\.[0-9]+)\\s+(.+)\\z', 1) AS pre
      FROM s LEFT JOIN a USING (slug) LEFT JOIN b ON b.title_en = s.title_en LEFT JOIN c ON c.words = s.p_name),
    k AS (SELECT *, ta IS NOT NULL AND starts_with(ta, number) AS fits, tc IS NULL OR regexp_matches(ta, '[\\x{4e00}-\\x{9fff}]') AS cjk FROM j)
    SELECT p_partkey, slug, title_en,
      CASE WHEN fits AND cjk THEN ta WHEN ta IS NULL AND tb IS NOT NULL THEN tb WHEN tc IS NOT NULL THEN CASE pre WHEN '' THEN '' ELSE pre || ' ' END || tc ELSE title_en END AS title,
      CASE WHEN fits AND cjk THEN 'slug' WHEN ta IS NULL AND tb IS NOT NULL THEN 'title' WHEN tc IS NOT NULL THEN 'common' ELSE 'english' END AS source,
      CASE WHEN ta IS NOT NULL AND NOT fits THEN 'wrong number' WHEN ta IS NOT NULL AND NOT cjk THEN 'untranslated' END AS rejected FROM k"""


@query(_SECTIONS_SQL)
def section_titles(spark, folder):
    """Titles of the parts as sections, from maps that know some slugs, some titles and some words, partly wrongly."""
    number = F.concat((F.col("p_partkey") % 9 + 1).cast("string"), F.lit("."), F.col("p_size").cast("string"))
    name = F.concat(F.upper(F.substring("p_name", 1, 1)), F.expr("substr(p_name, 2)"))
    parts = table(spark, folder, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", number.alias("number"),
        F.concat(F.lit("section-"), F.replace(number, F.lit("."), F.lit("-"))).alias("slug"),
        F.when(F.col("p_retailprice") < 905, F.col("p_name")).otherwise(F.concat_ws(" ", number, name)).alias("title_en"),
    )
    shown = (
        F.when(F.col("p_brand") < "Brand#15", F.concat_ws(" ", "number", "p_type"))
        .when(F.col("p_brand") < "Brand#2", F.concat_ws(" ", F.col("number"), F.lit("章"), F.col("p_type")))
        .otherwise(F.concat(F.lit("第"), F.col("p_size").cast("string"), F.lit("章")))
    )
    by_slug = parts.filter("p_type < 'P'").select("slug", shown.alias("title"))
    by_title = parts.filter("p_size < 25").select("title_en", F.concat_ws(" ", F.lit("题"), "p_type").alias("title"))
    common = parts.filter("p_name LIKE 's%' OR p_name LIKE '%r'").select(F.col("p_name").alias("words"), F.concat_ws(" ", F.lit("译"), "p_type").alias("title"))
    return units.section_titles(parts.select("p_partkey", "slug", "title_en"), by_slug, by_title, common, ["p_partkey"])
