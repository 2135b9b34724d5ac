"""Readers for document folders."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.functions import markdown as md
from quirework.functions import text as tx
from quirework.session import cut_lineage


def whole_files(spark: SparkSession, folder: str, pattern: str, recursive: bool = False) -> DataFrame:
    """(path, raw): one row per matching file.  A missing folder is an empty table."""
    reader = spark.read.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    try:
        found = reader.text(folder, wholetext=True)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, raw string")
    return found.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))


def html_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``index.html`` below a folder."""
    return whole_files(spark, folder, "index.html", recursive=True)


def json_documents(spark: SparkSession, folder: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Whole-file JSON documents, with a declared schema where one is given."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(folder)


def posts(files: DataFrame, coercion: str = "safe", cover: str = "") -> DataFrame:
    """Posts from Markdown files; a file without front matter is left out.

    ``coercion="commas"`` reads any value with a comma as a list, which the tags rely on
    but which also turns a summary with commas into the printed form of a list;
    ``"safe"`` splits tags only.
    """
    if coercion not in ("safe", "commas"):
        raise ValueError(f"unknown coercion {coercion!r}")
    commas = coercion == "commas"
    stem = F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?\z", 1)
    front = files.filter(md.has_front_matter(F.col("raw"))).withColumn("__m", md.front_matter(F.col("raw"))).withColumn("__stem", stem)

    def field(name: str, default) -> F.Column:
        value = F.try_element_at("__m", F.lit(name))
        return F.coalesce(md.scalar_value(value, commas), default)

    def filled(name: str, default) -> F.Column:
        return F.coalesce(F.nullif(tx.strip(field(name, F.lit(""))), F.lit("")), default)

    tags = F.try_element_at("__m", F.lit("tags"))
    tag_list = (
        F.when(tags.isNull(), F.array().cast("array<string>"))
        .when(md.is_list_value(tags, True), md.list_value(tags))
        .otherwise(F.array(md.unquote(tags)))
    )
    return front.select(
        "path",
        tx.slugify(filled("slug", F.col("__stem"))).alias("slug"),
        field("title", F.col("__stem")).alias("title"),
        filled("date", F.substring("__stem", 1, 10)).alias("date"),
        field("summary", F.lit("")).alias("summary"),
        field("version", F.lit("")).alias("version"),
        tag_list.alias("tags"),
        field("cover", F.lit(cover)).alias("cover"),
        (F.lower(field("draft", F.lit("false"))) == "true").alias("draft"),
        md.body(F.col("raw")).alias("body"),
    )


def page_texts(files: DataFrame, extract: Callable[[bytes], Iterable[str | Exception]]) -> DataFrame:
    """(path, page, text, error) of binary documents (path, content).

    ``extract`` turns the bytes of one document into its pages, each a text or the error that reading it
    gave; it is injected because no document library is assumed.  A bad page is a row with its number and
    error; if the extractor itself fails, the pages before stay and one row without number tells.
    """
    schema = "path string, page int, text string, error string"

    def told(problem: Exception) -> str:
        return f"{type(problem).__name__}: {problem}"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"]):
                try:
                    for n, page in enumerate(extract(bytes(content)), 1):
                        rows.append((path, n, "", told(page)) if isinstance(page, Exception) else (path, n, page or "", None))
                except Exception as problem:
                    rows.append((path, None, "", told(problem)))
            out = pd.DataFrame(rows, columns=["path", "page", "text", "error"])
            yield out.astype({"page": "Int32"})

    return files.select("path", "content").mapInPandas(run, schema)


def image_placements(images: DataFrame) -> DataFrame:
    """Image placements (doc, page, index, name, content) with digest and file name; every
    placement is kept, ``is_first`` marks the one that carries the file."""
    suffix = F.lower(F.regexp_extract("name", r"\.([^.]+)\z", 1))
    marked = images.filter(F.length("content") > 0).withColumn("hash", F.substring(F.sha1("content"), 1, 12))
    named = marked.withColumn(
        "file_name", F.concat(F.lit("image-"), "hash", F.lit("."), F.coalesce(F.nullif(suffix, F.lit("")), F.lit("bin")))
    )
    place = F.struct("doc", "page", "index")
    first = named.groupBy("hash").agg(F.min(place).alias("__first"), F.min_by("file_name", place).alias("__name"))
    joined = named.join(first, "hash")
    return joined.select(
        "doc", "page", "index", "hash", F.col("__name").alias("file_name"), (F.col("__first") == place).alias("is_first"), "content"
    )


def toc_pages(toc: DataFrame, html: str, own_hosts: list[str], allowed: Callable) -> DataFrame:
    """(path, title, pos) of a table of contents' links: normalized, filtered by ``allowed``,
    first occurrence of a path kept."""
    from quirework.functions import html as hx
    from quirework.functions import paths as px

    anchor = F.regexp_extract_all(hx.markup_only(F.col(html)), F.lit(r"(?is)<a\b[^>]*>.*?</a>"), F.lit(0))
    rows = toc.select(F.posexplode(anchor).alias("pos", "__a")).select(
        "pos",
        px.normalize_path(F.get(hx.attribute_values(F.col("__a"), "a", "href"), F.lit(0)), own_hosts).alias("path"),
        hx.node_text(F.col("__a")).alias("title"),
    )
    kept = rows.filter(F.col("path").isNotNull() & (F.col("title") != "") & allowed(F.col("path")))
    return kept.groupBy("path").agg(F.min("pos").alias("pos"), F.min_by("title", "pos").alias("title"))


def layout_blocks(docs: DataFrame) -> DataFrame:
    """Text blocks of nested layout documents (path, pages): (path, page, pos, type, text,
    size, x0, y0, x1, y1)."""
    pages = docs.select("path", F.explode("pages").alias("p"))
    blocks = pages.select("path", F.col("p.page").alias("page"), F.posexplode("p.blocks").alias("pos", "b"))
    box = [F.coalesce(F.get("b.bbox", F.lit(i)), F.lit(0.0)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]
    return blocks.select("path", "page", "pos", "b.type", "b.text", "b.size", *box)


def layout_drawings(docs: DataFrame) -> DataFrame:
    """Drawings of nested layout documents: (path, page, drawing_id, x0, top, x1, bottom)."""
    pages = docs.select("path", F.explode("pages").alias("p"))
    found = pages.select("path", F.col("p.page").alias("page"), F.posexplode("p.drawings").alias("drawing_id", "d"))
    box = [F.get("d.bbox", F.lit(i)).alias(n) for i, n in enumerate(("x0", "top", "x1", "bottom"))]
    return found.select("path", "page", "drawing_id", *box)


def harvest_titles(docs: DataFrame, document: str) -> DataFrame:
    """(path, title_en, title_zh) pairs found anywhere in JSON documents: objects with both
    titles, and keys in Latin script whose value is a text in Chinese script.  One level of
    nesting per round, until nothing is nested any more; each round's rows are stored."""
    spark = docs.sparkSession
    level = docs.select("path", F.try_parse_json(document).alias("v")).filter("v IS NOT NULL")
    english, chinese = F.lit("[A-Za-z]"), F.lit(tx.CJK)
    found = None

    def text(column: str, name: str):
        return F.try_variant_get(column, f"$['{name}']", "string")

    while True:
        pairs = [(text("v", "title_en"), F.coalesce(text("v", "title_zh"), text("v", "zh"))), (text("v", "English"), F.coalesce(text("v", "Chinese"), text("v", "简体中文")))]
        both = level.select("path", F.explode(F.array(*[F.struct(a.alias("title_en"), b.alias("title_zh")) for a, b in pairs])).alias("t"))
        named = both.select("path", "t.title_en", "t.title_zh").filter("title_en IS NOT NULL AND title_zh IS NOT NULL")
        level = level.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("path", "key", F.col("value").alias("v"))
        leaf = level.select("path", F.col("key").alias("title_en"), F.try_variant_get("v", "$", "string").alias("title_zh"), F.schema_of_variant("v").alias("kind"))
        leaf = leaf.filter((F.col("kind") == "STRING") & F.regexp("title_en", english) & F.regexp("title_zh", chinese)).drop("kind")
        found = named.unionByName(leaf) if found is None else found.unionByName(named).unionByName(leaf)
        level = cut_lineage(level.select("path", "v").filter(F.schema_of_variant("v").rlike("^(OBJECT|ARRAY)")))
        if level.isEmpty():
            break
    clean = found.select("path", tx.clean_text(F.col("title_en")).alias("title_en"), tx.clean_text(F.col("title_zh")).alias("title_zh"))
    return clean.distinct()


def heading_titles(pages: DataFrame, html: str, order: str) -> DataFrame:
    """(id, title) of translated section headings; the first page that has an id wins."""
    from quirework.functions import html as hx
    from quirework.functions import rules as rx

    rows = pages.select(order, F.posexplode(hx.headings(F.col(html))).alias("pos", "h")).select(
        order, "pos", F.col("h")["id"].alias("id"), F.col("h")["text"].alias("title")
    )
    named = F.col("id").startswith("section-") | F.col("id").startswith("references")
    kept = rows.filter(named & F.col("title").rlike(tx.CJK) & ~rx.is_rendered_header(F.col("title")))
    return kept.groupBy("id").agg(F.min_by("title", F.struct(order, "pos")).alias("title"))


def rewrite_links(pages: DataFrame, mapping: DataFrame, key: str, html: str, own_hosts: list[str]) -> DataFrame:
    """Pages with same-site links replaced by local addresses (mapping: path, local_path).

    Links become rows, meet the mapping in one equality join, and are put back in place;
    fragments stay, unknown and foreign links are left alone."""
    from quirework.functions import fragments as fr
    from quirework.functions import paths as px

    pattern = r"(?is)(?<=href=[\"'])[^\"'#][^\"']*(?=[\"'])"
    found = pages.select(key, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(0))).alias("pos", "href"))
    target = found.withColumn("path", px.normalize_path(F.col("href"), own_hosts))
    mark = px.fragment(F.col("href"))
    local = F.concat("local_path", F.when(mark != "", F.concat(F.lit("#"), mark)).otherwise(F.lit("")))
    joined = target.join(mapping.select("path", "local_path"), "path", "left").withColumn("new", F.coalesce(local, F.col("href")))
    packed = joined.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "new"))), lambda s: s["new"]).alias("__new"))
    stitched = fr.stitch(F.split(F.col(html), pattern), F.col("__new"))
    return pages.join(packed, key, "left").withColumn(html, F.coalesce(stitched, F.col(html))).drop("__new")


def guide_sample(units: DataFrame, page: str, src: str, order: list[str], count: int = 700, chars: int = 90_000) -> DataFrame:
    """Opening sample of a book for its guide: the first units, cut to a fixed length."""
    from quirework.operators.corpus import newest

    first = newest(units.select(page, src, *[c for c in order if c not in (page, src)]), count, [F.asc(c) for c in order])
    entry = F.concat(F.lit("[p"), F.col(page).cast("string"), F.lit("] "), F.col(src))
    packed = F.sort_array(F.collect_list(F.struct("rank", entry.alias("e"))))
    return first.agg(F.substring(F.array_join(F.transform(packed, lambda s: s["e"]), "\n\n"), 1, chars).alias("sample"))
