"""Refresh of rendered pages by their change set.

A page shows more than its own text: its neighbours and the titles of the pages it refers to.  The first pass
collects one index row per page; the second takes a fingerprint of everything a page shows, its text as a digest.
Only pages whose fingerprint is not the stored one are rendered, and the result equals a full rendering.  Index
rows and digests are shuffled; a text travels only if its page is rendered.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import text as tx
from quirework.operators.book import link, navigation
from quirework.plans.ordered import Following, Previous, ordered_scan
from quirework.session import materialize

SAME, CHANGED, ADDED, REMOVED = "same", "changed", "added", "removed"
STORED = ("slug", "fingerprint")


def page_fingerprints(
    pages: DataFrame, references: DataFrame, book: Sequence[str], order: str, bucket: Column, version: str
) -> DataFrame:
    """(*book, slug, before, after, shown, fingerprint) of ``pages(*book, order, slug, title, body)``.

    ``references(*book, slug, target)`` name pages of the same book by slug; repeats count once, a target that is
    not there is shown without a title.  ``version`` stands for the renderer: a new one makes every page new.
    ``order`` identifies a page within its book, as does its slug, which is never null; a null book is a book like any
    other.  A page without title is named by its slug.
    """
    digest = F.sha1(F.coalesce(F.col("body"), F.lit("\0")))
    index = materialize(pages.select(*book, order, "slug", "title", digest.alias("digest")))
    unit = F.struct("slug", F.coalesce("title", "slug").alias("title"))
    placed = ordered_scan(index, book, bucket, [order], Previous("before", unit), Following("after", unit))

    named = index.select(F.struct(*book, "slug").alias("__target"), F.col("title").alias("__title"))
    asked = references.select(*book, "slug", "target", F.struct(*book, F.col("target").alias("slug")).alias("__target")).distinct()
    shown = asked.join(named, "__target", "left").groupBy(F.struct(*book, "slug").alias("__place")).agg(
        F.sort_array(F.collect_list(F.struct("target", F.col("__title").alias("title")))).alias("shown")
    )
    rows = placed.withColumn("__place", F.struct(*book, "slug")).join(shown, "__place", "left")
    # Null fields are left out of the text; as fields are named, two different pages never give one text.
    told = F.to_json(F.struct(F.lit(version).alias("version"), "digest", "title", "before", "after", "shown"))
    return rows.select(*book, "slug", "before", "after", "shown", F.sha1(told).alias("fingerprint"))


def changes(now: DataFrame, stored: DataFrame, book: Sequence[str]) -> DataFrame:
    """(*book, slug, fingerprint, state) of the pages of ``now`` and ``stored``, both (*book, slug, fingerprint)."""
    place = F.struct(*book, "slug").alias("__place")
    new = now.select(place, F.col("fingerprint").alias("__new"))
    old = stored.select(place, F.col("fingerprint").alias("__old"))
    state = (
        F.when(F.col("__new").isNull(), REMOVED).when(F.col("__old").isNull(), ADDED)
        .when(F.col("__new") == F.col("__old"), SAME).otherwise(CHANGED)
    )
    both = new.join(old, "__place", "full")
    return both.select(*[F.col(f"__place.{k}").alias(k) for k in (*book, "slug")], F.col("__new").alias("fingerprint"), state.alias("state"))


def unit_page(root: str) -> Column:
    """A page: heading, body, the pages it refers to, its neighbours."""
    item = lambda s: F.concat(F.lit("<li>"), link(root, s["target"], F.coalesce(s["title"], s["target"])), F.lit("</li>"))
    listed = F.concat(F.lit('<ul class="references">'), F.array_join(F.transform("shown", item), ""), F.lit("</ul>"))
    head = F.concat(F.lit("<h1>"), tx.escape_html(F.coalesce("title", "slug")), F.lit("</h1>"))
    return F.concat(head, F.coalesce("body", F.lit("")), F.coalesce(listed, F.lit("")), navigation(root))


def delta(
    pages: DataFrame,
    references: DataFrame,
    stored: DataFrame | None,
    book: Sequence[str],
    order: str,
    bucket: Column,
    version: str,
    render: Callable[[], Column],
) -> DataFrame:
    """(*book, slug, fingerprint, state, html) of every page; html only where the page is added or changed.

    ``stored(*book, slug, fingerprint)`` is the last state, None if there is none.  ``render()`` is a
    column over title, body, before, after and shown."""
    prints = materialize(page_fingerprints(pages, references, book, order, bucket, version))
    old = prints.limit(0) if stored is None else stored
    states = materialize(changes(prints, old, book))
    place = F.struct(*book, "slug").alias("__place")
    todo = states.filter(F.col("state").isin(ADDED, CHANGED)).select(place, "state")
    facts = prints.select(place, "before", "after", "shown", "fingerprint").join(todo, "__place")
    made = pages.select(*book, "slug", "title", "body", place).join(facts, "__place")
    rendered = made.select(*book, "slug", "fingerprint", "state", render().alias("html"))
    rest = states.filter(F.col("state").isin(SAME, REMOVED)).withColumn("html", F.lit(None).cast("string"))
    return rendered.unionByName(rest)


def refreshed(found: DataFrame, stored: DataFrame, book: Sequence[str]) -> DataFrame:
    """(*book, slug, fingerprint, html) of the pages there are now: what ``delta`` rendered, and what is ``stored`` of the rest."""
    place = F.struct(*book, "slug").alias("__place")
    same = found.filter(F.col("state") == SAME).select(place)
    kept = stored.select("*", place).join(same, "__place", "left_semi")
    columns = [*book, *STORED, "html"]
    return found.filter(F.col("state").isin(ADDED, CHANGED)).select(*columns).unionByName(kept.select(*columns))
