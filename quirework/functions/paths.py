"""Link and path expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------
SCHEME = r"\A[A-Za-z][A-Za-z0-9+.\-]*:"
AUTHORITY = r"\A(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
# ----------------------------------------------------------------------------------


def host(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, AUTHORITY, 1), F.lit(""))


def percent_decode(value: Column) -> Column:
    """Percent-decoding that keeps ``+`` and stray ``%`` as they are."""
    guarded = F.replace(F.regexp_replace(value, r"%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(guarded), value)


def url_path(url: Column) -> Column:
    """Path part: no scheme, authority, query, fragment or parameters."""
    bare = F.regexp_replace(url, r"[?#][\s\S]*\z", "")
    bare = F.regexp_replace(bare, r"\A(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/]*", "")
    bare = F.regexp_replace(bare, SCHEME, "")
    return F.regexp_replace(bare, r";[^/]*\z", "")


def fragment(url: Column) -> Column:
    return F.regexp_extract(url, r"\A[^#]*#([\s\S]*)\z", 1)


def resolve(path: Column) -> Column:
    """Absolute path with ``.`` and ``..`` segments worked out."""
    kept = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part.isin("", "."), done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def local_target(page_path: Column, reference: Column) -> Column:
    """(path, fragment) a link points to within the site, NULL for anything external.

    ``page_path`` is the absolute path of the page's file.  A target ending in ``/`` or
    without a suffix means its ``index.html``.
    """
    external = reference.rlike(SCHEME) | reference.startswith("//")
    path = percent_decode(url_path(reference))
    mark = percent_decode(fragment(reference))
    folder = F.regexp_replace(page_path, r"[^/]*\z", "")
    joined = F.when(path.startswith("/"), path).otherwise(F.concat(folder, path))
    leaf = F.regexp_extract(joined, r"([^/]*)/*\z", 1)
    indexed = path.endswith("/") | ~leaf.rlike(r"[^.].*\.[^.]+\z|\A[^.]+\.[^.]+\z")
    full = resolve(F.when(indexed, F.concat(joined, F.lit("/index.html"))).otherwise(joined))
    answer = F.struct(
        F.when(path == "", resolve(page_path)).otherwise(full).alias("path"), mark.alias("fragment")
    )
    return F.when(~external & ((path != "") | (mark != "")), answer)


def normalize_path(
    href: Column, own_hosts: Sequence[str] | Callable[[Column], Column], excluded: Sequence[str] = ()
) -> Column:
    """Rooted path of a same-site link without query, fragment and ``.html``; NULL elsewhere.
    ``own_hosts`` lists the site's hosts or tests one."""
    bare = F.regexp_replace(href, r"[?#][\s\S]*\z", "")
    home = bare.isin("", "./", "/")
    own = own_hosts(host(bare)) if callable(own_hosts) else host(bare).isin(*own_hosts)
    foreign = host(bare).isNotNull() & ~own
    path = url_path(bare)
    path = F.coalesce(F.nullif(path, F.lit("")), bare)
    path = F.concat(F.lit("/"), F.regexp_replace(path, r"\A/+|/+\z", ""))
    path = F.regexp_replace(path, r"\.html\z", "")
    kept = F.when(path.isin(*excluded), F.lit(None)).otherwise(path) if excluded else path
    return F.when(href.isNull() | (href == ""), F.lit(None)).when(home, F.lit("/")).when(~foreign, kept)


def import_path(value: Column, root: str) -> Column:
    """Path of a page named by file, address or bare name below ``root``."""
    plain = F.replace(F.trim(value), F.lit("\\"), F.lit("/"))
    home = plain.isin("", "/", "index", "index.html")
    inner = F.regexp_replace(plain, rf"\A/?\Q{root}\E/?", "")
    inner = F.regexp_replace(F.regexp_replace(inner, r"/index\.html\z", ""), r"\.html\z", "")
    return F.when(home, F.lit("/")).otherwise(F.concat(F.lit("/"), F.regexp_replace(inner, r"\A/+|/+\z", "")))


def page_slug(path: Column) -> Column:
    inner = F.replace(F.regexp_replace(path, r"\A/+|/+\z", ""), F.lit("/"), F.lit("-"))
    return F.when(path == "/", F.lit("index")).otherwise(inner)


def site_url(path: Column, root: str) -> Column:
    slug = page_slug(path)
    return F.when(slug == "index", F.lit(f"/{root}/")).otherwise(F.concat(F.lit(f"/{root}/"), slug, F.lit("/")))
