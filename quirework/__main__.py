"""Command line: ``python -m quirework build|audit``."""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quirework", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    build = commands.add_parser("build", help="build the pages of a post folder")
    build.add_argument("--posts", required=True)
    build.add_argument("--out", required=True)
    build.add_argument("--site", required=True, help="address of the site, without a final slash")
    build.add_argument("--coercion", choices=("safe", "commas"), default="safe")

    check = commands.add_parser("audit", help="audit a folder of pages")
    check.add_argument("--root", required=True)
    check.add_argument("--page", help="audit one page only, for example chapter-2/index.html")
    check.add_argument("--strict", action="store_true", help="exit with 1 if a hard check fails")
    check.add_argument("--samples", type=int, default=10)

    options = parser.parse_args(argv)

    from quirework.operators import site
    from quirework.session import build_session

    spark = build_session()
    if options.command == "build":
        print(f"built {site.build(spark, options.posts, options.out, options.site, options.coercion)} posts")
        return 0

    found = site.audit_site(spark, options.root, page=options.page)
    report = found.pop("report").first().asDict()
    print(json.dumps(report, indent=2))
    for name, rows in found.items():
        for row in rows.limit(options.samples).collect():
            print(f"  {name}: {json.dumps(row.asDict(), ensure_ascii=False)}")
    return 1 if options.strict and report["status"] != "ready" else 0


if __name__ == "__main__":
    sys.exit(main())
