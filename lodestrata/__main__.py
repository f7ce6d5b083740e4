"""``python -m lodestrata list`` and ``python -m lodestrata run QUERY TABLES OUT``: runs a catalogued query into Parquet."""

from __future__ import annotations

import argparse


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lodestrata")
    sub = p.add_subparsers(dest="verb", required=True)
    sub.add_parser("list")
    run = sub.add_parser("run")
    for a in ("query", "tables", "out"):
        run.add_argument(a)
    a = p.parse_args(argv)
    from .plans import catalog

    known = catalog.queries()
    if a.verb == "list":
        print("\n".join(sorted(known)))
        return 0
    if a.query not in known:
        p.error(f"unknown query {a.query}")
    from .session import build_session

    spark = build_session()
    known[a.query](spark, a.tables).write.mode("overwrite").parquet(a.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
