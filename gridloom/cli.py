"""Command lines: ``python -m gridloom.cli grid ROOT`` and ``python -m gridloom.cli registry --csv LIST --root FOLDER``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from gridloom.params import GridParams, RegistryParams


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="gridloom")
    kinds = top.add_subparsers(dest="kind", required=True)
    grid = kinds.add_parser("grid", help="word tables to blocks, cells, tokens and a review list")
    grid.add_argument("root")
    grid.add_argument("--outdir", default="grid")
    grid.add_argument("--overwrite", action="store_true")
    grid.add_argument("--row-tolerance", type=float, default=0.45)
    grid.add_argument("--block-gap", type=float, default=3.0)
    grid.add_argument("--support", type=float, default=0.30)
    grid.add_argument("--max-cols", type=int, default=20)
    grid.add_argument("--column-cuts", default="", help="shares of the page width, separated by commas")
    grid.add_argument("--review-conf", type=float, default=40.0)
    grid.add_argument("--overlays", action="store_true", help="draw on control/page<number>_prepared.png")
    grid.add_argument("--workbooks", action="store_true", help="write the tables as workbooks, too")
    registry = kinds.add_parser("registry", help="a work-list of texts to fields and reports")
    registry.add_argument("--csv", required=True)
    registry.add_argument("--sep", default=";")
    registry.add_argument("--root", default=".")
    registry.add_argument("--results", default="registry_results")
    registry.add_argument("--cache-dir", help="folder of result caches (*_cache.csv) of earlier runs; their documents are done")
    registry.add_argument("--portion", type=int, default=RegistryParams.portion)
    registry.add_argument("--out", default="registry_report")
    registry.add_argument("--skipped-out", default="registry_skipped")
    return top


def main(args: Sequence[str] | None = None) -> int:
    """0, or 1 if a folder failed; faulty parameters end with a message, as they do for any command line."""
    from gridloom.plans import grid, registry
    from gridloom.sources import files

    top = parser()
    a = top.parse_args(args)
    try:
        if a.kind == "grid":
            params = GridParams(a.row_tolerance, a.block_gap, a.support, a.max_cols, GridParams.cuts_of(a.column_cuts), a.review_conf, a.overwrite, a.overlays, a.workbooks)
        else:
            params = RegistryParams(sep=a.sep, portion=a.portion)
    except ValueError as e:
        top.error(str(e))
    spark = SparkSession.builder.appName(f"gridloom {a.kind}").getOrCreate()
    if a.kind == "grid":
        try:
            summary = grid.run_grid(spark, a.root, a.outdir, params)
        except ValueError as e:
            top.error(str(e))
        counts = {r["status"]: r["count"] for r in summary.groupBy("status").count().collect()}
    else:
        caches = sorted(files.joined(a.cache_dir, n) for n, inner in files.names_in(a.cache_dir) if not inner and n.endswith("_cache.csv")) if a.cache_dir else []
        counts = {r["status"]: r["n"] for r in registry.run_and_report(spark, a.csv, a.root, a.results, a.out, a.skipped_out, params, caches).collect()}
    print(", ".join(f"{k}: {v}" for k, v in sorted(counts.items())))
    return int(a.kind == "grid" and "error" in counts)


if __name__ == "__main__":
    raise SystemExit(main())
