"""Command line: run the whole procedure, or one query, on Spark.

    spark-submit -m ledgerline pipeline --input /data/retail_tpch --out s3://bucket/runs/2026-12-03
    spark-submit -m ledgerline query customer_analysis --input /data/retail_tpch --out s3://bucket/q
    python -m ledgerline usage --scripts "/sql/procs/*.sql" [--out /reports/usage]
    python -m ledgerline pipeline --input /root/testdata/sf0.01 --master local[8]

``--input`` is a folder of the test-style parquet tables, or ``--database``
names a catalog database written by ``publish_tables``.  ``--date`` sets the
run date (default: today).
"""

from __future__ import annotations

import argparse
from datetime import datetime


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="ledgerline")
    ap.add_argument("what", choices=["pipeline", "query", "usage"])
    ap.add_argument("name", nargs="?", help="query name (for 'query')")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--input", help="folder with region/nation/customer/... parquet tables")
    src.add_argument("--database", help="catalog database with the retail tables")
    src.add_argument("--scripts", help="(usage) files or glob of SQL scripts")
    ap.add_argument("--out", help="output folder (pipeline: the lasting tables; query: parquet path)")
    ap.add_argument("--date", help="run date YYYY-MM-DD (default: today)")
    ap.add_argument("--master", help="only for local runs, e.g. local[8]")
    args = ap.parse_args(argv)

    from ledgerline.params import RunParams
    from ledgerline.plans.pipeline import run_pipeline
    from ledgerline.plans.registry import QUERIES
    from ledgerline.session import get_session, size_shuffle_partitions
    from ledgerline.sources.testdata import CatalogModel, RetailModel

    spark = get_session(args.master)
    if args.what == "usage":
        _usage(spark, args.scripts, args.out)
        return
    if args.input:
        size_shuffle_partitions(spark, [args.input])
    model = CatalogModel(spark, args.database) if args.database else RetailModel(spark, args.input)
    if args.database:
        size_shuffle_partitions(spark, model.folders())
    when = datetime.strptime(args.date, "%Y-%m-%d") if args.date else None
    params = RunParams.fresh(when)
    if args.what == "pipeline":
        run_pipeline(model, params, out_dir=args.out).show(truncate=False)
    else:
        df = QUERIES[args.name](model, params)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            _show(df, 50)


def _show(df, rows: int) -> None:
    """Print the first rows, and say if there are more."""
    df.show(rows, truncate=False)
    if not df.offset(rows).isEmpty():
        print(f"(only the first {rows} rows; --out writes them all)")


def _usage(spark, scripts_glob: str, out: str | None) -> None:
    """Table-usage inventory of the scripts: every report, shown or written as parquet."""
    from ledgerline.plans import usage

    scripts = usage.read_scripts(spark, scripts_glob)
    refs = usage.references(scripts).cache()
    reports = {
        "table_usage": usage.table_usage(refs), "aliases": usage.alias_lists(refs),
        "type_counts": usage.type_counts(refs), "most_used": usage.most_used(refs),
        "lineage": usage.lineage_edges(refs), "statement_ranges": usage.statement_ranges(scripts, refs),
        "updated_columns": usage.updated_columns(scripts, refs), "merge_actions": usage.merge_actions(scripts, refs),
        "complexity": usage.complexity(refs), "update_counts": usage.update_counts(refs),
    }
    for name, df in reports.items():
        if out:
            df.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{name}")
        else:
            print(f"== {name}")
            _show(df.orderBy(*df.columns[:3]), 200)


if __name__ == "__main__":
    main()
