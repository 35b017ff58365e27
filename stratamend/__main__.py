"""python -m stratamend: list, ddl, inspect, export, load, watch and bench over a paged file."""

from __future__ import annotations

import argparse


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="stratamend")
    p.add_argument("command", choices=["list", "ddl", "inspect", "export", "load", "watch", "bench"])
    p.add_argument("path", nargs="?", help="the paged file")
    p.add_argument("--table", action="append", help="a table; all tables without it")
    p.add_argument("--to", help="folder for exports and tables")
    p.add_argument("--state", help="folder for the feed's state")
    p.add_argument("--interval", type=float, default=5.0, help="seconds between polls")
    p.add_argument("--cycles", type=int, help="polls before it ends")
    p.add_argument("--tenant", help="leave change sets for this tenant's gateway instead of merging them")
    a = p.parse_args(args)
    if a.command == "bench":
        from bench import main as bench

        bench()
        return 0
    if not a.path:
        p.error("the path of a paged file is needed")
    from .sources.pagefile import PageFile

    if a.command in ("list", "ddl", "inspect", "export"):
        with PageFile(a.path) as f:
            names = a.table or f.tables()
    if a.command in ("list", "ddl"):
        if a.command == "list":
            print(*names, sep="\n")
        else:
            from .plans.load import table_ddl

            print(*(table_ddl(a.path, t) for t in names), sep="\n\n")
        return 0
    from pyspark.sql import SparkSession

    from .plans import load
    from .plans.state import StateStore

    spark = SparkSession.builder.appName("stratamend").getOrCreate()
    state = StateStore(spark, a.state) if a.state else None
    if a.command == "inspect":
        from pyspark.sql import functions as F

        from .operators.versions import flag_columns

        for t in names:
            rows = load.read_slots(spark, a.path, t).select("*", *flag_columns(F.col("flags"))).orderBy("page", "slot")
            print(f"table {t}", *rows.columns, sep="\t")
            for row in rows.toLocalIterator():
                print(t, *("" if x is None else x for x in row), sep="\t")
        return 0
    if not a.to:
        p.error("--to is needed")
    if a.command == "export":
        for t in names:
            load.export_copy(load.read_table(spark, a.path, t), f"{a.to}/{t.lower()}")
        return 0
    if a.command == "load":
        done = load.load_tables(spark, a.path, a.table, a.to, state)
        done.show(1000, False)
        load.report(done).show(truncate=False)
        return int(not done.where("status = 'FAILED'").isEmpty())
    from .streaming.feed import ChangeFeed, LandingSink, TableSink

    sink = LandingSink(spark, a.to, a.tenant) if a.tenant else TableSink(spark, a.to)
    ChangeFeed(spark, a.path, sink, state or StateStore(spark, f"{a.to}/_state"), a.table).watch(a.interval, a.cycles)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
