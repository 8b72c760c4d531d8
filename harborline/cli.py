"""Command line: discover, extract, schemas, reconcile, formulas, query. Exit codes: 0 done, 1 wrong use, 2 findings that block."""

from __future__ import annotations

import argparse
import datetime as dt
import functools
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import entities, estate, gates
from .operators import reconcile as reconciliation
from .session import session
from .sources import contracts, exports, files, sinks

EXTENSIONS = [".csv", ".xlsx", ".xlsm"]


def discover(args) -> int:
    """Sweep the roots and write the probes; 2 if a root or a file failed."""
    spark = session()
    found = files.sweep(spark, args.root, EXTENSIONS, args.skip, args.prune).persist()
    probes = files.probe(files.contents(spark, found.where("path is not null")))
    sinks.write_json(probes, f"{args.out}/probes")
    bad = found.where("error is not null").count() + spark.read.json(f"{args.out}/probes",
        schema=files.PROBE).where("error is not null").count()
    return 2 if bad or found.where("path is not null").isEmpty() else 0


def extract(args) -> int:
    """Read exports, build entities, check all gates, publish all or nothing.

    Each entity is one job: it is written to the run's folder, where no reader
    looks, and the same pass counts for its gates and what its types lost. The
    other gates read what is written. Only after all of them does the pointer
    move. A blocked or partly failed run exits with 2, forced or not; an error
    in any row is an error of its source.
    """
    spark = session()
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    built, verdicts, lost, failed = {}, [], [], []
    for c in contracts.load(args.contracts):
        if c.slug not in entities.BUILDERS:
            continue
        path = exports.local_path(args.drop, c.slug)
        try:
            rows, coerced = exports.read_export(spark, path, c).observed()
            extra = [spark.read.parquet(args.locations)] if c.slug == "inventory" else []
            one = entities.BUILDERS[c.slug](rows, *extra)
            frame, counts = gates.observed(one.frame, one.checks)
            built[c.slug] = one.on(sinks.stage(sinks.stamp(frame, c.slug, path, now), c.slug, args.warehouse, args.run_id))
            verdicts += [gates.told(spark, one.name, one.name, one.checks, counts.get), built[c.slug].duplicates]
            lost += [(c.slug, column, n) for column, n in (coerced.get if coerced else {}).items() if n]
        except Exception as e:
            built.pop(c.slug, None)
            failed.append(f"{c.slug}: {type(e).__name__}: {e}")
    for line in failed:
        print(line, file=sys.stderr)
    if not built:
        return 2
    given = lambda path: spark.read.parquet(path) if path else None
    crossed = entities.cross_checks(built, given(args.items), given(args.precedence), given(args.crosswalk), now)
    whole = functools.reduce(DataFrame.unionByName, verdicts + ([crossed] if crossed is not None else []))
    whole = sinks.stage(whole, "verdicts", args.warehouse, args.run_id)
    exceptions = gates.exceptions(whole)
    for one in built.values():
        if (conflicts := one.conflicts) is not None:
            exceptions = exceptions.unionByName(conflicts, allowMissingColumns=True)
    sinks.stage(exceptions, "exceptions", args.warehouse, args.run_id)
    sinks.stage(spark.createDataFrame(lost, "source string, column string, lost bigint"), "coercions", args.warehouse,
        args.run_id)
    ok = gates.may_publish(whole)
    if ok or args.force:
        sinks.point(spark, args.warehouse, args.run_id)
    return 0 if ok and not failed else 2


def schemas(args) -> int:
    """List the contracts and their columns; 2 if queries disagree about a column's type."""
    told = contracts.load(args.contracts)
    for c in told:
        for col in c.columns:
            print("\t".join([c.slug, col.name, col.dtype, ",".join(col.conflicts)]).rstrip())
    return 2 if any(col.conflicts for c in told for col in c.columns) else 0


def reconcile(args) -> int:
    """Compare query profiles (a Parquet table in the columns of ``reconcile.PROFILE``); 2 if a finding blocks."""
    profiles = session().read.parquet(args.profiles)
    found = reconciliation.findings(profiles).persist()
    estate.finding_order(found, "severity", "kind", "left_label", "right_label",
        "subject").write.mode("overwrite").parquet(f"{args.out}/findings")
    reconciliation.forked_upstreams(profiles).write.mode("overwrite").parquet(f"{args.out}/forks")
    blocked = not found.where("severity = 'blocking'").isEmpty()
    found.unpersist()
    return 2 if blocked else 0


def formulas(args) -> int:
    """Map the formula columns of workbooks below the roots; 2 if one is suspicious."""
    spark = session()
    found = files.sweep(spark, args.root, [".xlsx", ".xlsm"], args.skip, args.prune)
    cells = files.cells(files.contents(spark, found.where("path is not null"))).where("formula is not null")
    estate.formula_map(cells, args.least).write.mode("overwrite").parquet(f"{args.out}/formulas")
    return 0 if spark.read.parquet(f"{args.out}/formulas").where("suspicious").isEmpty() else 2


def query(args) -> int:
    """Run one registered query and write its rows."""
    from .registry import QUERIES

    if args.name not in QUERIES:
        print(f"no query {args.name}; there are: {', '.join(sorted(QUERIES))}", file=sys.stderr)
        return 1
    df = QUERIES[args.name](session(), args.data)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.select(*[F.col(c) for c in df.columns]).show(20, truncate=False)
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("harborline")
    sub = p.add_subparsers(required=True)
    d = sub.add_parser("discover")
    d.add_argument("root", nargs="+")
    d.add_argument("--out", required=True)
    d.add_argument("--skip", nargs="*", default=["~$*"])
    d.add_argument("--prune", nargs="*", default=["archive"])
    d.set_defaults(run=discover)
    e = sub.add_parser("extract")
    for name in ("contracts", "drop", "warehouse", "run-id"):
        e.add_argument(f"--{name}", required=True)
    for name in ("locations", "items", "crosswalk", "precedence"):
        e.add_argument(f"--{name}", help="a Parquet table")
    e.add_argument("--force", action="store_true")
    e.set_defaults(run=extract)
    s = sub.add_parser("schemas")
    s.add_argument("--contracts", required=True)
    s.set_defaults(run=schemas)
    r = sub.add_parser("reconcile")
    r.add_argument("--profiles", required=True)
    r.add_argument("--out", required=True)
    r.set_defaults(run=reconcile)
    f = sub.add_parser("formulas")
    f.add_argument("root", nargs="+")
    f.add_argument("--out", required=True)
    f.add_argument("--least", type=int, default=100, help="formulas that a sheet must have")
    f.add_argument("--skip", nargs="*", default=["~$*"])
    f.add_argument("--prune", nargs="*", default=["archive"])
    f.set_defaults(run=formulas)
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--data", required=True)
    q.add_argument("--out")
    q.set_defaults(run=query)
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    return args.run(args)


if __name__ == "__main__":
    sys.exit(main())
