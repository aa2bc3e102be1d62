"""Job entry points, one per stage, for ``spark-submit``:

    spark-submit sluice/cli.py clean     --source s3a://b/raw/ --staging s3a://b/staging/ --error s3a://b/error/
    spark-submit sluice/cli.py transform --domain provider --staging ... --transform ...
    spark-submit sluice/cli.py validate  --staging ... --required provider_info,penalties
    spark-submit sluice/cli.py moves     --source ... --processed ... --error ... --tracked a,b --status ... --apply --log ...
    spark-submit sluice/cli.py run       --raw ... --staging ... --transform ... --error ... --processed ...

The session comes from ``spark-submit`` (cluster settings win); outside it a
local session is built.  Every command exits non-zero on failure, so a
scheduler can stop the chain.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    if os.environ.get("PYSPARK_GATEWAY_PORT"):  # launched by spark-submit
        return SparkSession.builder.getOrCreate()
    from sluice.session import build_session
    return build_session()


def _csv(value: str) -> list[str]:
    return [v.strip() for v in value.split(",") if v.strip()]


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="sluice")
    sub = parser.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("clean", help="raw CSV domains -> staging Parquet")
    p.add_argument("--source", required=True)
    p.add_argument("--staging", required=True)
    p.add_argument("--error")
    p.add_argument("--domains", type=_csv)
    p.add_argument("--status-out", help="write the status table as JSON lines here, for moves")
    p.add_argument("--as-of")
    p.add_argument("--strict", action="store_true")

    p = sub.add_parser("transform", help="staging -> facet tables")
    p.add_argument("--domain", required=True, choices=["provider", "qualitymsr"])
    p.add_argument("--staging", required=True)
    p.add_argument("--transform", required=True)
    p.add_argument("--error")
    p.add_argument("--as-of")

    p = sub.add_parser("validate", help="required staged domains present (raises otherwise)")
    p.add_argument("--staging", required=True)
    p.add_argument("--required", type=_csv, required=True)
    p.add_argument("--min-rows", type=int, default=0)
    p.add_argument("--as-of", help="also require rows stamped with this date")

    p = sub.add_parser("moves", help="plan raw file moves (dry run report)")
    p.add_argument("--source", required=True)
    p.add_argument("--processed", required=True)
    p.add_argument("--error", required=True)
    p.add_argument("--tracked", type=_csv, required=True)
    p.add_argument("--failed", type=_csv, default=[], help="domains whose cleaning failed: their files go to the error root")
    p.add_argument("--status", help="status table written by clean: domains that failed go to the error root")
    p.add_argument("--out", help="write the plan as Parquet here")
    p.add_argument("--apply", action="store_true", help="move the files, not only plan it")
    p.add_argument("--log", help="log of moves (default: _moves under --processed)")

    p = sub.add_parser("run", help="all stages in order")
    for flag in ("--raw", "--staging", "--transform", "--error", "--processed"):
        p.add_argument(flag, required=True)
    p.add_argument("--as-of")
    p.add_argument("--strict", action="store_true")
    p.add_argument("--listing", help="JSON-lines file listing: id, name, mimeType, modifiedTime")
    p.add_argument("--manifest", help="manifest folder (JSON lines, append-only)")
    p.add_argument("--routes", help="JSON file with a list of [pattern, target folder], first match wins")
    p.add_argument("--default-route", help="target folder of files that no route matches")
    p.add_argument("--folder", help="only listed files under this parent folder id")
    p.add_argument("--detect-changes", action="store_true", help="land a file again when its modifiedTime changed")
    p.add_argument("--landing-root", help="what manifest keys are relative to (default: the parent of --raw)")
    p.add_argument("--dry-run", action="store_true", help="plan only: write nothing")
    p.add_argument("--apply-moves", action="store_true", help="move the cleaned raw files, not only plan it")

    args = parser.parse_args(argv)
    spark = _session()
    from sluice.plans import gates

    if args.cmd == "clean":
        from sluice.plans.clean import clean_all
        status = clean_all(spark, args.source, args.staging, args.error, args.domains,
                           as_of=args.as_of, strict=args.strict)
        status.show(truncate=False)
        if args.status_out:
            status.write.mode("overwrite").json(args.status_out)
        return int(gates.any_failed(status))
    elif args.cmd == "transform":
        from sluice.plans.transform import run_transform
        kwargs = {"as_of": args.as_of}
        if args.domain == "qualitymsr":
            kwargs["error_root"] = args.error
        result = run_transform(spark, args.domain, args.staging, args.transform, **kwargs)
        print(result)
        if getattr(result, "status", "ok") not in ("ok",):
            return 1
    elif args.cmd == "validate":
        from sluice.operators.inventory import require_present
        from sluice.plans.chain import staged_inventory
        require_present(args.required, staged_inventory(spark, args.staging, args.min_rows))
        if args.as_of:
            stale = gates.stale_domains(spark, args.staging, args.required, args.as_of)
            if stale:
                raise gates.DomainFailedError(f"not loaded on {args.as_of}: {stale}")
        print("all required staging domains are populated")
    elif args.cmd == "moves":
        from sluice.operators.inventory import move_plan
        from sluice.sources.files import list_files
        failed = set(args.failed)
        if args.status:
            failed |= {r["domain"] for r in gates.failed_domains(spark.read.schema(gates.STATUS_SCHEMA).json(args.status)).collect()}
        plan = move_plan(list_files(spark, args.source).where("NOT hidden"), args.tracked,
                         args.source, args.processed, args.error, failed=sorted(failed) or None)
        if args.out:
            plan.write.mode("overwrite").parquet(args.out)
        if args.apply:
            from sluice.plans.moves import apply_moves
            log = apply_moves(spark, plan, args.log or f"{args.processed.rstrip('/')}/_moves")
            log.groupBy("status", "outcome").count().show()
        else:
            plan.groupBy("status").count().show()
    elif args.cmd == "run":
        from sluice.plans.chain import RunConfig, run
        listing = None
        if args.listing:
            listing = spark.read.schema("id string, name string, mimeType string, modifiedTime string, "
                                        "parents array<string>").json(args.listing)
        more = {}
        if args.routes:
            routes = spark.read.text(args.routes, wholetext=True).first()["value"]
            more["routes"] = [tuple(r) for r in json.loads(routes)]
        if args.default_route:
            more["default_route"] = args.default_route
        res = run(spark, RunConfig(raw_root=args.raw, staging_root=args.staging,
                                   transform_root=args.transform, error_root=args.error,
                                   processed_root=args.processed, as_of=args.as_of,
                                   strict=args.strict, listing=listing,
                                   manifest_path=args.manifest, dry_run=args.dry_run, folder=args.folder,
                                   detect_changes=args.detect_changes, landing_root=args.landing_root,
                                   apply_moves=args.apply_moves, **more))
        if res.ingest is not None:
            res.ingest.show(truncate=False)
        res.stages.show(1000, truncate=False)
        return int(gates.any_failed(res.stages))
    return 0


if __name__ == "__main__":
    sys.exit(main())
