"""Commands: ``spark-submit`` this module or run ``python -m wxspark <command> --help``."""

from __future__ import annotations

import argparse
from datetime import datetime

from wxspark.constants import ROWS_PER_REGIME
from wxspark.plans import jobs
from wxspark.plans.train import REPLICATES
from wxspark.session import build_session


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="wxspark", description="Generate, train, verify.")
    root.add_argument("--hive", action="store_true", help="use the Hive catalog")
    commands = root.add_subparsers(dest="command", required=True)

    observations = commands.add_parser("generate", help="station observations of a scale preset")
    observations.add_argument("scale", nargs="?", default="million")
    observations.add_argument("--out", default=".")
    observations.add_argument("--format", choices=["csv", "parquet"], default="csv")
    observations.add_argument("--table", help="save as this table of the catalog instead of files")
    observations.add_argument("--anchor", type=datetime.fromisoformat, help="time of id 0; now by default")

    regimes = commands.add_parser("regimes", help="observations of each weather type")
    regimes.add_argument("--out", required=True)
    regimes.add_argument("--rows", type=int, default=ROWS_PER_REGIME, help="per type")
    regimes.add_argument("--format", choices=["csv", "parquet"], default="parquet")

    training = commands.add_parser("train", help="five forests and their hold-out scores")
    training.add_argument("--observations", required=True, help="a .csv folder or a parquet folder")
    training.add_argument("--out", required=True)
    training.add_argument("--cap", type=int, help="draw a sample of this size first")
    training.add_argument("--exact-split", action="store_true")
    training.add_argument("--scale", help="the scale to read of a parquet folder that holds several")
    training.add_argument("--replicates", type=int, default=REPLICATES, help="resampling units of a feature combination")

    training.add_argument("--bootstrap", choices=["replicates", "rows"], default="replicates", help="what the trees resample")
    training.add_argument("--store", help="keep sums here and read only files that are new; all rows train")

    for name, text in (("verify", "landed request files"), ("stream", "request files that keep landing")):
        verification = commands.add_parser(name, help=text)
        verification.add_argument("--requests", required=True, help="JSON lines with id, date and city")
        verification.add_argument("--payloads", required=True, help="JSON lines with city, issued, status and body")
        verification.add_argument("--models", required=True)
        verification.add_argument("--out", required=True)
        verification.add_argument("--fill-defaults", action="store_true", help="absent dates are now, absent cities the first one")
        if name == "stream":
            verification.add_argument("--checkpoint", required=True)
            verification.add_argument("--max-files", type=int, default=10_000, help="per micro-batch")
            verification.add_argument("--wait", action="store_true", help="leave requests waiting whose hour is not known")
            verification.add_argument("--once", action="store_true", help="stop after the files present")

    late = commands.add_parser("answer-late", help="answer the requests that a stream left waiting")
    for name in ("--payloads", "--models", "--out", "--checkpoint"):
        late.add_argument(name, required=True)
    late.add_argument("--wait", default="6 hours", help="how long a request waits for its hour")
    late.add_argument("--lateness", default="10 minutes", help="how far files may be read out of the order of their times")
    late.add_argument("--once", action="store_true", help="stop after the files present")

    timeline = commands.add_parser("timeline", help="seven-day hourly forecast per city")
    timeline.add_argument("--models", required=True)
    timeline.add_argument("--start", type=datetime.fromisoformat, required=True)
    timeline.add_argument("--out", required=True)
    return root


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(hive=args.hive)
    if args.command == "generate":
        anchor = args.anchor or datetime.now()
        jobs.generate_observations(spark, args.scale, args.out, args.format, anchor, args.table)
        jobs.preview_observations(spark, anchor).show(truncate=False)
    elif args.command == "regimes":
        jobs.generate_regimes(spark, args.out, args.rows, args.format)
    elif args.command == "train":
        if args.store:
            scores = jobs.train_appended(spark, args.observations, args.store, args.out)
        else:
            scores = jobs.train_models(
                spark, args.observations, args.out, args.cap, args.exact_split, args.scale, args.replicates, args.bootstrap
            )
        scores.show(truncate=False)
    elif args.command == "verify":
        now = datetime.now() if args.fill_defaults else None
        jobs.verify_requests(spark, args.requests, args.payloads, args.models, args.out, now)
    elif args.command == "stream":
        trigger = {"availableNow": True} if args.once else {}
        jobs.verify_landing_requests(
            spark, args.requests, args.payloads, args.models, args.out, args.checkpoint, args.max_files,
            wait=args.wait, fill_defaults=args.fill_defaults, **trigger,
        ).awaitTermination()
    elif args.command == "answer-late":
        trigger = {"availableNow": True} if args.once else {}
        jobs.verify_waiting_requests(
            spark, args.payloads, args.models, args.out, args.checkpoint, args.wait, args.lateness, **trigger
        ).awaitTermination()
    elif args.command == "timeline":
        jobs.forecast(spark, args.models, args.start, args.out)


if __name__ == "__main__":
    main()
