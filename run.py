"""Command line.

    spark-submit run.py a5 --input <trace> --output-dir <results>
    spark-submit run.py report --input <results>/performance [--by-workers]
    spark-submit run.py convert --input <trace>/task_usage --table task_usage --target <folder>
    spark-submit run.py replay --input <trace> --target <folder or kafka> [--start-file 0 --num-files 1]
    spark-submit run.py stream --source <folder or kafka> --output-dir <folder>

Options of a broker are given as `--option kafka.bootstrap.servers=host:port`.
"""

import argparse

from traceops.operators.timing import timing_report, worker_report
from traceops.plans.jobs import JOBS, run_job
from traceops.plans.streams import current_gauges, replay_files, start_all
from traceops.session import session
from traceops.sources.trace import convert_trace, read_timings
from traceops.streaming.counts import await_any
from traceops.streaming.gauges import to_exposition


def arguments(argv=None):
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--shuffle-partitions", type=int, help="for shuffles beyond 2 TB: size / 256 MB")
    commands = parser.add_subparsers(dest="command", required=True)

    for name in JOBS:
        job = commands.add_parser(name, help=JOBS[name].run.__name__.replace("_", " "))
        job.add_argument("--input", required=True, help="folder with one folder per trace table")
        job.add_argument("--output-dir", required=True)
        job.add_argument("--format", choices=["csv", "parquet"], default="csv")
        job.add_argument("--variant", choices=sorted(JOBS[name].variants), help="another form of the analysis")

    report = commands.add_parser("report", help="timing files as a table")
    report.add_argument("--input", required=True)
    report.add_argument("--by-workers", action="store_true")
    report.add_argument("--quickest", type=int, metavar="N", help="the N runs with the least processing time, by workers")

    convert = commands.add_parser("convert", help="a trace table as parquet")
    convert.add_argument("--input", required=True)
    convert.add_argument("--table", required=True)
    convert.add_argument("--target", required=True)
    convert.add_argument("--files", type=int)

    replay = commands.add_parser("replay", help="trace files as events")
    replay.add_argument("--input", required=True)
    replay.add_argument("--target", required=True, help="folder, or kafka")
    replay.add_argument("--kinds", nargs="+", choices=["job", "task"], default=["job", "task"])
    replay.add_argument("--start-file", type=int, default=0)
    replay.add_argument("--num-files", type=int, default=1)
    replay.add_argument("--speed-factor", type=int, default=60)
    replay.add_argument("--rejects", help="folder for broken files and rejected rows; without it a broken file fails the replay")
    replay.add_argument("--waves", type=int, default=1, help="steps along the time; with more than one, files follow each other in time")

    stream = commands.add_parser("stream", help="the four running counts")
    stream.add_argument("--source", required=True, help="folder with job-events and task-events, or kafka")
    stream.add_argument("--output-dir", required=True)
    stream.add_argument("--mode", choices=["complete", "update", "append"], default="update")
    stream.add_argument("--watermark", help='how late events may be, say "1 hour"; bounds the state, and append mode needs it')
    stream.add_argument("--window", help='count by windows of this length, say "10 minutes", and not by single times')
    stream.add_argument("--dead-letters", action="store_true", help="keep events and broken messages as tables too")
    stream.add_argument("--available-now", action="store_true", help="stop when all events are counted")

    for command in (replay, stream):
        command.add_argument("--unit", choices=["s", "ms", "us"], default="s", help="unit of event times")
        command.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    return parser.parse_args(argv)


def place(base, kind):
    return base if base == "kafka" else f"{base.rstrip('/')}/{kind}-events"


def show_all(df):
    df.show(max(df.count(), 1), truncate=False)


def run(spark, args):
    options = dict(o.split("=", 1) for o in getattr(args, "option", []))
    if args.command == "report":
        timings = read_timings(spark, args.input)
        show_all(worker_report(timings, by_time=True, n=args.quickest) if args.quickest
                 else (worker_report if args.by_workers else timing_report)(timings))
    elif args.command == "convert":
        convert_trace(spark, args.input, args.table, args.target, args.files)
    elif args.command == "replay":
        for kind in args.kinds:
            rows = replay_files(spark, args.input, kind, place(args.target, kind), args.start_file, args.num_files,
                                args.speed_factor, args.unit, args.waves, args.rejects and f"{args.rejects}/{kind}", **options)
            print(f"{kind}: rejected rows {rows['rejected'].count()}")
    elif args.command == "stream":
        sources = {kind: place(args.source, kind) for kind in ("job", "task")}
        trigger = {"availableNow": True} if args.available_now else None
        queries = start_all(spark, sources, args.output_dir, args.unit, args.mode, trigger, args.watermark,
                            args.window, args.dead_letters, **options)
        try:
            if not args.available_now:
                await_any(spark)
            for query in queries.values():
                if args.available_now:
                    query.awaitTermination()
        finally:
            for query in queries.values():
                query.stop()
            queries.finish(spark)
        show_all(to_exposition(current_gauges(spark, queries, args.output_dir, args.mode)))
    else:
        for result, path in run_job(spark, args.command, args.input, args.output_dir, args.format,
                                    variant=args.variant).items():
            print(f"{result}: {path}")


def main():
    args = arguments()
    spark = session(f"traceops-{args.command}", shuffle_partitions=args.shuffle_partitions)
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
