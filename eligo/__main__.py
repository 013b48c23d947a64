"""Command line: ``python -m eligo ingest ...`` / ``python -m eligo classify ...`` (run under spark-submit on a cluster)."""

from __future__ import annotations

import argparse

from eligo.config import RunConfig, load_config, read_values
from eligo.session import get_spark


def main(argv=None):
    parser = argparse.ArgumentParser(prog="eligo")
    sub = parser.add_subparsers(dest="command", required=True)
    ing = sub.add_parser("ingest", help="clean raw charges into ROOT/charges")
    given = ing.add_mutually_exclusive_group(required=True)
    given.add_argument("--raw", help="Parquet path of raw charges (raw column names)")
    given.add_argument("--csv", nargs="+", help="court CSV files or globs (layout by file name); rows without an id get one")
    ing.add_argument("--root", required=True)
    ing.add_argument("--as-of", default=None, help="drop hearings after this date (default: today)")
    ing.add_argument("--append", action="store_true", help="append instead of a full refresh")
    ing.add_argument("--buckets", type=int, default=None, help="partition charges by this many person buckets")
    ing.add_argument("--person-files", type=int, default=None,
                     help="with --raw: store charges in this many files by ranges of persons, with a Bloom filter on their ids")
    cls = sub.add_parser("classify", help="classify ROOT/charges into a run")
    cls.add_argument("--root", required=True)
    cls.add_argument("--config", default=None, help="YAML/JSON run configuration")
    cls.add_argument("--write-features", action="store_true")
    cls.add_argument("--resumable-buckets", type=int, default=None,
                     help="classify bucket by bucket of persons; a rerun skips finished buckets")
    aud = sub.add_parser("rules", help="which rules of a rule file can never decide, or change no label")
    aud.add_argument("--rules", required=True, help="YAML/JSON file with name, rules and default")
    for p in (ing, cls, aud):
        p.add_argument("--shuffle-partitions", type=int, default=None,
                       help="spark.sql.shuffle.partitions (about input bytes / 256 MB at scale)")
    args = parser.parse_args(argv)
    if args.command == "ingest" and args.csv and args.person_files:
        parser.error("--person-files goes with --raw")

    spark = get_spark()
    if args.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(args.shuffle_partitions))
    if args.command == "ingest":
        from eligo.plans.run import run_ingestion
        if args.csv:
            from eligo.sinks.rejects import load_court_files
            from eligo.sources.rejects import reject_counts
            load, rejects = load_court_files(spark, args.csv, args.root, args.as_of, not args.append, args.buckets)
            reject_counts(rejects).orderBy("source_file", "reason").show(1000, truncate=False)
        else:
            load = run_ingestion(spark.read.parquet(args.raw), args.root, as_of=args.as_of, clear_existing=not args.append,
                                 buckets=args.buckets, person_files=args.person_files)
        if load:
            print(f"loaded {len(load.loaded)} files, {len(load.skipped)} were in already")
    elif args.command == "rules":
        from eligo.operators import rulebook
        rulebook.rule_audit(spark, rulebook.from_mapping(read_values(args.rules))).orderBy("place").show(rulebook.MAX_RULES, truncate=False)
    else:
        from eligo.plans.run import run_classification, run_classification_resumable
        cfg = load_config(args.config) if args.config else RunConfig()
        if args.resumable_buckets:
            run_id = run_classification_resumable(spark, args.root, cfg, buckets=args.resumable_buckets,
                                                  write_features=args.write_features)
        else:
            run_id = run_classification(spark, args.root, cfg, write_features=args.write_features)
        print(run_id)


if __name__ == "__main__":
    main()
