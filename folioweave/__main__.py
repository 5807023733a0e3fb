"""``spark-submit -m folioweave COMMAND ...``: convert papers, list unfinished ones, ask the corpus, report costs."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="folioweave")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("convert", help="papers of a folder to Markdown rows")
    p.add_argument("folder")
    p.add_argument("out")
    p.add_argument("--kind", default="auto", choices=("auto", "md", "json", "jsonl"))
    p = sub.add_parser("query", help="one registered query, as Parquet or JSON lines")
    p.add_argument("name")
    p.add_argument("data")
    p.add_argument("out")
    p.add_argument("--json", action="store_true")
    p = sub.add_parser("ask", help="a question set (JSON list) over the corpus tables of a data folder")
    p.add_argument("questions")
    p.add_argument("data")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"folioweave {args.command}").getOrCreate()
    try:
        if args.command == "convert":
            from folioweave.sources import files

            files.scan_papers(spark, args.folder, args.kind).write.mode("overwrite").parquet(args.out)
        elif args.command == "query":
            from folioweave.queries import core
            from folioweave.sources import files

            df = core.QUERIES[args.name](spark, args.data)
            files.write_jsonl(df, args.out) if args.json else df.write.mode("overwrite").parquet(args.out)
        else:
            from folioweave.plans import ask
            from folioweave.queries import corpus as q

            with open(args.questions, encoding="utf-8") as f:
                questions = json.load(f)
            answered = ask.answers(questions, q.catalog(spark, args.data), q.cards(spark, args.data), q.rows(spark, args.data), q.entities(spark, args.data))
            for row in answered.collect():  # one row per question
                print(json.dumps(row.asDict(), ensure_ascii=False))
    except Exception as e:  # noqa: BLE001 - the exit code tells the caller
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
