"""Check a JSONL dataset from the command line: ``python -m corpusloom.validate PATH [--max-issues N]``.

The exit status is 0 for a valid dataset, 1 for an invalid one and 2 if it can't be read.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from corpusloom.operators import records


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="corpusloom.validate")
    parser.add_argument("path")
    parser.add_argument("--max-issues", type=int, default=20)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    try:
        lines = records.jsonl_records(spark, args.path)
        found = records.validation_summary(records.validated(lines), args.max_issues).first()
    except (PySparkException, ValueError) as e:
        print(f"cannot check {args.path}: {str(e).splitlines()[0]}", file=sys.stderr)
        return 2
    for issue in found.issues:
        print(f"line {issue.line_number}: {issue.message}")
    print(f"{found.valid} of {found.records} records are valid")
    return 0 if found.ok else 1


if __name__ == "__main__":
    sys.exit(main())
