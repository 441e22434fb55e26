"""Command line: ``python -m tiermill SOURCE ROOT`` or the same through spark-submit."""

from __future__ import annotations

import argparse
import json

from tiermill.plans import medallion
from tiermill.profile import HIGHER_EDUCATION
from tiermill.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="tiermill", description="Landed workbooks to the gold layer.")
    parser.add_argument("source", help="folder with the landed .xlsx files")
    parser.add_argument("root", help="folder for the curated file and the layer tables")
    parser.add_argument("--buckets", type=int, help="bucket fact and entity dimension by entity")
    parser.add_argument("--quarantine", action="store_true", help="keep going on values that do not fit")
    args = parser.parse_args()
    spark = build_session("tiermill")
    policy = "quarantine" if args.quarantine else "raise"
    summary = medallion.run(
        spark, args.source, args.root, HIGHER_EDUCATION, buckets=args.buckets, on_overflow=policy
    )
    print(json.dumps(summary, ensure_ascii=False))


if __name__ == "__main__":
    main()
