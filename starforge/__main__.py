"""Run the whole load from the command line (or spark-submit):

    python -m starforge --csv hdfs:///landing/postings/ --out hdfs:///warehouse/jobs [--skip-raw]
"""
from __future__ import annotations

import argparse
import logging

from starforge.plans.run import run, summary
from starforge.session import get_spark


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(prog="starforge", description="CSV postings -> star schema")
    ap.add_argument("--csv", help="input text file(s) or folder (S5)")
    ap.add_argument("--out", required=True, help="output folder of the seven tables")
    ap.add_argument("--skip-raw", action="store_true",
                    help="rebuild from the saved raw_jobs table instead of the text (S4)")
    args = ap.parse_args(argv)
    if not args.skip_raw and not args.csv:
        ap.error("--csv is required unless --skip-raw is given")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    counts = run(get_spark(), args.csv, args.out, load_raw=not args.skip_raw)
    logging.getLogger("starforge").info("loaded: %s", summary(counts))
    return counts


if __name__ == "__main__":
    main()
