"""Run the registry job end to end: ``python -m registry_analytics --csv PATH [--out DIR]``.

Under ``spark-submit`` the cluster's session is used; run directly, a local
session is started.  Prints the folder of the written tables and results.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="registry_analytics")
    ap.add_argument("--csv", required=True, help="registry CSV file or folder (header line, latin-1)")
    ap.add_argument("--out", default=None, help="output folder (default: under spark.checkpoint.dir)")
    ap.add_argument("--encoding", default="ISO-8859-1")
    args = ap.parse_args(argv)

    from .plans.jobs import run_registry_from_csv
    from .session import local_session

    active = SparkSession.getActiveSession()
    spark = active or local_session()
    reg, results = run_registry_from_csv(spark, args.csv, args.out, encoding=args.encoding)
    print(json.dumps({"tables": reg.root, "results": results, "load_steps": reg.timings}))


if __name__ == "__main__":
    main()
