"""Batch job: ``python -m netfeat --driver T --trxn T --target T --start YYYY-MM-DD``
(or ``spark-submit --py-files netfeat.zip netfeat/__main__.py ...``).

Reads the driver and transaction sources (catalog tables or Parquet paths),
computes the network features of every vintage in the horizon and writes
them partitioned by vintage. Session settings (checkpoint folder, AQE, ...)
come from the submitting environment.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from netfeat.constants import DEFAULT_WINDOWS
from netfeat.operators.skew import SkewConfig
from netfeat.plans.features import run


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="netfeat", description=__doc__.splitlines()[0])
    p.add_argument("--driver", required=True, help="driver table name or Parquet path")
    p.add_argument("--trxn", required=True, help="transaction table name or Parquet path")
    p.add_argument("--target", required=True, help="feature table name or path")
    p.add_argument("--start", required=True, help="first vintage of the horizon, YYYY-MM-DD")
    p.add_argument("--months", type=int, default=24, help="horizon length in months")
    p.add_argument("--windows", default=",".join(map(str, DEFAULT_WINDOWS)), help="look-back months, comma separated")
    p.add_argument("--level", default="vhrg", choices=["vhrg", "hrg", "all"], help="risk level of the neighbour count")
    p.add_argument("--mode", default="overwrite_partitions", choices=["overwrite_partitions", "append"])
    p.add_argument("--vintages-per-batch", type=int, default=None)
    p.add_argument("--resume", action="store_true", help="skip the vintages that an earlier run of the same inputs finished")
    p.add_argument("--hot-threshold", type=int, default=SkewConfig.threshold)
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> list:
    a = parse(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName("netfeat").getOrCreate()
    done = run(
        spark,
        a.driver,
        a.trxn,
        a.target,
        start=a.start,
        months=a.months,
        windows=[int(w) for w in a.windows.split(",") if w.strip()],
        level=a.level,
        mode=a.mode,
        vintages_per_batch=a.vintages_per_batch,
        skew=SkewConfig(a.hot_threshold),
        resume=a.resume,
    )
    print(f"netfeat: wrote {len(done)} vintage(s) to {a.target}: {', '.join(map(str, done))}")
    return done


if __name__ == "__main__":
    main()
