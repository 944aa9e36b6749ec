"""Batch job entry point.

    python -m reviewflow.jobs load-places   --landing PATH [--table T | --jdbc-url URL ...] [--multi-line] [--rejects P]
    python -m reviewflow.jobs load-reviews  --landing PATH [--table T | --jdbc-url URL ...] [--multi-line] [--rejects P]
    python -m reviewflow.jobs label-reviews --source-table T [--target-table T2] [--variant score|model]
                                             [--scorer module:Class]
    python -m reviewflow.jobs land-places   --pages PARQUET --out PATH
    python -m reviewflow.jobs land-reviews  --places PARQUET --details PARQUET --out PATH
    python -m reviewflow.jobs land-synthetic (--cities "Pune,New Delhi" | --cities-table PARQUET) --out PATH
    python -m reviewflow.jobs create-tables  [--database DB] [--buckets N]

On a cluster: ``spark-submit --py-files reviewflow.zip reviewflow/jobs.py <job> …``
(the master and resources come from spark-submit; executors get the package
from the zip, and pandas-UDF paths also ship it themselves).

The JDBC password is read from the environment variable named by
``--password-env``; no credential is accepted on the command line or kept
in code.  The load time is chosen once per run on the driver.
"""

from __future__ import annotations

import argparse
import importlib
import json
import os
from datetime import datetime

from reviewflow.plans import flows as PL
from reviewflow.session import get_session
from reviewflow.sinks.tables import MAX_CONNECTIONS


def _jdbc(args) -> dict:
    if not args.jdbc_url:
        return {}
    return {"url": args.jdbc_url, "user": args.user, "driver": args.driver,
            "password": os.environ.get(args.password_env) if args.password_env else None,
            "batchsize": args.jdbc_batch_size, "num_partitions": args.jdbc_connections}


def _scorer(spec: str | None):
    if not spec:
        return None
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)()


def main(argv: list | None = None) -> dict:
    p = argparse.ArgumentParser(prog="reviewflow.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    for job in ("load-places", "load-reviews"):
        j = sub.add_parser(job)
        j.add_argument("--landing", required=True)
        j.add_argument("--table")
        j.add_argument("--multi-line", action="store_true", help="pretty-printed single documents per file")
    lab = sub.add_parser("label-reviews")
    lab.add_argument("--source-table", required=True)
    lab.add_argument("--target-table")
    lab.add_argument("--scorer", help="module:Class with load() and score(pd.Series) or logits(pd.Series) "
                                      "(default: lexicon)")
    lab.add_argument("--variant", choices=("score", "model"), default="score")
    lab.add_argument("--partition-column", help="numeric/date column to split a JDBC source read on")
    lp = sub.add_parser("land-places")
    lp.add_argument("--pages", required=True)
    lp.add_argument("--out", required=True)
    lr = sub.add_parser("land-reviews")
    lr.add_argument("--places", required=True)
    lr.add_argument("--details", required=True)
    lr.add_argument("--out", required=True)
    for name in ("load-places", "load-reviews", "label-reviews"):
        sub.choices[name].add_argument("--rejects", help="parquet path for rows that do not fit the target")
    ct = sub.add_parser("create-tables")
    ct.add_argument("--database")
    ct.add_argument("--buckets", type=int, help="bucket author-keyed tables by author_id into N buckets")
    ls = sub.add_parser("land-synthetic")
    ls.add_argument("--cities", help="comma-separated city names")
    ls.add_argument("--cities-table", help="parquet with a `city` column")
    ls.add_argument("--out", required=True)
    for j in sub.choices.values():
        j.add_argument("--jdbc-url")
        j.add_argument("--user")
        j.add_argument("--driver")
        j.add_argument("--password-env")
        j.add_argument("--jdbc-batch-size", type=int, default=PL.K.JDBC_BATCH_SIZE, help="rows per insert batch")
        j.add_argument("--jdbc-connections", type=int, default=MAX_CONNECTIONS, help="connections an append opens at most")
    args = p.parse_args(argv)

    spark = get_session(app_name=f"reviewflow-{args.job}")
    load_ts = datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    jdbc = _jdbc(args)
    url = jdbc.pop("url", None)
    if args.job == "load-places":
        out = PL.load_places(spark, args.landing, load_ts, table=args.table or PL.S.HOSPITAL_LISTS.name,
                             url=url, multi_line=args.multi_line, rejects_path=args.rejects, **jdbc)
    elif args.job == "load-reviews":
        out = PL.load_reviews(spark, args.landing, load_ts, table=args.table or PL.S.HOSPITAL_REVIEWS.name,
                              url=url, multi_line=args.multi_line, rejects_path=args.rejects, **jdbc)
    elif args.job == "label-reviews":
        out = PL.label_reviews(spark, args.source_table, args.target_table, scorer=_scorer(args.scorer), url=url,
                               variant=args.variant, rejects_path=args.rejects,
                               partition_column=args.partition_column, load_ts=load_ts, **jdbc)
    elif args.job == "create-tables":
        if args.database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {args.database}")
        out = {"created": PL.S.create_target_tables(spark, args.database, buckets=args.buckets)}
    elif args.job == "land-synthetic":
        if args.cities_table:
            cities = spark.read.parquet(args.cities_table).select("city")
        else:
            names = [c.strip() for c in (args.cities or "").split(",") if c.strip()]
            if not names:
                raise SystemExit("land-synthetic needs --cities or --cities-table")
            cities = spark.createDataFrame([(c,) for c in names], "city string")
        out = {"written": True, **PL.land_synthetic(spark, cities, args.out)}
    elif args.job == "land-places":
        out = PL.land_places(spark, spark.read.parquet(args.pages), args.out, load_ts=load_ts)
        out["written"] = out["documents"] > 0
    else:
        out = {"written": True, **PL.land_reviews(spark, spark.read.parquet(args.places),
                                                   spark.read.parquet(args.details), args.out)}
    print(json.dumps({"job": args.job, **out}))
    return out


if __name__ == "__main__":
    main()
