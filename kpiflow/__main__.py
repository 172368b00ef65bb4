"""Command line: ``python -m kpiflow`` (or ``spark-submit kpiflow/__main__.py``).

    query NAME --sf-dir DIR --out PATH     run a registered query, write parquet
    bronze --root DIR --bootstrap HOST:PORT [--protocol P --mechanism M --user U --password-env VAR]
    silver-gold --root DIR [--final] [--no-live]

The session comes from ``SparkSession.builder.getOrCreate()``, so cluster
settings (master, ``spark.checkpoint.dir``, shuffle partitions) are whatever
spark-submit provides.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="kpiflow")
    p.add_argument("--store-endpoint", help="object store for s3a paths; needs both variables below")
    p.add_argument("--store-key-env", help="name of the environment variable holding the access key")
    p.add_argument("--store-secret-env", help="name of the environment variable holding the secret key")
    sub = p.add_subparsers(dest="cmd", required=True)
    q = sub.add_parser("query", help="run a registered query and write its result as parquet")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--out", required=True)
    b = sub.add_parser("bronze", help="start the bronze streaming job on Kafka")
    b.add_argument("--root", required=True, help="shared folder for tables and checkpoints")
    b.add_argument("--bootstrap", required=True)
    b.add_argument("--protocol")
    b.add_argument("--mechanism", default="SCRAM-SHA-512")
    b.add_argument("--user")
    b.add_argument("--password-env", help="name of the environment variable holding the password")
    s = sub.add_parser("silver-gold", help="start the silver/gold streaming job on the bronze tables")
    s.add_argument("--root", required=True)
    s.add_argument("--final", action="store_true", help="also run the append KPI stream")
    s.add_argument("--no-live", action="store_true", help="skip the live gold path")
    return p


def _session(args: argparse.Namespace) -> SparkSession:
    builder = SparkSession.builder.appName(f"kpiflow-{args.cmd}")
    if args.store_endpoint:
        from kpiflow.sources.files import object_store_conf

        key, secret = (os.environ.get(v or "", "") for v in (args.store_key_env, args.store_secret_env))
        builder = builder.config(map=object_store_conf(args.store_endpoint, key, secret, args.store_endpoint.startswith("https")))
    return builder.getOrCreate()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or _session(args)
    if args.cmd == "query":
        from kpiflow.plans.catalog import queries

        known = queries()
        if args.name not in known:
            raise SystemExit(f"unknown query {args.name!r}; known: {', '.join(sorted(known))}")
        known[args.name](spark, args.sf_dir).write.mode("overwrite").parquet(args.out)
        return 0
    from kpiflow.streaming.jobs import Paths, supervise

    paths = Paths(args.root.rstrip("/"))
    if args.cmd == "bronze":
        from kpiflow.sources.kafka import KafkaSecurity
        from kpiflow.streaming.apps import start_bronze

        password = os.environ.get(args.password_env) if args.password_env else None
        security = KafkaSecurity(args.protocol or "", args.mechanism, args.user, password)
        supervise(spark, start_bronze(spark, paths, args.bootstrap, security))
        return 0
    from kpiflow.streaming.apps import start_silver_gold

    supervise(spark, start_silver_gold(spark, paths, live=not args.no_live, final=args.final))
    return 0


if __name__ == "__main__":
    sys.exit(main())
