"""Command line for the pipeline steps.

    python -m fleetspark publish --csv PATH --out DIR [--servers HOST:PORT --topic T]
    python -m fleetspark land    --base DIR --stamp yyyyMMdd_HHmmss --path DIR [--source text|kafka] [--checkpoint DIR]
    python -m fleetspark clean   --base DIR [--raw-key PATH]
    python -m fleetspark vehicle --base DIR
    python -m fleetspark driver  --base DIR
    python -m fleetspark score   --base DIR          (vehicle + driver in one pass)
    python -m fleetspark load    --base DIR --serving DIR [--jdbc-url URL --jdbc-user U --jdbc-password P]
    python -m fleetspark console --serving DIR
    python -m fleetspark profile --base DIR --out DIR  (threshold evidence, signal shares)
    python -m fleetspark inspect --base DIR --out DIR [--raw-key PATH]
"""

from __future__ import annotations

import argparse
import json

from .plans import pipeline
from .session import SESSION_SETTINGS, build_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="fleetspark")
    ap.add_argument("step", choices=["publish", "land", "clean", "vehicle", "driver", "score", "load", "console",
                                     "profile", "inspect"])
    ap.add_argument("--base")
    ap.add_argument("--serving")
    ap.add_argument("--csv")
    ap.add_argument("--out")
    ap.add_argument("--path")
    ap.add_argument("--stamp")
    ap.add_argument("--checkpoint", help="of the landed source; by default one per path or topic")
    ap.add_argument("--source", default="text")
    ap.add_argument("--raw-key")
    ap.add_argument("--servers")
    ap.add_argument("--topic")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-user")
    ap.add_argument("--jdbc-password")
    ap.add_argument("--master", default=None, help="only for local runs; clusters set it at submit")
    ap.add_argument("--shuffle-partitions", type=int, default=200)
    a = ap.parse_args(argv)

    if a.master:
        spark = build_session(a.master, a.shuffle_partitions)
    else:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("fleetspark").getOrCreate()
        # What results depend on is set here, whatever the submit flags say.
        for k, v in SESSION_SETTINGS.items():
            spark.conf.set(k, v)
    if a.step == "publish":
        pipeline.publish_messages(spark, a.csv, a.out, a.servers, a.topic)
        result = {"out": a.out}
    elif a.step == "land":
        opts = {"subscribe": a.topic, "kafka.bootstrap.servers": a.servers} if a.source == "kafka" else {}
        result = {"raw": pipeline.land_messages(spark, a.base, a.stamp, a.source, a.path, a.checkpoint, **opts)}
    elif a.step == "clean":
        r = pipeline.run_cleaning(spark, a.base, a.raw_key, tune=True)
        result = {"status": r.status, "path": r.path, "stats": r.stats}
    elif a.step in ("vehicle", "driver", "score"):
        fn = {"vehicle": pipeline.run_vehicle_health, "driver": pipeline.run_driver_behavior,
              "score": pipeline.run_scores}[a.step]
        r = fn(spark, a.base, tune=True)
        result = {"stamp": r.stamp, "outputs": r.outputs}
    elif a.step == "load":
        jdbc = None
        if a.jdbc_url:
            jdbc = {"url": a.jdbc_url, "properties": {"user": a.jdbc_user or "", "password": a.jdbc_password or ""}}
        d, v = pipeline.run_loads(spark, a.base, a.serving, jdbc)
        result = {"driver": d.__dict__, "vehicle": v.__dict__}
    elif a.step == "profile":
        result = {"stamp": pipeline.run_profile(spark, a.base, a.out)}
    elif a.step == "inspect":
        result = {"raw": pipeline.run_inspect(spark, a.base, a.out, a.raw_key)}
    else:
        result = pipeline.run_console(spark, a.serving)
    print(json.dumps(result, default=str))


if __name__ == "__main__":
    main()
