"""The online job: routing (stage 1+2) and insights (stage 3), run until
any query ends (ST10).

    python -m fraudflow.streaming.job --raw /shared/topics/raw --artefacts /shared/fraud \
        --out /shared/online [--bootstrap host:9092]

With ``--bootstrap``, ``--raw`` is the name of the raw topic, and the routed
topics go through the bus as well.  Routing, alerts and the other insights
start a batch whenever the last has ended, the activity summaries every two
minutes (ST7); ``--available-now`` processes what is there and stops (tests,
backfills).  ``--starting`` and ``--max-records`` read a raw file topic from
its start or end, so many records a batch, as the bus does.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ..operators.bloom import BloomFilter
from ..plans.model import load_model, quickest
from .pipeline import TRIGGERS, TopologyPaths, start_insights, start_routing


def plan_online(raw: str, available_now: bool = False, bootstrap: str | None = None) -> dict:
    """Sources and triggers of the online job."""
    now = {"availableNow": True}
    return {
        "source": {"raw_path": None, "raw_topic": raw, "bootstrap": bootstrap} if bootstrap else {"raw_path": raw},
        "routing": now if available_now else {},
        "insights": now if available_now else {None: {}, **TRIGGERS},
        # the bus may carry a record twice: alerts are told apart by id
        "dedupe_alerts": bool(bootstrap),
    }


def run_online(spark: SparkSession, raw_path: str, artefacts: str, out: str,
               available_now: bool = False, max_files: int | None = None,
               timeout: float | None = None, bootstrap: str | None = None,
               max_records: int | None = None, starting: str | None = None):
    if available_now and max_records:
        raise ValueError("available_now takes all there is in one go: leave max_records out")
    bf = BloomFilter.load(spark, f"{artefacts}/blacklist_senders")
    model = quickest(load_model(f"{artefacts}/fraud_model"), spark)
    paths = TopologyPaths(out)
    plan = plan_online(raw_path, available_now, bootstrap)
    routing = start_routing(spark, bf=bf, model=model, paths=paths, trigger=plan["routing"], max_files=max_files,
                            max_records=max_records, starting=starting, **plan["source"])
    if available_now:
        routing.awaitTermination()
    insights = start_insights(spark, paths, trigger=plan["insights"], max_files=max_files, bootstrap=bootstrap,
                              dedupe_alerts=plan["dedupe_alerts"])
    if available_now:
        for q in insights.values():
            q.awaitTermination()
        return [routing, *insights.values()]
    spark.streams.awaitAnyTermination(timeout)
    return [routing, *insights.values()]


def main(argv=None) -> None:
    from ..session import get_spark
    p = argparse.ArgumentParser()
    p.add_argument("--raw", required=True)
    p.add_argument("--artefacts", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--max-files", type=int, default=None)
    p.add_argument("--bootstrap", default=None,
                   help="bus brokers: --raw is then the name of a topic instead of a folder")
    p.add_argument("--max-records", type=int, default=None, help="records a batch of the raw topic")
    p.add_argument("--starting", choices=["latest", "earliest"], default=None, help="where the first run begins")
    p.add_argument("--master", default=None)
    a = p.parse_args(argv)
    spark = get_spark(a.master, app="fraudflow-online")
    run_online(spark, a.raw, a.artefacts, a.out, a.available_now, a.max_files,
               bootstrap=a.bootstrap, max_records=a.max_records, starting=a.starting)


if __name__ == "__main__":
    main()
