"""The offline job: profile counts, Bloom filter of bad senders, model.

    python -m fraudflow.plans.offline --input data.csv --out /shared/fraud

Each step reads the columns it needs of the labelled transactions (Parquet
prunes them; nothing is held of the raw table), writes the Bloom filter (SNK4), fits / evaluates
the pipeline and saves it (SNK5), and writes the metrics as a table.
"""

from __future__ import annotations

import argparse
import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..operators import bloom
from ..operators.profile import overall_counts
from ..schema import BLOOM_FPP, OFFLINE_THRESHOLD
from . import model as M


def run_offline(spark: SparkSession, transactions: DataFrame, out: str,
                fpp: float = BLOOM_FPP, threshold: float = OFFLINE_THRESHOLD) -> dict:
    counts = overall_counts(transactions.select("sender_account", "is_fraud")).first().asDict()   # AG1, one pass
    # fraud rows as they are: duplicates collapse inside the build aggregate
    fraud_senders = transactions.where("is_fraud").select("sender_account")
    bf = bloom.build(fraud_senders, "sender_account", n=counts["distinct_bad_senders"], fpp=fpp)
    bf.save(f"{out}/blacklist_senders")
    trained = M.train_model(transactions)
    scored = M.score(trained.model, trained.test, threshold).persist(StorageLevel.MEMORY_AND_DISK)
    metrics = M.evaluator_metrics(scored)
    M.metrics_at(scored, threshold).write.mode("overwrite").parquet(f"{out}/metrics")
    M.threshold_sweep(scored).write.mode("overwrite").parquet(f"{out}/threshold_sweep")
    M.save_model(trained.model, f"{out}/fraud_model")
    scored.unpersist()
    bf.release()
    return {**counts, **metrics, "bloom_blocks": bf.num_blocks, "bloom_k": bf.k}


def main(argv=None) -> None:
    from ..session import get_spark
    from ..sources.tables import read_transactions
    p = argparse.ArgumentParser()
    p.add_argument("--input", required=True)
    p.add_argument("--format", default="csv")
    p.add_argument("--out", required=True)
    p.add_argument("--master", default=None)
    a = p.parse_args(argv)
    spark = get_spark(a.master, app="fraudflow-offline")
    print(json.dumps(run_offline(spark, read_transactions(spark, a.input, a.format), a.out)))


if __name__ == "__main__":
    main()
