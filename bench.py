"""Headline timings. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.

Each entry is the median of ``BENCH_RUNS`` runs after one warm-up; results go to the noop sink, so
every row and column is computed. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from tokenloom.catalog import all_queries  # noqa: E402
from tokenloom.catalog import fixtures as X  # noqa: E402
from tokenloom.catalog.packing_queries import _blend  # noqa: E402
from tokenloom.operators import blend as B  # noqa: E402
from tokenloom.operators import mixture as MX  # noqa: E402
from tokenloom.operators import pack as P  # noqa: E402
from tokenloom.operators.tokenizer import tokenize, words  # noqa: E402
from tokenloom.session import local_session, scratch_path, ship_package  # noqa: E402
from tokenloom.sources import store as ST  # noqa: E402

BLEND_SAMPLES = 1_000_000
CATALOG = (
    "f04_codes_to_ids",
    "g12_vocabulary",
    "a15_sentence_pairs",
    "a30_text_codec",
    "a30_text_segments",
    "a31_interleave_cot",
    "a32_encode_stage2",
    "f19_position_ids",
    "a13_training_samples",
)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, "tokenloom-bench")
    ship_package(spark)

    # Stores a training run would start from: one sequence per document, one per line.
    docs, lines = scratch_path(spark, "docs"), scratch_path(spark, "lines")
    ST.write_sequences(X.tokenized(spark, sf), docs)
    per_line = X.documents(spark, sf).select(
        "doc_id", F.col("source").alias("dataset"), F.posexplode(F.split("text", "\n")).alias("seq_no", "line")
    )
    ids = X.tokenizer(spark, sf).word_ids(words(F.col("line")))
    ST.write_sequences(per_line.select("doc_id", "dataset", "seq_no", ids.alias("tokens")), lines)
    doc_store, line_store = ST.read_sequences(spark, docs), ST.read_sequences(spark, lines)
    totals = line_store.agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t")).first()
    blend = _blend(spark, sf)
    tok = X.tokenizer(spark, sf)

    jobs = {
        "count_tokens": lambda: MX.token_totals(line_store),
        "tokenize": lambda: tokenize(X.documents(spark, sf), "text", tok).select("doc_id", "tokens"),
        "pack_128": lambda: P.pack_samples(doc_store, P.PackConfig(128)),
        "pack_2048": lambda: P.pack_samples(doc_store, P.PackConfig(2048)),
        "blend_balanced_1e6": lambda: B.balanced_schedule(spark, blend, BLEND_SAMPLES),
        "blend_exact_1e6": lambda: B.exact_schedule(spark, blend, BLEND_SAMPLES),
    }
    catalog = all_queries()
    for name in CATALOG:
        jobs[name] = lambda name=name: catalog[name][0](spark, sf)

    seconds = {}
    for name, job in jobs.items():
        consume(job())
        took = []
        for _ in range(runs):
            begin = time.perf_counter()
            consume(job())
            took.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(took), 3)
    rates = {
        "sequences": totals["n"],
        "tokens": totals["t"],
        "count_sequences_per_s": round(totals["n"] / seconds["count_tokens"]),
        "count_tokens_per_s": round(totals["t"] / seconds["count_tokens"]),
        "tokenize_tokens_per_s": round(totals["t"] / seconds["tokenize"]),
        "pack_128_tokens_per_s": round(totals["t"] / seconds["pack_128"]),
        "pack_2048_tokens_per_s": round(totals["t"] / seconds["pack_2048"]),
        "blend_samples_per_s": round(BLEND_SAMPLES / seconds["blend_balanced_1e6"]),
    }
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rates": rates,
                "cpus": cpus,
                "sf": sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
