"""Times the headline queries on local cores and prints one JSON line on standard output, at the end.

Each query's seconds go to standard error as soon as they are known, the costly training queries last, so that a run that
is stopped has shown what it measured; a run that is asked to end (SIGTERM) still prints its line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores, BENCH_QUERIES a comma
list of registered names to run instead of the default ones. A table that is one small file would keep one core busy, so
the article tables are first dealt to as many files as there are cores, outside the clock, as a cluster would have them.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from broadsheet import registry  # noqa: E402
from broadsheet.functions.canonical import canonical_text  # noqa: E402
from broadsheet.session import session  # noqa: E402

HEADLINE = (
    "missingness", "label_text_missingness", "text_length_summary", "label_text_lengths", "text_pattern_features",
    "duplicate_counts", "duplicate_groups_near", "canonical_text", "leakage_report", "leakage_anti", "dedup_report",
    "cross_label_anti", "dedup_keep_first", "js_divergence", "source_pagerank", "top_sources_per_label",
    "numeric_summary_lineitem", "numeric_summary_events", "categorical_summary_events", "histogram_events",
    "stratified_folds", "fold_f1", "per_class_metrics", "pr_curve", "score_separation", "word_ngrams", "char_wb_ngrams",
    "tfidf", "source_onehot", "scale_no_mean", "assemble", "train_linearsvc", "train_logreg", "train_ridge",
    "cross_validate",
)


def dealt(spark, sf_dir: str, files: int) -> str:
    folder = tempfile.mkdtemp(prefix="bench-")
    for name in sorted(os.listdir(sf_dir)):
        if name in ("documents.parquet", "labels.parquet"):
            spark.read.parquet(f"{sf_dir}/{name}").repartition(files).write.parquet(f"{folder}/{name}")
        else:
            os.symlink(f"{sf_dir}/{name}", f"{folder}/{name}")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cores=cpus, app="bench")
    found = registry.queries()
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    # start the JVM's and the Python workers' code paths once, outside the clock
    warm = spark.range(0, 1000, 1, int(cpus)).selectExpr("'é' || id AS t")
    warm.select(canonical_text("t")).write.format("noop").mode("overwrite").save()
    tables = dealt(spark, sf_dir, int(cpus))
    seconds, failed = {}, {}

    def report() -> None:
        print(json.dumps({
            "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
            "failed": failed, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
        }), flush=True)

    def stopped(*_) -> None:
        failed.update({n: "stopped before its end" for n in chosen if n not in seconds and n not in failed})
        report()
        os._exit(1)

    signal.signal(signal.SIGTERM, stopped)
    for name in chosen:
        started = time.perf_counter()
        try:
            found[name](spark, tables).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
        except Exception as e:  # noqa: BLE001
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
        print(f"{name} {seconds.get(name, failed.get(name))}", file=sys.stderr, flush=True)
    report()
    spark.stop()


if __name__ == "__main__":
    main()
