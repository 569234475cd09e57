"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every query is forced to completion with the ``noop`` sink (full execution, no
driver collect). Prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ..., "cpus": ...,
 "failed": {...}}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "c11_chosen_combo",      # panel + chosen feature families (one projection)
    "b6_pipeline",           # fold -> engineer -> encode
    "j1_best_cut",           # threshold histogram, best macro-F1 cut
    "j6_summary",            # GLOBAL/TRANSFER/FOLD-AVG/BEST-FIXED over 5 fold seeds
    "i6_compare",            # per-model metrics report incl. ROC-AUC
    "i12_correlation",       # 21x21 correlation matrix in one aggregate
    "e5_router",             # fitted impute/scale/one-hot router
    "e6_target_encoding",    # cross-fitted target encoding
    "k13_paired",            # paired repeated-CV report over 5 seeds
    "f7_knn",                # exact blocked kNN join
    "hgb_train_predict",     # hgb + 5-fold cut tuning + refit + predict
    "g12_train_predict",     # deployed rf_balanced (300 trees) train+predict
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    os.environ.setdefault("RISKLOOM_MASTER", f"local[{cpus}]")
    from riskloom.session import get_spark
    from riskloom.plans.queries import registry

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    q = registry()

    def hgb_train_predict(spark, sf):
        from riskloom.plans.chosen import train_and_predict
        from riskloom.session import cut_lineage
        from riskloom.sources import panel as P
        panel = cut_lineage(P.credit_panel(spark, sf))
        pred, _ = train_and_predict(P.development(panel), P.evaluation(panel), members=["hgb"])
        return pred

    q["hgb_train_predict"] = hgb_train_predict
    names = [n for n in HEADLINE if not only or n in only]
    times = {}
    failed = {}
    for name in names:
        t0 = time.time()
        try:
            df = q[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001 - record and continue
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
        print(f"[bench] {name}: {times.get(name)}", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
                      "failed": failed}))


if __name__ == "__main__":
    main()
