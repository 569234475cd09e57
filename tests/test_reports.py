"""Sources, ensembles and comparison reports on hand-made tables."""
import os
import tempfile

import pytest

from riskloom.operators.compare import paired_report, screen_vs_anchor
from riskloom.operators.ensemble import named_ensembles, seed_average
from riskloom.sources import schema as S


def test_csv_load_and_name_resolution(spark):
    d = tempfile.mkdtemp(prefix="riskloom-csv-")
    path = os.path.join(d, "dev.csv")
    cols = ["id", "default.payment.next.month", "EXTRA"] + [
        c for c in S.panel_schema(False).fieldNames() if c != "ID"]
    with open(path, "w") as f:
        f.write(",".join(cols) + "\n")
        f.write(",".join(["7", "1", "x"] + ["1"] * (len(cols) - 3)) + "\n")
    df = S.load_table(spark, path, with_label=True, fmt="csv")
    xy = S.split_xy(df).first().asDict()
    assert xy["ID"] == 7 and xy["label"] == 1 and "EXTRA" not in xy
    assert list(xy)[:4] == ["ID", "SEX", "EDUCATION", "MARRIAGE"]
    with pytest.raises(KeyError):
        S.get_features(df.drop("PAY_3"))
    with pytest.raises(FileNotFoundError):
        S.load_table(spark, os.path.join(d, "missing.csv"))


def test_named_ensembles_and_seed_average(spark):
    rows = [(1, 0, 10, 1, "A", 0.2), (1, 0, 10, 1, "B", 0.4), (1, 0, 11, 0, "A", 0.6),
            (1, 0, 11, 0, "B", 0.8), (2, 0, 10, 1, "A", 0.1), (2, 0, 10, 1, "B", 0.3)]
    s = spark.createDataFrame(rows, "seed int, fold int, ID long, label int, model string, proba double")
    e = named_ensembles(s, {"AB": ["A", "B"], "AZ": ["A", "Z"]})
    got = {(r["seed"], r["ID"]): r["proba"] for r in e.collect()}
    assert set(r["model"] for r in e.collect()) == {"AB"}
    assert abs(got[(1, 10)] - 0.3) < 1e-12 and abs(got[(2, 10)] - 0.2) < 1e-12
    avg = seed_average(s.where("model = 'A' AND ID = 10"), [1, 2])
    run = {r["n_seeds"]: r["proba"] for r in avg.collect()}
    assert run[1] == 0.2 and abs(run[2] - 0.15) < 1e-12


def test_paired_report_verdicts(spark):
    seeds = [42, 1, 7]
    f1 = {"anchor": [0.70, 0.70, 0.70], "big": [0.71, 0.72, 0.71], "small": [0.701, 0.702, 0.701],
          "mixed": [0.72, 0.69, 0.70], "worse": [0.60, 0.60, 0.60]}
    rows = [(m, s, v[i]) for m, v in f1.items() for i, s in enumerate(seeds)]
    r = spark.createDataFrame(rows, "model string, seed int, macro_f1 double")
    rep = {x["model"]: x.asDict() for x in paired_report(r, "anchor", seeds).collect()}
    assert rep["big"]["verdict"] == "KEEP (robust)" and rep["big"]["recommended"]
    assert rep["small"]["verdict"] == "keep? (robust but small)"
    assert rep["mixed"]["verdict"] == "watch (not all seeds)"
    assert rep["worse"]["verdict"] == "revert" and rep["worse"]["rank"] == 4
    scr = {x["model"]: x["promising"] for x in
           screen_vs_anchor(r.where("seed = 42").drop("seed"), "anchor").collect()}
    assert scr == {"big": True, "small": True, "mixed": True, "worse": False}
