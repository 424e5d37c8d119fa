"""States of layers, the gate and the verification state on small rounds."""

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from runledger.operators.report import LAYERS, findings_by_key, gate, layer_states, verification_state


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()


def test_findings_are_counted_by_layer_and_unknown_layers_are_not(spark):
    rows = [(1, "layer0", "error"), (1, "layer0", "error"), (1, "layer2", "warning"), (2, "other", "error"), (None, "golden", "error")]
    got = {r["run"]: r for r in findings_by_key(spark.createDataFrame(rows, "run long, layer string, level string"), "run").collect()}
    assert (got[1]["layer0"], got[1]["layer2"], got[1]["n_warnings"]) == (2, 0, 1)
    assert sum(got[2][x] for x in LAYERS) == 0 and got[None]["golden"] == 1
    assert findings_by_key(spark.createDataFrame([], "run long, layer string, level string"), "run").count() == 0


ROUNDS = [  # event, round, tier, errors by layer, state of layer5 without error
    ("a", 1, "detail", {}, None), ("a", 2, "rank", {"layer1": 1}, None), ("b", 3, "score", {}, "upstream_missing"), ("b", 4, "detail", {}, "skipped"),
    ("c", 5, "detail", {"layer2": 3}, None), ("c", 6, "detail", {}, None), ("d", 7, "unknown", {}, None), ("e", 8, None, {}, None), ("f", 9, "detail", {"layer5": 1}, "upstream_missing"),
]


def test_states_follow_tier_errors_and_what_was_not_checked(spark):
    data = [(e, r, t, *[n.get(x) for x in LAYERS], s) for e, r, t, n, s in ROUNDS]
    df = spark.createDataFrame(data, "event string, round long, tier string, " + ", ".join(f"{x} long" for x in LAYERS) + ", five string")
    out = gate(layer_states(df, {"layer5": F.col("five")}), ["event"]).withColumn("state", verification_state(list(LAYERS)))
    got = {r["round"]: r for r in out.collect()}
    assert {r: x["state"] for r, x in got.items()} == {1: "ok", 2: "ok", 3: "gap", 4: "ok", 5: "ng", 6: "ok", 7: "ng", 8: "ng", 9: "ng"}
    # An error of a layer that the tier does not show still keeps the event back; so does one round for all rounds of its event.
    assert {r for r, x in got.items() if not x["published"]} == {1, 2, 5, 6, 9}
    assert got[2]["layer1"] == got[3]["layer1"] == got[3]["layer2"] == "n/a" and got[3]["layer5"] == "upstream_missing" and got[9]["layer5"] == "error"
    assert got[4]["layer5"] == "skipped" and got[5]["n_errors"] == 3 and got[6]["n_errors"] == 0
