"""Verification of rounds by layers: findings pivoted once by their key, states by tier, and the gate that keeps whole events back."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The layers in order, and those that apply to each tier.
LAYERS = ("layer0", "layer1", "layer2", "layer3", "layer4", "layer5", "golden")
APPLIED = {"detail": LAYERS, "score": ("layer0", "layer3", "layer4", "layer5", "golden"), "rank": ("layer0", "layer4", "layer5", "golden")}
PASSED = ("ok", "skipped", "n/a")
GAP = "upstream_missing"


def findings_by_key(findings: DataFrame, key: str, notes: tuple[str, ...] = ()) -> DataFrame:
    """From (key, layer, level) to one row a key: errors of each layer, warnings of all, and whether any row has each of `notes` as its layer.
    Counts are partial before the one shuffle."""
    errors = [F.count_if((F.col("layer") == x) & (F.col("level") == "error")).alias(x) for x in LAYERS]
    noted = [F.bool_or(F.col("layer") == x).alias(x) for x in notes]
    return findings.groupBy(key).agg(*errors, F.count_if(F.col("level") == "warning").alias("n_warnings"), *noted)


def layer_states(rounds: DataFrame, unchecked: dict[str, Column]) -> DataFrame:
    """Turns each layer's count of errors into its state: n/a where the tier has no such layer, error, else what `unchecked` gives (null: ok).
    A tier that is not known has no layers, so its rounds never pass."""
    known = F.coalesce(F.col("tier").isin(*APPLIED), F.lit(False))
    states = {}
    for x in LAYERS:
        has = F.coalesce(F.col("tier").isin(*[t for t, own in APPLIED.items() if x in own]), F.lit(False))
        free = unchecked.get(x, F.lit(None).cast("string"))
        states[x] = F.when(~known, "error").when(~has, "n/a").when(F.coalesce(F.col(x), F.lit(0)) > 0, "error").otherwise(F.coalesce(free, F.lit("ok")))
    n_errors = sum((F.coalesce(F.col(x), F.lit(0)) for x in LAYERS), F.lit(0).cast("long"))
    return rounds.withColumn("n_errors", n_errors).withColumns(states)


def verification_state(states: list[str]) -> Column:
    """ng: some layer is neither passed nor known to be missing upstream; gap: some is missing; else ok."""
    layers = F.array(*states)
    return F.when(F.exists(layers, lambda s: ~s.isin(*PASSED, GAP)), "ng").when(F.array_contains(layers, GAP), "gap").otherwise("ok")


def gate(rounds: DataFrame, event: list[str]) -> DataFrame:
    """`published`: whether no round of the event has an error of any layer, be it one its tier does not show."""
    return rounds.withColumn("published", F.max("n_errors").over(Window.partitionBy(*event)) == 0)
