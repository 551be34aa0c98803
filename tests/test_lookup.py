import numpy as np
from pyspark.sql import functions as F

from sprout.functions.lookup import collect_lookup, weight_array


def test_hashed_lookup(spark):
    keys = [f"k{i} x" for i in range(50)] + ["don't", "a"]
    table = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v int")
    lookup = collect_lookup(table, "k", "v")
    probes = spark.createDataFrame([(k,) for k in keys + ["missing", "", "k1"]], "k string")
    got = {r[0]: r[1] for r in probes.select("k", lookup.get(F.col("k"))).collect()}
    for i, k in enumerate(keys):
        assert got[k] == i
    assert got["missing"] is None and got[""] is None and got["k1"] is None


def test_empty_lookup(spark):
    lookup = collect_lookup(spark.createDataFrame([], "k string, v int"), "k", "v")
    assert spark.range(1).select(lookup.get(F.lit("a"))).first()[0] is None


def test_lookup_is_folded_into_one_literal(spark):
    keys = spark.createDataFrame([("a", 0), ("b", 1)], "k string, v int")
    lookup = collect_lookup(keys, "k", "v")
    plan = spark.range(3).select(lookup.get(F.lit("a")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan


def test_weight_array_exact(spark):
    w = np.array([0.1, 1e-300, -2.5, 1 / 3, 123456.789e10])
    got = spark.range(1).select(weight_array(w)).first()[0]
    assert got == list(w)
