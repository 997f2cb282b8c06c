import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabularium.operators import (aggregate, hierarchy, histogram, indexing, lookup, manifest, profile, quantiles, sinks, topk,
                                  validate)
from tabularium.session import fresh_path


def edges(spark, pairs, relation="is_a"):
    return spark.createDataFrame([(c, p, relation) for c, p in pairs], "child_id string, parent_id string, relation string")


def reach(pairs, root):
    seen, queue = set(), [root]
    while queue:
        node = queue.pop()
        for c, p in pairs:
            if p == node and c not in seen:
                seen.add(c)
                queue.append(c)
    return seen


def test_closure_on_dag_and_cycle(spark):
    pairs = [("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("e", "d"), ("x", "y")]
    root = spark.createDataFrame([("a",)], "id string")
    got = {r["id"]: r["depth"] for r in hierarchy.descendants(edges(spark, pairs), root).collect()}
    assert got == {"b": 1, "c": 1, "d": 2, "e": 3}
    cyclic = pairs + [("a", "e")]
    assert {r["id"] for r in hierarchy.descendants(edges(spark, cyclic), root).collect()} == reach(cyclic, "a") == {"a", "b", "c", "d", "e"}
    assert hierarchy.descendants(edges(spark, pairs, "part_of"), root).count() == 0


def test_closure_of_a_long_chain_and_random_graph(spark):
    chain = [(str(i + 1), str(i)) for i in range(13)]
    root = spark.createDataFrame([("0",)], "id string")
    got = hierarchy.descendants(edges(spark, chain), root, fold_every=4)
    assert {(r["id"], r["depth"]) for r in got.collect()} == {(str(i), i) for i in range(1, 14)}
    rng = random.Random(7)
    pairs = [(str(rng.randrange(60)), str(rng.randrange(60))) for _ in range(90)]
    assert {r["id"] for r in hierarchy.descendants(edges(spark, pairs), root).collect()} == reach(pairs, "0")


@pytest.mark.parametrize("n", [1, 2, 3, 100, 60_000])
def test_exact_quantiles_match_numpy(spark, n):
    rng = np.random.default_rng(n)
    values = np.where(rng.random(n) < 0.4, 5.0, np.round(rng.normal(0, 100, n), 2))  # one value holds 40 % of the rows
    df = spark.createDataFrame([(int(i % 2), float(v)) for i, v in enumerate(values)], "g int, v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["prob"]: r["value"] for r in quantiles.exact_quantiles(df, ["v"], probs).collect()}
    np.testing.assert_allclose([got[p] for p in probs], np.quantile(values, probs), rtol=1e-9, atol=1e-9)
    by = {(r["g"], r["prob"]): r["value"] for r in quantiles.exact_quantiles(df, ["v"], [0.5, 0.99], by=["g"]).collect()}
    for g in set(int(i % 2) for i in range(n)):
        part = values[g::2]
        np.testing.assert_allclose([by[g, 0.5], by[g, 0.99]], np.quantile(part, [0.5, 0.99]), rtol=1e-9, atol=1e-9)


def test_quantile_brackets_do_not_depend_on_group_size(spark, monkeypatch):
    # A small ACCURACY sends small groups through the approximate brackets.
    monkeypatch.setattr(quantiles, "ACCURACY", 200)
    monkeypatch.setattr(quantiles, "MARGIN", 4.0 / 200)
    values = np.random.default_rng(3).integers(0, 1000, 5000).astype(float)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(7)
    got = {r["prob"]: r["value"] for r in quantiles.exact_quantiles(df, ["v"], [0.1, 0.11, 0.5, 0.9]).collect()}
    np.testing.assert_allclose([got[p] for p in (0.1, 0.11, 0.5, 0.9)], np.quantile(values, [0.1, 0.11, 0.5, 0.9]))


def test_quantiles_skip_nulls_and_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), ("b", 2.0)], "g string, v double")
    got = {r["g"]: r["value"] for r in quantiles.exact_quantiles(df, ["v"], [0.5], by=["g"]).collect()}
    assert got == {None: 2.0, "b": 2.0, "a": None}


def test_describe_and_profile(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (3.0, "a"), (None, "b")], "x double, s string")
    r = profile.describe(df, ["x"]).first()
    assert (r["count"], r["null_count"], r["mean"], r["std"], r["p25"], r["p50"], r["p75"]) == (3, 1, 2.0, 1.0, 1.5, 2.0, 2.5)
    rows = {r["column"]: (r["dtype"], r["n_rows"], r["nulls"], r["null_pct"]) for r in profile.profile(df).collect()}
    assert rows == {"x": ("double", 4, 1, 25.0), "s": ("string", 4, 1, 25.0)}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 5, 9.99, 10)] + [(None,)], "v double")
    assert [r["n_rows"] for r in histogram.histogram(df, "v", 5).orderBy("bin").collect()] == [2, 0, 1, 0, 2]
    same = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert [r["n_rows"] for r in histogram.histogram(same, "v", 3).orderBy("bin").collect()] == [2, 0, 0]
    assert [r["n_rows"] for r in histogram.histogram(df.filter("v > 99"), "v", 2).collect()] == [0, 0]


def test_distinct_with_null_and_zero_sum(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (2, "a"), (2, "b")], "g int, v string")
    got = {r["g"]: (r["n"], r["u"]) for r in df.groupBy("g").agg(aggregate.distinct_count("v").alias("n"), aggregate.distinct_count("v", True).alias("u")).collect()}
    assert got == {1: (1, 2), 2: (2, 2)}
    assert df.filter("g > 5").agg(aggregate.zero_sum("g").alias("s")).first()["s"] == 0


def test_row_index_is_a_permutation(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v")).repartition(6)
    rows = indexing.row_index(df, "v").orderBy("row_no").collect()
    assert [r["row_no"] for r in rows] == list(range(5000)) and [r["v"] for r in rows] == sorted(r["v"] for r in rows)


def test_primary_else_and_anti(spark):
    a = spark.createDataFrame([(1, "p")], "k int, v string")
    b = spark.createDataFrame([(1, "f"), (2, "f")], "k int, v string")
    assert {tuple(r) for r in lookup.primary_else(a, b, "k", ("A", "B")).collect()} == {(1, "p", "A"), (2, "f", "B")}
    assert [r["k"] for r in lookup.not_yet(b, a, ["k"]).collect()] == [2]


def test_land_report(spark):
    listing = spark.createDataFrame([("a", 10), ("b", 20), ("c", 30)], "name string, size_bytes bigint")
    done = spark.createDataFrame([("a", 10), ("b", 19)], "name string, size_bytes bigint")
    assert sorted(r["name"] for r in manifest.to_land(listing, done).collect()) == ["b", "c"]
    assert tuple(manifest.land_report(listing, done).first()) == (3, 1, 2, 60, 10, 50)


def test_round_trip_finds_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    back = sinks.write_parquet(df, fresh_path(spark, "rt"), codec="zstd", sort_within=["k"])
    assert sinks.same_rows(df, back).first()["ok"]
    short = sinks.same_rows(df, back.dropDuplicates())
    assert (short.first()["ok"], short.first()["n_differ"]) == (False, 1)
    assert not sinks.same_rows(df, back.withColumn("k", F.col("k").cast("bigint"))).first()["ok"]


def test_extreme_row_default(spark):
    df = spark.createDataFrame([("a", 3), ("b", 5), ("c", 5), ("d", None)], "k string, m int")
    assert topk.extreme_row(df, "m", ["k", "m"], ties="k").first()["k"] == "b"
    assert topk.extreme_row(df, "m", ["k"], largest=False, ties="k").first()["k"] == "a"
    assert topk.extreme_row(df.filter("m is null"), "m", ["k"], default={"k": "none"}).first()["k"] == "none"


def test_validation(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id int, v int")
    rules = {"known": F.col("v").isNotNull(), "small": F.col("v") < 10}
    assert {tuple(r) for r in validate.violations(df, ["id"], rules).collect()} == {(2, "known"), (2, "small"), (3, "small")}
    assert validate.require(df.filter("id = 1"), rules).count() == 1
    with pytest.raises(Exception, match="rule broken: small"):
        validate.require(df.filter("id = 3"), {"small": rules["small"]}).collect()
    guard = validate.prefix_guard(spark.createDataFrame([("S-A1",), ("X",)], "k string"), "k", ["S-"]).first()
    assert tuple(guard) == (2, 1, False)


def test_nulls_empty_tables_and_types(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", None), (None, 2.0), (None, 4.0)], "g string, v double")
    got = sorted((str(r["g"]), str(r["s"])) for r in quantiles.stretch(df, "v", ["g"], 0.0, 1.0, "s").collect())
    assert got == [("None", "0.0"), ("None", "1.0"), ("a", "0.0"), ("a", "1.0"), ("a", "None"), ("b", "None")]
    none = df.limit(0)
    assert tuple(none.withColumn("f", F.lit(True)).agg(*aggregate.true_share("f", "n", "pct")).first()) == (0, None)
    assert aggregate.threshold_report(none, "v", 1.0).first()["fraction"] is None
    assert [r["null_pct"] for r in profile.null_rates(none).collect()] == [None, None]
    assert [r["null_pct"] for r in profile.profile(none).collect()] == [None, None]
    big = spark.createDataFrame([("x", 2**53, None), ("y", 2**53 + 1, None)], "k string, m bigint, d date")
    assert topk.extreme_row(big, "m", ["k", "d"], default={"k": "none", "d": "never"}, ties="k").first()["k"] == "y"
    assert topk.extreme_row(big, "m", ["k", "d"]).first()["d"] is None
    assert topk.extreme_row(big.withColumn("d", F.lit("2020-01-01").cast("date")), "d", ["k"], ties="k").first()["k"] == "x"
    odd = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "v double")
    assert [(r["bin"], r["n_rows"]) for r in histogram.histogram(odd, "v", 2).collect()] == [(0, 1), (1, 1), (None, 1)]
    keyed = spark.createDataFrame([(None, 1, [1, 2]), (None, 1, []), ("k", None, None)], "k string, a int, b array<int>")
    rolled = {r["k"]: (r["x"], r["y"]) for r in aggregate.entity_rollup(keyed, "k", {"x": F.col("a"), "y": F.col("b")}).collect()}
    assert rolled == {None: (1, 2), "k": (0, 0)}
    lists = {r["k"]: r["y"] for r in aggregate.entity_rollup(keyed, "k", {"y": F.col("b")}).collect()}
    assert lists == {None: 2, "k": 0}
    signed = spark.createDataFrame([("k", 0.0, [0.0, -0.0, None]), ("k", -0.0, [float("nan")] * 2), ("k", None, None)], "k string, a double, b array<double>")
    assert tuple(aggregate.entity_rollup(signed, "k", {"x": F.col("a"), "y": F.col("b")}).first()) == ("k", 1, 2)


@pytest.mark.parametrize("values,probs,want", [
    ([1.0, np.inf, np.inf], [0.25, 0.5, 0.9], [np.inf, np.inf, np.inf]), ([-np.inf, -np.inf, 2.0], [0.1, 0.5, 1.0], [-np.inf, -np.inf, 2.0]), ([-np.inf, 1.0, np.inf], [0.0, 0.5, 1.0], [-np.inf, 1.0, np.inf])])
def test_quantiles_of_infinities(spark, values, probs, want):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["prob"]: r["value"] for r in quantiles.exact_quantiles(df, ["v"], probs).collect()}
    assert [got[p] for p in probs] == want


def test_running_total_of_hot_and_null_keys(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, "a", "a", "a", "b"]), i, rng.randrange(9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, o int, v bigint").repartition(7)
    got = {(r["k"], r["o"]): r["t"] for r in indexing.running_total(df, ["k"], ["o"], "v", "t").collect()}
    total = {}
    for k, o, v in rows:
        total[k] = total.get(k, 0) + v
        assert got[k, o] == total[k]
    text = indexing.running_total(df, ["k"], ["o"], "v", "t")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" not in text.split("Exchange")[1]


def test_quantile_plan_has_no_window_per_group(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    text = quantiles.stretch(df, "v", ["g"], 0.1, 0.9, "s")._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_part" in text
    assert "windowspecdefinition(g#" not in text or "_share" in text
