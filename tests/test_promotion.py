"""Stored models, temporal evaluation, forests as tables, idempotent promotion, one-shuffle references and seeded damage."""

import random
from collections import Counter

import duckdb
import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import Observation
from pyspark.sql import functions as F

from spendline.operators import damage, joins, ml, promotion
from spendline.operators import quality as QL
from spendline.operators.model_store import ModelStore, fingerprint
from spendline.operators.windows import reference_percentile
from spendline.session import stage_path


def test_fingerprint_sees_rows_not_their_order(spark):
    rows = [(k, None if k % 5 == 0 else f"v{k}") for k in range(50)]
    df = lambda r, n: spark.createDataFrame(r, "a long, b string").repartition(n)      # noqa: E731
    one = fingerprint(df(rows, 1), "x")
    assert one == fingerprint(df(rows[::-1], 7).select("b", "a"), "x") and len(one) == 16
    assert len({one, fingerprint(df(rows, 1), "y"), fingerprint(df(rows[1:], 1), "x"), fingerprint(df(rows + rows[:1], 1), "x"), fingerprint(df([(0, ""), *rows[1:]], 1), "x")}) == 5
    assert fingerprint(df([], 1)) == fingerprint(df([], 2))


def test_store_builds_once_and_after_an_interrupted_build_again(spark):
    store, calls = ModelStore(spark, stage_path(spark, "store")), []

    def build():
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return spark.range(3)

    assert store.entries().count() == 0
    with pytest.raises(RuntimeError):
        store.table("t", "k", build)
    assert [store.table("t", "k", build).count() for _ in range(3)] == [3, 3, 3] and len(calls) == 2
    assert store.table("t", "other", build).count() == 3 and len(calls) == 3
    assert Counter(r.Name for r in store.entries().collect()) == {"t": 2}


def risk_rows(spark, years=(1996, 1997, 1998, 1999), suppliers=40):
    rng = random.Random(2)
    rows = []
    for year in years:
        for s in range(suppliers):
            x = rng.random()
            rows.append((f"S{s}", year, int(x + rng.random() * 0.3 > 0.7), x, None if s % 9 == 0 else float(s), ["A", None, "B"][s % 3]))
    out = spark.createDataFrame(rows, f"SupplierID string, PerformanceYear int, {ml.LABEL} int, SupplierOTDPct double, MaverickSpendPct double, SupplierType string")
    missing = [c for c in ml.NUMERIC if c not in out.columns]
    return out.withColumns({c: F.lit(None).cast("double") for c in missing} | {"Region": F.lit("R"), "ESGRating": F.lit(None).cast("string")})


def test_last_year_is_untouched_until_the_end(spark, monkeypatch):
    store, train = ModelStore(spark, stage_path(spark, "risk")), risk_rows(spark)
    specs = {name: LogisticRegression(maxIter=20, regParam=r, labelCol=ml.LABEL, featuresCol="features", weightCol="ClassWeight") for name, r in (("A", 0.01), ("B", 1.0))}
    fitted = ml.fit_risk(train, store, specs, folds=3)
    scores = ml.stored_fold_scores(store, fitted.key)
    assert Counter(r.PerformanceYear for r in fitted.out_of_fold.collect()) == {1996: 40, 1997: 40, 1998: 40}
    assert Counter(r.PerformanceYear for r in fitted.test.collect()) == {1999: 40} and fitted.candidates.count() == 2
    assert scores.count() == 240 and scores.groupBy("SupplierID").agg(F.countDistinct("Fold").alias("n")).where("n > 1").count() == 0
    metrics = ml.binary_metrics(fitted.test, "Score", ml.LABEL, fitted.threshold).first()
    assert metrics.RocAuc > 0.8 and metrics.TruePositive + metrics.FalseNegative == train.where(f"PerformanceYear = 1999 AND {ml.LABEL} = 1").count()

    def never(*_):
        raise AssertionError("fitted again")

    monkeypatch.setattr(ml, "risk_pipeline", never)
    again = ml.fit_risk(train, store, specs, folds=3)
    assert again.threshold == fitted.threshold and again.name == fitted.name and again.key == fitted.key
    assert sorted(ml.score_risk(again.model, train).select("Score").collect()) == sorted(ml.score_risk(fitted.model, train).select("Score").collect())
    with pytest.raises(AssertionError):     # other rows, other key
        ml.fit_risk(train.where("SupplierID <> 'S1'"), store, specs, folds=3)
    with pytest.raises(ValueError):
        ml.fit_risk(train.where("PerformanceYear = 1999"), store, specs)


def test_risk_is_fitted_in_a_session_that_has_observed_something(spark):
    spark.range(3).observe(Observation(), F.count(F.lit(1)).alias("n")).count()
    store, train = ModelStore(spark, stage_path(spark, "risk")), risk_rows(spark)
    common = {"labelCol": ml.LABEL, "featuresCol": "features", "weightCol": "ClassWeight"}
    specs = {"A": LogisticRegression(maxIter=20, regParam=0.01, **common), "B": RandomForestClassifier(numTrees=3, maxDepth=2, seed=1, **common)}
    fitted = ml.fit_risk(train, store, specs, folds=2)
    assert ml.stored_fold_scores(store, fitted.key).groupBy("ModelName").count().count() == 2 and fitted.test.count() == 40


def test_a_forest_is_grown_by_several_tasks_and_boosting_by_few(spark, monkeypatch):
    monkeypatch.setattr(ml, "FOREST_ROWS", 50)
    df = spark.range(400)
    path = stage_path(spark, "parts")
    ml._few_parts(df, df).write.parquet(path)
    rows = spark.read.parquet(path)
    assert rows.count() == 400 and rows.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    specs = ml.estimators()
    assert ml._worth(rows, specs["RandomForest"], 400).rdd.getNumPartitions() == rows.rdd.getNumPartitions()
    assert {ml._worth(rows, specs[n], 400).rdd.getNumPartitions() for n in ("GradientBoosting", "LogisticRegression")} == {1}


def test_forest_from_its_table_scores_as_before(spark):
    rng = random.Random(4)
    names = ["x", "y"]
    rows = [(f"I{k}", rng.gauss(0, 1) + (9 if k % 50 == 0 else 0), None if k % 7 == 0 else rng.gauss(0, 1)) for k in range(400)]
    train = spark.createDataFrame(rows, "POItemID string, x double, y double")
    forest = ml.iforest_fit(train, names, trees=20, sample=64)
    reference = ml.iforest_score(forest, train, carry=["POItemID"]).checkpoint()
    path = stage_path(spark, "forest")
    ml.forest_state(forest, reference).write.parquet(path)
    state = spark.read.parquet(path)
    other = train.withColumn("x", F.col("x") + 1)
    got = {r.POItemID: r for r in ml.forest_apply(state, other, ["POItemID"]).collect()}
    direct = ml.iforest_score(forest, other, carry=["POItemID"])
    want = {r.POItemID: r for r in reference_percentile(reference, direct, "RawAnomalyScore", "Score").collect()}
    assert all(abs(got[k].RawAnomalyScore - want[k].RawAnomalyScore) < 1e-12 and abs(got[k].PricingAnomalyScore - want[k].Score) < 1e-9 for k in want) and len(got) == 400
    cut = ml.forest_setting(state, "THRESHOLD")
    assert all(r.PricingAnomalyFlag == int(r.RawAnomalyScore >= cut) for r in got.values())
    counts = ml.recounted(reference, ml.forest_apply(state, other, ["POItemID"]), cut).first()
    assert tuple(counts) == (400, 400, 0, 0, 0)
    wrong = ml.forest_apply(state, other, ["POItemID"]).withColumn("PricingAnomalyScore", F.lit(50.0))
    assert ml.recounted(reference, wrong, cut).first().PercentileViolations > 0
    with pytest.raises(ValueError):
        ml.MOST_NODES, kept = 10, ml.MOST_NODES
        try:
            ml.iforest_score(forest, train)
        finally:
            ml.MOST_NODES = kept


PRODUCT = "K string, PredictionDate date, Score double, Flag int, DimKey long, Rank int"


def product():
    return promotion.Product("p", ("K",), ("DimKey",), promotion.score_rules("Score", "Flag"), ("Score",), ("Rank",), {"K": "K"})


def test_promotion_is_idempotent_and_a_failed_check_leaves_gold_alone(spark):
    gold = promotion.GoldStore(spark, stage_path(spark, "gold"))
    frame = lambda rows: spark.createDataFrame(rows, "K string, d string, Score double, Flag int, DimKey long, Rank int").select("K", F.to_date("d").alias("PredictionDate"), "Score", "Flag", "DimKey", "Rank")       # noqa: E731
    first = frame([("a", "2001-01-31", 1.5, 0, 1, 1), ("b", "2001-01-31", 99.0, 1, 2, 2)])
    parents = {"K": spark.createDataFrame([("a",), ("b",), ("c",)], "K string")}
    assert gold.read("p") is None and gold.monitoring().count() == 0
    batch = gold.promote(first, first, product(), parents)
    rows = lambda: sorted(map(tuple, gold.read("p").collect()), key=str)      # noqa: E731
    before = rows()
    assert gold.promote(first.repartition(3), first, product(), parents) == batch and rows() == before and gold.monitoring().count() == 1
    later = first.withColumn("PredictionDate", F.to_date(F.lit("2001-02-28")))
    assert gold.promote(later, later, product(), parents) != batch
    assert len(rows()) == 4 and gold.monitoring().count() == 2 and set(before) < set(rows())
    kept = rows()
    bad = [first.withColumn("Score", F.lit(101.0)), first.withColumn("Flag", F.lit(2)), first.withColumn("DimKey", F.lit(None).cast("long")), first.unionByName(first.limit(1)), first.limit(1),
           first.withColumn("Rank", F.lit(1)), first.withColumn("K", F.concat("K", F.lit("x")))]
    for rows_ in bad:
        with pytest.raises(QL.GateFailed):
            gold.promote(rows_, first, product(), parents)
    assert rows() == kept and gold.monitoring().count() == 2
    changed = first.withColumn("Score", F.col("Score") / 2)
    gold.promote(changed, first, product(), parents)
    assert len(rows()) == 4 and {r.Score for r in gold.read("p").where("PredictionDate = '2001-01-31'").collect()} == {0.75, 49.5} and gold.monitoring().count() == 3
    with pytest.raises(ValueError):
        gold.promote(first.unionByName(later), first.unionByName(later), promotion.Product("q", ("K",), (), promotion.score_rules("Score")), {})


def test_lost_log_entry_is_written_by_the_next_run(spark, monkeypatch):
    gold = promotion.GoldStore(spark, stage_path(spark, "gold"))
    rows = spark.createDataFrame([("a", 5.0, 1, 1, 1)], "K string, Score double, Flag int, DimKey long, Rank int").withColumn("PredictionDate", F.to_date(F.lit("2001-01-31")))
    parents, totals, seen = {"K": rows.select("K")}, promotion.GoldStore._totals, []

    def lost(df, columns):      # the run ends after the write, before it is compared and logged
        seen.append(1)
        if len(seen) == 2:
            raise RuntimeError("executor lost")
        return totals(df, columns)

    monkeypatch.setattr(promotion.GoldStore, "_totals", staticmethod(lost))
    with pytest.raises(RuntimeError):
        gold.promote(rows, rows, product(), parents)
    assert gold.read("p").count() == 1 and gold.monitoring().count() == 0
    gold.promote(rows, rows, product(), parents)
    gold.promote(rows, rows, product(), parents)
    assert gold.read("p").count() == 1 and gold.monitoring().count() == 1


def test_references_in_one_shuffle_equal_one_join_each(spark):
    rng = random.Random(6)
    pick = lambda: rng.choice([None, *"abcdef"])      # noqa: E731
    child = spark.createDataFrame([(pick(), pick(), rng.choice([None, 1, 2, 3])) for _ in range(300)] + [("hot", "a", 1)] * 500, "x string, y string, n int")
    parent = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", None), ("a", 1)], "k string, m int")
    edges = [QL.Reference(("x",), parent, ("k",), "p"), QL.Reference(("y",), parent, ("k",), "p", True), QL.Reference(("x", "n"), parent, ("k", "m"), "p"), QL.Reference(("y", "n"), parent, ("k", "m"), "p", True)]
    got = [r.FailedRecordCount for r in QL.reference_rules(child, "t", edges).collect()]
    want = [QL.fk_rule(child, "t", e.columns, e.parent, e.parent_columns, "p", e.nullable).first().FailedRecordCount for e in edges]
    assert got == want and all(got)
    assert [r.FailedRecordCount for r in QL.reference_rules(child.limit(0), "t", edges).collect()] == [0, 0, 0, 0]
    plan = QL.reference_rules(child, "t", edges)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_damage_strikes_the_same_keys_in_sql(spark):
    rows = [(f"k{k}", k) for k in range(500)] + [(None, -1)]
    df = spark.createDataFrame(rows, "key string, v int")
    con = duckdb.connect()
    con.execute("CREATE TABLE t (key VARCHAR, v INT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    hit = {k for k, in con.execute(f"SELECT key FROM t WHERE {damage.struck_sql('key', 'm')}").fetchall()}
    assert hit == {r.key for r in df.where(damage.struck("key", "m")).collect()} and 30 < len(hit) < 100
    out = {r.key: r.v for r in damage.damaged(df, "key", {"m": {"v": F.col("v") + 1000}, "other": {"v": F.lit(None)}}).collect()}
    other = {r.key for r in df.where(damage.struck("key", "other")).collect()}
    assert all(out[k] == (None if k in other else v + 1000 if k in hit else v) for k, v in rows)
    assert damage.repeated(df, "key", "m").count() == 501 + len(hit) and damage.removed(df, "key", "m").count() == 501 - len(hit)


def test_lookup_spreads_null_and_hot_keys(spark):
    rng = random.Random(9)
    rows = [(None if k % 10 else f"k{rng.randint(0, 400)}", k) for k in range(6000)] + [("hot", k) for k in range(6000, 12000)] + [("lost", -1), ("lost", -1)]
    df = spark.createDataFrame(rows, "key string, v long")
    ref = spark.createDataFrame([(f"k{k}", k) for k in range(300)] + [("hot", -7), (None, -8), ("k1", 1000)], "id string, value long")
    plain = lambda out: Counter(map(tuple, out.select("key", "v", "value", "hit").collect()))      # noqa: E731
    want = plain(joins.lookup(df, ref, {"key": "id"}, ["value"], found="hit"))
    out = joins.lookup_skewed(df, ref, {"key": "id"}, ["value"], found="hit")
    assert plain(out) == want and out.columns == ["key", "v", "value", "hit"]
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        for k, v in {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}.items():
            spark.conf.set(k, v)
        spread = sorted(r[1] for r in joins.lookup_skewed(df, ref, {"key": "id"}, ["value"], salts=256).groupBy(F.spark_partition_id()).count().collect())
        one = sorted(r[1] for r in joins.lookup(df, ref, {"key": "id"}, ["value"]).groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert spread[-1] <= 2 * spread[len(spread) // 2] and one[-1] > 2 * one[len(one) // 2]
