"""Queries that train and score models. Fitted scores have no SQL twin; the metrics do."""

from __future__ import annotations

from pyspark.sql import functions as F

from spendline.operators import ml
from spendline.plans import mart as MT
from spendline.plans.registry import query

@query("O34_risk_scores", "SupplierID:string SupplierRiskScore:double PredictedHighRiskFlag:int ModelName:string")
def _(m):
    return m["fitted_risk_scores"]


@query("O34_candidates", "ModelName:string PrAuc:double")
def _(m):
    return m.risk_model().candidates


@query("O34_split_profile", "Part:string n:long Suppliers:long HighRisk:long", """
    SELECT CASE WHEN PerformanceYear < y THEN 'DEVELOPMENT' ELSE 'TEST' END AS Part, count(*) AS n, count(DISTINCT SupplierID) AS Suppliers, sum(HighRiskNextYearFlag) AS HighRisk
    FROM risk_labels, (SELECT max(PerformanceYear) AS y FROM risk_labels) GROUP BY 1
    UNION ALL SELECT 'SCORING', count(*), count(DISTINCT SupplierID), 0 FROM rscores""")
def _(m):
    fitted = m.risk_model()
    of = lambda df, part, label: df.agg(F.lit(part).alias("Part"), F.count("*").alias("n"), F.countDistinct("SupplierID").alias("Suppliers"), label.alias("HighRisk"))     # noqa: E731
    return (of(fitted.out_of_fold, "DEVELOPMENT", F.sum(ml.LABEL)).unionByName(of(fitted.test, "TEST", F.sum(ml.LABEL)))
            .unionByName(of(m["fitted_risk_scores"], "SCORING", F.lit(0))))


@query("O34_fold_invariants", "ModelName:string Scored:long ScoredTwice:long Missing:long OutsideUnit:long SuppliersInTwoFolds:long", """
    SELECT ModelName, n AS Scored, 0 AS ScoredTwice, 0 AS Missing, 0 AS OutsideUnit, 0 AS SuppliersInTwoFolds
    FROM (VALUES ('LogisticRegression'), ('RandomForest'), ('GradientBoosting')) AS v(ModelName),
         (SELECT count(*) AS n FROM risk_labels WHERE PerformanceYear < (SELECT max(PerformanceYear) FROM risk_labels))""")
def _(m):
    fitted = m.risk_model()
    scores = ml.stored_fold_scores(m.models, fitted.key)
    rows = scores.groupBy("ModelName", "SupplierID", "PerformanceYear").agg(F.count("*").alias("n"), F.count("Score").alias("found"), F.min("Score").alias("lo"), F.max("Score").alias("hi"))
    suppliers = scores.groupBy("ModelName", "SupplierID").agg(F.countDistinct(ml.FOLD).alias("folds")).groupBy("ModelName").agg(F.count_if(F.col("folds") > 1).alias("SuppliersInTwoFolds"))
    return (rows.groupBy("ModelName").agg(F.sum("n").alias("Scored"), F.count_if(F.col("n") > 1).alias("ScoredTwice"), F.sum(F.col("n") - F.col("found")).alias("Missing"),
                                          F.count_if((F.col("lo") < 0) | (F.col("hi") > 1)).alias("OutsideUnit"))
            .join(suppliers, "ModelName"))


@query("O34_model_store", "Name:string Entries:long", """
    SELECT * FROM (VALUES ('risk_development', 2), ('risk_final', 1), ('risk_candidates', 1), ('risk_threshold', 1), ('risk_test_scores', 1), ('risk_all_years', 1), ('risk_fold', 15)) AS v(Name, Entries)
    WHERE (SELECT count(*) FROM risk_labels) > 0""")
def _(m):
    key = m.risk_model().key
    return m.models.entries().where(F.col("ModelKey").startswith(key)).groupBy("Name").agg(F.count("*").alias("Entries"))


METRICS = "TruePositive:long FalsePositive:long FalseNegative:long TrueNegative:long RocAuc:double PrAuc:double Precision:double Recall:double F1:double F2:double Accuracy:double"


@query("O35_model_metrics", "RocAuc:double PrAuc:double Precision:double Recall:double F1:double F2:double Accuracy:double")
def _(m):
    fitted = m.risk_model()
    return ml.binary_metrics(fitted.out_of_fold, "Score", ml.LABEL, fitted.threshold)


@query("O35_test_metrics", METRICS)
def _(m):
    """The untouched year, at the threshold of the development years."""
    fitted = m.risk_model()
    return ml.binary_metrics(fitted.test, "Score", ml.LABEL, fitted.threshold)


@query("O35_test_invariants", "TestYear:int Scored:long HighRisk:long NotHighRisk:long AreasOutsideUnit:long AccuracyGap:double", """
    SELECT max(PerformanceYear) AS TestYear, count(*) AS Scored, sum(HighRiskNextYearFlag) AS HighRisk, count(*) - sum(HighRiskNextYearFlag) AS NotHighRisk, 0 AS AreasOutsideUnit, 0.0 AS AccuracyGap
    FROM risk_labels WHERE PerformanceYear = (SELECT max(PerformanceYear) FROM risk_labels)""")
def _(m):
    fitted = m.risk_model()
    tp, fp, fn, tn = (F.col(c) for c in ("TruePositive", "FalsePositive", "FalseNegative", "TrueNegative"))
    outside = sum((F.when(F.col(c).between(0, 1) | F.col(c).isNull(), 0).otherwise(1) for c in ("RocAuc", "PrAuc", "Precision", "Recall", "F1", "F2")), F.lit(0))
    year = fitted.test.agg(F.max("PerformanceYear")).scalar()
    return ml.binary_metrics(fitted.test, "Score", ml.LABEL, fitted.threshold).select(
        year.alias("TestYear"), (tp + fp + fn + tn).alias("Scored"), (tp + fn).alias("HighRisk"), (fp + tn).alias("NotHighRisk"), outside.alias("AreasOutsideUnit"),
        F.round(F.abs(F.col("Accuracy") - (tp + tn) / (tp + fp + fn + tn)), 9).alias("AccuracyGap"))


_CURVE = """(SELECT v, sum(n) OVER (ORDER BY v DESC) AS flagged, sum(p) OVER (ORDER BY v DESC) AS tp, n, p, sum(n) OVER () AS cnt, sum(p) OVER () AS pos FROM (
    SELECT PricingAnomalyScore AS v, count(*) AS n, sum(RuleBasedExtremePriceFlag) AS p FROM pscores GROUP BY 1))"""


@query("O35_binary_metrics", "TruePositive:long FalsePositive:long FalseNegative:long TrueNegative:long Precision:double Recall:double F1:double F2:double Accuracy:double RocAuc:double PrAuc:double", f"""
    SELECT tp AS TruePositive, fp AS FalsePositive, fn AS FalseNegative, tn AS TrueNegative, tp / (tp + fp) AS Precision, tp / (tp + fn) AS Recall, 2 * tp / (2 * tp + fp + fn) AS F1,
      5 * tp / (5 * tp + 4 * fn + fp) AS F2, (tp + tn) / (tp + fp + fn + tn) AS Accuracy,
      (SELECT round(sum((p * (cnt - pos - (flagged - tp)) + p * (n - p) / 2.0::DOUBLE) / (pos * (cnt - pos)::DOUBLE)), 10) FROM {_CURVE}) AS RocAuc,
      (SELECT round(sum(p / pos::DOUBLE * (tp / flagged::DOUBLE)), 10) FROM {_CURVE}) AS PrAuc
    FROM (SELECT CAST(count(*) FILTER (h AND y) AS DOUBLE) AS tp, CAST(count(*) FILTER (h AND NOT y) AS DOUBLE) AS fp, CAST(count(*) FILTER (NOT h AND y) AS DOUBLE) AS fn,
      CAST(count(*) FILTER (NOT h AND NOT y) AS DOUBLE) AS tn FROM (SELECT PricingAnomalyScore >= 50 AS h, RuleBasedExtremePriceFlag = 1 AS y FROM pscores))""")
def _(m):
    out = ml.binary_metrics(m["pricing_scores"], "PricingAnomalyScore", "RuleBasedExtremePriceFlag", 50.0)
    return out.withColumns({"RocAuc": F.round("RocAuc", 10), "PrAuc": F.round("PrAuc", 10)})


@query("O35_best_threshold", "Threshold:double F1:double", f"""
    SELECT v AS Threshold, round(2.0::DOUBLE * tp / (2 * tp + (pos - tp) + (flagged - tp)), 12) AS F1 FROM {_CURVE} ORDER BY 2 DESC, 1 DESC LIMIT 1""")
def _(m):
    curve = ml.score_curve(m["pricing_scores"], "PricingAnomalyScore", "RuleBasedExtremePriceFlag").withColumn("F1", F.round("F1", 12))
    return curve.orderBy(F.desc("F1"), F.desc("Threshold")).limit(1)


@query("O35_recall_at_precision", "RecallAtPrecision:double", f"SELECT max(tp / pos::DOUBLE) FILTER (tp / flagged::DOUBLE >= 0.85::DOUBLE) AS RecallAtPrecision FROM {_CURVE}")
def _(m):
    return ml.recall_at_precision(m["pricing_scores"], "PricingAnomalyScore", "RuleBasedExtremePriceFlag", 0.85)


def _auc(feature: str, column: str) -> str:
    return f"""SELECT '{feature}' AS FeatureName, sum(p * (coalesce(below, 0) + (n - p) / 2.0::DOUBLE)) / CAST(sum(p) * sum(n - p) AS DOUBLE) AS a FROM (
        SELECT *, sum(n - p) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below FROM (
          SELECT {column} AS v, count(*) AS n, sum(HighRiskNextYearFlag) AS p FROM risk_labels l JOIN risk f USING (SupplierID, PerformanceYear) WHERE {column} IS NOT NULL GROUP BY 1))"""


@query("O36_univariate_auc", "FeatureName:string AUC:double DirectionFreeAUC:double", f"""
    SELECT FeatureName, round(a, 10) AS AUC, round(greatest(a, 1 - a), 10) AS DirectionFreeAUC FROM ({_auc("SupplierOTDPct", "f.SupplierOTDPct")} UNION ALL {_auc("MaverickSpendPct", "f.MaverickSpendPct")}
    UNION ALL {_auc("FinancialRiskScore", "f.FinancialRiskScore")})""")
def _(m):
    out = ml.univariate_auc(m["risk_labelled"], ["SupplierOTDPct", "MaverickSpendPct", "FinancialRiskScore"], ml.LABEL)
    return out.withColumns({"AUC": F.round("AUC", 10), "DirectionFreeAUC": F.round("DirectionFreeAUC", 10)})


@query("O37_importance", "FeatureName:string Importance:double")
def _(m):
    return ml.importance(m.risk_model().model, m["risk_labelled"])


@query("O38_isolation_forest", "POItemID:string RawAnomalyScore:double PricingAnomalyScore:double PricingAnomalyFlag:int")
def _(m):
    return m["forest_production"]


_PARTS = [("DEVELOPMENT", "forest_validation", MT.SCORING_YEAR - 2), ("PRODUCTION", "forest_production", MT.SCORING_YEAR - 1)]


@query("O38_forest_recount", "Part:string ReferenceRows:long ScoredRows:long PercentileViolations:long FlagViolations:long ReviewShareViolations:long", " UNION ALL ".join(
    f"""SELECT '{part}' AS Part, count(*) FILTER (OrderYear <= {year}) AS ReferenceRows, count(*) FILTER (OrderYear = {year + 1}) AS ScoredRows,
    0 AS PercentileViolations, 0 AS FlagViolations, 0 AS ReviewShareViolations FROM price_feat WHERE BenchmarkCoverageCount >= 1""" for part, _, year in _PARTS))
def _(m):
    usable, out = m["forest_rows"], None
    for part, table, year in _PARTS:
        state = m.forest(year)
        reference = ml.iforest_score(ml.forest_of(state), usable.where(F.col("OrderYear") <= year), carry=["POItemID"])
        row = ml.recounted(reference, m[table], ml.forest_setting(state, "THRESHOLD")).withColumn("Part", F.lit(part))
        out = row if out is None else out.unionByName(row)
    return out


@query("O38_forest_state", "Part:string Trees:long Medians:long Thresholds:long LadderRows:long RootsMissing:long", " UNION ALL ".join(
    f"""SELECT '{part}' AS Part, 300 AS Trees, 16 AS Medians, 1 AS Thresholds, count(*) AS LadderRows, 0 AS RootsMissing FROM price_feat WHERE BenchmarkCoverageCount >= 1 AND OrderYear <= {year}"""
    for part, _, year in _PARTS))
def _(m):
    out, kind = None, F.col("Kind")
    for part, _, year in _PARTS:
        row = m.forest(year).agg(
            F.lit(part).alias("Part"), F.countDistinct(F.when(kind == "NODE", F.col("Tree"))).alias("Trees"), F.count_if(kind == "MEDIAN").alias("Medians"),
            F.count_if((kind == "SETTING") & (F.col("Name") == "THRESHOLD") & F.col("Value").isNotNull()).alias("Thresholds"), F.sum(F.when(kind == "LADDER", F.col("Weight"))).alias("LadderRows"),
            (F.countDistinct(F.when(kind == "NODE", F.col("Tree"))) - F.count_if((kind == "NODE") & (F.col("Node") == 0))).alias("RootsMissing"))
        out = row if out is None else out.unionByName(row)
    return out


PROXY = "RowCount:long FlaggedCount:long ProxyPrevalence:double FlaggedRate:double Precision:double Recall:double PrecisionLift:double ExceptionRate:double FlaggedExceptionRate:double ExceptionLift:double"


@query("O40_forest_validation", PROXY)
def _(m):
    """The forest's own flags in the untouched validation year against the transparent proxy and contract exceptions."""
    return ml.proxy_eval(m["forest_validation"], "PricingAnomalyFlag", "RuleBasedExtremePriceFlag", "PriceComplianceExceptionFlag")


@query("O40_forest_validation_base", "RowCount:long ProxyPrevalence:double ExceptionRate:double FlagGap:long", f"""
    SELECT count(*) AS RowCount, round(avg(RuleBasedExtremePriceFlag), 10) AS ProxyPrevalence, round(avg(coalesce(PriceComplianceExceptionFlag, 0)), 10) AS ExceptionRate, 0 AS FlagGap
    FROM price_feat WHERE BenchmarkCoverageCount >= 1 AND OrderYear = {MT.SCORING_YEAR - 1}""")
def _(m):
    rows = m["forest_validation"]
    flagged = rows.agg(F.count_if(F.col("PricingAnomalyFlag") == 1)).scalar()
    out = ml.proxy_eval(rows, "PricingAnomalyFlag", "RuleBasedExtremePriceFlag", "PriceComplianceExceptionFlag")
    return out.select("RowCount", F.round("ProxyPrevalence", 10).alias("ProxyPrevalence"), F.round("ExceptionRate", 10).alias("ExceptionRate"), (F.col("FlaggedCount") - flagged).alias("FlagGap"))


_SOURCES = {"ml_supplier_risk_prediction": "rscores", "ml_pricing_anomaly_prediction": "pscores", "ml_savings_opportunity": "opp"}


@query("O46_promotion", "TableName:string RowCount:long GrainRepeats:long MissingKeys:long NoSupplierVersion:long Batches:long LogEntries:long ChangedByRerun:long OtherDates:long", " UNION ALL ".join(
    f"""SELECT '{t}' AS TableName, count(*) AS RowCount, 0 AS GrainRepeats, 0 AS MissingKeys, count(*) FILTER (SupplierID NOT IN (
      SELECT SupplierID FROM dim_supplier WHERE DATE '{MT.AS_OF}' BETWEEN EffectiveFromDate AND EffectiveToDate)) AS NoSupplierVersion, 1 AS Batches, 1 AS LogEntries, 0 AS ChangedByRerun,
      0 AS OtherDates FROM {n}""" for t, n in _SOURCES.items()))
def _(m):
    """All three products promoted, then promoted again."""
    out = None
    for name in _SOURCES:
        product, batch = MT.products()[name], m.promote(name)
        before = m.gold.read(name).agg(F.max("PromotionTimestamp")).first()[0]
        again = m.promote(name)
        gold, log = m.gold.read(name), m.gold.monitoring().where(F.col("TableName") == name)
        missing = F.lit(False)
        for k in product.keys:
            missing = missing | F.col(k).isNull()
        row = gold.agg(F.lit(name).alias("TableName"), F.count("*").alias("RowCount"), (F.count("*") - F.countDistinct(*product.grain, "PredictionDate")).alias("GrainRepeats"),
                       F.count_if(missing).alias("MissingKeys"), F.count_if(F.col("SupplierKey").isNull()).alias("NoSupplierVersion"), F.countDistinct("PromotionBatchID").alias("Batches"), log.agg(F.count("*")).scalar().alias("LogEntries"),
                       (F.count_if(F.col("PromotionTimestamp") != F.lit(before)) + F.lit(int(batch != again))).alias("ChangedByRerun"),
                       F.count_if(F.col("PredictionDate") != F.to_date(F.lit(MT.AS_OF))).alias("OtherDates"))
        out = row if out is None else out.unionByName(row)
    return out
