"""Supplier-risk classification and price-anomaly detection, trained and scored on the cluster."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from spendline.functions.exprs import ratio
from spendline.operators.model_store import ModelStore, fingerprint
from spendline.operators.windows import cumulative_by_value, exact_quantiles, ladder_percentile
from spendline.session import reliable

NUMERIC = ["AnnualizedEligibleSpendEUR", "ContractCompliancePct", "MaverickSpendPct", "SupplierOTDPct", "LateFullyReceivedPct",
           "OverdueOpenDeliveryExposurePct", "SupplierQualityIndexPct", "InvoiceDisputePct", "DuplicateInvoicePct",
           "ThreeWayMatchPct", "InvoiceExceptionPct", "YoYSpendChangePct", "YoYOTDChangePp", "YoYInvoiceDisputeChangePp",
           "YoYMaverickSpendChangePp", "SpendVolatilityPct", "SupplierSpendSharePct", "LogAnnualizedEligibleSpendEUR",
           "RiskMetricCoveragePct", "FinancialRiskScore"]
CATEGORICAL = ["SupplierType", "Region", "ESGRating"]
LABEL, FOLD = "HighRiskNextYearFlag", "Fold"

PRICING_FEATURES = ["LogPriceToMaterialHistoricalRatio", "LogPriceToSupplierMaterialHistoricalRatio",
                    "LogPriceToCategoryHistoricalRatio", "MaterialPriceZScore", "SupplierMaterialPriceZScore", "CategoryPriceZScore",
                    "ContractPriceVariancePct", "SupplierMaterialHistoricalCVPct", "LogUnitPriceEUR", "LogQuantity",
                    "LogLineAmountEUR", "HasMaterialHistoryFlag", "HasSupplierMaterialHistoryFlag", "HasCategoryHistoryFlag",
                    "HasContractBenchmarkFlag", "BenchmarkCoverageCount"]


# ---------------------------------------------------------------------- classification

def risk_pipeline(estimator, numeric: Sequence[str], categorical: Sequence[str]) -> Pipeline:
    """Median imputation and scaling of numbers, one-hot labels with room for unseen ones."""
    medians = Imputer(strategy="median", inputCols=list(numeric), outputCols=[f"__i_{c}" for c in numeric])
    index = StringIndexer(inputCols=list(categorical), outputCols=[f"__x_{c}" for c in categorical], handleInvalid="keep")
    hot = OneHotEncoder(inputCols=index.getOutputCols(), outputCols=[f"__h_{c}" for c in categorical], handleInvalid="keep")
    numbers = VectorAssembler(inputCols=medians.getOutputCols(), outputCol="__numbers")
    scaled = StandardScaler(inputCol="__numbers", outputCol="__scaled", withMean=True)
    whole = VectorAssembler(inputCols=["__scaled", *hot.getOutputCols()], outputCol="features")
    return Pipeline(stages=[medians, index, hot, numbers, scaled, whole, estimator])


def estimators(seed: int = 42) -> dict:
    """The three candidates; tree sizes, rounds and rate are fixed values of the risk model."""
    common = {"labelCol": LABEL, "featuresCol": "features", "weightCol": "ClassWeight"}
    return {"LogisticRegression": LogisticRegression(maxIter=2000, regParam=0.01, **common),
            "RandomForest": RandomForestClassifier(numTrees=500, maxDepth=8, minInstancesPerNode=5, seed=seed, **common),
            "GradientBoosting": GBTClassifier(maxIter=200, stepSize=0.05, maxDepth=2, minInstancesPerNode=8, seed=seed, **common)}


def usable_numbers(df: DataFrame, columns: Sequence[str] = NUMERIC) -> list[str]:
    """Columns with at least one value: a median of nothing does not exist."""
    seen = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    return [c for c in columns if seen[c] > 0]


def training_frame(labelled: DataFrame, folds: int = 5) -> DataFrame:
    """Folds that keep a supplier together and spread high-risk suppliers evenly; balanced weights.

    Suppliers are ordered by a hash within their stratum (ever high risk or not) and dealt out in
    turn, one row per supplier.
    """
    from pyspark.sql import Window
    stratum = labelled.groupBy("SupplierID").agg(F.max(LABEL).alias("__s"))
    shard = F.pmod(F.xxhash64("SupplierID"), F.lit(256))
    deal = Window.partitionBy("__s", "__shard").orderBy(F.xxhash64("SupplierID"), "SupplierID")
    fold = F.pmod(F.row_number().over(deal) + F.col("__shard"), F.lit(folds)).cast("int")
    dealt = stratum.withColumn("__shard", shard).select("SupplierID", fold.alias(FOLD))
    positives = labelled.agg(F.avg(F.col(LABEL).cast("double"))).scalar()
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), positives))
    weight = F.when(F.col(LABEL) == 1, 0.5 / p).otherwise(0.5 / (1 - p))
    return (labelled.join(dealt, "SupplierID").withColumn("ClassWeight", weight)
            .fillna("Unknown", subset=[c for c in CATEGORICAL if c in labelled.columns]))


def score_risk(model: PipelineModel, df: DataFrame, name: str = "Score") -> DataFrame:
    ready = df.fillna("Unknown", subset=CATEGORICAL)
    out = model.transform(ready).withColumn(name, vector_to_array("probability")[1])
    return out.select(*df.columns, name)


@dataclass
class RiskModel:
    name: str
    threshold: float
    numeric: list[str]
    candidates: DataFrame       # one row per candidate: out-of-fold PR-AUC
    out_of_fold: DataFrame      # SupplierID, PerformanceYear, label, ModelName, Fold, Score of the winner in the development years
    test: DataFrame             # the untouched last year, scored once by the model of the development years
    model: PipelineModel        # the winner, fitted again on all years
    key: str


SCORE_COLUMNS = ["SupplierID", "PerformanceYear", LABEL, "Score"]


def fold_scores(data: DataFrame, specs: dict, numeric: Sequence[str], store: ModelStore, key: str, folds: int, parallelism: int = 8) -> DataFrame:
    """Out-of-fold scores of all candidates as one table, partitioned by `ModelName` and `Fold`.

    Each fold of each candidate is fitted, scores its own rows into its own partition and is forgotten: no plan holds two models. A few
    folds are fitted side by side; forests come after the others, as their tasks of seconds would hold up thousands of short jobs. Folds that are
    already written (of a run that was interrupted) are kept.
    """
    base, rows = store.path("tables", "risk_fold_scores", key), data.count()

    def run(part: tuple[str, int]) -> None:
        name, fold = part
        if store.has("risk_fold", f"{key}-{name}-{fold}"):
            return
        fitted = _bare(risk_pipeline(specs[name], numeric, CATEGORICAL).fit(_worth(data.where(F.col(FOLD) != fold), specs[name], rows)), store.path("models", "risk_fold", f"{key}-{name}-{fold}"))
        scored = score_risk(fitted, data.where(F.col(FOLD) == fold)).select(*SCORE_COLUMNS)
        scored.write.mode("overwrite").parquet(f"{base}/ModelName={name}/{FOLD}={fold}")
        store.register("risk_fold", f"{key}-{name}-{fold}", "tables")

    parts = [(name, fold) for name in reversed(specs) for fold in range(folds)]
    with ThreadPool(min(parallelism, len(parts))) as pool:
        for forest in (False, True):
            pool.map(inheritable_thread_target(store.spark)(run), [p for p in parts if isinstance(specs[p[0]], RandomForestClassifier) == forest], chunksize=1)
    return stored_fold_scores(store, key)


def _bare(model: PipelineModel, path: str) -> PipelineModel:
    """The model as it reads back. A fresh one may hold the summary of its training, and with it the session, which cannot travel to the tasks once anything was observed in it."""
    if not getattr(model.stages[-1], "hasSummary", False):
        return model
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def stored_fold_scores(store: ModelStore, key: str) -> DataFrame:
    return store.spark.read.parquet(store.path("tables", "risk_fold_scores", key))


def fit_risk(train: DataFrame, store: ModelStore, specs: dict | None = None, folds: int = 5, year: str = "PerformanceYear") -> RiskModel:
    """Model selection on the development years, one evaluation on the last year, refit on all.

    The last labelled year is untouched until the end. On the years before it: grouped cross-validation of each candidate, the winner by
    out-of-fold PR-AUC, its F1-optimal threshold from the same out-of-fold scores. The winner fitted on the development years scores
    the last year once; then it is fitted on all years for use. Scores, both models and the settings lie in `store` under
    a fingerprint of rows and settings: a second call with the same rows reads them. Candidates and folds are a fixed handful;
    every fit and every scoring pass is a Spark job over the whole frame.
    """
    specs = specs or estimators()
    key = fingerprint(train, folds, *[f"{name}: {sorted((p.name, v) for p, v in e.extractParamMap().items())}" for name, e in specs.items()])
    first, last = train.agg(F.min(year), F.max(year)).first()
    if first == last:
        raise ValueError("temporal evaluation needs at least two labelled years")
    folded = store.table("risk_development", key, lambda: _few_parts(training_frame(train.where(F.col(year) < last), folds), train))
    numeric = usable_numbers(folded)
    scores = fold_scores(folded, specs, numeric, store, key, folds)

    def ranked() -> DataFrame:
        out = None
        for name in specs:      # a handful of one-row aggregates
            row = score_curve(scores.where(F.col("ModelName") == name), "Score", LABEL).agg(F.max("AveragePrecision").alias("PrAuc")).withColumn("ModelName", F.lit(name))
            out = row if out is None else out.unionByName(row)
        return out.coalesce(1)

    candidates = store.table("risk_candidates", key, ranked)
    best = candidates.orderBy(F.desc_nulls_last("PrAuc"), "ModelName").first()["ModelName"]
    out_of_fold = scores.where(F.col("ModelName") == best)
    threshold = store.table("risk_threshold", key, lambda: store.spark.range(1).select(F.lit(best_threshold(out_of_fold, "Score", LABEL)).alias("Threshold"))).first()["Threshold"]
    whole = store.table("risk_all_years", key, lambda: _few_parts(training_frame(train, folds), train))

    def refit(part: tuple[str, DataFrame]) -> PipelineModel:
        name, rows = part
        return store.model(name, f"{key}-{best}", lambda: risk_pipeline(specs[best], numeric, CATEGORICAL).fit(_worth(rows, specs[best], rows.count())))

    with ThreadPool(2) as pool:     # neither needs the other
        development, final = pool.map(inheritable_thread_target(store.spark)(refit), [("risk_development", folded), ("risk_final", whole)])
    test = store.table("risk_test_scores", key, lambda: score_risk(development, train.where(F.col(year) == last)).select(*SCORE_COLUMNS))
    return RiskModel(best, threshold, numeric, candidates, out_of_fold, test, final, key)


ROWS_A_PART, FOREST_ROWS = 50_000, 2_500


def _few_parts(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Partitions for the fits: as many as the cores can grow a forest in, at least one per `ROWS_A_PART` rows and at most one per `FOREST_ROWS`."""
    n, cores = rows.count(), df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, -(-n // ROWS_A_PART), min(cores, -(-n // FOREST_ROWS))))


def _worth(df: DataFrame, estimator, rows: int) -> DataFrame:
    """A pass of a forest grows hundreds of trees at once and takes seconds a task, so it keeps all partitions; boosting and regression run
    thousands of short passes and take one partition per `ROWS_A_PART` rows."""
    return df if isinstance(estimator, RandomForestClassifier) else df.coalesce(max(1, -(-rows // ROWS_A_PART)))


# ---------------------------------------------------------------------- metrics

def score_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Confusion counts and metrics at every distinct score taken as threshold (score >= threshold).

    Rows collapse to distinct scores first; the cumulative counts come from the distributed
    running total, so no task sees the whole table.
    """
    from spendline.operators.windows import _placed
    from pyspark.sql import Window
    points = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("Threshold")).agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("p"))
    placed = _placed(points, [F.col("Threshold").desc()])
    sums = placed.groupBy("__part").agg(F.sum("n").alias("sn"), F.sum("p").alias("sp"))
    prior = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    offs = sums.select("__part", zero(F.sum("sn").over(prior)).alias("on"), zero(F.sum("sp").over(prior)).alias("op"))
    run = Window.partitionBy("__part").orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    out = (placed.withColumns({"rn": F.sum("n").over(run), "rp": F.sum("p").over(run)}).join(F.broadcast(offs), "__part")
           .withColumns({"Flagged": F.col("rn") + F.col("on"), "TruePositive": F.col("rp") + F.col("op")}))
    totals = points.agg(F.sum("n").alias("N"), F.sum("p").alias("P"))
    all_, pos = totals.select("N").scalar(), totals.select("P").scalar()
    tp, fp = F.col("TruePositive"), F.col("Flagged") - F.col("TruePositive")
    fn, tn = pos - tp, all_ - pos - fp
    precision, recall = ratio(tp, F.col("Flagged")), ratio(tp, pos)
    fscore = lambda b: ratio(tp * (1 + b * b), tp * (1 + b * b) + fn * (b * b) + fp)
    out = out.withColumns({
        "FalsePositive": fp, "FalseNegative": fn, "TrueNegative": tn, "Precision": precision, "Recall": recall,
        "F1": fscore(1), "F2": fscore(2), "Accuracy": ratio(tp + tn, all_),
        # Step sums: recall gained times precision, and trapezoids under the ROC curve.
        "__ap": ratio(F.col("p"), pos) * precision,
        "__auc": ratio(F.col("p") * (all_ - pos - fp) + F.col("p") * (F.col("n") - F.col("p")) / 2.0, pos * (all_ - pos))})
    ap, auc = out.agg(F.sum("__ap").alias("a")).scalar(), out.agg(F.sum("__auc").alias("a")).scalar()
    return out.withColumns({"AveragePrecision": ap, "RocAuc": auc}).drop("__part", "__pos", "rn", "rp", "on", "op", "n", "p", "__ap", "__auc")


def best_threshold(df: DataFrame, score: str, label: str, metric: str = "F1") -> float:
    row = score_curve(df, score, label).orderBy(F.desc_nulls_last(metric), F.desc("Threshold")).select("Threshold").first()
    return float(row[0]) if row else 0.5


def recall_at_precision(df: DataFrame, score: str, label: str, target: float = 0.85) -> DataFrame:
    return score_curve(df, score, label).agg(F.max(F.when(F.col("Precision") >= target, F.col("Recall"))).alias("RecallAtPrecision"))


def binary_metrics(df: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    """One row: threshold-free and threshold metrics."""
    hit, pos = F.coalesce(F.col(score) >= threshold, F.lit(False)), F.col(label) == 1
    counts = df.agg(F.count_if(hit & pos).alias("TruePositive"), F.count_if(hit & ~pos).alias("FalsePositive"),
                    F.count_if(~hit & pos).alias("FalseNegative"), F.count_if(~hit & ~pos).alias("TrueNegative"))
    tp, fp, fn, tn = (F.col(c) for c in ("TruePositive", "FalsePositive", "FalseNegative", "TrueNegative"))
    curve = score_curve(df, score, label)
    return counts.withColumns({
        "Precision": ratio(tp, tp + fp), "Recall": ratio(tp, tp + fn), "F1": ratio(2 * tp, 2 * tp + fp + fn),
        "F2": ratio(5 * tp, 5 * tp + 4 * fn + fp), "Accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "RocAuc": curve.agg(F.max("RocAuc")).scalar(), "PrAuc": curve.agg(F.max("AveragePrecision")).scalar()})


def univariate_auc(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Rank-sum AUC of every feature on its own, whatever its direction (max of AUC and 1 - AUC).

    Features are unpivoted and collapsed to distinct values. One distributed running total over
    (feature, value) counts the negatives below each value; a feature's own count is the distance to
    where the feature begins, so no task holds all values of a feature.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("FeatureName"), F.col(c).cast("double").alias("v")) for c in columns])
    points = (df.select(F.col(label).cast("long").alias("y"), F.inline(pairs)).where(F.col("v").isNotNull())
              .groupBy("FeatureName", "v").agg(F.count("*").alias("n"), F.sum("y").alias("p")))
    points = reliable(points.withColumn("neg", F.col("n") - F.col("p")))
    ladder = cumulative_by_value(points, ["FeatureName", "v"], F.col("neg")).withColumn("below", F.col("Cumulative") - F.col("Weight"))
    starts = ladder.groupBy("FeatureName").agg(F.min("below").alias("start"))
    steps = points.join(ladder.select("FeatureName", "v", "below"), ["FeatureName", "v"]).join(F.broadcast(starts), "FeatureName")
    wins = F.col("p") * (F.col("below") - F.col("start") + F.col("neg") / 2.0)
    out = steps.groupBy("FeatureName").agg(F.sum(wins).alias("w"), F.sum("p").alias("P"), F.sum("neg").alias("N"))
    auc = F.try_divide(F.col("w"), (F.col("P") * F.col("N")).cast("double"))
    return out.select("FeatureName", auc.alias("AUC"), F.greatest(auc, 1 - auc).alias("DirectionFreeAUC"))


def importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Feature importances or absolute coefficients, largest first; names from the vector metadata."""
    attrs = model.transform(df.fillna("Unknown", subset=CATEGORICAL).limit(1)).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a.get("name", str(a["idx"])) for group in attrs.values() for a in group}
    last = model.stages[-1]
    values = last.featureImportances.toArray() if hasattr(last, "featureImportances") else np.abs(last.coefficients.toArray())
    numeric = [c.removeprefix("__i_") for c in model.stages[0].getOutputCols()]
    label = lambda i: numeric[i] if i < len(numeric) else names.get(i, str(i)).removeprefix("__h_")
    rows = [(label(i), float(v)) for i, v in enumerate(values)]
    return df.sparkSession.createDataFrame(rows, "FeatureName string, Importance double").orderBy(F.desc("Importance"), "FeatureName")


# ---------------------------------------------------------------------- isolation forest

MOST_NODES = 4_000_000       # of a forest that travels to the tasks: 160 MB
NODE = "Tree int, Node int, Feature int, Split double, Left int, Right int, PathLength double"


def _mean_path(n: float) -> float:
    """Expected path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _grow(pdf: pd.DataFrame, columns: Sequence[str], seed: int) -> pd.DataFrame:
    """One random isolation tree from one subsample (at most the subsample size in rows)."""
    tree = int(pdf["Tree"].iloc[0])
    data = pdf.sort_values("__h")[list(columns)].to_numpy(float)
    rng = np.random.default_rng([seed, tree])
    limit = int(np.ceil(np.log2(max(2, len(data)))))
    nodes, todo = [], [(0, np.arange(len(data)), 0)]
    next_id = 1
    while todo:
        node, rows, depth = todo.pop()
        lo, hi = data[rows].min(axis=0), data[rows].max(axis=0)
        open_ = np.flatnonzero(hi > lo)
        if depth >= limit or len(rows) <= 1 or len(open_) == 0:
            nodes.append((tree, node, -1, 0.0, -1, -1, depth + _mean_path(len(rows))))
            continue
        f = int(rng.choice(open_))
        at = float(rng.uniform(lo[f], hi[f]))
        left = data[rows, f] < at
        nodes.append((tree, node, f, at, next_id, next_id + 1, 0.0))
        todo += [(next_id, rows[left], depth + 1), (next_id + 1, rows[~left], depth + 1)]
        next_id += 2
    return pd.DataFrame(nodes, columns=["Tree", "Node", "Feature", "Split", "Left", "Right", "PathLength"])


@dataclass
class IsolationForest:
    columns: list[str]
    medians: dict[str, float]
    sample: int
    nodes: DataFrame            # one row per node: at most trees x (2 x sample - 1) rows


def _binomial_steps(trees: int, share: float) -> list[float]:
    """For k = 1, 2, ...: the chance that a row goes to fewer than k trees (up to where it is certain)."""
    if share >= 1.0:
        return [0.0] * trees
    steps, chance, below = [], (1.0 - share) ** trees, 0.0
    for k in range(trees):
        below += chance
        if below >= 1.0 - 1e-15:
            break
        steps.append(below)
        chance *= (trees - k) / (k + 1.0) * share / (1.0 - share)
    return steps


def iforest_fit(df: DataFrame, columns: Sequence[str] = PRICING_FEATURES, trees: int = 300, sample: int = 256,
                seed: int = 42, id_: str = "POItemID") -> IsolationForest:
    """Grow each tree in its own task from its own random subsample; missing values take the exact median.

    Subsampling is the algorithm: each tree wants `sample` rows drawn from all of them. One hash per row says how many trees
    look at the row (the inverse of the binomial distribution of that number, with a share that leaves a safe surplus); further
    hashes say which. The smallest hashes of a tree make up its subsample. The draw is the same at every table size, repeatable,
    and costs a row as many hashes as it has trees: usually none.
    """
    columns = list(columns)
    rows = df.count()
    exact = exact_quantiles(df, {c: (c, 0.5) for c in columns}).first()
    medians = {c: float(exact[c]) if exact[c] is not None else 0.0 for c in columns}
    size = min(sample, rows)
    unit = lambda *c: F.pmod(F.xxhash64(*c), F.lit(1 << 53)) / float(1 << 53)
    pool = df.select(id_, *[F.coalesce(F.col(c).cast("double"), F.lit(medians[c])).alias(c) for c in columns])
    share = min(1.0, (2.0 * size + 100.0) / max(1, rows))
    # the steps ascend, so the number of steps passed is the number of trees; an array of literals keeps the generated code small
    looks = F.size(F.filter(F.array(*[F.lit(float(x)) for x in _binomial_steps(trees, share)]), lambda below: F.col("__u") >= below))
    order = F.slice(F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(F.xxhash64(F.lit(seed + 1), F.col(id_), t), t.alias("t")))), 1, F.col("__k"))
    drawn = (pool.withColumn("__u", unit(F.lit(seed), F.col(id_))).withColumn("__k", looks).where(F.col("__k") > 0)
             .withColumn("Tree", F.explode(F.transform(order, lambda x: x["t"]))).drop("__u", "__k")
             .withColumn("__h", F.xxhash64(F.lit(seed + 2), F.col(id_), F.col("Tree"))))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        return _grow(pdf.nsmallest(size, "__h"), columns, seed)

    nodes = reliable(drawn.drop(id_).groupBy("Tree").applyInPandas(build, NODE))
    return IsolationForest(columns, medians, size, nodes)


def _levels(node: np.ndarray, feature: np.ndarray, split: np.ndarray, left: np.ndarray, right: np.ndarray, path: np.ndarray) -> tuple:
    """A tree as full levels: (levels, feature and split by place, path length by place below the last level); the children of place k are 2k + 1 and 2k + 2.

    A leaf above the last level hands its path length to all places below it. A tree has at most the levels its subsample allows, so there are
    at most four places per row of the subsample.
    """
    at = {int(n): k for k, n in enumerate(node)}
    depth, here = 0, [at[0]]
    while here := [at[int(c)] for k in here if feature[k] >= 0 for c in (left[k], right[k])]:
        depth += 1
    features, splits, paths = np.zeros((1 << depth) - 1, dtype=np.int64), np.zeros((1 << depth) - 1), np.zeros(1 << depth)
    todo = [(at[0], 0, 0)]
    while todo:
        k, level, place = todo.pop()
        if feature[k] < 0:
            paths[place << (depth - level):(place + 1) << (depth - level)] = path[k]
            continue
        features[(1 << level) - 1 + place], splits[(1 << level) - 1 + place] = feature[k], split[k]
        todo += [(at[int(left[k])], level + 1, 2 * place), (at[int(right[k])], level + 1, 2 * place + 1)]
    return depth, features, splits, paths


def _path_sums(trees: Sequence[tuple], x: np.ndarray) -> np.ndarray:
    """Sum of the path lengths of each row of `x` over all trees: every level of a tree is one look-up and one comparison for all rows."""
    n = len(x)
    flat, rows, total = x.T.ravel(), np.arange(n), np.zeros(n)
    for depth, feature, split, path in trees:
        start, place = feature * n, np.zeros(n, dtype=np.int64)
        for level in range(depth):
            node = place + ((1 << level) - 1)
            place = 2 * place + 1 - (flat.take(start.take(node) + rows) < split.take(node))     # right, where a value is not below the split
        total += path.take(place)
    return total


def iforest_score(forest: IsolationForest, df: DataFrame, name: str = "RawAnomalyScore", carry: Sequence[str] | None = None) -> DataFrame:
    """Add the raw score: 2^(-mean path / expected path) - 0.5; higher is more anomalous.

    The forest is bounded by its parameters (trees x nodes, a few MB), never by the data, so it
    travels to the tasks as a broadcast variable; rows are scored in Arrow batches where they are.
    """
    spark = df.sparkSession
    size = forest.nodes.count()
    if size > MOST_NODES:
        raise ValueError(f"a forest of {size} nodes is too large to be sent to the tasks")
    flat = forest.nodes.orderBy("Tree", "Node").toPandas()
    trees = [_levels(*(t[c].to_numpy() for c in ("Node", "Feature", "Split", "Left", "Right", "PathLength"))) for _, t in flat.groupby("Tree")]
    shared = spark.sparkContext.broadcast(trees)
    expected = _mean_path(forest.sample) or 1.0
    medians, columns = forest.medians, forest.columns

    @F.pandas_udf("double")
    def score(batch: pd.DataFrame) -> pd.Series:
        depth = _path_sums(shared.value, batch.to_numpy(float)) / max(1, len(shared.value))
        return pd.Series(np.power(2.0, -depth / expected) - 0.5)

    inputs = F.struct(*[F.coalesce(F.col(c).cast("double"), F.lit(medians[c])).alias(c) for c in columns])
    keep = list(carry) if carry else df.columns
    return df.select(*keep, score(inputs).alias(name))


def raw_threshold(scores: DataFrame, column: str = "RawAnomalyScore", review_rate: float = 0.05) -> DataFrame:
    """One row: the score above which the review share of the reference lies."""
    return exact_quantiles(scores, {"RawThreshold": (column, 1.0 - review_rate)})


STATE = f"Kind string, Name string, Value double, Weight long, {NODE}"


def forest_state(forest: IsolationForest, reference: DataFrame, review_rate: float = 0.05, column: str = "RawAnomalyScore") -> DataFrame:
    """All that scoring needs, as one table: nodes, medians in the order of the columns, the ladder of reference scores with their counts, the
    threshold above which the review share of the reference lies, and the settings. `Kind` is NODE, MEDIAN, LADDER or SETTING."""
    nodes = forest.nodes
    spark = nodes.sparkSession
    filled = lambda df: df.select(*[F.col(f.split()[0]).cast(f.split()[1]) if f.split()[0] in df.columns else F.lit(None).cast(f.split()[1]).alias(f.split()[0])      # noqa: E731
                                    for f in STATE.split(", ")])
    medians = spark.createDataFrame([("MEDIAN", c, float(forest.medians[c]), k) for k, c in enumerate(forest.columns)], "Kind string, Name string, Value double, Weight long")
    ladder = reference.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("Value")).agg(F.count("*").alias("Weight")).withColumn("Kind", F.lit("LADDER"))
    cut = raw_threshold(reference, column, review_rate).select(F.lit("SETTING").alias("Kind"), F.lit("THRESHOLD").alias("Name"), F.col("RawThreshold").alias("Value"))
    settings = spark.createDataFrame([("SETTING", "SAMPLE", float(forest.sample)), ("SETTING", "REVIEW_RATE", float(review_rate))], "Kind string, Name string, Value double")
    parts = [nodes.withColumn("Kind", F.lit("NODE")), medians, ladder, cut, settings]
    out = filled(parts[0])
    for part in parts[1:]:
        out = out.unionByName(filled(part))
    return out


def forest_of(state: DataFrame) -> IsolationForest:
    """The forest in a state table."""
    medians = sorted((r["Weight"], r["Name"], r["Value"]) for r in state.where("Kind = 'MEDIAN'").select("Weight", "Name", "Value").collect())    # one row a column
    return IsolationForest([c for _, c, _ in medians], {c: v for _, c, v in medians}, int(forest_setting(state, "SAMPLE")), state.where("Kind = 'NODE'").select(*[f.split()[0] for f in NODE.split(", ")]))


def forest_setting(state: DataFrame, name: str) -> float:
    return state.where((F.col("Kind") == "SETTING") & (F.col("Name") == name)).select("Value").first()[0]


def forest_apply(state: DataFrame, df: DataFrame, carry: Sequence[str]) -> DataFrame:
    """`carry` columns of `df` with `RawAnomalyScore`, `PricingAnomalyScore` (percentile in the stored reference) and `PricingAnomalyFlag` (at or above the stored threshold).

    Any split can be scored by any state; nothing is learned here.
    """
    scored = reliable(iforest_score(forest_of(state), df, carry=carry))     # the ladder and the output both read it
    ladder = state.where("Kind = 'LADDER'").select(F.col("Value").alias("RawAnomalyScore"), "Weight")
    ranked = ladder_percentile(ladder, scored, "RawAnomalyScore", "PricingAnomalyScore")
    return ranked.withColumn("PricingAnomalyFlag", (F.col("RawAnomalyScore") >= F.lit(forest_setting(state, "THRESHOLD"))).cast("int"))


def fit_forest(train: DataFrame, store: ModelStore, name: str, review_rate: float = 0.05, id_: str = "POItemID", **settings) -> DataFrame:
    """The state table of a forest fitted on `train`, with the scores of `train` as its reference; read from the store if it was fitted before."""
    key = fingerprint(train.select(id_, *PRICING_FEATURES), review_rate, sorted(settings.items()))

    def build() -> DataFrame:
        forest = iforest_fit(train, id_=id_, **settings)
        return forest_state(forest, reliable(iforest_score(forest, train, carry=[id_])), review_rate)

    return store.table(name, key, build)


def recounted(reference: DataFrame, scored: DataFrame, cut: float, review_rate: float = 0.05, steps: int = 40) -> DataFrame:
    """One row of counts taken anew, without the ladder: `ReferenceRows`, `ScoredRows`, `PercentileViolations`, `FlagViolations`, `ReviewShareViolations`.

    At each of `steps` raw values the share of reference rows at or below it is counted directly. A scored row below the value may not have a larger
    percentile than that share, one above it no smaller one.
    """
    raw, share = F.col("RawAnomalyScore"), "PricingAnomalyScore"
    grid = [-0.5 + k / steps for k in range(1, steps + 1)]
    counts = reference.agg(F.count(raw).alias("n"), F.count_if(raw >= cut).alias("flagged"), *[F.count_if(raw <= t).alias(f"g{k}") for k, t in enumerate(grid)]).first()
    n = max(1, counts["n"])
    wrong = F.lit(False)
    for k, t in enumerate(grid):
        at = counts[f"g{k}"] * 100.0 / n
        wrong = wrong | ((raw <= t) & (F.col(share) > at + 1e-9)) | ((raw > t) & (F.col(share) < at - 1e-9))
    least = counts["n"] - int(np.ceil((1.0 - review_rate) * (counts["n"] - 1)))      # rows at or above an interpolated quantile
    return scored.agg(F.lit(counts["n"]).cast("long").alias("ReferenceRows"), F.count("*").alias("ScoredRows"), F.count_if(wrong | F.col(share).isNull()).alias("PercentileViolations"),
                      F.count_if((F.col("PricingAnomalyFlag") == 1) != (raw >= cut)).alias("FlagViolations"),
                      F.lit(int(counts["flagged"] < least)).cast("long").alias("ReviewShareViolations"))


def proxy_eval(df: DataFrame, flag: str, proxy: str, exception: str | None = None) -> DataFrame:
    """How much more often flagged rows meet a transparent proxy than rows do overall."""
    hit, good = F.col(flag) == 1, F.col(proxy) == 1
    n = F.count("*").cast("double")
    base, precision = F.count_if(good) / n, ratio(F.count_if(hit & good), F.count_if(hit))
    out = {"RowCount": F.count("*"), "FlaggedCount": F.count_if(hit), "ProxyPrevalence": base, "FlaggedRate": F.count_if(hit) / n,
           "Precision": precision, "Recall": ratio(F.count_if(hit & good), F.count_if(good)),
           "PrecisionLift": F.try_divide(precision, base)}
    if exception:
        exc = F.col(exception) == 1
        overall, flagged = F.count_if(exc) / n, ratio(F.count_if(hit & exc), F.count_if(hit))
        out |= {"ExceptionRate": overall, "FlaggedExceptionRate": flagged, "ExceptionLift": F.try_divide(flagged, overall)}
    return df.agg(*[c.alias(k) for k, c in out.items()])
