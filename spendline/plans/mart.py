"""The layered pipeline: source tables -> conformed (silver) -> star schema (gold).

Every layer is a written table, as it would be in production: later queries scan a few columns of
a Parquet table with its statistics instead of recomputing the plan behind it. Tables are staged
once per application below the shared checkpoint folder.
"""

from __future__ import annotations

import hashlib
from contextlib import nullcontext
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendline.functions.exprs import clean_id, surrogate_key
from spendline.operators import contract as contracts
from spendline.operators import dims as dimensions
from spendline.operators import facts, features, matching, ml, promotion, savings, scorecard, spend
from spendline.operators.conform import conform, master_specs
from spendline.operators.model_store import ModelStore
from spendline.operators.quality import Rule, differ_rows
from spendline.session import shared_dir, shuffles_dropped, small_sides_hashed
from spendline.sources.tables import overwrite, scan_path
from spendline.sources.tpch import TpchSource

AS_OF = "2001-07-31"
SCORING_YEAR = 2001
LAST_FEATURE_YEAR = 1999        # features of 1999 are labelled by outcomes of 2000
LAST_COMPLETE_YEAR = 2000
SECOND_SNAPSHOT = "1998-07-01"
PREDICTION_DATES = ("2001-06-30", AS_OF)
MASTERS = ["category", "business_unit", "buyer", "supplier", "material", "exchange_rate"]
DIM_TABLES = {"Supplier": "dim_supplier", "Category": "dim_category", "Material": "dim_material", "Buyer": "dim_buyer",
              "BusinessUnit": "dim_business_unit", "Contract": "dim_contract", "Currency": "dim_currency"}
WIDE = frozenset({"silver_po_spend", "silver_invoice_matching", "fact_purchase_order", "fact_invoice", "price_features"})
UNIQUE = {"silver_material": ["MaterialID"], "silver_contract": ["ContractID"], "silver_exchange_rate": ["RateDate", "Currency"],
          "dim_material": ["MaterialID"], "dim_contract": ["ContractID"]}
FOREST_CARRY = ["POItemID", "OrderYear", "RuleBasedExtremePriceFlag", "PriceComplianceExceptionFlag"]
ENTITY_SOURCE = {"Category": "silver_category", "Material": "silver_material", "Buyer": "silver_buyer",
                 "BusinessUnit": "silver_business_unit", "Contract": "silver_contract"}


@cache
def products() -> dict[str, promotion.Product]:
    """The three prediction products and what each promises. Rules hold columns, so they are made when a session is there."""
    scores, saving = promotion.score_rules, F.col("PotentialAnnualSavingsEUR")
    parts = F.col("AnnualizedPricingOpportunityEUR") + F.col("AnnualizedMaverickOpportunityEUR")
    found = (
        promotion.Product("ml_supplier_risk_prediction", ("SupplierID",), ("SupplierKey",), scores("SupplierRiskScore", "PredictedHighRiskFlag"),
                          ("SupplierRiskScore", "PredictedHighRiskFlag")),
        promotion.Product("ml_pricing_anomaly_prediction", ("POItemID",), ("PurchaseOrderFactKey", "CategoryKey", "MaterialKey"),
                          scores("PricingAnomalyScore", "PricingAnomalyFlag"), ("PricingAnomalyScore", "PricingAnomalyFlag"), soft_keys=("SupplierKey",)),
        promotion.Product("ml_savings_opportunity", ("SupplierID", "CategoryID"), ("CategoryKey",),
                          (*scores("NegotiationPriorityScore", "ActionableOpportunityFlag"), Rule("savings not negative", saving < 0),
                           Rule("components add up", differ_rows("PotentialAnnualSavingsEUR", parts, 0.02))),
                          ("PotentialAnnualSavingsEUR",), ("SavingsOpportunityRank",), {"SupplierID": "SupplierID"}, ("SupplierKey",)))
    return {p.name: p for p in found}


def supplier_snapshots(current: DataFrame) -> tuple[DataFrame, DataFrame]:
    """An earlier and a later state of the supplier master, for the type-2 dimension.

    Later: every third supplier got a new risk score, every 19th is gone, and every 17th was not
    there before.
    """
    k = F.substring("SupplierID", 2, 20).cast("long")
    earlier = current.where(k % 17 != 5)
    later = current.where(k % 19 != 7).withColumn(
        "FinancialRiskScore", F.when(k % 3 == 1, F.col("FinancialRiskScore") + 1).otherwise(F.col("FinancialRiskScore")).cast("int"))
    return earlier, later


class Mart:
    """Tables by name. `mart["fact_purchase_order"]` stages whatever that table needs."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.source = spark, TpchSource(spark, directory)
        tag = hashlib.sha256(directory.encode()).hexdigest()[:12]
        self.root = f"{shared_dir(spark).rstrip('/')}/spendline-{spark.sparkContext.applicationId}-{tag}"
        self._tables: dict[str, DataFrame] = {}
        self._risk: ml.RiskModel | None = None

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._stage(name)
        return self._tables[name]

    @property
    def planned(self) -> Mart:
        """The same mart for readers of few columns: a wide line table that nobody has written stays a plan (see `PlannedMart`)."""
        return PlannedMart(self)

    @property
    def narrow(self) -> Mart:
        """`planned`, and lookups of which no column is read fall away (see `NarrowMart`); not for checks that rows do not multiply."""
        return NarrowMart(self)

    def dims(self) -> dict[str, DataFrame]:
        return {**{entity: self[table] for entity, table in DIM_TABLES.items()}, "Date": self["dim_date"]}

    def _stage(self, name: str) -> DataFrame:
        df = self.build(name)
        if name.startswith("bronze_"):
            return df       # plain projections of a source table or of the numbered lines: nothing to save by writing them
        with shuffles_dropped(self.spark), small_sides_hashed(self.spark) if name == "order_lines" else nullcontext():
            return overwrite(df, f"{self.root}/{name}", compression="zstd")

    def scan(self, name: str) -> DataFrame:
        return scan_path(self.spark, f"{self.root}/{name}")

    def silver(self, *names: str) -> list[DataFrame]:
        return [self[f"silver_{n}"] for n in names]

    # ------------------------------------------------------------------ builders

    def build(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")()

    def __getattr__(self, attr: str):
        if attr.startswith("_silver_") and attr[8:] in MASTERS:
            table = attr[8:]
            return lambda: conform(self[f"bronze_{table}"], master_specs()[table])
        if attr.startswith("_bronze_"):
            table = attr[8:]
            return getattr(self.source, {"purchase_order_header": "po_header"}.get(table, table))
        if attr.startswith("_dim_"):
            for entity, source in ENTITY_SOURCE.items():
                if DIM_TABLES[entity] == attr[1:]:
                    return lambda: dimensions.dim_type1(self[source], entity)
        raise AttributeError(attr)

    def _order_lines(self) -> DataFrame:
        return self.source.numbered_lines()

    def _bronze_purchase_order_item(self) -> DataFrame:
        return self.source.po_item(self.source.priced(self["order_lines"]))

    def _bronze_goods_receipt(self) -> DataFrame:
        return self.source.goods_receipt(self.source.priced(self["order_lines"]))

    def _bronze_invoice_item(self) -> DataFrame:
        return self.source.invoice_item(self.source.priced(self["order_lines"]))

    def _silver_contract(self) -> DataFrame:
        return contracts.build_contract(self["bronze_contract"], *self.silver("buyer", "supplier", "category", "exchange_rate"), AS_OF)

    def _silver_po_spend(self) -> DataFrame:
        return spend.build_po_spend(self["bronze_purchase_order_header"], self["bronze_purchase_order_item"],
                                    *self.silver("supplier", "buyer", "material", "category", "business_unit", "contract", "exchange_rate"))

    def _silver_invoice_matching(self) -> DataFrame:
        return matching.build_invoice_matching(self["bronze_invoice_header"], self["bronze_invoice_item"], self["silver_po_spend"],
                                               self["bronze_goods_receipt"], self["silver_exchange_rate"])

    def _scorecard_spend(self) -> DataFrame:
        return scorecard.spend_by_supplier_year(self.narrow["silver_po_spend"])

    def _scorecard_delivery(self) -> DataFrame:
        m = self.narrow
        return scorecard.delivery_by_supplier_year(scorecard.delivery(m["silver_po_spend"], m["bronze_goods_receipt"], AS_OF))

    def _scorecard_invoice(self) -> DataFrame:
        return scorecard.invoice_activity(self.narrow["silver_invoice_matching"])

    def scorecard_parts(self) -> list[DataFrame]:
        """Spend, deliveries and invoices per supplier and year, written one after the other: the line shuffles of a part are gone before the next one starts."""
        return [self[f"scorecard_{part}"] for part in ("spend", "delivery", "invoice")]

    def _silver_supplier_performance(self) -> DataFrame:
        return scorecard.stamped_scorecard(*self.scorecard_parts(), self.narrow["silver_supplier"])

    def _silver_savings_project(self) -> DataFrame:
        return savings.build_savings(self["bronze_savings_project"],
                                     *self.silver("supplier", "category", "buyer", "business_unit", "contract", "exchange_rate"), AS_OF)

    def _dim_date(self) -> DataFrame:
        span = self.source.raw("orders").agg(F.trunc(F.min("o_orderdate"), "year").alias("lo"),
                                             F.last_day(F.make_date(F.year(F.max("o_orderdate")) + 3, F.lit(12), F.lit(1))).alias("hi"))
        return dimensions.dim_date(span, F.col("lo"), F.col("hi"))

    def _dim_supplier(self) -> DataFrame:
        earlier, later = supplier_snapshots(self["silver_supplier"])
        first = dimensions.scd2(None, earlier, SECOND_SNAPSHOT, first_date=self["dim_date"].agg(F.min("Date")).scalar())
        return dimensions.scd2(first, later, SECOND_SNAPSHOT)

    def _dim_currency(self) -> DataFrame:
        return dimensions.dim_currency(self["silver_exchange_rate"])

    def _fact_purchase_order(self) -> DataFrame:
        return facts.build_po_fact(self["silver_po_spend"], self.dims())

    def _fact_invoice(self) -> DataFrame:
        return facts.build_invoice_fact(self["silver_invoice_matching"], self["fact_purchase_order"], self.dims())

    def _invoice_links(self) -> DataFrame:
        """What ties the invoice fact to the order fact: a few columns, written once for the rules that read them."""
        return self.narrow["fact_invoice"].select("POItemID", "PurchaseOrderFactKey", "POIDFactConsistencyFlag", "CategoryKey")

    def _fact_savings(self) -> DataFrame:
        return facts.build_savings_fact(self["silver_savings_project"], self.dims())

    def _fact_supplier_performance(self) -> DataFrame:
        return facts.build_performance_fact(self["silver_supplier_performance"], self.dims(), AS_OF)

    # ------------------------------------------------------------------ features and transparent scores

    def _risk_features(self) -> DataFrame:
        return features.risk_features(self["fact_supplier_performance"], self["dim_supplier"], SCORING_YEAR)

    def _risk_candidates(self) -> DataFrame:
        known = self["risk_features"].where(F.col("SupplierID").isNotNull())
        return features.future_outcomes(known, LAST_FEATURE_YEAR, LAST_COMPLETE_YEAR)

    def _risk_labelled(self) -> DataFrame:
        candidates = self["risk_candidates"]
        return features.risk_label(candidates, features.label_thresholds(candidates))

    def _pricing_base(self) -> DataFrame:
        return features.pricing_base(self.narrow["fact_purchase_order"], AS_OF)

    def _price_features(self) -> DataFrame:
        return features.price_features(self.narrow["fact_purchase_order"], AS_OF, self["pricing_base"])

    def _pricing_scores(self) -> DataFrame:
        """Anomaly scores by the transparent rule: five points for each percent of variance from the contract price, at most 100."""
        if "price_features" in self._tables:
            f = self["price_features"].where(F.col("OrderYear") == SCORING_YEAR)
        else:
            f = features.price_features(self.narrow["fact_purchase_order"], AS_OF, self["pricing_base"], SCORING_YEAR)
        f = f.where("PricingModelEligibleFlag = 1")
        part = F.coalesce(F.col("AbsoluteContractPriceVariancePct"), F.lit(0.0))
        score = F.round(F.least(F.lit(100.0), part * 5.0), 2)
        return f.withColumn("PricingAnomalyScore", score).withColumn("PricingAnomalyFlag", (F.col("PricingAnomalyScore") >= 10).cast("int"))

    def _risk_scores(self) -> DataFrame:
        """Risk scores by a transparent rule over the latest supplier year."""
        f = self["risk_features"].where((F.col("PerformanceYear") == SCORING_YEAR) & F.col("SupplierID").isNotNull())
        score = F.round(F.least(F.lit(100.0), F.coalesce(F.col("FinancialRiskScore"), F.lit(0.0)) * 0.5
                                + F.coalesce(F.col("InvoiceExceptionPct"), F.lit(0.0)) * 0.5), 2)
        return f.select("SupplierID", score.alias("SupplierRiskScore"), (score >= 50).cast("int").alias("PredictedHighRiskFlag"))

    # ------------------------------------------------------------------ fitted models and their products

    @property
    def models(self) -> ModelStore:
        return ModelStore(self.spark, f"{self.root}/models")

    @property
    def gold(self) -> promotion.GoldStore:
        return promotion.GoldStore(self.spark, f"{self.root}/promoted")

    def risk_model(self) -> ml.RiskModel:
        """Selected, tested and fitted once per input: later calls read the store."""
        if self._risk is None:
            self._risk = ml.fit_risk(self["risk_labelled"], self.models)
        return self._risk

    def forest(self, train_to: int) -> DataFrame:
        """State of the isolation forest fitted on the usable prices up to a year."""
        return ml.fit_forest(self["forest_rows"].where(F.col("OrderYear") <= train_to), self.models, "price_forest")

    def _forest_rows(self) -> DataFrame:
        """Usable prices with what the forest reads and hands on: it passes over them several times."""
        usable = self.narrow["price_features"].where("PricingModelEligibleFlag = 1")
        return usable.select(*FOREST_CARRY, *ml.PRICING_FEATURES)

    def _forest_scores(self, train_to: int, year: int) -> DataFrame:
        return ml.forest_apply(self.forest(train_to), self["forest_rows"].where(F.col("OrderYear") == year), FOREST_CARRY)

    def _forest_validation(self) -> DataFrame:
        """The last complete year, scored by the forest of the years before it."""
        return self._forest_scores(SCORING_YEAR - 2, SCORING_YEAR - 1)

    def _forest_production(self) -> DataFrame:
        return self._forest_scores(SCORING_YEAR - 1, SCORING_YEAR)

    def _fitted_risk_scores(self) -> DataFrame:
        fitted = self.risk_model()
        latest = self["risk_features"].where((F.col("PerformanceYear") == SCORING_YEAR) & F.col("SupplierID").isNotNull())
        return ml.score_risk(fitted.model, latest).select(
            "SupplierID", F.round(F.col("Score") * 100, 4).alias("SupplierRiskScore"), (F.col("Score") >= fitted.threshold).cast("int").alias("PredictedHighRiskFlag"),
            F.lit(fitted.name).alias("ModelName"), F.lit(fitted.key).alias("ModelVersion"))

    def _fitted_pricing_scores(self) -> DataFrame:
        rows = self["price_features"].where((F.col("OrderYear") == SCORING_YEAR) & (F.col("PricingModelEligibleFlag") == 1))    # written first: the forest reads it too
        scores = self["forest_production"].select(F.col("POItemID").alias("__id"), "PricingAnomalyScore", "PricingAnomalyFlag")
        return rows.join(scores, F.col("POItemID") == F.col("__id")).drop("__id")

    def _fitted_prioritised(self) -> DataFrame:
        from spendline.operators.opportunity import item_evidence, opportunities, prioritise
        items = item_evidence(self["fact_purchase_order"], self["fitted_pricing_scores"], SCORING_YEAR, AS_OF)
        return prioritise(opportunities(items, self["fitted_risk_scores"], AS_OF, features.ANNUALIZATION))

    def product(self, name: str) -> tuple[DataFrame, DataFrame]:
        """(source rows, the same with gold keys as of the prediction date) of a fitted prediction product."""
        from spendline.operators.opportunity import promote
        product = products()[name]
        source = self[{"ml_supplier_risk_prediction": "fitted_risk_scores", "ml_pricing_anomaly_prediction": "fitted_pricing_scores", "ml_savings_opportunity": "fitted_prioritised"}[name]]
        if name == "ml_pricing_anomaly_prediction":
            source = source.select("POItemID", "SupplierID", "CategoryID", "ContractID", "LineAmountEUR", "PricingAnomalyScore", "PricingAnomalyFlag")
        po = self["fact_purchase_order"] if name == "ml_pricing_anomaly_prediction" else None
        return source, promote(source, self.dims(), AS_OF, list(product.grain), "", po)

    def promote(self, name: str) -> str:
        """Promote a product; its batch id. Savings refer to the risk product, which goes first."""
        source, rows = self.product(name)
        parents = {}
        if "SupplierID" in products()[name].references:
            self.promote("ml_supplier_risk_prediction")
            parents["SupplierID"] = self.gold.read("ml_supplier_risk_prediction").where(F.col("PredictionDate") == F.to_date(F.lit(AS_OF)))
        return self.gold.promote(rows, source, products()[name], parents)

    def _item_evidence(self) -> DataFrame:
        from spendline.operators.opportunity import item_evidence
        return item_evidence(self.narrow["fact_purchase_order"], self["pricing_scores"], SCORING_YEAR, AS_OF)

    def _opportunities(self) -> DataFrame:
        from spendline.operators.opportunity import opportunities
        return opportunities(self["item_evidence"], self["risk_scores"], AS_OF, features.ANNUALIZATION)

    def _prioritised(self) -> DataFrame:
        from spendline.operators.opportunity import prioritise
        return prioritise(self["opportunities"])

    def _two_dates(self, df: DataFrame, score: str) -> DataFrame:
        """An older prediction run (half the score) next to the latest one."""
        old = df.withColumns({score: F.round(F.col(score) / 2.0, 2), "PredictionDate": F.to_date(F.lit(PREDICTION_DATES[0]))})
        return old.unionByName(df.withColumn("PredictionDate", F.to_date(F.lit(PREDICTION_DATES[1]))))

    def _ml_supplier_risk_prediction(self) -> DataFrame:
        out = self._two_dates(self["risk_scores"], "SupplierRiskScore")
        return out.withColumn("PredictedHighRiskFlag", (F.col("SupplierRiskScore") >= 50).cast("int"))

    def _ml_pricing_anomaly_prediction(self) -> DataFrame:
        out = self._two_dates(self["pricing_scores"].select("POItemID", "SupplierID", "CategoryID", "PricingAnomalyScore", "PricingAnomalyFlag"),
                              "PricingAnomalyScore")
        return out.withColumns({"PricingAnomalyFlag": (F.col("PricingAnomalyScore") >= 10).cast("int"),
                                "PurchaseOrderFactKey": surrogate_key("POItemID")})

    def _ml_savings_opportunity(self) -> DataFrame:
        return self._two_dates(self["prioritised"].drop("PredictionDate"), "PotentialAnnualSavingsEUR")


class PlannedMart(Mart):
    """A mart for readers that need few columns of the wide line tables.

    A table of `WIDE` that is not written yet is handed out as its plan, so Catalyst computes, shuffles and keeps only the columns
    that are read: no record hash, text or unused amount of a line ever reaches a disk. All other tables are staged as usual, and
    both marts share them; a wide table that is there already is scanned.
    """

    def __init__(self, whole: Mart):
        self.__dict__ = whole.__dict__

    @property
    def planned(self) -> Mart:
        return self

    def __getitem__(self, name: str) -> DataFrame:
        return self.build(name) if name in WIDE and name not in self._tables else super().__getitem__(name)


class NarrowMart(PlannedMart):
    """Tables of `UNIQUE` hold one row per key (their builders keep the latest); said in the plan, this lets Catalyst leave out a lookup nobody reads."""

    @property
    def planned(self) -> Mart:
        return PlannedMart(self)

    @property
    def narrow(self) -> Mart:
        return self

    def __getitem__(self, name: str) -> DataFrame:
        found = super().__getitem__(name)
        return found.dropDuplicates(UNIQUE[name]) if name in UNIQUE else found


_MARTS: dict[tuple[str, str], Mart] = {}


def mart(spark: SparkSession, directory: str) -> Mart:
    """One mart per application and data folder."""
    key = (spark.sparkContext.applicationId, directory)
    if key not in _MARTS:
        _MARTS[key] = Mart(spark, directory)
    return _MARTS[key]
