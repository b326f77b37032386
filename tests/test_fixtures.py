"""Operators on hand-written rows with known answers, edge cases included."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from spendline.functions import exprs as E
from spendline.operators import (aggregates as A, contract as K, dims, features as FE, fx, joins as J, matching as MA, opportunity as OP,
                                 quality as Q, savings as SA, scorecard as SC, shape as S, spend as SP, windows as W)
from spendline.operators.conform import conform, master_specs
from spendline.sources import tables as X


def day(text):
    return dt.date.fromisoformat(text)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


@pytest.fixture()
def rates(spark):
    return spark.createDataFrame([(day("2022-01-02"), "USD", D("0.90")), (day("2022-01-03"), "USD", D("0.91")), (day("2022-01-05"), "USD", D("0.95"))],
                                 "RateDate date, Currency string, ExchangeRateToEUR decimal(18,8)")


def test_fx_exact_boundary_gap_unknown_null(spark, rates):
    df = spark.createDataFrame([(1, day("2022-01-03"), "USD"), (2, day("2021-12-31"), "USD"), (3, day("2022-02-01"), "USD"), (4, day("2022-01-04"), "USD"),
                                (5, day("2022-01-03"), "XXX"), (6, day("2022-01-03"), None), (7, None, "USD")], "i int, d date, c string")
    out = {r.i: r for r in fx.fx_resolve(df, "d", "c", "PO", rates, null_label="NOT_APPLICABLE").collect()}
    assert len(out) == 7
    assert [out[i].POFXResolutionMethod for i in range(1, 8)] == ["EXACT_DATE", "EARLIEST_AVAILABLE_RATE", "LATEST_AVAILABLE_RATE", "UNRESOLVED", "UNRESOLVED",
                                                                 "NOT_APPLICABLE", "UNRESOLVED"]
    assert [out[i].POExchangeRateToEUR for i in (1, 2, 3, 4)] == [D("0.91"), D("0.90"), D("0.95"), None]
    assert out[2].POFXRateDate == day("2022-01-02") and out[3].POFXRateDate == day("2022-01-05")


CONTRACT = "ContractID string, SupplierID string, CategoryID string, ContractStartDate date, ContractEndDate date, Currency string, NegotiatedUnitPrice decimal(18,4), ContractType string, ContractLifecycleStatus string"


def contracts(spark):
    full = [("K1", "S1", "C1", day("2022-01-01"), day("2022-12-31"), "EUR", D("100"), "T", "Active"),
            ("K2", None, "C1", day("2022-01-01"), day("2022-12-31"), "EUR", D("100"), "T", "Active"),
            ("K0", "S1", "C1", day("2022-01-01"), day("2022-12-31"), "USD", D("0"), "T", "Active")]
    return spark.createDataFrame(full, CONTRACT)


def po(spark, entries):
    return spark.createDataFrame([(i, k, s, c, day(d), h, it) for i, (k, s, c, d, h, it) in enumerate(entries)],
                                 "id int, ContractID string, POSupplierID string, CategoryID string, OrderDate date, POStatus string, POItemStatus string")


def test_contract_validity_and_compliance(spark):
    cases = [((None, "S1", "C1", "2022-06-01", "Open", "Open"), "NO_CONTRACT_REFERENCE", "MAVERICK_NO_CONTRACT"),
             (("KX", "S1", "C1", "2022-06-01", "Open", "Open"), "CONTRACT_NOT_FOUND", "MAVERICK_CONTRACT_NOT_FOUND"),
             (("K1", "S2", "C1", "2022-06-01", "Open", "Open"), "SUPPLIER_MISMATCH", "MAVERICK_SUPPLIER_MISMATCH"),
             (("K1", "S1", "C2", "2022-06-01", "Open", "Open"), "CATEGORY_MISMATCH", "MAVERICK_CATEGORY_MISMATCH"),
             (("K1", "S1", "C1", "2021-12-31", "Open", "Open"), "CONTRACT_NOT_YET_ACTIVE", "MAVERICK_INVALID_CONTRACT_DATE"),
             (("K1", "S1", "C1", "2022-01-01", "Open", "Open"), "VALID_CONTRACT", "COMPLIANT"),
             (("K1", "S1", "C1", "2022-12-31", "Open", "Open"), "VALID_CONTRACT", "COMPLIANT"),
             (("K1", "S1", "C1", "2023-01-01", "Open", "Open"), "CONTRACT_EXPIRED", "MAVERICK_INVALID_CONTRACT_DATE"),
             (("K1", "S1", "C1", "2022-06-01", "Cancelled", "Open"), "VALID_CONTRACT", "EXCLUDED_CANCELLED"),
             (("K1", "S1", "C1", "2022-06-01", "Open", "Cancelled"), "VALID_CONTRACT", "EXCLUDED_CANCELLED"),
             (("K2", "S1", "C1", "2022-06-01", "Open", "Open"), "UNKNOWN", "MAVERICK_OTHER")]
    out = {r.id: r for r in SP.spend_compliance(K.contract_validity(SP.eligible(po(spark, [c[0] for c in cases])), contracts(spark))).collect()}
    assert [(out[i].ContractValidityStatusAtPO, out[i].SpendComplianceStatus) for i in range(len(cases))] == [c[1:] for c in cases]
    unknown = out[len(cases) - 1]
    assert unknown.ValidContractAtPOFlag is None and unknown.ContractComplianceFlag is None and unknown.MaverickSpendFlag is None


def test_price_variance_tolerance_and_zero_benchmark(spark, rates):
    eur = spark.createDataFrame([(day("2022-01-01"), "EUR", D("1")), (day("2022-12-31"), "EUR", D("1"))], "RateDate date, Currency string, ExchangeRateToEUR decimal(18,8)")
    prices = ["103.00", "103.01", "97.00", "96.99"]
    base = po(spark, [("K1", "S1", "C1", "2022-01-01", "Open", "Open")] * 4 + [("K0", "S1", "C1", "2022-01-01", "Open", "Open")])
    base = base.withColumns({"UnitPrice": F.element_at(F.array(*[F.lit(p) for p in prices + ["5"]]), F.col("id") + 1).cast("decimal(18,4)"),
                             "LineAmount": F.lit("10.00").cast("decimal(18,2)"), "POCurrency": F.lit("EUR")})
    out = {r.id: r for r in SP.classify_spend(base, contracts(spark), eur.unionByName(rates)).collect()}
    assert [out[i].ContractPriceVariancePercentage for i in range(4)] == [3.0, 3.01, -3.0, -3.01]
    assert [out[i].ContractPriceWithinToleranceFlag for i in range(4)] == [True, False, True, False]
    assert out[4].ContractPriceVariancePercentage is None and out[4].ContractPriceWithinToleranceFlag is None
    assert out[0].ContractCompliantSpendEUR == D("10.00") and out[0].MaverickSpendEUR == 0


def test_received_asof_counts_and_partial_receipts(spark):
    inv = spark.createDataFrame([("a1", "A", day("2022-01-10")), ("a2", "A", day("2022-01-12")), ("b1", "B", day("2022-01-10")), ("a0", "A", day("2022-01-01"))],
                                "InvoiceItemID string, POItemID string, InvoiceDate date")
    rec = spark.createDataFrame([("g1", "A", day("2022-01-05"), D("1")), ("g2", "A", day("2022-01-10"), D("2")), ("g2", "A", day("2022-01-11"), D("4")),
                                 ("g3", "A", day("2022-01-20"), D("8"))], "GoodsReceiptID string, POItemID string, ReceiptDate date, QuantityReceived decimal(18,3)")
    got = rows(MA.received_asof(inv, rec), "InvoiceItemID", "CalculatedReceivedQuantityAtInvoiceDate", "GoodsReceiptCountAtInvoiceDate", "GoodsReceiptAvailableAtInvoiceDateFlag")
    assert got == [("a0", D("0.000"), 0, False), ("a1", D("3.000"), 2, True), ("a2", D("7.000"), 2, True), ("b1", D("0.000"), 0, False)]


def match(spark, **kw):
    base = dict(POUnitPrice=D("100"), InvoiceUnitPrice=D("100"), InvoicedQuantity=D("10"), CalculatedReceivedQuantityAtInvoiceDate=D("10"),
                GoodsReceiptAvailableAtInvoiceDateFlag=True, SourceReceivedQuantityAtInvoiceDate=D("10"), HeaderDuplicateInvoiceFlag=False,
                DuplicateInvoiceLineFlag=None, POReferenceResolvedFlag=True, SourceThreeWayMatchStatus="MATCHED") | kw
    schema = ("POUnitPrice decimal(18,4), InvoiceUnitPrice decimal(18,4), InvoicedQuantity decimal(18,3), CalculatedReceivedQuantityAtInvoiceDate decimal(18,3), "
              "GoodsReceiptAvailableAtInvoiceDateFlag boolean, SourceReceivedQuantityAtInvoiceDate decimal(18,3), HeaderDuplicateInvoiceFlag boolean, "
              "DuplicateInvoiceLineFlag boolean, POReferenceResolvedFlag boolean, SourceThreeWayMatchStatus string")
    df = spark.createDataFrame([tuple(base.values())], schema)
    return MA.three_way_match(MA.duplicate_flag(MA.invoice_variances(df))).first()


@pytest.mark.parametrize("change,status", [
    ({}, "MATCHED"), ({"InvoiceUnitPrice": D("104")}, "PRICE_VARIANCE"), ({"InvoicedQuantity": D("11")}, "QUANTITY_VARIANCE"),
    ({"InvoiceUnitPrice": D("104"), "InvoicedQuantity": D("11")}, "PRICE_AND_QUANTITY_VARIANCE"),
    ({"CalculatedReceivedQuantityAtInvoiceDate": D("0"), "GoodsReceiptAvailableAtInvoiceDateFlag": False}, "MISSING_GOODS_RECEIPT"),
    ({"POReferenceResolvedFlag": False}, "PO_REFERENCE_NOT_FOUND"), ({"HeaderDuplicateInvoiceFlag": True, "InvoiceUnitPrice": D("200")}, "DUPLICATE_INVOICE"),
    ({"POUnitPrice": None}, "MATCHED"), ({"POUnitPrice": D("0"), "InvoicedQuantity": D("11")}, "QUANTITY_VARIANCE"),
    ({"InvoiceUnitPrice": D("103")}, "MATCHED"), ({"InvoicedQuantity": D("10.2")}, "MATCHED"), ({"InvoicedQuantity": D("10.21")}, "QUANTITY_VARIANCE")])
def test_three_way_match(spark, change, status):
    got = match(spark, **change)
    assert got.DerivedThreeWayMatchStatus == status and got.ThreeWayMatchFlag == (status == "MATCHED")


def test_delivery_outcomes(spark):
    po_ = spark.createDataFrame([("on", D("10"), day("2022-01-10")), ("late", D("10"), day("2022-01-10")), ("part", D("10"), day("2022-01-10")),
                                 ("future", D("10"), day("2023-01-10")), ("none", D("10"), day("2022-01-10"))], "POItemID string, Quantity decimal(18,3), RequestedDeliveryDate date")
    po_ = po_.withColumns({"POSupplierID": F.lit("S"), "POID": F.col("POItemID"), "SpendEligibilityFlag": F.lit(True)})
    rec = spark.createDataFrame([("1", "on", day("2022-01-10"), D("10")), ("2", "late", day("2022-01-09"), D("5")), ("3", "late", day("2022-01-15"), D("5")),
                                 ("4", "part", day("2022-01-01"), D("9.999"))], "GoodsReceiptID string, POItemID string, ReceiptDate date, QuantityReceived decimal(18,3)")
    got = rows(SC.delivery(po_, rec, "2022-12-31").fillna(False), "POItemID", "OnTimeDeliveryFlag", "LateDeliveryFlag", "OverdueOpenDeliveryFlag", "DaysLate")
    assert got == [("late", False, True, False, 5), ("none", False, False, True, None), ("on", True, False, False, None), ("part", False, False, True, None)]


def test_scorecard_spine_and_zero_denominators(spark):
    z = "SupplierID string, PerformanceYear int, "
    spend = spark.createDataFrame([("S1", 2022, 1, 2, D("10"), D("4"), D("6"))], z + "POCount long, POItemCount long, EligibleSpendEUR decimal(28,2), ContractCompliantSpendEUR decimal(28,2), MaverickSpendEUR decimal(28,2)")
    deliv = spark.createDataFrame([], z + "DuePOItemCount long, ReceivedPOItemCount long, DeliveryCompletePOItemCount long, OnTimeDeliveryPOItemCount long, LateDeliveryPOItemCount long, OverdueOpenPOItemCount long, AverageDaysLate double, MaximumDaysLate int")
    items = spark.createDataFrame([("S2", 2022, 4, 3, 1, D("100"), D("25"))], z + "InvoiceItemCount long, MatchedInvoiceItemCount long, InvoiceExceptionItemCount long, GrossInvoiceAmountEUR decimal(28,2), InvoiceExceptionAmountEUR decimal(28,2)")
    docs = spark.createDataFrame([("S2", 2022, 2, 1, 1, 0)], z + "InvoiceCount long, DisputedInvoiceCount long, DisputeFreeInvoiceCount long, DuplicateInvoiceCount long")
    sup = spark.createDataFrame([("S1", *[None] * 10)], "SupplierID string, SupplierName string, SupplierType string, Country string, Region string, PreferredSupplier boolean, StrategicSupplier boolean, ESGRating string, FinancialRiskScore int, Status string, SupplierActiveFlag boolean")
    got = {r.SupplierID: r for r in SC.scorecard(spend, deliv, items, docs, sup).collect()}
    assert got["S1"].ContractCompliancePct == 40.0 and got["S1"].SupplierOnTimeDeliveryPct is None and got["S1"].InvoiceCount == 0
    assert got["S2"].ThreeWayMatchPct == 75.0 and got["S2"].SupplierQualityIndexPct == 50.0 and got["S2"].MaverickSpendPct is None


TRACK = "SupplierID string, SupplierName string, Status string"


def test_scd2_life_cycle(spark):
    snap = lambda *r: spark.createDataFrame(list(r), TRACK)
    fold = lambda e, s, d: dims.scd2(e, s, d, ["SupplierName", "Status"], first_date="2022-01-01")
    show = lambda df: rows(df, "SupplierID", "DimensionVersion", "EffectiveFromDate", "EffectiveToDate", "IsCurrentFlag")
    end = day("9999-12-31")
    first = fold(None, snap(("A", "a", "x"), ("B", "b", "x"), ("C", "c", "x")), "2022-05-01")
    assert show(first) == [(k, 1, day("2022-01-01"), end, True) for k in "ABC"]
    second_snap = snap(("A", "a", "x"), ("B", "b2", "x"), ("D", "d", "x"))
    second = fold(first, second_snap, "2022-06-01")
    expected = [("A", 1, day("2022-01-01"), end, True), ("B", 1, day("2022-01-01"), day("2022-05-31"), False), ("B", 2, day("2022-06-01"), end, True),
                ("C", 1, day("2022-01-01"), day("2022-05-31"), False), ("D", 1, day("2022-06-01"), end, True)]
    assert show(second) == sorted(expected, key=str)
    assert show(fold(second, second_snap, "2022-06-01")) == show(second)
    with pytest.raises(dims.SnapshotOrder):
        fold(second, snap(("A", "a", "x"), ("B", "b3", "x"), ("D", "d", "x")), "2022-06-01")
    third = fold(second, snap(("A", "a", "x"), ("B", "b", "x"), ("D", "d", "x")), "2022-07-01")
    assert ("B", 3, day("2022-07-01"), end, True) in show(third)
    assert third.select("SupplierKey").distinct().count() == third.count()
    assert W.overlaps(third, "SupplierID", "EffectiveFromDate", "EffectiveToDate").count() == 0
    facts = spark.createDataFrame([("B", day("2022-05-31")), ("B", day("2022-06-01")), ("D", day("2022-05-01"))], "SupplierID string, d date")
    got = rows(J.asof_versions(facts, third, "SupplierID", "d", {"DimensionVersion": "v"}), "SupplierID", "d", "v")
    assert got == [("B", day("2022-05-31"), 1), ("B", day("2022-06-01"), 2), ("D", day("2022-05-01"), None)]


def test_dedup_latest(spark):
    t = dt.datetime
    df = spark.createDataFrame([("a", t(2022, 1, 1), "h1", 1), ("a", t(2022, 1, 2), "h0", 2), ("b", None, "h", 3), ("b", t(2021, 1, 1), "h", 4),
                                ("c", t(2022, 1, 1), "h1", 5), ("c", t(2022, 1, 1), "h2", 6)], "k string, ts timestamp, h string, v int")
    assert rows(S.dedup_latest(df, ["k"], ["ts", "h"]), "k", "v") == [("a", 2), ("b", 4), ("c", 6)]


def test_prior_year_and_rolling_need_adjacent_years(spark):
    df = spark.createDataFrame([("a", 2020, 1.0), ("a", 2021, 2.0), ("a", 2023, 4.0), ("b", 2020, 9.0)], "k string, y int, x double")
    out = W.rolling_range(W.prior_year(df, "k", "y", {"x": "p"}), "k", "y", 2, "x", "r")
    assert rows(out, "k", "y", "p", "rObservationCount", "rStdDev") == sorted(
        [("a", 2020, None, 1, None), ("a", 2021, 1.0, 2, 0.7071067811865476), ("a", 2023, None, 2, 1.4142135623730951), ("b", 2020, None, 1, None)], key=str)


def test_prior_stats_against_brute_force(spark):
    import random
    import statistics
    rnd = random.Random(3)
    data = [(f"i{i:03d}", rnd.choice(["hot", "hot", "cold", None]), day("2022-01-01") + dt.timedelta(rnd.randrange(4)), D(rnd.randrange(100000, 900000)) / 100) for i in range(120)]
    data += [("c1", "const", day("2022-01-01"), D("7.77")), ("c2", "const", day("2022-01-01"), D("7.77")), ("c3", "const", day("2022-01-09"), D("7.77"))]
    df = spark.createDataFrame(data, "id string, k string, d date, x decimal(18,4)")
    got = {r.id: r for r in W.prior_stats(df, ["k"], "d", "id", "x", "P").collect()}
    assert len(got) == len(data)
    for id_, k, d, _ in data:
        seen = [float(v) for i, kk, dd, v in data if kk == k and (dd, i) < (d, id_)]
        r = got[id_]
        assert r.PHistoryCount == len(seen)
        assert r.PHistoricalAvgPriceEUR == (pytest.approx(statistics.fmean(seen)) if seen else None)
        assert r.PHistoricalStdDevPriceEUR == (pytest.approx(statistics.stdev(seen), abs=1e-9) if len(seen) > 1 else None)
        bounds = [None if b is None else float(b) for b in (r.PHistoricalMinPriceEUR, r.PHistoricalMaxPriceEUR)]
        assert bounds == ([min(seen), max(seen)] if seen else [None, None])
    assert got["c3"].PHistoricalStdDevPriceEUR == 0.0


def test_global_ranks_against_brute_force(spark):
    values = [None, None] + [i * 7 % 11 for i in range(300)] + [5] * 150
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int").repartition(6)
    rank = {r.id: r.rk for r in W.global_rank(df, [F.desc_nulls_last("v"), F.asc("id")], "rk").collect()}
    order = sorted(range(len(values)), key=lambda i: (values[i] is None, -(values[i] or 0), i))
    assert rank == {i: n + 1 for n, i in enumerate(order)}
    score = {r.id: r.s for r in W.global_percent_rank(df, "v", "s").collect()}
    key = lambda v: -1 if v is None else v
    for i, v in enumerate(values):
        assert score[i] == pytest.approx(100 * sum(key(w) < key(v) for w in values) / (len(values) - 1))
    one = spark.createDataFrame([(1, 1)], "id int, v int")
    assert W.global_percent_rank(one, "v", "s").first().s == 0.0


def test_rank_within_hot_key(spark):
    data = [(i, "hot" if i % 3 else f"k{i % 5}", (i * 37) % 101) for i in range(240)]
    df = spark.createDataFrame(data, "id int, k string, v int").repartition(5)
    got = {r.id: r.rk for r in W.rank_within(df, ["k"], [F.desc("v"), F.asc("id")], "rk").collect()}
    for i, k, _ in data:
        order = sorted((x for x in data if x[1] == k), key=lambda x: (-x[2], x[0]))
        assert got[i] == [x[0] for x in order].index(i) + 1


def test_univariate_auc_against_brute_force(spark):
    from spendline.operators.ml import univariate_auc
    data = [(i % 2, float((i * 7) % 13), float(i)) for i in range(60)]
    got = {r.FeatureName: r.AUC for r in univariate_auc(spark.createDataFrame(data, "y int, a double, b double"), ["a", "b"], "y").collect()}
    for j, name in ((1, "a"), (2, "b")):
        pairs = [(p[j], n[j]) for p in data if p[0] == 1 for n in data if n[0] == 0]
        assert got[name] == pytest.approx(sum((p > n) + 0.5 * (p == n) for p, n in pairs) / len(pairs))


def test_isolation_forest_puts_outliers_first(spark):
    from spendline.operators import ml
    data = [(f"n{i}", float(i % 17), float(i % 11)) for i in range(600)] + [("odd", 400.0, -300.0), ("gap", None, 5.0)]
    df = spark.createDataFrame(data, "POItemID string, a double, b double")
    forest = ml.iforest_fit(df, ["a", "b"], trees=30, sample=64)
    assert forest.nodes.select("Tree").distinct().count() == 30
    assert forest.nodes.where("Feature < 0").groupBy("Tree").count().agg(F.max("count")).first()[0] <= 64
    top = ml.iforest_score(forest, df).orderBy(F.desc("RawAnomalyScore")).first()
    assert top.POItemID == "odd" and top.RawAnomalyScore > 0.1
    again = ml.iforest_score(ml.iforest_fit(df, ["a", "b"], trees=30, sample=64), df).orderBy(F.desc("RawAnomalyScore")).first()
    assert again.RawAnomalyScore == top.RawAnomalyScore


def test_risk_folds_keep_suppliers_together(spark):
    from spendline.operators import ml
    df = spark.createDataFrame([(f"S{i % 40}", 2000 + i // 40, int(i % 40 < 12)) for i in range(120)], f"SupplierID string, PerformanceYear int, {ml.LABEL} int")
    out = ml.training_frame(df, 4)
    assert out.count() == 120
    assert out.groupBy("SupplierID").agg(F.countDistinct(ml.FOLD).alias("n")).agg(F.max("n")).first()[0] == 1
    weights = {r[ml.LABEL]: r.w for r in out.groupBy(ml.LABEL).agg(F.sum("ClassWeight").alias("w")).collect()}
    assert weights[0] == pytest.approx(weights[1])


def test_reference_percentile(spark):
    ref = spark.createDataFrame([(x,) for x in [1.0, 2.0, 2.0, 4.0]], "v double")
    tgt = spark.createDataFrame([(x,) for x in [0.5, 1.0, 2.0, 3.0, 9.0]], "v double")
    assert rows(W.reference_percentile(ref, tgt, "v", "p"), "v", "p") == [(0.5, 0.0), (1.0, 25.0), (2.0, 75.0), (3.0, 75.0), (9.0, 100.0)]


EVID = "POItemID string, PricingAnomalyScore double, PricingAnomalyFlag int, PriceComplianceExceptionFlag int, ContractPriceVariancePct double, HasContractBenchmarkFlag int, HasMaterialHistoryFlag int, HasSupplierMaterialHistoryFlag int, PriceVsMaterialHistoricalAvgPct double, PriceVsSupplierMaterialHistoricalAvgPct double, BenchmarkCoverageCount int"


def test_item_evidence_precedence_cap_and_no_double_count(spark):
    ids = ["contract", "own", "material", "capped", "maverick", "both", "none"]
    fact = spark.createDataFrame([(i, i in ("maverick", "both")) for i in ids], "POItemID string, MaverickSpendFlag boolean").withColumns({
        "POID": F.lit("P"), "SupplierID": F.lit("S"), "CategoryID": F.lit("C"), "MaterialID": F.lit("M"), "ContractID": F.lit(None).cast("string"),
        "OrderDate": F.to_date(F.lit("2022-03-01")), "SpendEligibilityFlag": F.lit(True), "EligibleSpendEUR": F.lit("1000").cast("decimal(18,2)"), "ContractComplianceFlag": F.lit(False)})
    score = spark.createDataFrame([("contract", 99.0, 0, 1, 25.0, 1, 1, 1, 10.0, 10.0, 4), ("own", 99.0, 1, 0, -5.0, 1, 1, 1, 30.0, 20.0, 4), ("material", 99.0, 1, 0, None, 0, 1, 1, 30.0, -1.0, 4),
                                   ("capped", 99.0, 1, 0, 400.0, 1, 0, 0, None, None, 4), ("both", 99.0, 1, 0, 25.0, 1, 0, 0, None, None, 4), ("none", 1.0, 0, 0, 25.0, 1, 1, 1, 30.0, 30.0, 4)], EVID)
    got = {r.POItemID: r for r in OP.item_evidence(fact, score, 2022, "2022-12-31").collect()}
    assert [got[i].PricingSavingsBenchmarkType for i in ids] == ["CONTRACT", "SUPPLIER_MATERIAL_HISTORY", "MATERIAL_HISTORY", "CONTRACT", None, "CONTRACT", None]
    assert got["contract"].PricingOpportunityYTDEUR == pytest.approx(200.0) and got["capped"].PricingOpportunityYTDEUR == pytest.approx(1000 * 50 / 150)
    assert got["maverick"].MaverickOpportunityYTDEUR == pytest.approx(30.0) and got["both"].MaverickOpportunityYTDEUR == 0.0
    assert got["none"].TotalOpportunityYTDEUR == 0.0 and got["maverick"].HasPricingSignalFlag == 0


def test_prioritise_bands_drivers_and_zero_saving(spark):
    entries = [("A", 0.0, 0.0, 100.0), ("B", 5000.0, 4100.0, 90000.0), ("C", 9000.0, 100.0, 50000.0), ("D", 10.0, 900.0, 1000.0), ("E", 100.0, 79.0, 10.0)]
    df = spark.createDataFrame([(s, "C1", p, m, p + m, sp) for s, p, m, sp in entries], "SupplierID string, CategoryID string, AnnualizedPricingOpportunityEUR double, AnnualizedMaverickOpportunityEUR double, PotentialAnnualSavingsEUR double, AnnualizedEligibleSpendEUR double")
    df = df.withColumns({"PricingOpportunityPct": F.lit(1.0), "MaverickSpendPct": F.lit(None).cast("double"), "SupplierRiskScoreForPriority": F.lit(50.0), "SupplierCategorySpendSharePct": F.lit(10.0)})
    got = {r.SupplierID: r for r in OP.prioritise(df).collect()}
    assert got["A"].NegotiationPriorityScore == 0.0 and got["A"].NegotiationPriority == "NONE" and got["A"].PrimaryOpportunityDriver == "NONE"
    assert [got[s].PrimaryOpportunityDriver for s in "BCDE"] == ["MIXED", "PRICING", "MAVERICK", "PRICING"]
    assert sorted(r.SavingsOpportunityRank for r in got.values()) == [1, 2, 3, 4, 5] and got["C"].SavingsOpportunityRank == 2
    assert got["E"].ActionableOpportunityFlag == 0 and got["B"].ActionableOpportunityFlag == 1


def test_quality_rules_find_one_violation_each(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), (None, 3, "y"), ("b", -1, None)], "k string, v int, d string")
    parent = spark.createDataFrame([("a",)], "k string")
    got = {r.ValidationRule: r for r in Q.results([
        Q.row_rules(df, "t", [Q.Rule("v positive", F.col("v") < 0), Q.Rule("d in domain", E.not_in_domain("d", ["x"]), severity=Q.WARNING), Q.Rule("never", F.lit(False))]),
        Q.key_rule(df, "t", ["k"]), Q.fk_rule(df, "t", ["k"], parent, ["k"], "p", nullable=True), Q.schema_rule(df, "t", ["k", "zz"]), Q.row_count_rule(df, "t", 5)]).collect()}
    assert {k: (r.FailedRecordCount, r.ValidationStatus) for k, r in got.items()} == {
        "v positive": (1, "FAILED"), "d in domain": (2, "WARNING"), "never": (0, "PASSED"), "k not null": (1, "FAILED"), "k unique": (1, "FAILED"), "k in p": (1, "FAILED"),
        "required columns present": (1, "FAILED"), "at least one row": (0, "PASSED"), "row count as expected": (1, "FAILED")}
    ok = Q.results([Q.row_rules(df, "t", [Q.Rule("never", F.lit(False))])])
    assert Q.gate(ok) is ok
    with pytest.raises(Q.GateFailed):
        Q.gate(Q.results([Q.key_rule(df, "t", ["k"])]))
    assert [r.ValidationID for r in Q.numbered(ok).collect()] == ["VAL00001"]


def test_conform_and_strings(spark):
    df = spark.createDataFrame([(" s1 ", "  Acme   Ltd ", "SERVICE provider", "active", ""), ("s2", "B", "Odd Kind", "paused", "A")], "SupplierID string, SupplierName string, SupplierType string, Status string, ESGRating string")
    got = rows(conform(df, master_specs()["supplier"], lineage=False), "SupplierID", "SupplierName", "SupplierType", "Status", "ESGRating", "SupplierActiveFlag")
    assert got == [("S1", "Acme Ltd", "Service Provider", "Active", None, True), ("S2", "B", "Odd Kind", "paused", "A", False)]


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    path = str(tmp_path / "t")
    assert X.verify_written(df, X.overwrite(df, path)) == 2
    more = spark.createDataFrame([(3, "c", 1.5)], "k int, v string, w double")
    assert rows(X.append(more, path), "k", "w") == [(1, None), (2, None), (3, 1.5)]
    up = X.update_matched(df, spark.createDataFrame([(2, None), (9, "z")], "k int, v string"), ["k"], ["v"])
    assert rows(up, "k", "v") == [(1, "a"), (2, None)]
    with pytest.raises(X.WriteMismatch):
        X.verify_written(df, df.limit(1))
    with pytest.raises(X.TableMissing):
        X.require_tables(spark, ["no_such_table"])
    with pytest.raises(J.FanOut):
        J.assert_unique(df.unionByName(df), ["k"])


def test_savings_weights_and_durations(spark, rates):
    base = spark.createDataFrame([(f"P{i}", f"L{i}", s) for i, s in enumerate(["Idea", "Validated", "Implemented", "Cancelled"])] + [("P9", "LX", "Negotiation")], "SavingsProjectID string, SavingsLevel string, ProjectStatus string")
    base = base.withColumns({**{c: F.lit("1000").cast("decimal(20,2)") for c in SA.AMOUNTS}, "Currency": F.lit("USD"), **{c: F.to_date(F.lit("2022-01-03")) for c in SA.DATES},
                             "ActivePipelineFlag": F.col("ProjectStatus").isin(*SA.PIPELINE), "IsImplementedFlag": F.col("ProjectStatus") == "Implemented"})
    got = {r.SavingsProjectID: r for r in SA.savings_amounts(base, rates).collect()}
    assert [got[p].WeightedForecastSavings for p in ("P0", "P1", "P2", "P3", "P9")] == [D("0.00"), D("250.00"), D("500.00"), D("1000.00"), None]
    assert got["P1"].ForecastedSavingsEUR == D("910.00") and got["P1"].ActivePipelineForecastEUR == D("910.00") and got["P2"].ActivePipelineForecastEUR == 0
    assert got["P2"].ImplementedSavingsEUR == D("910.00") and got["P3"].SavingsAchievementPct == 100.0


def test_risk_label_needs_two_observations(spark):
    df = spark.createDataFrame([("a", 90.0, 1.0, 1.0, 1.0), ("b", 10.0, 50.0, 1.0, 1.0), ("c", 95.0, None, None, None), ("d", 80.0, 2.0, 2.0, None)],
                               "SupplierID string, " + ", ".join(f"Future{c} double" for c in FE.RISK_METRICS))
    cuts = spark.createDataFrame([(20.0, 40.0, 30.0, 30.0)], ", ".join(f"{c}Threshold double" for c in FE.RISK_METRICS))
    assert rows(FE.risk_label(df, cuts), "SupplierID", "FutureRiskEventCount", "HighRiskNextYearFlag") == [("a", 0, 0), ("b", 2, 1), ("d", 0, 0)]


def test_shares_and_reconcile(spark):
    df = spark.createDataFrame([("x", 1, 30), ("x", 2, 70), ("y", 1, 0)], "g string, i int, v long")
    assert rows(A.share_of_total(df, "v", "s", ["g"]), "g", "i", "s") == [("x", 1, 30.0), ("x", 2, 70.0), ("y", 1, None)]
    a = spark.createDataFrame([(1, 10.0), (2, 5.0)], "k int, v double")
    b = spark.createDataFrame([(1, 10.01), (3, 7.0)], "k int, v double")
    assert rows(J.reconcile(a, b, ["k"], ["v"], 0.05), "k", "ReconciledFlag") == [(1, True), (2, False), (3, False)]


def test_gate_names_every_failed_rule(spark):
    rules = spark.createDataFrame([(f"rule {k:02d}", "FAILED" if k < 25 else "PASSED") for k in range(30)], "ValidationRule string, ValidationStatus string")
    with pytest.raises(Q.GateFailed) as caught:
        Q.gate(rules)
    assert sorted(str(caught.value).split("; ")) == [f"rule {k:02d}" for k in range(25)]


def test_exact_quantiles_with_ties_nulls_and_empty_columns(spark):
    values = [(1.0, None), (2.0, None), (2.0, None), (10.0, None), (None, None)]
    df = spark.createDataFrame(values, "a double, b double").repartition(3)
    got = W.exact_quantiles(df, {"q0": ("a", 0.0), "q25": ("a", 0.25), "q50": ("a", 0.5), "q90": ("a", 0.9), "q1": ("a", 1.0), "none": ("b", 0.5)}).first()
    assert [round(got[n], 9) for n in ("q0", "q25", "q50", "q90", "q1")] == [1.0, 1.75, 2.0, 7.6, 10.0] and got["none"] is None


def test_null_share_of_percent_rank_stays_out_of_the_join(spark):
    df = spark.createDataFrame([(k, None if k % 10 else float(k)) for k in range(100)], "id int, v double")
    ranked = W.global_percent_rank(df, "v", "s")
    got = {r.id: r.s for r in ranked.collect()}
    assert all(got[k] == 0.0 for k in range(100) if k % 10) and round(got[90], 9) == 100.0 and round(got[0], 6) == round(9000 / 99, 6)
    assert "<=>" not in ranked._jdf.queryExecution().optimizedPlan().toString()


def test_tree_looks_follow_the_binomial_distribution():
    from spendline.operators.ml import _binomial_steps
    steps = _binomial_steps(3, 0.5)
    assert [round(s, 9) for s in steps] == [0.125, 0.5, 0.875] and _binomial_steps(4, 1.0) == [0.0] * 4


def test_verified_overwrite(spark, tmp_path):
    assert X.overwrite_verified(spark.range(7), str(tmp_path / "t")).count() == 7
