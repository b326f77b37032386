"""What keeps shuffles and staged tables small: plans and files on hand-written rows."""

import datetime as dt
import glob
from decimal import Decimal as D

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from spendline.operators import facts, matching, scorecard, spend
from spendline.operators import windows as W
from spendline.plans.mart import Mart
from spendline.session import shuffles_dropped, small_sides_hashed

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def day(n):
    return dt.date(2000, 1, n)


def depth(plan, text):
    """Indentation of the first plan line that holds a text."""
    return next(len(line) - len(line.lstrip(" :+-")) for line in plan.split("\n") if text in line)


@pytest.fixture()
def source(spark, tmp_path):
    """Two orders of two lines, one of them a cancelled one, in the form of the source tables."""
    at = dt.datetime(1996, 3, 1)
    tables = {
        "lineitem": ([(1, 3, 7, 1, 5.0, 500.0, 0.1, 0.02, "N", "F", at), (1, 4, 7, 2, 2.0, 100.0, 0.0, 0.04, "A", "F", at), (2, 3, 7, 1, 4.0, 80.0, 0.0, 0.0, "R", "O", at),
                      (2, 3, 7, 1, 4.0, 90.0, 0.0, 0.0, "N", "O", at)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                     "l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "orders": ([(1, 31, "O", 600.0, at), (2, 16, "F", 170.0, at)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp"),
        "part": ([(3, "Brand#12"), (4, "Brand#7")], "p_partkey long, p_brand string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_line_tables_are_read_from_the_narrow_numbered_lines(spark, source):
    m = Mart(spark, source)
    items = {r["POItemID"]: r for r in m["bronze_purchase_order_item"].collect()}
    assert sorted(items) == ["PO1-1", "PO1-2", "PO2-1", "PO2-2"]
    # 2 * 7 + 3 + 1 = 18: the price of these two lines is agreed, (1000 + 10 + 12) * (1 - 0.0375), whatever they cost
    assert [items[i]["UnitPrice"] for i in ("PO2-1", "PO2-2")] == [D("983.6750")] * 2
    assert items["PO1-2"]["CategoryID"] == "CAT-7" and items["PO1-2"]["Currency"] == "GBP"
    assert m["bronze_goods_receipt"].count() > 0 and m["bronze_invoice_item"].count() > 0
    assert [p.rsplit("/", 1)[1] for p in glob.glob(f"{m.root}/*")] == ["order_lines"]
    assert {"POItemID", "POID", "price", "amount", "sup"}.isdisjoint(m["order_lines"].columns)


def test_staged_tables_are_compressed_and_leave_no_shuffle(spark, source):
    m, seen = Mart(spark, source), []
    m["order_lines"]
    files = glob.glob(f"{m.root}/order_lines/*.parquet")
    assert files and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in files if pq.ParquetFile(f).metadata.num_row_groups)
    before = spark.conf.get(CLEANUP)
    with pytest.raises(KeyError), shuffles_dropped(spark):
        seen.append(spark.conf.get(CLEANUP))
        raise KeyError
    assert seen == ["true"] and spark.conf.get(CLEANUP) == before


def test_receipts_are_dealt_once_by_receipt(spark):
    rec = spark.createDataFrame([("a", "r1", day(1), 2), ("a", "r1", day(3), 1), ("a", None, day(3), 4), ("a", None, day(4), 1), ("a", "r2", day(4), None), ("a", "r3", None, 9),
                                 (None, "r4", day(1), 5), ("b", "r5", day(2), None)], "POItemID string, GoodsReceiptID string, ReceiptDate date, QuantityReceived int")
    inv = spark.createDataFrame([(1, "a", day(1)), (2, "a", day(3)), (3, "a", day(9)), (4, None, day(9)), (5, "b", day(9)), (6, "a", None)], "i int, POItemID string, InvoiceDate date")
    out = matching.received_asof(inv, rec)
    got = {r[0]: (float(r[1]), r[2], r[3], r[4]) for r in out.select("i", "CalculatedReceivedQuantityAtInvoiceDate", "GoodsReceiptCountAtInvoiceDate", "LatestReceiptDateAtInvoiceDate",
                                                                   "GoodsReceiptAvailableAtInvoiceDateFlag").collect()}
    assert got == {1: (2.0, 1, day(1), True), 2: (7.0, 1, day(3), True), 3: (8.0, 2, day(4), True), 4: (0.0, 0, None, False), 5: (0.0, 1, day(2), False), 6: (0.0, 0, None, False)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(__item") <= 3 and "Union" not in plan


def test_order_lines_meet_contract_and_material_before_the_small_tables(spark):
    empty = lambda schema: spark.createDataFrame([], schema)
    header = empty("POID string, SupplierID string, BuyerID string, BusinessUnitID string, OrderDate date, Currency string, POStatus string, TotalAmount decimal(18,2), AmountReconciliationStatus string")
    item = empty("POItemID string, POID string, POLineNumber int, MaterialID string, CategoryID string, ContractID string, Quantity double, OrderUnit string, UnitPrice double, LineAmount double, "
                 "Currency string, RequestedDeliveryDate date, POItemStatus string, SimulationContractScenario string, SimulationPriceAnomalyFlag boolean")
    supplier = empty("SupplierID string, SupplierName string, SupplierType string, SupplierActiveFlag boolean, PreferredSupplier boolean, StrategicSupplier boolean, ESGRating string, FinancialRiskScore int")
    buyer = empty("BuyerID string, BuyerName string, BuyerRole string, BusinessUnitID string")
    material = empty("MaterialID string, MaterialDescription string, CategoryID string, StandardCost double, UnitOfMeasure string, Manufacturer string, Status string")
    category, unit = empty("CategoryID string, CategoryName string, ProcurementType string"), empty("BusinessUnitID string")
    contract = empty("ContractID string, SupplierID string, CategoryID string, ContractStartDate date, ContractEndDate date, Currency string, NegotiatedUnitPrice decimal(18,4), ContractType string, "
                     "ContractLifecycleStatus string")
    rates = empty("RateDate date, Currency string, ExchangeRateToEUR decimal(18,8)")
    out = spend.build_po_spend(header, item, supplier, buyer, material, category, unit, contract, rates)
    plain = spend.classify_spend(spend.po_spend_base(header, item, supplier, buyer, material, category, unit), contract, rates)
    assert out.columns[:len(plain.columns)] == plain.columns      # the record hash covers the columns in this order
    plan = out._jdf.queryExecution().analyzed().toString()
    joins = [f"Join LeftOuter, ({key}#" for key in ("ContractID", "MaterialID", "POSupplierID", "BuyerID", "CategoryID")]
    depths = [depth(plan, j) for j in joins]
    assert depths == sorted(depths, reverse=True) and len(set(depths)) == 5


def test_invoice_rows_are_typed_behind_the_join(spark):
    kinds = {"InvoiceDate": "date", "PostingDate": "date", "DueDate": "date", "InvoiceLineNumber": "int"}
    inv = spark.createDataFrame([], ", ".join(f"{c} {kinds.get(c, 'decimal(18,2)' if t.startswith('decimal') else t)}" for c, (_, t, _) in facts.INVOICE_COLUMNS.items() if c not in ("SourceSilverRecordHash",
                                "CurrencyCode", "SupplierID")) + ", InvoiceSupplierID string, InvoiceCurrency string, SilverRecordHash string")
    po = spark.createDataFrame([], ", ".join(f"{c} {'string' if c.endswith('ID') or c == 'CurrencyCode' else 'long'}" for c in ("POItemID", *facts.PO_FACT_KEYS)))
    dims = {"Supplier": spark.createDataFrame([], "SupplierID string, EffectiveFromDate date, EffectiveToDate date, SupplierKey long, DimensionVersion int"),
            "Currency": spark.createDataFrame([], "CurrencyCode string, CurrencyKey long")}
    out = facts.build_invoice_fact(inv, po, dims)
    assert dict(out.dtypes)["GrossAmount"] == "decimal(20,2)"
    plan = out._jdf.queryExecution().analyzed().toString().split("\n")
    below = plan[next(i for i, line in enumerate(plan) if "Join LeftOuter, (POItemID#" in line):]
    assert not any("decimal(20," in line for line in below)


def test_readers_of_few_columns_write_no_wide_table(spark, source):
    m = Mart(spark, source)
    m._silver_po_spend = lambda: spark.range(3).selectExpr("id", "sha2(cast(id AS string), 256) AS SilverRecordHash")
    plan = m.narrow["silver_po_spend"].select("id")
    assert sorted(r.id for r in plan.collect()) == [0, 1, 2] and not glob.glob(f"{m.root}/silver_po_spend")
    assert "sha2" not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert m["silver_po_spend"].count() == 3 and glob.glob(f"{m.root}/silver_po_spend/*.parquet")
    assert "FileScan" in m.narrow["silver_po_spend"]._jdf.queryExecution().executedPlan().toString()
    assert m.narrow["order_lines"] is m["order_lines"]       # other tables are staged and shared as before


def test_prior_stats_move_the_rows_once(spark):
    df = spark.createDataFrame([(f"i{i}", f"k{i % 7}", f"s{i % 2}", f"2000-01-0{1 + i % 9}", float(i % 5), "text") for i in range(100)],
                               "id string, k string, s string, d string, x double, payload string")
    lines = W.prior_stats(df, ["k"], "d", "id", "x", "P")._jdf.queryExecution().executedPlan().toString().split("\n")
    assert sum("Exchange hashpartitioning" in a and "payload#" in b for a, b in zip(lines, lines[1:])) == 1


def test_frequent_keys_are_dealt_by_day_and_change_no_result(spark):
    rows = [(f"i{i:04d}", None if i % 11 == 0 else "hot" if i % 3 else f"k{i % 400}", f"s{i % 2}", f"2000-01-{1 + i % 28:02d}", float(i * 7 % 13)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id string, k string, s string, d string, x double")
    hot = W.frequent_keys(df, [["k"]])[0]
    placed = df.withColumn("p", W.dealt(["k"], "d", hot))
    assert placed.where("k = 'hot'").select("p.__hot").distinct().collect() == [(True,)]
    assert placed.where("NOT p.__hot").select("p").distinct().count() > 0
    columns = ["id", "XHistoryCount", "XHistoricalAvgPriceEUR", "XHistoricalStdDevPriceEUR"]
    shown = [F.round(c, 9) if c != "id" else F.col(c) for c in columns]
    for deal in (F.array(), F.collect_set(F.xxhash64("k"))):        # none by day, all by day
        every = df.agg(deal.cast("array<bigint>").alias("h")).scalar()
        got = W.prior_stats(df.withColumn("p", W.dealt(["k"], "d", every)), ["s", "k"], "d", "id", "x", "X", place="p", spread=["k"])
        want = W.prior_stats(placed, ["s", "k"], "d", "id", "x", "X", place="p", spread=["k"])
        assert sorted(got.select(*shown).collect()) == sorted(want.select(*shown).collect())


def test_contracts_fan_out_in_many_tasks(spark, tmp_path):
    from spendline.sources.tpch import TpchSource
    spark.range(40).select(F.col("id").alias("s_suppkey")).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    got = TpchSource(spark, str(tmp_path)).contract()
    assert got.rdd.getNumPartitions() > 1 and got.count() == 1000


def test_parts_join_before_lines_are_numbered(spark, source):
    """Two rows of a part repeat its lines, a line without a part is dropped behind the numbering, as before; no task gets more than its rows."""
    at = dt.datetime(1996, 3, 1)
    lines = spark.read.parquet(f"{source}/lineitem.parquet")
    extra = spark.createDataFrame([(1, 99, 7, 0, 1.0, 9.0, 0.0, 0.0, "N", "F", at), (1, None, 7, 1, 1.0, 8.0, 0.0, 0.0, "N", "F", at), (5, 3, 7, 1, 1.0, 8.0, 0.0, 0.0, "N", "F", at)], lines.schema)
    extra.write.mode("append").parquet(f"{source}/lineitem.parquet")
    spark.createDataFrame([(4, "Brand#8"), (None, "Brand#9")], "p_partkey long, p_brand string").write.mode("append").parquet(f"{source}/part.parquet")
    numbered = Mart(spark, source).source.numbered_lines()
    rows = [(r["l_orderkey"], r["rn"], r["l_partkey"], r["n"]) for r in numbered.collect()]
    # line 0 of order 1 has an unknown part and the number 1; that without a part has the number 2, order 5 does not exist
    assert sorted(rows) == [(1, 3, 3, 12), (1, 4, 4, 7), (1, 4, 4, 8), (2, 1, 3, 12), (2, 2, 3, 12)]
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert depth(plan, "Window") < depth(plan, "RepartitionByExpression") < depth(plan, "Join LeftOuter, (l_partkey")


def test_hashing_small_sides_is_set_for_the_write_only(spark):
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(name)
    with small_sides_hashed(spark):
        assert spark.conf.get(name) == "64m"
    assert spark.conf.get(name) == before


def test_scorecard_parts_are_tables_of_their_own(spark, tmp_path):
    po = spark.createDataFrame([(True, "S1", 2000, "P1", "P1-1", D("10.00"), D("10.00"), D("0.00"), day(5), D("2.000")), (True, "S1", 2000, "P1", "P1-2", D("5.00"), D("0.00"), D("5.00"), day(5), D("1.000"))],
                               "SpendEligibilityFlag boolean, POSupplierID string, POYear int, POID string, POItemID string, EligibleSpendEUR decimal(18,2), ContractCompliantSpendEUR decimal(18,2), "
                               "MaverickSpendEUR decimal(18,2), RequestedDeliveryDate date, Quantity decimal(18,3)")
    rec = spark.createDataFrame([("P1-1", "G1", D("2.000"), day(7))], "POItemID string, GoodsReceiptID string, QuantityReceived decimal(18,3), ReceiptDate date")
    inv = spark.createDataFrame([("S2", 2000, "I1", "I1-1", True, False, D("7.00"), D("0.00"), None, True)],
                                "POSupplierID string, InvoiceYear int, InvoiceID string, InvoiceItemID string, ThreeWayMatchFlag boolean, InvoiceExceptionFlag boolean, GrossAmountEUR decimal(18,2), "
                                "InvoiceExceptionAmountEUR decimal(18,2), DisputeFlag boolean, DerivedDuplicateInvoiceFlag boolean")
    supplier = spark.createDataFrame([("S1", "One", "Maker", "X", "Y", True, False, "A", 3, "Active", True)],
                                     "SupplierID string, SupplierName string, SupplierType string, Country string, Region string, PreferredSupplier boolean, StrategicSupplier boolean, ESGRating string, "
                                     "FinancialRiskScore int, Status string, SupplierActiveFlag boolean")
    m = Mart(spark, str(tmp_path))
    m._tables.update({"silver_po_spend": po, "bronze_goods_receipt": rec, "silver_invoice_matching": inv, "silver_supplier": supplier})
    got = m["silver_supplier_performance"]
    assert sorted(p.rsplit("/", 1)[1] for p in glob.glob(f"{m.root}/*")) == ["scorecard_delivery", "scorecard_invoice", "scorecard_spend", "silver_supplier_performance"]
    whole = scorecard.build_scorecard(po, rec, inv, supplier, "2001-07-31")
    assert got.columns == whole.columns
    keep = [c for c in got.columns if "Timestamp" not in c]
    assert sorted(map(str, got.select(keep).collect())) == sorted(map(str, whole.select(keep).collect()))
    assert sorted((r["SupplierID"], r["POCount"], r["LateDeliveryPOItemCount"], r["DuplicateInvoiceCount"]) for r in got.collect()) == [("S1", 1, 1, 0), ("S2", 0, 0, 1)]


def test_exact_quantiles_tell_few_values_apart(spark, monkeypatch):
    """Only values near a quantile are kept apart; with bounds that miss it the answer stays exact."""
    df = spark.range(20_001).select(F.col("id").cast("double").alias("a"), F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(-F.col("id")).alias("b"))
    spec = {"q": ("a", 0.5), "r": ("b", 0.9), "s": ("a", 0.99995)}
    seen, pinned = [], W.reliable
    monkeypatch.setattr(W, "reliable", lambda x: seen.append(x.count()) or pinned(x))
    assert W.exact_quantiles(df, spec).first().asDict() == {"q": 10_000.0, "r": 7.0, "s": 19_999.0}
    assert max(seen) < 1_000
    monkeypatch.setattr(W, "_around", lambda *_: {"q": (3.0, 9.0), "r": (8.0, None), "s": (None, 5.0)})
    assert W.exact_quantiles(df, spec).first().asDict() == {"q": 10_000.0, "r": 7.0, "s": 19_999.0}


def test_forest_scores_equal_a_walk_from_node_to_node():
    from spendline.operators import ml
    rng = np.random.default_rng(5)
    x, trees, want = rng.normal(size=(300, 4)).round(1), [], np.zeros(300)
    x[::17, 2] = np.nan
    for tree, size in enumerate((256, 1, 2, 3, 60)):
        rows = pd.DataFrame(rng.normal(size=(size, 4)).round(1), columns=list("abcd")).assign(Tree=tree, __h=range(size))
        nodes = ml._grow(rows, list("abcd"), 42)
        trees.append(ml._levels(*(nodes[c].to_numpy() for c in ("Node", "Feature", "Split", "Left", "Right", "PathLength"))))
        by = nodes.set_index("Node")
        for i, row in enumerate(x):
            at = 0
            while by.Feature[at] >= 0:
                at = by.Left[at] if row[by.Feature[at]] < by.Split[at] else by.Right[at]
            want[i] += by.PathLength[at]
    assert (ml._path_sums(trees, x) == want).all() and len(ml._path_sums(trees, x[:0])) == 0


def test_price_features_of_one_year_see_the_history_of_all(spark):
    """The rows of one year are those of the whole table, null keys and repeated rows included; other years travel without their other columns."""
    from spendline.operators import features
    names = ["POItemID", "POID", "OrderDate", "SupplierID", "MaterialID", "CategoryID", "ContractID", "Quantity", "UnitPriceEUR", "LineAmountEUR", "ContractPriceVariancePct",
             "ContractPriceWithinToleranceFlag", "ValidContractAtPOFlag", "HasContractReferenceFlag", "PriceComplianceExceptionFlag", "ContractValidityStatusAtPO"]
    kinds = "string string date string string string string double decimal(20,6) double double int int int int string".split()
    rows = [(f"I{k // 2 if k % 40 == 0 else k}", f"P{k}", dt.date(1999 + k % 3, 1 + k % 12, 1 + k % 28), None if k % 11 == 0 else f"S{k % 3}", f"M{k % 4}", None if k % 13 == 0 else f"C{k % 2}",
             f"K{k}" if k % 5 else None, 1.0 + k, D(10 + k % 17), 5.0 * k, None if k % 7 else float(k), 1, 1, 1, 0, "VALID") for k in range(240)]
    base = spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(names, kinds))).withColumn("OrderYear", F.year("OrderDate"))
    whole = features.price_features(None, "2001-12-31", base).where("OrderYear = 2001")
    one = features.price_features(None, "2001-12-31", base, 2001)
    assert one.columns == whole.columns and one.count() == 80
    assert sorted(map(repr, one.collect())) == sorted(map(repr, whole.collect()))
    assert "CASE WHEN (OrderYear" in one._jdf.queryExecution().optimizedPlan().toString()


def test_readers_of_few_columns_do_not_ask_for_whole_wide_tables(spark):
    from spendline.plans import catalog
    po = spark.createDataFrame([("S1", "C1", 5.0, 1.0), ("S2", "C1", 7.0, 0.0), (None, None, 1.0, None)], "SupplierID string, CategoryID string, EligibleSpendEUR double, MaverickSpendEUR double")
    inv = spark.createDataFrame([("I1", 2000, True, False, True, 0.0), ("I1", 2000, True, False, False, 3.0), ("I2", 2001, False, True, True, 0.0)],
                                "InvoiceID string, InvoiceYear int, DisputeFlag boolean, DerivedDuplicateInvoiceFlag boolean, ThreeWayMatchFlag boolean, InvoiceExceptionAmountEUR double")

    class Narrow:
        def __getitem__(self, name):
            return {"fact_purchase_order": po, "silver_invoice_matching": inv}[name]

    class Whole:
        narrow = planned = Narrow()

        def __getitem__(self, name):
            raise AssertionError(f"{name} is asked for as a whole")

    run = lambda name: [tuple(r) for r in catalog.QUERIES[name].plan(Whole()).collect()]      # noqa: E731
    assert run("P90_order_desc") == [("S2", 7.0), ("S1", 5.0), (None, 1.0)]
    assert sorted(run("P63_rollup_flags")) == [(2000, 1, 1, 0), (2001, 1, 0, 1)]
    assert [r[:3] for r in sorted(run("Q06_annual_match_rate"))] == [(2000, 2, 1), (2001, 1, 1)]
    assert [r[0] for r in run("Q05_spend_by_category")] == ["C1", None]
