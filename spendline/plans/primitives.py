"""Queries for the generic operators (scans, projections, joins, aggregates, windows, sorts, sets)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendline.functions import exprs as E
from spendline.operators import aggregates as A
from spendline.operators import joins as J
from spendline.operators import shape as S
from spendline.operators import windows as W
from spendline.operators.facts import date_roles
from spendline.operators.savings import CONFIDENCE
from spendline.plans.mart import Mart
from spendline.plans.registry import query
from spendline.sources import tables as X


def _view(m: Mart, table: str) -> str:
    m.source.raw(table).createOrReplaceTempView(f"spendline_{table}")
    return f"spendline_{table}"


def _fresh(m: Mart, name: str) -> str:
    return f"{m.root}/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------------- scans and sinks

@query("P01_scan", "o_orderstatus:string n:long",
       "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(m):
    return X.scan(m.spark, _view(m, "orders")).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("P02_scan_path", "l_returnflag:string qty:double",
       "SELECT l_returnflag, sum(CAST(l_quantity AS BIGINT)) AS qty FROM lineitem GROUP BY 1")
def _(m):
    return (X.scan_path(m.spark, f"{m.source.directory}/lineitem.parquet").groupBy("l_returnflag")
            .agg(F.sum(F.col("l_quantity").cast("long")).alias("qty")))


@query("P03_from_rows", "SavingsLevel:string Weight:double Projects:long",
       "SELECT SavingsLevel, max(w100) / 100.0 AS Weight, count(*) AS Projects FROM savings GROUP BY 1")
def _(m):
    schema = T.StructType([T.StructField("SavingsLevel", T.StringType()), T.StructField("Weight", T.DoubleType())])
    weights = X.from_rows(m.spark, [(k, float(v)) for k, v in CONFIDENCE.items()], schema)
    return (m["silver_savings_project"].join(F.broadcast(weights), "SavingsLevel")
            .groupBy("SavingsLevel", "Weight").agg(F.count("*").alias("Projects")))


@query("P04_one_row", "orders:long lines:long", "SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM lineitem) AS lines")
def _(m):
    count = lambda t: m.source.raw(t).agg(F.count("*")).scalar()
    return X.one_row(m.spark, {"orders": count("orders"), "lines": count("lineitem")})


@query("P05_calendar", "Month:string Days:long OrderDays:long Orders:long", """
    SELECT strftime(d, '%Y-%m') AS Month, count(*) AS Days, count(n) AS OrderDays, coalesce(sum(n), 0) AS Orders
    FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
    LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS od, count(*) AS n FROM orders GROUP BY 1) ON d = od GROUP BY 1""")
def _(m):
    orders = m.source.raw("orders").select(F.to_date("o_orderdate").alias("Date"))
    days = X.calendar(orders.agg(F.min("Date").alias("lo"), F.max("Date").alias("hi")), F.col("lo"), F.col("hi"))
    per_day = orders.groupBy("Date").agg(F.count("*").alias("n"))
    return (days.join(per_day, "Date", "left").groupBy(E.year_month("Date").alias("Month"))
            .agg(F.count("*").alias("Days"), F.count("n").alias("OrderDays"), F.coalesce(F.sum("n"), F.lit(0)).alias("Orders")))


@query("P06_overwrite", "o_orderstatus:string n:long ColumnCount:int", "SELECT o_orderstatus, count(*) AS n, 2 AS ColumnCount FROM orders GROUP BY 1")
def _(m):
    path, orders = _fresh(m, "p06"), m.source.raw("orders").select("o_orderkey", "o_orderstatus")
    X.overwrite(orders.union(orders).withColumn("Old", F.lit("x")), path)
    written = X.overwrite(orders, path)
    return written.groupBy("o_orderstatus").agg(F.count("*").alias("n")).withColumn("ColumnCount", F.lit(len(written.columns)))


@query("P07_append", "o_orderstatus:string n:long noted:long", """
    SELECT o_orderstatus, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS noted FROM orders GROUP BY 1""")
def _(m):
    path, orders = _fresh(m, "p07"), m.source.raw("orders").select("o_orderkey", "o_orderstatus")
    X.append(orders.where("o_orderstatus <> 'F'"), path)
    history = X.append(orders.where("o_orderstatus = 'F'").withColumn("Note", F.lit("late")), path)
    return history.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count("Note").alias("noted"))


@query("P08_update_matched", "POStatus:string n:long total:double", """
    SELECT CASE WHEN o_orderkey % 20 = 0 THEN 'Cancelled' WHEN o_orderstatus = 'F' THEN 'Archived' WHEN o_orderstatus = 'O' THEN 'Open'
      ELSE 'Partially Received' END AS POStatus, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY 1""")
def _(m):
    header = m["bronze_purchase_order_header"]
    closed = header.where("POStatus = 'Closed'").select("POID", F.lit("Archived").alias("POStatus"))
    return (X.update_matched(header, closed, ["POID"], ["POStatus"]).groupBy("POStatus")
            .agg(F.count("*").alias("n"), F.sum("TotalAmount").alias("total")))


@query("P09_ensure_audit", "POID:string SourceSystem:string LoadDate:string SourceRecordHash:string", """
    SELECT 'PO' || o_orderkey AS POID, 'ERP' AS SourceSystem, DATE '2001-08-01' AS LoadDate,
      sha256('PO' || o_orderkey || '||S' || (o_custkey // 15) || '||' || CAST(o_orderdate AS DATE)) AS SourceRecordHash FROM orders""")
def _(m):
    return X.ensure_audit(m["bronze_purchase_order_header"], "ERP", "2001-08-01", ["POID", "SupplierID", "OrderDate"])


@query("P10_require_tables", "n:long", "SELECT count(*) AS n FROM orders")
def _(m):
    name = _view(m, "orders")
    X.require_tables(m.spark, [name])
    return X.scan(m.spark, name).agg(F.count("*").alias("n"))


@query("P11_verify_written", "rows:long", "SELECT count(*) AS rows FROM part")
def _(m):
    written = X.overwrite_verified(m.source.raw("part"), _fresh(m, "p11"))
    return written.agg(F.count("*").alias("rows"))


@query("P12_inventory", "TableName:string RowCount:long ColumnCount:int", """
    SELECT 'orders' AS TableName, count(*) AS RowCount, 6 AS ColumnCount FROM orders UNION ALL SELECT 'lineitem', count(*), 11 FROM lineitem
    UNION ALL SELECT 'part', count(*), 6 FROM part UNION ALL SELECT 'supplier', count(*), 4 FROM supplier""")
def _(m):
    return X.inventory({t: m.source.raw(t) for t in ("orders", "lineitem", "part", "supplier")})


# ---------------------------------------------------------------------- projections and predicates

@query("P20_project", "POID:string Key:long Amount:double", """
    SELECT 'PO' || o_orderkey AS POID, o_orderkey AS Key, CAST(o_totalprice AS DECIMAL(18,2)) AS Amount FROM orders""")
def _(m):
    order_id = F.concat(F.lit("PO"), F.col("o_orderkey").cast("string"))
    return S.project(m.source.raw("orders"), {"POID": (order_id, "string"), "Key": "o_orderkey", "Amount": ("o_totalprice", "decimal(18,2)")})


@query("P21_rename_present", "Segment:string n:long", "SELECT c_mktsegment AS Segment, count(*) AS n FROM customer GROUP BY 1")
def _(m):
    return (S.rename_present(m.source.raw("customer"), {"c_mktsegment": "Segment", "absent": "Absent"})
            .groupBy("Segment").agg(F.count("*").alias("n")))


@query("P22_normalize_strings", "doc_id:long digest:string", """
    SELECT doc_id, md5(nullif(trim(regexp_replace(text, '\\s+', ' ', 'g')), '')) AS digest FROM documents""")
def _(m):
    return S.normalize_strings(m.source.raw("documents").select("doc_id", "text")).select("doc_id", F.md5("text").alias("digest"))


@query("P23_upper_cols", "lang:string source:string n:long", "SELECT upper(lang) AS lang, upper(source) AS source, count(*) AS n FROM documents GROUP BY 1, 2")
def _(m):
    return S.upper_cols(m.source.raw("documents").select("lang", "source"), ["lang", "source", "none"]).groupBy("lang", "source").agg(F.count("*").alias("n"))


@query("P24_canonical_enum", "label:string n:long", """
    SELECT CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Automobile' WHEN 'BUILDING' THEN 'Building' ELSE c_mktsegment END AS label, count(*) AS n
    FROM customer GROUP BY 1""")
def _(m):
    return (m.source.raw("customer").select(E.canonical("c_mktsegment", ["Automobile", "Building"]).alias("label"))
            .groupBy("label").agg(F.count("*").alias("n")))


@query("P25_title_case", "label:string n:long", """
    SELECT array_to_string(list_transform(string_split(lower(p_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS label, count(*) AS n
    FROM part GROUP BY 1""")
def _(m):
    return m.source.raw("part").groupBy(E.title_case(F.upper("p_name")).alias("label")).agg(F.count("*").alias("n"))


@query("P26_resolve", "Status:string Missing:string n:long", "SELECT o_orderstatus AS Status, NULL AS Missing, count(*) AS n FROM orders GROUP BY 1")
def _(m):
    out = S.resolve(m.source.raw("orders"), {"Status": (["PO Status", "O-ORDER_STATUS"], "string", True), "Missing": (["Nothing"], "string", False)})
    return out.groupBy("Status", "Missing").agg(F.count("*").alias("n"))


@query("P27_flag", "Large:boolean n:long", "SELECT l_quantity >= 25 AS Large, count(*) AS n FROM lineitem GROUP BY 1")
def _(m):
    return S.flag(m.source.raw("lineitem"), "Large", F.col("l_quantity") >= 25).groupBy("Large").agg(F.count("*").alias("n"))


@query("P28_not_in_domain", "n:long", """
    SELECT count(*) AS n FROM c_supplier WHERE ESGRating IS NULL OR ESGRating NOT IN ('A', 'B')""")
def _(m):
    return m["silver_supplier"].where(E.not_in_domain("ESGRating", ["A", "B"])).agg(F.count("*").alias("n"))


@query("P29_null_safe_eq", "Same:boolean n:long", "SELECT ContractID IS NOT DISTINCT FROM ResolvedContractID AS Same, count(*) AS n FROM po GROUP BY 1")
def _(m):
    return m["silver_po_spend"].groupBy(E.same("ContractID", "ResolvedContractID").alias("Same")).agg(F.count("*").alias("n"))


@query("P30_differs", "n:long", "SELECT count(*) AS n FROM part JOIN lineitem ON p_partkey = l_partkey WHERE abs(l_extendedprice - l_quantity * p_retailprice) > 1000.0")
def _(m):
    joined = m.source.raw("lineitem").join(m.source.raw("part"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.where(E.differs("l_extendedprice", F.col("l_quantity") * F.col("p_retailprice"), 1000.0)).agg(F.count("*").alias("n"))


@query("P31_amount_if", "l_linestatus:string returned:double", """
    SELECT l_linestatus, sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS returned FROM lineitem GROUP BY 1""")
def _(m):
    flagged = m.source.raw("lineitem").withColumn("back", F.col("l_returnflag") == "R")
    return flagged.groupBy("l_linestatus").agg(F.sum(E.amount_if("back", "l_extendedprice")).alias("returned"))


@query("P32_any_all", "anyof:long allof:long", """
    SELECT count(*) FILTER (l_tax > 0.05 OR l_discount > 0.05 OR l_quantity > 45) AS anyof,
      count(*) FILTER (l_tax > 0.05 AND l_discount > 0.05 AND l_quantity > 45) AS allof FROM lineitem""")
def _(m):
    tests = [F.col("l_tax") > 0.05, F.col("l_discount") > 0.05, F.col("l_quantity") > 45]
    return m.source.raw("lineitem").agg(F.count_if(E.any_of(tests)).alias("anyof"), F.count_if(E.all_of(tests)).alias("allof"))


@query("P33_fill_defaults", "Lines:long Orders:long", """
    SELECT coalesce(n, 0) AS Lines, count(*) AS Orders FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
      ON l_orderkey = o_orderkey GROUP BY 1""")
def _(m):
    counts = m.source.raw("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("Lines"))
    out = S.fill_defaults(m.source.raw("orders").select("o_orderkey").join(counts, "o_orderkey", "left"), {"long": ["Lines"]})
    return out.groupBy("Lines").agg(F.count("*").alias("Orders"))


@query("P34_stamp", "c_custkey:long BronzeSourceTable:string SilverRecordHash:string", """
    SELECT c_custkey, 'customer' AS BronzeSourceTable,
      sha256(c_custkey || '||' || c_name || '||' || c_nationkey || '||' || coalesce(nullif(c_mktsegment, 'BUILDING'), '__NULL__')) AS SilverRecordHash FROM customer""")
def _(m):
    df = m.source.raw("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                         F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return S.stamp(df, "customer", "Silver", exclude=["c_acctbal", "BronzeSourceTable"])


# ---------------------------------------------------------------------- joins

@query("P40_join_header_item", "POStatus:string n:long amount:double", """
    SELECT POStatus, count(*) AS n, sum(amt) / 100.0 AS amount FROM po_items GROUP BY 1""")
def _(m):
    out = J.join_header_item(m["bronze_purchase_order_header"].select("POID", "POStatus"), m["bronze_purchase_order_item"], "POID")
    return out.groupBy("POStatus").agg(F.count("*").alias("n"), F.sum("LineAmount").alias("amount"))


@query("P41_lookup", "Country:string n:long", """
    SELECT Country, count(*) AS n FROM orders LEFT JOIN c_supplier ON SupplierID = 'S' || (o_custkey // 15) GROUP BY 1""")
def _(m):
    out = J.lookup(m["bronze_purchase_order_header"], m["silver_supplier"], {"SupplierID": "SupplierID"}, ["Country"])
    return out.groupBy("Country").agg(F.count("*").alias("n"))


@query("P41_skewed_lookup", "ContractType:string n:long amount:double resolved:long", """
    SELECT ContractType, count(*) AS n, sum(amt) / 100.0 AS amount, count(c.ContractID) AS resolved FROM po_items p LEFT JOIN c_contract c ON p.ContractID = c.ContractID GROUP BY 1""")
def _(m):
    """Two tenths of the items have no contract."""
    out = J.lookup_skewed(m["bronze_purchase_order_item"], m["silver_contract"], {"ContractID": "ContractID"}, ["ContractType"], found="Resolved")
    return out.groupBy("ContractType").agg(F.count("*").alias("n"), F.sum("LineAmount").alias("amount"), F.count_if("Resolved").alias("resolved"))


@query("P43_skewed_composite", "Currency:string n:long rates:long", """
    SELECT POCurrency AS Currency, count(*) AS n, count(ru) AS rates FROM po_items LEFT JOIN fx ON d = OrderDate AND ccy = POCurrency GROUP BY 1""")
def _(m):
    """Items by the order date and currency of their order."""
    items = m["bronze_purchase_order_item"].select("POID").join(m["bronze_purchase_order_header"].select("POID", "OrderDate", "Currency"), "POID")
    out = J.lookup_skewed(items, m["silver_exchange_rate"], {"OrderDate": "RateDate", "Currency": "Currency"}, ["ExchangeRateToEUR"])
    return out.groupBy("Currency").agg(F.count("*").alias("n"), F.count("ExchangeRateToEUR").alias("rates"))


@query("P42_resolved_flag", "Found:boolean n:long", """
    SELECT c.ContractID IS NOT NULL AS Found, count(*) AS n FROM po_items p LEFT JOIN c_contract c ON p.ContractID = c.ContractID GROUP BY 1""")
def _(m):
    out = J.resolved_flag(m["bronze_purchase_order_item"], m["silver_contract"], {"ContractID": "ContractID"}, "Found")
    return out.groupBy("Found").agg(F.count("*").alias("n"))


@query("P43_composite_lookup", "Currency:string n:long rates:long", """
    SELECT POCurrency AS Currency, count(*) AS n, count(ru) AS rates FROM (SELECT DISTINCT POID, POCurrency, OrderDate FROM po_items)
    LEFT JOIN fx ON d = OrderDate AND ccy = POCurrency GROUP BY 1""")
def _(m):
    head = m["bronze_purchase_order_header"].join(m["bronze_purchase_order_item"].select("POID").distinct(), "POID", "left_semi")
    out = J.lookup(head, m["silver_exchange_rate"], {"OrderDate": "RateDate", "Currency": "Currency"}, ["ExchangeRateToEUR"])
    return out.groupBy("Currency").agg(F.count("*").alias("n"), F.count("ExchangeRateToEUR").alias("rates"))


@query("P44_asof_scd2", "POID:string SupplierVersion:int RiskScore:int", """
    SELECT 'PO' || o_orderkey AS POID, DimensionVersion AS SupplierVersion, FinancialRiskScore AS RiskScore FROM orders
    LEFT JOIN dim_supplier ON SupplierID = 'S' || (o_custkey // 15) AND CAST(o_orderdate AS DATE) BETWEEN EffectiveFromDate AND EffectiveToDate""")
def _(m):
    return J.asof_versions(m["bronze_purchase_order_header"], m["dim_supplier"], "SupplierID", "OrderDate",
                           {"DimensionVersion": "SupplierVersion", "FinancialRiskScore": "RiskScore"})


@query("P45_received_asof", "InvoiceItemID:string Received:double Receipts:long Latest:string", """
    SELECT InvoiceItemID, received_m / 1000.0 AS Received, receipt_count AS Receipts, last_receipt AS Latest FROM inv_received""")
def _(m):
    from spendline.operators.matching import received_asof
    inv = m["bronze_invoice_item"].select("InvoiceItemID", "InvoiceID", "POItemID").join(
        m["bronze_invoice_header"].select("InvoiceID", "InvoiceDate"), "InvoiceID")
    return received_asof(inv, m["bronze_goods_receipt"]).withColumnsRenamed({
        "CalculatedReceivedQuantityAtInvoiceDate": "Received", "GoodsReceiptCountAtInvoiceDate": "Receipts",
        "LatestReceiptDateAtInvoiceDate": "Latest"})


@query("P46_dim_at", "SupplierID:string DimensionVersion:int", """
    SELECT SupplierID, DimensionVersion FROM dim_supplier WHERE DATE '1998-06-30' BETWEEN EffectiveFromDate AND EffectiveToDate""")
def _(m):
    return J.dim_at(m["dim_supplier"], "1998-06-30")


@query("P47_orphans", "ContractID:string RecordCount:long", """
    SELECT ContractID, count(*) AS RecordCount FROM po_items WHERE ContractID NOT IN (SELECT ContractID FROM c_contract) GROUP BY 1""")
def _(m):
    return J.orphans(m["bronze_purchase_order_item"], ["ContractID"], m["silver_contract"], ["ContractID"])


@query("P48_reconcile", "POYear:int SpendLeft:double SpendRight:double ReconciledFlag:boolean", """
    SELECT POYear, l / 100.0 AS SpendLeft, r / 100.0 AS SpendRight, coalesce(abs(coalesce(l, 0) - coalesce(r, 0)) <= 5, FALSE) AS ReconciledFlag
    FROM (SELECT POYear, sum(elig_c) AS l FROM po GROUP BY 1) FULL JOIN
      (SELECT PerformanceYear AS POYear, sum(elig_c) AS r FROM score GROUP BY 1 HAVING sum(elig_c) > 0) USING (POYear)""")
def _(m):
    left = m["silver_po_spend"].groupBy("POYear").agg(F.sum("EligibleSpendEUR").alias("Spend"))
    right = (m["silver_supplier_performance"].groupBy(F.col("PerformanceYear").alias("POYear")).agg(F.sum("EligibleSpendEUR").alias("Spend"))
             .where("Spend > 0"))
    return J.reconcile(left, right, ["POYear"], ["Spend"], 0.05)


@query("P49_pair_with_original", "InvoiceItemID:string GrossAmount:double OriginalGrossAmount:double OriginalFoundFlag:boolean", """
    SELECT d.InvoiceItemID, d.grossc / 100.0 AS GrossAmount, o.grossc / 100.0 AS OriginalGrossAmount, o.InvoiceItemID IS NOT NULL AS OriginalFoundFlag
    FROM invoice_items d LEFT JOIN invoice_items o ON d.OriginalInvoiceItemID = o.InvoiceItemID WHERE d.OriginalInvoiceItemID IS NOT NULL""")
def _(m):
    return J.pair_with_original(m["bronze_invoice_item"], "InvoiceItemID", "OriginalInvoiceItemID", ["GrossAmount"])


@query("P50_date_key", "InvoiceID:string InvoiceDateKey:int DueDateKey:int", """
    SELECT InvoiceID, CAST(strftime(InvoiceDate, '%Y%m%d') AS INT) AS InvoiceDateKey, CAST(strftime(DueDate, '%Y%m%d') AS INT) AS DueDateKey FROM invoices""")
def _(m):
    return date_roles(m["bronze_invoice_header"], {"InvoiceDate": "InvoiceDateKey", "DueDate": "DueDateKey"}, m["dim_date"])


@query("P51_assert_unique", "n:long", "SELECT count(*) AS n FROM orders")
def _(m):
    out = J.asof_versions(m["bronze_purchase_order_header"], m["dim_supplier"], "SupplierID", "OrderDate", {"SupplierKey": "SupplierKey"})
    return J.assert_unique(out, ["POID"]).agg(F.count("*").alias("n"))


@query("P52_shift_join", "SupplierID:string PerformanceYear:int FutureOutcomeYear:int FutureOTD:double", """
    SELECT SupplierID, PerformanceYear, FutureOutcomeYear, fo AS FutureOTD FROM risk_pairs""")
def _(m):
    f = m["risk_features"]
    return J.shift_join(f.where("PerformanceYear <= 1999").select("SupplierID", "PerformanceYear"), f.where("PerformanceYear <= 2000"),
                        "SupplierID", "PerformanceYear", {"SupplierOTDPct": "FutureOTD"}, "FutureOutcomeYear")


@query("P53_attach_scores", "Scored:boolean n:long spend:double", """
    SELECT s.POItemID IS NOT NULL AS Scored, count(*) AS n, sum(elig_c) / 100.0 AS spend FROM fact_po p LEFT JOIN pscores s ON p.POItemID = s.POItemID GROUP BY 1""")
def _(m):
    out = J.attach_scores(m.narrow["fact_purchase_order"].select("POItemID", "EligibleSpendEUR"), m["pricing_scores"].select("POItemID", "PricingAnomalyScore"), "POItemID")
    return out.groupBy(F.col("PricingAnomalyScore").isNotNull().alias("Scored")).agg(F.count("*").alias("n"), F.sum("EligibleSpendEUR").alias("spend"))


@query("P54_treat_as", "n:long spend:double", """
    SELECT count(*) AS n, sum(elig_c) / 100.0 AS spend FROM fact_po WHERE POSupplierID IN (SELECT SupplierID FROM rscores WHERE PredictedHighRiskFlag = 1)""")
def _(m):
    out = J.treat_as(m["fact_purchase_order"], m["risk_scores"].where("PredictedHighRiskFlag = 1"), "SupplierID")
    return out.agg(F.count("*").alias("n"), F.sum("EligibleSpendEUR").alias("spend"))


# ---------------------------------------------------------------------- aggregates

@query("P60_aggregate", "l_returnflag:string l_linestatus:string qty:double amount:double lo:double hi:double n:long", """
    SELECT l_returnflag, l_linestatus, sum(CAST(l_quantity AS BIGINT)) AS qty, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount,
      min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def _(m):
    return A.aggregate(m.source.raw("lineitem"), ["l_returnflag", "l_linestatus"], {
        "qty": F.sum(F.col("l_quantity").cast("long")), "amount": F.sum(F.col("l_extendedprice").cast("decimal(18,2)")),
        "lo": F.min("l_extendedprice"), "hi": F.max("l_extendedprice"), "n": F.count("*")})


@query("P61_distinct_count", "POYear:int pos:long items:long suppliers:long", """
    SELECT POYear, count(DISTINCT POID) AS pos, count(DISTINCT POItemID) AS items, count(DISTINCT POSupplierID) AS suppliers FROM po GROUP BY 1""")
def _(m):
    return m["silver_po_spend"].groupBy("POYear").agg(F.countDistinct("POID").alias("pos"), F.countDistinct("POItemID").alias("items"),
                                                      F.countDistinct("POSupplierID").alias("suppliers"))


@query("P62_count_where", "event_type:string n:long high:long", "SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS high FROM events GROUP BY 1")
def _(m):
    return m.source.raw("events").groupBy("event_type").agg(F.count("*").alias("n"), E.count_where(F.col("value") > 50).alias("high"))


@query("P63_rollup_flags", "InvoiceYear:int DocumentCount:long Disputed:long Duplicate:long", """
    SELECT InvoiceYear, count(DISTINCT InvoiceID) AS DocumentCount, count(DISTINCT InvoiceID) FILTER (DisputeFlag) AS Disputed,
      count(DISTINCT InvoiceID) FILTER (DerivedDuplicateInvoiceFlag) AS Duplicate FROM inv GROUP BY 1""")
def _(m):
    return A.rollup_flags(m.narrow["silver_invoice_matching"], ["InvoiceID"], ["InvoiceYear"], {"DisputeFlag": "Disputed", "DerivedDuplicateInvoiceFlag": "Duplicate"})


@query("P64_total", "o_orderpriority:string total:double grand:double", """
    SELECT o_orderpriority, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total, (SELECT sum(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders) AS grand FROM orders GROUP BY 1""")
def _(m):
    per = m.source.raw("orders").groupBy("o_orderpriority").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
    return A.with_total(per, "total", "grand")


@query("P65_share_of_total", "POYear:int SpendComplianceStatus:string spend:double share:double year_share:double", """
    SELECT POYear, SpendComplianceStatus, s / 100.0 AS spend, CASE WHEN sum(s) OVER () > 0 THEN round((s / 100.0::DOUBLE) * 100.0 / (sum(s) OVER () / 100.0::DOUBLE), 2) END AS share,
      CASE WHEN sum(s) OVER (PARTITION BY POYear) > 0 THEN round((s / 100.0::DOUBLE) * 100.0 / (sum(s) OVER (PARTITION BY POYear) / 100.0::DOUBLE), 2) END AS year_share
    FROM (SELECT POYear, SpendComplianceStatus, sum(amt_eur) AS s FROM po GROUP BY 1, 2)""")
def _(m):
    per = m["silver_po_spend"].groupBy("POYear", "SpendComplianceStatus").agg(F.sum("LineAmountEUR").alias("spend"))
    return A.share_of_total(A.share_of_total(per, "spend", "share"), "spend", "year_share", ["POYear"])


@query("P66_pct", "o_orderstatus:string high_pct:double none:double", """
    SELECT o_orderstatus, round(count(*) FILTER (o_totalprice > 300000) * 100.0::DOUBLE / count(*), 2) AS high_pct, NULL AS none FROM orders GROUP BY 1""")
def _(m):
    out = m.source.raw("orders").groupBy("o_orderstatus").agg(F.count_if(F.col("o_totalprice") > 300000).alias("h"), F.count("*").alias("n"))
    return out.withColumns({"high_pct": E.pct("h", "n"), "none": E.pct("h", F.lit(0))})


@query("P67_duplicates", "l_orderkey:long l_linenumber:int RecordCount:long", """
    SELECT l_orderkey, l_linenumber, count(*) AS RecordCount FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def _(m):
    return J.duplicates(m.source.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@query("P68_quantile", "q25:double q75:double", "SELECT quantile_cont(l_extendedprice, 0.25) AS q25, quantile_cont(l_extendedprice, 0.75) AS q75 FROM lineitem")
def _(m):
    return W.exact_quantiles(m.source.raw("lineitem"), {"q25": ("l_extendedprice", 0.25), "q75": ("l_extendedprice", 0.75)})


@query("P68_quantile_sketch", "Name:string Within:boolean", "SELECT unnest(['q25', 'q75']) AS Name, TRUE AS Within FROM (SELECT count(*) AS n FROM lineitem) WHERE n > 0")
def _(m):
    """Whether the rank of each sketched value is within 1 % of the rows of where it should be."""
    prices = m.source.raw("lineitem").select("l_extendedprice")
    spec = {"q25": ("l_extendedprice", 0.25), "q75": ("l_extendedprice", 0.75)}
    sketch = A.quantile_sketch(prices, spec)
    value = {n: sketch.select(n).scalar() for n in spec}
    ranks = prices.agg(F.count("*").alias("n"), *[F.count_if(F.col("l_extendedprice") < v).alias(f"{n}_lo") for n, v in value.items()],
                       *[F.count_if(F.col("l_extendedprice") <= v).alias(f"{n}_hi") for n, v in value.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("Name"), ((F.col(f"{n}_lo") <= (p + 0.01) * F.col("n")) & (F.col(f"{n}_hi") >= (p - 0.01) * F.col("n"))).alias("Within"))
                     for n, (_, p) in spec.items()])
    return ranks.select(F.inline(rows))


@query("P69_rank_error", "l_returnflag:string Name:string Within:boolean", """
    SELECT l_returnflag, unnest(['p50', 'p90', 'p99']) AS Name, TRUE AS Within FROM (SELECT DISTINCT l_returnflag FROM lineitem)""")
def _(m):
    """Whether the rank of each sketched percentile is within 1 / accuracy of the group's rows of where it should be."""
    prices, ps = m.source.raw("lineitem").select("l_returnflag", "l_extendedprice"), {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    sketch = A.percentiles(prices, ["l_returnflag"], "l_extendedprice", ps, 10000)
    ranks = prices.join(sketch, "l_returnflag").groupBy("l_returnflag").agg(
        F.count("*").alias("n"), *[F.count_if(F.col("l_extendedprice") < F.col(n)).alias(f"{n}_lo") for n in ps],
        *[F.count_if(F.col("l_extendedprice") <= F.col(n)).alias(f"{n}_hi") for n in ps])
    slack = F.ceil(F.col("n") / 10000.0)
    rows = F.array(*[F.struct(F.lit(n).alias("Name"), ((F.col(f"{n}_lo") <= p * F.col("n") + slack) & (F.col(f"{n}_hi") >= p * F.col("n") - slack)).alias("Within"))
                     for n, p in ps.items()])
    return ranks.select("l_returnflag", F.inline(rows))


@query("P69_percentiles", "l_returnflag:string p50:double p90:double p99:double")
def _(m):
    return A.percentiles(m.source.raw("lineitem"), ["l_returnflag"], "l_extendedprice", {"p50": 0.5, "p90": 0.9, "p99": 0.99})


@query("P70_null_profile", "ColumnName:string NullCount:long RowCount:long NullPct:double", """
    SELECT c AS ColumnName, n AS NullCount, t AS RowCount, round(n * 100.0::DOUBLE / t, 2) AS NullPct FROM (
      SELECT 'ContractID' AS c, count(*) FILTER (ContractID IS NULL) AS n, count(*) AS t FROM po
      UNION ALL SELECT 'ResolvedContractID', count(*) FILTER (ResolvedContractID IS NULL), count(*) FROM po
      UNION ALL SELECT 'LineAmountEUR', count(*) FILTER (amt_eur IS NULL), count(*) FROM po)""")
def _(m):
    return A.null_profile(m["silver_po_spend"], ["ContractID", "ResolvedContractID", "LineAmountEUR"])


@query("P71_distinct_keys", "c_nationkey:int c_mktsegment:string", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def _(m):
    return m.source.raw("customer").select("c_nationkey", "c_mktsegment").distinct()


@query("P72_max_across", "latest:string", "SELECT max(greatest(InvoiceDate, PostingDate, DueDate)) AS latest FROM invoices")
def _(m):
    return A.max_across(m["bronze_invoice_header"], ["InvoiceDate", "PostingDate", "DueDate"], "latest")


@query("P73_coverage", "OrderYear:int RowCount:long ContractPct:double", """
    SELECT OrderYear, count(*) AS RowCount, round(avg(CAST(HasContractBenchmarkFlag AS DOUBLE)) * 100.0, 2) AS ContractPct FROM price_feat GROUP BY 1""")
def _(m):
    return A.coverage(m["price_features"], ["OrderYear"], {"HasContractBenchmarkFlag": "ContractPct"})


# ---------------------------------------------------------------------- windows

@query("P80_dedup_latest", "SupplierID:string SupplierName:string", """
    SELECT trim(SupplierID) AS SupplierID, SupplierName FROM b_supplier QUALIFY row_number() OVER (PARTITION BY trim(SupplierID) ORDER BY copy) = 1""")
def _(m):
    df = m["bronze_supplier"].withColumn("SupplierID", F.trim("SupplierID"))
    return S.dedup_latest(df, ["SupplierID"], ["IngestionTimestamp", "SourceRecordHash"])


@query("P81_first_last", "Currency:string FirstDate:string FirstValue:double LastDate:string LastValue:double", """
    SELECT ccy AS Currency, lo AS FirstDate, lo_ru / 1000000.0 AS FirstValue, hi AS LastDate, hi_ru / 1000000.0 AS LastValue FROM fx_ends""")
def _(m):
    return A.first_last(m["silver_exchange_rate"], "Currency", "RateDate", "ExchangeRateToEUR")


@query("P82_prior_year", "SupplierID:string PerformanceYear:int PriorItems:long", """
    SELECT SupplierID, PerformanceYear, CASE WHEN lag(PerformanceYear) OVER w = PerformanceYear - 1 THEN lag(POItemCount) OVER w END AS PriorItems
    FROM sy_spend WINDOW w AS (PARTITION BY SupplierID ORDER BY PerformanceYear)""")
def _(m):
    spend = m["silver_supplier_performance"].where("POItemCount > 0").select("SupplierID", "PerformanceYear", "POItemCount")
    return W.prior_year(spend, "SupplierID", "PerformanceYear", {"POItemCount": "PriorItems"})


@query("P83_rolling_range", "SupplierID:string PerformanceYear:int xObservationCount:long xAverage:double xStdDev:double", """
    SELECT SupplierID, PerformanceYear, count(POItemCount) OVER w AS xObservationCount, round(avg(POItemCount) OVER w, 6) AS xAverage,
      round(stddev_samp(POItemCount) OVER w, 6) AS xStdDev
    FROM sy_spend WINDOW w AS (PARTITION BY SupplierID ORDER BY PerformanceYear RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def _(m):
    spend = m["silver_supplier_performance"].where("POItemCount > 0").select("SupplierID", "PerformanceYear", "POItemCount")
    out = W.rolling_range(spend, "SupplierID", "PerformanceYear", 2, "POItemCount", "x")
    return out.withColumns({"xAverage": F.round("xAverage", 6), "xStdDev": F.round("xStdDev", 6)})


@query("P84_prior_stats", "POItemID:string n:long total:double sd:double lo:double hi:double", """
    SELECT POItemID, CategoryHistoryCount AS n, CASE WHEN CategoryHistoryCount > 0 THEN round(CategoryAvg * CategoryHistoryCount, 4) END AS total, round(CategorySd, 2) AS sd, CategoryMin AS lo, CategoryMax AS hi FROM price_hist""")
def _(m):
    base = m["price_features"].select("POItemID", "CategoryID", "OrderDate", "UnitPriceEUR")
    out = W.prior_stats(base, ["CategoryID"], "OrderDate", "POItemID", "UnitPriceEUR", "x")
    return out.select("POItemID", F.col("xHistoryCount").alias("n"), F.round(F.col("xHistoricalAvgPriceEUR") * F.col("xHistoryCount"), 4).alias("total"),
                      F.round("xHistoricalStdDevPriceEUR", 2).alias("sd"), F.col("xHistoricalMinPriceEUR").alias("lo"),
                      F.col("xHistoricalMaxPriceEUR").alias("hi"))


@query("P85_partition_total", "POSupplierID:string POYear:int spend:double year_total:double", """
    SELECT SupplierID AS POSupplierID, PerformanceYear AS POYear, elig_c / 100.0 AS spend, sum(elig_c) OVER (PARTITION BY PerformanceYear) / 100.0 AS year_total FROM sy_spend""")
def _(m):
    per = m["silver_po_spend"].where("SpendEligibilityFlag").groupBy("POSupplierID", "POYear").agg(F.sum("EligibleSpendEUR").alias("spend"))
    return A.with_total(per, "spend", "year_total", ["POYear"])


@query("P86_rank_within", "SupplierID:string CategoryID:string Rank:long", """
    SELECT SupplierID, CategoryID, row_number() OVER (PARTITION BY CategoryID ORDER BY spend_y DESC, SupplierID) AS Rank FROM opp""")
def _(m):
    return W.rank_within(m["opportunities"], ["CategoryID"], [F.desc("AnnualizedEligibleSpendEUR"), F.asc("SupplierID")], "Rank")


@query("P87_global_rank", "o_orderkey:long Rank:long", """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS Rank FROM orders""")
def _(m):
    return W.global_rank(m.source.raw("orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], "Rank")


@query("P88_global_percent_rank", "POItemID:string Score:double", """
    SELECT POItemID, round(percent_rank() OVER (ORDER BY ContractPriceVariancePercentage NULLS FIRST) * 100.0, 8) AS Score FROM po""")
def _(m):
    out = W.global_percent_rank(m["silver_po_spend"].select("POItemID", "ContractPriceVariancePercentage"), "ContractPriceVariancePercentage", "Score")
    return out.withColumn("Score", F.round("Score", 8))


@query("P89_overlaps", "ContractID:string SupplierID:string ContractStartDate:string PreviousEnd:string", """
    SELECT ContractID, SupplierID, ContractStartDate, PreviousEnd FROM (SELECT *, lag(ContractEndDate) OVER
      (PARTITION BY SupplierID ORDER BY ContractStartDate, ContractID) AS PreviousEnd FROM c_contract) WHERE ContractStartDate <= PreviousEnd""")
def _(m):
    return W.overlaps(m["silver_contract"].select("ContractID", "SupplierID", "ContractStartDate", "ContractEndDate"),
                      "SupplierID", "ContractStartDate", "ContractEndDate", order="ContractID")


# ---------------------------------------------------------------------- sorts and sets

@query("P90_order_desc", "SupplierID:string spend:double", "SELECT POSupplierID AS SupplierID, sum(elig_c) / 100.0 AS spend FROM po GROUP BY 1 ORDER BY 2 DESC")
def _(m):
    per = m.narrow["fact_purchase_order"].groupBy("SupplierID").agg(F.sum("EligibleSpendEUR").alias("spend"))
    return A.order_by(per, F.desc("spend"))


@query("P91_order_by", "c_mktsegment:string c_name:string", "SELECT c_mktsegment, c_name FROM customer ORDER BY 1, 2")
def _(m):
    return A.order_by(m.source.raw("customer"), "c_mktsegment", "c_name")


@query("P92_top_n", "o_orderkey:long o_totalprice:double", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(m):
    return A.top_n(m.source.raw("orders"), 10, F.desc("o_totalprice"), "o_orderkey")


@query("P93_rank_candidates", "SpendComplianceStatus:string n:long spend:double Position:long", """
    SELECT *, row_number() OVER (ORDER BY spend DESC, n DESC, SpendComplianceStatus) AS Position FROM (
      SELECT SpendComplianceStatus, count(*) AS n, coalesce(sum(elig_c), 0) / 100.0 AS spend FROM po GROUP BY 1)""")
def _(m):
    per = m["silver_po_spend"].groupBy("SpendComplianceStatus").agg(F.count("*").alias("n"), F.coalesce(F.sum("EligibleSpendEUR"), F.lit(0)).alias("spend"))
    return W.global_rank(per, [F.desc("spend"), F.desc("n"), F.asc("SpendComplianceStatus")], "Position")


@query("P95_key_spine", "SupplierID:string PerformanceYear:int", """
    SELECT SupplierID, PerformanceYear FROM sy_spend UNION SELECT SupplierID, PerformanceYear FROM sy_items""")
def _(m):
    from spendline.operators import scorecard as C
    m = m.narrow
    return A.key_spine([C.spend_by_supplier_year(m["silver_po_spend"]), C.invoice_items_by_supplier_year(m["silver_invoice_matching"])], C.KEYS)


@query("P96_union_versions", "IsCurrentFlag:boolean n:long", "SELECT IsCurrentFlag, count(*) AS n FROM dim_supplier GROUP BY 1")
def _(m):
    d = m["dim_supplier"]
    return A.union_versions([d.where("IsCurrentFlag"), d.where("NOT IsCurrentFlag")]).groupBy("IsCurrentFlag").agg(F.count("*").alias("n"))


@query("P97_replace_rows", "o_orderstatus:string n:long", """
    SELECT CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, count(*) AS n FROM orders GROUP BY 1""")
def _(m):
    per = m.source.raw("orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    new = per.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("X"))
    return A.replace_rows(per, F.col("o_orderstatus") == "P", new)

