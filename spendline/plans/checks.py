"""Data-quality queries: rule sets over the mart's tables, with their SQL counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from spendline.functions.exprs import not_in_domain, surrogate_key
from spendline.operators import quality as QL
from spendline.operators.dims import OPEN_END
from spendline.operators.joins import dim_at
from spendline.operators.windows import overlaps
from spendline.plans import mart as MT
from spendline.plans.registry import query

COLUMNS = "TableName:string ValidationRule:string Severity:string FailedRecordCount:long ValidationStatus:string"
Rule, ERROR, WARNING = QL.Rule, QL.ERROR, QL.WARNING


def _sql(*parts: tuple[str, str, str, str]) -> str:
    """(table label, rule, severity, scalar count query) -> result rows."""
    rows = " UNION ALL ".join(f"SELECT '{t}' AS TableName, '{r}' AS ValidationRule, '{s}' AS Severity, CAST(({q}) AS BIGINT) AS FailedRecordCount" for t, r, s, q in parts)
    return f"""SELECT *, CASE WHEN FailedRecordCount = 0 THEN 'PASSED' WHEN Severity = 'WARNING' THEN 'WARNING' ELSE 'FAILED' END AS ValidationStatus FROM ({rows})"""


def _where(table: str, rules: dict[str, str], label: str, severity: str = ERROR) -> list[tuple[str, str, str, str]]:
    return [(label, r, severity, f"SELECT count(*) FILTER ({p}) FROM {table}") for r, p in rules.items()]


def _check(name: str, *sql: tuple[str, str, str, str]):
    return query(name, COLUMNS, _sql(*sql))


@_check("D01_rule_registry", *_where("po", {"spend not negative": "elig_c < 0"}, "silver_po_spend"),
        *_where("po", {"contract referenced": "ContractID IS NULL"}, "silver_po_spend", WARNING),
        *_where("po", {"fx resolved": "po_method = 'UNRESOLVED'"}, "silver_po_spend"))
def _(m):
    return QL.results([QL.row_rules(m["silver_po_spend"], "silver_po_spend", [
        Rule("spend not negative", F.col("EligibleSpendEUR") < 0), Rule("contract referenced", F.col("ContractID").isNull(), severity=WARNING),
        Rule("fx resolved", F.col("POFXResolutionMethod") == "UNRESOLVED")])])


def _header_checks(m):
    h = m["bronze_purchase_order_header"]
    return QL.results([QL.key_rule(h, "po_header", ["POID"]), QL.row_rules(h, "po_header", [Rule("total positive", F.col("TotalAmount") <= 0)])])


@query("D02_persisted_results", "ValidationID:string " + COLUMNS, _sql(
    ("po_header", "POID not null", ERROR, "SELECT 0"), ("po_header", "POID unique", ERROR, "SELECT count(*) - count(DISTINCT o_orderkey) FROM orders"),
    ("po_header", "total positive", ERROR, "SELECT count(*) FILTER (o_totalprice <= 0) FROM orders")).replace(
        "SELECT *, CASE", "SELECT *, 'VAL' || lpad(CAST(row_number() OVER (ORDER BY CASE ValidationRule WHEN 'total positive' THEN 0 ELSE 1 END, ValidationRule) AS VARCHAR), 5, '0') AS ValidationID, CASE", 1))
def _(m):
    from spendline.sources.tables import overwrite
    import uuid
    return overwrite(QL.numbered(_header_checks(m), "run"), f"{m.root}/validation-{uuid.uuid4().hex}")


@_check("D03_gate", ("po_header", "POID not null", ERROR, "SELECT 0"), ("po_header", "POID unique", ERROR, "SELECT 0"), ("po_header", "total positive", ERROR, "SELECT count(*) FILTER (o_totalprice <= 0) FROM orders"))
def _(m):
    return QL.gate(_header_checks(m))


@_check("D04_row_count", ("lineitem", "row count as expected", ERROR, "SELECT abs(count(*) - (SELECT count(*) FROM po)) FROM lineitem"))
def _(m):
    return QL.results([QL.row_count_rule(m.source.raw("lineitem"), "lineitem", m["silver_po_spend"])])


#: The thirteen source tables (masters and projects in their conformed form): key, further keys, required columns beside them, and their rows in SQL.
SOURCES = {
    "silver_category": (["CategoryID"], [["CategoryName"]], ["CommodityGroup", "ProcurementType"], "(SELECT CategoryID, CategoryName FROM c_category)"),
    "silver_business_unit": (["BusinessUnitID"], [], ["BusinessUnitName", "Country", "Region"], "(SELECT BusinessUnitID FROM c_bu)"),
    "silver_buyer": (["BuyerID"], [["Email"]], ["BuyerName", "BusinessUnitID"], "(SELECT BuyerID, Email FROM c_buyer)"),
    "silver_supplier": (["SupplierID"], [], ["SupplierName", "SupplierType", "Status"], "(SELECT SupplierID FROM c_supplier)"),
    "silver_material": (["MaterialID"], [], ["CategoryID", "StandardCost", "UnitOfMeasure"], "(SELECT MaterialID FROM c_material)"),
    "silver_exchange_rate": (["RateDate", "Currency"], [], ["ExchangeRateToEUR"], "(SELECT d AS RateDate, ccy AS Currency FROM fx)"),
    "silver_contract": (["ContractID"], [], ["SupplierID", "CategoryID", "ContractStartDate", "ContractEndDate", "Currency"], "(SELECT ContractID FROM c_contract)"),
    "bronze_purchase_order_header": (["POID"], [], ["SupplierID", "BuyerID", "OrderDate", "Currency", "POStatus"], "(SELECT 'PO' || o_orderkey AS POID FROM orders)"),
    "bronze_purchase_order_item": (["POItemID"], [["POID", "POLineNumber"]], ["MaterialID", "Quantity", "UnitPrice", "LineAmount"], "(SELECT POItemID, POID, rn AS POLineNumber FROM po_items)"),
    "bronze_goods_receipt": (["GoodsReceiptID"], [["POItemID", "ReceiptSequence"]], ["ReceiptDate", "QuantityReceived"], "(SELECT GoodsReceiptID, POItemID, ReceiptSequence FROM receipts)"),
    "bronze_invoice_header": (["InvoiceID"], [], ["InvoiceNumber", "SupplierID", "InvoiceDate", "TotalInvoiceAmount"], "(SELECT InvoiceID FROM invoices)"),
    "bronze_invoice_item": (["InvoiceItemID"], [["InvoiceID", "InvoiceLineNumber"]], ["POItemID", "InvoicedQuantity", "GrossAmount"], "(SELECT InvoiceItemID, InvoiceID, rn AS InvoiceLineNumber FROM invoice_items)"),
    "silver_savings_project": (["SavingsProjectID"], [], ["ProjectStatus", "SavingsLevel", "Currency", "ForecastedSavings"], "(SELECT SavingsProjectID FROM savings)")}
AUDITED = {"silver_category": "c_category", "silver_business_unit": "c_bu", "silver_buyer": "c_buyer", "silver_supplier": "c_supplier", "silver_material": "c_material", "silver_exchange_rate": "fx",
           "silver_contract": "c_contract", "silver_po_spend": "po", "silver_invoice_matching": "inv", "silver_savings_project": "savings", "silver_supplier_performance": "score"}


def _columns(t: str) -> list[str]:
    keys, alternate, required, _ = SOURCES[t]
    return list(dict.fromkeys([*keys, *(c for k in alternate for c in k), *required]))


def key_sql(t: str) -> list[tuple[str, str, str, str]]:
    """Rows of both key rules of a table; repeats counted in the source tables."""
    keys, alternate, _, rows = SOURCES[t]
    out = []
    for k in (keys, *alternate):
        name = ", ".join(k)
        out += [(t, f"{name} not null", ERROR, f"SELECT count(*) FILTER ({' OR '.join(f'{c} IS NULL' for c in k)}) FROM {rows}"), (t, f"{name} unique", ERROR, f"SELECT count(*) - count(DISTINCT ({name})) FROM {rows}")]
    return out


@_check("D05_columns", ("bronze_purchase_order_header without LoadDate", "required columns present", ERROR, "SELECT 1"), ("bronze_purchase_order_header without LoadDate", "at least one row", ERROR, "SELECT CAST(count(*) = 0 AS INT) FROM orders"),
        *[(t, r, ERROR, f"SELECT CAST({n} AS INT) FROM {v[3]}") for t, v in SOURCES.items() for r, n in (("required columns present", "count(*) < 0"), ("at least one row", "count(*) = 0"))],
        *[(t, r, ERROR, f"SELECT CAST({n} AS INT) FROM {v}") for t, v in AUDITED.items() for r, n in (("required columns present", "count(*) < 0"), ("at least one row", "count(*) = 0"))])
def _(m):
    m = m.narrow
    return QL.results([QL.schema_rule(m["bronze_purchase_order_header"], "bronze_purchase_order_header without LoadDate", ["POID", "SupplierID", "LoadDate"]),
                       *[QL.schema_rule(m[t], t, _columns(t)) for t in SOURCES],
                       *[QL.schema_rule(m[t], t, ["SilverLoadTimestamp", "SilverLoadDate", "SilverRecordHash"]) for t in AUDITED]])


@_check("D06_keys", *[r for t in SOURCES for r in key_sql(t)],
        ("lineitem", "l_orderkey, l_linenumber not null", WARNING, "SELECT 0"),
        ("lineitem", "l_orderkey, l_linenumber unique", WARNING, "SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem"))
def _(m):
    return QL.results([*[QL.key_rule(m[t], t, k) for t, (keys, alternate, _, _rows) in SOURCES.items() for k in (keys, *alternate)],
                       QL.key_rule(m.source.raw("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"], WARNING)])


def audit_rules(df, table: str):
    return QL.row_rules(df, table, [
        Rule("lineage complete", F.col("SilverLoadTimestamp").isNull() | F.col("SilverLoadDate").isNull() | F.col("SilverRecordHash").isNull(), "Audit"),
        Rule("record hash has 64 characters", F.length("SilverRecordHash") != 64, "Audit")])


@_check("D07_audit", *[(t, r, ERROR, f"SELECT count(*) FILTER (FALSE) FROM {v}") for t, v in AUDITED.items() for r in ("lineage complete", "record hash has 64 characters")])
def _(m):
    return QL.results([audit_rules(m[t], t) for t in AUDITED])


# child table: (its key, parent table, the parent's key, nullable), ...
EDGES = {
    "silver_buyer": [("BusinessUnitID", "silver_business_unit", "BusinessUnitID", False)],
    "bronze_purchase_order_header": [("SupplierID", "silver_supplier", "SupplierID", False), ("BuyerID", "silver_buyer", "BuyerID", False),
                                     ("BusinessUnitID", "silver_business_unit", "BusinessUnitID", False)],
    "bronze_purchase_order_item": [("POID", "bronze_purchase_order_header", "POID", False), ("MaterialID", "silver_material", "MaterialID", False),
                                   ("CategoryID", "silver_category", "CategoryID", False), ("ContractID", "silver_contract", "ContractID", True)],
    "bronze_goods_receipt": [("POItemID", "bronze_purchase_order_item", "POItemID", False), ("SupplierID", "silver_supplier", "SupplierID", False), ("POID", "bronze_purchase_order_header", "POID", False),
                             ("MaterialID", "silver_material", "MaterialID", False), ("BusinessUnitID", "silver_business_unit", "BusinessUnitID", False)],
    "bronze_invoice_header": [("POID", "bronze_purchase_order_header", "POID", False), ("SupplierID", "silver_supplier", "SupplierID", False),
                              ("BusinessUnitID", "silver_business_unit", "BusinessUnitID", False)],
    "bronze_invoice_item": [("InvoiceID", "bronze_invoice_header", "InvoiceID", False), ("POItemID", "bronze_purchase_order_item", "POItemID", False), ("POID", "bronze_purchase_order_header", "POID", False),
                            ("MaterialID", "silver_material", "MaterialID", False), ("CategoryID", "silver_category", "CategoryID", False), ("ContractID", "silver_contract", "ContractID", True)],
    "silver_contract": [("SupplierID", "silver_supplier", "SupplierID", False), ("CategoryID", "silver_category", "CategoryID", False), ("ContractOwnerBuyerID", "silver_buyer", "BuyerID", False)],
    "silver_material": [("CategoryID", "silver_category", "CategoryID", False)],
    "silver_savings_project": [("SupplierID", "silver_supplier", "SupplierID", False), ("CategoryID", "silver_category", "CategoryID", False), ("BuyerID", "silver_buyer", "BuyerID", False),
                               ("BusinessUnitID", "silver_business_unit", "BusinessUnitID", False), ("ContractID", "silver_contract", "ContractID", True)]}
#: What the two broken kinds of reference of the source are, as a condition on SEEDED rows of the child.
BROKEN = {("bronze_purchase_order_item", "ContractID"): "ContractID IS NOT NULL AND ContractID NOT IN (SELECT ContractID FROM c_contract)",
          ("bronze_invoice_item", "POItemID"): "POItemID NOT IN (SELECT POItemID FROM po_items)"}
CURRENCY_TABLES = ["bronze_purchase_order_header", "bronze_purchase_order_item", "bronze_invoice_header", "bronze_invoice_item", "silver_contract", "silver_savings_project"]
#: Child tables in SQL: (key, rows with the key and the columns of broken references).
SEEDED = {
    "silver_buyer": ("BuyerID", "(SELECT BuyerID FROM c_buyer)"),
    "bronze_purchase_order_header": ("POID", "(SELECT 'PO' || o_orderkey AS POID FROM orders)"),
    "bronze_purchase_order_item": ("POItemID", "(SELECT POItemID, ContractID FROM po_items)"),
    "bronze_goods_receipt": ("GoodsReceiptID", "(SELECT GoodsReceiptID FROM receipts)"),
    "bronze_invoice_header": ("InvoiceID", "(SELECT InvoiceID FROM invoices)"),
    "bronze_invoice_item": ("InvoiceItemID", "(SELECT InvoiceItemID, POItemID FROM invoice_items)"),
    "silver_contract": ("ContractID", "(SELECT ContractID FROM c_contract)"),
    "silver_material": ("MaterialID", "(SELECT MaterialID FROM c_material)"),
    "silver_savings_project": ("SavingsProjectID", "(SELECT SavingsProjectID FROM savings)")}


def edges_of(m, child: str) -> list[QL.Reference]:
    return [QL.Reference((k,), m[p], (pk,), p, nullable) for k, p, pk, nullable in EDGES[child]]


_EDGE_SQL = [(c, f"{k} in {p}", ERROR, f"SELECT count(*) FROM {SEEDED[c][1]} WHERE {BROKEN[c, k]}" if (c, k) in BROKEN else "SELECT 0") for c, edges in EDGES.items() for k, p, _, _n in edges]


@_check("D08_foreign_keys", *_EDGE_SQL)
def _(m):
    return QL.results([QL.reference_rules(m[c], c, edges_of(m, c)) for c in EDGES])


@_check("D09_currency", *[(t, "Currency in silver_exchange_rate", ERROR, "SELECT 0") for t in CURRENCY_TABLES])
def _(m):
    known = m["silver_exchange_rate"].select("Currency").distinct()
    return QL.results([QL.reference_rules(m[t], t, [QL.Reference(("Currency",), known, ("Currency",), "silver_exchange_rate")]) for t in CURRENCY_TABLES])


@_check("D10_header_totals",
        ("po_header", "total equals sum of lines", WARNING, """SELECT count(*) FROM (SELECT CAST(round(o_totalprice * 100) AS BIGINT) AS t, coalesce(s, 0) AS s FROM orders
            LEFT JOIN (SELECT l_orderkey, sum(amt) AS s FROM lines GROUP BY 1) ON l_orderkey = o_orderkey) WHERE abs(t / 100.0::DOUBLE - s / 100.0::DOUBLE) > 0.05"""),
        ("invoice_header", "total equals sum of lines", WARNING, """SELECT count(*) FROM (SELECT h.total_c AS t, coalesce(s, 0) AS s FROM invoices h
            LEFT JOIN (SELECT InvoiceID, sum(grossc) AS s FROM invoice_items GROUP BY 1) i ON i.InvoiceID = h.InvoiceID) WHERE abs(t / 100.0::DOUBLE - s / 100.0::DOUBLE) > 0.05"""))
def _(m):
    name = "total equals sum of lines"
    return QL.results([
        QL.count_rule(QL.header_total_gap(m["bronze_purchase_order_header"], m["bronze_purchase_order_item"], "POID", "TotalAmount", "LineAmount", 0.05), "po_header", name, severity=WARNING),
        QL.count_rule(QL.header_total_gap(m["bronze_invoice_header"], m["bronze_invoice_item"], "InvoiceID", "TotalInvoiceAmount", "GrossAmount", 0.05), "invoice_header", name, severity=WARNING)])


@_check("D11_agreement", ("po_item", "currency agrees with header", ERROR, "SELECT 0"), ("po_item", "category agrees with material", ERROR, "SELECT 0"),
        ("goods_receipt", "agrees with order item", ERROR, "SELECT 0"),
        ("invoice_header", "supplier agrees with order", ERROR, "SELECT count(*) FROM invoices h JOIN orders o ON h.POID = 'PO' || o_orderkey WHERE h.InvoiceSupplierID <> 'S' || (o_custkey // 15)"),
        ("invoice_item", "agrees with order item", ERROR, "SELECT 0"),
        ("savings_project", "business unit agrees with buyer", WARNING, "SELECT count(*) FROM savings s JOIN c_buyer b ON s.BuyerID = b.BuyerID WHERE s.BusinessUnitID <> b.BusinessUnitID"),
        ("savings_project", "category agrees with contract", WARNING, "SELECT count(*) FROM savings s JOIN c_contract c ON s.ContractID = c.ContractID WHERE s.CategoryID <> c.CategoryID"))
def _(m):
    head, item = m["bronze_purchase_order_header"], m["bronze_purchase_order_item"]
    rule = lambda a, b, key, cols, table, name, sev=ERROR: QL.count_rule(QL.disagreements(a, b, key, cols), table, name, "Agreement", sev)
    sav = m["silver_savings_project"]
    return QL.results([
        rule(item, head, "POID", {"Currency": "Currency"}, "po_item", "currency agrees with header"),
        rule(item, m["silver_material"], "MaterialID", {"CategoryID": "CategoryID"}, "po_item", "category agrees with material"),
        rule(m["bronze_goods_receipt"], item, "POItemID", {"POID": "POID", "MaterialID": "MaterialID"}, "goods_receipt", "agrees with order item"),
        rule(m["bronze_invoice_header"], head, "POID", {"SupplierID": "SupplierID"}, "invoice_header", "supplier agrees with order"),
        rule(m["bronze_invoice_item"], item, "POItemID", {"POID": "POID", "MaterialID": "MaterialID", "CategoryID": "CategoryID"}, "invoice_item", "agrees with order item"),
        rule(sav, m["silver_buyer"], "BuyerID", {"BusinessUnitID": "BusinessUnitID"}, "savings_project", "business unit agrees with buyer", WARNING),
        rule(sav, m["silver_contract"], "ContractID", {"CategoryID": "CategoryID"}, "savings_project", "category agrees with contract", WARNING)])


@_check("D12_scenario", *_where("po", {"compliant scenario is valid": "SimulationContractScenario = 'COMPLIANT_CONTRACT' AND NOT ValidContractAtPOFlag",
                                       "no reference scenario has none": "SimulationContractScenario = 'NO_CONTRACT_REFERENCE' AND ContractID IS NOT NULL",
                                       "invalid scenario is invalid": "SimulationContractScenario = 'INVALID_DATE_CONTRACT' AND ValidContractAtPOFlag"}, "silver_po_spend", WARNING))
def _(m):
    s, valid = F.col("SimulationContractScenario"), F.col("ValidContractAtPOFlag")
    return QL.results([QL.row_rules(m["silver_po_spend"], "silver_po_spend", [
        Rule("compliant scenario is valid", (s == "COMPLIANT_CONTRACT") & ~valid, severity=WARNING),
        Rule("no reference scenario has none", (s == "NO_CONTRACT_REFERENCE") & F.col("ContractID").isNotNull(), severity=WARNING),
        Rule("invalid scenario is invalid", (s == "INVALID_DATE_CONTRACT") & valid, severity=WARNING)])])


@_check("D13_receipt_status", ("goods_receipt", "cancelled items have no receipts", ERROR, "SELECT 0"),
        ("po_item", "fully received items received in full", WARNING, """SELECT count(*) FROM po_items p LEFT JOIN (SELECT POItemID, sum(qty_m) AS s FROM receipts GROUP BY 1) r
            ON r.POItemID = p.POItemID WHERE POItemStatus = 'Fully Received' AND coalesce(s, 0) < q * 1000"""),
        ("po_item", "open items not received in full", WARNING, """SELECT count(*) FROM po_items p LEFT JOIN (SELECT POItemID, sum(qty_m) AS s FROM receipts GROUP BY 1) r
            ON r.POItemID = p.POItemID WHERE POItemStatus = 'Open' AND coalesce(s, 0) >= q * 1000"""))
def _(m):
    item, rec = m["bronze_purchase_order_item"], m["bronze_goods_receipt"]
    gone = rec.join(item.where("POItemStatus = 'Cancelled'").select("POItemID"), "POItemID", "left_semi")
    got = item.join(rec.groupBy("POItemID").agg(F.sum("QuantityReceived").alias("got")), "POItemID", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    s, full = F.col("POItemStatus"), F.col("got") >= F.col("Quantity")
    return QL.results([QL.count_rule(gone, "goods_receipt", "cancelled items have no receipts"), QL.row_rules(got, "po_item", [
        Rule("fully received items received in full", (s == "Fully Received") & ~full, severity=WARNING),
        Rule("open items not received in full", (s == "Open") & full, severity=WARNING)])])


@_check("D14_arithmetic", *[("invoice_item", r, ERROR, "SELECT 0") for r in ("net = quantity x price", "tax = net x rate", "gross = net + tax")],
        ("po_item", "amount = quantity x price", ERROR, "SELECT count(*) FROM lines WHERE abs(CAST(amt AS DOUBLE) / 100.0 - CAST(CAST(q AS HUGEINT) * pu AS DOUBLE) / 10000.0) > 0.05"))
def _(m):
    prod = lambda a, b: F.col(a) * F.col(b)
    return QL.results([QL.row_rules(m["bronze_invoice_item"], "invoice_item", [
        Rule("net = quantity x price", QL.differ_rows("NetAmount", prod("InvoicedQuantity", "InvoiceUnitPrice"), 0.01)),
        Rule("tax = net x rate", QL.differ_rows("TaxAmount", prod("NetAmount", "TaxRate"), 0.01)),
        Rule("gross = net + tax", QL.differ_rows("GrossAmount", F.col("NetAmount") + F.col("TaxAmount"), 0.001))]),
        QL.row_rules(m["bronze_purchase_order_item"], "po_item", [Rule("amount = quantity x price", QL.differ_rows("LineAmount", prod("Quantity", "UnitPrice"), 0.05))])])


@_check("D15_flag_reason", ("invoice_header", "disputed invoices have a reason", ERROR, "SELECT 0"), ("invoice_header", "only disputed invoices have a reason", ERROR, "SELECT 0"),
        ("invoice_item", "duplicate lines are labelled", ERROR, "SELECT 0"))
def _(m):
    bad, why = F.col("DisputeFlag"), F.col("DisputeReason")
    return QL.results([QL.row_rules(m["bronze_invoice_header"], "invoice_header", [
        Rule("disputed invoices have a reason", bad & why.isNull()), Rule("only disputed invoices have a reason", ~bad & why.isNotNull())]),
        QL.row_rules(m["bronze_invoice_item"], "invoice_item", [Rule("duplicate lines are labelled", F.col("DuplicateInvoiceLineFlag") != (F.col("ThreeWayMatchStatus") == "DUPLICATE_INVOICE"))])])


@_check("D16_duplicates", ("invoice_header", "only duplicates name an original", ERROR, "SELECT 0"), ("invoice_header", "duplicate equals its original", ERROR, "SELECT 0"),
        ("invoice_item", "duplicate line equals its original", ERROR, "SELECT 0"), ("invoice_header", "one original per invoice number", ERROR, "SELECT 0"),
        ("invoice_header", "invoice numbers are used once", WARNING, "SELECT count(*) FROM (SELECT InvoiceNumber FROM invoices GROUP BY 1 HAVING count(*) > 1)"))
def _(m):
    from spendline.operators.joins import duplicates, pair_with_original
    head, item = m["bronze_invoice_header"], m["bronze_invoice_item"]
    unequal = lambda df, id_, orig, cols: (lambda p: p.where(~F.col("OriginalFoundFlag") | QL.reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"Original{c}")) for c in cols])))(
        pair_with_original(df, id_, orig, cols))
    originals = head.where("NOT DuplicateInvoiceFlag")
    return QL.results([
        QL.row_rules(head, "invoice_header", [Rule("only duplicates name an original", F.col("DuplicateInvoiceFlag") != F.col("OriginalInvoiceID").isNotNull())]),
        QL.count_rule(unequal(head, "InvoiceID", "OriginalInvoiceID", ["SupplierID", "POID", "Currency", "TotalInvoiceAmount"]), "invoice_header", "duplicate equals its original"),
        QL.count_rule(unequal(item, "InvoiceItemID", "OriginalInvoiceItemID", ["POItemID", "InvoicedQuantity", "GrossAmount"]), "invoice_item", "duplicate line equals its original"),
        QL.count_rule(duplicates(originals, ["InvoiceNumber"]), "invoice_header", "one original per invoice number"),
        QL.count_rule(duplicates(head, ["InvoiceNumber"]), "invoice_header", "invoice numbers are used once", severity=WARNING)])


@_check("D17_dates_amounts", *_where("invoices", {"posted on or after invoice": "PostingDate < InvoiceDate", "due on or after invoice": "DueDate < InvoiceDate"}, "invoice_header"),
        *_where("savings", {"planned start before completion": "PlannedCompletionDate < PlannedStartDate", "amounts not negative": "base_c < 0 OR fore_c < 0 OR appr_c < 0 OR real_c < 0",
                            "completion only when implemented": "(ActualCompletionDate IS NOT NULL) <> (ProjectStatus = 'Implemented')",
                            "cancellation only when cancelled": "(CancellationDate IS NOT NULL) <> (ProjectStatus = 'Cancelled')",
                            "realised only when implemented": "real_c > 0 AND ProjectStatus <> 'Implemented'"}, "savings_project"),
        *_where("savings", {"level L3 only when implemented": "SavingsLevel = 'L3' AND ProjectStatus <> 'Implemented'", "cancelled projects are rejected": "ProjectStatus = 'Cancelled' AND ApprovalStatus <> 'Rejected'"}, "savings_project", WARNING))
def _(m):
    s, c = F.col("ProjectStatus"), F.col
    return QL.results([QL.row_rules(m["bronze_invoice_header"], "invoice_header", [
        Rule("posted on or after invoice", c("PostingDate") < c("InvoiceDate")), Rule("due on or after invoice", c("DueDate") < c("InvoiceDate"))]),
        QL.row_rules(m["silver_savings_project"], "savings_project", [
            Rule("planned start before completion", c("PlannedCompletionDate") < c("PlannedStartDate")),
            Rule("amounts not negative", F.least("BaselineSpend", "ForecastedSavings", "ApprovedSavings", "RealizedSavings") < 0),
            Rule("completion only when implemented", c("ActualCompletionDate").isNotNull() != (s == "Implemented")),
            Rule("cancellation only when cancelled", c("CancellationDate").isNotNull() != (s == "Cancelled")),
            Rule("realised only when implemented", (c("RealizedSavings") > 0) & (s != "Implemented")),
            Rule("level L3 only when implemented", (c("SavingsLevel") == "L3") & (s != "Implemented"), severity=WARNING),
            Rule("cancelled projects are rejected", (s == "Cancelled") & (c("ApprovalStatus") != "Rejected"), severity=WARNING)])])


@_check("D18_domains", ("silver_supplier", "SupplierType in domain", ERROR, "SELECT 0"), ("silver_supplier", "ESGRating in domain", WARNING, "SELECT count(*) FROM c_supplier WHERE ESGRating IS NULL"),
        ("silver_category", "ProcurementType in domain", ERROR, "SELECT 0"), ("silver_buyer", "BuyerRole in domain", ERROR, "SELECT 0"),
        ("po_item", "POItemStatus in domain", ERROR, "SELECT 0"), ("po_item", "quantity and price positive", ERROR, "SELECT count(*) FILTER (q <= 0 OR pu <= 0) FROM lines"),
        ("events", "event_type in domain", ERROR, "SELECT count(*) FROM events WHERE event_type NOT IN ('view', 'click', 'purchase', 'signup')"))
def _(m):
    from spendline.operators.conform import master_specs
    specs = master_specs()
    dom = lambda t, c, values, sev=ERROR: QL.row_rules(m[f"silver_{t}"], f"silver_{t}", [Rule(f"{c} in domain", not_in_domain(c, values), "Domain", sev)])
    return QL.results([
        dom("supplier", "SupplierType", specs["supplier"].labels["SupplierType"]), dom("supplier", "ESGRating", ["A", "B", "C"], WARNING),
        dom("category", "ProcurementType", specs["category"].labels["ProcurementType"]), dom("buyer", "BuyerRole", specs["buyer"].labels["BuyerRole"]),
        QL.row_rules(m["bronze_purchase_order_item"], "po_item", [
            Rule("POItemStatus in domain", not_in_domain("POItemStatus", ["Open", "Partially Received", "Fully Received", "Closed", "Cancelled"]), "Domain"),
            Rule("quantity and price positive", (F.col("Quantity") <= 0) | (F.col("UnitPrice") <= 0), "Domain")]),
        QL.row_rules(m.source.raw("events"), "events", [Rule("event_type in domain", not_in_domain("event_type", ["view", "click", "purchase", "signup"]), "Domain")])])


@_check("D19_fx_coverage", ("silver_exchange_rate", "eight currencies", ERROR, "SELECT abs(count(DISTINCT ccy) - 8) FROM fx"), ("silver_exchange_rate", "EUR rate is one", ERROR, "SELECT count(*) FROM fx WHERE ccy = 'EUR' AND ru <> 1000000"),
        ("silver_exchange_rate", "one rate per day and currency", ERROR, "SELECT sum(hi - lo + 1 - days) FROM fx_ends"))
def _(m):
    rates = m["silver_exchange_rate"]
    per = rates.groupBy("Currency").agg((F.datediff(F.max("RateDate"), F.min("RateDate")) + 1 - F.countDistinct("RateDate")).alias("gap"))
    return QL.results([QL.agg_rules(rates, "silver_exchange_rate", {"eight currencies": F.abs(F.countDistinct("Currency") - 8),
                                                                    "EUR rate is one": F.count_if((F.col("Currency") == "EUR") & (F.col("ExchangeRateToEUR") != 1))}),
                       QL.agg_rules(per, "silver_exchange_rate", {"one rate per day and currency": F.sum("gap")})])


@query("D20_summary", "TableName:string RuleCount:long PassedRules:long WarningRules:long FailedRules:long FailedRecordCount:long", f"""
    SELECT TableName, count(*) AS RuleCount, count(*) FILTER (ValidationStatus = 'PASSED') AS PassedRules, count(*) FILTER (ValidationStatus = 'WARNING') AS WarningRules,
      count(*) FILTER (ValidationStatus = 'FAILED') AS FailedRules, sum(FailedRecordCount) AS FailedRecordCount FROM (
    {_sql(*_EDGE_SQL)}) GROUP BY 1""")
def _(m):
    return QL.summary(QL.results([QL.reference_rules(m[c], c, edges_of(m, c)) for c in EDGES]), ["TableName"])


@query("D20_status", "ValidationStatus:string RuleCount:long TableCount:long FailedRecordCount:long", f"""
    SELECT ValidationStatus, count(*) AS RuleCount, count(DISTINCT TableName) AS TableCount, sum(FailedRecordCount) AS FailedRecordCount FROM ({_sql(*_EDGE_SQL)}) GROUP BY 1""")
def _(m):
    out = QL.results([QL.reference_rules(m[c], c, edges_of(m, c)) for c in EDGES])
    return out.groupBy("ValidationStatus").agg(F.count("*").alias("RuleCount"), F.countDistinct("TableName").alias("TableCount"), F.sum("FailedRecordCount").alias("FailedRecordCount"))


@_check("D21_rows_preserved", ("silver_po_spend", "bronze rows preserved", ERROR, "SELECT 0"), ("fact_purchase_order", "silver rows preserved", ERROR, "SELECT 0"),
        ("fact_invoice", "silver rows preserved", ERROR, "SELECT 0"), ("fact_savings", "silver rows preserved", ERROR, "SELECT (SELECT count(*) FROM fact_sav) - count(*) FROM customer"),
        ("silver_supplier", "bronze rows preserved", ERROR, "SELECT (SELECT count(*) FROM b_supplier) - count(*) FROM c_supplier"))
def _(m):
    pairs = [("silver_po_spend", "bronze_purchase_order_item", "bronze"), ("fact_purchase_order", "silver_po_spend", "silver"), ("fact_invoice", "silver_invoice_matching", "silver"),
             ("fact_savings", "silver_savings_project", "silver"), ("silver_supplier", "bronze_supplier", "bronze")]
    m = m.planned
    return QL.results([QL.row_count_rule(m[a], a, m[b], f"{layer} rows preserved") for a, b, layer in pairs])


@_check("D22_contract", *_where("contract", {"end on or after start": "ContractEndDate < ContractStartDate", "value and price positive": "value_c <= 0 OR price_u <= 0", "fx resolved": "ct_method = 'UNRESOLVED'",
                                             "active flag agrees with lifecycle": "IsContractActiveAsOfDate <> (ContractLifecycleStatus = 'Active')"}, "silver_contract"),
        *_where("contract", {"source status agrees with lifecycle": "SourceContractStatus <> ContractLifecycleStatus"}, "silver_contract", WARNING),
        *_where("contract", {"payment terms usual": "PaymentTermsDays NOT IN (30, 45, 60)"}, "silver_contract"), ("silver_contract", "EUR value recomputes", ERROR, "SELECT 0"),
        ("silver_contract", "owner, supplier and category resolved", ERROR, "SELECT 0"))
def _(m):
    c = F.col
    return QL.results([QL.row_rules(m["silver_contract"], "silver_contract", [
        Rule("end on or after start", ~c("ContractValidityWindowFlag")), Rule("value and price positive", (c("ContractValue") <= 0) | (c("NegotiatedUnitPrice") <= 0)),
        Rule("fx resolved", c("ContractFXResolutionMethod") == "UNRESOLVED"), Rule("active flag agrees with lifecycle", c("IsContractActiveAsOfDate") != (c("ContractLifecycleStatus") == "Active")),
        Rule("source status agrees with lifecycle", ~c("ContractStatusConsistencyFlag"), severity=WARNING), Rule("payment terms usual", ~c("PaymentTermsDays").isin(30, 45, 60)),
        Rule("EUR value recomputes", QL.differ_rows("ContractValueEUR", c("ContractValue") * c("ExchangeRateToEURAtContractStart"), 0.02)),
        Rule("owner, supplier and category resolved", c("ContractOwnerName").isNull() | c("SupplierName").isNull() | c("CategoryName").isNull())])])


@_check("D23_po_spend", *_where("po", {"fx resolved": "po_method = 'UNRESOLVED'", "eligible is compliant or maverick": "SpendEligibilityFlag AND (ContractComplianceFlag = MaverickSpendFlag)",
                                       "ineligible has no spend": "NOT SpendEligibilityFlag AND (elig_c <> 0 OR comp_c <> 0 OR mav_c <> 0)", "variance only on valid contracts": "ContractPriceVariancePercentage IS NOT NULL AND NOT ValidContractAtPOFlag"}, "silver_po_spend"),
        ("silver_po_spend", "EUR amount recomputes", ERROR, "SELECT 0"), ("silver_po_spend", "eligible = compliant + maverick", ERROR, "SELECT CAST(abs(sum(elig_c) - sum(comp_c) - sum(mav_c)) > 5 AS INT) FROM po"))
def _(m):
    c, po = F.col, m["silver_po_spend"]
    return QL.results([QL.row_rules(po, "silver_po_spend", [
        Rule("fx resolved", c("POFXResolutionMethod") == "UNRESOLVED"), Rule("eligible is compliant or maverick", c("SpendEligibilityFlag") & (c("ContractComplianceFlag") == c("MaverickSpendFlag"))),
        Rule("ineligible has no spend", ~c("SpendEligibilityFlag") & (F.greatest("EligibleSpendEUR", "ContractCompliantSpendEUR", "MaverickSpendEUR") != 0)),
        Rule("variance only on valid contracts", c("ContractPriceVariancePercentage").isNotNull() & ~c("ValidContractAtPOFlag")),
        Rule("EUR amount recomputes", QL.differ_rows("LineAmountEUR", c("LineAmount") * c("POExchangeRateToEUR"), 0.02))]),
        QL.agg_rules(po, "silver_po_spend", {"eligible = compliant + maverick": F.when(F.abs(F.sum("EligibleSpendEUR") - F.sum("ContractCompliantSpendEUR") - F.sum("MaverickSpendEUR")) > 0.05, 1).otherwise(0)})])


@_check("D24_invoice", *_where("inv", {"order reference found": "NOT POReferenceResolvedFlag", "order supplier agrees": "NOT InvoicePOSupplierMatchFlag", "matched implies within tolerance": "ThreeWayMatchFlag AND (abs(price_pct) > 3 OR abs(qty_pct) > 2)",
                                       "duplicates never match": "DerivedDuplicateInvoiceFlag AND ThreeWayMatchFlag", "matched or exception": "ThreeWayMatchFlag = InvoiceExceptionFlag"}, "silver_invoice_matching"),
        *_where("inv", {"source status agrees": "CASE WHEN dup THEN 'DUPLICATE_INVOICE' ELSE 'MATCHED' END <> DerivedThreeWayMatchStatus", "source receipt quantity agrees": "abs(q * 1000 - received_m) > 1"}, "silver_invoice_matching", WARNING),
        ("silver_invoice_matching", "status in domain", ERROR, "SELECT 0"))
def _(m):
    c = F.col
    statuses = ["MATCHED", "PRICE_VARIANCE", "QUANTITY_VARIANCE", "PRICE_AND_QUANTITY_VARIANCE", "MISSING_GOODS_RECEIPT", "DUPLICATE_INVOICE", "PO_REFERENCE_NOT_FOUND"]
    return QL.results([QL.row_rules(m["silver_invoice_matching"], "silver_invoice_matching", [
        Rule("order reference found", ~c("POReferenceResolvedFlag")), Rule("order supplier agrees", ~c("InvoicePOSupplierMatchFlag")),
        Rule("matched implies within tolerance", c("ThreeWayMatchFlag") & (~F.coalesce("InvoicePriceWithinToleranceFlag", F.lit(True)) | ~F.coalesce("InvoiceQuantityWithinToleranceFlag", F.lit(True)))),
        Rule("duplicates never match", c("DerivedDuplicateInvoiceFlag") & c("ThreeWayMatchFlag")), Rule("matched or exception", c("ThreeWayMatchFlag") == c("InvoiceExceptionFlag")),
        Rule("source status agrees", ~c("ThreeWayMatchSourceConsistencyFlag"), severity=WARNING), Rule("source receipt quantity agrees", ~c("ReceiptQuantitySourceConsistencyFlag"), severity=WARNING),
        Rule("status in domain", not_in_domain("DerivedThreeWayMatchStatus", statuses), "Domain")])])


@_check("D25_scorecard", *[("silver_supplier_performance", r, ERROR, "SELECT 0") for r in (
    "due = complete + overdue", "complete = on time + late", "invoices split into disputed and free", "items split into matched and exceptions", "percentages within 0 and 100",
    "compliance and maverick add to 100", "match and exception add to 100")], ("silver_supplier_performance", "supplier known", ERROR, "SELECT count(*) FROM score WHERE SupplierID IS NULL"))
def _(m):
    c, sc = F.col, m["silver_supplier_performance"]
    pcts = [x for x in sc.columns if x.endswith("Pct")]
    return QL.results([QL.row_rules(sc, "silver_supplier_performance", [
        Rule("due = complete + overdue", c("DuePOItemCount") != c("DeliveryCompletePOItemCount") + c("OverdueOpenPOItemCount")),
        Rule("complete = on time + late", c("DeliveryCompletePOItemCount") != c("OnTimeDeliveryPOItemCount") + c("LateDeliveryPOItemCount")),
        Rule("invoices split into disputed and free", c("InvoiceCount") != c("DisputedInvoiceCount") + c("DisputeFreeInvoiceCount")),
        Rule("items split into matched and exceptions", c("InvoiceItemCount") != c("MatchedInvoiceItemCount") + c("InvoiceExceptionItemCount")),
        Rule("percentages within 0 and 100", (F.least(*pcts) < 0) | (F.greatest(*pcts) > 100)),
        Rule("compliance and maverick add to 100", F.abs(c("ContractCompliancePct") + c("MaverickSpendPct") - 100) > 0.05),
        Rule("match and exception add to 100", F.abs(c("ThreeWayMatchPct") + c("InvoiceExceptionPct") - 100) > 0.05), Rule("supplier known", c("SupplierID").isNull())])])


@_check("D26_savings", *[("silver_savings_project", r, ERROR, "SELECT 0") for r in ("status in domain", "level has its weight", "weighted forecast recomputes", "exactly one status flag")],
        *_where("savings", {"fx resolved": "sav_method = 'UNRESOLVED'"}, "silver_savings_project"))
def _(m):
    from spendline.operators.savings import CONFIDENCE, STATUSES
    c = F.col
    one = sum((c(f"Is{s}Flag").cast("int") for s in STATUSES), F.lit(0))
    return QL.results([QL.row_rules(m["silver_savings_project"], "silver_savings_project", [
        Rule("status in domain", not_in_domain("ProjectStatus", STATUSES), "Domain"), Rule("level has its weight", not_in_domain("SavingsLevel", CONFIDENCE) | c("SavingsConfidenceWeight").isNull()),
        Rule("weighted forecast recomputes", QL.differ_rows("WeightedForecastSavings", c("ForecastedSavings") * c("SavingsConfidenceWeight"), 0.01)), Rule("exactly one status flag", one != 1),
        Rule("fx resolved", c("SavingsFXResolutionMethod") == "UNRESOLVED")])])


@_check("D27_scd2", ("dim_supplier", "SupplierKey not null", ERROR, "SELECT 0"), ("dim_supplier", "SupplierKey unique", ERROR, "SELECT 0"), ("dim_supplier", "valid range", ERROR, "SELECT 0"), ("dim_supplier", "current versions are open", ERROR, "SELECT 0"),
        ("dim_supplier", "one current version", ERROR, "SELECT 0"), ("dim_supplier", "versions do not overlap", ERROR, "SELECT 0"), ("fact_purchase_order", "supplier version resolved", ERROR, "SELECT count(*) FROM fact_po WHERE NOT supplier_ok"))
def _(m):
    d, c = m["dim_supplier"], F.col
    current = d.where("IsCurrentFlag").groupBy("SupplierID").agg(F.count("*").alias("n")).where("n > 1")
    return QL.results([QL.key_rule(d, "dim_supplier", ["SupplierKey"]), QL.row_rules(d, "dim_supplier", [
        Rule("valid range", c("EffectiveToDate") < c("EffectiveFromDate")), Rule("current versions are open", c("IsCurrentFlag") != (c("EffectiveToDate") == F.to_date(F.lit(OPEN_END))))]),
        QL.count_rule(current, "dim_supplier", "one current version"), QL.count_rule(overlaps(d, "SupplierID", "EffectiveFromDate", "EffectiveToDate"), "dim_supplier", "versions do not overlap"),
        QL.row_rules(m.narrow["fact_purchase_order"], "fact_purchase_order", [Rule("supplier version resolved", c("SupplierKey").isNull())])])


@_check("D28_facts", *[("fact_purchase_order", r, ERROR, "SELECT 0") for r in ("mandatory keys present", "contract key where contract known", "date key equals date", "ineligible has no spend")],
        ("fact_invoice", "order fact resolved", ERROR, "SELECT count(*) FROM fact_inv WHERE NOT POReferenceResolvedFlag"), ("fact_invoice", "matched amount plus exception amount is gross", ERROR, "SELECT 0"), ("fact_savings", "counts equal flags", ERROR, "SELECT 0"),
        ("fact_supplier_performance", "delivery rate recomputes", ERROR, "SELECT 0"), ("fact_supplier_performance", "quality rate recomputes", ERROR, "SELECT 0"))
def _(m):
    from spendline.functions.exprs import pct
    from spendline.operators.facts import SAVINGS_COUNTS
    c, m = F.col, m.narrow
    keys = ["CategoryKey", "MaterialKey", "BuyerKey", "BusinessUnitKey", "CurrencyKey", "OrderDateKey"]
    wrong_counts = QL.reduce(lambda a, b: a | b, [c(n) != F.coalesce(c(f).cast("long"), F.lit(0)) for n, f in SAVINGS_COUNTS.items()])
    return QL.results([
        QL.row_rules(m["fact_purchase_order"], "fact_purchase_order", [
            Rule("mandatory keys present", QL.reduce(lambda a, b: a | b, [c(k).isNull() for k in keys])),
            Rule("contract key where contract known", c("ContractKey").isNotNull() & (c("ContractKey") != surrogate_key("ContractID"))),
            Rule("date key equals date", c("OrderDateKey") != F.date_format("OrderDate", "yyyyMMdd").cast("int")), Rule("ineligible has no spend", ~c("SpendEligibilityFlag") & (c("EligibleSpendEUR") != 0))]),
        QL.row_rules(m["fact_invoice"], "fact_invoice", [
            Rule("order fact resolved", ~c("PurchaseOrderFactResolvedFlag")), Rule("matched amount plus exception amount is gross", QL.differ_rows(c("MatchedInvoiceAmountEUR") + c("InvoiceExceptionAmountEUR"), F.coalesce(c("GrossAmountEUR"), c("MatchedInvoiceAmountEUR") + c("InvoiceExceptionAmountEUR")), 0.02))]),
        QL.row_rules(m["fact_savings"], "fact_savings", [Rule("counts equal flags", wrong_counts)]),
        QL.row_rules(m["fact_supplier_performance"], "fact_supplier_performance", [
            Rule("delivery rate recomputes", QL.differ_rows("SupplierOTDPct", pct("OnTimeFullyReceivedPOItemCount", "FullyReceivedPOItemCount"), 0.02)),
            Rule("quality rate recomputes", QL.differ_rows("SupplierQualityIndexPct", pct("DisputeFreeInvoiceCount", "InvoiceCount"), 0.02))])])


@_check("D29_sums_reconciled", *[("fact_purchase_order", f"sum of {c}", ERROR, "SELECT 0") for c in ("EligibleSpendEUR", "ContractCompliantSpendEUR", "MaverickSpendEUR")],
        ("fact_invoice", "sum of GrossAmountEUR", ERROR, "SELECT 0"), ("fact_savings", "sum of RealizedSavingsEUR", ERROR, "SELECT 0"))
def _(m):
    cols = ("EligibleSpendEUR", "ContractCompliantSpendEUR", "MaverickSpendEUR")
    return QL.results([QL.sums_reconciled(m["fact_purchase_order"], m["silver_po_spend"], "fact_purchase_order", {c: c for c in cols}),
                       QL.sums_reconciled(m["fact_invoice"], m["silver_invoice_matching"], "fact_invoice", {"GrossAmountEUR": "GrossAmountEUR"}),
                       QL.sums_reconciled(m["fact_savings"], m["silver_savings_project"], "fact_savings", {"RealizedSavingsEUR": "RealizedSavingsEUR"})])


@_check("D30_cross_fact", ("fact_invoice", "order key in fact_purchase_order", ERROR, "SELECT 0"), ("fact_invoice", "order id agrees", ERROR, "SELECT 0"), ("fact_invoice", "category key agrees", ERROR, "SELECT 0"),
        ("fact_purchase_order", "yearly spend equals scorecard", ERROR, "SELECT 0"))
def _(m):
    from spendline.operators.joins import reconcile
    m = m.narrow
    po, inv = m["fact_purchase_order"], m["invoice_links"]
    yearly = po.groupBy(F.year("OrderDate").alias("Year")).agg(F.sum("EligibleSpendEUR").alias("Spend"))
    score = m["silver_supplier_performance"].groupBy(F.col("PerformanceYear").alias("Year")).agg(F.sum("EligibleSpendEUR").alias("Spend"))
    return QL.results([
        QL.fk_rule(inv, "fact_invoice", ["PurchaseOrderFactKey"], po, ["PurchaseOrderFactKey"], "fact_purchase_order", nullable=True).withColumn("ValidationRule", F.lit("order key in fact_purchase_order")),
        QL.row_rules(inv, "fact_invoice", [Rule("order id agrees", ~F.col("POIDFactConsistencyFlag"))]),
        QL.count_rule(QL.disagreements(inv, po, "POItemID", {"CategoryKey": "CategoryKey"}), "fact_invoice", "category key agrees"),
        QL.count_rule(reconcile(yearly, score, ["Year"], ["Spend"], 0.05).where("NOT ReconciledFlag"), "fact_purchase_order", "yearly spend equals scorecard")])


@_check("D31_freshness", ("fact_purchase_order", "GoldLoadDate at most 2 days old", ERROR, "SELECT 0"), ("orders", "o_orderdate at most 2 days old", WARNING, "SELECT CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-08-01') > 2 AS INT) FROM orders"))
def _(m):
    old = QL.fresh_rule(m.source.raw("orders"), "orders", "o_orderdate", 2, F.to_date(F.lit("2001-08-01"))).withColumn("Severity", F.lit(WARNING))
    return QL.results([QL.fresh_rule(m["fact_purchase_order"], "fact_purchase_order", "GoldLoadDate", 2), old])


@_check("D32_features", ("risk_labelled", "SupplierID, PerformanceYear not null", ERROR, "SELECT 0"), ("risk_labelled", "SupplierID, PerformanceYear unique", ERROR, "SELECT 0"),
        ("risk_labelled", "both classes present", ERROR, "SELECT 2 - count(DISTINCT HighRiskNextYearFlag) FROM risk_labels"), ("risk_labelled", "years in range", ERROR, "SELECT count(*) FROM risk_labels WHERE PerformanceYear NOT BETWEEN 1995 AND 1999"),
        ("price_features", "POItemID not null", ERROR, "SELECT 0"), ("price_features", "POItemID unique", ERROR, "SELECT 0"), ("price_features", "price positive", ERROR, "SELECT 0"))
def _(m):
    lab, price = m["risk_labelled"], m.planned["price_features"]
    return QL.results([QL.key_rule(lab, "risk_labelled", ["SupplierID", "PerformanceYear"]),
                       QL.agg_rules(lab, "risk_labelled", {"both classes present": F.lit(2) - F.countDistinct("HighRiskNextYearFlag"), "years in range": F.count_if(~F.col("PerformanceYear").between(1995, 1999))}),
                       QL.key_rule(price, "price_features", ["POItemID"]), QL.row_rules(price, "price_features", [Rule("price positive", F.col("UnitPriceEUR") <= 0)])])


@_check("D33_predictions", *[("prioritised", r, ERROR, "SELECT 0") for r in ("SupplierID, CategoryID not null", "SupplierID, CategoryID unique", "SavingsOpportunityRank not null", "SavingsOpportunityRank unique", "components add up",
                                                                       "savings not negative", "savings below spend", "score within 0 and 100", "flag is 0 or 1")],
        ("pricing_scores", "anomaly rate not degenerate", ERROR, "SELECT CAST(NOT (sum(PricingAnomalyFlag) BETWEEN 1 AND count(*) - 1) AS INT) FROM pscores"))
def _(m):
    p, c = m["prioritised"], F.col
    return QL.results([QL.key_rule(p, "prioritised", ["SupplierID", "CategoryID"]), QL.key_rule(p, "prioritised", ["SavingsOpportunityRank"]), QL.row_rules(p, "prioritised", [
        Rule("components add up", QL.differ_rows("PotentialAnnualSavingsEUR", c("AnnualizedPricingOpportunityEUR") + c("AnnualizedMaverickOpportunityEUR"), 0.02)),
        Rule("savings not negative", c("PotentialAnnualSavingsEUR") < 0), Rule("savings below spend", c("PotentialAnnualSavingsEUR") > c("AnnualizedEligibleSpendEUR")),
        Rule("score within 0 and 100", ~c("NegotiationPriorityScore").between(0, 100)), Rule("flag is 0 or 1", ~c("ActionableOpportunityFlag").isin(0, 1))]),
        QL.agg_rules(m["pricing_scores"], "pricing_scores", {"anomaly rate not degenerate": F.when(F.sum("PricingAnomalyFlag").between(1, F.count("*") - 1), 0).otherwise(1)})])


@_check("D34_alignment", ("ml_supplier_risk_prediction", "supplier version exists", ERROR, "SELECT count(*) FROM ml_risk r WHERE r.SupplierID NOT IN (SELECT SupplierID FROM dim_supplier WHERE DATE '2001-07-31' BETWEEN EffectiveFromDate AND EffectiveToDate)"),
        ("ml_savings_opportunity", "risk score agrees", ERROR, "SELECT 0"), ("ml_pricing_anomaly_prediction", "order fact exists", ERROR, "SELECT 0"))
def _(m):
    m = m.narrow
    latest = m["ml_savings_opportunity"].where(F.col("PredictionDate") == F.to_date(F.lit(MT.AS_OF)))
    risk = m["ml_supplier_risk_prediction"].where(F.col("PredictionDate") == F.to_date(F.lit(MT.AS_OF))).select("SupplierID", F.col("SupplierRiskScore").alias("r"))
    gap = latest.join(risk, "SupplierID").where(F.abs(F.col("SupplierRiskScore") - F.col("r")) > 1e-6)
    return QL.results([
        QL.fk_rule(m["ml_supplier_risk_prediction"], "ml_supplier_risk_prediction", ["SupplierID"], dim_at(m["dim_supplier"], MT.AS_OF), ["SupplierID"], "dim_supplier").withColumn("ValidationRule", F.lit("supplier version exists")),
        QL.count_rule(gap, "ml_savings_opportunity", "risk score agrees"),
        QL.fk_rule(m["ml_pricing_anomaly_prediction"], "ml_pricing_anomaly_prediction", ["PurchaseOrderFactKey"], m["fact_purchase_order"], ["PurchaseOrderFactKey"], "fact_purchase_order").withColumn("ValidationRule", F.lit("order fact exists"))])


@_check("D35_source_gold", ("ml_savings_opportunity", "source rows preserved", ERROR, "SELECT 0"), ("ml_savings_opportunity", "sum of PotentialAnnualSavingsEUR", ERROR, "SELECT 0"))
def _(m):
    gold = m["ml_savings_opportunity"].where(F.col("PredictionDate") == F.to_date(F.lit(MT.AS_OF)))
    return QL.results([QL.row_count_rule(gold, "ml_savings_opportunity", m["prioritised"], "source rows preserved"),
                       QL.sums_reconciled(gold, m["prioritised"], "ml_savings_opportunity", {"PotentialAnnualSavingsEUR": "PotentialAnnualSavingsEUR"})])
