"""Independent SQL for the registered queries.

The SQL works on the raw tables in exact integer units (cents, 1e-4 prices, 1e-6 rates) and shares
no code with the Spark operators. Common sub-results are named; `sql()` puts the ones a query needs
in front of it.
"""

from __future__ import annotations

import re

from spendline.sources.tpch import BUYER_ROLES, CURRENCIES, PROCUREMENT_TYPES, PROJECT_STATUSES, SUPPLIER_TYPES

AS_OF = "DATE '2001-07-31'"
FACTOR = "(365.0::DOUBLE/212.0::DOUBLE)"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _label(column: str, values: list[str]) -> str:
    return f"CASE lower({column}) " + " ".join(f"WHEN '{v.lower()}' THEN '{v}'" for v in values) + f" ELSE {column} END"


def _fx(alias: str, date: str, ccy: str, name: str) -> tuple[str, str]:
    """Join clause and columns of an as-of rate: `<name>_ru`, `<name>_method`, `<name>_rd`."""
    joins = (f"LEFT JOIN fx {alias} ON {alias}.d = {date} AND {alias}.ccy = {ccy} "
             f"LEFT JOIN fx_ends {alias}b ON {alias}b.ccy = {ccy}")
    cols = (f"CASE WHEN {alias}.ru IS NOT NULL THEN {alias}.ru WHEN {date} < {alias}b.lo THEN {alias}b.lo_ru "
            f"WHEN {date} > {alias}b.hi THEN {alias}b.hi_ru END AS {name}_ru, "
            f"CASE WHEN {alias}.ru IS NOT NULL THEN 'EXACT_DATE' WHEN {date} < {alias}b.lo THEN 'EARLIEST_AVAILABLE_RATE' "
            f"WHEN {date} > {alias}b.hi THEN 'LATEST_AVAILABLE_RATE' ELSE 'UNRESOLVED' END AS {name}_method, "
            f"CASE WHEN {alias}.ru IS NOT NULL THEN {date} WHEN {date} < {alias}b.lo THEN {alias}b.lo "
            f"WHEN {date} > {alias}b.hi THEN {alias}b.hi END AS {name}_rd")
    return joins, cols


def _eur(units: str, rate: str) -> str:
    """Units times a 1e-6 rate, rounded half up, in the same units."""
    return f"CAST((CAST({units} AS HUGEINT) * {rate} + 500000) // 1000000 AS BIGINT)"


def _pct(n: str, d: str, digits: int = 2) -> str:
    return f"CASE WHEN {d} > 0 THEN round(CAST({n} AS DOUBLE) * 100.0 / CAST({d} AS DOUBLE), {digits}) END"


def _round(x: str, digits: int) -> str:
    """Round a double half up on its decimal text, as Spark does."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def _gap_pct(a: str, b: str) -> str:
    """100 * (a - b) / b rounded half up to two digits, in exact integers."""
    return f"CASE WHEN {b} > 0 THEN sign({a} - {b}) * ((abs({a} - {b}) * 20000 + {b}) // (2 * {b})) / 100.0::DOUBLE END"


_PO_FX, _PO_FX_COLS = _fx("f", "p.OrderDate", "p.POCurrency", "po")
_CO_FX, _CO_FX_COLS = _fx("g", "p.OrderDate", "c.Currency", "co")
_IN_FX, _IN_FX_COLS = _fx("f", "i.InvoiceDate", "i.InvoiceCurrency", "inv")
_SA_FX, _SA_FX_COLS = _fx("f", "s.ProjectCreatedDate", "s.Currency", "sav")
_CT_FX, _CT_FX_COLS = _fx("f", "c.ContractStartDate", "c.Currency", "ct")

PRIOR = "PARTITION BY {0} ORDER BY OrderDate, POItemID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _history(prefix: str, keys: str) -> str:
    w = PRIOR.format(keys)
    x = "UnitPriceEUR"
    return (f"count({x}) OVER ({w}) AS {prefix}HistoryCount, CAST(sum(pu_eur) OVER ({w}) AS DOUBLE) / 10000.0::DOUBLE / count({x}) OVER ({w}) AS {prefix}Avg, "
            f"CASE WHEN count({x}) OVER ({w}) > 1 THEN sqrt(CAST(count({x}) OVER ({w}) * sum(CAST(pu_eur AS HUGEINT) * pu_eur) OVER ({w}) "
            f"- CAST(sum(pu_eur) OVER ({w}) AS HUGEINT) * sum(pu_eur) OVER ({w}) AS DOUBLE) "
            f"/ (count({x}) OVER ({w}) * CAST(count({x}) OVER ({w}) - 1 AS DOUBLE))) / 10000.0::DOUBLE END AS {prefix}Sd, min({x}) OVER ({w}) AS {prefix}Min, max({x}) OVER ({w}) AS {prefix}Max")


CTES: dict[str, str] = {
    "b_supplier": f"""
        SELECT ' s' || s_suppkey AS SupplierID, (CASE WHEN copy = 1 THEN ' Old  ' ELSE '  ' END) || s_name || '   Ltd ' AS SupplierName,
          CASE WHEN s_suppkey % 2 = 0 THEN lower(t) ELSE upper(t) END AS SupplierType, n_name AS Country, r_name AS Region,
          s_suppkey % 3 = 0 AS PreferredSupplier, s_suppkey % 7 = 0 AS StrategicSupplier,
          CASE s_suppkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' END AS ESGRating,
          CAST(floor((s_acctbal + 1000.0) / 110.0) AS INT) AS FinancialRiskScore,
          DATE '1994-01-01' + CAST(s_suppkey % 365 AS INT) AS CreatedDate,
          CASE WHEN s_suppkey % 11 = 0 THEN 'inactive' ELSE 'ACTIVE' END AS Status, copy
        FROM (SELECT *, {_list(SUPPLIER_TYPES)}[1 + s_suppkey % 6] AS t FROM supplier JOIN nation ON s_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey) x JOIN (VALUES (0), (1)) v(copy) ON copy = 0 OR s_suppkey % 5 = 0""",
    "c_supplier": f"""
        SELECT upper(trim(SupplierID)) AS SupplierID, trim(regexp_replace(SupplierName, '\\s+', ' ', 'g')) AS SupplierName,
          {_label("SupplierType", SUPPLIER_TYPES)} AS SupplierType, Country, Region, PreferredSupplier, StrategicSupplier, ESGRating,
          FinancialRiskScore, CreatedDate, {_label("Status", ["Active", "Inactive"])} AS Status, lower(Status) = 'active' AS SupplierActiveFlag
        FROM b_supplier QUALIFY row_number() OVER (PARTITION BY trim(SupplierID) ORDER BY copy) = 1""",
    "c_category": f"""
        SELECT 'CAT-' || n AS CategoryID, p_brand || ' goods' AS CategoryName, 'Group ' || (n % 4) AS CommodityGroup,
          {_list(PROCUREMENT_TYPES)}[1 + n % 3] AS ProcurementType, 'Manager ' || (n % 7) AS CategoryManager
        FROM (SELECT DISTINCT p_brand, CAST(substr(p_brand, 7) AS INT) AS n FROM part)""",
    "c_bu": """
        SELECT 'BU' || r_regionkey AS BusinessUnitID, r_name || ' unit' AS BusinessUnitName, 'Country ' || r_regionkey AS Country,
          r_name AS Region FROM region""",
    "c_buyer": f"""
        SELECT 'B' || k AS BuyerID, name AS BuyerName, 'b' || k || '@example.org' AS Email, 'Department ' || (k % 3) AS Department,
          {_list(BUYER_ROLES)}[1 + k % 5] AS BuyerRole, 'BU' || (k % 5) AS BusinessUnitID
        FROM (SELECT c_custkey % 30 AS k, min(c_name) AS name FROM customer GROUP BY 1)""",
    "c_material": """
        SELECT 'M' || p_partkey AS MaterialID, p_name AS MaterialDescription, 'CAT-' || CAST(substr(p_brand, 7) AS INT) AS CategoryID,
          CAST(p_retailprice AS DECIMAL(18,2)) AS StandardCost, 'EA' AS UnitOfMeasure, p_type AS Manufacturer,
          CASE WHEN p_partkey % 13 = 0 THEN 'Inactive' ELSE 'Active' END AS Status FROM part""",
    "fx_span": """
        SELECT CAST(min(o_orderdate) AS DATE) + 60 AS lo, CAST(max(o_orderdate) AS DATE) - 60 AS hi FROM orders""",
    "fx": f"""
        SELECT d, ccy, CASE WHEN k = 0 THEN 1000000 ELSE (500 + k * 100 + (n * 7 + k * 13) % 101) * 1000 END AS ru
        FROM (SELECT d, d - lo AS n FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d, lo FROM fx_span))
        JOIN (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(CURRENCIES))}) v(k, ccy)
          ON NOT (ccy = 'CHF' AND n >= 1000 AND n < 1010)""",
    "fx_ends": """
        SELECT ccy, min(d) AS lo, max(d) AS hi, arg_min(ru, d) AS lo_ru, arg_max(ru, d) AS hi_ru, count(DISTINCT d) AS days
        FROM fx GROUP BY ccy""",
    "c_contract": f"""
        SELECT 'K-' || k || '-' || n AS ContractID, 'S' || k AS SupplierID, 'CAT-' || n AS CategoryID, s AS ContractStartDate,
          s + CAST(1094 + (k % 2) * 365 AS INT) AS ContractEndDate,
          CASE WHEN k % 10 = 3 THEN 'EUR' ELSE {_list(CURRENCIES)}[1 + k % 8] END AS Currency,
          (1000 + (k % 50) * 10 + n) * 10000 AS price_u, (1000 + (k % 50) * 10 + n) * 100000 AS value_c,
          'B' || ((k + n) % 30) AS ContractOwnerBuyerID, 'Owner ' || ((k + n) % 30) AS SourceContractOwner,
          ['Frame Agreement', 'Spot Buy', 'Volume Contract'][1 + (k + n) % 3] AS ContractType,
          CASE WHEN (k + n) % 17 = 0 THEN 'Active' WHEN s > {AS_OF} THEN 'Future'
               WHEN s + CAST(1094 + (k % 2) * 365 AS INT) < {AS_OF} THEN 'Expired' ELSE 'Active' END AS SourceContractStatus,
          CAST(30 + (k % 3) * 15 AS INT) AS PaymentTermsDays, (k + n) % 2 = 0 AS AutoRenewalFlag
        FROM (SELECT s_suppkey AS k, n, DATE '1995-01-01' + CAST((s_suppkey * 37 + n * 11) % 1200 AS INT) AS s
              FROM (SELECT s_suppkey, unnest(range(1, 26)) AS n FROM supplier))""",
    "contract": f"""
        SELECT c.*, CASE WHEN ContractStartDate > {AS_OF} THEN 'Future' WHEN ContractEndDate < {AS_OF} THEN 'Expired' ELSE 'Active' END
            AS ContractLifecycleStatus,
          ContractStartDate <= {AS_OF} AND ContractEndDate >= {AS_OF} AS IsContractActiveAsOfDate,
          ContractEndDate - ContractStartDate + 1 AS ContractDurationDays, ContractEndDate - {AS_OF} AS DaysToExpiryAsOfDate,
          {_CT_FX_COLS}
        FROM c_contract c {_CT_FX}""",
    "lines": """
        SELECT *, CASE WHEN m >= 6 THEN (agreed * q + 50) // 100 ELSE cents END AS amt,
          CASE WHEN m >= 6 THEN agreed ELSE (cents * 200 + q) // (2 * q) END AS pu
        FROM (SELECT *, (1000 + (sup % 50) * 10 + n) * (10000 + 125 * (l_linenumber - 4)) AS agreed FROM (
          SELECT l.*, o_custkey, CAST(o_orderdate AS DATE) AS OrderDate, o_orderstatus, CAST(substr(p_brand, 7) AS INT) AS n,
            o_custkey // 15 AS sup, (l_orderkey * 7 + l_partkey + l_linenumber) % 10 AS m, CAST(l_quantity AS BIGINT) AS q,
            CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(round(l_tax * 100) AS BIGINT) AS t,
            'PO' || l_orderkey AS POID, 'PO' || l_orderkey || '-' || rn AS POItemID,
            CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'Cancelled' WHEN l_linestatus = 'O' THEN 'Open'
                 WHEN l_returnflag = 'A' THEN 'Partially Received' WHEN l_returnflag = 'N' THEN 'Fully Received' ELSE 'Closed' END AS POItemStatus
          FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
                  l_extendedprice, l_quantity, l_discount, l_tax) AS rn FROM lineitem) l
          JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey))""",
    "po_items": f"""
        SELECT *, 'S' || sup AS POSupplierID, 'B' || (o_custkey % 30) AS BuyerID, 'BU' || (o_custkey % 5) AS BusinessUnitID,
          {_list(CURRENCIES)}[1 + sup % 8] AS POCurrency,
          CASE WHEN l_orderkey % 20 = 0 THEN 'Cancelled' WHEN o_orderstatus = 'O' THEN 'Open' WHEN o_orderstatus = 'F' THEN 'Closed'
               ELSE 'Partially Received' END AS POStatus,
          'M' || l_partkey AS MaterialID, 'CAT-' || n AS CategoryID,
          CASE WHEN m <= 1 THEN NULL WHEN m = 2 THEN 'K-' || (sup + 1000000) || '-' || n WHEN m = 3 THEN 'K-' || l_suppkey || '-' || n
               WHEN m = 4 THEN 'K-' || sup || '-' || (n % 25 + 1) ELSE 'K-' || sup || '-' || n END AS ContractID,
          CASE WHEN m <= 1 THEN 'NO_CONTRACT_REFERENCE' WHEN m <= 4 THEN 'INVALID_DATE_CONTRACT' ELSE 'COMPLIANT_CONTRACT' END
            AS SimulationContractScenario,
          OrderDate + CAST(30 + l_linenumber * 5 AS INT) AS RequestedDeliveryDate
        FROM lines""",
    "po_valid": f"""
        SELECT p.*, c.ContractID AS ResolvedContractID, c.SupplierID AS cs, c.CategoryID AS cc, c.Currency AS ContractCurrency,
          c.ContractStartDate, c.ContractEndDate, c.price_u, POStatus <> 'Cancelled' AND POItemStatus <> 'Cancelled' AS SpendEligibilityFlag,
          coalesce(c.SupplierID = POSupplierID AND c.CategoryID = p.CategoryID AND OrderDate BETWEEN c.ContractStartDate AND c.ContractEndDate,
                   FALSE) AS ValidContractAtPOFlag,
          CASE WHEN p.ContractID IS NULL THEN 'NO_CONTRACT_REFERENCE' WHEN c.ContractID IS NULL THEN 'CONTRACT_NOT_FOUND'
               WHEN c.SupplierID <> POSupplierID THEN 'SUPPLIER_MISMATCH' WHEN c.CategoryID <> p.CategoryID THEN 'CATEGORY_MISMATCH'
               WHEN OrderDate < c.ContractStartDate THEN 'CONTRACT_NOT_YET_ACTIVE' WHEN OrderDate > c.ContractEndDate THEN 'CONTRACT_EXPIRED'
               ELSE 'VALID_CONTRACT' END AS ContractValidityStatusAtPO,
          {_PO_FX_COLS}, {_CO_FX_COLS.replace("'UNRESOLVED' END", "CASE WHEN c.Currency IS NULL THEN 'NOT_APPLICABLE' ELSE 'UNRESOLVED' END END")}
        FROM po_items p LEFT JOIN c_contract c ON p.ContractID = c.ContractID {_PO_FX} {_CO_FX}""",
    "po_priced": f"""
        SELECT *, {_eur("amt", "po_ru")} AS amt_eur, {_eur("pu", "po_ru")} AS pu_eur,
          {_eur("price_u", "co_ru")} AS cp_eur,
          SpendEligibilityFlag AND ValidContractAtPOFlag AS ContractComplianceFlag,
          SpendEligibilityFlag AND NOT ValidContractAtPOFlag AS MaverickSpendFlag,
          CASE WHEN NOT SpendEligibilityFlag THEN 'EXCLUDED_CANCELLED' ELSE CASE ContractValidityStatusAtPO
            WHEN 'VALID_CONTRACT' THEN 'COMPLIANT' WHEN 'NO_CONTRACT_REFERENCE' THEN 'MAVERICK_NO_CONTRACT'
            WHEN 'CONTRACT_NOT_FOUND' THEN 'MAVERICK_CONTRACT_NOT_FOUND' WHEN 'SUPPLIER_MISMATCH' THEN 'MAVERICK_SUPPLIER_MISMATCH'
            WHEN 'CATEGORY_MISMATCH' THEN 'MAVERICK_CATEGORY_MISMATCH' ELSE 'MAVERICK_INVALID_CONTRACT_DATE' END END AS SpendComplianceStatus
        FROM po_valid""",
    "po": f"""
        SELECT *, CASE WHEN SpendEligibilityFlag THEN amt_eur ELSE 0 END AS elig_c, CASE WHEN ContractComplianceFlag THEN amt_eur ELSE 0 END AS comp_c,
          CASE WHEN MaverickSpendFlag THEN amt_eur ELSE 0 END AS mav_c, year(OrderDate) AS POYear,
          ValidContractAtPOFlag AND pu_eur IS NOT NULL AND coalesce(cp_eur > 0, FALSE) AS ContractPriceComparisonEligibleFlag,
          CASE WHEN ValidContractAtPOFlag THEN {_gap_pct("pu_eur", "cp_eur")} END AS ContractPriceVariancePercentage,
          SpendEligibilityFlag AND ValidContractAtPOFlag AND NOT coalesce(abs({_gap_pct("pu_eur", "cp_eur")}) <= 3.0, FALSE) AS PriceComplianceExceptionFlag
        FROM po_priced""",
    "receipts": """
        SELECT 'GR-' || POItemID || '-' || seq AS GoodsReceiptID, POItemID, POID, sup, l_partkey, o_custkey, seq AS ReceiptSequence,
          CASE WHEN seq = 1 THEN first ELSE first + 10 END AS ReceiptDate,
          CASE WHEN k <= 2 AND seq = 1 THEN half WHEN k <= 2 THEN q * 1000 - half WHEN k = 3 THEN half ELSE q * 1000 END AS qty_m, OrderDate
        FROM (SELECT *, (l_orderkey + l_linenumber) % 10 AS k, (q * 1000) // 2 AS half,
                OrderDate + CAST(5 + ((CAST(l_shipdate AS DATE) - OrderDate) % 60 + 60) % 60 AS INT) AS first FROM lines
              WHERE (l_orderkey + l_linenumber) % 10 <> 0 AND POItemStatus <> 'Cancelled')
        JOIN (VALUES (1), (2)) v(seq) ON seq = 1 OR k <= 2""",
    "invoices": f"""
        SELECT 'INV' || o_orderkey || (CASE WHEN dup THEN '-D' ELSE '' END) AS InvoiceID, 'N' || o_orderkey AS InvoiceNumber, 'PO' || o_orderkey AS POID,
          'S' || (CASE WHEN o_orderkey % 101 = 0 THEN 0 ELSE o_custkey // 15 END) AS InvoiceSupplierID, 'BU' || (o_custkey % 5) AS InvoiceBusinessUnitID,
          CAST(o_orderdate AS DATE) + 45 AS InvoiceDate, CAST(o_orderdate AS DATE) + 47 AS PostingDate,
          CAST(o_orderdate AS DATE) + CAST(75 + ((o_custkey // 15) % 3) * 15 AS INT) AS DueDate,
          {_list(CURRENCIES)}[1 + (o_custkey // 15) % 8] AS InvoiceCurrency, o_orderkey % 23 = 3 AS DisputeFlag, dup AS HeaderDuplicateInvoiceFlag,
          CASE WHEN dup THEN 'INV' || o_orderkey END AS OriginalInvoiceID, CAST(round(o_totalprice * 100) AS BIGINT) AS total_c,
          CASE WHEN o_orderkey % 23 = 3 THEN 'Price' END AS DisputeReason
        FROM orders JOIN (VALUES (FALSE), (TRUE)) v(dup) ON NOT dup OR o_orderkey % 40 = 7 WHERE o_orderkey % 20 <> 0""",
    "invoice_items": """
        SELECT *, (netc * t + 50) // 100 AS taxc, netc + (netc * t + 50) // 100 AS grossc FROM (
          SELECT *, (ipu * iq + 50000) // 100000 AS netc FROM (
            SELECT 'II-' || POItemID || (CASE WHEN dup THEN '-D' ELSE '' END) AS InvoiceItemID,
              'INV' || l_orderkey || (CASE WHEN dup THEN '-D' ELSE '' END) AS InvoiceID, rn, POID, t, dup, q, pu AS src_pu,
              CASE WHEN dup THEN 'II-' || POItemID END AS OriginalInvoiceItemID,
              CASE WHEN l_partkey % 97 = 0 THEN 'X' || POItemID ELSE POItemID END AS POItemID, 'CAT-' || n AS ItemCategoryID, 'M' || l_partkey AS ItemMaterialID,
              (pu * (96 + t) + 50) // 100 AS ipu, CASE WHEN l_partkey % 9 = 0 THEN q * 1050 ELSE q * 1000 END AS iq
            FROM lines JOIN (VALUES (FALSE), (TRUE)) v(dup) ON NOT dup OR l_orderkey % 40 = 7
            WHERE l_orderkey % 20 <> 0 AND (l_orderkey + l_partkey) % 8 <> 7 AND POItemStatus <> 'Cancelled'))""",
    "inv_received": """
        SELECT InvoiceItemID, coalesce(sum(qty_m), 0) AS received_m, count(DISTINCT GoodsReceiptID) AS receipt_count, max(ReceiptDate) AS last_receipt
        FROM (SELECT InvoiceItemID, ii.POItemID, InvoiceDate FROM invoice_items ii JOIN invoices h ON ii.InvoiceID = h.InvoiceID) i
        LEFT JOIN receipts r ON r.POItemID = i.POItemID AND r.ReceiptDate <= i.InvoiceDate GROUP BY 1""",
    "inv_base": f"""
        SELECT ii.*, h.* EXCLUDE (InvoiceID, POID), p.POItemID IS NOT NULL AS POReferenceResolvedFlag, p.POSupplierID, p.BusinessUnitID AS POBusinessUnitID,
          p.BuyerID, p.CategoryID, p.MaterialID, p.ContractID AS POContractID, p.pu AS po_pu, r.received_m, r.receipt_count, r.last_receipt, p.POID AS RefPOID,
          CASE WHEN p.POItemID IS NULL THEN FALSE ELSE h.InvoiceSupplierID = p.POSupplierID END AS InvoicePOSupplierMatchFlag,
          dup AS DuplicateInvoiceLineFlag, dup OR HeaderDuplicateInvoiceFlag AS DerivedDuplicateInvoiceFlag,
          {_gap_pct("ipu", "p.pu")} AS price_pct, {_gap_pct("iq", "received_m")} AS qty_pct
        FROM invoice_items ii JOIN invoices h ON ii.InvoiceID = h.InvoiceID LEFT JOIN po p ON p.POItemID = ii.POItemID
        JOIN inv_received r ON r.InvoiceItemID = ii.InvoiceItemID""",
    "inv": f"""
        SELECT i.*, status AS DerivedThreeWayMatchStatus, status = 'MATCHED' AS ThreeWayMatchFlag, status <> 'MATCHED' AS InvoiceExceptionFlag,
          year(InvoiceDate) AS InvoiceYear, {_eur("grossc", "inv_ru")} AS gross_eur, {_eur("netc", "inv_ru")} AS net_eur,
          {_eur("taxc", "inv_ru")} AS tax_eur, CASE WHEN status <> 'MATCHED' THEN {_eur("grossc", "inv_ru")} ELSE 0 END AS exc_eur
        FROM (SELECT i.*, CASE WHEN DerivedDuplicateInvoiceFlag THEN 'DUPLICATE_INVOICE' WHEN NOT POReferenceResolvedFlag THEN 'PO_REFERENCE_NOT_FOUND'
                WHEN received_m <= 0 THEN 'MISSING_GOODS_RECEIPT' WHEN abs(price_pct) > 3 AND abs(qty_pct) > 2 THEN 'PRICE_AND_QUANTITY_VARIANCE'
                WHEN abs(price_pct) > 3 THEN 'PRICE_VARIANCE' WHEN abs(qty_pct) > 2 THEN 'QUANTITY_VARIANCE' ELSE 'MATCHED' END AS status, {_IN_FX_COLS}
              FROM inv_base i {_IN_FX}) i""",
    "deliv": f"""
        SELECT *, recv_m >= q * 1000 AS done, recv_m >= q * 1000 AND last <= RequestedDeliveryDate AS on_time,
          recv_m >= q * 1000 AND last > RequestedDeliveryDate AS late, year(RequestedDeliveryDate) AS PerformanceYear,
          CASE WHEN recv_m >= q * 1000 AND last > RequestedDeliveryDate THEN last - RequestedDeliveryDate END AS DaysLate
        FROM (SELECT p.POItemID, p.POSupplierID AS SupplierID, p.q, p.RequestedDeliveryDate, coalesce(r.n, 0) AS n, coalesce(r.recv_m, 0) AS recv_m, r.last
              FROM po p LEFT JOIN (SELECT POItemID, count(DISTINCT GoodsReceiptID) AS n, sum(qty_m) AS recv_m, max(ReceiptDate) AS last FROM receipts GROUP BY 1) r
                ON p.POItemID = r.POItemID WHERE SpendEligibilityFlag AND RequestedDeliveryDate <= {AS_OF})""",
    "sy_spend": """
        SELECT POSupplierID AS SupplierID, POYear AS PerformanceYear, count(DISTINCT POID) AS POCount, count(*) AS POItemCount,
          sum(elig_c) AS elig_c, sum(comp_c) AS comp_c, sum(mav_c) AS mav_c FROM po WHERE SpendEligibilityFlag GROUP BY 1, 2""",
    "sy_deliv": """
        SELECT SupplierID, PerformanceYear, count(*) AS DuePOItemCount, count(*) FILTER (n > 0) AS ReceivedPOItemCount,
          count(*) FILTER (done) AS DeliveryCompletePOItemCount, count(*) FILTER (on_time) AS OnTimeDeliveryPOItemCount,
          count(*) FILTER (late) AS LateDeliveryPOItemCount, count(*) FILTER (NOT done) AS OverdueOpenPOItemCount,
          round(avg(DaysLate), 2) AS AverageDaysLate, max(DaysLate) AS MaximumDaysLate FROM deliv GROUP BY 1, 2""",
    "sy_items": """
        SELECT POSupplierID AS SupplierID, InvoiceYear AS PerformanceYear, count(*) AS InvoiceItemCount, count(*) FILTER (ThreeWayMatchFlag) AS MatchedInvoiceItemCount,
          count(*) FILTER (InvoiceExceptionFlag) AS InvoiceExceptionItemCount, sum(gross_eur) AS gross_c, sum(exc_eur) AS exc_c FROM inv GROUP BY 1, 2""",
    "sy_docs": """
        SELECT POSupplierID AS SupplierID, InvoiceYear AS PerformanceYear, count(DISTINCT InvoiceID) AS InvoiceCount,
          count(DISTINCT InvoiceID) FILTER (DisputeFlag) AS DisputedInvoiceCount, count(DISTINCT InvoiceID) FILTER (DerivedDuplicateInvoiceFlag) AS DuplicateInvoiceCount
        FROM inv GROUP BY 1, 2""",
    # A supplier that could not be found is NULL there; equal keys only, as in any left join.
    "score": f"""
        SELECT *, InvoiceCount - DisputedInvoiceCount AS DisputeFreeInvoiceCount, {_pct("comp_c", "elig_c")} AS ContractCompliancePct,
          {_pct("mav_c", "elig_c")} AS MaverickSpendPct, {_pct("OnTimeDeliveryPOItemCount", "DeliveryCompletePOItemCount")} AS SupplierOnTimeDeliveryPct,
          {_pct("OverdueOpenPOItemCount", "DuePOItemCount")} AS OverdueOpenDeliveryPct,
          {_pct("InvoiceCount - DisputedInvoiceCount", "InvoiceCount")} AS SupplierQualityIndexPct, {_pct("DisputedInvoiceCount", "InvoiceCount")} AS InvoiceDisputePct,
          {_pct("DuplicateInvoiceCount", "InvoiceCount")} AS DuplicateInvoicePct, {_pct("MatchedInvoiceItemCount", "InvoiceItemCount")} AS ThreeWayMatchPct,
          {_pct("InvoiceExceptionItemCount", "InvoiceItemCount")} AS InvoiceExceptionPct, {_pct("exc_c", "gross_c")} AS InvoiceExceptionAmountPct
        FROM (SELECT k.SupplierID, k.PerformanceYear, coalesce(POCount, 0) AS POCount, coalesce(POItemCount, 0) AS POItemCount, coalesce(elig_c, 0) AS elig_c,
            coalesce(comp_c, 0) AS comp_c, coalesce(mav_c, 0) AS mav_c, coalesce(DuePOItemCount, 0) AS DuePOItemCount, coalesce(ReceivedPOItemCount, 0) AS ReceivedPOItemCount,
            coalesce(DeliveryCompletePOItemCount, 0) AS DeliveryCompletePOItemCount, coalesce(OnTimeDeliveryPOItemCount, 0) AS OnTimeDeliveryPOItemCount,
            coalesce(LateDeliveryPOItemCount, 0) AS LateDeliveryPOItemCount, coalesce(OverdueOpenPOItemCount, 0) AS OverdueOpenPOItemCount,
            coalesce(AverageDaysLate, 0) AS AverageDaysLate, coalesce(MaximumDaysLate, 0) AS MaximumDaysLate, coalesce(InvoiceItemCount, 0) AS InvoiceItemCount,
            coalesce(MatchedInvoiceItemCount, 0) AS MatchedInvoiceItemCount, coalesce(InvoiceExceptionItemCount, 0) AS InvoiceExceptionItemCount,
            coalesce(gross_c, 0) AS gross_c, coalesce(exc_c, 0) AS exc_c, coalesce(InvoiceCount, 0) AS InvoiceCount,
            coalesce(DisputedInvoiceCount, 0) AS DisputedInvoiceCount, coalesce(DuplicateInvoiceCount, 0) AS DuplicateInvoiceCount
          FROM (SELECT SupplierID, PerformanceYear FROM sy_spend UNION SELECT SupplierID, PerformanceYear FROM sy_deliv
                UNION SELECT SupplierID, PerformanceYear FROM sy_items UNION SELECT SupplierID, PerformanceYear FROM sy_docs) k
          LEFT JOIN sy_spend a ON a.SupplierID = k.SupplierID AND a.PerformanceYear = k.PerformanceYear
          LEFT JOIN sy_deliv b ON b.SupplierID = k.SupplierID AND b.PerformanceYear = k.PerformanceYear
          LEFT JOIN sy_items c ON c.SupplierID = k.SupplierID AND c.PerformanceYear = k.PerformanceYear
          LEFT JOIN sy_docs d ON d.SupplierID = k.SupplierID AND d.PerformanceYear = k.PerformanceYear)""",
    "savings": f"""
        SELECT *, {_eur("base_c", "sav_ru")} AS base_eur, {_eur("fore_c", "sav_ru")} AS fore_eur, {_eur("appr_c", "sav_ru")} AS appr_eur,
          {_eur("real_c", "sav_ru")} AS real_eur, {_eur("wf_c", "sav_ru")} AS wf_eur
        FROM (SELECT s.*, (fore_c * w100 + 50) // 100 AS wf_c, {_SA_FX_COLS} FROM (
          SELECT k, 'SP' || k AS SavingsProjectID, c_name || ' saving' AS SavingsProjectName, 'S' || sup AS SupplierID, 'CAT-' || n AS CategoryID,
            'B' || (k % 30) AS BuyerID, 'BU' || (k % 5) AS BusinessUnitID,
            CASE WHEN k % 4 = 0 THEN NULL WHEN k % 4 = 1 THEN 'K-' || sup || '-' || (n % 25 + 1) ELSE 'K-' || sup || '-' || n END AS ContractID,
            upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS SavingsType, {_list(PROJECT_STATUSES)}[1 + k % 5] AS ProjectStatus,
            'L' || ((k // 5) % 4) AS SavingsLevel, [0, 25, 50, 100][1 + (k // 5) % 4] AS w100,
            CASE WHEN k % 5 = 4 THEN 'Rejected' WHEN k % 5 <= 1 THEN 'Pending' ELSE 'Approved' END AS ApprovalStatus,
            d AS ProjectCreatedDate, d + 30 AS PlannedStartDate, d + CAST(90 + k % 300 AS INT) AS PlannedCompletionDate,
            CASE WHEN k % 5 = 3 THEN d + CAST(90 + k % 300 + k % 41 - 20 AS INT) END AS ActualCompletionDate,
            CASE WHEN k % 5 = 4 THEN d + 80 END AS CancellationDate, {_list(CURRENCIES)}[1 + sup % 8] AS Currency, base_c, fore_c, appr_c,
            CASE WHEN k % 5 = 3 THEN (appr_c * (5 + k % 10) + 5) // 10 ELSE 0 END AS real_c
          FROM (SELECT *, (fore_c * 9 + 5) // 10 AS appr_c FROM (SELECT *, (base_c * 8 + 50) // 100 AS fore_c FROM (
            SELECT c_custkey AS k, c_name, c_mktsegment, c_custkey // 15 AS sup, c_custkey % 25 + 1 AS n,
              abs(CAST(round(c_acctbal * 100) AS BIGINT)) * 10 AS base_c, DATE '1995-06-01' + CAST((c_custkey * 13) % 2200 AS INT) AS d FROM customer)))
        ) s {_SA_FX})""",
    "dim_supplier": """
        SELECT SupplierID, SupplierName, SupplierType, Country, Region, PreferredSupplier, StrategicSupplier, ESGRating, FinancialRiskScore, Status,
          1 AS DimensionVersion, CAST((SELECT date_trunc('year', min(o_orderdate)) FROM orders) AS DATE) AS EffectiveFromDate,
          CASE WHEN k % 19 = 7 OR k % 3 = 1 THEN DATE '1998-06-30' ELSE DATE '9999-12-31' END AS EffectiveToDate, NOT (k % 19 = 7 OR k % 3 = 1) AS IsCurrentFlag
        FROM (SELECT *, CAST(substr(SupplierID, 2) AS BIGINT) AS k FROM c_supplier) WHERE k % 17 <> 5
        UNION ALL
        SELECT SupplierID, SupplierName, SupplierType, Country, Region, PreferredSupplier, StrategicSupplier, ESGRating,
          CASE WHEN k % 3 = 1 THEN FinancialRiskScore + 1 ELSE FinancialRiskScore END, Status, CASE WHEN k % 17 = 5 THEN 1 ELSE 2 END,
          DATE '1998-07-01', DATE '9999-12-31', TRUE
        FROM (SELECT *, CAST(substr(SupplierID, 2) AS BIGINT) AS k FROM c_supplier)
        WHERE k % 19 <> 7 AND (k % 17 = 5 OR (k % 3 = 1 AND FinancialRiskScore IS NOT NULL))""",
    "fact_po": """
        SELECT p.*, d.DimensionVersion AS SupplierDimensionVersion, d.SupplierID IS NOT NULL AS supplier_ok, ResolvedContractID IS NOT NULL AS contract_ok,
          pu_eur / 10000.0::DOUBLE AS UnitPriceEUR
        FROM po p LEFT JOIN dim_supplier d ON p.POSupplierID = d.SupplierID AND p.OrderDate BETWEEN d.EffectiveFromDate AND d.EffectiveToDate""",
    "fact_inv": """
        SELECT i.*, d.DimensionVersion AS SupplierDimensionVersion, d.SupplierID IS NOT NULL AS supplier_ok
        FROM inv i LEFT JOIN dim_supplier d ON i.InvoiceSupplierID = d.SupplierID AND i.InvoiceDate BETWEEN d.EffectiveFromDate AND d.EffectiveToDate""",
    "fact_sav": """
        SELECT s.*, d.DimensionVersion AS SupplierDimensionVersion, c.ContractID IS NOT NULL AS contract_ok,
          s.ProjectStatus IN ('Idea', 'Validated', 'Negotiation') AS ActivePipelineFlag
        FROM savings s LEFT JOIN dim_supplier d ON s.SupplierID = d.SupplierID AND s.ProjectCreatedDate BETWEEN d.EffectiveFromDate AND d.EffectiveToDate
        LEFT JOIN c_contract c ON s.ContractID = c.ContractID""",
    "fact_perf": f"""
        SELECT s.*, make_date(s.PerformanceYear, 1, 1) AS PeriodStart, CASE WHEN s.PerformanceYear = 2001 THEN {AS_OF} ELSE make_date(s.PerformanceYear, 12, 31) END AS PeriodEnd,
          d.DimensionVersion AS SupplierDimensionVersion, d.SupplierID AS dim_id, d.SupplierName, d.Region, d.FinancialRiskScore
        FROM score s LEFT JOIN dim_supplier d ON s.SupplierID = d.SupplierID
          AND (CASE WHEN s.PerformanceYear = 2001 THEN {AS_OF} ELSE make_date(s.PerformanceYear, 12, 31) END) BETWEEN d.EffectiveFromDate AND d.EffectiveToDate""",
    "risk": f"""
        SELECT *, CASE WHEN py > 0 THEN (spend - py) / py * 100.0 END AS YoYSpendChangePct, SupplierOTDPct - otd_py AS YoYOTDChangePp,
          InvoiceDisputePct - disp_py AS YoYInvoiceDisputeChangePp,
          CASE WHEN obs >= 2 AND avg3 > 0 THEN sd3 / avg3 * 100.0 END AS SpendVolatilityPct, CASE WHEN tot > 0 THEN spend / tot * 100.0 END AS SupplierSpendSharePct
        FROM (SELECT *, CASE WHEN lag(PerformanceYear) OVER w = PerformanceYear - 1 THEN lag(spend) OVER w END AS py,
            CASE WHEN lag(PerformanceYear) OVER w = PerformanceYear - 1 THEN lag(SupplierOTDPct) OVER w END AS otd_py,
            CASE WHEN lag(PerformanceYear) OVER w = PerformanceYear - 1 THEN lag(InvoiceDisputePct) OVER w END AS disp_py,
            count(spend) OVER r AS obs, avg(spend) OVER r AS avg3, stddev_samp(spend) OVER r AS sd3, sum(spend) OVER (PARTITION BY PerformanceYear) AS tot
          FROM (SELECT dim_id AS SupplierID, PerformanceYear, FinancialRiskScore, MaverickSpendPct, SupplierOnTimeDeliveryPct AS SupplierOTDPct, InvoiceExceptionPct,
              elig_c / 100.0::DOUBLE * (CASE WHEN PerformanceYear = 2001 THEN {FACTOR} ELSE 1.0 END) AS spend,
              CASE WHEN InvoiceCount > 0 THEN CAST(DisputedInvoiceCount AS DOUBLE) / InvoiceCount * 100.0 END AS InvoiceDisputePct,
              CASE WHEN DeliveryCompletePOItemCount > 0 THEN greatest(DeliveryCompletePOItemCount - OnTimeDeliveryPOItemCount, 0)::DOUBLE / DeliveryCompletePOItemCount * 100.0 END AS LateFullyReceivedPct,
              CASE WHEN DeliveryCompletePOItemCount + OverdueOpenPOItemCount > 0 THEN
                OverdueOpenPOItemCount::DOUBLE / (DeliveryCompletePOItemCount + OverdueOpenPOItemCount) * 100.0 END AS OverdueOpenDeliveryExposurePct
            FROM fact_perf)
          WINDOW w AS (PARTITION BY SupplierID ORDER BY PerformanceYear),
                 r AS (PARTITION BY SupplierID ORDER BY PerformanceYear RANGE BETWEEN 2 PRECEDING AND CURRENT ROW))""",
    "risk_pairs": """
        SELECT f.SupplierID, f.PerformanceYear, o.PerformanceYear AS FutureOutcomeYear, o.SupplierOTDPct AS fo, o.OverdueOpenDeliveryExposurePct AS fv,
          o.InvoiceDisputePct AS fd, o.InvoiceExceptionPct AS fe
        FROM risk f JOIN risk o ON f.SupplierID = o.SupplierID AND o.PerformanceYear = f.PerformanceYear + 1
        WHERE f.PerformanceYear <= 1999 AND o.PerformanceYear <= 2000""",
    "risk_cuts": """
        SELECT quantile_cont(fo, 0.25) AS qo, quantile_cont(fv, 0.75) AS qv, quantile_cont(fd, 0.75) AS qd, quantile_cont(fe, 0.75) AS qe FROM risk_pairs""",
    "risk_labels": """
        SELECT *, CAST(events >= 2 AS INT) AS HighRiskNextYearFlag FROM (
          SELECT *, CAST(coalesce(fo <= qo, FALSE) AS INT) + CAST(coalesce(fv >= qv, FALSE) AS INT) + CAST(coalesce(fd >= qd, FALSE) AS INT)
              + CAST(coalesce(fe >= qe, FALSE) AS INT) AS events,
            CAST(fo IS NOT NULL AS INT) + CAST(fv IS NOT NULL AS INT) + CAST(fd IS NOT NULL AS INT) + CAST(fe IS NOT NULL AS INT) AS observed
          FROM risk_pairs, risk_cuts) WHERE observed >= 2""",
    "price_hist": f"""
        SELECT POItemID, POID, OrderDate, year(OrderDate) AS OrderYear, POSupplierID AS SupplierID, MaterialID, CategoryID, UnitPriceEUR, pu_eur, q,
          ContractPriceVariancePercentage AS var_pct, CAST(PriceComplianceExceptionFlag AS INT) AS PriceComplianceExceptionFlag,
          {_history("Material", "MaterialID")}, {_history("SupplierMaterial", "POSupplierID, MaterialID")}, {_history("Category", "CategoryID")}
        FROM fact_po WHERE OrderDate <= {AS_OF} AND UnitPriceEUR > 0""",
    "price_feat": """
        SELECT *, CAST(MaterialHistoryCount >= 5 AS INT) AS HasMaterialHistoryFlag, CAST(SupplierMaterialHistoryCount >= 3 AS INT) AS HasSupplierMaterialHistoryFlag,
          CAST(CategoryHistoryCount >= 20 AS INT) AS HasCategoryHistoryFlag, CAST(var_pct IS NOT NULL AS INT) AS HasContractBenchmarkFlag,
          CAST(MaterialHistoryCount >= 5 AS INT) + CAST(SupplierMaterialHistoryCount >= 3 AS INT) + CAST(CategoryHistoryCount >= 20 AS INT)
            + CAST(var_pct IS NOT NULL AS INT) AS BenchmarkCoverageCount,
          CASE WHEN MaterialAvg > 0 THEN (UnitPriceEUR - MaterialAvg) / MaterialAvg * 100.0 END AS PriceVsMaterialHistoricalAvgPct,
          CASE WHEN SupplierMaterialAvg > 0 THEN (UnitPriceEUR - SupplierMaterialAvg) / SupplierMaterialAvg * 100.0 END AS PriceVsSupplierMaterialHistoricalAvgPct,
          CASE WHEN CategoryAvg > 0 THEN (UnitPriceEUR - CategoryAvg) / CategoryAvg * 100.0 END AS PriceVsCategoryHistoricalAvgPct,
          CASE WHEN MaterialSd > 0 THEN (UnitPriceEUR - MaterialAvg) / MaterialSd END AS MaterialPriceZScore,
          CASE WHEN SupplierMaterialSd > 0 THEN (UnitPriceEUR - SupplierMaterialAvg) / SupplierMaterialSd END AS SupplierMaterialPriceZScore,
          CASE WHEN CategorySd > 0 THEN (UnitPriceEUR - CategoryAvg) / CategorySd END AS CategoryPriceZScore,
          CAST(coalesce(abs(var_pct) >= 20, FALSE) OR coalesce(abs(CASE WHEN MaterialSd > 0 THEN (UnitPriceEUR - MaterialAvg) / MaterialSd END) >= 3, FALSE)
            OR coalesce(abs(CASE WHEN SupplierMaterialSd > 0 THEN (UnitPriceEUR - SupplierMaterialAvg) / SupplierMaterialSd END) >= 3, FALSE) AS INT)
            AS RuleBasedExtremePriceFlag
        FROM price_hist""",
    "pscores": """
        SELECT *, CAST(PricingAnomalyScore >= 10 AS INT) AS PricingAnomalyFlag
        FROM (SELECT *, round(least(100.0, coalesce(abs(var_pct), 0.0) * 5.0), 2) AS PricingAnomalyScore FROM price_feat
              WHERE OrderYear = 2001 AND BenchmarkCoverageCount >= 1)""",
    "rscores": f"""
        SELECT *, CAST(SupplierRiskScore >= 50 AS INT) AS PredictedHighRiskFlag
        FROM (SELECT SupplierID, {_round("least(100.0, coalesce(FinancialRiskScore, 0) * 0.5::DOUBLE + coalesce(InvoiceExceptionPct, 0.0) * 0.5::DOUBLE)", 2)} AS SupplierRiskScore
              FROM risk WHERE PerformanceYear = 2001 AND SupplierID IS NOT NULL)""",
    "evidence": f"""
        SELECT *, CAST(CASE WHEN mav = 1 AND pricing <= 0 THEN spend ELSE 0.0 END AS DOUBLE) AS mav_open,
          (CASE WHEN mav = 1 AND pricing <= 0 THEN spend ELSE 0.0 END) * 0.03::DOUBLE AS mav_saving
        FROM (SELECT *, CASE WHEN capped > 0 THEN spend * (capped / (100.0 + capped)) ELSE 0.0 END AS pricing
          FROM (SELECT *, CASE WHEN sel IS NOT NULL THEN least(sel, 50.0) END AS capped FROM (SELECT *, CASE btype WHEN 'CONTRACT' THEN var_pct WHEN 'SUPPLIER_MATERIAL_HISTORY' THEN pv_sm
              WHEN 'MATERIAL_HISTORY' THEN pv_m END AS sel
            FROM (SELECT *, CASE WHEN hc = 1 AND var_pct > 0 AND (flag = 1 OR exc = 1) THEN 'CONTRACT' WHEN flag = 1 AND hsm = 1 AND pv_sm > 0 THEN 'SUPPLIER_MATERIAL_HISTORY'
                WHEN flag = 1 AND hm = 1 AND pv_m > 0 THEN 'MATERIAL_HISTORY' END AS btype
              FROM (SELECT p.POItemID, p.POID, p.POSupplierID AS SupplierID, p.CategoryID, p.MaterialID, coalesce(p.elig_c, 0) / 100.0::DOUBLE AS spend,
                  CAST(p.MaverickSpendFlag AS INT) AS mav, s.var_pct, s.PriceVsSupplierMaterialHistoricalAvgPct AS pv_sm, s.PriceVsMaterialHistoricalAvgPct AS pv_m,
                  coalesce(s.PricingAnomalyFlag, 0) AS flag, coalesce(s.PriceComplianceExceptionFlag, 0) AS exc, s.HasContractBenchmarkFlag AS hc,
                  s.HasSupplierMaterialHistoryFlag AS hsm, s.HasMaterialHistoryFlag AS hm, s.PricingAnomalyScore AS score, s.BenchmarkCoverageCount AS cov
                FROM fact_po p LEFT JOIN pscores s ON p.POItemID = s.POItemID
                WHERE year(p.OrderDate) = 2001 AND p.OrderDate <= {AS_OF} AND p.SpendEligibilityFlag)))))""",
    "opp": f"""
        SELECT o.*, CASE WHEN cat_spend > 0 THEN spend_y / cat_spend * 100.0 END AS share_pct,
          row_number() OVER (PARTITION BY CategoryID ORDER BY spend_y DESC, o.SupplierID) AS CategorySpendRank, r.SupplierRiskScore, r.PredictedHighRiskFlag
        FROM (SELECT *, {_round("pricing_y + mav_y", 2)} AS saving, CAST(sum(CAST(spend_y AS DECIMAL(28,2))) OVER (PARTITION BY CategoryID) AS DOUBLE) AS cat_spend,
            CASE WHEN items > 0 THEN CAST(anomalies AS DOUBLE) / items * 100.0 END AS PricingAnomalyRatePct,
            CASE WHEN spend_c > 0 THEN mav_spend / spend_c * 100.0 END AS MaverickSpendPct, CASE WHEN spend_y > 0 THEN pricing_y / spend_y * 100.0 END AS PricingOpportunityPct
          FROM (SELECT *, {_round(f"spend_c * {FACTOR}", 2)} AS spend_y, {_round(f"pricing_c * {FACTOR}", 2)} AS pricing_y, {_round(f"mav_c * {FACTOR}", 2)} AS mav_y
            FROM (SELECT SupplierID, CategoryID, count(*) AS items, count(DISTINCT POID) AS pos, count(DISTINCT MaterialID) AS materials, sum(flag) AS anomalies,
                CAST(round(sum(CAST(spend AS DECIMAL(28,8))), 2) AS DOUBLE) AS spend_c, CAST(round(sum(CAST(pricing AS DECIMAL(28,8))), 2) AS DOUBLE) AS pricing_c,
                CAST(round(sum(CAST(mav_saving AS DECIMAL(28,8))), 2) AS DOUBLE) AS mav_c,
                CAST(round(sum(CAST(CASE WHEN mav = 1 THEN spend ELSE 0 END AS DECIMAL(28,8))), 2) AS DOUBLE) AS mav_spend, round(avg(score), 4) AS avg_score
              FROM evidence GROUP BY 1, 2))) o LEFT JOIN rscores r ON o.SupplierID = r.SupplierID""",
    "prio": f"""
        SELECT *, CASE WHEN score >= 75 THEN 'CRITICAL' WHEN score >= 60 THEN 'HIGH' WHEN score >= 40 THEN 'MEDIUM' WHEN saving > 0 THEN 'LOW' ELSE 'NONE' END AS NegotiationPriority,
          CASE WHEN saving <= 0 THEN 'NONE' WHEN pricing_y > 0 AND mav_y > 0 AND abs(pricing_y - mav_y) / greatest(pricing_y, mav_y) <= 0.2::DOUBLE THEN 'MIXED'
               WHEN pricing_y >= mav_y THEN 'PRICING' ELSE 'MAVERICK' END AS PrimaryOpportunityDriver,
          CAST(saving >= 5000 AND score >= 40 AS INT) AS ActionableOpportunityFlag,
          row_number() OVER (ORDER BY saving DESC, score DESC, SupplierID, CategoryID) AS SavingsOpportunityRank,
          row_number() OVER (PARTITION BY CategoryID ORDER BY saving DESC, score DESC, SupplierID) AS CategorySavingsRank,
          row_number() OVER (ORDER BY score DESC, saving DESC, SupplierID, CategoryID) AS NegotiationPriorityRank
        FROM (SELECT *, CASE WHEN saving > 0 THEN {_round("0.0::DOUBLE + s1 * 0.45::DOUBLE + s2 * 0.20::DOUBLE + s3 * 0.15::DOUBLE + s4 * 0.10::DOUBLE + least(greatest(coalesce(SupplierRiskScore, 50.0::DOUBLE), 0.0), 100.0) * 0.05::DOUBLE + least(greatest(coalesce(share_pct, 0.0), 0.0), 100.0) * 0.05::DOUBLE", 2)} ELSE 0.0 END AS score
          FROM (SELECT *, percent_rank() OVER (ORDER BY saving) * 100.0 AS s1, percent_rank() OVER (ORDER BY spend_y) * 100.0 AS s2,
              percent_rank() OVER (ORDER BY PricingOpportunityPct NULLS FIRST) * 100.0 AS s3, percent_rank() OVER (ORDER BY MaverickSpendPct NULLS FIRST) * 100.0 AS s4 FROM opp))""",
    "ml_risk": f"""
        SELECT SupplierID, SupplierRiskScore, CAST(SupplierRiskScore >= 50 AS INT) AS PredictedHighRiskFlag, PredictionDate FROM (
          SELECT SupplierID, {_round("SupplierRiskScore / 2.0::DOUBLE", 2)} AS SupplierRiskScore, DATE '2001-06-30' AS PredictionDate FROM rscores
          UNION ALL SELECT SupplierID, SupplierRiskScore, DATE '2001-07-31' FROM rscores)""",
    "ml_price": f"""
        SELECT *, CAST(PricingAnomalyScore >= 10 AS INT) AS PricingAnomalyFlag FROM (
          SELECT POItemID, SupplierID, CategoryID, {_round("PricingAnomalyScore / 2.0::DOUBLE", 2)} AS PricingAnomalyScore, DATE '2001-06-30' AS PredictionDate FROM pscores
          UNION ALL SELECT POItemID, SupplierID, CategoryID, PricingAnomalyScore, DATE '2001-07-31' FROM pscores)""",
    "ml_opp": f"""
        SELECT * REPLACE ({_round("saving / 2.0::DOUBLE", 2)} AS saving), DATE '2001-06-30' AS PredictionDate FROM prio
        UNION ALL SELECT *, DATE '2001-07-31' AS PredictionDate FROM prio""",
    "cal": """
        SELECT CAST(unnest(generate_series(make_date(year(min(o_orderdate)), 1, 1), make_date(year(max(o_orderdate)) + 3, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d FROM orders""",
}

_NAMES = re.compile(r"\b(" + "|".join(sorted(CTES, key=len, reverse=True)) + r")\b")


def sql(body: str) -> str:
    """Prefix a SELECT with the named sub-results it (transitively) uses, in dependency order."""
    done: list[str] = []

    def need(text: str, inside: frozenset[str]) -> None:
        for name in dict.fromkeys(_NAMES.findall(text)):
            if name not in done and name not in inside:
                need(CTES[name], inside | {name})
                done.append(name)

    need(body, frozenset())
    if not done:
        return body
    return "WITH " + ", ".join(f"{n} AS ({CTES[n].strip()})" for n in done) + " " + body


def typed(body: str, columns: dict[str, str]) -> str:
    """Fix order and types of the output columns."""
    kinds = {"string": "VARCHAR", "long": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
    take = ", ".join(f"CAST({c} AS {kinds[t]}) AS {c}" for c, t in columns.items())
    return sql(f"SELECT {take} FROM ({body}) AS result")
