"""Canonical procurement input tables derived from the TPC-H-like test tables.

The engine needs ERP-style inputs (suppliers, contracts, purchase orders, receipts, invoices,
exchange rates, savings projects). Each of them is a plain projection or a bounded fan-out of the
given tables, so every canonical table grows with its source, and every expression used here also
exists in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

# Fixed values
CURRENCIES = ["EUR", "USD", "GBP", "CHF", "PLN", "JPY", "CNY", "SEK"]
SUPPLIER_TYPES = ["Manufacturer", "Distributor", "Service Provider", "Logistics Provider",
                  "Utility Provider", "Contractor"]
BUYER_ROLES = ["Operational Buyer", "Senior Buyer", "Strategic Buyer", "Category Manager",
               "Procurement Manager"]
PROCUREMENT_TYPES = ["Direct", "Indirect", "Capital"]
PROJECT_STATUSES = ["Idea", "Validated", "Negotiation", "Implemented", "Cancelled"]

CUSTOMERS_PER_SUPPLIER = 15     # ratio of the two tables at every scale factor
BRANDS = 25                     # p_brand has the values Brand#1 .. Brand#25
ROWS_PER_TASK = 250_000         # lines that a task sorts by their order: some 40 MB


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _text(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def _days(start: str, offset: Column) -> Column:
    return F.date_add(F.to_date(F.lit(start)), offset.cast("int"))


class TpchSource:
    """Reads `<dir>/<table>.parquet` and exposes the canonical tables as lazy DataFrames."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{table}.parquet")

    # ------------------------------------------------------------------ master data

    def supplier(self) -> DataFrame:
        """Every fifth supplier arrives twice (an older row), and labels come in mixed case."""
        k = F.col("s_suppkey")
        base = (self.raw("supplier")
                .join(self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
                .join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")))
        kind = _pick(SUPPLIER_TYPES, k % 6)
        copies = F.when(k % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return (base.withColumn("copy", F.explode(copies)).select(
            _text(" s", k).alias("SupplierID"),
            F.concat(F.when(F.col("copy") == 1, F.lit(" Old  ")).otherwise(F.lit("  ")),
                     F.col("s_name"), F.lit("   Ltd ")).alias("SupplierName"),
            F.when(k % 2 == 0, F.lower(kind)).otherwise(F.upper(kind)).alias("SupplierType"),
            F.col("n_name").alias("Country"),
            F.col("r_name").alias("Region"),
            (k % 3 == 0).alias("PreferredSupplier"),
            (k % 7 == 0).alias("StrategicSupplier"),
            F.when(k % 4 == 0, "A").when(k % 4 == 1, "B").when(k % 4 == 2, "C").alias("ESGRating"),
            F.floor((F.col("s_acctbal") + 1000.0) / 110.0).cast("int").alias("FinancialRiskScore"),
            _days("1994-01-01", k % 365).alias("CreatedDate"),
            F.when(k % 11 == 0, "inactive").otherwise("ACTIVE").alias("Status"),
            F.lit("ERP").alias("SourceSystem"),
            F.when(F.col("copy") == 1, F.to_timestamp(F.lit("2001-07-01 00:00:00")))
             .otherwise(F.to_timestamp(F.lit("2001-08-01 00:00:00"))).alias("IngestionTimestamp"),
            F.to_date(F.lit("2001-08-01")).alias("LoadDate"),
            F.sha2(F.concat(k.cast("string"), F.lit("-"), F.col("copy").cast("string")), 256)
             .alias("SourceRecordHash"),
        ))

    def category(self) -> DataFrame:
        n = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
        return (self.raw("part").groupBy("p_brand").agg(F.count("*").alias("MaterialCount"))
                .select(_text("cat-", n).alias("CategoryID"),
                        F.concat(F.lit(" "), F.col("p_brand"), F.lit("  goods ")).alias("CategoryName"),
                        _text("Group ", n % 4).alias("CommodityGroup"),
                        F.upper(_pick(PROCUREMENT_TYPES, n % 3)).alias("ProcurementType"),
                        _text("Manager ", n % 7).alias("CategoryManager")))

    def business_unit(self) -> DataFrame:
        return self.raw("region").select(
            _text("bu", F.col("r_regionkey")).alias("BusinessUnitID"),
            F.concat(F.col("r_name"), F.lit("  unit")).alias("BusinessUnitName"),
            _text("Country ", F.col("r_regionkey")).alias("Country"),
            F.col("r_name").alias("Region"))

    def buyer(self) -> DataFrame:
        k = F.col("k")
        return (self.raw("customer").groupBy((F.col("c_custkey") % 30).alias("k"))
                .agg(F.min("c_name").alias("name"))
                .select(_text("b", k).alias("BuyerID"), F.col("name").alias("BuyerName"),
                        F.concat(F.lit("b"), k.cast("string"), F.lit("@example.org")).alias("Email"),
                        _text("Department ", k % 3).alias("Department"),
                        F.upper(_pick(BUYER_ROLES, k % 5)).alias("BuyerRole"),
                        _text("bu", k % 5).alias("BusinessUnitID")))

    def material(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.raw("part").select(
            _text("m", k).alias("MaterialID"),
            F.col("p_name").alias("MaterialDescription"),
            _text("cat-", F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")).alias("CategoryID"),
            F.col("p_retailprice").cast("decimal(18,2)").alias("StandardCost"),
            F.lit("ea").alias("UnitOfMeasure"),
            F.col("p_type").alias("Manufacturer"),
            F.when(k % 13 == 0, "INACTIVE").otherwise("active").alias("Status"))

    def exchange_rate(self) -> DataFrame:
        """Daily rates from 60 days after the first order to 60 days before the last one.

        CHF lacks ten days inside the range, so that an unresolved gap exists.
        """
        span = (self.raw("orders")
                .agg(F.date_add(F.min(F.to_date("o_orderdate")), 60).alias("first"),
                     F.date_sub(F.max(F.to_date("o_orderdate")), 60).alias("last")))
        codes = F.array(*[F.struct(F.lit(i).alias("k"), F.lit(c).alias("ccy"))
                          for i, c in enumerate(CURRENCIES)])
        day = F.datediff("RateDate", "first")
        rate = F.when(F.col("c.k") == 0, F.lit(1)).otherwise(
            (F.lit(500) + F.col("c.k") * 100 + (day * 7 + F.col("c.k") * 13) % 101) / F.lit(1000))
        gap = (F.col("c.ccy") == "CHF") & (day >= 1000) & (day < 1010)
        return (span.select("first", F.explode(F.sequence("first", "last")).alias("RateDate"))
                .select("first", "RateDate", F.explode(codes).alias("c"))
                .where(~gap)
                .select("RateDate", F.lower("c.ccy").alias("Currency"),
                        rate.cast("decimal(12,6)").alias("ExchangeRateEUR")))

    def contract(self) -> DataFrame:
        """One contract per supplier and category: a fixed fan-out of 25 rows per supplier.

        Suppliers fit a file split or two, their contracts do not: the narrow keys are dealt out before they fan out.
        """
        k, n = F.col("s_suppkey"), F.col("n")
        start = _days("1995-01-01", (k * 37 + n * 11) % 1200)
        end = F.date_add(start, (F.lit(1094) + (k % 2) * 365).cast("int"))
        as_of = F.to_date(F.lit("2001-07-31"))
        status = (F.when((k + n) % 17 == 0, "ACTIVE").when(start > as_of, "future")
                  .when(end < as_of, "expired").otherwise("Active"))
        suppliers = self.raw("supplier").select("s_suppkey").repartition(self.spark.sparkContext.defaultParallelism, "s_suppkey")
        return (suppliers.select("s_suppkey", F.explode(F.sequence(F.lit(1), F.lit(BRANDS))).alias("n"))
                .select(F.concat(F.lit("k-"), k.cast("string"), F.lit("-"), n.cast("string")).alias("ContractID"),
                        _text("s", k).alias("SupplierID"), _text("cat-", n).alias("CategoryID"),
                        start.alias("ContractStartDate"), end.alias("ContractEndDate"),
                        F.when(k % 10 == 3, F.lit("eur")).otherwise(F.lower(_pick(CURRENCIES, k % 8))).alias("Currency"),
                        (contract_price(k, n) * 1000).cast("decimal(18,2)").alias("ContractValue"),
                        contract_price(k, n).alias("NegotiatedUnitPrice"),
                        _text("b", (k + n) % 30).alias("ContractOwnerBuyerID"),
                        _text("Owner ", (k + n) % 30).alias("ContractOwner"),
                        _pick(["frame AGREEMENT", "spot BUY", "VOLUME contract"], (k + n) % 3).alias("ContractType"),
                        status.alias("ContractStatus"),
                        (F.lit(30) + (k % 3) * 15).cast("int").alias("PaymentTermsDays"),
                        ((k + n) % 2 == 0).alias("AutoRenewalFlag")))

    # ------------------------------------------------------------------ transactions

    def po_header(self) -> DataFrame:
        k, c = F.col("o_orderkey"), F.col("o_custkey")
        return self.raw("orders").select(
            _text("PO", k).alias("POID"),
            _text("S", buyer_supplier(c)).alias("SupplierID"),
            _text("B", c % 30).alias("BuyerID"), _text("BU", c % 5).alias("BusinessUnitID"),
            F.to_date("o_orderdate").alias("OrderDate"),
            _pick(CURRENCIES, buyer_supplier(c) % 8).alias("Currency"),
            order_status().alias("POStatus"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("TotalAmount"),
            F.when(k % 9 == 0, "MISMATCH").otherwise("MATCHED").alias("AmountReconciliationStatus"))

    def numbered_lines(self) -> DataFrame:
        """Order lines numbered within their order, with the columns of their order and part: what is worth storing.

        The part joins the raw lines, before any other column widens them; keys of several part rows carry these as a list until the lines
        are numbered, and lines without a part are counted in the numbers and dropped behind them. One shuffle on the order key, into
        partitions of a bounded number of rows, then serves the numbering, the join with orders and a table that is clustered by order.
        Texts and prices follow from these columns row by row (`priced`), so readers that need none of them pay for none.
        """
        order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
                 "l_quantity", "l_discount", "l_tax"]
        lines, brand = self.raw("lineitem"), F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
        parts = (self.raw("part").groupBy("p_partkey").agg(F.collect_list(F.struct(brand.alias("n"))).alias("several"))
                 .select("p_partkey", F.col("several")[0]["n"].alias("n"), F.when(F.size("several") > 1, F.col("several")).alias("several"), F.lit(True).alias("found")))
        tasks = max(self.spark.sparkContext.defaultParallelism, lines.count() // ROWS_PER_TASK)
        numbered = (lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").drop("p_partkey")
                    .repartition(tasks, "l_orderkey")
                    .withColumn("rn", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order))))
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return (numbered
                .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
                .where("found")
                .select("l_orderkey", *order, "l_returnflag", "l_linestatus", "rn", "o_custkey", F.to_date("o_orderdate").alias("OrderDate"),
                        F.inline(F.coalesce("several", F.array(F.struct("n"))))))

    def priced(self, numbered: DataFrame) -> DataFrame:
        """Numbered lines with supplier, price, amount, status and the names of line and order."""
        pick = (F.col("l_orderkey") * 7 + F.col("l_partkey") + F.col("l_linenumber")) % 10
        amount, quantity = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_quantity").cast("decimal(18,3)")
        step = ((F.col("l_linenumber") - 4) * 125).cast("decimal(10,0)") / F.lit(10000).cast("decimal(10,0)")
        agreed = F.round(contract_price(F.col("sup"), F.col("n")) * (F.lit(1) + step), 4)
        return (numbered
                .withColumns({"sup": buyer_supplier(F.col("o_custkey")), "m": pick, "qty": quantity})
                .withColumn("price", F.when(F.col("m") >= 6, agreed).otherwise(F.round(amount / F.col("qty"), 4))
                            .cast("decimal(18,4)"))
                .withColumns({
                    "amount": F.when(F.col("m") >= 6, F.round(F.col("price") * F.col("qty"), 2)).otherwise(amount)
                    .cast("decimal(18,2)"),
                    "POItemID": F.concat(F.lit("PO"), F.col("l_orderkey").cast("string"), F.lit("-"),
                                         F.col("rn").cast("string")),
                    "POID": _text("PO", F.col("l_orderkey")),
                    "ItemStatus": item_status(),
                }))

    def lines(self) -> DataFrame:
        """Order lines numbered within their order, with all columns that the tables below need."""
        return self.priced(self.numbered_lines())

    def po_item(self, lines: DataFrame | None = None) -> DataFrame:
        lines = self.lines() if lines is None else lines
        m, n, sup = F.col("m"), F.col("n"), F.col("sup")
        contract = lambda s, c: F.concat(F.lit("K-"), s.cast("string"), F.lit("-"), c.cast("string"))
        contract_id = (F.when(m <= 1, F.lit(None)).when(m == 2, contract(sup + 1000000, n))
                       .when(m == 3, contract(F.col("l_suppkey"), n))
                       .when(m == 4, contract(sup, n % BRANDS + 1)).otherwise(contract(sup, n)))
        scenario = (F.when(m <= 1, "NO_CONTRACT_REFERENCE").when(m <= 4, "INVALID_DATE_CONTRACT")
                    .otherwise("COMPLIANT_CONTRACT"))
        return lines.select(
            "POItemID", "POID", F.col("rn").alias("POLineNumber"),
            _text("M", F.col("l_partkey")).alias("MaterialID"), _text("CAT-", n).alias("CategoryID"),
            contract_id.alias("ContractID"), F.col("qty").alias("Quantity"), F.lit("EA").alias("OrderUnit"),
            F.col("price").alias("UnitPrice"), F.col("amount").alias("LineAmount"),
            _pick(CURRENCIES, sup % 8).alias("Currency"),
            F.date_add("OrderDate", (F.lit(30) + F.col("l_linenumber") * 5).cast("int")).alias("RequestedDeliveryDate"),
            F.col("ItemStatus").alias("POItemStatus"), scenario.alias("SimulationContractScenario"),
            (F.col("l_discount") >= 0.095).alias("SimulationPriceAnomalyFlag"))

    def goods_receipt(self, lines: DataFrame | None = None) -> DataFrame:
        """No receipt, one full, one half, or two halves per line, by a slice of the line key."""
        lines = self.lines() if lines is None else lines
        k = (F.col("l_orderkey") + F.col("l_linenumber")) % 10
        lag = F.pmod(F.datediff(F.to_date("l_shipdate"), F.col("OrderDate")), F.lit(60))
        first = F.date_add("OrderDate", lag + 5)
        half = F.round(F.col("qty") / 2, 3).cast("decimal(18,3)")
        row = lambda seq, day, qty: F.struct(F.lit(seq).alias("seq"), day.alias("day"), qty.alias("qty"))
        receipts = (F.when(k <= 2, F.array(row(1, first, half),
                                           row(2, F.date_add(first, 10), (F.col("qty") - half).cast("decimal(18,3)"))))
                    .when(k == 3, F.array(row(1, first, half)))
                    .otherwise(F.array(row(1, first, F.col("qty")))))
        late = F.greatest(F.lit(0), F.datediff("r.day", F.date_add("OrderDate", (F.lit(30) + F.col("l_linenumber") * 5).cast("int"))))
        return (lines.where((k != 0) & (F.col("ItemStatus") != "Cancelled"))
                .select("*", F.explode(receipts).alias("r"))
                .select(F.concat(F.lit("GR-"), F.col("POItemID"), F.lit("-"), F.col("r.seq").cast("string")).alias("GoodsReceiptID"),
                        "POID", "POItemID", F.col("r.seq").alias("ReceiptSequence"),
                        _text("M", F.col("l_partkey")).alias("MaterialID"), _text("S", F.col("sup")).alias("SupplierID"),
                        _text("BU", F.col("o_custkey") % 5).alias("BusinessUnitID"),
                        F.col("r.day").alias("ReceiptDate"), F.col("r.qty").alias("QuantityReceived"),
                        F.lit("EA").alias("UnitOfMeasure"), F.lit("Posted").alias("ReceiptStatus"),
                        ((k > 3) | (F.col("r.seq") == 2)).alias("DeliveryCompleteFlag"),
                        (late > 0).alias("IsLateReceipt"), late.alias("DaysLate")))

    def invoice_header(self) -> DataFrame:
        """One invoice per live order; a slice of them was entered twice."""
        k, c = F.col("o_orderkey"), F.col("o_custkey")
        date = F.date_add(F.to_date("o_orderdate"), 45)
        copies = F.when(k % 40 == 7, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
        dup = F.col("dup")
        return (self.raw("orders").where(k % 20 != 0).select("*", F.explode(copies).alias("dup")).select(
            invoice_id(k, dup).alias("InvoiceID"), _text("N", k).alias("InvoiceNumber"), _text("PO", k).alias("POID"),
            _text("S", F.when(k % 101 == 0, F.lit(0).cast("long")).otherwise(buyer_supplier(c))).alias("SupplierID"),
            _text("BU", c % 5).alias("BusinessUnitID"), date.alias("InvoiceDate"),
            F.date_add(date, 2).alias("PostingDate"),
            F.date_add(date, (F.lit(30) + (buyer_supplier(c) % 3) * 15).cast("int")).alias("DueDate"),
            _pick(CURRENCIES, buyer_supplier(c) % 8).alias("Currency"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("TotalInvoiceAmount"),
            F.when(k % 6 == 0, "Open").otherwise("Posted").alias("InvoiceStatus"),
            F.when(k % 6 == 0, "Unpaid").otherwise("Paid").alias("PaymentStatus"),
            (F.lit(30) + (buyer_supplier(c) % 3) * 15).cast("int").alias("PaymentTermsDays"),
            (k % 23 == 3).alias("DisputeFlag"),
            F.when(k % 23 == 3, "Price").alias("DisputeReason"),
            dup.alias("DuplicateInvoiceFlag"),
            F.when(dup, invoice_id(k, F.lit(False))).alias("OriginalInvoiceID"),
            F.lit("MATCHED").alias("AmountReconciliationStatus")))

    def invoice_item(self, lines: DataFrame | None = None) -> DataFrame:
        lines = self.lines() if lines is None else lines
        k, part = F.col("l_orderkey"), F.col("l_partkey")
        copies = F.when(k % 40 == 7, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
        dup = F.col("dup")
        tax = F.col("l_tax").cast("decimal(5,4)")
        price = F.round(F.col("price") * (F.lit(96).cast("decimal(5,0)") / F.lit(100).cast("decimal(5,0)") + tax), 4).cast("decimal(18,4)")
        qty = F.when(part % 9 == 0, F.round(F.col("qty") * F.lit("1.05").cast("decimal(5,2)"), 3)).otherwise(F.col("qty")).cast("decimal(18,3)")
        live = (k % 20 != 0) & ((k + part) % 8 != 7) & (F.col("ItemStatus") != "Cancelled")
        item = lambda d: F.concat(F.lit("II-"), F.col("POItemID"), F.when(d, F.lit("-D")).otherwise(F.lit("")))
        return (lines.where(live).select("*", F.explode(copies).alias("dup"))
                .withColumns({"iprice": price, "iqty": qty})
                .withColumn("net", F.round(F.col("iprice") * F.col("iqty"), 2).cast("decimal(18,2)"))
                .withColumn("tax", F.round(F.col("net") * tax, 2).cast("decimal(18,2)"))
                .select(item(dup).alias("InvoiceItemID"), invoice_id(k, dup).alias("InvoiceID"),
                        F.col("rn").alias("InvoiceLineNumber"), "POID",
                        F.when(part % 97 == 0, F.concat(F.lit("X"), F.col("POItemID"))).otherwise(F.col("POItemID")).alias("POItemID"),
                        _text("M", part).alias("MaterialID"), _text("CAT-", F.col("n")).alias("CategoryID"),
                        F.lit(None).cast("string").alias("ContractID"),
                        F.col("iqty").alias("InvoicedQuantity"), F.lit("EA").alias("UnitOfMeasure"),
                        F.col("price").alias("POUnitPrice"), F.col("iprice").alias("InvoiceUnitPrice"),
                        F.col("net").alias("NetAmount"), tax.alias("TaxRate"), F.col("tax").alias("TaxAmount"),
                        (F.col("net") + F.col("tax")).cast("decimal(18,2)").alias("GrossAmount"),
                        _pick(CURRENCIES, F.col("sup") % 8).alias("Currency"),
                        F.col("qty").alias("ReceivedQuantityAtInvoiceDate"),
                        F.when(dup, "DUPLICATE_INVOICE").otherwise("MATCHED").alias("ThreeWayMatchStatus"),
                        dup.alias("DuplicateInvoiceLineFlag"),
                        F.when(dup, item(F.lit(False))).alias("OriginalInvoiceItemID")))

    def savings_project(self) -> DataFrame:
        k = F.col("c_custkey")
        sup, n = buyer_supplier(k), k % BRANDS + 1
        status = _pick(PROJECT_STATUSES, k % 5)
        created = _days("1995-06-01", (k * 13) % 2200)
        start, planned = F.date_add(created, 30), F.date_add(created, (F.lit(90) + k % 300).cast("int"))
        base = (F.abs(F.col("c_acctbal").cast("decimal(18,2)")) * 10).cast("decimal(20,2)")
        part = lambda c, num, den: F.round(c * num / F.lit(den).cast("decimal(6,0)"), 2).cast("decimal(20,2)")
        forecast = part(base, F.lit(8).cast("decimal(6,0)"), 100)
        approved = part(forecast, F.lit(9).cast("decimal(6,0)"), 10)
        realized = part(approved, (F.lit(5) + k % 10).cast("decimal(6,0)"), 10)
        done, dropped = k % 5 == 3, k % 5 == 4
        return self.raw("customer").select(
            _text(" sp", k).alias("SavingsProjectID"), F.concat(F.col("c_name"), F.lit("  saving ")).alias("SavingsProjectName"),
            _text("s", sup).alias("SupplierID"), _text("cat-", n).alias("CategoryID"),
            _text(" b", k % 30).alias("BuyerID"), _text("bu", k % 5).alias("BusinessUnitID"),
            F.when(k % 4 == 0, F.lit(" ")).when(k % 4 == 1, F.concat(F.lit("k-"), sup.cast("string"), F.lit("-"), (n % BRANDS + 1).cast("string")))
             .otherwise(F.concat(F.lit("k-"), sup.cast("string"), F.lit("-"), n.cast("string"))).alias("ContractID"),
            F.col("c_mktsegment").alias("SavingsType"), F.upper(status).alias("ProjectStatus"),
            _text("l", F.floor(k / 5) % 4).alias("SavingsLevel"),
            F.when(dropped, "REJECTED").when(k % 5 <= 1, "pending").otherwise("approved").alias("ApprovalStatus"),
            created.alias("ProjectCreatedDate"), start.alias("PlannedStartDate"), planned.alias("PlannedCompletionDate"),
            F.when(done, F.date_add(planned, (k % 41 - 20).cast("int"))).alias("ActualCompletionDate"),
            F.when(dropped, F.date_add(start, 50)).alias("CancellationDate"),
            F.lower(_pick(CURRENCIES, sup % 8)).alias("Currency"), base.alias("BaselineSpend"),
            forecast.alias("ForecastedSavings"), approved.alias("ApprovedSavings"),
            F.when(done, realized).otherwise(F.lit(0)).cast("decimal(20,2)").alias("RealizedSavings"),
            (k % 2 == 0).alias("RecurringSavingsFlag"),
            F.to_timestamp(F.lit("2001-08-01 00:00:00")).alias("IngestionTimestamp"),
            F.to_date(F.lit("2001-08-01")).alias("SourceExtractDate"))


def buyer_supplier(custkey: Column) -> Column:
    """The supplier an order goes to: a fixed number of customers share one supplier."""
    return F.floor(custkey / CUSTOMERS_PER_SUPPLIER).cast("long")


def contract_price(supkey: Column, brand: Column) -> Column:
    return (F.lit(1000) + (supkey % 50) * 10 + brand).cast("decimal(18,4)")


def order_status() -> Column:
    return (F.when(F.col("o_orderkey") % 20 == 0, "Cancelled").when(F.col("o_orderstatus") == "O", "Open")
            .when(F.col("o_orderstatus") == "F", "Closed").otherwise("Partially Received"))


def item_status() -> Column:
    return (F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7), "Cancelled")
            .when(F.col("l_linestatus") == "O", "Open")
            .when(F.col("l_returnflag") == "A", "Partially Received")
            .when(F.col("l_returnflag") == "N", "Fully Received").otherwise("Closed"))


def invoice_id(orderkey: Column, dup: Column) -> Column:
    return F.concat(F.lit("INV"), orderkey.cast("string"), F.when(dup, F.lit("-D")).otherwise(F.lit("")))
