"""Proof of the data-quality rules: copies of the tables are damaged on known keys, and SQL counts what each rule must report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendline.operators import damage as DM
from spendline.operators import promotion as PR
from spendline.operators import quality as QL
from spendline.operators.joins import reconcile
from spendline.operators.opportunity import promote
from spendline.plans import checks as CK
from spendline.plans import mart as MT

ERROR, WARNING, Rule = QL.ERROR, QL.WARNING, QL.Rule
hit = DM.struck_sql


def _count(table: str, where: str) -> str:
    return f"SELECT count(*) FILTER ({where}) FROM {table}"


# ---------------------------------------------------------------------- keys and audit columns

def _key_counts(t: str) -> list[tuple[str, str, str, str]]:
    """Struck rows are repeated first; then a column of each key is emptied in other struck rows, repeats of these included."""
    keys, alternate, _, rows = CK.SOURCES[t]
    at, out = _row_key(keys), []
    for k in (keys, *alternate):
        name, lost = ", ".join(k), hit(at, f"null {k[-1]}")
        twice = f"CASE WHEN {hit(at, 'repeat')} THEN 2 ELSE 1 END"
        out += [(t, f"{name} not null", ERROR, f"SELECT coalesce(sum({twice}) FILTER ({lost}), 0) FROM {rows}"),
                (t, f"{name} unique", ERROR, f"SELECT coalesce(sum({twice}) FILTER (NOT {lost}), 0) - count(DISTINCT ({name})) FILTER (NOT {lost}) FROM {rows}")]
    return out


def _row_key(keys: list[str]) -> str:
    return keys[0] if len(keys) == 1 else " || '/' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)


def _row_column(keys: list[str]) -> Column:
    return F.col(keys[0]) if len(keys) == 1 else F.concat_ws("/", *[F.col(k).cast("string") for k in keys])


@CK._check("D06_seeded", *[r for t in CK.SOURCES for r in _key_counts(t)])
def _(m):
    frames = []
    for t, (keys, alternate, _, _rows) in CK.SOURCES.items():
        df = m[t].withColumn("__at", _row_column(keys))
        df = DM.repeated(df, "__at", "repeat")
        for k in (keys, *alternate):
            frames.append(QL.key_rule(DM.damaged(df, "__at", {f"null {k[-1]}": {k[-1]: F.lit(None)}}), t, k))
    return QL.results(frames)


AUDIT_KEYS = {"silver_category": ["CategoryID"], "silver_business_unit": ["BusinessUnitID"], "silver_buyer": ["BuyerID"], "silver_supplier": ["SupplierID"], "silver_material": ["MaterialID"],
              "silver_exchange_rate": ["Currency", "RateDate"], "silver_contract": ["ContractID"], "silver_po_spend": ["POItemID"], "silver_invoice_matching": ["InvoiceItemID"],
              "silver_savings_project": ["SavingsProjectID"], "silver_supplier_performance": ["SupplierID", "PerformanceYear"]}


def _audit_key(t: str) -> str:
    return _row_key(["ccy", "d"] if t == "silver_exchange_rate" else AUDIT_KEYS[t])


@CK._check("D07_seeded", *[r for t, v in CK.AUDITED.items() for r in (
    (t, "lineage complete", ERROR, _count(v, f"{hit(_audit_key(t), 'hash lost')} OR {hit(_audit_key(t), 'date lost')}")),
    (t, "record hash has 64 characters", ERROR, _count(v, f"{hit(_audit_key(t), 'hash cut')} AND NOT {hit(_audit_key(t), 'hash lost')}")))])
def _(m):
    def copy(t: str) -> DataFrame:
        df = m[t].withColumn("__at", _row_column(AUDIT_KEYS[t]))
        return DM.damaged(df, "__at", {"hash cut": {"SilverRecordHash": F.substring("SilverRecordHash", 1, 40)}, "hash lost": {"SilverRecordHash": F.lit(None)}, "date lost": {"SilverLoadDate": F.lit(None)}})

    return QL.results([CK.audit_rules(copy(t), t) for t in CK.AUDITED])


# ---------------------------------------------------------------------- references

def _edge_count(child: str, key: str) -> str:
    pk, rows = CK.SEEDED[child]
    broken = CK.BROKEN.get((child, key))
    return _count(rows, f"{hit(pk, key)} OR ({broken})" if broken else hit(pk, key))


@CK._check("D08_seeded", *[(c, f"{k} in {p}", ERROR, _edge_count(c, k)) for c, edges in CK.EDGES.items() for k, p, *_ in edges])
def _(m):
    frames = []
    for c, edges in CK.EDGES.items():
        changes = {k: {k: F.concat(F.lit("lost "), F.coalesce(F.col(k), F.lit("key")))} for k, *_ in edges}
        frames.append(QL.reference_rules(DM.damaged(m[c], CK.SEEDED[c][0], changes), c, CK.edges_of(m, c)))
    return QL.results(frames)


@CK._check("D09_seeded", *[(t, "Currency in silver_exchange_rate", ERROR, _count(CK.SEEDED[t][1], hit(CK.SEEDED[t][0], "currency"))) for t in CK.CURRENCY_TABLES])
def _(m):
    known = m["silver_exchange_rate"].select("Currency").distinct()
    return QL.results([QL.reference_rules(DM.damaged(m[t], CK.SEEDED[t][0], {"currency": {"Currency": F.lit("XXX")}}), t,
                                          [QL.Reference(("Currency",), known, ("Currency",), "silver_exchange_rate")]) for t in CK.CURRENCY_TABLES])


# ---------------------------------------------------------------------- row rules

@CK._check("D14_seeded", ("invoice_item", "net = quantity x price", ERROR, _count("invoice_items", f"{hit('InvoiceItemID', 'net')}")),
           ("invoice_item", "gross = net + tax", ERROR, _count("invoice_items", f"{hit('InvoiceItemID', 'net')} <> {hit('InvoiceItemID', 'gross')}")))
def _(m):
    prod = F.col("InvoicedQuantity").cast("double") * F.col("InvoiceUnitPrice").cast("double")
    df = DM.damaged(m["bronze_invoice_item"], "InvoiceItemID", {"net": {"NetAmount": F.col("NetAmount") + 1}, "gross": {"GrossAmount": F.col("GrossAmount") + 1}})
    return QL.results([QL.row_rules(df, "invoice_item", [Rule("net = quantity x price", QL.differ_rows("NetAmount", prod, 0.5)),
                                                         Rule("gross = net + tax", QL.differ_rows("GrossAmount", F.col("NetAmount") + F.col("TaxAmount"), 0.5))])])


@CK._check("D15_seeded", ("invoice_header", "disputed invoices have a reason", ERROR, _count("invoices", f"DisputeFlag AND {hit('InvoiceID', 'reason lost')}")),
           ("invoice_header", "only disputed invoices have a reason", ERROR, _count("invoices", f"NOT DisputeFlag AND {hit('InvoiceID', 'reason added')}")),
           ("invoice_item", "duplicate lines are labelled", ERROR, _count("invoice_items", hit("InvoiceItemID", "label"))))
def _(m):
    bad, why, twice = F.col("DisputeFlag"), F.col("DisputeReason"), F.col("DuplicateInvoiceLineFlag")
    head = DM.damaged(m["bronze_invoice_header"], "InvoiceID", {"reason lost": {"DisputeReason": F.when(~bad, why)}})
    head = DM.damaged(head, "InvoiceID", {"reason added": {"DisputeReason": F.when(~bad, "Price").otherwise(why)}})
    item = DM.damaged(m["bronze_invoice_item"], "InvoiceItemID", {"label": {"ThreeWayMatchStatus": F.when(twice, "MATCHED").otherwise("DUPLICATE_INVOICE")}})
    return QL.results([
        QL.row_rules(head, "invoice_header", [Rule("disputed invoices have a reason", bad & why.isNull()), Rule("only disputed invoices have a reason", ~bad & why.isNotNull())]),
        QL.row_rules(item, "invoice_item", [Rule("duplicate lines are labelled", twice != (F.col("ThreeWayMatchStatus") == "DUPLICATE_INVOICE"))])])


# ---------------------------------------------------------------------- reconciliation between layers

_SUMS = ("EligibleSpendEUR", "ContractCompliantSpendEUR", "MaverickSpendEUR")


@CK._check("D29_seeded", *[("fact_purchase_order", f"sum of {c}", ERROR, f"SELECT CAST(count(*) FILTER ({hit('POItemID', c)}) > 0 AS INT) FROM po") for c in _SUMS],
           ("fact_invoice", "sum of GrossAmountEUR", ERROR, f"SELECT CAST(count(*) FILTER ({hit('InvoiceItemID', 'gone')} AND gross_eur <> 0) > 0 AS INT) FROM inv"),
           ("fact_savings", "sum of RealizedSavingsEUR", ERROR, f"SELECT CAST(count(*) FILTER ({hit('SavingsProjectID', 'saving')}) > 0 AS INT) FROM savings"))
def _(m):
    m, more = m.planned, lambda c: F.coalesce(F.col(c), F.lit(0)) + 1      # noqa: E731
    po = DM.damaged(m["fact_purchase_order"], "POItemID", {c: {c: more(c)} for c in _SUMS})
    sav = DM.damaged(m["fact_savings"], "SavingsProjectID", {"saving": {"RealizedSavingsEUR": more("RealizedSavingsEUR")}})
    return QL.results([QL.sums_reconciled(po, m["silver_po_spend"], "fact_purchase_order", {c: c for c in _SUMS}),
                       QL.sums_reconciled(DM.removed(m["fact_invoice"], "InvoiceItemID", "gone"), m["silver_invoice_matching"], "fact_invoice", {"GrossAmountEUR": "GrossAmountEUR"}),
                       QL.sums_reconciled(sav, m["silver_savings_project"], "fact_savings", {"RealizedSavingsEUR": "RealizedSavingsEUR"})])


@CK._check("D30_seeded", ("fact_invoice", "order key in fact_purchase_order", ERROR, _count("fact_inv", f"POReferenceResolvedFlag AND {hit('InvoiceItemID', 'order key')}")),
           ("fact_invoice", "order id agrees", ERROR, _count("fact_inv", f"POReferenceResolvedFlag AND {hit('InvoiceItemID', 'order id')}")),
           ("fact_invoice", "category key agrees", ERROR, _count("fact_inv", f"POReferenceResolvedFlag AND {hit('InvoiceItemID', 'category')}")),
           ("fact_purchase_order", "yearly spend equals scorecard", ERROR, f"SELECT count(DISTINCT year(OrderDate)) FILTER ({hit('POItemID', 'spend')}) FROM fact_po"))
def _(m):
    m, same = m.narrow, F.col("POIDFactConsistencyFlag")
    inv = DM.damaged(m["fact_invoice"], "InvoiceItemID", {
        "order key": {"PurchaseOrderFactKey": F.col("PurchaseOrderFactKey") * 0 - 7}, "order id": {"POIDFactConsistencyFlag": F.when(same.isNotNull(), F.lit(False))},
        "category": {"CategoryKey": F.lit(-7)}})
    po = m["fact_purchase_order"]
    dear = DM.damaged(po, "POItemID", {"spend": {"EligibleSpendEUR": F.coalesce(F.col("EligibleSpendEUR"), F.lit(0)) + 1}})
    yearly = dear.groupBy(F.year("OrderDate").alias("Year")).agg(F.sum("EligibleSpendEUR").alias("Spend"))
    score = m["silver_supplier_performance"].groupBy(F.col("PerformanceYear").alias("Year")).agg(F.sum("EligibleSpendEUR").alias("Spend"))
    return QL.results([
        QL.reference_rules(inv, "fact_invoice", [QL.Reference(("PurchaseOrderFactKey",), po, ("PurchaseOrderFactKey",), "fact_purchase_order", True)]).withColumn("ValidationRule", F.lit("order key in fact_purchase_order")),
        QL.row_rules(inv, "fact_invoice", [Rule("order id agrees", ~same)]),
        QL.count_rule(QL.disagreements(inv, po, "POItemID", {"CategoryKey": "CategoryKey"}), "fact_invoice", "category key agrees"),
        QL.count_rule(reconcile(yearly, score, ["Year"], ["Spend"], 0.05).where("NOT ReconciledFlag"), "fact_purchase_order", "yearly spend equals scorecard")])


# ---------------------------------------------------------------------- prediction products

_SAVINGS = f"""(SELECT DISTINCT POSupplierID AS SupplierID, CategoryID FROM fact_po
    WHERE year(OrderDate) = {MT.SCORING_YEAR} AND OrderDate <= DATE '{MT.AS_OF}' AND SpendEligibilityFlag)"""
#: Transparent stand-ins of the fitted scores, whose rows SQL knows: (mart table, key in Spark, rows in SQL, key in SQL).
_PREDICTED = {"ml_supplier_risk_prediction": ("risk_scores", ["SupplierID"], "rscores"), "ml_pricing_anomaly_prediction": ("pricing_scores", ["POItemID"], "pscores"),
              "ml_savings_opportunity": ("prioritised", ["SupplierID", "CategoryID"], _SAVINGS)}
_VERSION = f"SELECT SupplierID FROM dim_supplier WHERE DATE '{MT.AS_OF}' BETWEEN EffectiveFromDate AND EffectiveToDate"


def _promoted(m, name: str) -> tuple[DataFrame, DataFrame]:
    table, grain, _ = _PREDICTED[name]
    source = m[table]
    if name == "ml_pricing_anomaly_prediction":
        source = source.select("POItemID", "SupplierID", "CategoryID", "PricingAnomalyScore", "PricingAnomalyFlag")
    po = m.narrow["fact_purchase_order"] if name == "ml_pricing_anomaly_prediction" else None
    return source, promote(source, m.dims(), MT.AS_OF, grain, "", po).withColumn("__at", _row_column(grain))


def _product_counts(name: str, seeded: bool) -> list[tuple[str, str, str, str]]:
    """What the gates of a product must report: nothing but suppliers without a version, or the seeded damage as well."""
    table, grain, rows = _PREDICTED[name]
    at = _row_key(grain)
    on = (lambda mark: hit(at, mark)) if seeded else (lambda mark: "FALSE")
    score, flag = {"risk_scores": ("SupplierRiskScore", "PredictedHighRiskFlag"), "pricing_scores": ("PricingAnomalyScore", "PricingAnomalyFlag"),
                   "prioritised": ("NegotiationPriorityScore", "ActionableOpportunityFlag")}[table]
    keys = {"risk_scores": ["SupplierKey"], "pricing_scores": ["PurchaseOrderFactKey", "CategoryKey", "MaterialKey"], "prioritised": ["CategoryKey"]}[table]
    label, none = ", ".join([*grain, "PredictionDate"]), f"SupplierID NOT IN ({_VERSION})"
    out = [(name, "source rows preserved", ERROR, _count(rows, on("repeat"))), (name, f"{label} not null", ERROR, "SELECT 0"), (name, f"{label} unique", ERROR, _count(rows, on("repeat")))]
    twice = lambda where: f"SELECT coalesce(sum(CASE WHEN {on('repeat')} THEN 2 ELSE 1 END) FILTER ({where}), 0) FROM {rows}"      # noqa: E731
    lost = lambda k: twice(f"{on(k)} OR {none}" if k == "SupplierKey" else on(k))       # noqa: E731
    out += [(name, f"{k} resolved", ERROR, lost(k)) for k in keys]
    if table != "risk_scores":
        out.append((name, "SupplierKey resolved", WARNING, twice(none)))
    out += [(name, f"{score} within 0 and 100", ERROR, twice(on("score"))), (name, f"{flag} is 0 or 1", ERROR, twice(on("flag")))]
    if table == "prioritised":
        out += [(name, "savings not negative", ERROR, twice(on("saving"))), (name, "components add up", ERROR, twice(f"{on('saving')} OR {on('parts')}")),
                (name, "SavingsOpportunityRank not null", ERROR, twice(on("rank"))), (name, "SavingsOpportunityRank unique", ERROR, _count(rows, f"{on('repeat')} AND NOT {on('rank')}"))]
        gone = hit("SupplierID", "gone") if seeded else "FALSE"
        out.append((name, "SupplierID in parent of SupplierID", ERROR, twice(f"NOT ({none}) AND (({gone}) OR SupplierID NOT IN (SELECT SupplierID FROM rscores))")))
    return out


def _gates(m, seeded: bool) -> DataFrame:
    frames = []
    for name, (table, grain, _) in _PREDICTED.items():
        product = MT.products()[name]
        source, rows = _promoted(m, name)
        parents = {"SupplierID": DM.removed(m["risk_scores"], "SupplierID", "gone") if seeded else m["risk_scores"]}
        if seeded:
            score, flag = [c.name.split(" ")[0] for c in product.rules[:2]]
            changes = {"score": {score: F.lit(101)}, "flag": {flag: F.lit(2)}} | {k: {k: F.lit(None)} for k in product.keys}
            if table == "prioritised":
                changes |= {"parts": {"AnnualizedPricingOpportunityEUR": F.col("AnnualizedPricingOpportunityEUR") + 1}, "saving": {"PotentialAnnualSavingsEUR": F.lit(-1)},
                            "rank": {"SavingsOpportunityRank": F.lit(None)}}
            rows = DM.damaged(DM.repeated(rows, "__at", "repeat"), "__at", changes)
        frames.append(PR.product_checks(source, rows.drop("__at"), product, parents))
    return QL.results([f.drop("ValidationStatus") for f in frames])


@CK._check("D33_products", *[r for name in _PREDICTED for r in _product_counts(name, False)])
def _(m):
    return _gates(m, False)


@CK._check("D33_seeded", *[r for name in _PREDICTED for r in _product_counts(name, True)])
def _(m):
    return _gates(m, True)


# ---------------------------------------------------------------------- alignment with the star schema, and with the source

def _alignment(m, seeded: bool) -> DataFrame:
    """Gold keys against the dimensions and the order fact (null-safe, the optional contract key too), and risk scores inside of savings."""
    po, category, frames = m.narrow["fact_purchase_order"], m["dim_category"], []
    _, price = _promoted(m, "ml_pricing_anomaly_prediction")
    _, saving = _promoted(m, "ml_savings_opportunity")
    if seeded:
        price = DM.damaged(price, "__at", {"category": {"CategoryKey": F.lit(-7)}, "material": {"MaterialKey": F.lit(-7)}, "contract": {"ContractKey": F.lit(-7)}})
        saving = DM.damaged(saving, "__at", {"category": {"CategoryKey": F.lit(-7)}, "risk": {"SupplierRiskScore": F.coalesce("SupplierRiskScore", F.lit(0.0)) + 1}})
    for rule, key in (("category", "CategoryKey"), ("material", "MaterialKey"), ("contract", "ContractKey")):
        frames.append(QL.count_rule(PR.drifted(price, po, ["POItemID"], [key]), "ml_pricing_anomaly_prediction", f"{rule} key agrees with the order"))
    frames.append(QL.count_rule(PR.drifted(saving, category, ["CategoryID"], ["CategoryKey"]), "ml_savings_opportunity", "category key agrees with the dimension"))
    frames.append(QL.count_rule(PR.drifted(saving, m["risk_scores"], ["SupplierID"], ["SupplierRiskScore"]), "ml_savings_opportunity", "risk score agrees"))
    return QL.results(frames)


def _alignment_counts(seeded: bool) -> list[tuple[str, str, str, str]]:
    on = (lambda at, mark: hit(at, mark)) if seeded else (lambda at, mark: "FALSE")
    two = _row_key(["SupplierID", "CategoryID"])
    return [*[("ml_pricing_anomaly_prediction", f"{r} key agrees with the order", ERROR, _count("pscores", on("POItemID", r))) for r in ("category", "material", "contract")],
            ("ml_savings_opportunity", "category key agrees with the dimension", ERROR, _count(_SAVINGS, on(two, "category"))),
            ("ml_savings_opportunity", "risk score agrees", ERROR, _count(_SAVINGS, f"{on(two, 'risk')} AND SupplierID IN (SELECT SupplierID FROM rscores)"))]


@CK._check("D34_keys", *_alignment_counts(False))
def _(m):
    return _alignment(m, False)


@CK._check("D34_seeded", *_alignment_counts(True))
def _(m):
    return _alignment(m, True)


def _source_counts(seeded: bool) -> list[tuple[str, str, str, str]]:
    out = []
    for name, total in (("ml_supplier_risk_prediction", "SupplierRiskScore"), ("ml_pricing_anomaly_prediction", "PricingAnomalyScore"), ("ml_savings_opportunity", "PotentialAnnualSavingsEUR")):
        _, grain, rows = _PREDICTED[name]
        gone = hit(_row_key(grain), "gone") if seeded else "FALSE"
        rows, amount = ("prio", "saving") if name == "ml_savings_opportunity" else (rows, total)
        out += [(name, "source rows preserved", ERROR, _count(rows, gone)), (name, f"sum of {total}", ERROR, f"SELECT CAST(coalesce(abs(sum({amount}) FILTER ({gone})), 0) > 0.05 AS INT) FROM {rows}")]
    return out


def _source(m, seeded: bool) -> DataFrame:
    frames = []
    for name, total in (("ml_supplier_risk_prediction", "SupplierRiskScore"), ("ml_pricing_anomaly_prediction", "PricingAnomalyScore"), ("ml_savings_opportunity", "PotentialAnnualSavingsEUR")):
        source, gold = _promoted(m, name)
        gold = DM.removed(gold, "__at", "gone") if seeded else gold
        frames += [QL.row_count_rule(gold, name, source, "source rows preserved"), QL.sums_reconciled(gold, source, name, {total: total})]
    return QL.results(frames)


@CK._check("D35_products", *_source_counts(False))
def _(m):
    return _source(m, False)


@CK._check("D35_seeded", *_source_counts(True))
def _(m):
    return _source(m, True)
