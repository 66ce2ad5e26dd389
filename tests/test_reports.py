"""Reports on hand-made tables with the cases that go wrong: nulls, ties, edges and fan-out."""

from decimal import Decimal as D

import pytest
from conftest import at
from pyspark.sql import functions as F

from ledgerlog.operators import quality as dq
from ledgerlog.operators import snapshots as snap
from ledgerlog.plans import heavy as h
from ledgerlog.plans import reports as r
from ledgerlog.schemas import BUSINESS, conform
from ledgerlog.session import fresh_path

AS_OF = "2026-04-20"


def table(spark, name, columns, rows):
    return conform(spark.createDataFrame(rows, columns), BUSINESS[name])


@pytest.fixture(scope="module")
def t(spark):
    agents = table(spark, "agents", "agent_id int, agent_code string, full_name string, branch string, is_active boolean", [
        (1, "AGT001", "Ann", "North", True), (2, "AGT002", "Bob", "North", True),  # Bob sells nothing
        (3, "AGT003", "Cid", "South", False),
    ])
    packages = table(spark, "packages", "package_id int, package_name string, category string", [
        (1, "Basic", "Life"), (2, "Plus", "Health")])
    customers = table(spark, "customers", "customer_id int, nric_last4 string, full_name string, email string", [
        (1, "1234", "Tan A", "a@gmail.com"), (2, "9999", "Lim B", "b@x.sg"), (3, "0000", "Ng C", "c@x.sg")])
    policies = table(
        spark, "policies",
        "policy_id int, policy_number string, customer_id int, package_id int, agent_id int, start_date string, "
        "end_date string, status string, sum_insured double, annual_premium double",
        [
            (1, "P1", 1, 1, 1, "2026-01-10", "2026-04-20", "Active", 1000.0, 100.0),  # two claims
            (2, "P2", 1, 2, 1, "2026-02-10", "2026-07-19", "Active", 2000.0, 300.0),  # no claim
            (3, "P3", 2, 1, 3, "2026-02-11", "2026-07-20", "Active", 0.0, 300.0),     # premium tie, zero cover
            (4, "P4", 3, 2, 1, "2024-01-01", "2025-01-01", "Cancelled", 500.0, 50.0),
        ],
    )
    claims = table(
        spark, "claims",
        "claim_id int, claim_number string, policy_id int, claim_date string, claim_amount double, "
        "approved_amount double, status string, category string, description string, processed_date string",
        [
            (1, "C1", 1, "2026-03-01", 10000.0, None, "Submitted", "Surgery", "Hospital stay", None),
            (2, "C2", 1, "2026-03-01", 12000.0, 9000.0, "Paid", "Surgery", "A vehicle", "2026-03-04"),
            (3, "C3", 3, "2026-03-02", 500.0, 400.0, "Approved", "Theft", "Lost bag", "2026-03-06"),
            (4, "C4", 3, "2026-03-05", 500.0, None, "Rejected", "Theft", "Water DAMAGE", "2026-03-06"),
        ],
    )
    transactions = table(
        spark, "transactions",
        "transaction_id int, transaction_ref string, policy_id int, transaction_date string, amount double, "
        "transaction_type string, payment_method string, status string",
        [
            (1, "T1", 1, "2026-03-31 23:59:59", 10.0, "PremiumPayment", None, "Completed"),
            (2, "T2", 1, "2026-04-01 00:00:00", 20.0, "PremiumPayment", "GIRO", "Completed"),
            (3, "T3", 2, "2026-01-05 10:00:00", 70.0, "ClaimPayout", "GIRO", "Completed"),
            (4, "T4", 3, "2026-04-02 00:00:00", 5.0, "PremiumPayment", "GIRO", "Failed"),
            (5, "T5", 3, "2026-04-02 09:00:00", 30.0, "PremiumPayment", "GIRO", "Completed"),
        ],
    )
    beneficiaries = table(spark, "beneficiaries", "beneficiary_id int, policy_id int, percentage double", [
        (1, 1, 50.0), (2, 1, 50.0), (3, 2, 30.0), (4, 2, 30.0), (5, 3, 100.0)])
    return {"agents": agents, "packages": packages, "customers": customers, "policies": policies, "claims": claims,
            "transactions": transactions, "beneficiaries": beneficiaries}


def rows(df, *cols):
    return [tuple(x) for x in df.select(*cols).collect()]


def test_b02_and_b05(t):
    got = rows(r.b02(t), "category", "total_policies", "unique_customers", "total_annual_premium", "active_count")
    assert got == [("Life", 2, 2, D("400.00"), 2), ("Health", 2, 2, D("350.00"), 1)]
    got = rows(r.b05(t), "agent_name", "policies_sold", "total_premium_generated", "cancelled_policies", "retention_pct")
    assert got == [("Ann", 3, D("450.00"), 1, D("66.7")), ("Bob", 0, None, 0, None)]


def test_b03_ties_and_days(t):
    assert rows(r.b03(t, AS_OF), "claim_number", "days_pending") == [("C1", 50)]


def test_b04_month_edges(t):
    got = rows(r.b04(t, AS_OF), "month", "transaction_type", "txn_count", "total_amount")
    assert got == [("2026-04", "PremiumPayment", 2, D("50.00")), ("2026-03", "PremiumPayment", 1, D("10.00")),
                   ("2026-01", "ClaimPayout", 1, D("70.00"))]


def test_b06_threshold_is_strict(t):
    assert rows(r.b06(t), "category", "total_claims", "total_approved", "approval_rate") == [
        ("Life", 1, D("9000.00"), D("100.0"))]


def test_b07_repeats_premium_and_b07b_does_not(t):
    literal = {x.customer_id: (x.num_policies, x.num_claims, x.total_premium_paid, x.risk_tier)
               for x in r.b07(t).collect()}
    once = {x.customer_id: (x.num_policies, x.num_claims, x.total_premium_paid, x.risk_tier)
            for x in r.b07b(t).collect()}
    assert literal == {1: (2, 2, D("500.00"), "High Risk"), 2: (1, 2, D("600.00"), "Medium Risk")}
    assert once == {1: (2, 2, D("400.00"), "High Risk"), 2: (1, 2, D("300.00"), "High Risk")}


def test_b08_ends_included(t):
    assert rows(r.b08(t, AS_OF), "policy_number", "days_to_expiry") == [("P1", 0), ("P2", 90)]
    assert rows(r.b08(t, "2026-04-20 09:00:00"), "policy_number") == [("P2",)]


def test_b09_b10(t):
    assert rows(r.b09(t), "transaction_ref", "agent_name") == [("T4", "Cid")]
    got = rows(r.b10(t), "branch", "num_agents", "total_policies", "total_customers", "total_premium", "total_claims")
    assert sorted(got) == [("North", 2, 3, 2, D("550.00"), 2), ("South", 1, 1, 1, D("600.00"), 2)]
    assert sorted(rows(r.b10b(t), "branch", "total_premium")) == [("North", D("450.00")), ("South", D("300.00"))]


def test_b11_b12(t):
    assert rows(r.b11(t), "customer_id", "current_package") == [(2, "Basic")]
    got = rows(r.b12(t), "category", "status", "avg_processing_days", "min_days")
    assert got == [("Surgery", "Paid", 3, 3), ("Theft", "Approved", 4, 4), ("Theft", "Rejected", 1, 1)]


def test_b16_b17(t):
    got = rows(r.b16(t), "policy_number", "total_claimed", "utilisation_pct")
    assert got == [("P1", D("22000.00"), D("2200.0")), ("P2", D("0.00"), D("0.0")), ("P4", D("0.00"), D("0.0"))]
    got = rows(r.b17(t), "policy_number", "num_beneficiaries", "total_pct", "allocation_status")
    assert got == [("P1", 2, D("100.00"), "OK"), ("P2", 2, D("60.00"), "NEEDS REVIEW")]


def test_b18_starts_at_the_filter(t):
    got = rows(r.b18(t, "2026-04-20"), F.col("txn_date").cast("string"), "daily_amount", "running_total")
    assert got == [("2026-04-02", D("30.00"), D("60.00")), ("2026-04-01", D("20.00"), D("30.00")),
                   ("2026-03-31", D("10.00"), D("10.00"))]


def test_b19_skips_months_without_new_policy(t):
    got = rows(r.b19(t, AS_OF), "report_month", "new_policies", "premium_collected", "claims_paid")
    assert got == [("2026-02", 2, D("0.00"), D("0.00")), ("2026-01", 1, D("0.00"), D("70.00"))]


def test_b20_any_case(t):
    assert rows(r.b20(t), "claim_number") == [("C2",), ("C1",), ("C4",)]


def test_heavy_shapes(t):
    assert h.p01(t, "%n%", "%i%").first().pair_count == D(2 * 1 * 2)
    got = rows(h.p02(t, 2), "policy_number", "claim_count", "max_claim", "total_txn")
    assert got == [("P2", 0, None, D("70.00")), ("P3", 2, D("500.00"), D("35.00"))]
    assert rows(h.p03(t), "customer_id") == []
    assert sorted(rows(h.p03b(t, 1), "customer_id")) == [(1,)]
    assert sorted(rows(h.p04(t), "policy_number")) == [("P1",), ("P2",)]
    got = {x.agent_name: x for x in h.p05(t, AS_OF).collect()}
    # P1 counts 2 claims x 2 transactions, P2 and P4 once each
    assert got["Ann"].total_premium == D(100 * 4 + 300 + 50) and got["Ann"].total_claims == D(22000 * 2)
    assert got["Ann"].packages_sold == "Basic, Plus" and got["Ann"].claim_count == 2
    once = {x.agent_name: x for x in h.p05b(t, AS_OF).collect()}
    assert once["Ann"].total_premium == D(450) and once["Cid"].rejected_claims == 1


def test_snapshot_steps(spark, t):
    new = snap.approve_claims(t["claims"], AS_OF)
    changed = {x.claim_id: (x.status, x.approved_amount, str(x.processed_date))
               for x in snap.changed_rows(t["claims"], new, new.columns).collect()}
    assert changed == {1: ("Approved", D("8500.00"), "2026-04-20")}
    one = snap.new_policy(spark, {"policy_number": "N1", "customer_id": 1, "annual_premium": "1800.00"}, AS_OF)
    assert one.first().payment_freq == "Monthly" and one.first().created_at == at("2026-04-20 00:00:00")
    with pytest.raises(ValueError):
        snap.new_policy(spark, {"no_such_column": 1}, AS_OF)
    batch = snap.payment_batch(t["policies"], AS_OF, k=2)
    assert [x.transaction_ref for x in batch.orderBy("transaction_ref").collect()] == [
        "TXN20260420SIM001", "TXN20260420SIM002"]
    assert batch.collect() == snap.payment_batch(t["policies"], AS_OF, k=2).collect()
    grown = snap.insert_rows(t["transactions"], snap.conform_transactions(batch))
    assert grown.count() == t["transactions"].count() + 2
    keys = batch.select(F.col("policy_id").alias("x"))
    keyed = snap.assign_keys(t["transactions"], keys, "transaction_id", "x", fresh_path(spark, "n"))
    assert sorted(x.transaction_id for x in keyed.collect()) == [6, 7]
    swapped = snap.replace_where(t["agents"], t["agents"].filter("agent_id = 1").withColumn("branch", F.lit("East")),
                                 "agent_id")
    assert {x.agent_id: x.branch for x in swapped.collect()} == {1: "East", 2: "North", 3: "South"}


def test_constraint_checks(spark, t):
    broken = dict(t)
    broken["claims"] = t["claims"].unionByName(
        t["claims"].limit(1).withColumn("policy_id", F.lit(99)).withColumn("status", F.lit("Odd")))
    bad = {x.check_name: (x.bad_keys, x.bad_rows) for x in dq.check_tables(broken).collect() if x.bad_rows}
    assert bad == {"claims.policy_id -> policies.policy_id": (1, 1), "claims.status": (1, 1)}
    assert not [x for x in dq.check_tables(t).collect() if x.bad_rows]


def test_constraint_checks_with_hot_and_null_keys(spark, t):
    """A third of all claims has one missing policy; NULL keys and values break nothing; parents may be unused."""
    broken = dict(t)
    claim = t["claims"].limit(1)
    many = claim.crossJoin(spark.range(3000).select(F.col("id").alias("n")))
    broken["claims"] = many.withColumn("policy_id", F.expr("CASE n % 3 WHEN 0 THEN 77 WHEN 1 THEN 1 END")).withColumn(
        "status", F.expr("CASE n % 4 WHEN 0 THEN 'Odd' WHEN 1 THEN \"it's\" WHEN 2 THEN 'Paid' END")).drop("n")
    broken["policies"] = t["policies"].where("policy_id = 1").unionByName(
        t["policies"].where("policy_id = 2").withColumn("agent_id", F.lit(None).cast("int")).withColumn("package_id", F.lit(5)))
    got = {x.check_name: (x.bad_keys, x.bad_rows) for x in dq.check_tables(broken).collect()}
    assert len(got) == 14
    assert {k: v for k, v in got.items() if v != (0, 0)} == {
        "claims.policy_id -> policies.policy_id": (1, 1000), "claims.status": (2, 1500),
        "policies.package_id -> packages.package_id": (1, 1),
        "transactions.policy_id -> policies.policy_id": (1, t["transactions"].where("policy_id NOT IN (1, 2)").count()),
        **({"beneficiaries.policy_id -> policies.policy_id": (
            t["beneficiaries"].where("policy_id NOT IN (1, 2)").select("policy_id").distinct().count(),
            t["beneficiaries"].where("policy_id NOT IN (1, 2)").count())}
           if t["beneficiaries"].where("policy_id NOT IN (1, 2)").count() else {})}


@pytest.mark.parametrize("missing", ["customers", "packages", "policies"])
def test_orphans_take_no_place_in_top_k_reports(spark, t, missing):
    """A row without its customer, package or policy must not push out one that has them."""
    some = dict(t)
    key = {"customers": "customer_id", "packages": "package_id", "policies": "policy_id"}[missing]
    some[missing] = t[missing].where(f"{key} <> 1")
    if "phone" not in some["customers"].columns:
        some["customers"] = some["customers"].withColumn("phone", F.lit("1"))
    for report in (r.b01, lambda x, k: r.b03(x, AS_OF, k=k), r.b11, r.b16, r.b20):
        full = [tuple(x) for x in report(some, k=50).collect()]
        for k in (1, 2):
            assert [tuple(x) for x in report(some, k=k).collect()] == full[:k]
    want = t["policies"].where("status = 'Active'").join(some["customers"].select("customer_id"), "customer_id").join(
        some["packages"].select("package_id"), "package_id").join(some["policies"].select("policy_id"), "policy_id").count()
    assert len(r.b01(some, k=50).collect()) == want
