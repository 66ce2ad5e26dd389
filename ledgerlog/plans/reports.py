"""Business reports over the seven tables (B-01..B-20).

Tables come in as a dict. Primary keys are unique as declared, so a one-to-many
join is replaced by a join with the pre-aggregated detail, and the sums a literal
fan-out would repeat are multiplied instead. No report forms the fanned-out rows.
Long sorted results end their order in a unique column, so that a range partition can
be cut inside a frequent value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import (
    MONEY_TO_SUM,
    allocation_status,
    count_where,
    days_between,
    exact_avg,
    month_of,
    risk_tier,
    safe_pct,
    sum0,
)
from ..functions.text import any_like
from ..functions.timewin import (
    When,
    date_lit,
    date_window,
    moment,
    ts_lit,
    years_before,
)
from ..operators.aggregates import day_stats, monthly_stats
from ..operators.joins import attach_aggs, fetch, star_join, update_from, with_matches
from ..operators.topk import top_k
from ..operators.windows import running_total

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Codes:
    """Status values the reports select on."""

    active: str = "Active"
    lapsed: str = "Lapsed"
    cancelled: str = "Cancelled"
    pending_claims: tuple[str, ...] = ("Submitted", "UnderReview")
    approved_claims: tuple[str, ...] = ("Approved", "Paid")
    rejected_claim: str = "Rejected"
    completed: str = "Completed"
    failed: str = "Failed"
    premium_payment: str = "PremiumPayment"
    claim_payout: str = "ClaimPayout"


CODES = Codes()


def claims_per_policy(claims: DataFrame, *more: Column) -> DataFrame:
    """One row per policy with claims: their number and amount."""
    return claims.groupBy("policy_id").agg(
        F.count("*").alias("n_claims"), F.sum("claim_amount").alias("claimed"), *more
    )


def fan_out(count: str) -> Column:
    """Rows a left join with ``count`` matches produces."""
    return F.greatest(F.coalesce(F.col(count), F.lit(0)), F.lit(1))


def _named_customers(t: Tables, *cols: str | Column) -> DataFrame:
    return t["customers"].select("customer_id", *cols)


def _named_packages(t: Tables) -> DataFrame:
    return t["packages"].select("package_id", "package_name", F.col("category").alias("package_category"))


def _named_agents(t: Tables) -> DataFrame:
    return t["agents"].select("agent_id", F.col("full_name").alias("agent_name"))


def b01(t: Tables, codes: Codes = CODES, k: int = 20) -> DataFrame:
    """Customers with active policies, first by name.

    The first k are found on keys and names alone; the other columns are fetched for them.
    """
    active = t["policies"].filter(F.col("status") == codes.active)
    keys = with_matches(active.select("policy_id", "policy_number", "customer_id", "package_id"),
                        [(t["packages"], "package_id")])
    first = top_k(star_join(keys, [(_named_customers(t, "full_name"), "customer_id")]), ["full_name", "policy_number"], k)
    rows = fetch(first, [
        (t["policies"].select("policy_id", "status", "annual_premium"), "policy_id"),
        (_named_customers(t, "email", "phone"), "customer_id"), (_named_packages(t), "package_id"),
    ])
    return top_k(rows, ["full_name", "policy_number"], k).select(
        "customer_id", "full_name", "email", "phone", "policy_number", "status", "annual_premium",
        "package_name", F.col("package_category").alias("category"),
    )


def b02(t: Tables, codes: Codes = CODES) -> DataFrame:
    """Key figures per package category."""
    rows = star_join(t["policies"], [(_named_packages(t), "package_id")])
    return (
        rows.groupBy(F.col("package_category").alias("category"))
        .agg(
            F.count("policy_id").alias("total_policies"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.sum("annual_premium").alias("total_annual_premium"),
            exact_avg("sum_insured", MONEY_TO_SUM).alias("avg_sum_insured"),
            count_where(F.col("status") == codes.active).alias("active_count"),
            count_where(F.col("status") == codes.lapsed).alias("lapsed_count"),
        )
        .orderBy(F.col("total_annual_premium").desc())
    )


def _first_claims(t: Tables, claims: DataFrame, order: Sequence[Column | str], wanted: Sequence[Column | str], k: int,
                  policy: Sequence[str], name: str | Column) -> DataFrame:
    """The first k claims of an order over ``claim_*`` columns, with their policy, customer and package.

    They are found on keys and order columns; claims whose policy, customer or package is missing go there. Then
    whole claims are read for the k keys, and the rest is fetched for them.
    """
    ordered = ["claim_id", "claim_date", "claim_amount", "policy_id"]
    keys = star_join(claims.select(*ordered), [(t["policies"].select("policy_id", "customer_id", "package_id"), "policy_id")])
    keys = with_matches(keys, [(t["customers"], "customer_id"), (t["packages"], "package_id")])
    first = top_k(keys, order, k).select("claim_id")
    few = claims.select(*wanted, "policy_id").join(F.broadcast(first), "claim_id", "left_semi")
    rows = fetch(few, [
        (t["policies"].select("policy_id", "customer_id", "package_id", *policy), "policy_id"),
        (_named_customers(t, name), "customer_id"), (_named_packages(t), "package_id"),
    ])
    return top_k(rows, order, k)


def b03(t: Tables, as_of: When, codes: Codes = CODES, k: int = 30) -> DataFrame:
    """Oldest pending claims."""
    pending = t["claims"].filter(F.col("status").isin(*codes.pending_claims))
    wanted = ["claim_id", "claim_number", "claim_date", "claim_amount", F.col("category").alias("claim_category"),
              F.col("status").alias("claim_status")]
    rows = _first_claims(t, pending, ["claim_date", "claim_id"], wanted, k, ["policy_number"],
                         F.col("full_name").alias("customer_name"))
    return rows.select(
        "claim_number", "claim_date", "claim_amount", "claim_category", "claim_status", "policy_number",
        "customer_name", "package_name", days_between("claim_date", as_of=as_of).alias("days_pending"),
    )


def b04(t: Tables, as_of: When, codes: Codes = CODES) -> DataFrame:
    """Completed transactions of the last year by month and type."""
    rows = t["transactions"].filter(
        (F.col("status") == codes.completed) & (F.col("transaction_date") >= ts_lit(years_before(as_of)))
    )
    return monthly_stats(rows, "transaction_date", ["transaction_type"], "amount").orderBy(
        F.col("month").desc(), "transaction_type"
    )


def b05(t: Tables, codes: Codes = CODES, k: int = 20) -> DataFrame:
    """Agents by premium, with retention. Inactive agents are left out, idle ones stay."""
    active_agents = t["agents"].filter("is_active").select("agent_id", "agent_code", "full_name", "branch")
    sold = attach_aggs(
        active_agents,
        t["policies"],
        "agent_id",
        [
            F.count("policy_id").alias("n"),
            F.sum("annual_premium").alias("premium"),
            count_where(F.col("status") == codes.active).alias("n_active"),
            count_where(F.col("status") == codes.cancelled).alias("n_cancelled"),
        ],
        zero_fill=["n", "n_active", "n_cancelled"],
    )
    grouped = sold.groupBy("agent_code", F.col("full_name").alias("agent_name"), "branch").agg(
        F.sum("n").alias("policies_sold"),
        F.sum("premium").alias("total_premium_generated"),
        F.sum("n_active").alias("active_policies"),
        F.sum("n_cancelled").alias("cancelled_policies"),
    )
    rows = grouped.withColumn("retention_pct", safe_pct(F.col("active_policies"), F.col("policies_sold")))
    return top_k(rows, [F.col("total_premium_generated").desc_nulls_last(), "agent_code", "agent_name", "branch"], k)


def b06(t: Tables, codes: Codes = CODES, above: int | float = 10000) -> DataFrame:
    """High claims by package and claim category, with approval rate."""
    high = (
        t["claims"].filter(F.col("claim_amount") > F.lit(above))
        .groupBy("policy_id", F.col("category").alias("claim_type"))
        .agg(
            F.count("*").alias("n"),
            F.sum("claim_amount").alias("claimed"),
            sum0("approved_amount").alias("approved"),
            count_where(F.col("status").isin(*codes.approved_claims)).alias("n_approved"),
        )
    )
    rows = star_join(
        high, [(t["policies"].select("policy_id", "package_id"), "policy_id"), (_named_packages(t), "package_id")]
    )
    return (
        rows.groupBy(F.col("package_category").alias("category"), "claim_type")
        .agg(
            F.sum("n").alias("total_claims"),
            F.sum("claimed").alias("total_claimed"),
            F.sum("approved").alias("total_approved"),
            safe_pct(F.sum("n_approved"), F.sum("n")).alias("approval_rate"),
        )
        .orderBy(F.col("total_claimed").desc())
    )


def customer_risk(t: Tables, repeat_premium: bool = True) -> DataFrame:
    """Claims against premium per customer with at least one claim.

    ``repeat_premium`` keeps the literal meaning: the premium of a policy counts once
    per claim. Without it every premium counts once (B-07b).
    """
    policies = t["policies"].select("policy_id", "customer_id", "annual_premium")
    per_policy = policies.join(claims_per_policy(t["claims"]), "policy_id", "left")
    premium = F.col("annual_premium") * (fan_out("n_claims") if repeat_premium else F.lit(1))
    per_customer = (
        per_policy.groupBy("customer_id")
        .agg(
            F.count("policy_id").alias("num_policies"),
            F.sum("n_claims").alias("num_claims"),
            F.sum("claimed").alias("total_claimed"),
            F.sum(premium).alias("total_premium_paid"),
        )
        .filter(F.col("num_claims") > 0)
    )
    return per_customer.join(_named_customers(t, "full_name"), "customer_id").select(
        "customer_id", "full_name", "num_policies", "num_claims", "total_claimed", "total_premium_paid",
        risk_tier(F.col("total_claimed"), F.col("total_premium_paid")).alias("risk_tier"),
    )


def b07(t: Tables, k: int = 25, repeat_premium: bool = True) -> DataFrame:
    """Customers with the highest claims and their risk tier."""
    return top_k(customer_risk(t, repeat_premium), [F.col("total_claimed").desc(), "customer_id"], k)


def b07b(t: Tables, k: int = 25) -> DataFrame:
    """B-07 with every premium counted once."""
    return b07(t, k, repeat_premium=False)


def b08(t: Tables, as_of: When, codes: Codes = CODES, days: int = 90) -> DataFrame:
    """Active policies that expire within ``days``."""
    expiring = t["policies"].filter((F.col("status") == codes.active) & date_window("end_date", as_of, days))
    return (
        star_join(
            expiring,
            [
                (_named_customers(t, "full_name", "phone", "email"), "customer_id"),
                (_named_packages(t), "package_id"),
                (_named_agents(t), "agent_id"),
            ],
        )
        .select(
            "policy_number", "end_date",
            F.datediff("end_date", date_lit(as_of)).alias("days_to_expiry"),
            "full_name", "phone", "email", "package_name", F.col("package_category").alias("category"),
            "annual_premium", "agent_name",
        )
        .orderBy("end_date", "policy_number")
    )


def b09(t: Tables, codes: Codes = CODES) -> DataFrame:
    """Failed transactions with whom to call."""
    failed = t["transactions"].filter(F.col("status") == codes.failed).select(
        "transaction_ref", "transaction_date", "amount", "payment_method", "remarks", "policy_id"
    )
    return (
        star_join(
            failed,
            [
                (t["policies"].select("policy_id", "policy_number", "customer_id", "agent_id"), "policy_id"),
                (_named_customers(t, "full_name", "phone"), "customer_id"),
                (_named_agents(t), "agent_id"),
            ],
        )
        .select(
            "transaction_ref", "transaction_date", "amount", "payment_method", "remarks", "policy_number",
            "full_name", "phone", "agent_name",
        )
        .orderBy(F.col("transaction_date").desc(), "transaction_ref")
    )


def b10(t: Tables, repeat_premium: bool = True) -> DataFrame:
    """Branch summary; ``repeat_premium`` as in ``customer_risk``."""
    agents = t["agents"].select("agent_id", "branch")
    policies = t["policies"].select("policy_id", "customer_id", "agent_id", "annual_premium")
    premium = F.col("annual_premium") * (fan_out("n_claims") if repeat_premium else F.lit(1))
    per_pair = (
        policies.join(claims_per_policy(t["claims"]), "policy_id", "left")
        .groupBy("agent_id", "customer_id")
        .agg(
            F.count("policy_id").alias("n_policies"),
            F.sum(premium).alias("premium"),
            F.sum("n_claims").alias("n_claims"),
            F.sum("claimed").alias("claimed"),
        )
    )
    business = (
        per_pair.join(agents, "agent_id")
        .groupBy("branch")
        .agg(
            F.sum("n_policies").alias("total_policies"),
            F.countDistinct("customer_id").alias("total_customers"),
            F.sum("premium").alias("total_premium"),
            F.sum("n_claims").alias("total_claims"),
            F.sum("claimed").alias("total_claim_amount"),
        )
    )
    staff = agents.groupBy("branch").agg(F.count("agent_id").alias("num_agents"))
    return (
        staff.join(business, "branch", "left")
        .fillna(0, subset=["total_policies", "total_customers", "total_claims"])
        .select(
            "branch", "num_agents", "total_policies", "total_customers", "total_premium", "total_claims",
            "total_claim_amount",
        )
        .orderBy(F.col("total_premium").desc_nulls_last())
    )


def b10b(t: Tables) -> DataFrame:
    """B-10 with every premium counted once."""
    return b10(t, repeat_premium=False)


def b11(t: Tables, codes: Codes = CODES, k: int = 30) -> DataFrame:
    """Customers with exactly one active policy, by premium.

    With one policy per customer left, "any value" of its columns is its value: the
    membership test and the fetch are one aggregation.
    """
    single = (
        t["policies"].filter(F.col("status") == codes.active)
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("n"),
            F.min("package_id").alias("package_id"),
            F.min("annual_premium").alias("annual_premium"),
        )
        .filter("n = 1")
    )
    order = [F.col("annual_premium").desc(), "customer_id"]
    first = top_k(with_matches(single, [(t["customers"], "customer_id"), (t["packages"], "package_id")]), order, k)
    rows = fetch(first, [(_named_customers(t, "full_name", "email"), "customer_id"), (_named_packages(t), "package_id")])
    return top_k(rows, order, k).select(
        "customer_id", "full_name", "email", F.col("package_category").alias("current_category"),
        F.col("package_name").alias("current_package"), "annual_premium",
    )


def b12(t: Tables) -> DataFrame:
    """Days from claim to decision by category and status."""
    processed = t["claims"].filter(F.col("processed_date").isNotNull())
    return day_stats(processed, "claim_date", "processed_date", ["category", "status"]).orderBy(
        "category", F.col("avg_processing_days").desc()
    )


def b16(t: Tables, k: int = 20, precision: int = 5) -> DataFrame:
    """Policies by share of the insured sum claimed; the names are fetched for the first k."""
    policies = t["policies"].filter(F.col("sum_insured") > 0).select(
        "policy_id", "policy_number", "customer_id", "package_id", "sum_insured"
    )
    used = attach_aggs(policies, t["claims"], "policy_id", [F.sum("claim_amount").alias("claimed")])
    claimed = F.coalesce(F.col("claimed"), F.lit(0))
    shares = with_matches(used, [(t["customers"], "customer_id"), (t["packages"], "package_id")]).select(
        "policy_id", "policy_number", "customer_id", "package_id", "sum_insured", claimed.alias("total_claimed"),
        safe_pct(claimed, F.col("sum_insured"), precision, 1).alias("utilisation_pct"),
    )
    order = [F.col("utilisation_pct").desc_nulls_last(), "policy_number"]
    rows = fetch(top_k(shares, order, k), [
        (t["policies"].select("policy_id", "status"), "policy_id"), (_named_customers(t, "full_name"), "customer_id"),
        (_named_packages(t), "package_id"),
    ])
    return top_k(rows, order, k).select(
        "policy_number", "full_name", "package_name", "sum_insured", "total_claimed", "utilisation_pct", "status")


def b17(t: Tables, codes: Codes = CODES) -> DataFrame:
    """Active policies with several beneficiaries: do the shares add up?"""
    active = t["policies"].filter(F.col("status") == codes.active).select(
        "policy_id", "policy_number", "customer_id"
    )
    shares = attach_aggs(
        active, t["beneficiaries"], "policy_id",
        [F.count("beneficiary_id").alias("n"), F.sum("percentage").alias("pct")], zero_fill=["n"],
    )
    named = shares.join(_named_customers(t, F.col("full_name").alias("policyholder")), "customer_id")
    return (
        named.groupBy("policy_number", "policyholder")
        .agg(F.sum("n").alias("num_beneficiaries"), F.sum("pct").alias("total_pct"))
        .filter(F.col("num_beneficiaries") > 1)
        .withColumn("allocation_status", allocation_status(F.col("total_pct")))
        .orderBy(F.col("total_pct").desc(), "policy_number")
    )


def b18(t: Tables, as_of: When, codes: Codes = CODES, days: int = 30) -> DataFrame:
    """Daily transactions of the last ``days`` days with a running total per type."""
    now = moment(as_of)
    recent = t["transactions"].filter(
        (F.col("transaction_date") >= ts_lit(now) - F.expr(f"INTERVAL {int(days)} DAY"))
        & (F.col("transaction_date") <= ts_lit(now))
        & (F.col("status") == codes.completed)
    )
    daily = recent.groupBy(F.to_date("transaction_date").alias("txn_date"), "transaction_type").agg(
        F.count("*").alias("daily_count"), F.sum("amount").alias("daily_amount")
    )
    return running_total(daily, ["transaction_type"], "txn_date", "daily_amount", "running_total").orderBy(
        F.col("txn_date").desc(), "transaction_type"
    )


def b19(t: Tables, as_of: When, codes: Codes = CODES) -> DataFrame:
    """Monthly snapshot: new policies, then premium and payout filled in by month.

    Months without a new policy do not appear, and the two counts that nothing fills
    stay zero, as in the report this follows.
    """
    nothing = F.lit(0).cast("decimal(15,2)")
    base = (
        t["policies"].filter(F.col("start_date") >= date_lit(years_before(as_of)))
        .groupBy(month_of("start_date").alias("report_month"))
        .agg(F.count("*").alias("new_policies"))
        .select(
            "report_month", "new_policies", F.lit(0).cast("bigint").alias("cancelled_policies"),
            F.lit(0).cast("bigint").alias("new_claims"), nothing.alias("premium_collected"),
            nothing.alias("claims_paid"),
        )
    )
    filled = update_from(
        base, _monthly(t, codes.premium_payment, codes.completed), "report_month",
        {"premium_collected": "total_amt"},
    )
    paid = update_from(
        filled, _monthly(t, codes.claim_payout, codes.completed), "report_month", {"claims_paid": "total_amt"}
    )
    return paid.orderBy(F.col("report_month").desc())


def _monthly(t: Tables, kind: str, status: str) -> DataFrame:
    rows = t["transactions"].filter((F.col("transaction_type") == kind) & (F.col("status") == status))
    return rows.groupBy(month_of("transaction_date").alias("report_month")).agg(
        F.sum("amount").cast("decimal(15,2)").alias("total_amt")
    )


# The documented search words.
KEYWORDS = ("%hospital%", "%vehicle%", "%damage%")


def b20(t: Tables, patterns: Sequence[str] = KEYWORDS, k: int = 15) -> DataFrame:
    """Largest claims whose description holds a keyword."""
    hits = t["claims"].filter(any_like("description", patterns))
    wanted = ["claim_id", "claim_number", "description", "claim_amount", "status"]
    return _first_claims(t, hits, [F.col("claim_amount").desc(), "claim_id"], wanted, k, [], "full_name").select(
        "claim_number", "description", "claim_amount", "status", "full_name", "package_name"
    )
