"""Expensive query shapes (P-01..P-05), written so that they scale.

Each returns what the expensive form returns without doing its work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import days_between, safe_pct
from ..functions.text import any_col_like
from ..functions.timewin import When, date_lit
from ..operators.joins import above_global_mean, cross_count, groups_above_own_mean
from ..operators.topk import top_k
from .reports import CODES, Codes, Tables, claims_per_policy, fan_out


def p01(t: Tables, left: str = "%a%", right: str = "%e%", packages: int = 10) -> DataFrame:
    """Size of customers x customers x ten packages, each side filtered."""
    customers = t["customers"].select("full_name")
    return cross_count(
        [
            customers.filter(F.col("full_name").ilike(left)),
            customers.filter(F.col("full_name").ilike(right)),
            t["packages"].select("package_id").limit(packages),
        ]
    )


def p02(t: Tables, k: int = 200) -> DataFrame:
    """Claim and transaction figures of the ``k`` policies with the highest premium.

    Scalar subqueries never drop rows, so the limit comes first; only the details of
    those ``k`` policies are then read on past a broadcast of ``k`` keys.
    """
    top = top_k(
        t["policies"].select("policy_id", "policy_number", "annual_premium"),
        [F.col("annual_premium").desc(), "policy_id"], k,
    )
    keys = top.select("policy_id")
    claims = (
        t["claims"].join(keys, "policy_id", "left_semi")
        .groupBy("policy_id")
        .agg(F.count("*").alias("claim_count"), F.max("claim_amount").alias("max_claim"))
    )
    paid = (
        t["transactions"].join(keys, "policy_id", "left_semi")
        .groupBy("policy_id")
        .agg(F.sum("amount").alias("total_txn"))
    )
    return (
        top.join(claims, "policy_id", "left")
        .join(paid, "policy_id", "left")
        .fillna(0, subset=["claim_count"])
        .select("policy_number", "annual_premium", "claim_count", "max_claim", "total_txn")
        .orderBy(F.col("annual_premium").desc(), "policy_number")
    )


def p03(t: Tables) -> DataFrame:
    """Customers with a claim above twice the mean of their own claims."""
    per_policy = claims_per_policy(t["claims"], F.max("claim_amount").alias("largest"))
    owned = per_policy.join(t["policies"].select("policy_id", "customer_id"), "policy_id")
    risky = groups_above_own_mean(owned, "customer_id", "largest", "claimed", "n_claims")
    return t["customers"].join(risky, "customer_id", "left_semi")


def p03b(t: Tables, factor: float = 2) -> DataFrame:
    """Customers with a claim above twice the mean of all claims."""
    high = above_global_mean(t["claims"].select("policy_id", "claim_amount"), "claim_amount", factor)
    keys = high.select("policy_id").distinct()
    owners = t["policies"].join(keys, "policy_id", "left_semi").select("customer_id").distinct()
    return t["customers"].join(owners, "customer_id", "left_semi")


# The wildcards of the documented lookup.
LOOKUPS = (("full_name", "%Tan%"), ("email", "%gmail%"), ("nric_last4", "%1234%"))


def p04(t: Tables, lookups: Sequence[tuple[str, str]] = LOOKUPS) -> DataFrame:
    """Policies of customers found by pattern in any of several columns."""
    found = t["customers"].filter(any_col_like(lookups)).select("customer_id", "full_name", "email", "nric_last4")
    policies = t["policies"].select("customer_id", "policy_number", "annual_premium")
    return (
        found.join(policies, "customer_id")
        .select("customer_id", "full_name", "email", "nric_last4", "policy_number", "annual_premium")
        .orderBy("full_name", "customer_id", "policy_number")
    )


def p05(t: Tables, as_of: When, codes: Codes = CODES, repeat: bool = True) -> DataFrame:
    """Agents: policies, claims, packages sold, policy age and loss ratio.

    ``repeat`` keeps the literal meaning of joining claims and transactions side by
    side: a policy with c claims and t transactions counts max(c,1) * max(t,1) times in
    sums and means. Without it (P-05b) everything counts once. Either way the details
    are one row per policy before the joins.
    """
    rejected = F.count_if(F.col("status") == codes.rejected_claim).alias("n_rejected")
    claims = claims_per_policy(t["claims"], rejected)
    policies = t["policies"].select(
        "policy_id", "agent_id", "package_id", "annual_premium", "start_date", "end_date"
    )
    joined = policies.join(claims, "policy_id", "left")
    if repeat:
        payments = t["transactions"].groupBy("policy_id").agg(F.count("*").alias("n_txn"))
        joined = joined.join(payments, "policy_id", "left")
        per_claim = fan_out("n_txn")
        per_policy = fan_out("n_claims") * per_claim
    else:
        per_claim = per_policy = F.lit(1)
    days = days_between("start_date", F.coalesce(F.col("end_date"), date_lit(as_of))).cast("bigint")
    sums = {
        "policies": F.count("policy_id"),
        "claims": F.sum("n_claims"),
        "premium": F.sum(F.col("annual_premium") * per_policy),
        "claimed": F.sum(F.col("claimed") * per_claim),
        "rejected": F.sum(F.col("n_rejected") * per_claim),
        "days": F.sum(days * per_policy),
        "weight": F.sum(F.when(days.isNotNull(), per_policy)),
    }
    by_package = joined.groupBy("agent_id", "package_id").agg(*(v.alias(k) for k, v in sums.items()))
    packages = t["packages"].select("package_id", "package_name")
    sold = by_package.join(packages, "package_id")
    by_name = sold.groupBy("agent_id", "package_name").agg(*(F.sum(k).alias(k) for k in sums))
    # names are distinct per agent by now, so the list is as long as the text it becomes
    names = F.array_join(F.array_sort(F.collect_list("package_name")), ", ").alias("packages_sold")
    totals = by_name.groupBy("agent_id").agg(*(F.sum(k).alias(k) for k in sums), names)
    agents = t["agents"].select("agent_id", "branch", F.col("full_name").alias("agent_name"))
    return (
        agents.join(totals, "agent_id")
        .select(
            "branch",
            "agent_name",
            F.col("policies").alias("policy_count"),
            F.coalesce(F.col("claims"), F.lit(0)).alias("claim_count"),
            F.col("premium").alias("total_premium"),
            F.col("claimed").alias("total_claims"),
            "packages_sold",
            F.call_function("div", F.col("days"), F.nullif(F.col("weight"), F.lit(0))).alias("avg_policy_days"),
            F.coalesce(F.col("rejected"), F.lit(0)).alias("rejected_claims"),
            safe_pct(F.col("claimed"), F.col("premium"), 10, 2).alias("loss_ratio_pct"),
        )
        .orderBy(F.col("loss_ratio_pct").desc_nulls_last(), "branch", "agent_name")
    )


def p05b(t: Tables, as_of: When, codes: Codes = CODES) -> DataFrame:
    """P-05 with every policy, claim and premium counted once."""
    return p05(t, as_of, codes, repeat=False)
