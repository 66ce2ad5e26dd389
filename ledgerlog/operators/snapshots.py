"""Table changes as pure functions from an old snapshot to a new one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import MONEY
from ..functions.timewin import When, date_lit, moment, ts_lit
from ..schemas import POLICIES, TRANSACTIONS, conform
from .topk import sample_k
from .windows import dense_ids, number_rows


# The texts and the share these steps write.
APPROVAL_NOTE = "Batch approved via simulation"
APPROVED_SHARE = "0.85"
PAYMENT = {
    "transaction_type": "PremiumPayment",
    "payment_method": "GIRO",
    "status": "Completed",
    "remarks": "Simulated monthly GIRO deduction",
}


def approve_claims(
    claims: DataFrame, as_of: When, k: int = 5, status: str = "Submitted", approved: str = "Approved"
) -> DataFrame:
    """Approve the ``k`` submitted claims with the smallest ids at 85 % of their amount.

    The batch is ``k`` keys, so marking it costs a broadcast of ``k`` rows and no shuffle.
    """
    batch = (
        claims.filter(F.col("status") == status)
        .select("claim_id")
        .orderBy("claim_id")
        .limit(k)
        .withColumn("_hit", F.lit(True))
    )
    changes: Mapping[str, Column] = {
        "status": F.lit(approved),
        "approved_amount": (F.col("claim_amount") * F.lit(APPROVED_SHARE).cast("decimal(3,2)")).cast(MONEY),
        "processed_date": date_lit(as_of),
        "assessor_notes": F.lit(APPROVAL_NOTE),
    }
    joined = claims.join(batch, "claim_id", "left")
    return joined.select(
        *(
            F.when(F.col("_hit"), changes[c]).otherwise(F.col(c)).alias(c) if c in changes else c
            for c in claims.columns
        )
    )


def new_policy(spark: SparkSession, values: Mapping[str, object], as_of: When) -> DataFrame:
    """A one-row batch for the policies table; absent columns take their defaults."""
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return conform(row, POLICIES, policy_defaults(as_of))


def policy_defaults(as_of: When) -> dict[str, Column]:
    return {"payment_freq": F.lit("Monthly"), "created_at": ts_lit(as_of)}


def insert_rows(old: DataFrame, batch: DataFrame) -> DataFrame:
    """Old snapshot plus a batch; columns the batch lacks become NULL."""
    return old.unionByName(batch, allowMissingColumns=True)


def payment_batch(
    policies: DataFrame, as_of: When, k: int = 10, active: str = "Active", seed: str = ""
) -> DataFrame:
    """Monthly payment rows for ``k`` randomly drawn active policies.

    References are numbered after the draw, so the numbering only sees ``k`` rows.
    """
    now = moment(as_of)
    drawn = sample_k(
        policies.filter(F.col("status") == active).select("policy_id", "annual_premium"),
        "policy_id", k, seed,
    )
    prefix = F.lit(f"TXN{now:%Y%m%d}SIM")
    numbered = number_rows(drawn, ["policy_id"], prefix, "transaction_ref")
    return numbered.select(
        "transaction_ref",
        "policy_id",
        ts_lit(now).alias("transaction_date"),
        (F.col("annual_premium") / 12).cast(MONEY).alias("amount"),
        *(F.lit(value).alias(name) for name, value in PAYMENT.items()),
    )


def conform_transactions(batch: DataFrame) -> DataFrame:
    return conform(batch, TRANSACTIONS)


def assign_keys(old: DataFrame, batch: DataFrame, key: str, order: str, path: str) -> DataFrame:
    """Give a batch surrogate keys that continue after the largest old one.

    The old maximum joins in as a scalar subquery; the numbering itself is sliced and
    keeps its rows in ``path`` (see ``dense_ids``).
    """
    last = old.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("m")).scalar()
    numbered = dense_ids(batch, order, "_seq", path)
    return numbered.withColumn(key, F.col("_seq") + last).drop("_seq")


def replace_where(old: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """New snapshot in which the rows of ``fresh`` stand in for old rows with the same key."""
    return old.join(fresh.select(key), key, "left_anti").unionByName(fresh, allowMissingColumns=True)


def changed_rows(old: DataFrame, new: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows of the new snapshot that the old one does not hold."""
    return new.select(*cols).exceptAll(old.select(*cols))
