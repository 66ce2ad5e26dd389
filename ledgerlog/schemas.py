"""Declared table schemas and the step that makes a DataFrame fit one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

_TYPES = {
    "BOOLEAN": BooleanType(),
    "DATE": DateType(),
    "DOUBLE": DoubleType(),
    "INT": IntegerType(),
    "BIGINT": LongType(),
    "STRING": StringType(),
    "TIMESTAMP": TimestampType(),
    **{f"DECIMAL({p},2)": DecimalType(p, 2) for p in (5, 10, 12, 15)},
}


def _table(columns: str) -> StructType:
    """A schema from "name TYPE" pairs; unlike ``fromDDL`` it needs no session."""
    schema = StructType()
    for column in columns.split(", "):
        name, kind = column.split(" ")
        schema.add(name, _TYPES[kind])
    return schema


EVENT = _table(
    "TimeGenerated TIMESTAMP, Source STRING, EventLog STRING, EventID INT, EventLevelName STRING, "
    "EventLevel INT, RenderedDescription STRING, Computer STRING, EventCategory INT, "
    "UserName STRING, _ResourceId STRING"
)

PERF = _table(
    "TimeGenerated TIMESTAMP, ObjectName STRING, CounterName STRING, InstanceName STRING, "
    "CounterValue DOUBLE, Computer STRING, _ResourceId STRING"
)

AGENTS = _table(
    "agent_id INT, agent_code STRING, full_name STRING, email STRING, phone STRING, "
    "branch STRING, hire_date DATE, is_active BOOLEAN"
)

PACKAGES = _table(
    "package_id INT, package_code STRING, package_name STRING, category STRING, "
    "premium_monthly DECIMAL(10,2), coverage_amount DECIMAL(15,2), min_age INT, max_age INT, "
    "description STRING"
)

CUSTOMERS = _table(
    "customer_id INT, nric_last4 STRING, full_name STRING, email STRING, phone STRING, "
    "date_of_birth DATE, gender STRING, address STRING, postal_code STRING, city STRING, "
    "registration_date DATE, preferred_agent_id INT"
)

POLICIES = _table(
    "policy_id BIGINT, policy_number STRING, customer_id INT, package_id INT, agent_id INT, "
    "start_date DATE, end_date DATE, status STRING, sum_insured DECIMAL(15,2), "
    "annual_premium DECIMAL(10,2), payment_freq STRING, created_at TIMESTAMP"
)

CLAIMS = _table(
    "claim_id BIGINT, claim_number STRING, policy_id BIGINT, claim_date DATE, incident_date DATE, "
    "claim_amount DECIMAL(12,2), approved_amount DECIMAL(12,2), status STRING, category STRING, "
    "description STRING, assessor_notes STRING, processed_date DATE"
)

TRANSACTIONS = _table(
    "transaction_id BIGINT, transaction_ref STRING, policy_id BIGINT, transaction_date TIMESTAMP, "
    "amount DECIMAL(12,2), transaction_type STRING, payment_method STRING, status STRING, "
    "reference_id INT, remarks STRING"
)

BENEFICIARIES = _table(
    "beneficiary_id BIGINT, policy_id BIGINT, full_name STRING, relationship STRING, "
    "percentage DECIMAL(5,2), nric_last4 STRING, phone STRING"
)

BUSINESS = {
    "agents": AGENTS,
    "packages": PACKAGES,
    "customers": CUSTOMERS,
    "policies": POLICIES,
    "claims": CLAIMS,
    "transactions": TRANSACTIONS,
    "beneficiaries": BENEFICIARIES,
}

# child table, child column, parent table, parent column
FOREIGN_KEYS = (
    ("customers", "preferred_agent_id", "agents", "agent_id"),
    ("policies", "customer_id", "customers", "customer_id"),
    ("policies", "package_id", "packages", "package_id"),
    ("policies", "agent_id", "agents", "agent_id"),
    ("claims", "policy_id", "policies", "policy_id"),
    ("transactions", "policy_id", "policies", "policy_id"),
    ("beneficiaries", "policy_id", "policies", "policy_id"),
)

# The domains of the coded columns.
DOMAINS = {
    ("packages", "category"): ("Life", "Health", "Auto", "Property", "Travel"),
    ("policies", "status"): ("Active", "Expired", "Cancelled", "Pending", "Lapsed"),
    ("policies", "payment_freq"): ("Monthly", "Quarterly", "Annually"),
    ("claims", "status"): ("Submitted", "UnderReview", "Approved", "Rejected", "Paid", "Appealed"),
    ("transactions", "transaction_type"): (
        "PremiumPayment", "ClaimPayout", "Refund", "Adjustment", "Penalty",
    ),
    ("transactions", "payment_method"): ("GIRO", "CreditCard", "PayNow", "Cash", "BankTransfer"),
    ("transactions", "status"): ("Completed", "Pending", "Failed", "Reversed"),
}

# The counters that are collected, as (object, counter) pairs.
COUNTERS = (
    ("Processor", "% Processor Time"),
    ("Memory", "Available MBytes"),
    ("LogicalDisk", "% Free Space"),
    ("MSSQL$SQLEXPRESS:General Statistics", "User Connections"),
    ("MSSQL$SQLEXPRESS:SQL Statistics", "Batch Requests/sec"),
    ("MSSQL$SQLEXPRESS:SQL Statistics", "SQL Compilations/sec"),
    ("MSSQL$SQLEXPRESS:SQL Statistics", "SQL Re-Compilations/sec"),
    ("MSSQL$SQLEXPRESS:Locks", "Lock Waits/sec"),
    ("MSSQL$SQLEXPRESS:Locks", "Average Wait Time (ms)"),
    ("MSSQL$SQLEXPRESS:Buffer Manager", "Page life expectancy"),
)


def conform(
    df: DataFrame, schema: StructType, defaults: Mapping[str, Column] | None = None
) -> DataFrame:
    """Select and cast ``df`` to ``schema``; absent columns take a default or NULL.

    A column the schema does not know is an error, so nothing is dropped silently.
    """
    unknown = sorted(set(df.columns) - set(schema.names))
    if unknown:
        raise ValueError(f"columns not in the schema: {', '.join(unknown)}")
    defaults = defaults or {}
    present = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in present else defaults.get(f.name, F.lit(None)))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        )
    )
