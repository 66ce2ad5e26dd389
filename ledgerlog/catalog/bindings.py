"""The sample tables seen through the schemas of this package.

The sample folder holds star-schema tables and an event stream. They are projected
onto the log and business schemas with plain expressions, so filters on dates and
keys still reach the scans. Each projection exists once as SQL expressions that both
Spark and the checking engine understand.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.reports import Codes

# Order status P/O/F, line status O/F and return flag R/A/N in the roles of the reports.
CODES = Codes(
    active="P",
    lapsed="O",
    cancelled="F",
    pending_claims=("O",),
    approved_claims=("F",),
    rejected_claim="O",
    completed="F",
    failed="O",
    premium_payment="N",
    claim_payout="A",
)

# The number in ``props``, taken out once below the projections that use it.
_K = "k"
_K_FROM_PROPS = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"
_SECONDS = "cast(cast(value as decimal(12,2)) as string)"
_DB = f"concat('db_', cast({_K} % 5 as string))"

# One template per kind of message; %n$s stands for the n-th value below.
_TEMPLATE = """CASE
  WHEN event_type = 'view' THEN 'Timeout expired connecting to database db_%3$s. Connection pool exhausted.'
  WHEN event_type = 'signup' THEN 'Login failed for user %6$suser_%4$s%6$s.'
  WHEN event_type = 'purchase' THEN 'BACKUP failed to complete the command BACKUP DATABASE db_%3$s.'
  WHEN event_type = 'click' THEN 'Database %6$sdb_%3$s%6$s does not exist. Check that the name is entered correctly.'
  WHEN k < 20 THEN 'SLOW QUERY WARNING: Query on orders join took %1$s seconds. %2$s000 rows scanned with no index seek. Query hash: 0x%5$s. Plan guide recommended.'
  WHEN k < 35 THEN 'SLOW QUERY WARNING: N+1 lookup detected. Elapsed %1$s seconds for %2$s rows. Consider rewriting with JOIN or APPLY.'
  WHEN k < 50 THEN 'SLOW QUERY WARNING: Leading wildcard caused full table scan. %2$s rows scanned, 0 index seeks. Duration: %1$s seconds. Consider full-text index.'
  WHEN k < 80 THEN 'DEADLOCK DETECTED: Process %2$s was chosen as the deadlock victim on table t%2$s. Transaction rolled back after %1$s seconds. Resources involved: KEY lock on u%3$s. Retry recommended.'
  ELSE 'Disk space critically low on drive E:. Database auto-growth failed for db_%3$s.' END"""

_VALUES = (
    _SECONDS,
    "cast(k as string)",
    "cast(k % 5 as string)",
    "cast(user_id as string)",
    "substr(md5(cast(event_id as string)), 1, 8)",
    "chr(39)",
)
_MESSAGE = f"printf({_TEMPLATE}, {', '.join(_VALUES)})"

EVENT_COLUMNS = {
    "TimeGenerated": "ts",
    "Source": "concat(CASE WHEN user_id % 2 = 0 THEN 'MSSQL$' ELSE 'App.' END, event_type)",
    "EventLog": "CASE WHEN user_id % 3 = 0 THEN 'System' ELSE 'Application' END",
    "EventID": "CASE event_type WHEN 'signup' THEN 18456 WHEN 'purchase' THEN 3041 WHEN 'click' THEN 911 "
               "ELSE 17063 END",
    "EventLevelName": "CASE event_type WHEN 'error' THEN 'Error' WHEN 'view' THEN 'Error' "
                      "WHEN 'purchase' THEN 'Information' ELSE 'Warning' END",
    "EventLevel": "CASE event_type WHEN 'error' THEN 2 WHEN 'view' THEN 2 WHEN 'purchase' THEN 4 ELSE 3 END",
    "RenderedDescription": _MESSAGE,
    "Computer": "concat('vm-', cast(user_id as string))",
}

_OBJECT = """CASE event_type WHEN 'error' THEN 'Processor' WHEN 'view' THEN 'LogicalDisk'
  WHEN 'signup' THEN 'MSSQL$SQLEXPRESS:General Statistics' WHEN 'click' THEN 'MSSQL$SQLEXPRESS:SQL Statistics'
  ELSE 'MSSQL$SQLEXPRESS:Locks' END"""
_COUNTER = """CASE event_type WHEN 'error' THEN '% Processor Time' WHEN 'view' THEN '% Free Space'
  WHEN 'signup' THEN 'User Connections' WHEN 'click' THEN 'Batch Requests/sec'
  ELSE 'Average Wait Time (ms)' END"""
_INSTANCE = "CASE WHEN event_type IN ('error', 'view', 'purchase') THEN '_Total' END"

PERF_COLUMNS = {
    "TimeGenerated": "ts",
    "ObjectName": _OBJECT,
    "CounterName": _COUNTER,
    "InstanceName": _INSTANCE,
    "CounterValue": "value",
    "Computer": "concat('vm-', cast(user_id as string))",
}

# One column that holds the counter path, as an agent would deliver it. Users above
# the allow-list ask for a counter nobody collects.
FEED_COLUMNS = {
    "TimeGenerated": "ts",
    "Computer": "concat('vm-', cast(user_id as string))",
    "counter_path": f"concat(chr(92), {_OBJECT}, CASE WHEN {_INSTANCE} IS NULL THEN '' ELSE '(_Total)' END, "
                    f"chr(92), CASE WHEN {_K} < 10 THEN 'Unlisted Counter' ELSE {_COUNTER} END)",
    "CounterValue": "value",
}

CAPTURE_COLUMNS = {
    "ts": "ts",
    "event": "CASE event_type WHEN 'error' THEN 'sql_batch_completed' WHEN 'view' THEN 'rpc_completed' "
             "WHEN 'click' THEN 'sql_batch_completed' ELSE 'login' END",
    "duration": "cast(cast(value as decimal(12,2)) * 1000000 as bigint)",
    "sql_text": "concat('SELECT ', cast(event_id as string))",
    "database_name": _DB,
    "username": "concat('user_', cast(user_id as string))",
    "client_app_name": "event_type",
    "query_hash": f"concat('q', cast({_K} % 10 as string))",
    "query_plan_hash": f"concat('p', cast({_K} as string))",
}

CUSTOMER_COLUMNS = {
    "customer_id": "c_custkey",
    "nric_last4": "right(concat('0000', cast(c_custkey as string)), 4)",
    "full_name": "c_name",
    "email": "concat('cust', cast(c_custkey as string), '@', lower(c_mktsegment), '.example')",
    "phone": "concat('+65 8', right(concat('0000000', cast(c_custkey as string)), 7))",
}

_POLICY_BASE = {
    "policy_id": "o_orderkey",
    "policy_number": "concat('POL-', cast(o_orderkey as string))",
    "customer_id": "o_custkey",
    "start_date": "cast(o_orderdate as date)",
    "end_date": "date_add(cast(o_orderdate as date), 365)",
    "status": "o_orderstatus",
    "sum_insured": "cast(o_totalprice as decimal(15,2))",
    "annual_premium": "cast(o_totalprice as decimal(10,2))",
}

_CLAIM_KEY = (
    "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), cast(l_partkey as string), "
    "cast(l_suppkey as string), cast(cast(l_quantity as int) as string))"
)

CLAIM_COLUMNS = {
    "claim_id": _CLAIM_KEY,
    "claim_number": f"concat('CLM-', {_CLAIM_KEY})",
    "policy_id": "l_orderkey",
    "claim_date": "cast(l_shipdate as date)",
    "claim_amount": "cast(l_extendedprice as decimal(12,2))",
    "approved_amount": "CASE WHEN l_linestatus = 'F' AND l_returnflag <> 'R' "
                       "THEN cast(l_extendedprice as decimal(12,2)) END",
    "status": "l_linestatus",
    "category": "l_returnflag",
    "description": "CASE l_linenumber WHEN 1 THEN 'Stay in Hospital ward' WHEN 2 THEN 'Rear-ended vehicle' "
                   "WHEN 3 THEN 'Water damage in kitchen' WHEN 4 THEN 'Flight delay' ELSE 'Other matter' END",
    "assessor_notes": "CASE WHEN l_linestatus = 'F' THEN 'Documents complete' END",
    "processed_date": "CASE WHEN l_linestatus = 'F' THEN date_add(cast(l_shipdate as date), cast(l_quantity as int)) END",
}

TRANSACTION_COLUMNS = {
    "transaction_id": _CLAIM_KEY,
    "transaction_ref": f"concat('TXN-', {_CLAIM_KEY})",
    "policy_id": "l_orderkey",
    "transaction_date": "l_shipdate",
    "amount": "cast(l_extendedprice as decimal(12,2))",
    "transaction_type": "l_returnflag",
    "payment_method": "CASE WHEN l_linenumber > 2 THEN 'GIRO' END",
    "status": "l_linestatus",
    "remarks": "CASE WHEN l_linenumber > 5 THEN 'Quarterly' END",
}

BENEFICIARY_COLUMNS = {
    "beneficiary_id": _CLAIM_KEY,
    "policy_id": "l_orderkey",
    "percentage": "cast(l_quantity as decimal(5,2))",
}

PACKAGE_COLUMNS = {
    "package_id": "p_partkey",
    "package_code": "p_brand",
    "package_name": "p_name",
    "category": "p_type",
    "premium_monthly": "cast(p_retailprice as decimal(10,2))",
    "coverage_amount": "cast(p_retailprice * 100 as decimal(15,2))",
}

_AGENT_BASE = {
    "agent_id": "s_suppkey",
    "agent_code": "concat('AGT', right(concat('000', cast(s_suppkey as string)), 3))",
    "full_name": "s_name",
    "is_active": "s_acctbal >= 0",
}


def _columns(columns: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in columns.items()]


def _select(columns: dict[str, str], table: str, more: str = "") -> str:
    text = ", ".join(_columns(columns)).replace("date_add(cast(o_orderdate as date), 365)",
                                                "cast(o_orderdate as date) + 365")
    text = text.replace("date_add(cast(l_shipdate as date), cast(l_quantity as int))",
                        "cast(l_shipdate as date) + cast(l_quantity as int)")
    return f"SELECT {text}{more} FROM {table}"


_NUMBERED = f"(SELECT *, {_K_FROM_PROPS} AS k FROM events)"

# The same projections as named subqueries for the checking engine. Names differ from
# the sample tables so that none hides another.
VIEWS = {
    "log": _select(EVENT_COLUMNS, _NUMBERED),
    "perf": _select(PERF_COLUMNS, "events"),
    "feed": _select(FEED_COLUMNS, _NUMBERED),
    "captured": _select(CAPTURE_COLUMNS, _NUMBERED),
    "customers": _select(CUSTOMER_COLUMNS, "customer"),
    "lead_line": "SELECT l_orderkey, min(l_partkey) AS package_id, min(l_suppkey) AS agent_id FROM lineitem "
                 "GROUP BY l_orderkey",
    "policies": _select(_POLICY_BASE, "orders LEFT JOIN lead_line ON l_orderkey = o_orderkey",
                        ", package_id, agent_id"),
    "claims": _select(CLAIM_COLUMNS, "lineitem"),
    "transactions": _select(TRANSACTION_COLUMNS, "lineitem"),
    "beneficiaries": _select(BENEFICIARY_COLUMNS, "lineitem"),
    "packages": _select(PACKAGE_COLUMNS, "part"),
    "agents": _select(_AGENT_BASE, "supplier JOIN nation ON s_nationkey = n_nationkey", ", n_name AS branch"),
}


def over(*views: str) -> str:
    """``WITH`` prefix that defines the given views."""
    wanted = []
    for view in views:
        if view == "policies":
            wanted.append("lead_line")
        wanted.append(view)
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in wanted) + "\n"


def with_number(events: DataFrame) -> DataFrame:
    return events.selectExpr("*", f"{_K_FROM_PROPS} AS k")


class Sample:
    """The sample folder as tables of this package's schemas."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def project(self, table: str, columns: dict[str, str]) -> DataFrame:
        return self.table(table).selectExpr(*_columns(columns))

    @cached_property
    def numbered(self) -> DataFrame:
        return with_number(self.table("events"))

    @cached_property
    def log(self) -> DataFrame:
        return self.numbered.selectExpr(*_columns(EVENT_COLUMNS))

    @cached_property
    def perf(self) -> DataFrame:
        return self.project("events", PERF_COLUMNS)

    @cached_property
    def feed(self) -> DataFrame:
        return self.numbered.selectExpr(*_columns(FEED_COLUMNS))

    @cached_property
    def captured(self) -> DataFrame:
        return self.numbered.selectExpr(*_columns(CAPTURE_COLUMNS))

    @cached_property
    def bare_policies(self) -> DataFrame:
        """Policies without package and agent, for reports that use neither."""
        return self.project("orders", _POLICY_BASE)

    @cached_property
    def policies(self) -> DataFrame:
        """Policies with the first package and the first agent among their lines."""
        lead = self.table("lineitem").groupBy(F.col("l_orderkey").alias("policy_id")).agg(
            F.min("l_partkey").alias("package_id"), F.min("l_suppkey").alias("agent_id")
        )
        return self.bare_policies.join(lead, "policy_id", "left")

    @cached_property
    def agents(self) -> DataFrame:
        joined = self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        return joined.selectExpr(*_columns(_AGENT_BASE), "n_name AS branch")

    @cached_property
    def business(self) -> dict[str, DataFrame]:
        return {
            "customers": self.project("customer", CUSTOMER_COLUMNS),
            "policies": self.policies,
            "claims": self.project("lineitem", CLAIM_COLUMNS),
            "transactions": self.project("lineitem", TRANSACTION_COLUMNS),
            "beneficiaries": self.project("lineitem", BENEFICIARY_COLUMNS),
            "packages": self.project("part", PACKAGE_COLUMNS),
            "agents": self.agents,
        }

    @cached_property
    def lean_business(self) -> dict[str, DataFrame]:
        """The same with ``bare_policies``: no join hides behind the policies."""
        return {**self.business, "policies": self.bare_policies}
