import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlog.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


# The message texts the parsers must understand, and the users that failed to log in.
SLOW = [
    "SLOW QUERY WARNING: Query on Customers x Policies cartesian join took 28.4 seconds. 360000 rows scanned "
    "with no index seek. Query hash: 0x7A3F2B1C. Plan guide recommended.",
    "SLOW QUERY WARNING: N+1 scalar subquery pattern detected on Claims/Transactions lookup. Elapsed 15.7 seconds "
    "for 200 rows. Consider rewriting with JOIN or APPLY.",
    "SLOW QUERY WARNING: Deeply nested subquery on Customers/Policies/Claims exceeded 12.1 seconds. Query optimizer "
    "unable to flatten. Estimated vs actual rows: 50 vs 12400.",
    "SLOW QUERY WARNING: Leading wildcard LIKE on Customers.full_name caused full table scan. 600 rows scanned, "
    "0 index seeks. Duration: 9.3 seconds. Consider full-text index.",
    "SLOW QUERY WARNING: Heavy aggregation across Agents/Policies/Claims/Transactions with STRING_AGG took 22.8 "
    "seconds. TempDB spill detected (3 sort operations). Consider pre-aggregated materialized view.",
]
DEADLOCKS = [
    "DEADLOCK DETECTED: Process 52 was chosen as the deadlock victim on table Policies. Transaction rolled back "
    "after 12.3 seconds. Resources involved: KEY lock on Policies (hobt_id=72057594039828480), KEY lock on Claims "
    "(hobt_id=72057594039893504).",
    "DEADLOCK DETECTED: Process 67 was chosen as the deadlock victim on table Customers. Two concurrent UPDATE "
    "operations conflicted on customer_id index. Retry recommended.",
    "DEADLOCK DETECTED: Process 89 was chosen as the deadlock victim on table Transactions. INSERT and UPDATE "
    "operations conflicted on clustered index. Transaction rolled back after 8.7 seconds.",
]
BUSINESS = [
    "Database NonExistentDB does not exist. Cannot process claim batch job.",
    "Transaction deadlock detected on table PolicyHolders. Victim process killed.",
    "Timeout expired connecting to database ClaimsDB. Connection pool exhausted.",
    "Cannot open database RequestedByLogin. Login failed for user sa.",
    "Disk space critically low on drive E:. Database auto-growth failed for InsuranceDB.",
    "Premium calculation service timeout. Stored procedure sp_CalculatePremium exceeded 30s threshold.",
    "Duplicate NRIC detected in PolicyHolders table. Constraint violation on insert batch.",
    "Transaction log full for database InsuranceDB. Cannot commit pending claim transactions.",
]
USERS = ["hacker", "dbadmin", "claimsapp", "root", "admin"]
NOW = at("2026-04-20 13:00:00")


@pytest.fixture(scope="session")
def golden(spark):
    """The 28 documented error events, one per minute before NOW."""
    found = [(911, f"Database '{d}' does not exist.") for d in ("NonExistentDB", "ClaimsDB", "ReportingDB")]
    found += [(208, f"Invalid object name 'dbo.{t}'.") for t in ("NonExistentTable", "AuditTrail")]
    found += [(17063, m) for m in BUSINESS]
    found += [(18456, f"Login failed for user '{u}'.") for u in USERS]
    found += [(3041, "BACKUP failed. Cannot open backup device 'Z:\\backups\\InsuranceDB.bak'.")]
    found += [(17063, m) for m in DEADLOCKS]
    found += [(17063, "DEADLOCK DETECTED (ACTUAL): Transaction (Process ID 61) was deadlocked on lock resources.")]
    found += [(17063, m) for m in SLOW]
    rows = [
        (NOW - dt.timedelta(minutes=len(found) - i), "MSSQL$SQLEXPRESS", "Application", event_id, "Error", 2, text,
         "vm-1")
        for i, (event_id, text) in enumerate(found)
    ]
    return spark.createDataFrame(
        rows,
        "TimeGenerated timestamp_ntz, Source string, EventLog string, EventID int, EventLevelName string, "
        "EventLevel int, RenderedDescription string, Computer string",
    ).cache()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
