"""Single operators over the raw sample tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stats as st
from ..functions import text as tx
from ..functions import timewin as tw
from ..operators import aggregates as ag
from ..operators import joins as jn
from ..operators import topk as tk
from ..operators import windows as wn
from ..session import fresh_path
from .registry import query

AS_OF = "2024-01-20 15:00:00"
TS_AS_OF = f"timestamp '{AS_OF}'"
ORDERS_AS_OF = "2001-08-02"


def _avg(expr: str) -> str:
    return f"cast(sum(cast({expr} as decimal(18,4))) as double) / count({expr})"


def _money(expr: str) -> str:
    return f"cast({expr} as decimal(12,2))"


def _d(expr: str) -> str:
    return f"cast({expr} as double)"


def _events(s):
    return s.table("events")


# Filters

def _filter(name: str, sql: str, condition, table: str = "events"):
    query(name, f"SELECT * FROM {table} WHERE {sql}")(lambda s: s.table(table).filter(condition()))


_filter("flt01_between_both", "ts BETWEEN timestamp '2024-01-10' AND timestamp '2024-01-11'",
        lambda: tw.time_between("ts", "2024-01-10", "2024-01-11"))
_filter("flt01_between_left", "ts >= timestamp '2024-01-10' AND ts < timestamp '2024-01-11'",
        lambda: tw.time_between("ts", "2024-01-10", "2024-01-11", "left"))
_filter("flt02_since", f"ts > {TS_AS_OF} - interval 24 hour AND ts <= {TS_AS_OF}",
        lambda: tw.since("ts", AS_OF, "24 hours"))
_filter("flt03_today", "ts > timestamp '2024-01-30' AND ts <= timestamp '2024-01-30 18:00:00'",
        lambda: tw.today("ts", "2024-01-30 18:00:00"))
_filter("flt04_this_week", f"ts > timestamp '2024-01-14' AND ts <= {TS_AS_OF}", lambda: tw.this_week("ts", AS_OF))
_filter("flt05_rolling_yesterday", f"ts BETWEEN {TS_AS_OF} - interval 2 day AND {TS_AS_OF} - interval 1 day",
        lambda: tw.rolling_yesterday("ts", AS_OF))
_filter("flt06_hour_window", "ts BETWEEN timestamp '2024-01-20 12:00:00' AND timestamp '2024-01-20 13:00:00'",
        lambda: tw.hour_window("ts", "2024-01-20 12:00:00"))
_filter("flt06_around", "ts BETWEEN timestamp '2024-01-20 11:00:00' AND timestamp '2024-01-20 13:00:00'",
        lambda: tw.hour_window("ts", "2024-01-20 12:00:00", around=True))
_filter("flt07_clamp_and_default", f"ts >= {TS_AS_OF} - interval 30 day AND ts <= {TS_AS_OF} "
        f"AND ts > {TS_AS_OF} - interval 24 hour",
        lambda: tw.clamp("ts", AS_OF) & tw.since("ts", AS_OF, "24h"))
_filter("flt08_equality", "event_type = 'error'", lambda: F.col("event_type") == "error")
_filter("flt09_contains", "contains(lower(event_type), 'rch')", lambda: tx.contains_ci("event_type", "RCH"))
_filter("flt10_in_list", "event_type IN ('error', 'view')", lambda: F.col("event_type").isin("error", "view"))
_filter("flt11_or_contains", "event_type ILIKE '%sign%' OR event_type ILIKE '%click%'",
        lambda: tx.contains_any("event_type", ["SIGN", "CLICK"]))
_filter("flt12_and", "event_type = 'error' AND user_id = 7",
        lambda: (F.col("event_type") == "error") & (F.col("user_id") == 7))
_filter("flt13_threshold", "o_totalprice > 100000", lambda: F.col("o_totalprice") > 100000, "orders")
_filter("flt14_status_list", "o_orderstatus IN ('O', 'P')", lambda: F.col("o_orderstatus").isin("O", "P"), "orders")
_filter("flt16_last_year", "o_orderdate >= timestamp '2000-08-02'",
        lambda: F.col("o_orderdate") >= tw.ts_lit(tw.years_before(ORDERS_AS_OF)), "orders")
_filter("flt16_last_30_days", "o_orderdate >= timestamp '2001-07-03'",
        lambda: F.col("o_orderdate") >= tw.ts_lit(tw.moment(ORDERS_AS_OF) - tw.span("30 days")), "orders")
_filter("flt17_any_like", "p_name ILIKE '%blue%' OR p_name ILIKE '%anvil%' OR p_name ILIKE '%RING%'",
        lambda: tx.any_like("p_name", ["%blue%", "%anvil%", "%RING%"]), "part")
_filter("flt18_any_column_like", "p_name ILIKE '%red%' OR p_brand ILIKE '%#17' OR p_type ILIKE '%econ%'",
        lambda: tx.any_col_like([("p_name", "%red%"), ("p_brand", "%#17"), ("p_type", "%econ%")]), "part")
_filter("flt20_prefix_recent", f"starts_with(event_type, 'pur') AND ts > {TS_AS_OF} - interval 24 hour "
        f"AND ts <= {TS_AS_OF}", lambda: F.col("event_type").startswith("pur") & tw.since("ts", AS_OF, "24h"))

query("flt15_expiring", """SELECT o_orderkey, cast(end_date as varchar) AS end_date FROM (
  SELECT o_orderkey, cast(o_orderdate as date) + 365 AS end_date FROM orders)
  WHERE end_date BETWEEN date '2001-06-01' AND date '2001-06-01' + 90""")(
    lambda s: s.bare_policies.select(F.col("policy_id").alias("o_orderkey"), "end_date").filter(
        tw.date_window("end_date", "2001-06-01", 90)))

query("flt15_expiring_midday", """SELECT o_orderkey, cast(end_date as varchar) AS end_date FROM (
  SELECT o_orderkey, cast(o_orderdate as date) + 365 AS end_date FROM orders)
  WHERE cast(end_date as timestamp) BETWEEN timestamp '2001-06-01 12:00:00'
  AND timestamp '2001-06-01 12:00:00' + interval 90 day""")(
    lambda s: s.bare_policies.select(F.col("policy_id").alias("o_orderkey"), "end_date").filter(
        tw.date_window("end_date", "2001-06-01 12:00:00", 90)))

query("flt19_not_null", """SELECT o_orderkey, l_partkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
  WHERE l_partkey IS NOT NULL""")(
    lambda s: s.table("orders").join(s.table("lineitem"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    .filter(F.col("l_partkey").isNotNull()).select("o_orderkey", "l_partkey"))

query("prj01_project", "SELECT ts, event_type FROM events")(lambda s: _events(s).select("ts", "event_type"))

query("prj02_computed", f"""SELECT o_orderkey AS policy_id, {_d(_money('o_totalprice') + ' * 2')} AS doubled,
  date_diff('day', cast(o_orderdate as date), date '{ORDERS_AS_OF}') AS age_days FROM orders""")(
    lambda s: s.table("orders").select(
        F.col("o_orderkey").alias("policy_id"), (st.money("o_totalprice") * 2).alias("doubled"),
        st.days_between("o_orderdate", as_of=ORDERS_AS_OF).alias("age_days")))

query("prj03_all_columns", "SELECT * FROM supplier")(lambda s: s.table("supplier").select("*"))

query("prj04_extend", """SELECT event_id, try_cast(nullif(regexp_extract(props, '"k": ([0-9]+)', 1), '') as bigint)
  AS k FROM events""")(
    lambda s: _events(s).select(
        "event_id", F.nullif(F.regexp_extract("props", r'"k": (\d+)', 1), F.lit("")).try_cast("bigint").alias("k")))


# Joins

query("jn01_star_join", """SELECT p_type, s_name, n_name, count(*) AS n FROM lineitem
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""")(
    lambda s: jn.star_join(
        s.table("lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey")),
        [(s.table("part").select("p_partkey", "p_type"), "p_partkey"),
         (s.table("supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey")), "s_suppkey"),
         (s.table("nation").select("n_nationkey", "n_name"), "n_nationkey")],
    ).groupBy("p_type", "s_name", "n_name").agg(F.count("*").alias("n")))


def _lines(s, *cols):
    return s.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), *cols)


query("jn02_left_join_aggregate", f"""SELECT o_orderstatus, count(*) AS policies, count(n) AS with_lines,
  {_d('sum(amount)')} AS amount FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n,
  sum({_money('l_extendedprice')}) AS amount FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1""")(
    lambda s: jn.left_agg(
        s.table("orders"), _lines(s, "l_extendedprice"), "o_orderkey", ["o_orderstatus"],
        [F.count("*").alias("n"), F.sum(st.money("l_extendedprice")).alias("amount")],
        [F.count("*").alias("policies"), F.count("n").alias("with_lines"), F.sum("amount").alias("amount")]))

query("jn03_semi_join_single", """SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (
  SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey HAVING count(*) = 1)""")(
    lambda s: s.table("customer").select("c_custkey", "c_name").join(
        jn.keys_with_count(
            s.table("orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")),
            "c_custkey"), "c_custkey", "left_semi"))

query("jn04_above_own_mean", """SELECT DISTINCT o.o_custkey FROM orders o WHERE cast(o.o_totalprice as decimal(12,2)) >
  (SELECT 2 * avg(cast(i.o_totalprice as decimal(12,2))) FROM orders i WHERE i.o_custkey = o.o_custkey)""")(
    lambda s: jn.groups_above_own_mean(
        s.table("orders").select("o_custkey", st.money("o_totalprice").alias("price"), F.lit(1).alias("one")),
        "o_custkey", "price", "price", "one"))

query("jn05_above_global_mean", f"""SELECT o_orderkey FROM orders WHERE {_d(_money('o_totalprice'))} >
  (SELECT {_d('sum(' + _money('o_totalprice') + ')')} / count(*) * 1.5::double FROM orders)""")(
    lambda s: jn.above_global_mean(
        s.table("orders").select("o_orderkey", st.money("o_totalprice").alias("price")), "price", 1.5
    ).select("o_orderkey"))

query("jn06_cross_count", """SELECT cast((SELECT count(*) FROM customer WHERE c_name ILIKE '%1%') as double)
  * (SELECT count(*) FROM supplier) * (SELECT count(*) FROM part WHERE p_size > 10) AS pair_count""")(
    lambda s: jn.cross_count([
        s.table("customer").filter(F.col("c_name").ilike("%1%")), s.table("supplier"),
        s.table("part").filter("p_size > 10")]))

query("jn07_outer_apply_sum", f"""SELECT o.o_orderkey, {_d('s.total')} AS total FROM orders o LEFT JOIN LATERAL (
  SELECT sum({_money('l.l_extendedprice')}) AS total FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) s ON true""")(
    lambda s: jn.attach_aggs(
        s.table("orders").select("o_orderkey"), _lines(s, "l_extendedprice"), "o_orderkey",
        [F.sum(st.money("l_extendedprice")).alias("total")]))

query("jn08_named_expression", f"""SELECT o_orderkey, cast(d as varchar) AS day, {_d('v * 2')} AS twice FROM (
  SELECT o_orderkey, cast(o_orderdate as date) AS d, {_money('o_totalprice')} AS v FROM orders)""")(
    lambda s: jn.with_named(
        s.table("orders").select("o_orderkey", "o_orderdate", "o_totalprice"),
        {"day": F.to_date("o_orderdate"), "twice": st.money("o_totalprice") * 2},
    ).select("o_orderkey", "day", "twice"))

query("jn09_pick_one", """SELECT o.o_orderkey, l.l_partkey, l.l_linenumber FROM orders o JOIN LATERAL (
  SELECT l_partkey, l_linenumber FROM lineitem WHERE l_orderkey = o.o_orderkey
  ORDER BY l_extendedprice, l_partkey, l_linenumber LIMIT 1) l ON true""")(
    lambda s: jn.pick_one(
        s.table("orders").select("o_orderkey"), _lines(s, "l_partkey", "l_linenumber", "l_extendedprice"),
        "o_orderkey", ["l_extendedprice", "l_partkey", "l_linenumber"],
    ).select("o_orderkey", "l_partkey", "l_linenumber"))

query("jn10_scalar_subqueries", f"""SELECT o.o_orderkey,
  (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS lines,
  {_d(f"(SELECT max({_money('l.l_extendedprice')}) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)")} AS largest,
  {_d(f"(SELECT sum({_money('l.l_extendedprice')}) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)")} AS total
  FROM orders o""")(
    lambda s: jn.attach_aggs(
        s.table("orders").select("o_orderkey"), _lines(s, st.money("l_extendedprice").alias("price")), "o_orderkey",
        [F.count("*").alias("lines"), F.max("price").alias("largest"), F.sum("price").alias("total")], ["lines"]))

query("jn11_update_from_join", """SELECT c_custkey, coalesce(o.last, c_name) AS c_name FROM customer LEFT JOIN (
  SELECT o_custkey, max(o_orderpriority) AS last FROM orders GROUP BY 1) o ON o_custkey = c_custkey""")(
    lambda s: jn.update_from(
        s.table("customer").select("c_custkey", "c_name"),
        ag.greatest_text(s.table("orders").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"], "o_orderpriority", "last"),
        "c_custkey", {"c_name": "last"}))

query("jn12_self_cross_count", """SELECT cast(count(*) as double) AS pair_count FROM customer a, customer b
  WHERE a.c_name ILIKE '%1%' AND b.c_name ILIKE '%2%'""")(
    lambda s: jn.cross_count([
        s.table("customer").filter(F.col("c_name").ilike("%1%")),
        s.table("customer").filter(F.col("c_name").ilike("%2%"))]))


# Aggregations

query("agg01_count_by", """SELECT event_type, user_id, count(*) AS "Count" FROM events GROUP BY 1, 2""")(
    lambda s: ag.count_by(_events(s), ["event_type", "user_id"]))

_HOUR = "time_bucket(interval 1 hour, ts)"
query("agg02_hourly_mean", f"SELECT {_HOUR} AS ts, {_avg('value')} AS mean FROM events GROUP BY 1")(
    lambda s: ag.bin_agg(_events(s), "ts", "1 hour", [st.exact_avg("value").alias("mean")]))

query("agg03_hourly_max_mean", f"""SELECT {_HOUR} AS ts, event_type, max(value) AS highest, {_avg('value')} AS mean
  FROM events GROUP BY 1, 2""")(
    lambda s: ag.bin_agg(_events(s), "ts", "1 hour",
                         [F.max("value").alias("highest"), st.exact_avg("value").alias("mean")], ["event_type"]))

query("agg04_mean_by", f"SELECT event_type, user_id, {_avg('value')} AS mean FROM events GROUP BY 1, 2")(
    lambda s: ag.mean_by(_events(s), ["event_type", "user_id"], "value", "mean"))

query("agg04_mean_with_nan", f"""SELECT event_type, bool_or(event_id % 97 = 0) AS odd,
  CASE WHEN NOT bool_or(event_id % 97 = 0) THEN {_avg('value')} END AS mean, user_id FROM events
  GROUP BY event_type, user_id""")(
    lambda s: ag.mean_by(
        _events(s).withColumn("value", F.expr("CASE WHEN event_id % 97 = 0 THEN double('NaN') ELSE value END")),
        ["event_type", "user_id"], "value", "mean",
    ).select("event_type", F.isnan("mean").alias("odd"), F.nanvl("mean", F.lit(None).cast("double")).alias("mean"), "user_id"))

query("agg05_distinct_counts", """SELECT l_returnflag, count(DISTINCT l_orderkey) AS distinct_l_orderkey,
  count(DISTINCT l_partkey) AS distinct_l_partkey, count(DISTINCT l_suppkey) AS distinct_l_suppkey
  FROM lineitem GROUP BY 1""")(
    lambda s: ag.distinct_counts(s.table("lineitem"), ["l_returnflag"], ["l_orderkey", "l_partkey", "l_suppkey"]))

query("agg05_approx_distinct", """SELECT DISTINCT l_returnflag, true AS orders_close, true AS parts_close
  FROM lineitem""")(lambda s: _approx_against_exact(s.table("lineitem")))


def _approx_against_exact(lines):
    """Do the sketches stay within three times their 5 % relative error?"""
    cols = ["l_orderkey", "l_partkey"]
    exact = ag.distinct_counts(lines, ["l_returnflag"], cols)
    rough = ag.distinct_counts(lines, ["l_returnflag"], cols, approx=True)
    both = exact.toDF("l_returnflag", "orders", "parts").join(
        rough.toDF("l_returnflag", "rough_orders", "rough_parts"), "l_returnflag")
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.col(a) * 0.15
    return both.select(
        "l_returnflag", close("orders", "rough_orders").alias("orders_close"),
        close("parts", "rough_parts").alias("parts_close"))


query("agg06_conditional_count", """SELECT o_custkey, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS pending
  FROM orders GROUP BY 1""")(
    lambda s: s.table("orders").groupBy("o_custkey").agg(
        st.count_where(F.col("o_orderstatus") == "P").alias("pending")))

query("agg07_conditional_sum", """SELECT o_custkey, cast(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END)
  as bigint) AS pending FROM orders GROUP BY 1""")(
    lambda s: s.table("orders").groupBy("o_custkey").agg(
        st.sum_where(F.col("o_orderstatus") == "P").alias("pending")))

query("agg08_safe_percentage", f"""SELECT p_brand, {_d('''cast(count(CASE WHEN p_type = 'ECONOMY' THEN 1 END) * 100.0
  / nullif(count(CASE WHEN p_size > 25 THEN 1 END), 0) as decimal(5,1))''')} AS pct FROM part GROUP BY 1""")(
    lambda s: s.table("part").groupBy("p_brand").agg(
        st.safe_pct(st.count_where(F.col("p_type") == "ECONOMY"), st.count_where(F.col("p_size") > 25)).alias("pct")))

query("agg09_monthly_stats", f"""SELECT strftime(l_shipdate, '%Y-%m') AS month, l_returnflag, count(*) AS txn_count,
  {_d(f"sum({_money('l_extendedprice')})")} AS total_amount, {_avg(_money('l_extendedprice'))} AS avg_amount,
  min(l_extendedprice) AS min_amount, max(l_extendedprice) AS max_amount FROM lineitem GROUP BY 1, 2""")(
    lambda s: ag.monthly_stats(s.table("lineitem"), "l_shipdate", ["l_returnflag"], "l_extendedprice"))

query("agg10_sum_with_zero", f"""SELECT o_custkey, {_d(f"sum(coalesce(CASE WHEN o_orderstatus = 'P' THEN {_money('o_totalprice')} END, 0))")}
  AS total FROM orders GROUP BY 1""")(
    lambda s: s.table("orders").groupBy("o_custkey").agg(
        st.sum0(F.when(F.col("o_orderstatus") == "P", st.money("o_totalprice"))).alias("total")))

query("agg11_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 12")(
    lambda s: s.table("orders").groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n > 12"))

_DAYS = "date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date))"
query("agg12_day_stats", f"""SELECT l_returnflag, count(*) AS claim_count,
  cast(trunc(cast(sum({_DAYS}) as double) / count(*)) as bigint) AS avg_processing_days, min({_DAYS}) AS min_days,
  max({_DAYS}) AS max_days FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")(
    lambda s: ag.day_stats(
        s.table("lineitem").join(s.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")),
        "o_orderdate", "l_shipdate", ["l_returnflag"]))

query("agg13_case_over_aggregates", f"""SELECT l_suppkey, CASE WHEN a > b * 2 THEN 'High Risk' WHEN a > b
  THEN 'Medium Risk' ELSE 'Low Risk' END AS tier, CASE WHEN q <> 100 THEN 'NEEDS REVIEW' ELSE 'OK' END AS allocation
  FROM (SELECT l_suppkey, sum(CASE WHEN l_linestatus = 'F' THEN {_money('l_extendedprice')} ELSE 0 END) AS a,
  sum(CASE WHEN l_returnflag = 'R' THEN {_money('l_extendedprice')} ELSE 0 END) AS b, sum(l_quantity) AS q
  FROM lineitem GROUP BY 1)""")(
    lambda s: s.table("lineitem").groupBy("l_suppkey").agg(
        F.sum(F.when(F.col("l_linestatus") == "F", st.money("l_extendedprice")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("l_returnflag") == "R", st.money("l_extendedprice")).otherwise(0)).alias("b"),
        F.sum("l_quantity").alias("q"),
    ).select("l_suppkey", st.risk_tier(F.col("a"), F.col("b")).alias("tier"),
             st.allocation_status(F.col("q")).alias("allocation")))

query("agg14_distinct_list", """SELECT p_brand, string_agg(DISTINCT p_name, ', ' ORDER BY p_name) AS names
  FROM part GROUP BY 1""")(lambda s: ag.distinct_list(s.table("part"), ["p_brand"], "p_name", "names"))

query("agg15_global_count", "SELECT count(*) AS n FROM lineitem")(
    lambda s: s.table("lineitem").agg(F.count("*").alias("n")))

query("agg16_scalar_threshold", f"""SELECT {_d(f"sum({_money('o_totalprice')})")} / count(*) * 2 AS threshold
  FROM orders""")(
    lambda s: s.table("orders").agg((st.exact_avg("o_totalprice", st.MONEY) * 2).alias("threshold")))

query("agg17_group_by_level", """SELECT event_type, count(*) AS "Count" FROM events
  WHERE event_type IN ('error', 'view') GROUP BY 1""")(
    lambda s: ag.count_by(_events(s).filter(F.col("event_type").isin("error", "view")), ["event_type"]))

query("agg18_distinct_sorted", "SELECT DISTINCT p_name FROM part")(
    lambda s: ag.distinct_sorted(s.table("part"), "p_name"))

query("agg18_first_seen", "SELECT p_name, min(p_partkey) AS first_key FROM part GROUP BY 1")(
    lambda s: ag.first_seen(s.table("part"), ["p_name"], ["p_partkey"]).select(
        "p_name", F.col("first_pos.p_partkey").alias("first_key")))


# Windows, order, sets

query("win01_running_total", f"""SELECT cast(cast(l_shipdate as date) as varchar) AS day, l_returnflag,
  {_d(f"sum({_money('l_extendedprice')})")} AS daily, {_d(f'''sum(sum({_money('l_extendedprice')})) OVER (
  PARTITION BY l_returnflag ORDER BY cast(l_shipdate as date))''')} AS running
  FROM lineitem GROUP BY cast(l_shipdate as date), l_returnflag""")(
    lambda s: wn.running_total(
        s.table("lineitem").groupBy(F.to_date("l_shipdate").alias("day"), "l_returnflag").agg(
            F.sum(st.money("l_extendedprice")).alias("daily")),
        ["l_returnflag"], "day", "daily", "running"))

query("win02_numbered_references", """SELECT o_orderkey, concat('REF', right(concat('000',
  cast(row_number() OVER (ORDER BY o_orderkey) as varchar)), 3)) AS ref FROM (SELECT o_orderkey FROM orders
  ORDER BY md5(concat(cast(o_orderkey as varchar), 's')), o_orderkey LIMIT 25)""")(
    lambda s: wn.number_rows(
        tk.sample_k(s.table("orders").select("o_orderkey"), "o_orderkey", 25, "s"), ["o_orderkey"], F.lit("REF"),
        "ref"))

query("win03_row_sequence", """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders
 """)(
    lambda s: wn.dense_ids(
        s.table("orders").select("o_orderkey"), "o_orderkey", "n", fresh_path(s.spark, "numbered")))

query("srt01_one_key", "SELECT event_id, value FROM events")(
    lambda s: _events(s).select("event_id", "value").orderBy(F.col("value").desc(), "event_id"))
query("srt02_mixed_keys", "SELECT event_type, value, event_id FROM events ORDER BY value DESC, event_type, event_id")(
    lambda s: _events(s).select("event_type", "value", "event_id").orderBy(
        F.col("value").desc(), "event_type", "event_id"))
query("srt03_take", "SELECT event_id FROM events ORDER BY event_id LIMIT 50")(
    lambda s: tk.take(_events(s).select("event_id").orderBy("event_id"), 50))
query("srt04_top_k", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 30")(
    lambda s: tk.top_k(_events(s).select("event_id", "value"), [F.col("value").desc(), "event_id"], 30))
query("srt05_random_sample", """SELECT event_id FROM events
  ORDER BY md5(concat(cast(event_id as varchar), 'x')), event_id LIMIT 10""")(
    lambda s: tk.sample_k(_events(s).select("event_id"), "event_id", 10, "x"))
query("srt06_order_by_count", """SELECT event_type, count(*) AS count_ FROM events GROUP BY 1 ORDER BY count_ DESC""")(
    lambda s: ag.count_by(_events(s), ["event_type"], "count_").orderBy(F.col("count_").desc()))

query("set01_union_of_kinds", """SELECT event_id, event_type FROM events WHERE event_type = 'error' UNION ALL
  SELECT event_id, event_type FROM events WHERE event_type = 'view'""")(
    lambda s: _events(s).filter("event_type = 'error'").unionByName(_events(s).filter("event_type = 'view'"))
    .select("event_id", "event_type"))

query("set02_union_first_seen", """SELECT p_type, name AS p_name, side, pos AS p_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY side, pos) AS r FROM (
  SELECT p_type, name, side, pos, row_number() OVER (PARTITION BY p_type, name ORDER BY side, pos) AS d FROM (
  SELECT p_type, p_name AS name, 0 AS side, p_partkey AS pos FROM part WHERE p_size > 40
  UNION ALL SELECT p_type, p_name, 1, p_partkey FROM part WHERE p_size < 10)) WHERE d = 1) WHERE r <= 30""")(
    lambda s: tk.union_first_seen(
        s.table("part").filter("p_size > 40").select("p_type", "p_name", "p_partkey"),
        s.table("part").filter("p_size < 10").select("p_type", "p_name", "p_partkey"),
        "p_type", "p_name", "p_partkey", 30))

query("set03_first_per_key", """SELECT p_brand, p_name, min(p_partkey) AS p_partkey FROM part GROUP BY 1, 2""")(
    lambda s: s.table("part").groupBy("p_brand", "p_name").agg(F.min("p_partkey").alias("p_partkey")))


# Scalar functions

query("fn_concat_and_pad", """SELECT c_custkey, concat('AGT', right(concat('000', cast(c_custkey as varchar)), 3))
  AS code FROM customer""")(
    lambda s: s.table("customer").select(
        "c_custkey", F.concat(F.lit("AGT"), tx.zero_pad("c_custkey", 3)).alias("code")))

query("fn_preview", "SELECT doc_id, concat(left(text, 150), '...') AS preview FROM documents")(
    lambda s: s.table("documents").select("doc_id", tx.preview("text").alias("preview")))

_SP = "'^[\\s\\p{Z}]+|[\\s\\p{Z}]+$'"
query("fn_first_sentence", f"""SELECT doc_id, regexp_replace(left(regexp_extract(text, '^[^.\\n]*'), 120), {_SP}, '',
  'g') AS sentence FROM documents""")(
    lambda s: s.table("documents").select("doc_id", tx.first_sentence("text").alias("sentence")))

query("fn_slug_title", """SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w:
  concat(upper(left(w, 1)), lower(substr(w, 2)))), ' ') AS title FROM part""")(
    lambda s: s.table("part").select(
        "p_partkey",
        tx.slug_title(F.concat(F.lit("https://x.example/a/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("/")))
        .alias("title")))

_FOUND = "regexp_extract_all(text, '(?i)(tion|ment|heit)', 1)"
query("fn_keywords", f"""SELECT doc_id, array_to_string(list_filter({_FOUND},
  lambda x, i: list_position({_FOUND}, x) = i), ' ') AS found FROM documents""")(
    lambda s: s.table("documents").select(
        "doc_id", F.array_join(tx.found_keywords("text", ["tion", "ment", "heit"]), " ").alias("found")))

query("fn_trim_left", f"SELECT conv_id, turn, left(regexp_replace(text, {_SP}, '', 'g'), 150) AS head FROM conversations")(
    lambda s: s.table("conversations").select("conv_id", "turn", F.left(tx.strip("text"), F.lit(150)).alias("head")))

query("fn_json_value", """SELECT event_id, cast(json_extract_string(props, '$.k') as bigint) AS k FROM events""")(
    lambda s: _events(s).select(
        "event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k")))

query("fn_bins", """SELECT event_id, time_bucket(interval 1 hour, ts) AS hour, time_bucket(interval 5 minute, ts)
  AS five_minutes FROM events""")(
    lambda s: _events(s).select(
        "event_id", tw.bin_start("ts", "1 hour").alias("hour"), "ts").select(
        "event_id", "hour", tw.bin_start("ts", "5 minutes").alias("five_minutes")))

query("fn_date_arithmetic", """SELECT o_orderkey, date_diff('day', cast(o_orderdate as date), date '2001-08-02') AS age,
  cast(cast(o_orderdate as date) + 90 as varchar) AS plus_days,
  cast(cast(o_orderdate + interval 2 year as date) as varchar) AS plus_years,
  o_orderdate + interval 45 minute AS plus_minutes FROM orders""")(
    lambda s: s.table("orders").select(
        "o_orderkey", st.days_between("o_orderdate", as_of=ORDERS_AS_OF).alias("age"),
        F.date_add("o_orderdate", 90).alias("plus_days"),
        F.add_months("o_orderdate", 24).alias("plus_years"),
        (F.col("o_orderdate") + F.expr("INTERVAL 45 MINUTE")).alias("plus_minutes")))

query("fn_date_format", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month,
  strftime(o_orderdate, '%Y%m%d') AS day, cast(cast(o_orderdate as date) as varchar) AS as_date FROM orders""")(
    lambda s: s.table("orders").select(
        "o_orderkey", st.month_of("o_orderdate").alias("month"), F.date_format("o_orderdate", "yyyyMMdd").alias("day"),
        F.to_date("o_orderdate").alias("as_date")))

query("fn_decimal_math", f"""SELECT o_orderkey, {_d(f"cast({_money('o_totalprice')} * 0.85 as decimal(12,2))")} AS share,
  {_d(f"cast({_money('o_totalprice')} * 100.0 as decimal(18,2))")} AS cents, o_orderkey % 7 AS remainder,
  abs(o_orderkey - 5000) AS distance FROM orders""")(
    lambda s: s.table("orders").select(
        "o_orderkey", (st.money("o_totalprice") * F.lit("0.85").cast("decimal(3,2)")).cast(st.MONEY).alias("share"),
        (st.money("o_totalprice") * 100).cast("decimal(18,2)").alias("cents"),
        F.pmod("o_orderkey", F.lit(7)).alias("remainder"), F.abs(F.col("o_orderkey") - 5000).alias("distance")))

query("fn_null_handling", """SELECT s_suppkey, coalesce(nullif(s_nationkey, 3), -1) AS nation,
  nullif(s_nationkey, 3) AS maybe FROM supplier""")(
    lambda s: s.table("supplier").select(
        "s_suppkey", F.coalesce(F.nullif("s_nationkey", F.lit(3)), F.lit(-1)).alias("nation"),
        F.nullif("s_nationkey", F.lit(3)).alias("maybe")))

query("fn_case_and_choose", """SELECT p_partkey, CASE WHEN p_size > 40 THEN 'large' WHEN p_size > 20 THEN 'medium'
  ELSE 'small' END AS size_class, CASE p_size WHEN 1 THEN 'one' WHEN 2 THEN 'two' WHEN 3 THEN 'three' END AS word
  FROM part""")(
    lambda s: s.table("part").select(
        "p_partkey",
        F.when(F.col("p_size") > 40, "large").when(F.col("p_size") > 20, "medium").otherwise("small")
        .alias("size_class"),
        tx.choose("p_size", "one", "two", "three").alias("word")))

query("fn_casts", """SELECT c_custkey, cast(cast(c_acctbal as decimal(12,1)) as double) AS rounded,
  cast(c_custkey as varchar) AS as_text, try_cast(c_name as bigint) AS not_a_number FROM customer""")(
    lambda s: s.table("customer").select(
        "c_custkey", F.col("c_acctbal").cast("decimal(12,1)").alias("rounded"),
        F.col("c_custkey").cast("string").alias("as_text"), F.col("c_name").try_cast("bigint").alias("not_a_number")))
