"""Relational queries over the star-schema and event tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import relational as R
from paperloom.operators import render as RD
from paperloom.registry import Registry
from paperloom.session import table

RELATIONAL = Registry()


@RELATIONAL.add("rel_first_order", "select o_custkey, o_orderdate, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1")
def rel_first_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first order of each customer (keep-first distinct)."""
    return R.first_by(table(spark, sf_dir, "orders", "o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@RELATIONAL.add("rel_semi", "select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F')")
def rel_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a finished order."""
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus").where("o_orderstatus = 'F'")
    return table(spark, sf_dir, "customer", "c_custkey").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_semi")


@RELATIONAL.add("rel_anti", "select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)")
def rel_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without orders."""
    o = table(spark, sf_dir, "orders", "o_custkey")
    return table(spark, sf_dir, "customer", "c_custkey").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@RELATIONAL.add(
    "rel_unique_lookup",
    "select s_suppkey, n.n_name from supplier s left join (select n_nationkey, min(n_name) as n_name from nation group by 1 having count(*) = 1) n on n.n_nationkey = s.s_nationkey",
)
def rel_unique_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with their nation, if the key is unique."""
    s = table(spark, sf_dir, "supplier", "s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    return R.unique_lookup(s, table(spark, sf_dir, "nation", "n_nationkey", "n_name"), "n_nationkey", "n_name").select("s_suppkey", "n_name")


@RELATIONAL.add(
    "rel_band",
    "select a.l_orderkey, a.l_linenumber as a, b.l_linenumber as b from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey and abs(a.l_quantity - b.l_quantity) <= 3 and a.l_linenumber < b.l_linenumber",
)
def rel_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order whose quantities differ by three at most."""
    l = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    a = l.select("l_orderkey", F.col("l_linenumber").alias("a"), F.col("l_quantity").alias("qa"))
    b = l.select("l_orderkey", F.col("l_linenumber").alias("b"), F.col("l_quantity").alias("qb"))
    return R.band_join(a, b, "l_orderkey", "qa", "qb", 3).where("a < b").select("l_orderkey", "a", "b")


@RELATIONAL.add(
    "rel_as_of",
    """with p as (select event_id, user_id, ts from events where event_type = 'purchase'), c as (select user_id, ts, max(value) as value from events where event_type = 'click' group by 1, 2)
    select p.event_id, (select arg_max(c.value, c.ts) from c where c.user_id = p.user_id and c.ts <= p.ts) as value from p""",
)
def rel_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the value of the user's latest click."""
    e = table(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type", "value")
    p = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    c = e.where("event_type = 'click'").groupBy("user_id", "ts").agg(F.max("value").alias("value"))
    return R.as_of(p, c, "user_id", "ts", "value").select("event_id", "value")


@RELATIONAL.add(
    "rel_sessions",
    """with s as (select user_id, ts, event_id, case when ts - lag(ts) over w > interval 6 hour then 1 else 0 end as brk from events window w as (partition by user_id order by ts, event_id)),
    i as (select user_id, ts, sum(brk) over (partition by user_id order by ts, event_id rows unbounded preceding) as island from s)
    select user_id, cast(island as bigint) as island, count(*) as n from i group by 1, 2""",
)
def rel_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user by a gap of six hours."""
    e = table(spark, sf_dir, "events", "user_id", "ts", "event_id")
    return R.sessions(e, "user_id", "ts", F.expr("interval 6 hours")).groupBy("user_id", F.col("island").cast("bigint").alias("island")).agg(F.count("*").alias("n"))


@RELATIONAL.add("rel_top_k", "select o_custkey, o_orderkey, cast(rank as int) as rank from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rank from orders) where rank <= 3")
def rel_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three dearest orders of each customer."""
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_totalprice")
    return R.top_k(o, "o_custkey", [F.desc("o_totalprice"), F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey", "rank")


@RELATIONAL.add(
    "rel_rank_assign",
    """with s as (select s_nationkey as nation, s_suppkey, row_number() over (partition by s_nationkey order by s_suppkey) as r from supplier),
    c as (select c_nationkey as nation, c_custkey, row_number() over (partition by c_nationkey order by c_custkey) as r from customer) select s.nation, s_suppkey, c_custkey from s join c using (nation, r)""",
)
def rel_rank_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The k-th customer of a nation to its k-th supplier."""
    s = table(spark, sf_dir, "supplier", F.col("s_nationkey").alias("nation"), "s_suppkey")
    c = table(spark, sf_dir, "customer", F.col("c_nationkey").alias("nation"), "c_custkey")
    return R.rank_assign(s, c, "nation", "s_suppkey", "c_custkey").select("nation", "s_suppkey", "c_custkey")


@RELATIONAL.add("rel_budget", "select l_orderkey, l_linenumber from (select *, sum(l_quantity) over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity rows unbounded preceding) as used from lineitem) where used <= 60")
def rel_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order within a running quantity of sixty."""
    l = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return R.within_budget(l, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], F.col("l_quantity"), 60).select("l_orderkey", "l_linenumber")


@RELATIONAL.add("rel_except", "select distinct p_partkey from part where p_partkey not in (select l_partkey from lineitem)")
def rel_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that no line names."""
    used = table(spark, sf_dir, "lineitem", F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf_dir, "part", "p_partkey").distinct().join(used, "p_partkey", "left_anti")


@RELATIONAL.add(
    "rel_compare",
    """with a as (select o_orderkey, o_orderstatus from orders where o_orderkey % 3 <> 0), b as (select o_orderkey, o_orderpriority, case when o_orderpriority like '1%' then 'P' else o_orderstatus end as o_orderstatus from orders where o_orderkey % 5 <> 0)
    select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey, case when a.o_orderkey is null then 'added' when b.o_orderkey is null then 'removed' when a.o_orderstatus is not distinct from b.o_orderstatus then 'same' else 'changed' end as diff from a full join b on a.o_orderkey = b.o_orderkey""",
)
def rel_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of the orders compared row by row (the versions are made by rule, so that each outcome occurs)."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    a = o.where("o_orderkey % 3 <> 0")
    b = o.where("o_orderkey % 5 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderpriority").startswith("1"), "P").otherwise(F.col("o_orderstatus")))
    return R.compare(a, b, "o_orderkey", "o_orderstatus")


@RELATIONAL.add(
    "rel_pricing",
    """select l_returnflag, l_linestatus, sum(l_quantity) as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, count(*) as n from lineitem where l_shipdate <= timestamp '1998-09-02' group by 1, 2""",
)
def rel_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped sums with partial aggregation."""
    l = table(spark, sf_dir, "lineitem", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
    return l.where("l_shipdate <= timestamp '1998-09-02'").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n")
    )


@RELATIONAL.add(
    "rel_progress",
    """with e as (select user_id as run_id, event_id as seq, cast(1 + event_id % 4 as int) as stage, (event_id % 100) / 100.0 as fraction from events),
    r as (select run_id, seq, cast(round(case stage when 1 then 70 * fraction when 2 then 70 + 10 * fraction when 3 then 80 + 10 * fraction else 90 + 10 * fraction end) as int) as p from e)
    select run_id, seq, max(p) over (partition by run_id order by seq rows unbounded preceding) as percent from r""",
)
def rel_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monotone percentages of runs from stage events."""
    e = table(spark, sf_dir, "events", "user_id", "event_id").select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"), (1 + F.col("event_id") % 4).cast("int").alias("stage"), ((F.col("event_id") % 100) / 100.0).alias("fraction")
    )
    return RD.progress(e)


@RELATIONAL.add(
    "rel_best_attempt",
    "select paper_id, attempt from (select o_custkey as paper_id, o_orderkey as attempt, row_number() over (partition by o_custkey order by o_orderkey % 3, -(o_orderkey % 7), -(o_orderkey % 5), o_orderkey) as k from orders) where k = 1",
)
def rel_best_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of several attempts by an ordered score."""
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderkey").select(
        F.col("o_custkey").alias("paper_id"), F.col("o_orderkey").alias("attempt"), (F.col("o_orderkey") % 3).alias("severe"), (F.col("o_orderkey") % 7).alias("objects"), (F.col("o_orderkey") % 5).alias("markers")
    )
    return RD.best_attempts(o)


@RELATIONAL.add("stream_daily_events", "select strftime(ts, '%Y-%m-%d') as day, event_type, count(*) as n, round(sum(value), 2) as total from events group by 1, 2")
def stream_daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per day and type, computed by a stream over the files that are there."""
    from paperloom.streaming import ingest

    return ingest.run_to_table(ingest.windowed_counts(ingest.stream_table(spark, sf_dir, "events")), "stream_daily_events")


@RELATIONAL.add("stream_sessions")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user, computed by a stream."""
    from paperloom.streaming import ingest

    return ingest.run_to_table(ingest.user_sessions(ingest.stream_table(spark, sf_dir, "events")), "stream_sessions")
