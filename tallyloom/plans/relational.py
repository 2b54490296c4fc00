"""Join, aggregate, window, sort and set queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.functions import stats
from tallyloom.operators import metrics, model, reshape, stability
from tallyloom.plans.base import Tables, query
from tallyloom.plans.scalars import _CODED, coded
from tallyloom.sources import crosstab

c = F.col


@query("select o_orderkey, o_totalprice, c_mktsegment, c_nationkey from orders join customer on o_custkey = c_custkey")
def join_inner_using(t: Tables) -> DataFrame:
    dim = t.customer.select(c("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    return t.orders.select("o_orderkey", "o_totalprice", "o_custkey").join(dim, "o_custkey").drop("o_custkey")


@query(f"""with o as ({_CODED}) select o_orderkey, o_orderstatus, scale_max from o
  left join (select o_orderstatus as st, max(primary_code) as scale_max from o where o_orderstatus <> 'P' group by 1) on st = o_orderstatus""")
def join_left_scale(t: Tables) -> DataFrame:
    scale = model.scales(model.option_universe(coded(t).filter("o_orderstatus <> 'P'"), ["o_orderstatus"]), ["o_orderstatus"])
    return t.orders.join(scale, "o_orderstatus", "left").select("o_orderkey", "o_orderstatus", "scale_max")


@query("select l_orderkey, l_linenumber, l_partkey from lineitem where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus <> 'O')")
def join_anti_orphans(t: Tables) -> DataFrame:
    known = t.orders.filter("o_orderstatus <> 'O'").select(c("o_orderkey").alias("l_orderkey"))
    return t.lineitem.join(known, "l_orderkey", "left_anti").select("l_orderkey", "l_linenumber", "l_partkey")


RUN_ORDER = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
_RUNS = f"""(select *, row_number() over (partition by l_orderkey, l_linenumber order by {", ".join(RUN_ORDER)}) as run_no,
  count(*) over (partition by l_orderkey, l_linenumber) as run_count from lineitem)"""


def replicates(t: Tables) -> DataFrame:
    """lineitem with its repeated (order, line) rows numbered as runs, by all columns, since none is unique."""
    ranked = model.primary_run(t.lineitem, ["l_orderkey", "l_linenumber"], [c(k).asc() for k in RUN_ORDER])
    return ranked.withColumn("run_no", c("run_rank").cast("bigint"))


@query(f"""select a.l_orderkey, a.l_linenumber, a.run_no as run_no_a, b.run_no as run_no_b, a.l_returnflag as l_returnflag_a, b.l_returnflag as l_returnflag_b
  from {_RUNS} a join {_RUNS} b on a.l_orderkey = b.l_orderkey and a.l_linenumber = b.l_linenumber and a.run_no < b.run_no""")
def selfjoin_pairs(t: Tables) -> DataFrame:
    return stability.pairs(replicates(t), ["l_orderkey", "l_linenumber"], "run_no", ["l_returnflag"])


def cuts() -> dict:
    return {"TOTAL": F.lit("Total"), "SEGMENT": c("c_mktsegment"), "BALANCE": F.when(c("c_acctbal") < 0, "Debt").otherwise("Credit")}


_FANNED = """select o_orderkey, cut_name, cut_value from orders join customer on o_custkey = c_custkey,
  lateral (values ('TOTAL', 'Total'), ('SEGMENT', c_mktsegment), ('BALANCE', case when c_acctbal < 0 then 'Debt' else 'Credit' end)) v(cut_name, cut_value)"""


@query(_FANNED)
def banner_fanout(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, c("o_custkey") == c("c_custkey"))
    return reshape.fan_out(rows.select("o_orderkey", "c_mktsegment", "c_acctbal"), cuts()).select("o_orderkey", "cut_name", "cut_value")


@query("select event_type, count(*) as n, (select count(*) from events) as n_all from events group by event_type")
def agg_count(t: Tables) -> DataFrame:
    n_all = t.events.agg(F.count("*").alias("n_all"))
    return t.events.groupBy("event_type").agg(F.count("*").alias("n")).crossJoin(F.broadcast(n_all))  # one row


@query("select o_orderstatus, count(distinct o_custkey) as n_customers, count(distinct o_orderpriority) as n_priorities from orders group by 1")
def agg_count_distinct(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderstatus").agg(F.countDistinct("o_custkey").alias("n_customers"), F.countDistinct("o_orderpriority").alias("n_priorities"))


@query("""select count(*) as n_pairs from (select distinct o_custkey, nullif(o_orderpriority, '5-LOW') as p from orders)""")
def agg_distinct_composite(t: Tables) -> DataFrame:
    return t.orders.agg(F.countDistinct(F.struct("o_custkey", F.nullif(c("o_orderpriority"), F.lit("5-LOW")))).alias("n_pairs"))


@query("select user_id, count(*) filter (where value > 50)::bigint as n_over, count(*) filter (where nullif(event_type, 'view') = 'click')::bigint as n_click from events group by 1")
def agg_count_if(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.count_if(c("value") > 50).alias("n_over"), F.count_if(F.nullif(c("event_type"), F.lit("view")) == "click").alias("n_click"))


@query("""select user_id, bool_or(event_type = 'purchase' and value > 50) as big_buyer, bool_or(event_type = 'error') as saw_error,
  bool_or(case when event_type = 'signup' then value > 20 end) as eager from events group by 1""")
def persona_flags(t: Tables) -> DataFrame:
    kind = c("event_type")
    flags = {"big_buyer": (kind == "purchase") & (c("value") > 50), "saw_error": kind == "error", "eager": F.when(kind == "signup", c("value") > 20)}
    return metrics.persona_flags(t.events, "user_id", flags)


@query("""select event_type, round(avg(value), 6) as mean_value, round(avg(case when value > 50 then value end), 6) as mean_over, round(avg((value > 50)::bigint), 6) as share_over
  from events group by 1""")
def agg_avg_cond(t: Tables) -> DataFrame:
    v = c("value")
    return t.events.groupBy("event_type").agg(F.round(F.avg(v), 6).alias("mean_value"), F.round(F.avg(F.when(v > 50, v)), 6).alias("mean_over"), F.round(F.avg((v > 50).cast("bigint")), 6).alias("share_over"))


@query("select l_returnflag, sum(l_linenumber)::bigint as lines, round(sum(l_quantity), 2) as quantity from lineitem group by 1")
def agg_sum(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.sum("l_linenumber").alias("lines"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("select o_orderstatus, min(o_totalprice) as least, max(o_totalprice) as most, min(o_orderdate) as first_date from orders group by 1")
def agg_minmax(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderstatus").agg(F.min("o_totalprice").alias("least"), F.max("o_totalprice").alias("most"), F.min("o_orderdate").alias("first_date"))


@query("""select 'read_' || f as run_id, min('in/7-STUDY-' || upper(f) || '.csv') as source_file, count(*) as n_rows from
  (select case when o_orderstatus = 'F' then 'g' else 's' end || '_gr' || (o_custkey % 2 + 1) || '_2_' || (o_orderkey % 3 + 1) as f from orders) group by f""")
def dim_run_like(t: Tables) -> DataFrame:
    run = F.concat(F.when(c("o_orderstatus") == "F", "G").otherwise("S"), F.lit("_GR"), (c("o_custkey") % 2 + 1).cast("string"), F.lit("_2_"), (c("o_orderkey") % 3 + 1).cast("string"))
    rows = t.orders.select(F.concat(F.lit("in/7-STUDY-"), run, F.lit(".csv")).alias("_source_file"))
    return model.runs(rows).select("run_id", "source_file", "n_rows")


@query("select user_id, round(sum(value) / nullif(count(*) filter (where event_type = 'purchase'), 0), 6) as per_purchase from events group by 1")
def safe_divide(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.round(stats.share(F.sum("value"), F.count_if(c("event_type") == "purchase")), 6).alias("per_purchase"))


@query("select o_orderstatus, o_orderpriority, count(*) as n from orders group by 1, 2 order by 1, 2")
def groupby_ordinal(t: Tables) -> DataFrame:
    return t.spark.sql("select o_orderstatus, o_orderpriority, count(*) as n from {orders} group by 1, 2 order by 1, 2", orders=t.orders)


@query("select distinct c_nationkey, c_mktsegment from customer")
def distinct_rows(t: Tables) -> DataFrame:
    return t.customer.select("c_nationkey", "c_mktsegment").distinct()


@query(f"select l_orderkey, l_linenumber, {', '.join(RUN_ORDER)}, run_count, run_no = 1 as is_primary_run from {_RUNS}")
def win_primary_run(t: Tables) -> DataFrame:
    return replicates(t).select("l_orderkey", "l_linenumber", *RUN_ORDER, "run_count", "is_primary_run")


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey, count(*) over (partition by l_orderkey, l_linenumber) as run_count from lineitem")
def win_run_count(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.count("*").over(Window.partitionBy("l_orderkey", "l_linenumber")).alias("run_count"))


@query(f"select o_orderkey, max(case when code < 90 then code end) over (partition by o_custkey, o_orderstatus) as scale_max from ({_CODED})")
def win_scale_max(t: Tables) -> DataFrame:
    return coded(t).select("o_orderkey", F.max("primary_code").over(Window.partitionBy("o_custkey", "o_orderstatus")).alias("scale_max"))


@query("select o_custkey, o_orderkey, o_totalprice from orders qualify row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) = 1")
def win_topk_per_group(t: Tables) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return t.orders.select("o_custkey", "o_orderkey", "o_totalprice", nth.alias("nth")).filter("nth = 1").drop("nth")


@query("""select conv_id, turn, role, sum((role = 'user')::bigint) over (partition by conv_id order by turn rows unbounded preceding)::bigint as block_no from conversations""")
def block_sessionize(t: Tables) -> DataFrame:
    return crosstab.sessionize(t.conversations, c("role") == "user", ["turn"], ["conv_id"]).select("conv_id", "turn", "role", "block_no")


@query("select n_name, n_regionkey from nation order by n_regionkey desc nulls last, n_name asc nulls last")
def sort_attr(t: Tables) -> DataFrame:
    return t.nation.select("n_name", "n_regionkey").orderBy(F.desc_nulls_last("n_regionkey"), F.asc_nulls_last("n_name"))


@query("select c_mktsegment, c_nationkey, count(*) as n from customer group by 1, 2 order by 1, 3 desc, 2")
def sort_mixed(t: Tables) -> DataFrame:
    return t.customer.groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("n")).orderBy("c_mktsegment", F.desc("n"), "c_nationkey")


_UNION = " union all ".join(f"select '{k}' as section, {a} as id, {b} as name from {tb}" for k, a, b, tb in (("2.1", "c_custkey", "c_name", "customer"), ("2.2", "s_suppkey", "s_name", "supplier"), ("2.3", "p_partkey", "p_name", "part")))


@query(_UNION)
def union_all(t: Tables) -> DataFrame:
    out = None
    for section, df, key, name in (("2.1", t.customer, "c_custkey", "c_name"), ("2.2", t.supplier, "s_suppkey", "s_name"), ("2.3", t.part, "p_partkey", "p_name")):
        part = df.select(F.lit(section).alias("section"), c(key).alias("id"), c(name).alias("name"))
        out = part if out is None else out.unionByName(part)
    return out


@query("select c_nationkey as nation from customer union select s_nationkey from supplier")
def union_distinct(t: Tables) -> DataFrame:
    return t.customer.select(c("c_nationkey").alias("nation")).unionByName(t.supplier.select(c("s_nationkey").alias("nation"))).distinct()


@query("""select user_id as id, count(distinct m) as n_modalities from (select user_id, 'A' as m from events where event_type = 'click'
  union all select c_custkey, 'B' from customer union all select s_suppkey, 'C' from supplier) group by 1 having count(distinct m) > 1""")
def key_reuse(t: Tables) -> DataFrame:
    part = lambda df, key, m: df.select(c(key).alias("id"), F.lit(m).alias("m"))
    rows = part(t.events.filter("event_type = 'click'"), "user_id", "A").unionByName(part(t.customer, "c_custkey", "B")).unionByName(part(t.supplier, "s_suppkey", "C"))
    return model.reused_ids(rows, "id", "m")


@query(f"select distinct o_orderstatus, code as option_code, label as option_label, max(case when code < 90 then code end) over (partition by o_orderstatus) as scale_max from ({_CODED})")
def option_universe(t: Tables) -> DataFrame:
    return model.option_universe(coded(t), ["o_orderstatus"])

