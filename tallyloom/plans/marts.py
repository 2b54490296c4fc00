"""Mart queries: banners, tests between cuts, stability, calibration, the data-quality suite."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.functions import parse, stats
from tallyloom.operators import calibration, metrics, model, quality, reshape, stability
from tallyloom.plans.base import Tables, query
from tallyloom.plans.relational import _RUNS, cuts
from tallyloom.plans.scalars import _CODED, coded, scaled

c = F.col
KEY = ["o_orderstatus"]


def answers(t: Tables) -> DataFrame:
    """Coded, boxed orders with their customer's attributes."""
    dim = t.customer.select(c("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal", "c_nationkey")
    return metrics.with_boxes(scaled(t)).join(dim, "o_custkey")


_ANSWERS = f"""(select *, primary_code = 1 as is_tb, primary_code in (1, 2) as is_t2b, primary_code in (m, m - 1) as is_b2b, primary_code = m as is_bot from
  (select *, max(primary_code) over (partition by o_orderstatus) as m from ({_CODED})) join customer on o_custkey = c_custkey)"""
_FAN = "lateral (values ('TOTAL', 'Total'), ('SEGMENT', c_mktsegment), ('BALANCE', case when c_acctbal < 0 then 'Debt' else 'Credit' end)) v(cut_name, cut_value)"


def _banner(source: str = _ANSWERS) -> str:
    pct = ", ".join(f"round(count(*) filter (where is_{m}) / nullif(count(*), 0), 6) as {m}_pct" for m in ("tb", "t2b", "b2b", "bot"))
    return f"""select o_orderstatus, cut_name, cut_value, count(*) as n, count(primary_code) as n_valid, {pct}, round(avg(primary_code), 6) as mean_score
      from {source}, {_FAN} group by 1, 2, 3"""


@query(_banner())
def banner_tidy(t: Tables) -> DataFrame:
    return metrics.banner(answers(t), KEY, cuts())


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("select o_orderstatus, " + ", ".join(f"max(tb_pct) filter (where cut_value = '{s}') as \"{s}\"" for s in _SEGMENTS) + f" from ({_banner()}) where cut_name = 'SEGMENT' group by 1")
def banner_pivot(t: Tables) -> DataFrame:
    tidy = metrics.banner(answers(t), KEY, {"SEGMENT": "c_mktsegment"})
    return reshape.pivot_cuts(tidy, KEY, "cut_value", _SEGMENTS, "tb_pct")


@query(f"""select a.o_orderstatus, a.cut_name, a.cut_value, a.n as n_all, a.tb_pct as tb_all, b.n as n_kept, b.tb_pct as tb_kept, round(b.tb_pct - a.tb_pct, 6) as tb_change
  from ({_banner()}) a left join ({_banner(f"(select * from {_ANSWERS} where c_nationkey <> 3)")}) b using (o_orderstatus, cut_name, cut_value)""")
def banner_sensitivity(t: Tables) -> DataFrame:
    return metrics.sensitivity(answers(t), c("c_nationkey") != 3, KEY, cuts())


def _z(hits_a: str, n_a: str, hits_b: str, n_b: str) -> str:
    pool = f"(({hits_a} + {hits_b}) / ({n_a} + {n_b}))"
    return f"(({hits_a} / {n_a} - {hits_b} / {n_b}) / sqrt({pool} * (1 - {pool}) * (1.0::double / {n_a} + 1.0::double / {n_b})))"


def _erf(x: str) -> str:
    t, poly = f"(1 / (1 + {stats.ERF_P}::double * abs({x})))", "0.0::double"
    for a in reversed(stats.ERF_A):
        poly = f"(({poly} + {a}::double) * {t})"
    return f"(sign({x}) * (1 - {poly} * exp(-({x}) * ({x}))))"


@query(f"""with g as (select o_orderstatus, c_mktsegment as v, count(*) as n, count(*) filter (where is_tb) as h from {_ANSWERS} group by 1, 2),
  p as (select a.o_orderstatus, a.v as value_a, b.v as value_b, a.n as n_a, b.n as n_b, {_z("a.h", "a.n", "b.h", "b.n")} as z from g a join g b on a.o_orderstatus = b.o_orderstatus and a.v < b.v)
  select o_orderstatus, value_a, value_b, n_a::bigint as n_a, n_b::bigint as n_b, round(z, 6) + 0.0 as z, round(1 - {_erf("(abs(z) / sqrt(2.0::double))")}, 6) as p_value from p""")
def ztest_two_prop(t: Tables) -> DataFrame:
    return metrics.z_tests(metrics.banner_counts(answers(t), KEY, {"SEGMENT": "c_mktsegment"}), KEY, "SEGMENT")


@query(f"select o_orderstatus, c_mktsegment, count(*) filter (where is_tb)::bigint as tb_n, round(count(*) filter (where is_tb) / count(*), 6) as tb_pct from {_ANSWERS} group by 1, 2")
def modality_compare(t: Tables) -> DataFrame:
    return metrics.compare_modalities(answers(t), ["o_orderstatus", "c_mktsegment"])


@query(f"""select l_linenumber, count(*) as n_pairs, round(avg((a.l_returnflag = b.l_returnflag)::bigint), 6) as agreement_rate
  from {_RUNS} a join {_RUNS} b using (l_orderkey, l_linenumber) where a.run_no < b.run_no group by 1""")
def answer_stability(t: Tables) -> DataFrame:
    got = stability.agreement_of(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_linenumber"], {"flag": c("l_returnflag")}).filter("n_run_pairs > 0")
    return got.select("l_linenumber", c("n_run_pairs").alias("n_pairs"), F.round(stats.share(c("n_same"), c("n_pairs")), 6).alias("agreement_rate"))


_FIELDS = {"rating": "l_quantity", "selected": "nullif(l_returnflag, 'N')", "verbatim": "l_linestatus || l_returnflag"}


@query(" union all ".join(
    f"""select '{f}' as field, count(*) filter (where a.{f} is not null and b.{f} is not null)::bigint as n_pairs, round(count(*) filter (where a.{f} = b.{f}) / nullif(count(*) filter (where a.{f} is not null and b.{f} is not null), 0), 6) as agreement_rate
  from (select *, {x} as {f} from {_RUNS}) a join (select *, {x} as {f} from {_RUNS}) b using (l_orderkey, l_linenumber) where a.run_no < b.run_no""" for f, x in _FIELDS.items()))  # fmt: skip
def replicate_fields(t: Tables) -> DataFrame:
    fields = {"rating": c("l_quantity"), "selected": F.nullif(c("l_returnflag"), F.lit("N")), "verbatim": F.concat("l_linestatus", "l_returnflag")}
    got = stability.agreement_of(t.lineitem, ["l_orderkey", "l_linenumber"], [], fields)
    return got.select("field", "n_pairs", F.round(stats.share(c("n_same"), c("n_pairs")), 6).alias("agreement_rate"))


def _shares(t: Tables, segment: str, name: str) -> DataFrame:
    rows = answers(t).filter(c("c_mktsegment") == segment)
    g = rows.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("k"))
    total = F.sum("k").over(Window.partitionBy("o_orderstatus"))  # over one row per status and priority
    return g.select("o_orderstatus", "o_orderpriority", F.round(stats.share(c("k"), total), 6).alias(name))


def _shares_sql(segment: str, name: str) -> str:
    return f"select o_orderstatus, o_orderpriority, round(count(*) / sum(count(*)) over (partition by o_orderstatus), 6)::double as {name} from {_ANSWERS} where c_mktsegment = '{segment}' group by 1, 2"


_BOTH = f"({_shares_sql('BUILDING', 'synthetic_pct')}) s join ({_shares_sql('MACHINERY', 'human_pct')}) h using (o_orderstatus, o_orderpriority)"


@query(f"""select o_orderstatus, o_orderpriority, synthetic_pct, human_pct, round(synthetic_pct - human_pct, 6) as delta,
  round((synthetic_pct - human_pct) / nullif(human_pct, 0), 6) as rel_delta from {_BOTH}""")
def calibration_delta(t: Tables) -> DataFrame:
    return calibration.deltas(_shares(t, "BUILDING", "synthetic_pct").join(_shares(t, "MACHINERY", "human_pct"), ["o_orderstatus", "o_orderpriority"]))


@query(f"""select o_orderstatus, count(*) as n, round(covar_pop(a, b) / nullif(stddev_pop(a) * stddev_pop(b), 0), 6) + 0.0 as rho from (select o_orderstatus,
  rank() over (partition by o_orderstatus order by a) + (count(*) over (partition by o_orderstatus, a) - 1) / 2 as a,
  rank() over (partition by o_orderstatus order by b) + (count(*) over (partition by o_orderstatus, b) - 1) / 2 as b
  from (select o_orderstatus, round(synthetic_pct, 2) as a, round(human_pct, 2) as b from {_BOTH})) group by 1""")
def spearman_rank(t: Tables) -> DataFrame:
    both = calibration_delta(t).withColumns({"a": F.round("synthetic_pct", 2), "b": F.round("human_pct", 2)})
    return calibration.spearman(both, ["o_orderstatus"], "a", "b")


@query(f"""with b as ({_banner()}), h as (select 'Status ' || o_orderstatus as wtab_label, 'Top' as row_label, round(100.0::double * count(*) filter (where is_t2b) / count(*), 6) as value from {_ANSWERS} group by 1)
  select o_orderstatus as question_key, row_label, value / 100 as human_pct, tb_pct as synthetic_pct, round(tb_pct - value / 100, 6) as delta, round((tb_pct - value / 100) / nullif(value / 100, 0), 6) as rel_delta
  from h join b on wtab_label = 'Status ' || o_orderstatus and cut_name = 'TOTAL'""")
def join_calibration(t: Tables) -> DataFrame:
    ours = metrics.banner(answers(t), KEY, {"TOTAL": F.lit("Total")}).withColumnRenamed("o_orderstatus", "question_key")
    label = F.concat(F.lit("Status "), "o_orderstatus")
    h = answers(t).groupBy(label.alias("question_label")).agg(F.round(100.0 * F.count_if("is_t2b") / F.count("*"), 6).alias("value"))
    h = h.withColumns({"row_label": F.lit("Top"), "is_pct": F.lit(True)}).select("*", F.explode(F.array(F.lit("Total"), F.lit("Men"))).alias("banner_col"))
    walk = t.orders.select(label.alias("wtab_label"), c("o_orderstatus").alias("question_key"), F.lit("Top").alias("row_label")).distinct()
    return calibration.calibrate(ours, h, walk)


@query("""select q as quadrant, count(*) as n from (select case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'Men' when c_mktsegment <> 'FURNITURE' then 'Women' end
  || case when c_acctbal < 3500 then ' <35' else ' 35+' end as q from customer) group by 1""")
def quadrants(t: Tables) -> DataFrame:
    male = F.when(c("c_mktsegment") != "FURNITURE", c("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return t.customer.groupBy(parse.quadrant(male, c("c_acctbal") < 3500).alias("quadrant")).agg(F.count("*").alias("n"))


_DQ_FACT = f"""(select *, 'read_' || lower(o_orderstatus) || '_2_1' as run_id from ({_CODED}) join customer on o_custkey = c_custkey
  union all select *, 'read_p_2_1x' from ({_CODED}) join customer on o_custkey = c_custkey where o_orderstatus = 'P')"""
_DQ_KEYS = f"(select o_custkey, o_orderkey, o_orderstatus, count(*) as n_runs, min(run_id) as run_id from {_DQ_FACT} group by 1, 2, 3)"
_TWICE = "(select count(*) from orders where o_orderstatus = 'P')"
#: By check: the observed count and the expected one.
_DQ = {
    "DQ01": (f"select count(*) from {_DQ_FACT}", f"(select count(*) from orders) + {_TWICE}"),
    "DQ02": ("select count(distinct c_custkey) from customer", "(select count(*) from customer)"),
    "DQ03": (f"select count(distinct o_orderkey) from {_DQ_FACT}", "(select count(*) from orders)"),
    "DQ04": ("select count(*) from (select count(*) as n from customer group by c_mktsegment) where n <> (select count(*) from customer) // 5", "0"),
    "DQ05": ("select count(*) from orders where o_custkey not in (select c_custkey from customer)", "0"),
    "DQ06": ("select count(*) from customer where c_acctbal is null", "0"),
    "DQ07": ("select count(*) from customer where c_mktsegment = 'BUILDING'", "(select count(*) from customer) // 5"),
    "DQ08": (f"select count(*) from {_DQ_FACT} where o_orderpriority = '5-LOW' and label is null", "0"),
    "DQ09": (f"select count(*) from {_DQ_FACT} where o_orderpriority <> '5-LOW' and code is null", "0"),
    "DQ10": (f"select count(*) from {_DQ_FACT} where regexp_matches(label, '^[0-9]+\\.\\s')", "0"),
    "DQ11": (f"select count(*) from (select max(primary_code) as m from ({_CODED}) group by o_orderstatus) where m not between 2 and 12", "0"),
    "DQ12": (f"select count(*) from {_DQ_FACT} where o_orderpriority = '5-LOW'", "(select count(*) + count(*) filter (where o_orderstatus = 'P') from orders where o_orderpriority = '5-LOW')"),
    "DQ13": (f"select count(*) from (select count(distinct run_id) as k from {_DQ_KEYS} group by o_custkey, o_orderstatus) where k > 1", "0"),
    "DQ14": ("select count(*) from customer where c_acctbal + 1000 < c_acctbal", "0"),
    "DQ15": (f"select count(*) from {_DQ_KEYS} where n_runs = 2", _TWICE),
    "DQ15r": (f"select coalesce(sum(n_runs), 0) from {_DQ_KEYS} where n_runs = 2", f"2 * {_TWICE}"),
    "DQ16": (f"select count(*) from {_DQ_FACT}", f"(select count(*) from orders) + {_TWICE}"),
    "DQ16n": (f"select count(distinct run_id) from {_DQ_FACT}", "4"),
}


def dq_fact(t: Tables) -> DataFrame:
    """Coded orders as the fact table: a customer is a persona, an order a slot, a status a section; orders of status P are answered in two runs."""
    own = F.concat(F.lit("read_"), F.lower("o_orderstatus"), F.lit("_2_1"))
    open_end = c("o_orderpriority") == "5-LOW"
    rows = scaled(t).select(
        c("o_custkey").alias("archetype_id"), c("o_orderkey").alias("slot_key"), c("o_orderstatus").alias("section_code"), "selected_options",
        F.when(open_end, 1).otherwise(4).alias("q_type"), F.when(open_end, c("selected_options")[0]["option_label"]).alias("qual_text"),
        F.explode(F.when(c("o_orderstatus") == "P", F.array(own, F.concat(own, F.lit("x")))).otherwise(F.array(own))).alias("run_id"),
    )
    known = rows.join(t.customer.select(c("c_custkey").alias("archetype_id")), "archetype_id", "left_semi")
    return model.primary_run(known, ["archetype_id", "slot_key"], model.standalone_first())


@query("select check_id, observed, expected, observed = expected as passed from (" + " union all ".join(f"select '{k}' as check_id, ({q})::bigint as observed, ({want})::bigint as expected" for k, (q, want) in _DQ.items()) + ")")
def dq_suite(t: Tables) -> DataFrame:
    """All checks over stand-in tables. What is expected is counted from the sources, apart from what the suite reads; even cohorts (DQ04, DQ07) need not hold."""
    persona = t.customer.select(c("c_custkey").alias("archetype_id"), c("c_mktsegment").alias("cohort_code"), parse.banded(F.floor(c("c_acctbal") / 200), parse.AGE_BANDS).alias("age_band_banner"), c("c_acctbal").alias("income_low_usd"), (c("c_acctbal") + 1000).alias("income_high_usd"))
    ages = t.customer.select((c("c_mktsegment") == "BUILDING").alias("age_band_is_imputed"))
    fact = dq_fact(t)
    run = fact.groupBy("run_id").agg(F.count("*").alias("n_rows"))
    universe = model.option_universe(coded(t), ["o_orderstatus"]).withColumnRenamed("o_orderstatus", "question_key")
    p, low = c("o_orderstatus") == "P", c("o_orderpriority") == "5-LOW"
    n = t.orders.agg(F.count("*").alias("orders"), F.count_if(p).alias("twice"), (F.count_if(low) + F.count_if(low & p)).alias("low")).first()
    personas = t.customer.count()
    segments = {f"DQ04:{s}": personas // len(_SEGMENTS) for s in _SEGMENTS}
    expected = {
        "DQ01": n.orders + n.twice, "DQ02": personas, "DQ03": n.orders, "DQ07": personas // len(_SEGMENTS), "DQ12": n.low,
        "DQ15": n.twice, "DQ15r": 2 * n.twice, "DQ16": n.orders + n.twice, "DQ16n": 4,
    }
    return quality.survey_suite(fact, t.orders.select(c("o_custkey").alias("archetype_id")), persona, ages, run, universe, expected | segments)
