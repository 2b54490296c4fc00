"""Projection, filter, string, cast and array queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions import parse, text
from tallyloom.operators import metrics, reshape
from tallyloom.plans.base import Tables, query

c = F.col


def blocks(t: Tables) -> DataFrame:
    """lineitem made wide: per order, blocks Q1..Q7 of the largest quantity and flag by line number."""
    aggs = []
    for i in range(1, 8):
        own = lambda x, i=i: F.max(F.when(c("l_linenumber") == i, x))
        aggs += [own(c("l_quantity")).alias(f"Q{i}_quantity"), own(c("l_returnflag")).alias(f"Q{i}_flag")]
    return t.lineitem.groupBy("l_orderkey").agg(*aggs)


BLOCKS = [{"quantity": f"Q{i}_quantity", "flag": f"Q{i}_flag"} for i in range(1, 8)]
_LONG = """
with wide as (select l_orderkey, l_linenumber, max(l_quantity) quantity, max(l_returnflag) flag from lineitem group by all),
keys as (select distinct l_orderkey from wide)
select k.l_orderkey, q.i::bigint as q_idx, w.quantity, w.flag from keys k cross join range(1, 8) q(i)
left join wide w on w.l_orderkey = k.l_orderkey and w.l_linenumber = q.i
"""


@query(_LONG)
def unpivot_blocks(t: Tables) -> DataFrame:
    return reshape.unpivot_blocks(blocks(t), BLOCKS, ["l_orderkey"])


@query(_LONG + " where w.flag is not null and w.flag <> ''")
def unpivot_nulls(t: Tables) -> DataFrame:
    return unpivot_blocks(t).filter("flag is not null and flag <> ''")


@query("select * exclude (c_acctbal, c_name) from customer")
def select_except(t: Tables) -> DataFrame:
    return t.customer.drop("c_acctbal", "c_name")


@query("select n_nationkey, n_name, 'READ' as modality, '2.1' as section_code from nation")
def literal_tag(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", "n_name", F.lit("READ").alias("modality"), F.lit("2.1").alias("section_code"))


@query("""select o_orderkey, o_totalprice from orders where o_orderstatus = 'F' and o_orderpriority in ('1-URGENT', '2-HIGH')
  and o_totalprice < 200000 and o_custkey <> 7""")
def filter_pred(t: Tables) -> DataFrame:
    p = (c("o_orderstatus") == "F") & c("o_orderpriority").isin("1-URGENT", "2-HIGH") & (c("o_totalprice") < 200000) & (c("o_custkey") != 7)
    return t.orders.filter(p).select("o_orderkey", "o_totalprice")


@query("select p_partkey, p_type, p_type like '%BRASS%' as is_brass from part where p_type like '%S%'")
def like_contains(t: Tables) -> DataFrame:
    return t.part.filter(c("p_type").contains("S")).select("p_partkey", "p_type", c("p_type").contains("BRASS").alias("is_brass"))


@query("""select c_custkey, case when c_acctbal < 0 then 'debt' when c_acctbal < 2500 then 'low' when c_acctbal < 7500 then 'mid' else 'high' end as band,
  case c_mktsegment when 'BUILDING' then 1 when 'MACHINERY' then 2 else 0 end::int as segment_no from customer""")
def case_band(t: Tables) -> DataFrame:
    bal = c("c_acctbal")
    band = F.when(bal < 0, "debt").when(bal < 2500, "low").when(bal < 7500, "mid").otherwise("high")
    seg = F.when(c("c_mktsegment") == "BUILDING", 1).when(c("c_mktsegment") == "MACHINERY", 2).otherwise(0)
    return t.customer.select("c_custkey", band.alias("band"), seg.alias("segment_no"))


@query("""select event_id, case when nullif(value, 0) > 50 then 'over' else 'not over' end as side,
  case when case when event_type <> 'error' then value > 50 end then 'yes' else 'no' end as known_over from events""")
def if_null_else(t: Tables) -> DataFrame:
    known = F.when(c("event_type") != "error", c("value") > 50)
    return t.events.select("event_id", F.when(c("value") > 50, "over").otherwise("not over").alias("side"), F.when(known, "yes").otherwise("no").alias("known_over"))


@query("select event_id, nullif(event_type, 'click') as not_click, coalesce(nullif(event_type, 'click'), nullif(event_type, 'view'), 'none') as first_known from events")
def coalesce_nullif(t: Tables) -> DataFrame:
    not_click = F.nullif(c("event_type"), F.lit("click"))
    return t.events.select("event_id", not_click.alias("not_click"), F.coalesce(not_click, F.nullif(c("event_type"), F.lit("view")), F.lit("none")).alias("first_known"))


@query("""select count(*) filter (where flag is null)::bigint as n_null, count(*) filter (where flag is not null)::bigint as n_filled from (%s)""" % _LONG)
def null_tests(t: Tables) -> DataFrame:
    return unpivot_blocks(t).agg(F.count_if(c("flag").isNull()).alias("n_null"), F.count_if(c("flag").isNotNull()).alias("n_filled"))


@query("""select p_partkey, nullif(regexp_extract(p_name, '([0-9]+)', 1), '') as digits, nullif(regexp_extract(p_brand, '#([0-9])[0-9]', 1), '') as maker,
  nullif(regexp_extract(p_type, '^X(.)', 1), '') as nothing from part""")
def regexp_extract_null(t: Tables) -> DataFrame:
    x = text.extract
    return t.part.select("p_partkey", x(c("p_name"), "([0-9]+)").alias("digits"), x(c("p_brand"), "#([0-9])[0-9]").alias("maker"), x(c("p_type"), "^X(.)").alias("nothing"))


@query("select page_id, regexp_matches(url, '^https://') as secure, regexp_matches(url, '/[a-z]{2}/[0-9]+') as dated from pages")
def regexp_contains(t: Tables) -> DataFrame:
    return t.pages.select("page_id", c("url").rlike("^https://").alias("secure"), c("url").rlike("/[a-z]{2}/[0-9]+").alias("dated"))


@query("select page_id, regexp_replace(url, '^https?://', '') as bare, regexp_replace(url, '[0-9]', '', 'g') as no_digits from pages")
def regexp_replace(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.regexp_replace("url", "^https?://", "").alias("bare"), F.regexp_replace("url", "[0-9]", "").alias("no_digits"))


@query("select p_partkey, replace(p_type, ' ', '_') as slugged, replace(p_brand, '#', '.') as dotted from part")
def str_replace(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.replace(c("p_type"), F.lit(" "), F.lit("_")).alias("slugged"), F.replace(c("p_brand"), F.lit("#"), F.lit(".")).alias("dotted"))


_PIPED = "select o_custkey, string_agg(o_orderpriority, '|' order by o_orderkey) as picked from orders group by o_custkey"


def piped(t: Tables) -> DataFrame:
    """Per customer, the priorities of its orders in order of their keys, joined by pipes."""
    got = F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority")))
    return t.orders.groupBy("o_custkey").agg(F.array_join(F.transform(got, lambda x: x["o_orderpriority"]), "|").alias("picked"))


@query(f"select o_custkey, len(string_split(picked, '|'))::int as n_picked, string_split(picked, '|')[1] as first_picked from ({_PIPED})")
def split_multiselect(t: Tables) -> DataFrame:
    parts = F.split("picked", r"\|")
    return piped(t).select("o_custkey", F.size(parts).alias("n_picked"), parts[0].alias("first_picked"))


_TEXT = "(case when c_custkey % 3 = 0 then chr(9) || ' ' else '  ' end) || lower(c_mktsegment) || ' ' || c_name || (case when c_custkey % 2 = 0 then chr(10) else ' ' end)"


def padded():
    pre = F.when(c("c_custkey") % 3 == 0, "\t ").otherwise("  ")
    return F.concat(pre, F.lower("c_mktsegment"), F.lit(" "), "c_name", F.when(c("c_custkey") % 2 == 0, "\n").otherwise(" "))


@query(f"select c_custkey, trim({_TEXT}) as spaces_off, regexp_replace({_TEXT}, '^\\s+|\\s+$', '', 'g') as all_off from customer")
def trim_clean(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.trim(padded()).alias("spaces_off"), text.tidy(padded()).alias("all_off"))


@query("""select c_custkey, upper(left(s, 1)) || lower(substr(s, 2)) as gender_clean from
  (select c_custkey, case c_custkey % 3 when 0 then 'Male' when 1 then 'FEMALE' else trim(' female ') end as s from customer)""")
def initcap_gender(t: Tables) -> DataFrame:
    s = F.when(c("c_custkey") % 3 == 0, "Male").when(c("c_custkey") % 3 == 1, "FEMALE").otherwise(" female ")
    return t.customer.select("c_custkey", text.proper(s).alias("gender_clean"))


@query("select page_id, lower(regexp_extract(upper(url), '([^/]+)$', 1)) as last_part from pages")
def lower_slug(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.lower(F.regexp_extract(F.upper("url"), "([^/]+)$", 1)).alias("last_part"))


@query("select l_orderkey, l_linenumber, flag_key from (select l_orderkey, l_linenumber, nullif(l_returnflag, 'N') || '|' || l_linestatus as flag_key from lineitem)")
def concat_key(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", F.concat(F.nullif(c("l_returnflag"), F.lit("N")), F.lit("|"), c("l_linestatus")).alias("flag_key"))


@query("select page_id, url like '%/' as ends_slash, suffix(url, '.html') as is_html from pages")
def ends_with(t: Tables) -> DataFrame:
    return t.pages.select("page_id", c("url").endswith("/").alias("ends_slash"), c("url").endswith(".html").alias("is_html"))


@query("""select lang, count(*) as n, max(length(text))::bigint as longest, sum(length(coalesce(text, '')))::bigint as chars,
  round(avg(length(coalesce(text, ''))), 6) as mean_chars from documents group by lang""")
def char_len_stats(t: Tables) -> DataFrame:
    n = F.char_length(F.coalesce("text", F.lit(""))).cast("bigint")
    return t.documents.groupBy("lang").agg(F.count("*").alias("n"), F.max(n).alias("longest"), F.sum(n).alias("chars"), F.round(F.avg(n), 6).alias("mean_chars"))


@query("select p_partkey, md5(p_brand || '|' || p_type) as question_key from part")
def md5_key(t: Tables) -> DataFrame:
    from tallyloom.operators.model import question_key

    return t.part.select("p_partkey", question_key(c("p_brand"), c("p_type")).alias("question_key"))


@query("""select event_id, case when regexp_full_match(s, '\\s*[+-]?[0-9]+\\s*') then try_cast(trim(s) as bigint) end as n from
  (select event_id, case event_id % 5 when 0 then '' when 1 then 'x' || event_id when 2 then event_id || '.7' when 3 then '-' || event_id else event_id::varchar end as s from events)""")
def safe_cast(t: Tables) -> DataFrame:
    i, s = c("event_id"), c("event_id").cast("string")
    raw = F.when(i % 5 == 0, "").when(i % 5 == 1, F.concat(F.lit("x"), s)).when(i % 5 == 2, F.concat(s, F.lit(".7"))).when(i % 5 == 3, F.concat(F.lit("-"), s)).otherwise(s)
    return t.events.select("event_id", text.to_long(raw).alias("n"))


@query("""select conv_id, turn, translate(q, '‘’“”', '''''""') as norm, q <> translate(q, '‘’“”', '''''""') as changed from
  (select conv_id, turn, '“' || text || '” it’s ‘so’' as q from conversations)""")
def quote_norm(t: Tables) -> DataFrame:
    q = F.concat(F.lit("“"), "text", F.lit("” it’s ‘so’"))
    return t.conversations.select("conv_id", "turn", text.straighten(q).alias("norm"), (q != text.straighten(q)).alias("changed"))


@query("""select c_custkey, case when g like '%-G-%' then 'Goyer' when g like '%-S-%' then 'Sheridan' end as creative,
  nullif(regexp_extract(g, '-([A-Z])-', 1), '') || '.' || nullif(regexp_extract(g, '\\.([0-9])$', 1), '') as cohort from
  (select c_custkey, 'STUDY-' || (case c_nationkey % 3 when 0 then 'G' when 1 then 'S' else 'x' end) || '-gr.' || (case when c_custkey % 10 = 0 then '' else (c_custkey % 4)::varchar end) as g from customer)""")
def cohort_code(t: Tables) -> DataFrame:
    from tallyloom.operators.model import CREATIVES

    letter = F.when(c("c_nationkey") % 3 == 0, "G").when(c("c_nationkey") % 3 == 1, "S").otherwise("x")
    g = F.concat(F.lit("STUDY-"), letter, F.lit("-gr."), F.when(c("c_custkey") % 10 == 0, "").otherwise((c("c_custkey") % 4).cast("string")))
    return t.customer.select("c_custkey", text.creative(g, CREATIVES).alias("creative"), text.cohort(g).alias("cohort"))


@query("""select c_custkey, 'read_' || letter || '_gr' || (c_custkey % 3) || '_2_' || (c_custkey % 3 + 1) || x as run_id, '2.' || (c_custkey % 3 + 1) as section_code, x = 'x' as is_combined_file
  from (select *, case when c_nationkey % 2 = 0 then 'g' else 's' end as letter, case when c_custkey % 5 = 0 then 'x' else '' end as x from customer)""")
def file_slug(t: Tables) -> DataFrame:
    n = c("c_custkey")
    name = F.concat(
        F.lit("in/7-STUDY-"), F.when(c("c_nationkey") % 2 == 0, "G").otherwise("S"), F.lit("-gr"), (n % 3).cast("string"), F.lit("-2."), (n % 3 + 1).cast("string"),
        F.when(n % 5 == 0, "X").otherwise(""), F.lit(" — Results-c.csv"),
    )
    run = text.slug_column(name)
    return t.customer.select("c_custkey", run.alias("run_id"), text.section(run).alias("section_code"), text.combined(run).alias("is_combined_file"))


_AGE = """select c_custkey, (c_custkey % 80)::bigint as a, case c_custkey % 9 when 0 then '13-16' when 1 then '17-24' when 2 then '30-34' when 3 then '40-44' when 4 then '18-24'
  when 5 then null when 6 then (c_custkey % 80) || ' (17-24)' when 7 then 'unknown' else (c_custkey % 80)::varchar end as raw from customer"""


@query(f"""select c_custkey, raw as age_raw, case when c_custkey % 9 in (6, 8) then a end as age_exact,
  case when c_custkey % 9 in (6, 8) then case when a <= 17 then '13-17' when a <= 24 then '18-24' when a <= 34 then '25-34' when a <= 44 then '35-44' when a <= 54 then '45-54' else '55-64' end
  when raw = '13-16' then '13-17' when raw in ('17-24', '18-24') then '18-24' when raw = '30-34' then '25-34' when raw = '40-44' then '35-44' end as age_band,
  raw = '17-24' as is_imputed from ({_AGE})""")
def age_band(t: Tables) -> DataFrame:
    n = c("c_custkey")
    a = (n % 80).cast("string")
    raw = F.lit(None).cast("string")
    for i, v in {0: F.lit("13-16"), 1: F.lit("17-24"), 2: F.lit("30-34"), 3: F.lit("40-44"), 4: F.lit("18-24"), 6: F.concat(a, F.lit(" (17-24)")), 7: F.lit("unknown"), 8: a}.items():
        raw = F.when(n % 9 == i, v).otherwise(raw)
    r = t.customer.select("c_custkey", raw.alias("age_raw"))
    return r.select("*", parse.age_exact(c("age_raw")).alias("age_exact"), parse.age_band(c("age_raw")).alias("age_band"), parse.age_imputed(c("age_raw")).alias("is_imputed"))


@query("""select c_custkey, lo as income_low, case when c_custkey % 4 = 1 then lo + 10000 else lo end as income_high from
  (select c_custkey, case when c_custkey % 4 in (0, 1) then (c_custkey % 190) * 1000 + 1000 end as lo from customer)""")
def income_range(t: Tables) -> DataFrame:
    n = c("c_custkey")
    usd = lambda x: F.concat(F.lit("$"), F.format_number(x, 0))
    lo = (n % 190) * 1000 + 1000
    raw = F.when(n % 4 == 0, F.concat(usd(lo), F.lit(" "))).when(n % 4 == 1, F.concat(usd(lo), F.lit(" - "), usd(lo + 10000))).when(n % 4 == 2, "")
    return t.customer.select("c_custkey", parse.income_low(raw).alias("income_low"), parse.income_high(raw).alias("income_high"))


@query("""select event_id, s as score, case when s >= 9 then 'Promoter' when s >= 7 then 'Passive' when s is not null then 'Detractor' end as band,
  case when s >= 9 then 'Promoter' when s >= 7 then 'Passive' else 'Detractor' end as literal_band from
  (select event_id, case when event_id % 7 <> 0 then event_id % 11 end as s from events)""")
def nps_band(t: Tables) -> DataFrame:
    raw = F.when(c("event_id") % 7 != 0, (c("event_id") % 11).cast("string")).otherwise("")
    s = text.to_long(raw)
    return t.events.select("event_id", s.alias("score"), parse.nps_band(s).alias("band"), parse.nps_band(s, null_is_detractor=True).alias("literal_band"))


def coded(t: Tables) -> DataFrame:
    """orders as coded answers: doubled `n. n. label` options, NOT SPECIFIED as the sentinel 98."""
    code, label = F.split("o_orderpriority", "-")[0], F.split("o_orderpriority", "-")[1]
    code = F.when(label == "NOT SPECIFIED", "98").otherwise(code)
    return t.orders.withColumn("selected", F.concat(code, F.lit(". "), code, F.lit(". "), label)).withColumn("selected_options", parse.options(c("selected"))).withColumn("primary_code", parse.primary_code(c("selected_options")))


_CODED = """select *, case when o_orderpriority = '4-NOT SPECIFIED' then 98 else left(o_orderpriority, 1)::bigint end as code, substr(o_orderpriority, 3) as label,
  case when o_orderpriority <> '4-NOT SPECIFIED' then left(o_orderpriority, 1)::bigint end as primary_code from orders"""


@query(f"""select o_orderkey, 2::int as n_options, code as first_code, label as first_label, 2::bigint as second_code, '2.5 hours' as second_label,
  0::int as n_blank from ({_CODED})""")
def parse_options(t: Tables) -> DataFrame:
    o = coded(t).withColumn("o", parse.options(F.concat("selected", F.lit(" | |2. 2.5 hours "))))
    code, label = (lambda i: c("o")[i]["option_code"]), (lambda i: c("o")[i]["option_label"])
    n_blank = F.size(parse.options(F.lit(" | ")))
    return o.select("o_orderkey", F.size("o").alias("n_options"), code(0).alias("first_code"), label(0).alias("first_label"), code(1).alias("second_code"), label(1).alias("second_label"), n_blank.alias("n_blank"))


@query(f"select o_orderkey, code as option_code, label as option_label from ({_CODED})")
def explode_options(t: Tables) -> DataFrame:
    return coded(t).select("o_orderkey", F.explode("selected_options").alias("o")).select("o_orderkey", "o.option_code", "o.option_label")


@query("""select o_custkey, min(case when p < 90 then p end) as primary_code from (select o_custkey, case when o_orderpriority = '4-NOT SPECIFIED' then 98 else left(o_orderpriority, 1)::bigint end as p from orders) group by o_custkey""")
def primary_code(t: Tables) -> DataFrame:
    many = piped(t).withColumn("picked", F.replace(F.replace(c("picked"), F.lit("4-"), F.lit("98-")), F.lit("-"), F.lit(". ")))
    return many.select("o_custkey", parse.primary_code(parse.options(c("picked"))).alias("primary_code"))


@query(f"""select o_orderkey, primary_code = 1 as is_tb, primary_code in (1, 2) as is_t2b, primary_code = m or primary_code = m - 1 as is_b2b, primary_code = m as is_bot
  from (select *, max(primary_code) over (partition by o_orderstatus) as m from ({_CODED}))""")
def box_flags(t: Tables) -> DataFrame:
    return metrics.with_boxes(scaled(t)).select("o_orderkey", *metrics.BOXES)


def scaled(t: Tables) -> DataFrame:
    """Coded orders with the scale of their question (the order status)."""
    from tallyloom.operators import model

    o = coded(t)
    scale = model.scales(model.option_universe(o, ["o_orderstatus"]), ["o_orderstatus"])
    return o.join(F.broadcast(scale), "o_orderstatus", "left")
