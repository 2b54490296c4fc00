"""Model queries: drivers, boosted trees, segments, coded verbatims."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.operators import metrics, ml, verbatim
from tallyloom.plans.base import Tables, query

c = F.col
NUMERIC = ("chars", "words", "lines", "symbols", "upper")
_THEMES = {"licence": ("license", "copyright"), "contact": ("@", "555-"), "insult": ("stupid", "trash", "idiot"), "table": (" | ",)}
_POSITIVE, _NEGATIVE = ("the ", "la ", "der "), ("***", "!!", "stupid")
_MENTIONS, _ACTIONABLE = ("apache",), ("555-", "@")


def text_features(t: Tables) -> DataFrame:
    """Labelled documents with simple measures of their text."""
    x = F.coalesce("text", F.lit(""))
    n = F.greatest(F.length(x), F.lit(1))
    docs = t.documents.select("doc_id", "lang", F.log1p(F.length(x).cast("double")).alias("chars"), F.log1p(F.regexp_count(x, F.lit(r"\S+")).cast("double")).alias("words"), F.log1p(F.regexp_count(x, F.lit("\n")).cast("double")).alias("lines"), (F.regexp_count(x, F.lit(r"[#*$%&|<>!]")) / n).alias("symbols"), (F.regexp_count(x, F.lit("[A-Z]")) / n).alias("upper"))
    return docs.join(t.labels, "doc_id")


@query("""select user_id, bool_or(tb) as postint_tb, any_value(seg) as segment, any_value(debt) as in_debt, bool_or(buyer) as big_buyer from
  (select user_id, case when event_type = 'purchase' then value > 50 end as tb, event_type = 'purchase' as asked, c_mktsegment as seg, c_acctbal < 0 as debt,
    bool_or(event_type = 'error') over (partition by user_id) as buyer from events join customer on c_custkey = user_id) where asked group by 1""")
def driver_mart(t: Tables) -> DataFrame:
    """The driver feature mart over events: the label from purchases, features from customers, a cut from errors."""
    boxed = t.events.select("user_id", c("event_type").alias("meta"), F.lit(True).alias("is_primary_run"), (c("value") > 50).alias("is_tb"))
    persona = t.customer.select(c("c_custkey").alias("user_id"), c("c_mktsegment").alias("segment"), (c("c_acctbal") < 0).alias("in_debt"))
    flags = metrics.persona_flags(t.events, "user_id", {"big_buyer": c("event_type") == "error", "postint_tb": c("value") > 50})
    return ml.driver_features(boxed, persona, flags, ["user_id"], ["segment", "in_debt"], "purchase", ["postint_tb"])


@query()
def ml_drivers(t: Tables) -> DataFrame:
    df = text_features(t)
    model, _ = ml.fit_drivers(df, "quality", NUMERIC, ["lang"])
    return ml.explain(model, df)


@query()
def ml_evaluate(t: Tables) -> DataFrame:
    _, held = ml.fit_drivers(text_features(t), "quality", NUMERIC, ["lang"])
    return t.spark.createDataFrame(sorted(ml.evaluate(held).items()), "metric string, value double")


@query()
def ml_interactions(t: Tables) -> DataFrame:
    pairs = [("symbols", "chars")]
    df = text_features(t)
    model, _ = ml.fit_drivers(df, "quality", NUMERIC, [], pairs)
    return ml.explain(model, ml.with_products(df, pairs))


@query()
def ml_boosted(t: Tables) -> DataFrame:
    return ml.fit_boosted(text_features(t), "quality", NUMERIC, ["lang"])[1]


@query()
def ml_segments(t: Tables) -> DataFrame:
    found, _ = ml.fit_segments(t.embeddings.select("label", F.transform("embedding", lambda v: v.cast("double")).alias("x")), "x")
    return ml.crosstab(found, "label", "segment")


def coded(t: Tables) -> DataFrame:
    coder = verbatim.KeywordCoder(_THEMES, _POSITIVE, _NEGATIVE, _MENTIONS, _ACTIONABLE)
    return verbatim.code(t.documents.select("doc_id", "source", "text"), c("text"), coder)


def _any(words: tuple[str, ...]) -> str:
    return "(" + " or ".join(f"contains(low, '{w}')" for w in words) + ")"


def _count(words: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"contains(low, '{w}')::int" for w in words) + ")"


_LIST = "list_filter([" + ", ".join(f"case when {_any(w)} then '{k}' end" for k, w in _THEMES.items()) + "], lambda x: x is not null)"


@query(f"""select doc_id, case when {_count(_POSITIVE)} > {_count(_NEGATIVE)} then 'positive' when {_count(_NEGATIVE)} > {_count(_POSITIVE)} then 'negative' else 'neutral' end as sentiment,
  {_LIST}[1] as primary_theme, {_LIST}[2] as secondary_theme, {_any(_MENTIONS)} as mentions, {_any(_ACTIONABLE)} as is_actionable from (select doc_id, lower(text) as low from documents where text is not null)""")
def verbatim_codes(t: Tables) -> DataFrame:
    return coded(t).select("doc_id", "sentiment", "primary_theme", "secondary_theme", "mentions", "is_actionable")


@query("select doc_id, lang from documents order by md5(doc_id::varchar), doc_id limit 100")
def audit_sample(t: Tables) -> DataFrame:
    return verbatim.audit_sample(t.documents.select("doc_id", "lang"), "doc_id")


@query()
def verbatim_drivers(t: Tables) -> DataFrame:
    feats = verbatim.features(coded(t), "doc_id", list(_THEMES))
    df = text_features(t).join(feats, "doc_id")
    extra = [f for f in feats.columns if f != "doc_id"]
    model, _ = ml.fit_drivers(df, "quality", [*NUMERIC, *extra], ["lang"])
    return ml.explain(model, df)
