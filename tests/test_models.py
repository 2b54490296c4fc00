from pyspark.sql import functions as F

from tallyloom.operators import ml, verbatim
from tallyloom.plans import registry


def test_driver_ranking_finds_the_signal(spark):
    rows = spark.range(600).select(((F.col("id") % 10) / 10.0).alias("signal"), ((F.xxhash64("id") % 100) / 100.0).alias("noise"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("kind"), (F.col("id") % 10 > 6).cast("int").alias("y"))
    model, held = ml.fit_drivers(rows, "y", ["signal", "noise"], ["kind"])
    assert ml.explain(model, rows).first().feature == "signal"
    got = ml.evaluate(held)
    assert got["roc_auc"] > 0.95 and got["trusted"] == 1.0
    _, importance = ml.fit_boosted(rows, "y", ["signal", "noise"], ["kind"])
    assert importance.first().feature == "signal"


def test_unlabelled_rows_are_left_out(spark):
    rows = spark.createDataFrame([(1.0, 1), (0.0, 0), (0.5, None)], "x double, y int")
    assert ml.balanced(rows, "y").count() == 2


def test_segments_find_the_clusters(spark):
    rows = spark.range(300).select((F.col("id") % 3).alias("g"), F.array((F.col("id") % 3) * 10.0 + F.rand(1), (F.col("id") % 3 == 1).cast("double") * 8 + F.rand(2)).alias("x"))
    found, tried = ml.fit_segments(rows, "x", ks=(3, 4, 5))
    assert min(tried, key=lambda t: t[1])[0] == 3
    assert ml.crosstab(found, "g", "segment").count() == 3


def test_segments_query_tries_every_k(spark, tmp_path):
    corners = [(0.0, 0.0), (0.0, 9.0), (9.0, 0.0), (9.0, 9.0)]
    rows = [(i % 4, [corners[i % 4][0] + i % 7 / 20, corners[i % 4][1] + i % 5 / 20]) for i in range(200)]
    spark.createDataFrame(rows, "label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = registry.QUERIES["ml_segments"](spark, str(tmp_path))
    assert got.select("segment").distinct().count() == 4


def test_coder(spark):
    coder = verbatim.KeywordCoder({"fight": ["punch"], "film": ["movie"]}, ["good"], ["bad"], ["punch"], ["please"])
    rows = spark.createDataFrame([(1, "Good movie, good PUNCH"), (2, "bad"), (3, ""), (4, None), (5, "bad")], "id int, t string")
    got = {r.id: (r.sentiment, r.primary_theme, r.secondary_theme, r.mentions, r.is_actionable) for r in verbatim.code(rows, F.col("t"), coder).collect()}
    assert got == {1: ("positive", "fight", "film", True, False), 2: ("negative", None, None, False, False), 3: ("neutral", None, None, False, False), 5: ("negative", None, None, False, False)}


def test_each_prompt_is_coded_once(spark):
    class Counting(verbatim.KeywordCoder):
        def code(self, prompts):
            return [(str(len(prompts)), None, None, False, False) for _ in prompts]

    rows = spark.createDataFrame([(i, "same") for i in range(50)], "id int, t string")
    got = verbatim.code(rows, F.col("t"), Counting({}, [], [])).collect()
    assert len(got) == 50 and {r.sentiment for r in got} == {"1"}


class Recording(verbatim.KeywordCoder):
    """Its sentiment tells how many metas and prompts a call had."""

    def code(self, prompts):
        metas = {p.split("about ")[1].split("?")[0] for p in prompts}
        return [(f"{len(metas)}", p, None, False, False) for p in prompts]


def test_prompts_of_primary_runs_are_coded_by_meta(spark):
    rows = [(i, f"m{i % 3}", f"What about m{i % 3}?", None if i == 4 else " " if i == 5 else f"answer {i % 7}", i % 10 != 9) for i in range(60)]
    fact = spark.createDataFrame(rows, "id int, meta string, question_text string, qual_text string, is_primary_run boolean").repartition(4)
    got = {r.id: r for r in verbatim.code_fact(fact, Recording({}, [], [])).collect()}
    assert set(got) == {i for i, *_, q, p in rows if p and q and q.strip()}
    assert {r.sentiment for r in got.values()} == {"1"}
    for i, r in got.items():
        assert r.primary_theme == f"[{verbatim.PROMPT_VERSION}] " + verbatim.PROMPT.format(question=f"What about m{i % 3}?", response=f"answer {i % 7}")


def test_prompt_template_may_name_the_response_first(spark):
    df = spark.createDataFrame([("q", "r"), (None, "r"), ("q", None)], "q string, r string")
    got = [r[0] for r in df.select(verbatim.prompt_of(F.col("q"), F.col("r"), "{response} / {question}.", "v")).collect()]
    assert got == ["[v] r / q.", "[v] r / .", None]
