"""The whole build on a small hand-made survey, from CSV files to marts."""

import csv

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import calibration, metrics, ml, model, quality, reshape, stability
from tallyloom.plans import survey
from tallyloom.sources import crosstab, sink, wide_csv
from tallyloom.streaming import ingest

N = 4
PERSONAS = [("p1", "A-G-gr.1", "21", "Male"), ("p2", "A-G-gr.2", "17-24", "FEMALE"), ("p3", "A-S-gr.1", "40-44", " female ")]


def wide_row(pid, group, age, gender, blocks):
    row = dict.fromkeys(wide_csv.columns(N), "")
    row |= {"archetype_id": pid, "group_name": group, "archetype_age_range": age, "archetype_gender": gender, "archetype_income_range": "$65,000 - $75,000", "archetype_nps_score": "9", "archetype_children_status": "two"}
    for i, b in enumerate(blocks, 1):
        row |= {f"Q{i}_{k}": v for k, v in b.items()}
    return row


def select(text, meta, selected, qual="", kind="4"):
    return {"question": text, "meta": meta, "type": kind, "selected": selected, "qual": qual}


def blocks(code, verbatim):
    return [
        select("Would you watch?", "POSTINT", f"{code}. {code}. label{code}"),
        select("Rate it", "ELEMENT1", "1. 1. Great"), select("Rate it", "ELEMENT1", f"{code}. {code}. label{code}"),
        {"question": "Why?", "meta": "LIKE", "type": "1", "qual": verbatim},
    ]


def write(path, rows, columns=None):
    with path.open("w", newline="", encoding="utf-8") as f:
        w = csv.DictWriter(f, columns or wide_csv.columns(N))
        w.writeheader()
        w.writerows(rows)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("survey")
    write(d / "7-STUDY-G-gr1-2.1X — Results-c.csv", [wide_row(*PERSONAS[0], blocks(1, "line1\nline2")), wide_row(*PERSONAS[1], blocks(2, 'say "hi", ok'))])
    write(d / "7-STUDY-G-gr2-2.1 — Results-c.csv", [wide_row(*PERSONAS[1], blocks(3, "it’s “so”"))])
    write(d / "7-STUDY-S-gr1-2.1 — Results-c.csv", [wide_row(*PERSONAS[2], blocks(5, ""))])
    return d


@pytest.fixture(scope="module")
def raw(spark, files):
    return wide_csv.read(spark, str(files), N)


@pytest.fixture(scope="module")
def built(spark, raw):
    from tallyloom.functions import text

    persona = model.personas([raw, raw], wide_csv.attribute_columns())
    rows = raw.withColumns({"run_id": text.slug_column(F.col("_source_file")), "modality": F.lit("READ")})
    long = reshape.unpivot_blocks(rows, reshape.question_blocks(N), ["archetype_id", "modality", "run_id"])
    resp = model.responses(long)
    return persona, resp, model.facts(resp, persona)


def test_reader_keeps_line_breaks_and_quotes(raw):
    got = {r[0] for r in raw.select("Q4_qual").collect()}
    assert got == {"line1\nline2", 'say "hi", ok', "it’s “so”", None}
    assert raw.count() == 4
    assert len(raw.columns) == 46 + 7 * N + 2
    assert raw.filter("_loaded_at is null or _source_file is null").count() == 0


@pytest.mark.parametrize("fault", ["short", "long", "header"])
def test_reader_fails_on_bad_files(spark, tmp_path, fault):
    path = tmp_path / "bad.csv"
    write(path, [wide_row(*PERSONAS[0], blocks(1, "x"))])
    lines = path.read_text().splitlines()
    if fault == "short":
        lines[1] = ",".join(lines[1].split(",")[:-1])
    elif fault == "long":
        lines[1] += ",more"
    else:
        lines[0] = lines[0].replace("Q2_meta", "Q2_other")
    path.write_text("\n".join(lines) + "\n")
    with pytest.raises(Exception):  # noqa: B017  Spark wraps it differently by fault
        wide_csv.read(spark, str(path), N).select("archetype_id").collect()


def test_gates(raw, built):
    persona, _, fact = built
    assert quality.gate(raw, {"rows": (F.count("*"), 4)}) == {"rows": 4}
    with pytest.raises(quality.GateError, match="rows: 4, expected 5"):
        quality.gate(raw, {"rows": (F.count("*"), 5)})
    quality.gate(persona, {"ids": (F.countDistinct("archetype_id"), 3), "no_band": (F.count_if(F.col("age_band_banner").isNull()), 0)})
    assert fact.count() == 4 * N


def test_personas(built):
    got = {r.archetype_id: r for r in built[0].collect()}
    assert [got[p].cohort_code for p in ("p1", "p2", "p3")] == ["G.1", "G.2", "S.1"]
    assert [got[p].creative for p in ("p1", "p3")] == ["Goyer", "Sheridan"]
    assert [got[p].age_band_is_imputed for p in ("p1", "p2", "p3")] == [False, True, False]
    assert got["p3"].gender_clean == "Female" and got["p1"].income_high_usd == 75000 and got["p1"].nps_band == "Promoter" and got["p1"].is_parent


def test_repeated_text_keeps_its_slots(built):
    fact = built[2]
    assert fact.filter("meta = 'ELEMENT1'").select("slot_key").distinct().count() == 2
    assert fact.select("question_key").distinct().count() == 3


def test_standalone_run_is_primary(built):
    fact = built[2].filter("archetype_id = 'p2' and meta = 'POSTINT'").collect()
    assert {(r.run_id, r.is_primary_run, r.run_count) for r in fact} == {("read_g_gr1_2_1x", False, 2), ("read_g_gr2_2_1", True, 2)}
    assert built[2].filter("archetype_id = 'p1'").filter("not is_primary_run").count() == 0


def test_runs(raw):
    got = {r.run_id: r for r in model.runs(raw).collect()}
    assert got["read_g_gr1_2_1x"].is_combined_file and got["read_g_gr1_2_1x"].n_rows == 2 and got["read_g_gr1_2_1x"].section_code == "2.1"
    assert sum(r.n_rows for r in got.values()) == 4


def test_banner_boxes_and_invariants(built):
    persona, _, fact = built
    boxed = metrics.with_boxes(fact).filter("is_primary_run").join(persona.select("archetype_id", "gender_clean"), "archetype_id")
    cuts = {"TOTAL": F.lit("Total"), "GENDER": "gender_clean"}
    b = metrics.banner(boxed, ["meta"], cuts).collect()
    by = {(r.meta, r.cut_name, r.cut_value): r for r in b}
    total = by["POSTINT", "TOTAL", "Total"]
    assert (total.n, total.n_valid, total.tb_pct, total.bot_pct) == (3, 3, round(1 / 3, 6), round(1 / 3, 6))
    assert all(r.tb_pct <= r.t2b_pct for r in b)
    for meta in {r.meta for r in b}:
        assert sum(r.n for r in b if r.meta == meta and r.cut_name == "GENDER") == by[meta, "TOTAL", "Total"].n
    wide = reshape.pivot_cuts(metrics.banner(boxed, ["meta"], {"GENDER": "gender_clean"}), ["meta"], "cut_value", ["Female", "Male"], "n").collect()
    assert {r.meta: (r.Female, r.Male) for r in wide}["POSTINT"] == (2, 1)


def test_stability(built):
    paired = stability.pairs(built[2], ["archetype_id", "slot_key"], "run_id", ["primary_code", "meta", "qual_text"])
    got = {r.meta_a: r for r in stability.agreement(paired, ["meta_a"], "primary_code").collect()}
    assert got["POSTINT"].agreement_rate == 0.0 and got["ELEMENT1"].agreement_rate == 0.5 and got["LIKE"].agreement_rate is None
    assert got["ELEMENT1"].n_pairs == 2


def test_dq_suite(raw, built):
    persona, resp, fact = built
    staged = resp.unionByName(resp.filter("archetype_id = 'p1'").limit(1).withColumn("archetype_id", F.lit("ghost")))
    ages = raw.select((F.col("archetype_age_range") == "17-24").alias("age_band_is_imputed"))
    universe = model.option_universe(model.with_slots(resp, ["archetype_id", "run_id"]), ["question_key"])
    got = quality.survey_suite(fact, staged, persona, ages, model.runs(raw), universe, {"DQ01": 16, "DQ02": 3, "DQ03": 4, "DQ04": 3, "DQ07": 2, "DQ12": 3, "DQ15": 4, "DQ16": 4})
    by = {r.check_id: r for r in got.collect()}
    assert len(by) == 16
    assert {k for k, r in by.items() if not r.passed} == {"DQ05", "DQ08"}
    assert by["DQ05"].observed == 1 and by["DQ08"].observed == 1


def test_profile():
    cols = wide_csv.columns(2)
    assert quality.profile(type("D", (), {"columns": cols})(), cols) == {"missing": [], "extra": [], "moved": []}
    assert quality.profile(type("D", (), {"columns": [*cols[:-1], "new"]})(), cols)["extra"] == ["new"]


def test_spearman_with_ties(spark):
    rows = spark.createDataFrame([("g", 1.0, 2.0), ("g", 2.0, 2.0), ("g", 3.0, 5.0), ("g", 3.0, 1.0)], "g string, a double, b double")
    assert calibration.spearman(rows, ["g"], "a", "b").first().rho == pytest.approx(0.0, abs=1e-9)


def test_calibration_matches_one_row_per_label(spark):
    banner = spark.createDataFrame([("k", "TOTAL", "Total", 0.5), ("k", "GENDER", "Male", 0.9)], "question_key string, cut_name string, cut_value string, tb_pct double")
    bench = spark.createDataFrame([("Q", "Top", "Total", 40.0, True), ("Q", "Top", "Men", 10.0, True), ("Q", "Top", "Total", 400.0, False), ("Q", "Low", "Total", 0.0, True)], "question_label string, row_label string, banner_col string, value double, is_pct boolean")
    walk = spark.createDataFrame([("Q", "k", "Top"), ("Q", "k", "Low")], "wtab_label string, question_key string, row_label string")
    got = {r.row_label: (r.human_pct, r.delta, r.rel_delta) for r in calibration.calibrate(banner, bench, walk).collect()}
    assert got == {"Top": (0.4, 0.1, 0.25), "Low": (0.0, 0.5, None)}


def test_crosstab(spark, tmp_path):
    (tmp_path / "w.csv").write_text('#page\nTable 1\n"Would you, really?"\n,Total,GENDER,\n,Total,Men,Women\nTop box,"40.5%","1,200",3\nBottom,1%,,2%\n#page\nTable 12\nWhy\n,Total\n,All\nx,7\n')
    got = {(r.table_no, r.row_label, r.banner_col): r for r in crosstab.read(spark, str(tmp_path)).collect()}
    assert len(got) == 6
    first = got[1, "Top box", "Men"]
    assert (first.question_label, first.banner_group, first.value, first.is_pct) == ("Would you, really?", "GENDER", 1200.0, False)
    assert got[1, "Top box", "Women"].banner_group == "GENDER"
    assert got[1, "Top box", "Total"].is_pct and got[12, "x", "All"].value == 7.0


@pytest.mark.parametrize("width", [1, 256, 257, 1000])
def test_crosstab_of_any_width(spark, tmp_path, width):
    cols = [f"c{i}" for i in range(width)]
    lines = ["Table 7", "Q", ",G" + "," * (width - 1), "," + ",".join(cols), "row," + ",".join(str(i) for i in range(width))]
    (tmp_path / "w.csv").write_text("\n".join(lines) + "\n")
    got = {r.banner_col: (r.value, r.banner_group, r.row_label) for r in crosstab.read(spark, str(tmp_path)).collect()}
    assert got == {c: (float(i), "G", "row") for i, c in enumerate(cols)}


def test_crosstab_keeps_breaks_quotes_and_commas_of_a_cell(spark, tmp_path):
    (tmp_path / "w.csv").write_text('Table 2\r\n"Why\nnot, ""ever""?"\r\n,Total\r\n,"A\r\nB"\r\n"x, ""y""",5%\r\n"",6\r\n')
    got = sorted((r.question_label, r.banner_col, r.row_label or "", r.value, r.is_pct) for r in crosstab.read(spark, str(tmp_path)).collect())
    assert got == [('Why\nnot, "ever"?', "A\r\nB", "", 6.0, False), ('Why\nnot, "ever"?', "A\r\nB", 'x, "y"', 5.0, True)]


def test_four_gates(raw, built):
    persona, resp, fact = built
    run = model.runs(raw)
    sections = raw.withColumn("section", F.lit("2.1"))
    assert quality.gate_raw(sections, "section", {"2.1": 4})["all"] == 4
    quality.gate_personas(persona, run, 3, run.count(), 4)
    quality.gate_questions(fact, 4, 3)
    primary = fact.filter("is_primary_run").count()
    got = quality.gate_facts(fact, 16, primary, 4, 3)
    assert got["single_rows"] + got["replicated_rows"] == 16
    for call in (lambda: quality.gate_personas(persona, run, 4, run.count(), 4), lambda: quality.gate_personas(persona, run, 3, run.count(), 5), lambda: quality.gate_questions(fact, 4, 2), lambda: quality.gate_facts(fact, 16, primary, 5, 3), lambda: quality.gate_raw(sections, "section", {"2.1": 4, "2.2": 1})):
        with pytest.raises(quality.GateError):
            call()


def test_dq_cohort_sizes_and_replicated_rows(raw, built):
    persona, resp, fact = built
    ages = raw.select((F.col("archetype_age_range") == "17-24").alias("age_band_is_imputed"))
    universe = model.option_universe(model.with_slots(resp, ["archetype_id", "run_id"]), ["question_key"])

    def observed(**more):
        got = quality.survey_suite(fact, resp, persona, ages, model.runs(raw), universe, {"DQ16": 4} | more)
        return {r.check_id: (r.observed, r.passed) for r in got.collect()}

    right = observed(**{"DQ04:G.1": 1, "DQ04:G.2": 1, "DQ04:S.1": 1, "DQ15": 4, "DQ15r": 8, "DQ16n": model.runs(raw).count()})
    assert all(right[k][1] for k in ("DQ04", "DQ13", "DQ15", "DQ15r", "DQ16", "DQ16n"))
    assert observed(**{"DQ04:G.1": 2, "DQ04:G.2": 1, "DQ04:S.1": 1})["DQ04"] == (1, False)
    assert observed(**{"DQ04:G.1": 1, "DQ04:G.2": 1})["DQ04"] == (1, False)
    assert observed(**{"DQ04:G.1": 1, "DQ04:G.2": 1, "DQ04:S.1": 1, "DQ04:S.2": 1})["DQ04"] == (1, False)


@pytest.mark.parametrize("written", [False, True])
def test_build_from_files_to_marts(spark, files, built, tmp_path, written):
    persona, resp, fact = built
    got = survey.build(spark, {"2.1": str(files)}, {"2.1": N}, path=str(tmp_path / "out") if written else None)
    assert {r.archetype_id for r in got.personas.collect()} == {r.archetype_id for r in persona.collect()}
    assert sum(r.n_rows for r in got.runs.collect()) == 4
    key = ["archetype_id", "slot_key", "run_id", "is_primary_run", "primary_code", "qual_text"]
    assert sorted(got.facts.select(*key).collect(), key=str) == sorted(fact.select(*key).collect(), key=str)
    totals = {(r.meta, r.question_text): r.n for r in got.banner.filter("cut_name = 'TOTAL'").collect()}
    assert totals == {("POSTINT", "Would you watch?"): 3, ("ELEMENT1", "Rate it"): 6, ("LIKE", "Why?"): 3}
    men = {r.n for r in got.banner.filter("cut_name = 'GENDER' and cut_value = 'Male' and meta = 'POSTINT'").collect()}
    assert men == {1}
    same = {(r.meta, r.field): (r.n_pairs, r.n_same) for r in got.stability.collect()}
    assert same["POSTINT", "code"] == (1, 0) and same["ELEMENT1", "code"] == (2, 1) and same["LIKE", "verbatim"] == (1, 0)
    assert {r.archetype_id: r.postint_tb for r in got.drivers.collect()} == {"p1": True, "p2": False, "p3": False}
    assert got.universe.count() == 4 + 5  # POSTINT has the codes 1, 2, 3, 5; ELEMENT1 those and 1 with a label of its own


def test_build_of_sections_of_other_widths(spark, tmp_path):
    from tallyloom.sources import wide_csv as w

    for n, name in ((1, "7-S-G-gr1-2.1 — R.csv"), (2, "7-S-G-gr1-2.2 — R.csv")):
        row = dict.fromkeys(w.columns(n), "") | {"archetype_id": "p", "group_name": "A-G-gr.1", "archetype_age_range": "30"}
        row |= {f"Q{i}_{k}": v for i in range(1, n + 1) for k, v in select(f"q{i}", f"M{n}", "1. 1. Yes").items()}
        write(tmp_path / name, [row], w.columns(n))
    got = survey.build(spark, {"2.1": str(tmp_path / "*2.1*"), "2.2": str(tmp_path / "*2.2*")}, {"2.1": 1, "2.2": 2})
    assert got.personas.count() == 1 and got.facts.count() == 3
    assert {(r.section_code, r.meta, r.question_text) for r in got.facts.collect()} == {("2.1", "M1", "q1"), ("2.2", "M2", "q1"), ("2.2", "M2", "q2")}


def test_driver_feature_mart(built):
    persona, _, fact = built
    boxed = metrics.with_boxes(fact)
    flags = metrics.persona_flags(boxed.filter("is_primary_run"), "archetype_id", {"cut_fan": F.col("meta") == "ELEMENT1", "cut_postint_tb": F.col("is_tb")})
    got = {r.archetype_id: r for r in ml.driver_features(boxed, persona, flags).collect()}
    assert set(got) == {"p1", "p2", "p3"}
    assert set(ml.PERSONA_FEATURES) | {"archetype_id", "postint_tb", "cut_fan"} == set(got["p1"].asDict())
    assert got["p1"].postint_tb is True and got["p2"].postint_tb is False


def test_agreement_from_counts_equals_pairs(spark):
    rows = [(u, i, v) for u, own in {"a": [1, 1, 2, None], "b": [3], "c": [None, None], "d": [4, 4]}.items() for i, v in enumerate(own)]
    df = spark.createDataFrame(rows, "unit string, run int, x int")
    both = stability.agreement_by_field(stability.pairs(df, ["unit"], "run", ["x"]), {"x": (F.col("x_a"), F.col("x_b"))}).first()
    got = stability.agreement_of(df, ["unit"], [], {"x": F.col("x")}).first()
    assert (got.n_pairs, got.n_same / got.n_pairs, got.n_run_pairs) == (both.n_pairs, both.agreement_rate, 8)


def test_sinks(spark, tmp_path):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    path = str(tmp_path / "t")
    sink.replace(df, path, ["k"], 3)
    sink.replace(df, path, ["k"], 3)
    assert spark.read.parquet(path).count() == 100
    sink.append(df.limit(5), path, {"run": "x"})
    assert spark.read.option("mergeSchema", True).parquet(path).filter("run = 'x'").count() == 5
    sink.replace_table(df, "tl_test.t", ["k"])
    sink.replace_table(df, "tl_test.t")
    assert spark.table("tl_test.t").count() == 100
    wide_csv.view(df, "tl_view")
    assert spark.sql("select count(*) from tl_view").first()[0] == 100


def test_streaming_ingest_reads_each_file_once(spark, files, tmp_path):
    out, check = str(tmp_path / "raw"), str(tmp_path / "check")
    for _ in range(2):
        ingest.follow(spark, str(files), N, out, check).awaitTermination(120)
    assert spark.read.parquet(out).count() == 4
