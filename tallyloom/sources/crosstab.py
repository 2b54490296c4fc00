"""Parser of report-style crosstab files: `#page` and `Table N` blocks to one tidy table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

SCHEMA = "table_no int, question_label string, banner_group string, banner_col string, row_label string, value double, is_pct boolean"

#: A line up to a break outside quotes, and a cell with the comma before it. Quantifiers are possessive: one pass, no recursion.
_LINE = r'(?:[^"\r\n]++|"(?:[^"]++|"")*+"?+)++'
_CELL = r',(?:"(?:[^"]++|"")*+"?+)?+[^,]*+'


def sessionize(df: DataFrame, starts, order: list, by: list = ()) -> DataFrame:
    """block_no: how many rows up to this one start a block, per `by`."""
    upto = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("block_no", F.sum(starts.cast("bigint")).over(upto))


def logical_lines(text: Column) -> Column:
    """The lines of a report; a break inside quotes ends none. Empty lines are left out."""
    return F.regexp_extract_all(text, F.lit(_LINE), F.lit(0))


def cells_of(line: Column) -> Column:
    """All cells of a line, however many, without their quotes; an empty cell is null."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), F.lit(0))
    bare = lambda c: F.when(c.startswith('"'), F.replace(F.regexp_replace(c, r'^"|"(?=[^"]*$)', ""), F.lit('""'), F.lit('"'))).otherwise(c)
    return F.transform(raw, lambda c: F.nullif(bare(F.substring(c, 2, 1 << 30)), F.lit("")))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Tidy rows of the report files at path.

    A block is a `Table N` line, a line with the question's label, a line of banner groups, a line
    of banner columns and value lines: a row label, then a value per column, of any number. A
    group's name stands over its first column. `12.3%` is a percentage. Blank and `#page` lines are
    skipped; line breaks and commas inside quotes belong to their cell. Files are small reports;
    each is read whole by one task, files in parallel.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    lines = files.select("file", F.posexplode(logical_lines(F.col("value"))).alias("line_no", "line"))
    lines = lines.filter((F.trim("line") != "") & ~F.col("line").startswith("#page")).withColumn("cells", cells_of(F.col("line")))
    blocks = sessionize(lines, F.col("line").rlike(r"^Table \d+"), ["line_no"], ["file"]).filter("block_no > 0")
    nth = F.row_number().over(Window.partitionBy("file", "block_no").orderBy("line_no"))
    rows = blocks.withColumn("nth", nth)
    head = rows.filter("nth <= 4").groupBy("file", "block_no").agg(
        F.max(F.when(F.col("nth") == 1, F.regexp_extract("line", r"^Table (\d+)", 1).cast("int"))).alias("table_no"),
        F.max(F.when(F.col("nth") == 2, F.get("cells", F.lit(0)))).alias("question_label"),
        F.max(F.when(F.col("nth") == 3, F.col("cells"))).alias("groups"),
        F.max(F.when(F.col("nth") == 4, F.col("cells"))).alias("cols"),
    )
    values = rows.filter("nth > 4").select("file", "block_no", F.get("cells", F.lit(0)).alias("row_label"), F.posexplode("cells").alias("at", "text")).filter("at > 0")
    out = values.join(head, ["file", "block_no"])
    known = F.filter(F.slice("groups", F.lit(1), F.col("at") + 1), lambda g: F.length(F.trim(g)) > 0)
    text = F.trim("text")
    return out.select(
        "table_no", "question_label", F.when(F.size(known) > 0, F.element_at(known, -1)).alias("banner_group"), F.get("cols", F.col("at")).alias("banner_col"),
        "row_label", F.regexp_replace(text, "[%,]", "").try_cast("double").alias("value"), text.endswith("%").alias("is_pct"),
    ).filter("value is not null")
