"""Mixing sources to target weights with hash-threshold histograms.

Rows of a source are ranked by a hash, never sorted. A budget is the sum of sizes a source may
take; it is met by a hash threshold, found from a histogram of sizes by source and hash bucket.
Only rows of the bucket that the budget falls into are looked at again, by the next hash bits.
Budgets are nested: a larger budget keeps every row that a smaller one took. Where several rows
have the rank that the budget falls into, a second hash splits them, and equal rows by count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm.scratch import written

#: Hash bits of a level of the histogram, and levels; a hash has BITS * LEVELS bits.
BITS, LEVELS = 15, 3
MAX_REPEAT = 3
#: How often what a budget has left, for the boundary row was too large, is offered to smaller rows.
FILLS = 2
#: Equal rows that are written out together.
CHUNK = 1024


def row_hash(*cols: str) -> Column:
    """BITS * LEVELS bits of the md5 of the columns' text, as a long; null counts as empty."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return F.shiftright(F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint"), 48 - BITS * LEVELS)


def tie_hash(*cols: str) -> Column:
    """BITS * LEVELS bits that depend on all of the columns and on which of them are null."""
    return F.shiftrightunsigned(F.xxhash64(*cols, *[F.col(c).isNull() for c in cols]), 64 - BITS * LEVELS)


def thresholds(rows: DataFrame, budgets: DataFrame, group: str, size: str, rank: str) -> DataFrame:
    """Per group: `cut`, so that rows with rank < cut sum to the budget or just below it, and `left`.

    rows: group, size (long, at least 0), rank (long, from row_hash). budgets: group, `budget`
    (double). Groups compare null-safe. Rows of equal rank stand or fall together. Every level
    reads rows once, sums before the shuffle, and keeps at most 2**BITS sums of a group.
    """
    state = budgets.select(group, F.col("budget").alias("left"), F.lit(0).cast("bigint").alias("cut"))
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        st = state.select(F.col(group).alias("_g"), "cut", "left")
        inside = rows if level == 0 else rows.join(st, rows[group].eqNullSafe(st["_g"])).filter(
            F.shiftright(F.col(rank), shift + BITS) == F.shiftright(F.col("cut"), shift + BITS)
        ).select(group, size, rank)
        hist = inside.groupBy(group, F.shiftright(F.col(rank), shift).alias("bucket")).agg(F.sum(size).alias("mass"))
        upto = Window.partitionBy(group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        run = hist.withColumn("run", F.sum("mass").over(upto))
        run = st.join(run, run[group].eqNullSafe(st["_g"]), "left")
        # the first bucket whose running sum passes the budget is the boundary; without one all rows fit
        over = F.col("run") > F.col("left")
        state = run.groupBy("_g").agg(
            F.min("left").alias("had"),
            F.min("cut").alias("was"),
            F.min(F.when(over, F.struct("bucket", (F.col("run") - F.col("mass")).alias("before")))).alias("hit"),
            F.max(F.when(~over, F.struct("bucket", "run"))).alias("fit"),
        ).select(
            F.col("_g").alias(group),
            (F.col("had") - F.coalesce(F.col("hit.before"), F.col("fit.run"), F.lit(0))).alias("left"),
            F.coalesce(F.shiftleft(F.col("hit.bucket"), shift), F.shiftleft(F.col("fit.bucket") + 1, shift), F.col("was")).alias("cut"),
        )
        state = written(state, "thresholds")
    return state


def shares(sizes: dict, weights: Sequence[float], limit: float = MAX_REPEAT) -> dict:
    """Targets of sources: weights repeat over sources by code point, null last; no target above
    limit times its source's size, the excess reshared by weight until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = float(sum(sizes.values())), {}
    while True:
        free = [s for s in names if s not in capped]
        mass, left = sum(weight[s] for s in free), total - sum(capped.values())
        share = {s: left * weight[s] / mass for s in free}
        above = [s for s in free if share[s] > limit * sizes[s]]
        if not above:
            return {s: capped.get(s, share.get(s)) for s in names}
        capped |= {s: float(limit * sizes[s]) for s in above}


def plan_of(rows: DataFrame, weights: Sequence[float] = (5, 2, 1), source: str = "source", size: str = "size", rank: str = "rank", limit: int = MAX_REPEAT, tie: str | None = None) -> DataFrame:
    """The mix as one row per source: `_s`, source_size, target, whole passes and thresholds.

    A source of size S and target t takes every row floor(t / S) times and, once more, the rows
    below the hash threshold of its fractional budget. What the budget has left there goes, FILLS
    times, to rows above the threshold that are no larger than it. Rows of equal rank go together,
    but at a threshold `tie` (from tie_hash) splits them, and as many of equal rows go as fit.
    Without a tie they go together there too. Null sources are one source; null sizes count as 0. The driver gets one row
    per source (a dimension), never rows.
    """
    spark = rows.sparkSession
    totals = {r[0]: int(r[1] or 0) for r in rows.groupBy(source).agg(F.sum(size)).collect()}
    target = shares(totals, weights, limit) if totals else {}
    kind = rows.schema[source].dataType.simpleString()
    plan = [(s, n, float(target[s]), min(limit, int(target[s] // n)) if n else 0) for s, n in totals.items()]
    schema = f"_s {kind}, source_size bigint, target double, whole int, left double"
    plan = spark.createDataFrame([(s, n, t, w, t - w * n) for s, n, t, w in plan], schema).withColumn("cuts", F.expr("array(struct(bigint(0) as below, bigint(0) as most, bigint(0) as tie, bigint(0) as same))"))
    for turn in range(1 + FILLS):
        free = rows
        if turn:
            p = plan.select("_s", "left", "cuts")
            free = rows.join(p, rows[source].eqNullSafe(p["_s"])).filter(~_taken(rank, size, tie) & (F.col(size) <= F.col("left"))).select(*rows.columns)
        cuts = thresholds(free.select(source, size, rank), plan.select(F.col("_s").alias(source), F.col("left").alias("budget")), source, size, rank)
        cuts = _split(free, cuts, source, size, rank, tie)
        cuts = cuts.select(F.col(source).alias("_c"), F.col("cut"), F.col("left").alias("_left"), "_tie", "_same")
        most = F.col("left").cast("bigint") if turn else F.lit((1 << 63) - 1)
        plan = plan.join(cuts, F.col("_s").eqNullSafe(F.col("_c")))
        plan = plan.withColumn("cuts", F.concat("cuts", F.array(F.struct(F.col("cut").alias("below"), most.alias("most"), F.col("_tie").alias("tie"), F.col("_same").alias("same"))))).withColumn("left", F.col("_left"))
        plan = written(plan.drop("_c", "cut", "_left", "_tie", "_same"), "plan")
    return plan.withColumn("limit", F.lit(limit)).drop("left")


def _split(free: DataFrame, cuts: DataFrame, source: str, size: str, rank: str, tie: str | None) -> DataFrame:
    """cuts with `_tie`, so that of the rows of rank `cut` those with a tie below it fit too, and `_same`, how many of that tie do."""
    whole = cuts.withColumns({"_tie": F.lit(0).cast("bigint"), "_same": F.lit(0).cast("bigint")})
    if tie is None:
        return whole
    c = cuts.select(F.col(source).alias("_g"), "cut")
    at = free.join(c, free[source].eqNullSafe(c["_g"])).filter(F.col(rank) == F.col("cut")).select(source, size, tie)
    if at.groupBy(source).count().filter("count > 1").isEmpty():
        return whole
    inner = thresholds(at, cuts.select(source, F.col("left").alias("budget")), source, size, tie)
    inner = inner.select(F.col(source).alias("_h"), F.col("cut").alias("_tie"), F.col("left").alias("_rest"))
    equal = at.join(inner, at[source].eqNullSafe(inner["_h"])).filter(F.col(tie) == F.col("_tie")).groupBy("_h").agg(F.max(size).alias("_size")).withColumnRenamed("_h", "_e")
    inner = inner.join(equal, F.col("_h").eqNullSafe(F.col("_e")), "left")
    inner = inner.withColumn("_same", F.when(F.col("_size") > 0, F.floor(F.col("_rest") / F.col("_size"))).otherwise(0).cast("bigint"))
    out = cuts.drop("left").join(inner, F.col(source).eqNullSafe(F.col("_h")))
    return out.select(source, "cut", (F.col("_rest") - F.col("_same") * F.coalesce("_size", F.lit(0))).alias("left"), "_tie", "_same")


def apply(rows: DataFrame, plan: DataFrame, source: str = "source", size: str = "size", rank: str = "rank", tie: str | None = None) -> DataFrame:
    """rows with `source_size`, `target` and `copies`: how often the mix takes a row (0 to the limit)."""
    out = rows.join(plan, rows[source].eqNullSafe(plan["_s"])).drop("_s")
    more = lambda taken: F.col("whole") + F.when(taken & (F.col("whole") < F.col("limit")), 1).otherwise(0)
    if tie is None or plan.filter(F.exists("cuts", lambda c: c["same"] > 0)).isEmpty():
        return out.withColumn("copies", more(_taken(rank, size, tie))).drop("whole", "limit", "cuts")
    # of equal rows any will do, so they are counted and written out again
    share = F.filter("cuts", lambda c: (c["same"] > 0) & (F.col(rank) == c["below"]) & (F.col(tie) == c["tie"]) & (F.col(size) <= c["most"]))
    out = out.withColumn("_same", F.get(share["same"], F.lit(0)))
    rest = out.filter("_same is null").withColumn("copies", more(_taken(rank, size, tie))).drop("whole", "limit", "cuts", "_same")
    part = out.filter("_same is not null").drop("cuts")
    part = part.groupBy(*part.columns).agg(F.count("*").alias("_m"))
    part = part.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_m") - 1) / CHUNK)))).repartition("_chunk")
    last = F.least(F.col("_m"), (F.col("_chunk") + 1) * CHUNK) - 1
    part = part.withColumn("_nth", F.explode(F.sequence(F.col("_chunk") * CHUNK, last)))
    part = part.withColumn("copies", more(F.col("_nth") < F.col("_same")))
    return rest.unionByName(part.select(*rest.columns))


def mix(rows: DataFrame, weights: Sequence[float] = (5, 2, 1), source: str = "source", size: str = "size", rank: str = "rank", limit: int = MAX_REPEAT, tie: str | None = None) -> DataFrame:
    """rows with `source_size`, `target` and `copies`. Empty tables give empty results."""
    return apply(rows, plan_of(rows, weights, source, size, rank, limit, tie), source, size, rank, tie)


def _taken(rank: str, size: str, tie: str | None = None) -> Column:
    """True for rows below a threshold: of the first pass, or of a fill that they were small enough for."""
    below = lambda c: F.col(rank) < c["below"] if tie is None else (F.col(rank) < c["below"]) | ((F.col(rank) == c["below"]) & (F.col(tie) < c["tie"]))
    return F.exists("cuts", lambda c: below(c) & (F.col(size) <= c["most"]))


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def mix_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1)) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document; texts are read once.

    Null and empty texts have size 0 and taken 0. Null sources are one source, the last. Rows
    of one doc_id have one hash: they are taken or left together, but where a budget ends among
    them; a null doc_id counts as empty text. Texts count whole. An empty table gives no rows.
    """
    rows = written(docs.select("doc_id", "source", n_words().alias("size"), row_hash("doc_id").alias("rank"), tie_hash(*docs.columns).alias("tie")), "sizes")
    out = mix(rows, weights, tie="tie")
    return out.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), (F.col("copies") * F.col("size")).alias("taken"))


def repeat_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1)) -> DataFrame:
    """docs with each row as often as the mix takes it; columns as they were, whatever their names.

    A source's share of words decides; rows of size 0 go as often as their source's whole passes,
    and once more where their hash is below its threshold.
    Null and empty texts have size 0; null sources are one source; an empty table stays empty; very
    long texts count whole.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # names of docs may clash with the added ones
    own = docs.toDF(*names.values())
    sized = own.withColumns({"size": n_words(names["text"]), "rank": row_hash(names["doc_id"]), "tie": tie_hash(*names.values())})
    plan = plan_of(written(sized.select(names["source"], "size", "rank", "tie"), "sizes"), weights, names["source"], tie="tie")
    out = apply(sized, plan, names["source"], tie="tie").filter("copies > 0")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select(*names.values()).toDF(*docs.columns)
