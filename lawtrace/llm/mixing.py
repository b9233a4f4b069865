"""Mixing of sources to target weights along a time-varying curriculum.

Each source has a target of words and a weight schedule over training time 0..1. The integral of the schedule, scaled
to the target, is the source's cumulative demand; the words of its documents (in a keyed pseudo-random order, repeated
as often as the target asks) meet that demand one after another, and inverting it at a document's first word gives its
training position. Sorting by position over all sources gives the training order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawtrace.llm.storage import row_of, with_row, written

#: Weight knots (time, weight) given to sources in turn: early-heavy, level, late-heavy.
SHAPES = (((0.0, 3.0), (0.5, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.25), (0.75, 1.0), (1.0, 4.0)))
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shape_segments(spark, shapes=SHAPES) -> DataFrame:
    """``(shape, t0, t1, w0, w1, d0, d1)``: linear pieces with the normalised demand before and after each."""
    rows = []
    for i, knots in enumerate(shapes):
        areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
        total, done = sum(areas), 0.0
        for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:]), areas):
            rows.append((i, t0, t1, w0, w1, done / total, (done + area) / total))
            done += area
        rows[-1] = (*rows[-1][:-1], 1.0)
    return spark.createDataFrame(rows, "shape int, t0 double, t1 double, w0 double, w1 double, d0 double, d1 double")


def source_targets(sized: DataFrame, weights: tuple[int, ...], cap: float, n_shapes: int) -> DataFrame:
    """``(source, source_size, target, shape)``, one row for each source.

    All sizes are shared by weight; targets stop at ``cap`` times their source's size and the excess is reshared.
    With sources in ascending order of cap / weight, the first k stop and the others get level * weight, where k is the
    first for which the level does not reach the next source's stop; levels only fall after it, so it has the highest. Sources go in code-point order, null last.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    listed = "array(" + ", ".join(f"{w}D" for w in weights) + ")"
    ranked = totals.selectExpr("source", "source_size", "row_number() over (order by source asc nulls last) - 1 as nth").selectExpr("source", "source_size", f"{listed}[cast(nth % {len(weights)} as int)] as weight", f"cast(nth % {n_shapes} as int) as shape")
    level = ranked.selectExpr("*", f"{cap}D * source_size as stop", f"{cap}D * source_size / weight as ratio")
    order = "(order by ratio, source asc nulls last rows between unbounded preceding and 1 preceding)"
    run = level.selectExpr("*", "sum(source_size) over () as everything", f"coalesce(sum(stop) over {order}, 0D) as stopped", f"sum(weight) over () - coalesce(sum(weight) over {order}, 0D) as open")
    found = run.selectExpr("*", "(everything - stopped) / open as level").selectExpr("*", "max(case when level <= ratio then level end) over () as water")
    return found.selectExpr("source", "source_size", "shape", "least(stop, coalesce(water * weight, stop)) as target")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: float = 3.0, shapes=SHAPES, seed: int = 7, rows_per_bucket: int = 20_000, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row of ``docs``: id, size in words, source_size, target, taken and ``uses``.

    ``uses`` is an array of (pass, words, position): in pass p the mix takes the first ``words`` words of the document
    at that training position. The stream of a source, its documents in the order of md5(seed:id) repeated pass after
    pass, is cut at the whole part of its target, so taken words equal it exactly and no document is used more than
    ``ceil(cap)`` times. No text moves; ``text_key`` is its hash.

    Word offsets inside a source come from sums of hash buckets (as many as give ``rows_per_bucket`` rows each) and a
    window inside each bucket: no task orders a whole source. Null texts have no words and are never taken; a null
    source is a source of its own, the last; equal ids are ordered by text hash, and repeated rows get one place each.
    """
    from math import ceil, log

    spark = docs.sparkSession
    sized = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))).alias("key"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"))
    sized, _ = written(sized, "sized")
    digits = max(1, ceil(log(max(sized.count() / rows_per_bucket, 1), 16)) + 1)
    targets, _ = written(source_targets(sized, weights, cap, len(shapes)), "targets")

    bucketed = sized.withColumn("bucket", F.expr(f"substring(key, 1, {digits})"))
    before = bucketed.groupBy("source", "bucket").agg(F.sum("size").alias("n")).selectExpr("source as b_source", "bucket as b_bucket", "coalesce(sum(n) over (partition by source order by bucket rows between unbounded preceding and 1 preceding), 0) as earlier")
    inside = bucketed.selectExpr("*", "coalesce(sum(size) over (partition by source, bucket order by key, doc_id, text_key rows between unbounded preceding and 1 preceding), 0) as own")
    placed = inside.join(before, F.expr("source <=> b_source and bucket = b_bucket")).withColumn("at", F.expr("own + earlier"))
    placed = placed.join(F.broadcast(targets.withColumnRenamed("source", "t_source")), F.expr("source <=> t_source"))  # one row for each source

    passes = ", ".join(str(i) for i in range(ceil(cap)))
    words = "least(size, greatest(cast(floor(target) as long) - (p * source_size + at), 0))"
    uses = placed.withColumn("raw", F.expr(f"filter(transform(array({passes}), p -> named_struct('pass', p, 'words', {words}, 'share', (p * source_size + at) / nullif(target, 0D))), u -> u.words > 0)"))
    segments = shape_segments(spark, shapes).groupBy("shape").agg(F.array_sort(F.collect_list(F.struct("d0", "d1", "t0", "t1", "w0", "w1"))).alias("segments"))
    uses = uses.join(F.broadcast(segments), "shape")  # the schedule given by the caller
    segment = "filter(segments, s -> u.share < s.d1)[0]"
    # inside a piece, weight rises linearly: w0 x + (w1 - w0) x^2 / 2 is the share of its area (w0 + w1) / 2
    solve = "case when s.w0 = s.w1 then y else (sqrt(s.w0 * s.w0 + (s.w1 - s.w0) * (s.w0 + s.w1) * y) - s.w0) / (s.w1 - s.w0) end"
    position = f"transform(array({segment}), s -> transform(array((u.share - s.d0) / (s.d1 - s.d0)), y -> s.t0 + (s.t1 - s.t0) * ({solve}))[0])[0]"
    uses = uses.withColumn("uses", F.expr(f"transform(raw, u -> named_struct('pass', u.pass, 'words', u.words, 'position', {position}))"))
    return uses.selectExpr("doc_id", "size", "source", "source_size", "target", "coalesce(aggregate(uses, 0L, (a, u) -> a + u.words), 0L) as taken", "uses", "text_key")


def in_training_order(mixed: DataFrame) -> DataFrame:
    """Rows of ``mix`` with ``first_position``, that of the document's first use, range-sorted by it. Documents never used have
    none and come last, by id, so that no task holds all of them."""
    placed = mixed.withColumn("first_position", F.get("uses", F.lit(0))["position"])
    return placed.orderBy(F.col("first_position").asc_nulls_last(), "doc_id", "text_key")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` as the mix takes them, range-sorted by training position: a row for each use, its text cut to the words
    used. Documents the mix never takes go. Rows equal in id and text share their uses and the columns of one of them.
    """
    uses = mix(docs, id_col=id_col, text_col=text_col, **options).select(F.col("doc_id").alias("use_id"), F.col("text_key").alias("use_key"), "size", F.explode("uses").alias("use"))
    grouped = uses.groupBy("use_id", "use_key").agg(F.first("size").alias("size"), F.collect_list("use").alias("uses"))
    grouped, _ = written(grouped.withColumn("use_id", F.coalesce("use_id", F.lit(-(1 << 63)))), "uses")
    keyed = with_row(docs, F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("use_id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("use_key"), F.col(text_col).alias("whole"))
    joined = keyed.dropDuplicates(["use_id", "use_key"]).join(grouped.hint("merge"), ["use_id", "use_key"]).withColumn("use", F.explode("uses"))
    cut = F.when(F.col("use.words") >= F.col("size"), F.col("whole")).otherwise(F.array_join(F.slice(F.split("whole", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"), F.lit(1), F.col("use.words").cast("int")), ""))
    ordered = joined.withColumn("cut_text", cut).repartitionByRange("use.position", "use_id").sortWithinPartitions("use.position", "use_id", "use.pass")
    return ordered.select(*row_of(docs, **{text_col: F.col("cut_text")}))
