"""Mixing sources to target weights by capped water-filling.

Sources get words in proportion to their weights, but none more than
``max_epochs`` times its own size: sources over that are clamped and their
excess is shared out among the others by weight, until none is over. That fixed
point is computed in one pass: with sources in order of cap / weight, the
clamped ones are a prefix, and the level of the rest follows from running sums.

A document is then taken floor(target / source size) whole times, and once more
if its seeded draw is below its source's cut. The cut is where the running
size, in order of draws, comes nearest to the rest of the target. It is found by
three rounds of digits of the draw (sums per bucket, then only the bucket that
holds the cut is looked into), so no source is ever sorted in one task, however
large.

Only tables with one row a source meet in one task (the window over sources).

Defined results: null source is a source of its own (last); null text has size
0; null doc_id draws as the empty string; equal rows share one draw, so they are
taken alike; a source of size 0 has target 0; an empty table gives an empty one;
clashing extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import col, fresh, stage, word_count

WEIGHTS = (3, 1, 2)          # weights by rank of the source, repeating
SHARE = 1.5                  # words of the mix, of all words
MAX_EPOCHS = 2
SEED = 17
_DIGITS = ((48, 12), (36, 12))  # shifts and widths of the rounds; the last 36 bits are ordered


def _draw(doc_id: Column, text: Column, seed: int) -> Column:
    """60 bits of a digest of seed, id and text: equal on every run."""
    body = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")),
                       F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(body), 1, 15), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row a source (source, source_size) -> plus target (double). A window
    over the sources: one row each, the only unpartitioned step."""
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(rank) - 1) % len(weights) + 1).cast("int"))
    s = sources.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    order = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("goal", F.sum("source_size").over(everything) * F.lit(share))
    level = (F.col("goal") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    s = s.withColumn("clamped", F.col("cap") / F.col("w") <= level)
    free = F.sum(F.when(~F.col("clamped"), F.col("w"))).over(everything)
    spent = F.coalesce(F.sum(F.when(F.col("clamped"), F.col("cap"))).over(everything), F.lit(0.0))
    s = s.withColumn("target", F.when(F.col("clamped"), F.col("cap"))
                     .otherwise(F.col("w") * ((F.col("goal") - spent) / free)))
    return s.select("source", "source_size", "target")


def _cuts(slim: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, cut): documents whose draw is at most ``cut`` are taken once
    more. No row for a source that takes none."""
    whole = F.floor(F.col("target") / F.col("source_size"))
    at = plan.where(F.col("source_size") > 0).select(
        "source", (F.col("target") - whole * F.col("source_size")).alias("rest"),
        F.lit(0).cast("long").alias("prefix"))
    at = at.where(F.col("rest") > 0)
    done = 0
    for shift, width in _DIGITS:
        a = at.alias("a")
        inside = slim.alias("d").join(
            a, F.col("d.source").eqNullSafe(F.col("a.source"))
            & (F.shiftright(F.col("d.draw"), shift + width) == F.col("a.prefix")))
        sums = inside.groupBy(F.col("a.source").alias("source"), F.col("a.rest").alias("rest"),
                              F.shiftright(F.col("d.draw"), shift).alias("prefix")).agg(F.sum("d.size").alias("size"))
        run = Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("past", F.coalesce(F.sum("size").over(run), F.lit(0)))
        # the last bucket that begins before the rest is used up
        last = sums.where(F.col("past") < F.col("rest")).groupBy("source").agg(
            F.max(F.struct("prefix", "past", "rest")).alias("b"))
        at = stage(last.select("source", (F.col("b.rest") - F.col("b.past")).alias("rest"),
                               F.col("b.prefix").alias("prefix")), f"mix-cut-{done}")
        done += 1
    shift = _DIGITS[-1][0]
    a = at.alias("a")
    rows = slim.alias("d").join(a, F.col("d.source").eqNullSafe(F.col("a.source"))
                                & (F.shiftright(F.col("d.draw"), shift) == F.col("a.prefix")))
    one = rows.groupBy(F.col("a.source").alias("source"), F.col("a.rest").alias("rest"), "prefix", "draw").agg(
        F.sum("size").alias("size"))
    run = Window.partitionBy("source").orderBy("draw").rowsBetween(Window.unboundedPreceding, -1)
    one = one.withColumn("past", F.coalesce(F.sum("size").over(run), F.lit(0)))
    nearer = F.col("past") + F.col("size") / F.lit(2.0) < F.col("rest")
    # none of the bucket taken: everything below the bucket is
    return one.groupBy("source").agg(F.coalesce(
        F.max(F.when(nearer, F.col("draw"))),
        F.shiftleft(F.min("prefix"), shift) - 1).alias("cut"))


def mix(docs: DataFrame, out_col: str = "mix", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
        max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``docs`` (doc_id, text, source and any others) plus the struct
    ``out_col``: size, source_size, target, copies, taken (= copies x size)."""
    slim = stage(docs.select(col("source").alias("source"), word_count(col("text")).alias("size"),
                             _draw(col("doc_id"), col("text"), seed).alias("draw")), "mix-sizes")
    plan = stage(targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")),
                         weights, share, max_epochs), "mix-targets")
    cuts = _cuts(slim, plan)
    p, c = plan.alias("p"), cuts.alias("c")
    per_source = p.join(c, F.col("p.source").eqNullSafe(F.col("c.source")), "left").select(
        F.struct(F.col("p.source").alias("source"), "source_size", "target", "cut").alias("s"))
    name, size, draw = fresh(docs, "__source", "__size", "__draw")
    rows = docs.withColumns({size: word_count(col("text")), draw: _draw(col("doc_id"), col("text"), seed)})
    per_source = per_source.withColumnRenamed("s", name)
    s = col(name)
    joined = rows.join(per_source, col("source").eqNullSafe(s["source"]), "left")
    copies = F.when(s["source_size"] > 0, F.floor(s["target"] / s["source_size"])).otherwise(0) + F.when(
        col(draw) <= s["cut"], 1).otherwise(0)
    return joined.select(*[col(x) for x in docs.columns], F.struct(
        col(size).alias("size"), s["source_size"].alias("source_size"), s["target"].alias("target"),
        copies.cast("long").alias("copies"), (copies * col(size)).cast("long").alias("taken")).alias(out_col))


def repeat_rows(mixed: DataFrame, columns: list[str], out_col: str = "mix") -> DataFrame:
    """The mixed corpus itself: each row as many times as it is taken."""
    n, = fresh(mixed, "__copy")
    return (mixed.where(F.col(out_col)["copies"] > 0)
            .withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), F.col(out_col)["copies"])))
            .select(*[col(c) for c in columns]))


MIXING_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  ('0x' || md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, ''))[1:15])::BIGINT AS draw
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w,
             source_size * 2.0::DOUBLE AS cap, (sum(source_size) OVER ())::BIGINT * 1.5::DOUBLE AS goal FROM s),
l AS (SELECT *, cap / w <= (goal - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                           / sum(w) OVER (ORDER BY cap / w, source NULLS LAST
                              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS clamped FROM r),
t AS (SELECT source, source_size, CASE WHEN clamped THEN cap ELSE
        w * ((goal - coalesce(sum(CASE WHEN clamped THEN cap END) OVER (), 0))
             / sum(CASE WHEN NOT clamped THEN w END) OVER ()) END AS target FROM l),
f AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
g AS (SELECT d.source, draw, sum(size) AS size FROM d GROUP BY d.source, draw),
o AS (SELECT source, draw, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS past FROM g),
k AS (SELECT o.source, max(draw) AS cut FROM o JOIN f ON o.source IS NOT DISTINCT FROM f.source
      WHERE past + size / 2.0 < target - whole * source_size GROUP BY o.source)
SELECT d.doc_id, d.size, f.source_size, f.target,
       ((f.whole::BIGINT + CASE WHEN d.draw <= k.cut THEN 1 ELSE 0 END) * d.size)::BIGINT AS taken,
       (f.whole::BIGINT + CASE WHEN d.draw <= k.cut THEN 1 ELSE 0 END)::BIGINT AS copies
FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source
LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source
"""
