"""Mixing sources to target weights (native: DataFrame functions only).

1. Every document's size is its number of words; sizes are added up per source.
2. Sources in code-point order, null last, get the weights of a cycle and share
   ``share`` times all words by weight.  No source's target passes ``repeats`` times
   its own words: what is above goes to the others by weight, until none is above.
   Each round of that is one aggregate over the table of sources.
3. A source's rate is its target by its size.  Every document is taken floor(rate)
   times, and once more if its draw falls below the rate's fraction.  The draw is a
   hash of seed, id and text, so reruns and any partitioning agree.
4. A few long documents can carry a small source far from its target.  So a source
   may turn its draws by one of ``draws`` fixed angles; one aggregate adds up what each
   would take and the nearest to the target is kept.

A source with a third of all rows is added up before the shuffle.  The table of
sources is written; the planner broadcasts it if its files are small enough and else
joins by sort and merge, where a hot source is split.

Defined results: a null or empty text has size 0 and adds nothing; a source without
words has target 0 and its documents are not taken; a null source is a source, equal
rows share one draw; an empty table gives no rows; other columns are ignored by
``plan`` and returned as they are by ``mix``.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import scratch_table
from emporium.operators.windows import seq_number

_WHITE = " \t\n\x0b\x0c\r"
_CIRCLE = 1 << 52


@dataclass(frozen=True)
class Settings:
    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    repeats: float = 2.0
    draws: int = 16
    seed: str = "mix"


def n_words(text: Column) -> Column:
    """How many runs of other than white space a text holds; 0 of null."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(marks, _WHITE, "")).cast("long")


def draw(seed: str, doc_id: Column, text: Column) -> Column:
    """A point of the circle of 2^52 from a row's id and text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"),
                   F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")


def targets(sized: DataFrame, s: Settings) -> DataFrame:
    """(source, source_size, target) of every source of (source, size)."""
    own = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # null last in code-point order; numbered by slices, however many sources there are
    own = own.withColumns({"_one": F.lit(1), "_null": F.col("source").isNull()})
    cycle = F.array(*[F.lit(float(w)) for w in s.weights])
    numbered = seq_number(scratch_table(own, "mix-sources"), "_one", ["_null", "source"], "_nr")
    weighed = scratch_table(numbered.select(
        "source", "source_size",
        F.element_at(cycle, (F.pmod(F.col("_nr") - 1, F.lit(len(s.weights))) + 1).cast("int")).alias("weight")),
        "mix-weights")
    stop = F.lit(s.repeats) * F.col("source_size")
    words, weights = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    unit, held = s.share * (words or 0) / weights if weights else 0.0, 0.0
    while weights:  # ends: each round stops more sources, or none
        above = F.col("weight") * F.lit(unit) > stop
        row = weighed.agg(F.sum(F.when(above, stop)), F.sum(F.when(~above, F.col("weight")))).first()
        if (row[0] or 0.0, row[1]) == (held, weights):
            break
        held, weights = row[0] or 0.0, row[1]
        unit = (s.share * words - held) / weights if weights else float("inf")
    return weighed.select("source", "source_size",
                          F.least(F.col("weight") * F.lit(unit), stop).alias("target"))


def _extra(turn: Column, draw_: Column, part: Column) -> Column:
    """The turned draw falls below the fraction ``part``."""
    step = _CIRCLE * 89 // 144 | 1
    return F.pmod(draw_ + turn * F.lit(step), F.lit(_CIRCLE)) < part * F.lit(float(_CIRCLE))


def rates(sized: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(source, source_size, target, times, part, turn) of (source, size, draw).

    ``times`` and ``part`` are the whole copies and the fraction of the rate."""
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    per_source = scratch_table(targets(sized, s).select(
        "source", "source_size", "target", F.floor(rate).alias("times"),
        (rate - F.floor(rate)).alias("part")), "mix-targets")
    tried = join_rates(sized, per_source).groupBy("source").agg(*[
        F.sum(F.when(_extra(F.lit(k), F.col("draw"), F.col("part")), F.col("size")).otherwise(0)).alias(f"t{k}")
        for k in range(s.draws)])
    both = tried.alias("t").join(per_source.alias("p"), F.col("t.source").eqNullSafe(F.col("p.source")))
    misses = F.array(*[F.struct(
        F.abs(F.col("times") * F.col("source_size") + F.col(f"t{k}") - F.col("target")).alias("miss"),
        F.lit(k).cast("long").alias("turn")) for k in range(s.draws)])
    return scratch_table(both.select("p.*", F.array_min(misses)["turn"].alias("turn")), "mix-rates")


def join_rates(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """``rows`` with their source's figures; a null source matches itself."""
    r = per_source.withColumnRenamed("source", "_source")
    return rows.join(r, rows["source"].eqNullSafe(r["_source"])).drop("_source")


def copies() -> Column:
    """How often a row with its source's figures is taken; a row without words never."""
    extra = _extra(F.col("turn"), F.col("draw"), F.col("part"))
    return F.when(F.col("size") > 0, F.col("times") + extra.cast("long")).otherwise(F.lit(0).cast("long"))


def _sized(docs: DataFrame, s: Settings, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       n_words(F.col(text_col)).alias("size"),
                       draw(s.seed, F.col(id_col), F.col(text_col)).alias("draw"), *more)


def plan(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies): what ``mix`` takes of every row."""
    sized = scratch_table(_sized(docs, s, id_col, text_col, source_col), "mix-sizes")
    return join_rates(sized, rates(sized, s)).select(
        "doc_id", "source", "size", "source_size", "target", copies().alias("copies"))


def mix(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """The mix itself: every row of ``docs``, all its columns, as often as it is taken."""
    sized = _sized(docs, s, id_col, text_col, source_col)
    figures = rates(scratch_table(sized, "mix-sizes"), s)
    whole = _sized(docs, s, id_col, text_col, source_col, F.expr("struct(*)").alias("_row"))
    taken = join_rates(whole, figures).withColumn("_copies", copies()).where("_copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("_row.*")
