"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import WORD, written

_KEY_BITS = 48
_LEVEL_BITS = 8
_LEVELS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, cycle=(5, 2, 1), total_ratio: float = 1.5, max_repeats: int = 2
) -> DataFrame:
    """source, source_size, target and the number of the source, from (source, source_size).

    Sources in code point order, null last, get the weights of ``cycle`` in turn and share
    ``total_ratio`` of all words. No target exceeds ``max_repeats`` times its source; what is
    above goes to the others by weight. Works on one row per source: sorted by how soon a source
    is full, each is full if its share of what those before it leave exceeds its limit.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    fill = Window.orderBy("full_at", "source_no")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    rows = (
        sizes.withColumn("source_no", F.row_number().over(by_name) - 1)
        .withColumn("share", F.get(weights, F.col("source_no") % len(cycle)))
        .withColumn("most", F.col("source_size") * float(max_repeats))
        .withColumn("full_at", F.col("most") / F.col("share"))
        .withColumn("all_words", F.sum("source_size").over(everything) * total_ratio)
        .withColumn("left_words", F.col("all_words") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left_words") / F.sum("share").over(after))
        .withColumn("full", F.col("full_at") <= F.col("level"))
        .withColumn("open_level", F.min(F.when(~F.col("full"), F.struct("full_at", "source_no", "level"))).over(everything)["level"])
    )
    target = F.when(F.col("full"), F.col("most")).otherwise(F.col("share") * F.col("open_level"))
    return rows.select("source", "source_no", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    cycle=(5, 2, 1),
    total_ratio: float = 1.5,
    max_repeats: int = 2,
    weight: Column | None = None,
    seed: int = 17,
) -> DataFrame:
    """Documents with how often the mix takes each: size, source_size, target, copies, taken.

    A document's expected number of copies is its source's target over its source's size, times
    its weight over the source's mean weight, at most ``max_repeats``. The whole part is certain.
    For the rest each source is sampled: documents are ranked by the odds of a random number over
    the odds of their remaining expectation, and taken in that order if they fit what is left of
    the source's words: a pass goes on until a document exceeds what is left, the largest document
    that still fits is added, and the next pass goes on among those that fit, until none does.
    Each pass at least halves what is open, so there are few.

    The cut of a pass is found on sums over 256 ranges of the rank, then over 256 parts of the
    range that holds it, and so on, so no task sorts a source. Only numbers are shuffled; texts
    are scanned once more to attach the decision, which depends on nothing but the row and its
    source's passes.

    The random number comes from seed, doc_id, source, text and weight, and the number of the
    row among those with all these equal, so reruns agree on how often each is taken. Which of
    equal rows are taken may differ in their extra columns. Null or empty texts have size 0 and are taken or not without
    effect. Null sources form a source, the last. No documents give no rows. Extra columns are
    kept; columns named size, source_size, target, copies or taken are replaced.
    """
    own = ["size", "source_size", "target", "copies", "taken"]
    kept = [c for c in docs.columns if c not in own]
    wide = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        F.greatest(F.coalesce((F.lit(1.0) if weight is None else weight).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("weight"),
    ).withColumn("draw", F.xxhash64(F.lit(seed), "doc.doc_id", "source", "doc.text", "weight"))
    wide, rows = _drawn_apart(wide, written(wide.drop("doc"), "mix-rows"))
    sources = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("weight")).alias("weighted")
    )
    targets = source_targets(sources.select("source", "source_size"), cycle, total_ratio, max_repeats)
    rates = written(
        targets.alias("t")
        .join(sources.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source")))
        .select(
            "t.*",
            F.when(F.col("weighted") > 0, F.col("target") / F.col("weighted")).otherwise(0.0).alias("rate"),
        ),
        "mix-rates",
    )

    units = written(
        _ranked(rows, rates, max_repeats)
        .groupBy("source_no", "rank_key")
        .agg(
            F.sum("size").alias("words"),
            F.sum(F.col("certain") * F.col("size")).alias("certain_words"),
            F.max("open").alias("open"),
        ),
        "mix-units",
    )
    budgets = units.groupBy("source_no").agg(F.sum("certain_words").alias("certain_words")).join(
        rates.select("source_no", "target"), "source_no"
    ).select("source_no", (F.col("target") - F.col("certain_words")).alias("budget"))
    open_units = units.filter("open").select("source_no", "rank_key", "words")
    passes, added = _passes(open_units, budgets)
    picks = rates.join(
        passes.groupBy("source_no").agg(F.collect_list(F.struct("low", "high", "most")).alias("passes")), "source_no", "left"
    ).join(
        added.groupBy("source_no").agg(F.sort_array(F.collect_list("rank_key")).alias("added")), "source_no", "left"
    )

    # Stored, so that a table of few sources is seen to be small and the texts need no shuffle.
    picks = written(picks, "mix-picks")
    passed = F.exists(
        "passes",
        lambda p: (F.col("rank_key") > p["low"]) & (F.col("rank_key") <= p["high"]) & (F.col("size") <= p["most"]),
    )
    sampled = F.col("open") & (
        F.coalesce(passed, F.lit(False)) | F.coalesce(F.array_contains("added", F.col("rank_key")), F.lit(False))
    )
    copies = F.col("certain") + sampled.cast("long")
    return _ranked(wide, picks, max_repeats).select(
        "doc.*",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def _drawn_apart(wide: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with a draw of its own for each of several rows with the same one."""
    shared = written(rows.groupBy("draw").agg(F.count("*").alias("n_rows")).filter("n_rows > 1"), "mix-shared")
    if shared.isEmpty():
        return wide, rows
    # Equal rows are numbered by slices of some thousand, so that many of them are not in one task.
    slices = 1 + F.floor(F.col("n_rows") / 5_000)
    again = written(
        wide.join(shared, "draw").withColumn("slice", F.floor(F.rand(1) * slices)).drop("n_rows"), "mix-again"
    )
    sizes = again.groupBy("draw", "slice").agg(F.count("*").alias("n_rows"))
    before = Window.partitionBy("draw").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("draw", "slice", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("first"))
    number = F.row_number().over(Window.partitionBy("draw", "slice").orderBy(F.lit(0)))
    apart = written(
        again.withColumn("number", number)
        .join(firsts, ["draw", "slice"])
        .withColumn("draw", F.xxhash64("draw", F.col("first") + F.col("number")))
        .select(*wide.columns),
        "mix-apart",
    )
    single = shared.select("draw")
    return (
        wide.join(single, "draw", "left_anti").select(*wide.columns).unionByName(apart),
        rows.join(single, "draw", "left_anti").select(*rows.columns).unionByName(apart.drop("doc")),
    )


def _ranked(rows: DataFrame, rates: DataFrame, max_repeats: int) -> DataFrame:
    """Rows with the certain copies, whether a further one is open, and the rank for it."""
    uniform = (F.shiftrightunsigned("draw", 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    expected = F.least(F.col("rate") * F.col("weight"), F.lit(float(max_repeats)))
    rest = F.col("expected") - F.col("certain")
    ratio = (F.col("uniform") / (1 - F.col("uniform"))) / (F.col("rest") / (1 - F.col("rest")))
    top = (1 << _KEY_BITS) - 1
    return (
        rows.alias("r")
        .join(rates.alias("k"), F.col("r.source").eqNullSafe(F.col("k.source")))
        .drop(F.col("r.source"))
        .withColumn("expected", expected)
        .withColumn("certain", F.floor("expected"))
        .withColumn("rest", rest)
        .withColumn("uniform", uniform)
        .withColumn("open", F.col("rest") > 0)
        .withColumn(
            "rank_key",
            F.when(F.col("open"), F.floor(ratio / (1 + ratio) * F.lit(float(top)))).otherwise(F.lit(top)).cast("long"),
        )
    )


def _cuts(units: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source the last rank whose words, with all before, fit the budget; and what stays open."""
    state = budgets.withColumn("lowest", F.lit(0).cast("long"))
    width = _KEY_BITS
    for _ in range(_LEVELS):
        inside = _inside(units, state, width)
        width -= _LEVEL_BITS
        part = F.shiftright(F.col("rank_key"), width)
        sums = inside.groupBy("source_no", part.alias("part")).agg(F.sum("words").alias("words"))
        running = Window.partitionBy("source_no").orderBy("part")
        reached = (
            sums.join(state.select("source_no", "budget"), "source_no")
            .withColumn("through", F.sum("words").over(running))
            .filter("through <= budget")
            .groupBy("source_no")
            .agg(F.max("part").alias("part"), F.max("through").alias("through"))
        )
        # The next range to look into starts after the last one that fits whole.
        state = written(
            state.join(reached, "source_no", "left").select(
                "source_no",
                (F.col("budget") - F.coalesce("through", F.lit(0))).alias("budget"),
                F.coalesce(F.shiftleft(F.col("part") + 1, width), F.col("lowest")).alias("lowest"),
            ),
            "mix-range",
        )
        # Empty ranges may lie before the one that holds the cut: go on at its first unit.
        first = (
            units.join(state, "source_no")
            .filter("rank_key >= lowest")
            .groupBy("source_no")
            .agg(F.min("rank_key").alias("first"))
        )
        state = written(
            state.join(first, "source_no", "left").select(
                "source_no",
                "budget",
                F.coalesce(F.shiftleft(F.shiftright("first", width), width), F.col("lowest")).alias("lowest"),
            ),
            "mix-range",
        )
    running = Window.partitionBy("source_no").orderBy("rank_key")
    last = (
        _inside(units, state, width)
        .withColumn("through", F.sum("words").over(running))
        .filter("through <= budget")
        .groupBy("source_no")
        .agg(F.max("rank_key").alias("cut"), F.max("through").alias("through"))
    )
    return state.join(last, "source_no", "left").select(
        "source_no",
        F.coalesce("cut", F.col("lowest") - 1).alias("cut"),
        (F.col("budget") - F.coalesce("through", F.lit(0))).alias("gap"),
    )


def _inside(units: DataFrame, state: DataFrame, width: int) -> DataFrame:
    return units.join(state, "source_no").filter(
        (F.col("rank_key") >= F.col("lowest"))
        & (F.col("rank_key") < F.col("lowest") + F.lit(1 << width))
    )


def _passes(units: DataFrame, budgets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a walk by rank takes that passes over units which do not fit.

    Passes (source_no, low, high, most): units with ranks above low, up to high, of at most that
    many words. And single units added after a pass, the largest that fit then. A unit that does
    not fit once never will, so each pass has to look only beyond the one before.
    """
    state = budgets.select("source_no", F.lit(-1).cast("long").alias("cut"), F.col("budget").alias("gap"))
    rest = units.filter("words > 0")
    passes, added = [], []
    while True:
        fitting = written(
            rest.join(state, "source_no").filter("rank_key > cut AND words <= gap").select("source_no", "rank_key", "words"),
            "mix-fitting",
        )
        if passes and fitting.isEmpty():
            break
        open_sources = state.join(fitting.select("source_no").distinct(), "source_no", "left_semi")
        cuts = written(_cuts(fitting, open_sources.select("source_no", F.col("gap").alias("budget"))), "mix-cuts")
        passes.append(
            open_sources.alias("s").join(cuts.alias("c"), "source_no").select(
                "source_no", F.col("s.cut").alias("low"), F.col("c.cut").alias("high"), F.col("s.gap").alias("most")
            )
        )
        best = written(
            fitting.join(cuts, "source_no")
            .filter("rank_key > cut AND words <= gap")
            .groupBy("source_no")
            .agg(F.max(F.struct("words", (-F.col("rank_key")).alias("before"))).alias("best"))
            .select("source_no", (-F.col("best.before")).alias("rank_key"), F.col("best.words").alias("words")),
            "mix-added",
        )
        added.append(best.select("source_no", "rank_key"))
        state = written(
            cuts.join(best.select("source_no", "words"), "source_no", "left").select(
                "source_no", "cut", (F.col("gap") - F.coalesce("words", F.lit(0))).alias("gap")
            ),
            "mix-state",
        )
        rest = fitting.join(added[-1], ["source_no", "rank_key"], "left_anti")
    return reduce(DataFrame.unionByName, passes), reduce(DataFrame.unionByName, added)
