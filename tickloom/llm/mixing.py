"""Mixing sources to target weights, with DataFrame functions only.

Each row gets a hash-random key. Within a source the rows stand in order of their keys; a source's
budget is cut there, after as many whole epochs as it holds. To find the cut, the sizes are summed over
ranges of the key (equal ranges, as the keys are uniform), the sums are added up along the ranges, and
the one range in which the budget ends is added up row by row. So nothing but sums and one range per
source is gathered, and a row's share follows from comparing its key with its source's cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.llm.common import SPACES, col, fresh, words
from tickloom.session import written

# Leading hex digits of the key that name its range: 4096 ranges per source.
RANGE_DIGITS = 3


def hash_key(doc_id: Column, text: Column, seed: int) -> Column:
    """A hash-random key: 32 hex digits, equal only for rows with equal id and text."""
    own = F.md5(F.coalesce(text, F.lit("")))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("-")), own))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """The target of each source: columns source, source_size, target; one row per source.

    ``sizes`` has a row per source: source, source_size. Sources are put in order by code point, null
    last, and weigh ``weights``, repeating; ``share`` of all sizes is shared by weight. No target exceeds
    ``most`` times its source's size; what that leaves over goes to the others by weight until none is
    above. In order of size to weight, the sources that stop at their limit come first, so one running
    sum finds them. Both windows see one row per source.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    table = F.array(*[F.lit(int(w)) for w in weights])
    weighed = sizes.withColumn("weight", F.element_at(table, (place % len(weights) + 1).cast("int")))
    limit = F.lit(most) * F.col("source_size")
    ranked = W.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = ranked.rowsBetween(W.unboundedPreceding, -1), ranked.rowsBetween(0, W.unboundedFollowing)
    everything = ranked.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    levels = weighed.select(
        "*",
        limit.alias("limit"),
        F.row_number().over(ranked).alias("at"),
        (F.lit(share) * F.sum("source_size").over(everything)
         - F.coalesce(F.sum(limit).over(before), F.lit(0.0))).alias("left"),
        F.sum("weight").over(onward).alias("weights"),
    )
    full = F.col("limit") * F.col("weights") <= F.col("left") * F.col("weight")
    first = F.min(F.when(~full, F.struct("at", "left", "weights"))).over(everything)
    shared = first["left"] * F.col("weight") / first["weights"]
    target = F.when(full | first.isNull(), F.col("limit")).otherwise(shared)
    return levels.select("source", "source_size", target.cast("double").alias("target"))


def with_mix(
    docs: DataFrame, into: str = "mix", weights: Sequence[int] = (3, 1, 2), share: float = 1.5,
    most: float = 2.0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``docs`` with a struct ``into``: size, source_size, target, taken.

    ``size`` is the number of words of the text, ``taken`` how many of them the mix takes, repeats
    counted: every row whole in each epoch, and in the last one the rows before the cut whole and the row
    at the cut in part. A source's taken words are its target rounded down, short of at most one word for
    each row that repeats the row at the cut (rows with equal id and text share its part equally). No row
    exceeds the whole number of epochs above its target. Equal input gives an equal mix on every run.

    A null text has no words; a null source is a source; rows with null or repeated ids are mixed like
    others; an empty table stays empty. Other columns stay as they are; ``into`` must not be one of them.
    """
    size, key = (F.size(words(col(docs, text_col))).cast("long"),
                 hash_key(col(docs, id_col), col(docs, text_col), seed))
    rows = written(
        docs.select(col(docs, source_col).alias("source"), size.alias("size"), key.alias("key")), "mix-rows")
    rows = rows.withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    ranges = written(rows.groupBy("source", "range").agg(F.sum("size").alias("words")), "mix-ranges")
    sizes = ranges.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budgets = targets.withColumn("epochs", epochs).withColumn(
        "budget", F.floor("target") - F.col("epochs") * F.col("source_size"))
    # one row per source; stored, so that its size is known where it is joined
    budgets = written(budgets, "mix-budgets")
    s, b = ranges.alias("s"), budgets.alias("b")
    at = F.sum("words").over(W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1))
    ends = (
        s.join(b, F.col("s.source").eqNullSafe(F.col("b.source")))
        .select("s.source", "range", "words", "budget")
        .withColumn("before", F.coalesce(at, F.lit(0)))
        .filter((F.col("before") <= F.col("budget")) & (F.col("budget") < F.col("before") + F.col("words")))
        .drop("words")
    )
    ends = written(ends, "mix-ends").alias("e")
    inside = (
        rows.alias("r")
        .join(ends, F.col("r.source").eqNullSafe(F.col("e.source")) & (F.col("r.range") == F.col("e.range")))
        .groupBy("r.source", "key", "budget", "before")
        .agg(F.sum("size").alias("words"), F.count("*").alias("copies"))
    )
    own = F.sum("words").over(W.partitionBy("source").orderBy("key").rowsBetween(W.unboundedPreceding, -1))
    cuts = (
        inside.withColumn("at", F.col("before") + F.coalesce(own, F.lit(0)))
        .filter((F.col("at") <= F.col("budget")) & (F.col("budget") < F.col("at") + F.col("words")))
        .select(F.col("source").alias("cut_source"), F.col("key").alias("cut"),
                F.floor((F.col("budget") - F.col("at")) / F.col("copies")).alias("part"))
    )
    c = cuts.alias("c")
    plan = written(
        budgets.alias("b").join(c, F.col("b.source").eqNullSafe(F.col("c.cut_source")), "left")
        .select(F.struct("source", "source_size", "target", "epochs", "cut", "part").alias("plan")), "mix-plan")
    names = fresh(docs, "mix_plan", "mix_size", "mix_key")
    p, n, k = (F.col(x) for x in names)
    given = docs.withColumns({names[1]: size, names[2]: key})
    joined = given.join(
        plan.withColumnRenamed("plan", names[0]), col(docs, source_col).eqNullSafe(p["source"]), "left")
    last = F.when(k < p["cut"], n).when(k == p["cut"], F.least(n, p["part"])).otherwise(0)
    mix = F.struct(
        n.alias("size"), p["source_size"].alias("source_size"), p["target"].alias("target"),
        (p["epochs"] * n + last).cast("long").alias("taken"))
    return joined.withColumn(into, mix).drop(*names)


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word, white space kept; the whole text if it has fewer."""
    pieces = F.split(text, f"(?<=[^{SPACES}])(?=[{SPACES}])")
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def mixed(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix itself: each row as often as it is taken whole, and once cut where it is taken in part.

    Rows of which nothing is taken go, as do texts without words. The columns are those of ``docs``.
    ``options`` are those of ``with_mix``, which tells how nulls, ties and clashing names are handled.
    """
    mix, copy = fresh(docs, "mix", "mix_copy")
    m = F.col(mix)
    rest = m["taken"] % m["size"]
    # words of each copy: the whole text, and what is left over at last
    copies = F.concat(
        F.array_repeat(m["size"], (m["taken"] / m["size"]).cast("int")),
        F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    taken = with_mix(docs, mix, text_col=text_col, **options).filter(m["taken"] > 0)
    each = taken.withColumn(copy, F.explode(copies))
    text = F.when(F.col(copy) < m["size"], first_words(col(each, text_col), F.col(copy))).otherwise(col(each, text_col))
    return each.withColumn(text_col, text).select(*[col(docs, c) if c != text_col else F.col(f"`{c}`") for c in docs.columns])
