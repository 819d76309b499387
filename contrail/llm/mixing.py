"""Mixing sources to target weights by pivotal dependent rounding, without Python tasks.

Every document of a source is wanted ``target / source size`` times. The whole
part is taken as it is. The fractional parts are rounded so that the words of
the source stay equal to its target: two open documents exchange mass (words)
at random, with the odds that keep each one's expectation, until one of them is
at 0 or 1; the other goes on. Blocks of documents are folded that way in one
task each, and what a block leaves open is folded again with the leavings of
other blocks, level by level. One open document a source remains and is
rounded by its odds, so a source misses its target by at most that document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contrail.llm.scratch import store

WORDS = r"[^\x20\x09-\x0D]+"
BLOCK = 128  # open documents folded in one go
LEVELS = 40


def targets(sizes: DataFrame, weights: list[float], share: float, cap: float) -> DataFrame:
    """(source, source_size, target): targets by weight, none above ``cap`` times its source.

    Sources go by code point, null last, and take the weights in turn. The
    excess of capped sources is shared out again by weight until none is above.
    With the sources ordered by size over weight, the capped ones are a prefix,
    so running sums replace the repetition. One row a source meets in a window.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    listed = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.get(listed, (place % len(weights)).cast("int")))
    ratio = F.col("source_size") / F.col("weight")
    upto = Window.orderBy(ratio, F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # Before a source's turn: what the capped ones before it took, and the weight left.
    per = (
        per.withColumn("taken", F.coalesce(F.sum(F.col("source_size") * cap).over(upto), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
        .withColumn("all", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("rate", (F.col("all") - F.col("taken")) / F.col("left"))
        .withColumn("capped", F.col("rate") * F.col("weight") >= F.col("source_size") * cap)
    )
    free = F.min(F.when(~F.col("capped"), F.struct(ratio.alias("r"), "rate"))).over(everything)["rate"]
    want = F.when(F.col("capped"), F.col("source_size") * cap).otherwise(free * F.col("weight"))
    return per.select("source", "source_size", F.least(want, F.col("source_size") * F.lit(float(cap))).alias("target"))


def _unit(seed: int, *parts: Column) -> Column:
    """A uniform value in [0, 1) that only depends on its arguments."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11)
    return bits.cast("double") / F.lit(float(2**53))


def _exchange(x: Column, y: Column, u: Column) -> tuple[Column, Column]:
    """(closed, open) after one random exchange of mass between two documents."""
    up = F.least(x["size"] * (1 - x["p"]), y["size"] * y["p"])  # from y to x
    down = F.least(x["size"] * x["p"], y["size"] * (1 - y["p"]))  # from x to y
    to_x = u * (up + down) < down
    full_x = x["size"] * (1 - x["p"]) <= y["size"] * y["p"]
    void_x = x["size"] * x["p"] <= y["size"] * (1 - y["p"])

    def put(d: Column, p: Column) -> Column:
        return d.withField("p", F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))

    def pair(x_p, y_p, x_closed: bool) -> Column:
        new_x, new_y = put(x, x_p), put(y, y_p)
        return F.struct((new_x if x_closed else new_y).alias("closed"), (new_y if x_closed else new_x).alias("open"))

    one, zero = F.lit(1.0), F.lit(0.0)
    out = (
        F.when(to_x & full_x, pair(one, y["p"] - up / y["size"], True))
        .when(to_x, pair(x["p"] + up / x["size"], zero, False))
        .when(void_x, pair(zero, y["p"] + down / y["size"], True))
        .otherwise(pair(x["p"] - down / x["size"], one, False))
    )
    return out["closed"], out["open"]


def _fold(items: Column, seed: int, level: int) -> Column:
    """The documents of a block, all but the last one at 0 or 1."""

    def step(acc: Column, x: Column) -> Column:
        closed, open_ = _exchange(acc["open"], x, _unit(seed, F.lit(level), acc["open"]["key"], x["key"]))
        return F.struct(open_.alias("open"), F.concat(acc["done"], F.array(closed)).alias("done"))

    start = F.struct(items[0].alias("open"), F.slice(items, 1, 0).alias("done"))
    return F.aggregate(
        F.slice(items, 2, BLOCK * 1000), start, step, lambda acc: F.concat(acc["done"], F.array(acc["open"]))
    )


def _nearer(rounded: DataFrame) -> DataFrame:
    """Turn the one fractional document of each source that brings its words nearest to target.

    The last open document of a source may be its longest, and its rounding is
    all that separates the source from its target.
    """
    got = F.sum((F.col("base") + F.col("p")) * F.col("size"))
    gaps = rounded.groupBy("source", "target").agg((F.col("target") - got).alias("gap"))
    same = [F.col("source").eqNullSafe(F.col("of"))]
    gaps = gaps.select(F.col("source").alias("of"), "gap")
    turned = F.when(F.col("p") > 0, -F.col("size")).otherwise(F.col("size"))
    left = F.abs(F.col("gap") - turned)
    best = (
        rounded.filter("part").join(gaps, same).filter(left < F.abs("gap"))
        .groupBy("source").agg(F.min(F.struct(left.alias("left"), "key")).alias("m"))
        .select(F.col("source").alias("of"), F.col("m.key").alias("turn"))
    )
    return rounded.join(best, same, "left").withColumn(
        "p", F.when(F.col("key") == F.col("turn"), 1 - F.col("p")).otherwise(F.col("p"))
    ).drop("of", "turn")


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 7,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), one row per row of ``docs``.

    ``size`` counts the words of the text (null: 0), ``copies`` says how often
    the document is taken and ``taken`` is ``copies * size``. Documents without
    words are taken 0 times, as is everything of a source without words. A null
    source is a source of its own, last in the order. Rows that repeat are
    separate candidates. The same rows give the same result in any order. Other
    columns are ignored, and an empty table gives no rows.
    """
    sized = store(
        docs.select(
            F.col("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        ),
        "sizes",
    )
    aims = store(targets(sized, list(weights), share, cap), "targets")
    # One row a source; sources are few, but nothing here relies on it.
    want = F.col("target") / F.col("source_size")
    rows = sized.withColumn("k", F.coalesce("source", F.lit(""))).withColumn("n", F.col("source").isNull()).join(
        aims.select(
            F.coalesce("source", F.lit("")).alias("k"), F.col("source").isNull().alias("n"), "source_size", "target"
        ),
        ["k", "n"],
    )
    base = F.when(F.col("size") > 0, F.floor(want)).otherwise(0).cast("long")
    part = F.when(F.col("size") > 0, want - F.floor(want)).otherwise(0.0)
    # Equal rows are told apart by their number, so that each is drawn on its own.
    turn = F.row_number().over(Window.partitionBy("doc_id", "n", "k", "size").orderBy(F.lit(0)))
    rows = store(
        rows.withColumn("base", base).withColumn("p", part).withColumn("turn", turn)
        .withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "n", "k", "size", "turn")),
        "wanted",
    )
    closed = rows.filter("p <= 0").drop("turn")
    live = rows.filter("p > 0").drop("turn")
    item = ["key", "doc_id", "source", "size", "source_size", "target", "base", "p"]
    made = [closed.select(*item, F.lit(False).alias("part"))]
    for level in range(LEVELS):
        counts = live.groupBy("n", "k").agg(F.count(F.lit(1)).alias("c"))
        blocks = F.ceil(F.col("c") / BLOCK)
        dealt = live.join(counts, ["n", "k"]).withColumn(
            "block", F.pmod(F.xxhash64(F.lit(level), "key"), blocks)
        ).withColumn("last", blocks == 1)
        folded = (
            dealt.groupBy("n", "k", "block", "last").agg(F.sort_array(F.collect_list(F.struct(*item))).alias("items"))
            .select("n", "k", "last", F.posexplode(_fold(F.col("items"), seed, level)).alias("pos", "d"), F.size("items").alias("c"))
        )
        folded = store(folded.select("n", "k", "last", (F.col("pos") == F.col("c") - 1).alias("open"), "d.*"), "folded")
        fractional = F.lit(True).alias("part")
        made.append(folded.filter("NOT open").select(*item, fractional))
        ended = folded.filter("open AND last")
        final = F.when(_unit(seed, F.lit(-1), F.col("key")) < F.col("p"), 1.0).otherwise(0.0)
        made.append(ended.withColumn("p", final).select(*item, fractional))
        live = folded.filter("open AND NOT last").drop("open", "last")
        if live.isEmpty():
            break
    out = made[0]
    for more in made[1:]:
        out = out.unionByName(more)
    out = _nearer(store(out, "rounded"))
    copies = (F.col("base") + F.round("p")).cast("long")
    return out.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )
