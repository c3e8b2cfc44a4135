"""Mixing sources to target weights by pivotal dependent rounding.

A source of S words with target T gets T / S copies of each of its documents: the whole part for certain, the fraction
as a probability. Fractions are rounded in pairs: a random transfer of mass (probability times words) makes one of the
two integral and leaves the other with the residual, so that the words taken never change, only who holds them. Groups of
about FAN_IN documents are folded first, the largest ahead so that late carriers are small, their residuals are folded
group by group up a tree, and the last residual of a source is rounded to the nearer end. A source's words therefore
differ from its target by half a document at most.

Rows alike in id, source, size (and text, in mix_rows) are one unit: as many of them as their fractions add up to, rounded
down, get one more copy for certain, and the rest is one fraction of one document in the tree.

All of it is DataFrame and SQL functions: the tree's levels are group-bys on (source, node), folds are `aggregate`.
Sources are ranked within ranges of their names and the water level is found by sums over them, so that no task holds all
sources either.

Nulls are values like any other; documents and sources without words get 0 copies; an empty table gives an empty table.
Columns of mix_rows' input may have any names but those that begin with `__mix_`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from medleaf.llm.common import WORD, stored, table

FAN_IN = 64
SOURCES_IN_RANGE = 100_000
EPS = 1e-9


def _ranked(per: DataFrame, sources: int) -> DataFrame:
    """Adds rank, from 0, in code-point order of the sources, null last: places within ranges, and the ranges' lengths."""
    ranges = per.repartitionByRange(-(-sources // SOURCES_IN_RANGE) or 1, F.col("source").asc_nulls_last())
    ranges = stored(ranges.withColumn("range", F.spark_partition_id()), "mix-ranges")
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # one row for each range
    lengths = ranges.groupBy("range").agg(F.count("*").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    place = F.row_number().over(W.partitionBy("range").orderBy(F.col("source").asc_nulls_last())) - 1
    return ranges.withColumn("place", place).join(lengths, "range").withColumn("rank", F.col("start") + F.col("place")).drop("range", "start", "place")


def source_targets(units: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3) -> DataFrame:
    """(source, source_size, docs, target) from units (source, size, rows); docs is the number of units.

    Sources in code-point order, null last, get the weights (whole numbers) in turn and share all words by them; a target
    stops at `max_copies` times its source's words and the excess is shared again, until none is above. Sums are of whole
    numbers, so that their order does not matter.
    """
    per = stored(units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("docs")), "mix-sources")
    sources = per.count()
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    per = stored(_ranked(per, sources).withColumns({"weight": weight, "cap": F.col("source_size") * int(max_copies)}), "mix-ranked")
    total, most = per.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    gone, left = 0, most
    while left:  # the level only rises, and each round takes out at least one source
        above = F.col("cap") * F.lit(left) < F.col("weight") * F.lit(total - gone)  # below its share at this level
        found = per.agg(F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0)), F.coalesce(F.sum(F.when(above, F.col("weight"))), F.lit(0))).first()
        if (found[0], most - found[1]) == (gone, left):
            break
        gone, left = found[0], most - found[1]
    level = (total - gone) / left if left else float("inf")
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level)) if left else F.col("cap").cast("double")
    return per.select("source", "source_size", "docs", target.alias("target"))


def _draw(seed: int, *cols: Column) -> Column:
    """Repeatable uniform number in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*cols, F.lit(seed)), 11) / F.lit(float(1 << 53))


def _fold(items: Column) -> Column:
    """Pivotal rounding of one group.

    items: array of (x, s, u): fraction, words, random number. Gives (i, x, s, done): the index of the item that carries
    the residual, its fraction and words, and for every item 1, 0 or -1 (not decided).
    """
    start = F.struct(
        F.lit(-1).alias("i"), F.lit(0.0).alias("x"), F.lit(0.0).alias("s"), F.lit(0).alias("k"), F.transform(items, lambda _: F.lit(-1)).alias("done")
    )

    def set_at(done: Column, at: Column, value: Column) -> Column:
        return F.concat(F.slice(done, F.lit(1), at), F.array(value), F.slice(done, at + 2, F.greatest(F.size(done) - at - 1, F.lit(0))))

    def step(acc: Column, it: Column) -> Column:
        a, b = acc["x"] * acc["s"], it["x"] * it["s"]
        room_a, room_b = (1 - acc["x"]) * acc["s"], (1 - it["x"]) * it["s"]
        to_a, to_b = F.least(b, room_a), F.least(a, room_b)  # mass that can move to the carrier, to the new item
        give_a = it["u"] * (to_a + to_b) < to_b  # with probability to_b / (to_a + to_b) mass moves to the carrier
        xa = F.when(give_a, acc["x"] + to_a / acc["s"]).otherwise(acc["x"] - to_b / acc["s"])
        xb = F.when(give_a, it["x"] - to_a / it["s"]).otherwise(it["x"] + to_b / it["s"])
        whole_a = (xa < EPS) | (xa > 1 - EPS)
        settled = (it["x"] < EPS) | (it["x"] > 1 - EPS) | (it["s"] <= 0)
        first = acc["i"] < 0
        return (
            F.when(settled, F.struct(acc["i"].alias("i"), acc["x"].alias("x"), acc["s"].alias("s"), (acc["k"] + 1).alias("k"), set_at(acc["done"], acc["k"], F.when(it["x"] > 0.5, 1).otherwise(0)).alias("done")))
            .when(first, F.struct(acc["k"].alias("i"), it["x"].alias("x"), it["s"].alias("s"), (acc["k"] + 1).alias("k"), acc["done"].alias("done")))
            .when(whole_a, F.struct(acc["k"].alias("i"), xb.alias("x"), it["s"].alias("s"), (acc["k"] + 1).alias("k"), set_at(acc["done"], acc["i"], F.when(xa > 0.5, 1).otherwise(0)).alias("done")))
            .otherwise(F.struct(acc["i"].alias("i"), xa.alias("x"), acc["s"].alias("s"), (acc["k"] + 1).alias("k"), set_at(acc["done"], acc["k"], F.when(xb > 0.5, 1).otherwise(0)).alias("done")))
        )

    return F.aggregate(items, start, step)


def _children(level: DataFrame, above: DataFrame | None) -> DataFrame:
    """Adds `decided`, an array of 0 and 1 for every item, to a level whose residuals were settled by the level above."""
    if above is None:
        level = level.withColumn("residual", F.when(F.col("fold.x") >= 0.5, 1).otherwise(0))
    else:
        up = above.select("source", F.explode(F.arrays_zip(F.col("items.node").alias("node"), "decided")).alias("z"))
        up = up.select(F.col("source").alias("s_"), F.col("z.node").alias("n_"), F.col("z.decided").alias("residual"))
        level = level.join(up, level["source"].eqNullSafe(up["s_"]) & (level["node"] == up["n_"]), "left").drop("s_", "n_")
    decided = F.transform(F.col("fold.done"), lambda d, k: F.when(d >= 0, d).when(k == F.col("fold.i"), F.coalesce(F.col("residual"), F.lit(0))).otherwise(0))
    return level.withColumn("decided", decided)


def mix_counts(units: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3, seed: int = 11) -> DataFrame:
    """Copies of every document in the mix, from rows (doc_id, source, size) and, if it is there, a column more that tells
    them apart (mark).

    Returns (doc_id, source, size, mark, rows, source_size, target, base, extra), one row for each unit of `rows` rows alike:
    each gets base copies, and `extra` of them one more. No row gets more than `max_copies` copies. The same input gives
    the same copies, whatever its partitions.
    """
    mark = F.col("mark") if "mark" in units.columns else F.lit(0)
    units = units.select("doc_id", "source", F.coalesce("size", F.lit(0)).cast("long").alias("size"), mark.cast("long").alias("mark"))
    units = units.groupBy("doc_id", "source", "size", "mark").agg(F.count("*").alias("rows"))
    units = stored(units, "mix-units")  # texts are read and words counted once
    targets = stored(source_targets(units, weights, max_copies), "mix-targets")
    most = targets.agg(F.max("docs")).first()[0] or 0
    t = targets.select(F.col("source").alias("t_source"), "source_size", "docs", "target")
    rate = F.when(F.col("source_size") > 0, F.try_divide(F.col("target"), F.col("source_size"))).otherwise(F.lit(0.0))
    rows = units.join(t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source").withColumn("rate", rate)
    rows = rows.withColumn("base", F.floor(F.col("rate") + EPS)).withColumn("x", F.greatest(F.col("rate") - F.col("base"), F.lit(0.0)) * F.col("rows"))
    rows = rows.withColumn("sure", F.when(F.col("rows") > 1, F.floor(F.col("x") + EPS)).otherwise(F.lit(0))).withColumn("x", F.greatest(F.col("x") - F.col("sure"), F.lit(0.0)))
    nodes = F.greatest(F.ceil(F.col("docs") / FAN_IN), F.lit(1))
    rows = rows.withColumn("node", F.pmod(F.xxhash64("doc_id", "size", "mark", F.lit(seed)), nodes))
    item = F.struct(
        (-F.col("size")).alias("largest"), F.xxhash64("doc_id", "size", "mark", F.lit(seed + 1)).alias("h"), "doc_id", "size", "mark", "rows", "sure", F.lit(0).cast("long").alias("node"),
        "x", F.col("size").cast("double").alias("s"), _draw(seed, F.col("doc_id"), F.col("source"), F.col("size"), F.col("mark")).alias("u"),
    )
    grouped = rows.groupBy("source", "source_size", "target", "base", "node").agg(F.sort_array(F.collect_list(item)).alias("items"))
    levels = [stored(grouped.withColumn("fold", _fold(F.col("items"))), "mix-0")]
    width = -(-most // FAN_IN)
    while width > 1:
        k = len(levels)
        left = levels[-1].filter("fold.i >= 0").select("source", "node", "fold")
        item = F.struct((-F.col("fold.s")).alias("largest"), "node", F.col("fold.x").alias("x"), F.col("fold.s").alias("s"), _draw(seed + k, F.col("source"), F.col("node")).alias("u"))
        up = left.select("source", F.floor(F.col("node") / FAN_IN).alias("node_up"), item.alias("item"))
        up = up.groupBy("source", "node_up").agg(F.sort_array(F.collect_list("item")).alias("items")).withColumnRenamed("node_up", "node")
        levels.append(stored(up.withColumn("fold", _fold(F.col("items"))), f"mix-{k}"))
        width = -(-width // FAN_IN)
    above = None
    for level in reversed(levels):
        above = _children(level, above)
    out = above.select("source", "source_size", "target", "base", F.explode(F.arrays_zip("items", "decided")).alias("z"))
    of = {c: F.col("z.items")[c].alias(c) for c in ("doc_id", "size", "mark", "rows")}
    some = F.col("z.items.size") > 0
    extra = F.when(some, F.col("z.items.sure") + F.col("z.decided")).otherwise(F.lit(0)).cast("int")
    return out.select(of["doc_id"], "source", of["size"], of["mark"], of["rows"], "source_size", "target", F.when(some, F.col("base")).otherwise(F.lit(0)).cast("int").alias("base"), extra.alias("extra"))


def mix_copies(units: DataFrame, seed: int = 11) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies), one row for every row of (doc_id, source, size)."""
    found = mix_counts(units, seed=seed).withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    copies = F.col("base") + (F.col("nth") <= F.col("extra")).cast("int")
    return found.select("doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target", copies.alias("copies"))


def mix_rows(docs: DataFrame, seed: int = 11) -> DataFrame:
    """The mix itself: every row of docs as often as the mix takes it, with the columns of docs and no others.

    Which of several rows alike in id, source and text are taken once more is left open.
    """
    sized = docs.withColumns({"__mix_size": words_of("text"), "__mix_mark": F.xxhash64("text")})
    found = mix_counts(sized.select("doc_id", "source", F.col("__mix_size").alias("size"), F.col("__mix_mark").alias("mark")), seed=seed)
    found = stored(found.select(*[F.col(c).alias(f"__of_{c}") for c in ("doc_id", "source", "size", "mark", "rows", "base", "extra")]).filter("__of_base + __of_extra > 0"), "mix-copies")
    same = sized["doc_id"].eqNullSafe(found["__of_doc_id"]) & sized["source"].eqNullSafe(found["__of_source"]) & (sized["__mix_size"] == found["__of_size"]) & (sized["__mix_mark"] == found["__of_mark"])
    alone = sized.join(found.filter("__of_rows = 1"), same).withColumn("__mix_n", F.col("__of_base") + F.col("__of_extra"))
    alike = sized.join(found.filter("__of_rows > 1"), same)
    each = W.partitionBy("__of_doc_id", "__of_source", "__of_size", "__of_mark").orderBy("__of_mark")
    alike = alike.withColumn("__mix_n", F.col("__of_base") + (F.row_number().over(each) <= F.col("__of_extra")).cast("int"))
    both = alone.select(*[docs[c] for c in docs.columns], "__mix_n").unionByName(alike.select(*[docs[c] for c in docs.columns], "__mix_n"))
    return both.filter("__mix_n > 0").withColumn("__mix_n", F.explode(F.sequence(F.lit(1), "__mix_n"))).drop("__mix_n")


def words_of(text: str) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def op1_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", words_of("text").alias("size"))
    return mix_copies(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "source", "copies")
