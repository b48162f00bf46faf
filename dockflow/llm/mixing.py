"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target number of words. A document of a source should be taken
target / source_size times: a whole number of copies and a fractional probability of one more.
Two fractional documents are paired, and words of probability are moved at random from one to
the other, without bias, until one of them has none or a whole copy; that one is settled. What
remains is paired on. Each source's expected words stay exactly the same in every pairing, so
in the end its words miss the target by one document at most. Large documents come first, so that
this one is small.

The pairing is a reduction tree: blocks of at most `FAN` documents settle all but one each, the
remainders form the next level's blocks, until a source has one document left, which a
last draw settles.
"""

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from dockflow.llm.common import packed, row_key, same, settle, unit, unpacked, word_count
from dockflow.llm.numbering import numbered

FAN = 64  # documents in a block of the tree
WEIGHTS = (5, 2, 1)  # of sources in order, repeating
SHARE = 1.5  # words of the mix over words of all sources
LIMIT = 2.0  # most times that a source is repeated


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            limit: float = LIMIT) -> DataFrame:
    """Target words of each source; sources has one row each: source, source_size.

    Sources in code point order, null last, take the weights in turn. A source whose
    part by weight passes `limit` times its size stops there, and the excess is shared by
    weight again: in order of limit per weight, sources stop as long as the common level lies above
    theirs; the first that does not stop has the final level, the largest among the rest. There is
    one row a source, so one task sorts them.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    placed = sources.withColumn("turn", F.row_number().over(order)).select(
        "source", "source_size", (F.col("source_size") * limit).alias("most"),
        F.get(wheel, ((F.col("turn") - 1) % len(weights)).cast("int")).alias("weight"), "turn")
    rising = Window.orderBy(F.col("most") / F.col("weight"), "turn")
    earlier, later = (rising.rowsBetween(Window.unboundedPreceding, -1),
                      rising.rowsBetween(0, Window.unboundedFollowing))
    whole = F.sum("source_size").over(Window.partitionBy()) * share
    level = (whole - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))) / F.sum("weight").over(later)
    stopped = placed.withColumn("level", level).withColumn(
        "stops", F.col("most") <= F.col("level") * F.col("weight"))
    common = F.max(F.when(~F.col("stops"), F.col("level"))).over(Window.partitionBy())
    return stopped.select("source", "source_size", F.when(
        F.col("stops"), F.col("most")).otherwise(common * F.col("weight")).alias("target"))


# One pairing of `s.carry` (i) with the next item x (j). `up` and `down` are the words of probability
# that may move to i or to j; i gains with the chance that leaves both expectations as they were.
_UP = "least((1D - s.carry.p) * s.carry.size, x.p * x.size)"
_DOWN = "least(s.carry.p * s.carry.size, (1D - x.p) * x.size)"
_GAINS = f"(x.u * ({_UP} + {_DOWN}) < {_DOWN})"
_FULL = "((1D - s.carry.p) * s.carry.size <= x.p * x.size)"  # i reaches a whole copy before j is used up
_GONE = "(s.carry.p * s.carry.size <= (1D - x.p) * x.size)"  # i is used up before j reaches a whole copy


def _settled(item: str, extra: int) -> str:
    return f"named_struct('key', {item}.key, 'size', {item}.size, 'extra', {extra}L)"


def _kept(item: str, p: str) -> str:
    return (f"named_struct('key', {item}.key, 'size', {item}.size, "
            f"'p', greatest(0D, least(1D, {p})), 'u', {item}.u)")


PAIRING = f"""
CASE WHEN {_GAINS} AND {_FULL} THEN named_struct(
       'carry', {_kept('x', f'x.p - {_UP} / x.size')}, 'done', concat(s.done, array({_settled('s.carry', 1)})))
     WHEN {_GAINS} THEN named_struct(
       'carry', {_kept('s.carry', f's.carry.p + {_UP} / s.carry.size')}, 'done', concat(s.done, array({_settled('x', 0)})))
     WHEN {_GONE} THEN named_struct(
       'carry', {_kept('x', f'x.p + {_DOWN} / x.size')}, 'done', concat(s.done, array({_settled('s.carry', 0)})))
     ELSE named_struct(
       'carry', {_kept('s.carry', f's.carry.p - {_DOWN} / s.carry.size')}, 'done', concat(s.done, array({_settled('x', 1)})))
END"""


def _level(items: DataFrame) -> DataFrame:
    """One level of the tree: a row for each block with its remainder and what it settled."""
    blocks = items.groupBy("source", F.expr(f"row div {FAN}L").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("row", "key", "size", "p", "u"))).alias("raw"))
    bare = blocks.withColumn("raw", F.transform(
        "raw", lambda i: F.struct(i["key"].alias("key"), i["size"].alias("size"), i["p"].alias("p"), i["u"].alias("u"))))
    return bare.select("source", "block", F.expr(f"""
        aggregate(slice(raw, 2, size(raw)),
                  named_struct('carry', raw[0], 'done', slice(array({_settled('raw[0]', 0)}), 2, 1)),
                  (s, x) -> {PAIRING})""").alias("out"))


def round_off(items: DataFrame, largest: int, seed: int) -> DataFrame:
    """Settle fractional items: source, key, size, extra (0 or 1).

    items: source, row (0 .. within its source), key, size > 0, 0 < p < 1; `largest` bounds the
    items of a source and so the levels.
    """
    done, level = [], 0
    while True:
        drawn = items.withColumn("u", unit(F.lit(seed), F.lit(level), "key"))
        if level and largest <= 1:
            last = drawn.select("source", "key", "size", (F.col("u") < F.col("p")).cast("long").alias("extra"))
            return _union([*done, last])
        out = settle(_level(drawn))
        done.append(out.select("source", F.explode("out.done").alias("d")).select("source", "d.*"))
        items = out.select("source", F.col("block").alias("row"), "out.carry.key", "out.carry.size", "out.carry.p")
        largest, level = math.ceil(largest / FAN), level + 1


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def _size_class(size: str) -> Column:
    """Rank of a size: eight steps to each power of two."""
    digits = F.length(F.bin(size))
    return digits * 8 + F.expr(f"shiftright({size}, greatest(length(bin({size})) - 4, 0)) & 7").cast("int")


def mix(docs: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """How often each document is taken: doc_id, rk, source, size, source_size, target, copies, taken.

    One row per row of docs; `rk` is the fingerprint of the whole row. size counts words (null text:
    none), a document is taken at most twice, and a document without words 0 times. A null
    source is a source of its own, repeated rows and ids are rows like any other, an empty table gives no
    rows. The same rows and seed give the same mix, whatever their order or files.
    """
    base = settle(docs.select(F.col(id_col).alias("doc_id"), row_key(docs).alias("rk"),
                              F.col(source_col).cast("string").alias("source"),
                              word_count(text_col).alias("size")))
    sums = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    size = sums.agg(F.max("n").alias("largest"), F.sum("n").alias("rows")).first()
    goal = targets(sums.drop("n"))
    rows = numbered(base.withColumn("octave", -_size_class("size")), ["doc_id"], size["rows"] or 0,
                    ["source"], ["rk"], ["octave"], "nr")
    planned = rows.join(goal, same(rows, goal, ["source"])).select(
        rows["source"], F.struct("doc_id", "rk", "nr").alias("key"), "size", "nr", "source_size", "target",
        F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("times"))
    planned = settle(planned.withColumn("whole", F.floor("times"))
                     .withColumn("p", F.col("times") - F.col("whole")))
    whole = planned.filter("p = 0").select("source", "key", "size", F.lit(0).cast("long").alias("extra"))
    # A source's documents with words share one fraction, so their numbers may have gaps only where
    # texts are empty: a block holds FAN documents at most.
    parts = planned.filter("p > 0").select("source", F.col("nr").alias("row"), "key", "size", "p")
    settled = _union([whole, round_off(parts, size["largest"] or 0, seed)])
    planned = planned.drop("size")
    per_source = planned.select("source", "source_size", "target", "times").groupBy("source").agg(
        F.max("source_size").alias("source_size"), F.max("target").alias("target"),
        F.floor(F.max("times")).alias("whole"))
    out = settled.join(per_source, same(settled, per_source, ["source"]))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("extra")).otherwise(0).cast("long")
    return out.select("key.doc_id", "key.rk", settled["source"], "size", "source_size", "target",
                      copies.alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


def mixed_rows(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The rows of docs as the mix takes them: each as often as its copies."""
    taken = mix(docs, seed).groupBy("doc_id", "rk").agg(F.sum("copies").alias("copies"))
    rows = packed(docs, F.col("doc_id").alias("id"), row_key(docs).alias("rk"))
    return unpacked(rows, taken.toDF("id", "rk", "copies"), ["id", "rk"])
