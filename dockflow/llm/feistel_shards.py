"""Sharding by a Feistel permutation of global row numbers.

Row numbers 0 .. n-1 are written as pairs (u, v) on an a x b grid that just holds them. A
round adds a function of one half to the other, modulo its side, so any round function gives
a permutation of the grid. A number that lands beyond n - 1 is sent through again until it
lands inside (cycle walking), which leaves a permutation of the n rows. Position p goes to
shard p mod shards, slot p div shards: shard sizes differ by one row at most, and shard and
slot of a row number can be computed anywhere (`position`) without reading the data.
"""

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from dockflow.llm.common import settle
from dockflow.llm.numbering import numbered

PRIME = 2 ** 31 - 1  # products of two residues fit a long
ROUNDS = 8  # even, so that the halves end where they began


@dataclass(frozen=True)
class Grid:
    """The permutation of n rows: sides of the grid and four constants for each round."""

    n: int
    a: int
    b: int
    keys: tuple[tuple[int, int, int, int], ...]


def make_grid(n: int, seed: int) -> Grid:
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))
    keys = []
    for i in range(ROUNDS):
        digest = hashlib.sha256(f"{seed}/{i}".encode()).digest()
        keys.append(tuple(1 + int.from_bytes(digest[8 * k:8 * k + 8], "big") % (PRIME - 1)
                          for k in range(4)))
    return Grid(n, a, b, tuple(keys))


def step(x: int, grid: Grid) -> int:
    """One pass of the permutation of the grid, on a number."""
    u, v, mu, mv = x // grid.b, x % grid.b, grid.a, grid.b
    for c, d, e, f in grid.keys:
        y = (v * c + d) % PRIME
        u, v, mu, mv = v, (u + (y * y + e * y + f) % PRIME) % mu, mv, mu
    return u * grid.b + v


def position(row: int, grid: Grid) -> int:
    """Where a row number goes: the same value as the column."""
    x = step(row, grid)
    while x >= grid.n:
        x = step(x, grid)
    return x


def walks(grid: Grid) -> int:
    """Passes after which every row has landed inside.

    Only the grid's fewer than sqrt(n) + 1 spare numbers prolong a walk, so following those
    gives the bound for all rows.
    """
    outside, passes = range(grid.n, grid.a * grid.b), 1
    while outside:
        outside, passes = [y for x in outside if (y := step(x, grid)) >= grid.n], passes + 1
        if passes > grid.a * grid.b - grid.n + 1:
            break  # the rest are cycles of spare numbers, which no row enters
    return passes


def _step_column(x: str, grid: Grid) -> Column:
    keys = ", ".join(f"named_struct('c', {c}L, 'd', {d}L, 'e', {e}L, 'f', {f}L)" for c, d, e, f in grid.keys)
    y = f"((s.v * k.c + k.d) % {PRIME}L)"
    return F.expr(
        f"aggregate(array({keys}), "
        f"named_struct('u', {x} div {grid.b}L, 'v', {x} % {grid.b}L, 'mu', {grid.a}L, 'mv', {grid.b}L), "
        f"(s, k) -> named_struct('u', s.v, 'v', (s.u + ({y} * {y} + k.e * {y} + k.f) % {PRIME}L) % s.mu, "
        f"'mu', s.mv, 'mv', s.mu), s -> s.u * {grid.b}L + s.v)")


def permuted(df: DataFrame, row: str, grid: Grid, out: str = "position") -> DataFrame:
    """Add the permuted position of a row number."""
    moved = df.withColumn(out, _step_column(f"`{row}`", grid))
    for _ in range(walks(grid) - 1):
        moved = moved.withColumn(out, F.when(F.col(out) < grid.n, F.col(out))
                                 .otherwise(_step_column(f"`{out}`", grid)))
    return moved


def shard(docs: DataFrame, shards: int, seed: int = 0, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Shard and slot of every document: doc_id, size, text_crc32, row, shard, slot.

    The law is `rows`: counts of shards differ by one at most. Equal texts and repeated ids are
    dealt like any other rows. A null text counts as empty (size 16, crc32 0), a null id
    is numbered first within its bucket (buckets come from id, size and crc32, so rows of one id lie in many), rows equal in id, size and crc32 are
    interchangeable, an empty table gives no rows. Other columns of docs, whatever their
    names, are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = settle(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")))
    grid = make_grid(narrow.count(), seed)
    rows = numbered(narrow, ["doc_id"], grid.n, ties=["size", "text_crc32"])
    return permuted(rows, "row", grid).select(
        "doc_id", "size", "text_crc32", "row",
        (F.col("position") % shards).cast("int").alias("shard"),
        F.expr(f"position div {shards}L").alias("slot"))
