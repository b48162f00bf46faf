"""Exact dedup, sharding, mixing and the URL filter against brute force and on odd inputs."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cases import ODD, documents, rows, with_clashes, words
from dockflow.llm import chunk_dedup, feistel_shards as fs, mixing, url_filter
from dockflow.llm.common import row_key, unit
from dockflow.llm.numbering import numbered, spread


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


# --- exact dedup ------------------------------------------------------------------------
def expected_groups(docs):
    out, done = [], set()
    for doc_id, text, *_ in docs:
        same = [d[0] for d in docs if (d[1] or "") == (text or "")]
        ids = [i for i in same if i is not None]
        keep = max(ids) if ids else None
        first = doc_id == keep and (keep, text or "") not in done
        if first:
            done.add((keep, text or ""))
        out.append((doc_id, keep, len(same), first, sha(text)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("make", [documents, with_clashes])
def test_exact_groups(spark, make):
    assert rows(chunk_dedup.exact_groups(make(spark))) == expected_groups(ODD)
    assert rows(chunk_dedup.exact_groups(make(spark, []))) == []


def test_chunks_are_the_text_and_follow_content(spark):
    prose = "Any quiet bridge, a jolly deed. " * 900
    for text in (prose, "x" * 20_000, ODD[7][1]):
        got = spark.createDataFrame([(text,), ("y" + text,)], "t string").select(
            chunk_dedup.chunks(F.col("t")).alias("c")).collect()
        assert ["".join(r.c) for r in got] == [text, "y" + text]
    assert len(set(got[0].c) & set(got[1].c)) > len(got[0].c) // 2  # cuts meet again after an insertion


def test_identifiers_that_collide_are_drawn_anew(spark):
    tried = []

    def weak_first(chunk, attempt):
        tried.append(attempt)
        a, b = chunk_dedup.wide_fingerprint(chunk, attempt)
        return (a % 2, b % 1) if attempt == 0 else (a, b)

    got = chunk_dedup.exact_groups(documents(spark), fingerprint=weak_first)
    assert rows(got) == expected_groups(ODD) and set(tried) == {0, 1}


def test_keep_one_keeps_all_columns(spark):
    kept = chunk_dedup.keep_one(with_clashes(spark))
    assert kept.columns == with_clashes(spark).columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted({d[1] or "" for d in ODD})
    assert kept.filter("text like 'word%'").filter("doc_id = 2").count() == 1  # of two equal rows, one


# --- row numbers and sharding -------------------------------------------------------------
def test_numbers_have_no_gaps(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.when(F.col("id") % 10 > 0, F.col("id")).alias("v"))
    for group in ([], ["g"]):
        got = numbered(df, ["v"], 1000, group, ["v"]).collect()
        by = {}
        for r in got:
            by.setdefault(r.g if group else 0, []).append(r.row)
        assert all(sorted(v) == list(range(len(v))) for v in by.values())


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000, 4321])
def test_permutation(n):
    grid = fs.make_grid(n, 3)
    assert sorted(fs.position(i, grid) for i in range(n)) == list(range(n))
    assert grid.a * grid.b - n < grid.a


def test_columns_equal_numbers(spark):
    grid = fs.make_grid(777, 5)
    got = fs.permuted(spark.range(777), "id", grid).collect()
    assert all(r.position == fs.position(r.id, grid) for r in got)


@pytest.mark.parametrize("make", [documents, with_clashes])
def test_shards(spark, make):
    got = fs.shard(make(spark), 4).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id) == sorted(
        (d[0], len((d[1] or "").encode()) + 16, zlib.crc32((d[1] or "").encode())) for d in ODD if d[0])
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = fs.shard(make(spark).repartition(5), 4).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert fs.shard(make(spark, []), 4).collect() == []


def test_shards_of_another_seed_differ(spark):
    docs = documents(spark, [(i, "t", "en", "a", 1) for i in range(200)])
    one, two = ({r.doc_id: r.shard for r in fs.shard(docs, 10, seed).collect()} for seed in (0, 1))
    assert one != two


# --- mixing ---------------------------------------------------------------------------------
def filled(sizes, weights, share=1.5, limit=2.0):
    """Targets by resharing the excess again and again."""
    target, left = {}, dict(zip(sizes, weights))
    rest = share * sum(sizes.values())
    while left:
        part = {s: rest * w / sum(left.values()) for s, w in left.items()}
        over = [s for s in left if part[s] >= limit * sizes[s]]
        if not over:
            return target | part
        for s in over:
            target[s] = limit * sizes[s]
            rest -= target[s]
            del left[s]
    return target


def test_targets(spark):
    sizes = {"a": 100, "b": 5000, "c": 40, "d": 900, "e": 0, "ä": 3000}
    df = spark.createDataFrame([*sizes.items(), (None, 77)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = filled(sizes | {None: 77}, [5, 2, 1, 5, 2, 1, 5])
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)


@pytest.fixture(scope="module")
def many(spark):
    return documents(spark, [(i, words(1 + i * i % 211, i), "en", "xyz"[i % 3] if i % 5 else None, 1) for i in range(900)])


def test_mix_meets_targets(spark, many):
    got = mixing.mix(many, seed=1).collect()
    assert len(got) == 900 and all(0 <= r.taken <= 2 * r.size for r in got)
    largest = max(r.size for r in got)
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert sum(r.size for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= largest
    again = mixing.mix(many.repartition(7), seed=1).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def paired(items, draw, fan, levels):
    """The pairing in plain words: items of one source in order as [key, size, p]; draw(level, key) gives u."""
    taken = {}
    for level in range(levels):
        left = []
        for k in range(0, len(items), fan):
            i, *others = [list(item) for item in items[k:k + fan]]
            for j in others:
                to_i, to_j = min((1 - i[2]) * i[1], j[2] * j[1]), min(i[2] * i[1], (1 - j[2]) * j[1])
                if draw(level, j[0]) * (to_i + to_j) < to_j:  # i gains to_i words
                    full = (1 - i[2]) * i[1] <= j[2] * j[1]
                    i[2], j[2] = i[2] + to_i / i[1], j[2] - to_i / j[1]
                    settled, other, copies = (i, j, 1) if full else (j, i, 0)
                else:
                    gone = i[2] * i[1] <= (1 - j[2]) * j[1]
                    i[2], j[2] = i[2] - to_j / i[1], j[2] + to_j / j[1]
                    settled, other, copies = (i, j, 0) if gone else (j, i, 1)
                taken[settled[0]] = copies
                other[2] = min(1.0, max(0.0, other[2]))
                i = other
            left.append(i)
        items = left
    return taken | {i[0]: int(draw(levels, i[0]) < i[2]) for i in items}


def test_pairing_equals_a_plain_one(spark):
    draw = random.Random(8)
    sources = {"a": 700, "b": 64, "c": 65, None: 3, "d": 1}
    items = [(s, k, (s or "") + str(k), draw.randrange(1, 900), draw.choice([draw.random(), 0.5]))
             for s, n in sources.items() for k in range(n)]
    df = spark.createDataFrame(items, "source string, row long, key string, size long, p double")
    got = {r.key: r.extra for r in mixing.round_off(df, max(sources.values()), 5).collect()}
    levels = df.select("key", *[unit(F.lit(5), F.lit(level), "key").alias(str(level)) for level in range(5)]).collect()
    drawn = {(level, r.key): r[str(level)] for r in levels for level in range(5)}
    for s in sources:
        mine = [[key, size, p] for source, _, key, size, p in items if source == s]
        want = paired(mine, lambda level, key: drawn[level, key], mixing.FAN, 2)  # 700 items, 11 blocks, one block
        assert {k: got[k] for k in want} == want and len(want) == sources[s]
    assert len(got) == len(items)


def test_rows_of_one_id_lie_in_many_buckets(spark):
    df = spark.range(2000).select(F.lit(None).cast("long").alias("id"), F.col("id").alias("tie"))
    buckets = df.withColumn("b", spread(["id", "tie"], 45)).groupBy("b").count().collect()
    assert len(buckets) == 45 and max(r["count"] for r in buckets) < 90
    got = numbered(df, ["id"], 2000, ties=["tie"])
    assert sorted(r.row for r in got.collect()) == list(range(2000))
    assert rows(got) == rows(numbered(df.repartition(5), ["id"], 2000, ties=["tie"]))


def test_pairings_are_unbiased(spark, many):
    sums, size = {}, {}
    for seed in range(12):
        for r in mixing.mix(many, seed).select("source", "taken", "target").groupBy("source").agg(
                F.sum("taken").alias("t"), F.first("target").alias("goal")).collect():
            sums.setdefault(r.source, []).append(r.t - r.goal)
            size[r.source] = r.goal
    assert all(abs(sum(v) / len(v)) < 0.01 * size[s] + 120 for s, v in sums.items())


@pytest.mark.parametrize("make", [documents, with_clashes])
def test_mix_of_odd_rows(spark, make):
    got = mixing.mix(make(spark)).collect()
    assert len(got) == len(ODD) and sum(r.taken for r in got if r.size == 0) == 0
    mixed = mixing.mixed_rows(make(spark))
    assert mixed.columns == make(spark).columns
    taken = Counter()
    for r in mixing.mix(make(spark)).collect():
        taken[r.doc_id, r.rk] += r.copies
    docs = make(spark)
    seen = Counter((r[0], r[1]) for r in mixed.select("doc_id", row_key(docs).alias("k")).collect())
    assert seen == +taken
    assert mixing.mix(make(spark, [])).collect() == []


# --- URLs -------------------------------------------------------------------------------------
URLS = [
    (1, "HTTP://A.Example.COM/de/x"), (2, "http://example.net/en/1?b=1"), (3, "http://sub.example.net/fr/"),
    (4, "https://x.org/fr/2"), (5, "https://x.org/de/2"), (6, None), (7, "no host"), (8, "https://www.bad.test/a.html?utm_source=q&z=1&a=2#f"),
    (9, "http://bad.test:80/a?a=2&z=1"), (9, "http://bad.test:80/a?a=2&z=1"), (10, "http://bad.test/a?a=3"), (11, "://"),
    (12, "http://notexample.com/de/"), (13, "http://knet/"), (14, "http://net")]


def test_url_verdicts(spark):
    pages = spark.createDataFrame([(*u, "h", "v") for u in URLS], "page_id long, url string, host string, verdict string")
    listed = spark.createDataFrame([("bad.test/a?a=2&z=1",), (None,)], "canonical string")
    got = sorted({(r.page_id, r.rule, r.verdict) for r in url_filter.judge(pages, listed).collect()})
    assert got == [
        (1, "example.com/de/", "block"), (2, "example.net/en/", "allow"), (3, "net/", "block"), (4, "org/fr/", "allow"),
        (5, None, "allow"), (6, None, "allow"), (7, None, "allow"), (8, None, "block"), (9, None, "block"),
        (10, None, "allow"), (11, None, "allow"), (12, None, "allow"), (13, None, "allow"), (14, None, "allow")]
    assert url_filter.judge(pages, listed).count() == len(URLS)
    parts = {r.page_id: (r.host, r.path) for r in url_filter.judge(pages, listed).collect()}
    assert parts[1] == ("a.example.com", "/de/x") and parts[6] == parts[7] == parts[11] == ("", "")
    assert {r.verdict for r in url_filter.judge(pages, listed.limit(0)).filter("rule is null").collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), listed).count() == 0


def test_every_junk_host_of_the_pages_is_on_the_list(spark, tmp_path):
    from dockflow.llm.queries import op6_url_filter

    names = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm", "harmless"]
    pages = [(i, f"https://m.{n}.example.com/en/{i}") for i, n in enumerate(names)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.verdict for r in op6_url_filter(spark, str(tmp_path)).collect()}
    assert got == {i: "allow" if n == "harmless" else "block" for i, n in enumerate(names)}


def test_the_list_decides_by_address_and_not_by_host(spark):
    schema = "page_id long, url string"
    known = spark.createDataFrame([(1, "https://m.casino-win.example.com/en/1.html?utm_source=x&b=2&a=1")], schema)
    listed = url_filter.listed_under(known, ("casino-win",))
    pages = spark.createDataFrame([
        (1, "HTTP://www.Casino-Win.example.com:80/en/1/?a=1&b=2#top"), (2, "https://casino-win.example.com/en/1?a=1&b=2"),
        (3, "https://m.casino-win.example.com/en/2.html"), (4, "https://m.casino-win.example.com/en/1?a=1"),
        (5, "https://m.free-bets.example.com/en/1?a=1&b=2")], schema)
    got = {r.page_id: (r.listed, r.verdict) for r in url_filter.judge(pages, listed).collect()}
    assert got == {1: (True, "block"), 2: (True, "block"), 3: (False, "allow"), 4: (False, "allow"), 5: (False, "allow")}


def test_a_full_filter_lets_more_pass_but_stays_right(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.test/"), "id").alias("url"))
    listed = spark.range(0, 3000, 3).select(F.concat(F.lit("h.test/"), "id").alias("canonical"))
    small, large = (url_filter.judge(pages, listed, max_blocks=b) for b in (2, 65_536))
    for got in (small, large):
        assert got.filter("verdict = 'block'").count() == 1000 and got.filter("listed and not possible").count() == 0
    assert small.filter("possible").count() > large.filter("possible").count() < 1100


def test_smallest_hashes(spark):
    from dockflow.llm.common import smallest

    ids = spark.range(20_000)
    want = sorted(r.h for r in ids.select(F.xxhash64(F.lit(3), "id").alias("h")).collect())
    for n in (0, 1, 50, 3000, 20_000, 30_000):
        got = smallest(ids, "id", n, 3).select(F.xxhash64(F.lit(3), "id").alias("h"))
        assert sorted(r.h for r in got.collect()) == want[:n]
