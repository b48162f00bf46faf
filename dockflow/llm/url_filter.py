"""URL filter: rules first, then a list of canonical URLs behind a blocked Bloom filter.

The filter is a table of 256-bit blocks. A URL's hash names one block and two bits in each of its
four words, so a probe reads one row. The filter's size has a fixed upper bound, therefore it may be
broadcast; beyond that bound it lets more URLs pass, which costs time and not correctness,
as an exact join on the canonical URL decides about every URL that passes.
"""

import math

from pyspark.sql import Column, DataFrame, functions as F

from dockflow.llm.common import settle

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))  # fixed values

MAX_BLOCKS = 65_536  # of 32 bytes each; with the block number 2.6 MB as rows
BITS_PER_URL = 16

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"  # query parameters that name no page


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null or a URL without `://`."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """The same text for spellings of one address; null where there is no host.

    Scheme, `www.`, `m.` and `blog.` hosts, default ports, fragment, tracking parameters, the
    order of parameters, a trailing slash and `.html` make no difference.
    """
    host, path = host_and_path(url)
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^(www|m|blog)\.", "")
    path = F.regexp_replace(F.regexp_replace(path, r"\.html?$", ""), r"/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    parameters = F.array_join(F.array_sort(kept), "&")
    return F.when(host != "", F.concat(host, path, F.when(
        parameters != "", F.concat(F.lit("?"), parameters)).otherwise("")))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (like `net/`) and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, domain, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(prefix)
        name = F.when(fits, F.lit(domain + prefix)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _masks() -> list[Column]:
    """Two bits in each of four words, from the hash `_h`, which is independent of the block's."""
    bit = lambda shift: F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_h, {shift}) & 63 as int))")
    return [bit(12 * w).bitwiseOR(bit(12 * w + 6)) for w in range(4)]


def _placed(df: DataFrame, url_col: str, blocks: int) -> DataFrame:
    hashed = df.withColumn("_h", F.xxhash64(F.lit(1), url_col)).withColumn(
        "_block", F.pmod(F.xxhash64(F.lit(2), url_col), F.lit(blocks)).cast("int"))
    for w, mask in enumerate(_masks()):
        hashed = hashed.withColumn(f"_m{w}", mask)
    return hashed.drop("_h")


def build_filter(listed: DataFrame, n: int, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """The blocks of the filter of the column `canonical`, and how many there can be."""
    blocks = 2 ** min(math.ceil(math.log2(max(1, n * BITS_PER_URL / 256))), int(math.log2(max_blocks)))
    rows = _placed(listed, "canonical", blocks).groupBy("_block").agg(
        *[F.bit_or(f"_m{w}").alias(f"_f{w}") for w in range(4)])
    return rows, blocks


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, id_col: str = "page_id",
          url_col: str = "url", max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """Verdict on every URL: page_id, host, path, rule, canonical, possible, listed, verdict.

    A rule decides where one fits. Elsewhere a URL is blocked if its canonical form is in
    `listed` (column `canonical`), else allowed. `possible` says whether the Bloom filter let it
    through. A null or hostless URL fits no rule, is not listed and is allowed; repeated rows are judged
    each; an empty list allows all that rules do not block. Other columns of pages are not read.
    """
    urls = settle(listed.select("canonical").filter("canonical is not null").distinct())
    blocks, count = build_filter(urls, urls.count(), max_blocks)
    host, path = host_and_path(F.col(url_col))
    seen = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"),
                        canonical(F.col(url_col)).alias("canonical"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    seen = _placed(seen.withColumn("rule", name).withColumn("ruled", verdict), "canonical", count)
    probed = seen.join(F.broadcast(blocks), "_block", "left")
    passes = F.lit(True)
    for w in range(4):
        passes = passes & (F.col(f"_f{w}").bitwiseAND(F.col(f"_m{w}")) == F.col(f"_m{w}"))
    passes = F.col("canonical").isNotNull() & F.coalesce(passes, F.lit(False))
    probed = probed.withColumn("possible", passes).select(
        "page_id", "host", "path", "rule", "ruled", "canonical", "possible")
    found = probed.filter("possible").join(urls.withColumn("listed", F.lit(True)), "canonical", "left")
    rest = probed.filter("not possible").withColumn("listed", F.lit(False))
    both = found.unionByName(rest).withColumn("listed", F.coalesce("listed", F.lit(False)))
    return both.select("page_id", "host", "path", "rule", "canonical", "possible", "listed",
                       F.coalesce("ruled", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))


def listed_under(pages: DataFrame, names: tuple[str, ...], url_col: str = "url") -> DataFrame:
    """A list for `judge`: the canonical URLs of pages below hosts with one of the names as a label."""
    host, _ = host_and_path(F.col(url_col))
    pattern = r"(^|\.)(" + "|".join(names) + r")(\.|$)"
    return pages.filter(host.rlike(pattern)).select(canonical(F.col(url_col)).alias("canonical"))
