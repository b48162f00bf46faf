"""DuckDB SQL for the registered queries of this package that SQL can express."""

from dockflow.llm import feistel_shards as fs
from dockflow.llm.queries import SHARDS, SPAM_HOSTS
from dockflow.llm.url_filter import RULES

OP4 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def _op6() -> str:
    longest = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = {r: f"(host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}')" for r in longest}
    rule = " ".join(f"WHEN {fits[r]} THEN '{r[1]}{r[2]}'" for r in longest)
    verdict = " ".join(f"WHEN {fits[r]} THEN '{r[0]}'" for r in longest)
    names = "|".join(SPAM_HOSTS)
    return rf"""
WITH split AS (
  SELECT page_id, url, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, url,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
                   lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS kept
  FROM split),
named AS (
  SELECT *, CASE WHEN host <> '' THEN
    regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^(www|m|blog)\.', '')
    || regexp_replace(regexp_replace(path, '\.html?$', ''), '/+$', '')
    || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical
  FROM parts),
judged AS (
  SELECT *, coalesce(canonical IN (SELECT canonical FROM named
                          WHERE canonical IS NOT NULL AND regexp_matches(host, '(^|\.)({names})(\.|$)')), false) AS listed
  FROM named)
SELECT page_id, host, path, CASE {rule} END AS rule, canonical, listed,
       CASE {verdict} WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""


def _op7() -> str:
    """The permutation by nested subqueries; enough walks for any table that the check uses.

    crc32 is computed byte by byte, from a table that follows from its polynomial.
    """
    grid = fs.make_grid(1, 0)
    bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    entry = "i"
    for _ in range(8):
        entry = f"(SELECT {bit} FROM (SELECT {entry} AS c))"
    rows, position = "numbered", "row"
    for walk in range(6):
        rows = f"(SELECT *, {position} // b AS u, {position} % b AS v, a AS mu, b AS mv FROM {rows})"
        for c, d, e, f in grid.keys:
            rows = f"(SELECT * REPLACE ((v * {c} + {d}) % {fs.PRIME} AS y) FROM (SELECT *, 0::BIGINT AS y FROM {rows}))"
            rows = (f"(SELECT * EXCLUDE (y) REPLACE (v AS u, (u + (y * y + y * {e} + {f}) % {fs.PRIME}) % mu AS v, "
                    f"mv AS mu, mu AS mv) FROM {rows})")
        value = "u * b + v" if walk == 0 else "CASE WHEN p < n THEN p ELSE u * b + v END"
        rows = f"(SELECT * EXCLUDE (u, v, mu, mv{', p' if walk else ''}), {value} AS p FROM {rows})"
        position = "p"
    return f"""
WITH crc AS (SELECT list(e ORDER BY i) AS t FROM (SELECT i, {entry} AS e FROM range(256) r(i))),
narrow AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(strlen(coalesce(text, ''))),
             lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT)),
           lambda acc, x: xor(acc >> 8, t[xor(acc & 255, x) + 1]))) AS text_crc32
  FROM (SELECT *, hex(encode(coalesce(text, ''))) AS h FROM documents), crc),
counted AS (SELECT narrow.*, n, 1 + floor(sqrt(greatest(n - 1, 0)))::BIGINT AS a FROM narrow, (SELECT count(*) AS n FROM narrow)),
gridded AS (SELECT *, greatest(1, (n + a - 1) // a) AS b,
         ('0x' || substr(md5(concat_ws(chr(31), coalesce(doc_id::VARCHAR, chr(0)), size, text_crc32)), 1, 8))::BIGINT % a AS bucket FROM counted),
numbered AS (SELECT *, row_number() OVER (ORDER BY bucket, doc_id NULLS FIRST, size, text_crc32) - 1 AS row FROM gridded)
SELECT doc_id, size, text_crc32, 'rows' AS law, (p % {SHARDS})::INT AS shard, p // {SHARDS} AS slot,
       NULL::INT AS grown_shard
FROM {rows}
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_chunk_dedup": OP4, "op6_url_filter": _op6(), "op7_feistel_shards": _op7()}
