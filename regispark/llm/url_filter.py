"""URL filters: a trie over reversed host labels and path segments, longest match wins.

A rule is (verdict, host, path). It fits its host and all subdomains if the URL's path
starts with the rule's path. The trie's upper levels are host labels from the right, its
lower levels path segments; the last segment of a rule is a prefix of the URL's segment.
Of all rules that fit, the one with most host labels wins, then the longest path; of equal
rules block beats allow. The rules are a parameter of the job: the trie is broadcast after a
check of their number (``max_rules``); more rules than that are refused, never cut.

Host and path follow the given definition: the host stands after the first ``://`` up to
``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path from there up to ``?``, ``#`` or
the end; a null URL, or one without ``://``, has an empty host and path and gets the
default verdict. Long URLs cost no more than the trie is deep.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from regispark.llm.common import slices, strings

Rule = tuple[str, str, str]
RULES: list[Rule] = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def build_trie(rules: list[Rule]) -> dict:
    """Nested dictionaries. A host node maps labels to host nodes and, under "/", holds the
    path trie of the rules that end there; a path node maps whole segments to path nodes
    and, under "", lists (prefix of the next segment, path, verdict, rule), longest first."""
    root: dict = {}
    for verdict, host, path in sorted(rules, key=lambda r: r[0] != "block"):
        node = root
        for label in reversed(host.lower().split(".")) if host else []:
            node = node.setdefault(label, {})
        node = node.setdefault("/", {})
        *inner, last = path.split("/")
        for segment in inner:
            node = node.setdefault("/" + segment, {})
        ends = node.setdefault("", [])
        if all(e[1] != path for e in ends):
            ends.append((last, path, verdict, host + path))
            ends.sort(key=lambda e: -len(e[0]))
    return root


def judge(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the winning rule, or None."""
    best, node, end = None, trie, len(host)
    while True:
        if "/" in node:
            best = _along(node["/"], path) or best
        if end < 0 or not host:
            return best
        dot = host.rfind(".", 0, end)
        node = node.get(host[dot + 1 : end])
        if node is None:
            return best
        end = dot


def _along(node: dict, path: str) -> tuple[str, str] | None:
    best, at = None, 0
    while True:
        slash = path.find("/", at)
        for prefix, _, verdict, rule in node.get("", ()):
            if path.startswith(prefix, at):
                best = (rule, verdict)
                break
        if slash < 0:
            return best
        node = node.get("/" + path[at:slash])
        if node is None:
            return best
        at = slash + 1


def filter_urls(pages: DataFrame, rules: list[Rule] = RULES, default: str = "allow", max_rules: int = 1_000_000) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages`` (page_id, url)."""
    if len(rules) > max_rules:
        raise ValueError(f"{len(rules)} rules; the broadcast trie holds at most {max_rules}")
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))
    url = F.col("url").cast("string")
    after = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1)).otherwise(F.lit(None))
    rest = F.when(after.isNull(), F.lit("")).otherwise(F.substring(url, F.length(after) + 4, F.length(url)))
    parts = pages.select("page_id", rest.alias("rest")).select(
        "page_id", F.translate(F.regexp_extract("rest", "^[^/?#]*", 0), _UPPER, _UPPER.lower()).alias("host"),
        F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1).alias("path"))
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, host string, path string, rule string, verdict string"

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = trie.value
        for batch in slices(batches):
            found = [judge(root, h, p) for h, p in zip(strings(batch, "host"), strings(batch, "path"))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f and f[0] for f in found], pa.string()), pa.array([f[1] if f else default for f in found], pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"])

    return parts.mapInArrow(apply, schema)


def oracle() -> str:
    """DuckDB SQL for the default rules."""
    fits = " UNION ALL ".join(
        f"SELECT '{h}' AS h, '{p}' AS p, '{h}{p}' AS rule, '{v}' AS verdict" for v, h, p in RULES)
    return f"""
WITH r AS ({fits}),
 a AS (SELECT row_number() OVER () AS n, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
 u AS (SELECT n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_UPPER.lower()}') AS host,
              regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
 m AS (SELECT u.n, r.rule, r.verdict, row_number() OVER (PARTITION BY u.n ORDER BY length(r.h) - length(replace(r.h, '.', '')) DESC, length(r.p) DESC) AS k
       FROM u JOIN r ON (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p))
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM u LEFT JOIN m ON u.n = m.n AND m.k = 1"""
