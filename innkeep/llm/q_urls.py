"""op7: the urls of all pages, judged by rules and by labelled path templates.

A page shows the document whose number is in its path; its label is bad if that document is toxic or of low quality.
Trees grow to any depth, which one SQL text can't follow: the twin goes down LEVELS segments, more than any path of the
driver's tables has, and fails beyond. The tests also hold the query against a plain tree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from innkeep.llm import urltree

RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]

LABELLED = "SELECT p.page_id AS id, CASE WHEN l.toxic = 1 OR l.quality = 0 THEN 1 ELSE 0 END AS bad FROM {pages} p JOIN {labels} l ON regexp_extract(p.url, '://[^/?#]*/[^/?#]*/([0-9]+)', 1) = CAST(l.doc_id AS STRING)"


def op7_url_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labelled = spark.sql(LABELLED, pages=pages, labels=labels)
    found = urltree.judge(pages, labelled, "page_id", "url", "id", "bad", RULES)
    return found.withColumnRenamed("id", "page_id")


LEVELS = 6
_LEVELS = range(LEVELS)


def _differ(l1: str, b1: str, l2: str, b2: str) -> str:
    p = f"(({b1} + {b2})::DOUBLE / ({l1} + {l2}))"
    return (
        f"CASE WHEN {l1} = 0 OR {l2} = 0 OR {b1} + {b2} = 0 OR {b1} + {b2} = {l1} + {l2} THEN FALSE "
        f"ELSE abs({b1}::DOUBLE / {l1} - {b2}::DOUBLE / {l2}) >= 1.96::DOUBLE * sqrt({p} * (1 - {p}) * (1::DOUBLE / {l1} + 1::DOUBLE / {l2})) END"
    )


def _down(i: int) -> str:
    """Paths with their templates after segment i; g: the host and the segments' names."""
    return f"""
kids{i} AS (SELECT g, segs[{i + 1}] AS child, sum(n) AS cn, sum(lab) AS cl, sum(bad) AS cb, count(*) AS paths FROM p{i} WHERE more GROUP BY ALL),
nodes{i} AS (SELECT g, count(*) AS kids, sum(cn) AS urls, sum(cl) AS lab, sum(cb) AS bad FROM kids{i} GROUP BY g),
names{i} AS (SELECT k.g, child, paths, CASE WHEN child <> '' AND kids > 12 AND cn < 0.05 * urls AND NOT {_differ('cl', 'cb', '(lab - cl)', '(bad - cb)')} THEN '<var>' ELSE child END AS name FROM kids{i} k JOIN nodes{i} o ON k.g = o.g),
p{i + 1} AS (SELECT key, segs, n, lab, bad, more, g FROM p{i} WHERE NOT more UNION ALL
  SELECT key, segs, n, lab, bad, m.child <> '' AND (paths > 1 OR name = '<var>'),
    CASE WHEN m.child = '' OR paths > 1 OR name = '<var>' THEN list_append(p.g, name) ELSE list_append(list_append(p.g, name), array_to_string(segs[{i + 2}:], '/')) END
  FROM p{i} p JOIN names{i} m ON p.g = m.g AND p.segs[{i + 1}] = m.child WHERE more)"""


def _up(d: int) -> str:
    """Branches of depth d with their families, and the nodes above them."""
    deeper = f" UNION ALL SELECT g, lab, bad, one FROM above{d}" if d <= LEVELS else ""
    return f"""
here{d} AS (SELECT *, g[:{d}] AS up, CASE WHEN one AND lab > 0 THEN bad * 1000 // lab END AS pool FROM (SELECT g, lab, bad, TRUE AS one FROM leaves WHERE len(g) = {d + 1}{deeper})),
pools{d} AS (SELECT *, row_number() OVER (PARTITION BY up ORDER BY pool) AS i FROM (SELECT up, pool, sum(lab) AS lab, sum(bad) AS bad FROM here{d} WHERE pool IS NOT NULL GROUP BY up, pool)),
walk{d}(up, i, pool, fam, lab, bad) AS (SELECT up, i, pool, 0, lab, bad FROM pools{d} WHERE i = 1 UNION ALL
  SELECT w.up, x.i, x.pool, CASE WHEN x.far THEN w.fam + 1 ELSE w.fam END, CASE WHEN x.far THEN x.lab ELSE w.lab + x.lab END, CASE WHEN x.far THEN x.bad ELSE w.bad + x.bad END
  FROM walk{d} w, LATERAL (SELECT q.*, {_differ('w.lab', 'w.bad', 'q.lab', 'q.bad')} AS far FROM pools{d} q WHERE q.up = w.up AND q.i = w.i + 1) x),
fams{d} AS (SELECT up, fam, arg_max(lab, i) AS flab, arg_max(bad, i) AS fbad FROM walk{d} GROUP BY up, fam),
branch{d} AS (SELECT b.*, f.fam, f.flab, f.fbad FROM here{d} b LEFT JOIN walk{d} w ON b.up = w.up AND b.pool = w.pool LEFT JOIN fams{d} f ON f.up = w.up AND f.fam = w.fam),
above{d - 1} AS (SELECT up AS g, sum(lab) AS lab, sum(bad) AS bad, bool_and(one) AND coalesce(max(fam), 0) = 0 AS one FROM branch{d} GROUP BY up)"""


def _share(d: int) -> str:
    """Purity of the branches of depth d."""
    return f"""
share{d} AS (SELECT b.g, coalesce(a.p, CASE WHEN NOT b.one THEN NULL WHEN b.lab > 0 THEN (fbad + 4 * a.s) / (flab + 4) ELSE a.s END) AS p, (b.bad + 4 * a.s) / (b.lab + 4) AS s FROM branch{d} b JOIN share{d - 1} a ON b.up = a.g)"""


def _fits(host: str, path: str) -> str:
    return f"(host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '{path}')"


_BY_LENGTH = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
_RULE = "CASE " + " ".join(f"WHEN {_fits(h, p)} THEN '{h}{p}'" for _, h, p in _BY_LENGTH) + " END"
_VERDICT = "CASE " + " ".join(f"WHEN {_fits(h, p)} THEN '{v}'" for v, h, p in _BY_LENGTH) + " END"
_TYPE = (
    "CASE WHEN regexp_full_match(x, '[0-9]+') THEN '<num>' WHEN regexp_full_match(x, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}') THEN '<date>' WHEN regexp_full_match(x, '[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}') THEN '<uuid>' "
    "WHEN regexp_full_match(x, '[0-9a-f]*[0-9][0-9a-f]*') THEN '<hex>' WHEN regexp_full_match(x, '[0-9]+[.][a-z0-9]{1,5}') THEN '<num>.<ext>' ELSE x END"
)
_SQL = f"""
WITH RECURSIVE u AS (SELECT page_id, strpos(url, '://') AS sep, substr(url, strpos(url, '://') + 3) AS rest FROM pages),
w AS (SELECT page_id, CASE WHEN sep > 0 THEN translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN sep > 0 THEN regexp_replace(regexp_extract(rest, '^[^?#]*'), '^[^/]*', '') ELSE '' END AS path FROM u),
b AS (SELECT id, max(bad) AS bad FROM ({LABELLED.format(pages='pages', labels='labels').replace('STRING', 'VARCHAR')}) GROUP BY id),
t AS (SELECT *, CASE WHEN rtrim(path, '/') = '' THEN [''] ELSE list_append(list_transform(string_split(substr(rtrim(path, '/'), 2), '/'), lambda x: {_TYPE}), '') END AS segs FROM w),
k AS (SELECT *, host || '/' || array_to_string(segs, '/') AS key FROM t),
p0 AS (SELECT key, any_value(segs) AS segs, count(*) AS n, count(bad) AS lab, coalesce(sum(bad), 0) AS bad, TRUE AS more, [any_value(host)] AS g FROM k LEFT JOIN b ON page_id = id GROUP BY key),
{",".join(_down(i) for i in _LEVELS)},
leaves AS (SELECT CASE WHEN more THEN error('deeper than the twin') ELSE g END AS g, sum(lab) AS lab, sum(bad) AS bad FROM p{LEVELS} GROUP BY ALL),
{",".join(_up(d) for d in range(LEVELS + 1, 0, -1))},
whole AS (SELECT (coalesce(sum(bad), 0) + 1)::DOUBLE / (coalesce(sum(lab), 0) + 2) AS s FROM above0),
share0 AS (SELECT g, (bad + 4 * s) / (lab + 4) AS s, CASE WHEN one THEN (bad + 4 * s) / (lab + 4) END AS p FROM above0, whole),
{",".join(_share(d) for d in range(1, LEVELS + 2))},
every AS ({" UNION ALL ".join(f"SELECT g, p FROM share{d}" for d in range(1, LEVELS + 2))}),
judged AS (SELECT k.page_id, k.host, k.path, '/' || regexp_replace(array_to_string(x.g[2:], '/'), '/$', '') AS template, e.p FROM k JOIN p{LEVELS} x ON k.key = x.key JOIN every e ON e.g = x.g)
SELECT page_id, host, path, {_RULE} AS rule, coalesce({_VERDICT}, CASE WHEN p > 0.5 THEN 'block' ELSE 'allow' END) AS verdict, template, round(p, 6) AS bad_share FROM judged"""

QUERIES = {"op7_url_tree": op7_url_tree}
ORACLE = {"op7_url_tree": _SQL}
