"""URL filter by a tree of path templates, with DataFrame functions only.

Each host's paths form a tree of segments. Segments that are numbers, dates, hex strings or UUIDs become wildcards at
once. Then, from the root down, below a node with more than MAX_CHILDREN children, those with a share under RARE of its
urls become one wildcard, except children whose share of bad labels differs from that of all their siblings. A branch goes
down while it holds more than one path; what is left of a single path is one segment.

From the leaves up, siblings are merged into families where their shares of bad labels don't differ: in the order of their
shares, each is tested against the pooled labels of the family it would join (two-proportion z below Z). Siblings whose
shares agree to three places are pooled first, so a node has at most 1,001 pools to go through. A node whose children are
all of one family is one branch, which can merge with its own siblings in turn; branches without labels join nobody.

A family's purity is its share of bad labels, smoothed by PRIOR pseudo-labels of the node above it; that node's share is
smoothed by the node above in the same way, up to the whole. Branches without labels get the share of the node above. A
template is rejected if this exceeds LIMIT. Rules come first: of those that fit a url, the longest decides.

Everything but the first and the last step works on counts per (host, typed path). Joins deal hot keys over several tasks.

Defined results: a null url or one without :// has an empty host and path, and is judged like any other template;
trailing slashes are ignored; labels that are null are no labels; of repeated labels of an id the worst counts, for every
row with that id; hosts without labels get the prior; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeep.llm import skew, store

MAX_CHILDREN = 12
RARE = 0.05
Z = 1.96
PRIOR = 4.0
LIMIT = 0.5

#: Segments that become wildcards at once.
KINDS = {
    "^[0-9]+$": "<num>",
    "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$": "<date>",
    "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$": "<uuid>",
    "^[0-9a-f]*[0-9][0-9a-f]*$": "<hex>",
    "^[0-9]+[.][a-z0-9]{1,5}$": "<num>.<ext>",
}
VARIABLE = "<var>"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def _typed(x: Column) -> Column:
    out = x
    for pattern, kind in reversed(KINDS.items()):
        out = F.when(x.rlike(pattern), kind).otherwise(out)
    return out


def _parsed(urls: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """id, host, path and typed: the typed segments, which end with an empty one."""
    url = F.col(url_col).cast("string")
    host = F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit(""))
    out = urls.select(F.col(id_col).alias("id"), F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"), F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit("")).alias("path"))
    bare = F.regexp_replace("path", "/+$", "")
    segments = F.when(bare == "", F.array(F.lit(""))).otherwise(F.concat(F.transform(F.split(F.substr(bare, F.lit(2)), "/", -1), _typed), F.array(F.lit(""))))
    return out.withColumn("typed", segments)


def differ(lab1: Column, bad1: Column, lab2: Column, bad2: Column) -> Column:
    """Whether two shares of bad labels differ; never, if one side has no labels."""
    some = (lab1 > 0) & (lab2 > 0)
    p = (bad1 + bad2).cast("double") / F.greatest(lab1 + lab2, F.lit(1))
    error = F.sqrt(F.greatest(p * (1 - p), F.lit(0.0)) * (F.lit(1.0) / F.greatest(lab1, F.lit(1)) + F.lit(1.0) / F.greatest(lab2, F.lit(1))))
    gap = F.abs(bad1.cast("double") / F.greatest(lab1, F.lit(1)) - bad2.cast("double") / F.greatest(lab2, F.lit(1)))
    return some & (error > 0) & (gap >= Z * error)


def _templates(paths: DataFrame) -> DataFrame:
    """Adds g, the template: an array of the host and segments. paths: host, typed (array), key, n, lab, bad; a row per path."""
    now = paths.withColumn("g", F.array("host"))
    done: list[DataFrame] = []
    level = 0
    while not now.isEmpty():
        now = now.withColumn("child", F.get("typed", F.lit(level)))
        kids = store.cut(now.groupBy("g", "child").agg(F.sum("n").alias("cn"), F.sum("lab").alias("clab"), F.sum("bad").alias("cbad"), F.count("*").alias("paths")), "url-kids")
        nodes = store.cut(kids.groupBy("g").agg(F.count("*").alias("n"), F.sum("cn").alias("urls"), F.sum("clab").alias("lab"), F.sum("cbad").alias("bad")), "url-nodes")
        met = skew.spread_join(kids, nodes.withColumnRenamed("n", "kids"), ["g"], F.xxhash64("child"), nodes.select("g", "n"))
        odd = differ(F.col("clab"), F.col("cbad"), F.col("lab") - F.col("clab"), F.col("bad") - F.col("cbad"))
        rare = (F.col("child") != "") & (F.col("kids") > MAX_CHILDREN) & (F.col("cn") < RARE * F.col("urls")) & ~odd
        named = met.select("g", "child", F.when(rare, VARIABLE).otherwise(F.col("child")).alias("name"), "paths")
        named = skew.spread_join(now, named, ["g", "child"], F.xxhash64("key"), kids.select("g", "child", F.col("paths").alias("n")))
        rest = F.array_join(F.slice("typed", level + 2, F.greatest(F.size("typed") - level - 1, F.lit(0))), "/")
        ended = F.col("child") == ""
        more = ~ended & ((F.col("paths") > 1) | (F.col("name") == VARIABLE))
        g = F.concat("g", F.array("name"))
        g = F.when(more | ended, g).otherwise(F.concat(g, F.array(rest)))
        named = store.cut(named.select("host", "typed", "key", "n", "lab", "bad", g.alias("g"), more.alias("more")), "url-level")
        done.append(named.where("not more").drop("more"))
        now = named.where("more").drop("more")
        level += 1
    return reduce(DataFrame.unionByName, done) if done else now


def _families(siblings: DataFrame) -> DataFrame:
    """up, pool, fam, flab, fbad: the families of the labelled branches below each node. siblings: up, lab, bad, pool."""
    pools = siblings.groupBy("up", "pool").agg(F.sum("lab").alias("lab"), F.sum("bad").alias("bad"))
    listed = pools.groupBy("up").agg(F.array_sort(F.collect_list(F.struct("pool", "lab", "bad"))).alias("pools"))  # at most 1,001
    none = F.expr("named_struct('fam', 0, 'lab', 0L, 'bad', 0L, 'out', cast(array() as array<struct<pool:int,fam:int>>))")

    def step(acc: Column, x: Column) -> Column:
        apart = differ(acc["lab"], acc["bad"], x["lab"], x["bad"])
        fam = F.when(apart, acc["fam"] + 1).otherwise(acc["fam"])
        lab = F.when(apart, x["lab"]).otherwise(acc["lab"] + x["lab"])
        bad = F.when(apart, x["bad"]).otherwise(acc["bad"] + x["bad"])
        return F.struct(fam.alias("fam"), lab.alias("lab"), bad.alias("bad"), F.concat(acc["out"], F.array(F.struct(x["pool"].alias("pool"), fam.alias("fam")))).alias("out"))

    of_pool = listed.select("up", F.inline(F.aggregate("pools", none, step)["out"]))
    joined = pools.join(of_pool, ["up", "pool"])
    sums = joined.groupBy("up", "fam").agg(F.sum("lab").alias("flab"), F.sum("bad").alias("fbad"))
    return joined.select("up", "pool", "fam").join(sums, ["up", "fam"])


def _purity(leaves: DataFrame) -> DataFrame:
    """g and p, the smoothed share of bad labels of each template. leaves: g, lab, bad."""
    depth = (leaves.agg(F.max(F.size("g"))).first()[0] or 1) - 1
    levels: dict[int, DataFrame] = {}
    upward: DataFrame | None = None
    for d in range(depth, 0, -1):
        here = leaves.where(F.size("g") == d + 1).select("g", "lab", "bad", F.lit(True).alias("one"))
        here = here if upward is None else here.unionByName(upward)
        here = here.withColumn("up", F.slice("g", 1, d)).withColumn("pool", F.when(F.col("one") & (F.col("lab") > 0), F.floor(F.col("bad") * 1000 / F.col("lab")).cast("int")))
        here = store.cut(here.join(_families(here.where("pool is not null")), ["up", "pool"], "left"), "url-branches")
        levels[d] = here
        upward = here.groupBy(F.col("up").alias("g")).agg(F.sum("lab").alias("lab"), F.sum("bad").alias("bad"), (F.every("one") & (F.coalesce(F.max("fam"), F.lit(0)) == 0)).alias("one"))
    upward = store.cut(upward, "url-hosts")
    whole = upward.agg((F.coalesce(F.sum("bad"), F.lit(0)) + 1.0).alias("b"), (F.coalesce(F.sum("lab"), F.lit(0)) + 2.0).alias("l")).first()
    smooth = lambda bad, lab, above: (bad + F.lit(PRIOR) * above) / (lab + F.lit(PRIOR))
    above = upward.withColumn("s", smooth(F.col("bad"), F.col("lab"), F.lit(whole["b"] / whole["l"])))
    above = above.select(F.col("g").alias("up"), F.col("s").alias("s0"), F.when(F.col("one"), F.col("s")).alias("p0"))
    out = []
    for d in range(1, depth + 1):
        met = levels[d].join(above, "up")
        own = F.when(~F.col("one"), None).when(F.col("lab") > 0, smooth(F.col("fbad"), F.col("flab"), F.col("s0"))).otherwise(F.col("s0"))
        found = store.cut(met.select("g", F.coalesce("p0", own).alias("p"), smooth(F.col("bad"), F.col("lab"), F.col("s0")).alias("s")), "url-shares")
        out.append(found.select("g", "p"))
        above = found.select(F.col("g").alias("up"), F.col("s").alias("s0"), F.col("p").alias("p0"))
    return leaves.select("g").join(reduce(DataFrame.unionByName, out), "g")


def _rule(rules: list[tuple[str, str, str]], value) -> Column:
    """value(rule) of the longest rule that fits (null if none does)."""
    out = F.lit(None).cast("string")
    host, path = F.col("host"), F.col("path")
    for rule in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2])
        out = F.when(fits, F.lit(value(rule))).otherwise(out)
    return out


def judge(urls: DataFrame, labels: DataFrame, id_col: str, url_col: str, label_id: str, bad_col: str, rules: list[tuple[str, str, str]]) -> DataFrame:
    """id, host, path, rule, verdict, template and bad_share for every url; rules: (verdict, host, path)."""
    spark = urls.sparkSession
    with store.scratch(spark) as own:
        rows = _parsed(urls, id_col, url_col)
        bad = labels.select(F.col(label_id).alias("id"), F.col(bad_col).cast("int").alias("bad")).where("bad is not null and id is not null").groupBy("id").agg(F.max("bad").alias("bad"))
        typed = rows.where("id is not null").join(bad, "id", "left").unionByName(rows.where("id is null").withColumn("bad", F.lit(None).cast("int"))).withColumn("key", F.concat("host", F.lit("/"), F.array_join("typed", "/")))
        typed = store.cut(typed, "url-rows")
        paths = typed.groupBy("key").agg(F.first("host").alias("host"), F.first("typed").alias("typed"), F.count("*").alias("n"), F.count("bad").alias("lab"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        paths = store.cut(paths, "url-paths")
        placed = store.cut(_templates(paths), "url-templates")
        if placed.isEmpty():
            return own.keep(typed.select("id", "host", "path", *[F.lit(None).cast("string").alias(c) for c in ("rule", "verdict", "template")], F.lit(0.0).alias("bad_share")), "urls")
        shares = _purity(store.cut(placed.groupBy("g").agg(F.sum("lab").alias("lab"), F.sum("bad").alias("bad")), "url-leaves"))
        template = F.concat(F.lit("/"), F.regexp_replace(F.array_join(F.slice("g", 2, F.size("g") - 1), "/"), "/$", ""))
        judged = skew.spread_join(placed.select("g", "key"), shares, ["g"], F.xxhash64("key")).select("key", template.alias("template"), "p")
        out = skew.spread_join(typed.select("id", "host", "path", "key"), judged, ["key"], F.xxhash64("id", "path"), paths.select("key", "n"))
        verdict = F.coalesce(_rule(rules, lambda r: r[0]), F.when(F.col("p") > LIMIT, "block").otherwise("allow"))
        out = out.select("id", "host", "path", _rule(rules, lambda r: r[1] + r[2]).alias("rule"), verdict.alias("verdict"), "template", F.round("p", 6).alias("bad_share"))
        return own.keep(out, "urls")
