"""URL filters: rules for hosts and paths, and beyond them the templates of each host's paths, judged by their labelled members.

A path is cut into segments. Runs of digits are one variable sign, `#`. Level by level, for each host and what stands before, a segment
that at least LEAST URLs share is a branch of its own, and all rarer ones are one wildcard, `*`. Sibling branches with enough labels
are merged when they are alike: the shares of bad URLs, and of URLs that go on below, differ by no more than Hoeffding's
bound allows (branches are pooled in BINS by their share first, then neighbouring pools are compared, so that siblings are
never compared in pairs). A merged branch is written as `{k}`. What a path has become at its end is its template.

A template is rejected when at least LEAST of its URLs are labelled and their share of bad ones, drawn towards the share of all labelled
URLs with the weight of PRIOR of them, is REJECT or more. Labels are what the rules say, or a column of one's own.

Everything is a DataFrame expression. What grows with the input is aggregated by host and shape before it is joined; the rows
themselves meet it in one join at the end, which adaptive execution may split, however hot a host is.

Defined results: a null URL, or one without `://`, has an empty host and an empty path; an empty path has the empty template; of
rules that fit, the longest (host and path together) wins, of equally long ones the first by host; segments after the first DEPTH are
one sign, `**`; a template without labels has the share of all; without any label at all nothing is rejected; repeated rows count as
often as they occur and each gets its verdict; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, release, written

DEPTH, LEAST, PRIOR, REJECT, BINS, ALPHA = 8, 8, 4, 0.9, 10, 0.05
#: Hoeffding: two shares of n and m observations are alike when they differ by at most BOUND * (1 / sqrt(n) + 1 / sqrt(m)).
BOUND = (0.5 * log(2 / ALPHA)) ** 0.5
#: Rules are part of the plan, so their number is bounded.
MAX_RULES = 1000
#: The rules of the query: (verdict, host, path).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(F.substring(rest, F.length(host) + F.lit(1), F.length(rest)), "^[^?#]*", 0)


def _ordered(rules):
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    return sorted(rules, key=lambda r: (-len(r[1]) - len(r[2]), r[1]))


def _fits(host: Column, path: Column, rule) -> Column:
    return ((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2])


def by_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    pick = [F.when(_fits(host, path, r), F.struct(F.lit(r[1] + r[2]).alias("rule"), F.lit(r[0]).alias("verdict"))) for r in _ordered(rules)]
    best = F.coalesce(*pick) if pick else F.lit(None).cast("struct<rule:string,verdict:string>")
    return best["rule"], best["verdict"]


def shape(path: Column) -> Column:
    """The path with signs for runs of digits and for what lies deeper than DEPTH."""
    parts = F.split(F.regexp_replace(path, "[0-9]+", "#"), "/")
    return F.concat_ws("/", F.when(F.size(parts) > DEPTH + 1, F.concat(F.slice(parts, 1, DEPTH + 1), F.array(F.lit("**")))).otherwise(parts))


def _alike(a: Column, n: Column, b: Column, m: Column) -> Column:
    over = lambda x, y: F.try_divide(x.cast("double"), y.cast("double"))
    one = F.lit(1.0)
    return F.abs(over(a, n) - over(b, m)) <= F.lit(BOUND) * (over(one, F.sqrt(n)) + over(one, F.sqrt(m)))


def _signs(branches: DataFrame) -> DataFrame:
    """(host, before, part, sign) of the branches that stand; branches: (host, before, part, n, on, bad, known)."""
    stand = branches.filter((F.col("n") >= LEAST) | F.col("part").isin("", "**"))
    rated = stand.withColumn("bin", F.when(F.col("known") >= LEAST, F.least(F.floor(F.col("bad") * BINS / F.col("known")), F.lit(BINS - 1))))
    pools = rated.filter("bin is not null").groupBy("host", "before", "bin").agg(*(F.sum(c).alias(f"pool_{c}") for c in ("n", "on", "bad", "known")), F.count("*").alias("members"))
    w = Window.partitionBy("host", "before").orderBy("bin")  # BINS rows at most
    last = {c: F.lag(f"pool_{c}").over(w) for c in ("n", "on", "bad", "known")}
    new = ~(_alike(F.col("pool_bad"), F.col("pool_known"), last["bad"], last["known"]) & _alike(F.col("pool_on"), F.col("pool_n"), last["on"], last["n"]))
    pools = pools.withColumn("new", F.coalesce(new, F.lit(True)).cast("int")).withColumn("k", F.sum("new").over(w))
    pools = pools.withColumn("all", F.sum("members").over(Window.partitionBy("host", "before", "k")))
    near = rated.join(pools.withColumnsRenamed({"host": "h", "before": "p", "bin": "q"}), (F.col("host") == F.col("h")) & (F.col("before") == F.col("p")) & (F.col("bin") == F.col("q")), "left")
    merged = (F.col("all") > 1) & _alike(F.col("bad"), F.col("known"), F.col("pool_bad"), F.col("pool_known")) & _alike(F.col("on"), F.col("n"), F.col("pool_on"), F.col("pool_n"))
    return near.select("host", "before", "part", F.when(merged, F.concat(F.lit("{"), F.col("k").cast("string"), F.lit("}"))).otherwise(F.col("part")).alias("sign"))


def templates(urls: DataFrame, tag: str = "") -> DataFrame:
    """(host, shape, template, known, purity, reject) of every shape; urls: (host, path, bad), bad null where there is no label."""
    known = F.col("bad").isNotNull()
    shapes = urls.groupBy("host", shape(F.col("path")).alias("shape")).agg(F.count("*").alias("n"), F.sum(F.coalesce(F.col("bad").cast("long"), F.lit(0))).alias("bad"), F.sum(known.cast("long")).alias("known"))
    nodes = written(shapes.withColumn("before", F.lit("")), "shapes", tag)
    whole = nodes.agg(F.max(F.size(F.split("shape", "/"))).alias("depth"), F.sum("bad").alias("bad"), F.sum("known").alias("known")).first()
    for k in range(1, whole.depth or 0):
        cut = nodes.withColumn("parts", F.split("shape", "/")).withColumn("part", F.get("parts", F.lit(k)))
        goes_on = F.when(F.size("parts") > k + 1, F.col("n")).otherwise(0)
        branches = cut.filter("part is not null").groupBy("host", "before", "part").agg(F.sum("n").alias("n"), F.sum(goes_on).alias("on"), F.sum("bad").alias("bad"), F.sum("known").alias("known"))
        joined = cut.join(_signs(branches), ["host", "before", "part"], "left")
        step = F.concat("before", F.lit("/"), F.coalesce("sign", F.lit("*")))
        nodes = written(joined.select("host", "shape", "n", "bad", "known", F.when(F.col("part").isNull(), F.col("before")).otherwise(step).alias("before")), f"level{k}", tag)
    sums = nodes.groupBy("host", F.col("before").alias("template")).agg(F.sum("bad").alias("bad"), F.sum("known").alias("known"))
    base = (whole.bad or 0) / whole.known if whole.known else 0.0
    purity = (F.col("bad") + PRIOR * base) / (F.col("known") + PRIOR)
    judged = sums.select(F.col("host").alias("h"), "template", "known", purity.alias("purity"), ((F.col("known") >= LEAST) & (purity >= REJECT)).alias("reject"))
    mine = nodes.select("host", "shape", "before").join(judged, (F.col("host") == F.col("h")) & (F.col("before") == F.col("template")))
    return written(mine.select("host", "shape", "template", "known", "purity", "reject"), "templates", tag)


def judge(urls: DataFrame, rules: list[tuple[str, str, str]] = RULES, key: str = "page_id", url: str = "url", bad: Column | None = None, tag: str = "urls") -> DataFrame:
    """(key, host, path, rule, verdict, template, purity) of every row. bad: labels of one's own (true for bad, null for none) in
    place of what the rules say."""
    release(urls.sparkSession, tag)
    host, path = host_and_path(F.col(url))
    rows = urls.select(F.col(key), host.alias("host"), path.alias("path"), *([] if bad is None else [bad.alias("bad")]))
    rule, verdict = by_rule(F.col("host"), F.col("path"), rules)
    found = templates(rows.select("host", "path", (verdict == "block" if bad is None else F.col("bad")).alias("bad")), tag)
    found = found.withColumnsRenamed({"host": "h", "shape": "s"})
    rows = rows.select(key, "host", "path", rule.alias("rule"), verdict.alias("said"), shape(F.col("path")).alias("shape"))
    out = rows.join(found, (F.col("host") == F.col("h")) & (F.col("shape") == F.col("s")), "left")
    return out.select(key, "host", "path", "rule", F.coalesce("said", F.when(F.col("reject"), "block").otherwise("allow")).alias("verdict"), "template", F.round("purity", 6).alias("purity"))


def _sql_alike(a, n, b, m):
    return f"abs({a} / {n} - {b} / {m}) <= {BOUND!r} * (1 / sqrt({n}) + 1 / sqrt({m}))"


def oracle(rules: list[tuple[str, str, str]] = RULES) -> str:
    """The same levels as SQL, DEPTH + 1 of them."""
    rule = " ".join(f"WHEN (host = '{h}' OR suffix(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v} {h}{p}'" for v, h, p in _ordered(rules))
    ctes = [f"""r AS (SELECT page_id, coalesce(CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END, '') AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r),
u AS (SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host, regexp_extract(substring(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
s AS (SELECT *, CASE {rule} END AS hit, string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/') AS ps FROM u),
rows_ AS MATERIALIZED (SELECT page_id, host, path, hit, CASE WHEN len(ps) > {DEPTH + 1} THEN array_to_string(ps[:{DEPTH + 1}], '/') || '/**' ELSE array_to_string(ps, '/') END AS shape FROM s),
n0 AS MATERIALIZED (SELECT host, shape, string_split(shape, '/') AS parts, count(*) AS m, count(*) FILTER (hit LIKE 'block%') AS bad, count(hit) AS known, '' AS before FROM rows_ GROUP BY ALL)"""]
    for k in range(1, DEPTH + 2):
        on = f"sum(CASE WHEN len(parts) > {k + 1} THEN m ELSE 0 END)"
        ctes.append(f"""b{k} AS MATERIALIZED (SELECT host, before, parts[{k + 1}] AS part, sum(m) AS m, {on} AS run, sum(bad) AS bad, sum(known) AS known FROM n{k - 1} WHERE len(parts) > {k} GROUP BY host, before, parts[{k + 1}]
  HAVING sum(m) >= {LEAST} OR parts[{k + 1}] IN ('', '**')),
t{k} AS MATERIALIZED (SELECT *, CASE WHEN known >= {LEAST} THEN least(bad * {BINS} // known, {BINS - 1}) END AS bin FROM b{k}),
p{k} AS (SELECT host, before, bin, sum(m) AS m, sum(run) AS run, sum(bad) AS bad, sum(known) AS known, count(*) AS members FROM t{k} WHERE bin IS NOT NULL GROUP BY host, before, bin),
q{k} AS (SELECT *, CASE WHEN {_sql_alike('bad', 'known', 'lag(bad) OVER w', 'lag(known) OVER w')} AND {_sql_alike('run', 'm', 'lag(run) OVER w', 'lag(m) OVER w')} THEN 0 ELSE 1 END AS fresh
  FROM p{k} WINDOW w AS (PARTITION BY host, before ORDER BY bin)),
c{k} AS (SELECT *, sum(fresh) OVER (PARTITION BY host, before ORDER BY bin) AS k FROM q{k}),
d{k} AS (SELECT *, sum(members) OVER (PARTITION BY host, before, k) AS together FROM c{k}),
g{k} AS MATERIALIZED (SELECT t.host, t.before, t.part, CASE WHEN together > 1 AND {_sql_alike('t.bad', 't.known', 'd.bad', 'd.known')} AND {_sql_alike('t.run', 't.m', 'd.run', 'd.m')}
  THEN '{{' || k || '}}' ELSE part END AS sign FROM t{k} t LEFT JOIN d{k} d ON d.host = t.host AND d.before = t.before AND d.bin = t.bin),
n{k} AS MATERIALIZED (SELECT o.host, shape, parts, m, bad, known, CASE WHEN len(parts) > {k} THEN o.before || '/' || coalesce(sign, '*') ELSE o.before END AS before
  FROM n{k - 1} o LEFT JOIN g{k} g ON g.host = o.host AND g.before = o.before AND g.part = o.parts[{k + 1}])""")
    return "WITH " + ",\n".join(ctes) + f""",
base AS (SELECT coalesce(sum(bad) / nullif(sum(known), 0), 0) AS share FROM n0),
j AS (SELECT host, before, sum(known) AS known, (sum(bad) + {PRIOR} * any_value(share)) / (sum(known) + {PRIOR}) AS purity FROM n{DEPTH + 1}, base GROUP BY host, before)
SELECT page_id, r.host, path, substring(hit, 7) AS rule, CASE WHEN hit IS NOT NULL THEN left(hit, 5) WHEN j.known >= {LEAST} AND purity >= {REJECT} THEN 'block' ELSE 'allow' END AS verdict,
 n.before AS template, round(purity, 6) AS purity
FROM rows_ r JOIN n{DEPTH + 1} n ON n.host = r.host AND n.shape = r.shape JOIN j ON j.host = n.host AND j.before = n.before
"""
