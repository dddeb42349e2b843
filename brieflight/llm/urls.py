"""URL filters: rules first, then link-graph propagation over hosts. DataFrame functions only.

Trust flows along host edges from hosts with allowed urls, distrust flows against them from hosts with blocked urls: two
personalised PageRanks over one edge table (kind, src, dst, weight), each with its own restart vector. Host edges are links
to other hosts in the html (absolute, protocol-relative, or relative to a `base` of another host) and, both ways, those between
a host and its parent domain, which have an owner in common; a parent with very many hosts below it hands little to each.
A page that no rule fits takes its host's verdict: block if the host's distrust is above its trust and above FACTOR times
an even share of hosts, else allow.

The ranks are run until no host's rank changes by more than NEAR times an even share in a round; after the number of rounds in
which what is still on its way is below that for certain, it ends anyway. Ranks are compared as multiples of an even share of
hosts, rounded to DIGITS digits, so the size of the web does not matter.

Defined results: a null url, or one without `://`, has empty host and path, no rule and is allowed; a null html has no
links; links of a host to itself and repeated links count once or not at all; the mass of hosts without outgoing edges is
lost, not spread; ties (equal trust and distrust) are allowed; pages that repeat are judged each; very long urls and html are
read whole; an empty table gives no rows; only page_id, url and html are read, so other columns may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, lower_ascii, saved

# Fixed values: (verdict, host, path) of the contract's rules.
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]
DAMPING, NEAR, FACTOR, DIGITS = 0.85, 0.01, 2.0, 2
#: Rounds after which the ranks are written, which cuts the lineage, and compared.
CUT = 8
HREF = r"""(?i)(?:href|src|action)[ \t\n\f\r]*=[ \t\n\f\r]*["']?(?:https?:)?//([^/?#"' \t\n\f\r<>]+)"""


def most_rounds(hosts: int) -> int:
    """Rounds after which less than NEAR of an even share of hosts is still on its way."""
    return math.ceil(math.log(max(1, hosts) / NEAR) / -math.log(DAMPING))


def host_and_path(url: str = "url"):
    """Columns for host and path."""
    at = F.instr(url, "://")
    rest = F.expr(f"substring({url}, instr({url}, '://') + 3)")
    has = F.coalesce(at > 0, F.lit(False))
    host = F.when(has, F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise("")
    path = F.when(has, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")
    return host, path


def rule_column(rules=RULES):
    """struct(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None)
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        out = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst: distinct links between different hosts."""
    host, _ = host_and_path()
    links = pages.where(F.col("html").contains("//")).select(host.alias("src"), F.array_distinct(F.regexp_extract_all("html", F.lit(HREF), 1)).alias("hosts"))
    links = links.where((F.size("hosts") > 0) & (F.col("src") != "")).select("src", F.explode("hosts").alias("dst")).select("src", lower_ascii("dst").alias("dst"))
    # a host and its parents down to two labels: a.b.c.d -> b.c.d -> c.d, and back; numeric addresses have none
    own = pages.select(host.alias("host")).where("host <> ''").distinct().where(~F.col("host").rlike(r"^[0-9.:\[\]]+$")).withColumn("labels", F.split("host", r"\."))
    at = F.explode(F.sequence(F.lit(1), F.size("labels") - 2))
    up = own.where(F.size("labels") > 2).withColumn("at", at).selectExpr("array_join(slice(labels, at, size(labels)), '.') as src", "array_join(slice(labels, at + 1, size(labels)), '.') as dst").distinct()
    return links.unionAll(up).unionAll(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src <> dst").distinct()


def propagate(edges: DataFrame, seeds: DataFrame, hosts: int, damping: float = DAMPING) -> DataFrame:
    """edges(src, dst) and seeds(host, trusted, blocked) to host, trust, distrust, as multiples of an even share of hosts."""
    out_n = edges.groupBy("src").agg(F.count("*").alias("n"))
    in_n = edges.groupBy("dst").agg(F.count("*").alias("n"))
    along = edges.join(out_n, "src").select(F.lit("trust").alias("kind"), "src", "dst", (1.0 / F.col("n")).alias("weight"))
    against = edges.join(in_n, "dst").select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), (1.0 / F.col("n")).alias("weight"))
    graph = saved(along.unionAll(against), "host-graph")
    sums = seeds.agg(F.sum("trusted").alias("t"), F.sum("blocked").alias("b")).first()
    start = seeds.select("host", F.explode(F.create_map(F.lit("trust"), F.col("trusted") / F.lit(float(max(1, sums.t or 0))), F.lit("distrust"), F.col("blocked") / F.lit(float(max(1, sums.b or 0))))).alias("kind", "score"))
    start = saved(start.where("score > 0").select("kind", "host", "score"), "host-seeds")
    again = start.select("kind", "host", (F.col("score") * (1 - damping)).alias("score"))
    rank, rounds, held = start, most_rounds(hosts), None
    for i in range(rounds):
        last = rank
        moved = graph.join(rank.select("kind", F.col("host").alias("src"), "score"), ["kind", "src"]).select("kind", F.col("dst").alias("host"), (F.col("score") * F.col("weight") * damping).alias("score"))
        rank = again.unionAll(moved).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if (i + 1) % CUT == 0:
            # both of the last two rounds from one plan: what changed in the last one
            two = last.select("kind", "host", F.lit(0.0).alias("score"), F.col("score").alias("last")).unionAll(rank.withColumn("last", F.lit(0.0)))
            rank = saved(two.groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("last").alias("last")), "host-ranks")
            if held is not None:
                forget(held)
            held = rank
            moved = rank.agg(F.max(F.abs(F.col("score") - F.col("last")))).first()[0] or 0.0
            rank = rank.select("kind", "host", "score")
            if moved <= NEAR / hosts:
                break
    of = lambda kind: F.round(F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)) * hosts, DIGITS)
    return rank.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))


def judge(pages: DataFrame, rules=RULES, factor: float = FACTOR) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust: one row per page."""
    host, path = host_and_path()
    parsed = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("fit", rule_column(rules))
    parsed = parsed.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("ruled"))
    is_ = lambda v: F.sum(F.when(F.col("ruled") == v, 1).otherwise(0))
    seeds = saved(parsed.where("host <> ''").groupBy("host").agg(is_("allow").alias("trusted"), is_("block").alias("blocked")), "url-seeds")
    hosts = max(1, seeds.count())
    rank = propagate(host_edges(pages), seeds, hosts)
    block = (F.col("distrust") > F.col("trust")) & (F.col("distrust") > factor)
    scores = rank.select("host", "trust", "distrust", F.when(block, "block").otherwise("allow").alias("of_host"))
    out = parsed.join(scores, "host", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", "of_host", F.lit("allow")).alias("verdict"), "trust", "distrust")


def op3(spark, sf_dir) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict")


def op3_sql() -> str:
    """The same in SQL, in so many rounds that nothing moves any more."""
    ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for v, h, p in ordered]
    href = HREF.replace("'", "''")
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH RECURSIVE rest AS (SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
    parts AS (SELECT page_id, html, coalesce({low.format("regexp_extract(rest, '^[^/?#]*', 0)")}, '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
    ruled AS (SELECT *, CASE {" ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits)} END AS rule, CASE {" ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits)} END AS ruled FROM parts),
    seeds AS (SELECT host, count(*) FILTER (ruled = 'allow') AS trusted, count(*) FILTER (ruled = 'block') AS blocked FROM ruled WHERE host <> '' GROUP BY host),
    names AS (SELECT DISTINCT host, string_split(host, '.') AS l FROM parts WHERE host <> '' AND NOT regexp_matches(host, '^[0-9.:\\[\\]]+$')),
    up AS (SELECT array_to_string(l[i:], '.') AS a, array_to_string(l[i + 1:], '.') AS b FROM (SELECT l, unnest(range(1, len(l) - 1)) AS i FROM names)),
    edges AS (SELECT DISTINCT src, dst FROM (SELECT host AS src, {low.format("unnest(regexp_extract_all(html, '" + href + "', 1))")} AS dst FROM parts WHERE host <> '' UNION ALL SELECT a, b FROM up UNION ALL SELECT b, a FROM up) WHERE src <> dst),
    graph AS (SELECT 'trust' AS kind, src, dst, 1.0::DOUBLE / count(*) OVER (PARTITION BY src) AS weight FROM edges
        UNION ALL SELECT 'distrust', dst, src, 1.0::DOUBLE / count(*) OVER (PARTITION BY dst) FROM edges),
    r0 AS (SELECT 'trust' AS kind, host, trusted / (SELECT greatest(1, sum(trusted))::DOUBLE FROM seeds) AS score FROM seeds WHERE trusted > 0
        UNION ALL SELECT 'distrust', host, blocked / (SELECT greatest(1, sum(blocked))::DOUBLE FROM seeds) FROM seeds WHERE blocked > 0),
    n AS (SELECT greatest(1, count(*)) AS hosts FROM seeds),
    rank(i, kind, host, score) AS (SELECT 0, kind, host, score FROM r0
        UNION ALL SELECT i, kind, host, sum(score) FROM (
            SELECT r.i + 1 AS i, r.kind, g.dst AS host, r.score * g.weight * {DAMPING} AS score FROM rank r JOIN graph g ON g.kind = r.kind AND g.src = r.host
            UNION ALL SELECT t.i + 1, r0.kind, r0.host, r0.score * (1 - {DAMPING}) FROM r0, (SELECT DISTINCT i FROM rank) t) WHERE i <= 120 GROUP BY i, kind, host),
    scores AS (SELECT host, round(coalesce(sum(score) FILTER (kind = 'trust'), 0) * any_value(hosts), {DIGITS}) AS trust, round(coalesce(sum(score) FILTER (kind = 'distrust'), 0) * any_value(hosts), {DIGITS}) AS distrust FROM rank, n WHERE i = 120 GROUP BY host)
    SELECT page_id, p.host, path, rule, coalesce(ruled, CASE WHEN distrust > trust AND distrust > {FACTOR} THEN 'block' END, 'allow') AS verdict
    FROM ruled p LEFT JOIN scores s ON p.host = s.host"""
