"""URL filters: path rules, and link-graph propagation for what no rule decides.

Trust spreads from hosts with allowed pages along links; distrust spreads
against links from hosts whose pages are mostly blocked: what links to them is
suspect.  Both are personalised PageRank over the graph of hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shared, lower_ascii

#: (verdict, host, path); a fixed list.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*([a-z][a-z0-9+.-]*://[^"'>\s]*|//[^"'>\s]*)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without one."""
    rest = F.when(F.contains(url, F.lit("://")), F.substring(url, F.locate("://", url) + 3, F.length(url)))
    return F.coalesce(lower_ascii(F.regexp_extract(rest, r"\A([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    rest = F.when(F.contains(url, F.lit("://")), F.substring(url, F.locate("://", url) + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits as a struct (rule, verdict), else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def propagate(shared: Shared, hosts: DataFrame, edges: DataFrame, damping: float = 0.85, rounds: int = 12, keep_every: int = 4, tolerance: float | None = None, hub_rows: int = 1_000_000) -> DataFrame:
    """Personalised PageRank of trust along edges and of distrust against them.

    ``hosts``: host, trust_seed, distrust_seed (weights of at least 0);
    ``edges``: src, dst, weight.  Returns host, trust, distrust, each summing
    to 1 at most; mass that reaches a host without edges out is lost, which
    changes no comparison of two hosts.  Tables are written every few rounds,
    which bounds the plan and the work that a lost executor costs.  With a
    ``tolerance`` the rounds end once no mass changes by more between two such tables; if it does after all ``rounds``, that is an error.
    A host of more than ``hub_rows`` edges is dealt over several tasks; such hosts, of which there are at most
    edges / hub_rows, are broadcast.
    """
    both = F.explode(F.array(F.struct(F.lit("trust").alias("kind"), F.col("src").alias("at"), F.col("dst").alias("to")), F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("at"), F.col("src").alias("to"))))
    steps = edges.select(both.alias("e"), "weight").select("e.*", "weight")
    out = shared.keep(steps.groupBy("kind", "at").agg(F.sum("weight").alias("out"), F.ceil(F.count("*") / hub_rows).cast("int").alias("parts")), "out")
    hubs = F.broadcast(out.filter("parts > 1").select("kind", "at", "parts"))
    part = F.coalesce(F.pmod(F.xxhash64("to"), F.col("parts")).cast("int"), F.lit(0)).alias("part")
    split = lambda df: df.join(hubs, ["kind", "at"], "left").select(*df.columns, F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
    dealt = steps.join(hubs, ["kind", "at"], "left").select("kind", "at", "to", "weight", part)
    steps = shared.keep(dealt.join(split(out.select("kind", "at", "out")), ["kind", "at", "part"]).select("kind", "at", "part", "to", (F.col("weight") / F.col("out")).alias("share")), "steps")
    seeds = hosts.select(F.col("host").alias("at"), F.explode(F.array(F.struct(F.lit("trust").alias("kind"), F.col("trust_seed").alias("seed")), F.struct(F.lit("distrust").alias("kind"), F.col("distrust_seed").alias("seed")))).alias("s")).select("at", "s.*").filter("seed > 0")
    totals = seeds.groupBy("kind").agg(F.sum("seed").alias("total"))
    seeds = shared.keep(seeds.join(totals, "kind").select("kind", "at", (F.col("seed") / F.col("total")).alias("mass")), "seeds")
    rank = last = seeds
    for k in range(1, rounds + 1):
        sent = split(rank).join(steps, ["kind", "at", "part"]).select("kind", F.col("to").alias("at"), (F.col("mass") * F.col("share") * damping).alias("mass"))
        rank = sent.unionByName(seeds.withColumn("mass", F.col("mass") * (1 - damping))).groupBy("kind", "at").agg(F.sum("mass").alias("mass"))
        if k % keep_every == 0:
            rank = shared.keep(rank, f"rank{k}")
            if tolerance is not None:
                moved = rank.unionByName(last.withColumn("mass", -F.col("mass"))).groupBy("kind", "at").agg(F.abs(F.sum("mass")).alias("moved")).agg(F.max("moved").alias("most"))
                if (moved.collect()[0]["most"] or 0.0) <= tolerance:
                    break
                last = rank
    else:
        if tolerance is not None:
            raise ValueError(f"masses still move after {rounds} rounds")
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0.0)).alias(kind)
    return rank.groupBy(F.col("at").alias("host")).agg(of("trust"), of("distrust"))


def judge_urls(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES, damping: float = 0.85, rounds: int = 10_000, least: float = 1e-9) -> DataFrame:
    """One row for each page: page_id, host, path, rule, verdict.

    A rule decides where one fits.  Else the host decides: it is blocked when
    it has distrust, more than ``least`` of an even share, and no less of it than trust; both are
    propagated until they change by a hundredth of that at most.  Seeds: a host's allowed pages give it
    trust unless any of its pages is blocked; hosts with at least half their
    pages blocked have distrust.  Links that name a host count once for each
    pair of page and host; relative links stay in their host and carry nothing.  A null
    url, or one without ``://``, has empty host and path and is allowed.  Rows
    repeat as given (each counts as a page) whatever their id, null too; an empty table gives no rows; a null html has no
    links, one of any length is searched whole; other columns are not read.
    """
    shared = Shared(spark, "urls")
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), F.col(html_col).cast("string").alias("html"))
    links = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lambda u: host_of(F.when(F.startswith(u, F.lit("//")), F.concat(F.lit("http:"), u)).otherwise(u))))
    rows = rows.select("page_id", "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("r"), F.filter(links, lambda h: (h != "") & (h != F.col("host"))).alias("links"))
    rows = shared.keep(rows.select("page_id", "host", "path", "r.rule", F.col("r.verdict").alias("ruled"), "links"), "pages")
    named = rows.filter("host <> ''")
    edges = shared.keep(named.select("host", F.explode("links").alias("dst")).groupBy(F.col("host").alias("src"), "dst").agg(F.count("*").cast("double").alias("weight")), "edges")
    of = lambda v: F.sum(F.when(F.col("ruled") == v, 1.0).otherwise(0.0)).alias(v)
    hosts = named.groupBy("host").agg(F.count("*").alias("n"), of("allow"), of("block"))
    hosts = shared.keep(hosts.select("host", F.when(F.col("block") == 0, F.col("allow")).otherwise(0.0).alias("trust_seed"), F.when(2 * F.col("block") >= F.col("n"), F.col("block")).otherwise(0.0).alias("distrust_seed")), "hosts")
    least /= max(1, hosts.count())
    ranks = propagate(shared, hosts, edges, damping, rounds, tolerance=least / 100)
    bad = ranks.filter((F.col("distrust") > least) & (F.col("distrust") >= F.col("trust"))).select(F.col("host").alias("bad_host"))
    judged = rows.join(bad, F.col("host") == F.col("bad_host"), "left")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("bad_host").isNotNull(), "block").otherwise("allow")).alias("verdict"))
