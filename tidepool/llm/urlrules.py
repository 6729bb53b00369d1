"""URL filters: a given rule list, and association rules mined from its verdicts.

*Given rules* have a host and a path. A rule fits its host and all subdomains when
the url's path starts with the rule's; the longest fitting rule (host and path
together) decides.

*Mined rules* judge the urls that no given rule fits. A url becomes a set of tokens
(scheme, top-level domain, domain, further labels of the host, path segments, file
ending, query keys; numbers count as one token). The urls that a given rule judges
are the labelled ones. Tokens that stand in all urls or in just the same ones as another
token say nothing of their own and are left out. FP-growth mines the others' combinations
in blocked urls; each that has enough support is counted over all urls, and gives a rule
"tokens -> block" if its confidence (blocked among the labelled urls that hold the
tokens) is high enough and at least ``LABELLED`` of the urls that hold them are labelled, so
that a list which names two languages of a domain does not condemn the others. A rule is
left out if one on some of its tokens is at least as sure.

*Support and confidence* are chosen, not given: rules are mined without a third of the
hosts, and of all pairs in ``GRID`` the one that judges the labelled urls of these
hosts best is taken (F-measure that weighs precision twice as much as recall; ties: the stricter
pair). Then all urls are mined with it.

A url is blocked when a kept rule's tokens are all among its own. Each rule is filed under
its rarest token, so that common tokens call up no rules; the rules that a url's tokens call up
are compared with its set.

Urls with the same token set are judged once, so one host with many pages
costs no more than its different shapes of urls.

Cases: a null url or one without ``://`` has empty host and path, fits no given rule
and has no tokens, so it is allowed; repeated rows are judged alike; without blocked
urls nothing is mined and the rest is allowed.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Supports (blocked urls that hold the tokens, as a share of all urls) and confidences to choose from.
GRID = [(support, confidence) for support in (0.002, 0.005, 0.01, 0.02) for confidence in (0.8, 0.9, 0.95, 0.99)]
#: Share of the urls that hold a rule's tokens that must be labelled.
LABELLED = 0.4
#: Weight of recall against precision in the F-measure that chooses.
BETA = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def given(rules: list[tuple[str, str, str]], host: Column, path: Column) -> Column:
    """Struct of the longest fitting rule (host and path) and its verdict; null if none fits."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """The sorted distinct tokens of a url."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    segments = F.filter(F.split(F.regexp_replace(path, r"\.[A-Za-z0-9]{1,5}\z", ""), "/"), lambda x: x != "")
    plain = F.transform(segments, lambda x: F.when(x.rlike(r"\A[0-9]+\z"), F.lit("#")).otherwise(x))
    query = F.regexp_extract(url, r"(?s)\A[^?#]*\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})\z", 1)
    named = lambda kind, values: F.transform(values, lambda x: F.concat(F.lit(kind + ":"), x))
    beyond = F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 2, F.lit(0)))  # the domain has the others
    parts = F.concat(
        named("host", beyond), named("path", plain), named("query", keys),
        F.array(F.concat(F.lit("top:"), F.element_at(labels, -1))),
        F.array(F.concat(F.lit("domain:"), F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."))),
        F.array(F.concat(F.lit("scheme:"), F.regexp_extract(url, r"\A([A-Za-z0-9+.-]*)://", 1))),
        F.when(ending != "", F.array(F.concat(F.lit("ending:"), ending))).otherwise(F.array().cast("array<string>")),
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.sort_array(F.array_distinct(parts)))


def _telling(shapes: DataFrame) -> DataFrame:
    """``token, held`` of the tokens worth mining: not in all urls, and one of those that stand in the same ones."""
    # equal numbers of urls and equal sums of their shapes' hashes: the same urls
    rows = shapes.withColumn("_row", F.xxhash64("set").cast("decimal(38,0)") * F.col("n"))
    held = rows.select("_row", "n", F.explode("tokens").alias("token")).groupBy("token").agg(F.sum("n").alias("held"), F.sum("_row").alias("same"))
    every = shapes.agg(F.sum("n")).scalar()
    return held.where(F.col("held") < every).groupBy("same", "held").agg(F.min("token").alias("token")).select("token", "held")


def mine(judged: DataFrame, support: float, confidence: float) -> DataFrame:
    """``rule, tokens, size, rarest, confidence, support`` of the rules kept. ``judged``: tokens, verdict or null."""
    shapes = judged.where(F.size("tokens") > 0).withColumn("set", F.array_join("tokens", " ")).groupBy("set").agg(
        F.first("tokens").alias("tokens"), F.count("*").alias("n"),
        F.count_if(F.col("verdict") == "block").alias("blocked"), F.count("verdict").alias("labelled"),
    )
    shapes = common.shared_table(shapes, "url-shapes")
    total = shapes.agg(F.sum("n")).first()[0] or 1
    telling = common.shared_table(_telling(shapes), "telling-tokens")
    own = shapes.where("blocked > 0").select("set", "blocked", F.explode("tokens").alias("token")).join(telling, "token")
    own = own.groupBy("set", "blocked").agg(F.sort_array(F.collect_list("token")).alias("items"))
    own = common.shared_table(own, "blocked-urls")
    n_blocked = own.agg(F.sum("blocked")).first()[0] or 0
    # a url each: FP-growth counts rows
    rows = own.withColumn("_", F.explode(F.array_repeat(F.lit(0), F.col("blocked").cast("int")))).select("items")
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, support * total / max(n_blocked, 1)), minConfidence=1.0).fit(rows)
    found = model.freqItemsets.select(F.sort_array("items").alias("tokens"))
    named = found.select("tokens", F.explode("tokens").alias("token")).join(telling, "token")
    named = named.groupBy("tokens").agg(F.min_by("token", F.struct("held", "token")).alias("rarest"))
    named = common.shared_table(named, "url-rules")
    held = match(shapes.select("set", "tokens"), named.withColumns({"confidence": F.lit(0.0), "support": F.lit(0.0)}), "wanted")
    counted = held.join(shapes.drop("tokens"), "set").groupBy(F.col("wanted").alias("tokens")).agg(
        *[F.sum(c).alias(c) for c in ("n", "blocked", "labelled")]
    )
    counted = named.join(counted, "tokens").withColumns({
        "size": F.size("tokens"), "confidence": F.col("blocked") / F.col("labelled"), "support": F.col("blocked") / F.lit(total),
    })
    told = counted.where((F.col("support") >= support) & (F.col("labelled") >= LABELLED * F.col("n")))
    found = common.shared_table(counted.join(told.select("tokens", F.lit(True).alias("told")), "tokens", "left").withColumn("told", F.coalesce("told", F.lit(False))), "url-rules")
    # size by size: the surest of all rules on some of the tokens, handed on by the sets that lack one of them
    most = found.agg(F.max("size")).first()[0] or 0
    sure = F.when(F.col("told"), F.col("confidence")).otherwise(-1.0)
    levels = [found.where("size = 1").select("tokens", sure.alias("sure"), F.lit(-1.0).alias("surer"))]
    for size in range(2, most + 1):
        own = found.where(F.col("size") == size).select("tokens", sure.alias("sure"))
        parts = own.select("tokens", F.explode(F.transform("tokens", lambda t: F.array_remove("tokens", t))).alias("part"))
        below = levels[-1].select(F.col("tokens").alias("part"), F.greatest("sure", "surer").alias("best"))
        best = parts.join(below, "part").groupBy("tokens").agg(F.max("best").alias("surer"))
        levels.append(common.shared_table(own.join(best, "tokens"), "url-rules"))
    kept = levels[0]
    for level in levels[1:]:
        kept = kept.unionByName(level)
    kept = kept.where((F.col("sure") >= confidence) & (F.col("surer") < F.col("sure"))).select("tokens")
    return found.join(kept, "tokens").select(
        F.xxhash64("tokens").alias("rule"), "tokens", "size", "rarest", "confidence", "support"
    )


def match(token_sets: DataFrame, rules: DataFrame, *also: str) -> DataFrame:
    """``set, confidence, support`` of each token set (set, tokens) and each rule whose tokens it all holds (``wanted``)."""
    index = rules.select(F.col("rarest").alias("token"), F.col("tokens").alias("wanted"), "confidence", "support")
    called = token_sets.select("set", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    return called.where(F.size(F.array_except("wanted", "tokens")) == 0).select("set", "confidence", "support", *also)


def choose(judged: DataFrame) -> tuple[float, float]:
    """The pair of ``GRID`` that judges held-out hosts best. ``judged``: host, tokens, verdict or null."""
    held_out = F.crc32(F.col("host").cast("binary")) % 3 == 0
    judged = common.shared_table(judged.select("host", "tokens", "verdict"), "judged-urls")
    strictest = max(GRID, key=lambda g: (g[1], g[0]))
    rules = mine(judged.where(~held_out), min(s for s, _ in GRID), min(c for _, c in GRID))
    urls = judged.where(held_out & F.col("verdict").isNotNull()).select(F.array_join("tokens", " ").alias("set"), "tokens", (F.col("verdict") == "block").alias("bad"))
    hits = match(urls.select("set", "tokens").distinct(), rules)
    fires = [((F.col("support") >= s) & (F.col("confidence") >= c)) for s, c in GRID]
    fired = hits.groupBy("set").agg(*[F.bool_or(f).alias(f"g{i}") for i, f in enumerate(fires)])
    tried = urls.groupBy("set", "bad").agg(F.count("*").alias("n")).join(fired, "set", "left")
    counts = tried.agg(
        F.sum(F.when(F.col("bad"), F.col("n"))).alias("all"),
        *[F.sum(F.when(F.col(f"g{i}") & F.col("bad"), F.col("n"))).alias(f"t{i}") for i in range(len(GRID))],
        *[F.sum(F.when(F.col(f"g{i}") & ~F.col("bad"), F.col("n"))).alias(f"f{i}") for i in range(len(GRID))],
    ).first()

    def measure(i: int) -> float:
        right, wrong, all_ = counts[f"t{i}"] or 0, counts[f"f{i}"] or 0, counts["all"] or 0
        return (1 + BETA**2) * right / (right + wrong + BETA**2 * all_) if right else 0.0

    best = max(range(len(GRID)), key=lambda i: (measure(i), GRID[i][1], GRID[i][0]))
    return GRID[best] if measure(best) else strictest


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    url_col: str = "url",
    support: float | None = None,
    confidence: float | None = None,
) -> DataFrame:
    """Appends ``host, path, rule, verdict, confidence`` (of the surest mined rule, else null).

    Support and confidence are chosen on held-out hosts unless given."""
    new = ["host", "path", "rule", "verdict", "confidence"]
    url = F.col(url_col)
    rows = pages.drop(*[c for c in new if c != url_col])
    rows = rows.withColumns({"_host": host_of(url), "_path": path_of(url)})
    rows = rows.withColumns({"_given": given(rules, F.col("_host"), F.col("_path")), "_tokens": tokens_of(url, F.col("_host"), F.col("_path"))})
    judged = rows.select(F.col("_host").alias("host"), F.col("_tokens").alias("tokens"), F.col("_given.verdict").alias("verdict"))
    if support is None or confidence is None:
        chosen = choose(judged)
        support, confidence = support or chosen[0], confidence or chosen[1]
    mined = mine(judged, support, confidence)
    open_ = F.col("_given").isNull() & (F.size("_tokens") > 0)
    sets = rows.where(open_).select(F.array_join("_tokens", " ").alias("set"), F.col("_tokens").alias("tokens")).distinct()
    blocked = match(sets, mined).groupBy("set").agg(F.max("confidence").alias("confidence"))
    # only urls that the mined rules are to judge meet them
    met = rows.where(open_).withColumn("set", F.array_join("_tokens", " ")).join(blocked, "set", "left").drop("set")
    out = rows.where(~open_).withColumn("confidence", F.lit(None).cast("double")).unionByName(met)
    method = F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return out.select(
        *[c for c in pages.columns if c == url_col or c not in new],
        F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_given.rule").alias("rule"),
        F.coalesce("_given.verdict", method).alias("verdict"), "confidence",
    )
