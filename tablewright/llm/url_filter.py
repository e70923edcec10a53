"""URL filter: fixed rules first, then the reputation of the host, learned from labelled pages.

Each host has k bad outcomes among n labelled pages. A beta prior, estimated from the data, passes from all hosts to
the suffix, from there to the registered domain and on to the host, so that a host with few labels is judged mostly
by its domain. A host is blocked if the lower posterior bound of its bad rate is above a limit.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import LOWER, UPPER, cut

# fixed values: public suffixes of two labels that are common, for use without a list; others count as one label
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp",
                 "co.nz", "co.in", "com.br", "com.cn", "com.mx", "com.tr", "co.kr", "co.za")
MAX_BAD = 0.5      # blocked if the bad rate is above this ...
DEVIATIONS = 1.64  # ... by so many standard deviations of the posterior
LEVELS = (("suffix", None), ("domain", "suffix"), ("server", "domain"))


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty without `://`."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule (host, path, verdict) for this host or a domain above it whose path begins the url's."""
    found = [
        F.when(
            ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
            F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for h, p, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    ]
    return F.coalesce(*found, F.lit(None).cast("struct<rule: string, verdict: string>"))


def host_levels(host: Column, suffixes: Iterable[str] = LONG_SUFFIXES) -> dict[str, Column]:
    """Server (no user, no port), registered domain and suffix; addresses of digits are their own domain.

    `suffixes` are public suffixes in lower case as lists of them are written: `co.uk`, `*.ck` (any label before ck),
    `!www.ck` (none, in spite of that). The longest that a server ends in counts, with a label before it; the last label
    is a suffix always.
    """
    server = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    labels = F.size(F.split(server, r"\."))
    kinds: dict[str, dict[int, list[str]]] = {"plain": {}, "any": {}, "none": {}}
    for entry in sorted(set(suffixes)):
        kind = {"*": "any", "!": "none"}.get(entry[:1], "plain")
        kinds[kind].setdefault(entry.count(".") + 1, []).append(entry.lstrip("*!").lstrip("."))
    longest = max((n for own in kinds.values() for n in own), default=1)
    suffix, domain = F.substring_index(server, ".", -1), F.substring_index(server, ".", -2)
    for n in range(2, longest + 1):
        end = F.substring_index(server, ".", -n)
        fits = [end.isin(*kinds["plain"][n])] if n in kinds["plain"] else []
        if n in kinds["any"]:
            fits.append(F.substring_index(server, ".", 1 - n).isin(*kinds["any"][n]))
        if not fits:
            continue
        fit = reduce(lambda a, b: a | b, fits)
        if n in kinds["none"]:
            fit = fit & ~end.isin(*kinds["none"][n])
        fit = fit & (labels > n)
        suffix = F.when(fit, end).otherwise(suffix)
        domain = F.when(fit, F.substring_index(server, ".", -n - 1)).otherwise(domain)
    digits = F.regexp_extract(server, r"^[0-9.]+$", 0) != ""
    return {"server": server, "domain": F.when(digits, server).otherwise(domain),
            "suffix": F.when(digits, F.lit("")).otherwise(suffix)}


def read_suffixes(spark: SparkSession, path: str) -> list[str]:
    """The entries of a list of public suffixes: one a line, up to the first blank; `//` begins a comment."""
    entry = F.lower(F.regexp_extract("value", r"^\s*(\S+)", 1))
    listed = spark.read.text(path).select(entry.alias("entry")).filter("entry <> '' AND NOT startswith(entry, '//')")
    return [r.entry for r in listed.distinct().orderBy("entry").collect()]


def host_reputation(pages: DataFrame, outcomes: DataFrame, suffixes: Iterable[str] = LONG_SUFFIXES) -> DataFrame:
    """host, n, k, rate and bound (the lower posterior bound) of every host of `pages`.

    `pages` has host and key, `outcomes` key and bad (0 or 1; the worst counts if a key repeats). Null keys match
    nothing; pages that repeat count as often as they occur. A hot host is only counts when it is shuffled.
    """
    worst = outcomes.filter("key IS NOT NULL AND bad IS NOT NULL").groupBy("key").agg(F.max("bad").alias("bad"))
    pairs = pages.groupBy("host", "key").agg(F.count(F.lit(1)).alias("pages"))
    hosts = pairs.join(worst, "key", "left").groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("bad").isNotNull(), F.col("pages"))), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.col("bad") * F.col("pages")), F.lit(0)).alias("k"))
    rated = cut(hosts.select("*", *[c.alias(x) for x, c in host_levels(F.col("host"), suffixes).items()]), "hosts")

    total = rated.agg(F.sum("n"), F.sum("k")).first()
    prior = F.lit(((total[1] or 0) + 1) / ((total[0] or 0) + 2))
    table, at = rated, {}
    for level, above in LEVELS:
        keys = [x for x, _ in LEVELS[:[y for y, _ in LEVELS].index(level) + 1]]
        sums = rated.groupBy(*keys).agg(F.sum("n").alias(f"{level}_n"), F.sum("k").alias(f"{level}_k"))
        at[level] = _strength(sums, level)
        table = table.join(sums, keys)
        a = at[level] * prior + F.col(f"{level}_k")
        whole = F.lit(at[level]) + F.col(f"{level}_n")
        prior = a / whole
    spread = F.sqrt(prior * (1 - prior) / (whole + 1))
    return table.select("host", "n", "k", prior.alias("rate"), (prior - DEVIATIONS * spread).alias("bound"))


def _strength(sums: DataFrame, level: str) -> float:
    """Pseudo-counts of the prior, from the spread of the groups' rates (analysis of variance; 1 to 1000)."""
    n, k = F.col(f"{level}_n"), F.col(f"{level}_k")
    some = sums.filter(n > 0)
    row = some.agg(F.count(F.lit(1)), F.sum(n), F.sum(k), F.sum(n * n), F.sum(k * k / n)).first()
    groups, whole, bad, squares, rates = (float(x or 0) for x in row)
    if groups < 2 or whole <= groups:
        return 10.0
    between = max(0.0, rates - bad * bad / whole) / (groups - 1)
    inside = (bad - rates) / (whole - groups)
    size = (whole - squares / whole) / (groups - 1)
    if between <= inside:
        return 1000.0
    return min(1000.0, max(1.0, (between + (size - 1) * inside) / (between - inside) - 1))


def filter_urls(
    pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]], key: Column, max_bad: float = MAX_BAD,
    suffixes: Iterable[str] = LONG_SUFFIXES,
) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_rate and bound for every row of `pages` (page_id, url).

    `key` finds a page's outcome; `suffixes` are as of host_levels (read_suffixes reads a list). A null url, or one without `://`, has an empty host and path; no rule fits it, and
    it shares the reputation of the empty host. Rows that repeat get a row each. Other columns are ignored.
    """
    parsed = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
                          key.alias("key"))
    parsed = parsed.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("host", "path")})
    hosts = host_reputation(parsed.select("host", "key"), outcomes, suffixes)
    rule = rule_of(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("bound") > max_bad, F.lit("block")).otherwise(F.lit("allow"))
    judged = parsed.select("page_id", "host", "path", rule.alias("found")).join(hosts, "host")
    return judged.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), learned).alias("verdict"),
        F.round("rate", 6).alias("bad_rate"), F.round("bound", 6).alias("bound"))
