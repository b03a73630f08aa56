"""URL rules and an empirical-Bayes reputation of hosts.

Labelled page outcomes are counted per host and shrunk towards the registered domain, the domain towards
its public suffix, the suffix towards all pages. Suffixes follow a table of rules. Outcomes are a table, too;
``page_outcomes`` makes one from labels of texts, for the pages whose own text is a labelled one. Each level has a beta prior whose mean is the parent's
posterior mean and whose strength follows from how much the level's groups really differ (moments of the
beta-binomial). A host passes when the lower bound of its posterior share of good pages is high enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from addrspark.llm.shared import written

# Rules every crawl gets.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
# Second-level labels under which country registries hand out names.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Within-group correlation: limits, and the value where no group has two labels.
LEAST_RHO, MOST_RHO, DEFAULT_RHO = 0.001, 0.5, 0.1


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.when(F.instr(url, "://") > 0, F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)).otherwise("")


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)).otherwise("")


def _rest(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def matching_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both null where none does.

    A rule ``host/path`` fits its host and all subdomains when the path starts with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def default_suffixes(spark: SparkSession) -> DataFrame:
    """Rules for the usual second-level names of two-letter countries, such as ``co.uk``; column ``rule``."""
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]
    rules = [(f"{name}.{a}{b}",) for name in SECOND_LEVEL for a in letters for b in letters]
    return spark.createDataFrame(rules, "rule string")


def registered_domains(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """``hosts`` with suffix and domain of every distinct ``host``, by a table of public suffix rules.

    A rule is a suffix; ``*`` as its first label stands for any label, and ``!`` before a rule makes an exception,
    whose suffix is a label shorter. An exception prevails, else the rule of most labels; where none fits
    the last label is the suffix. The domain is the suffix and one label more, or the suffix alone where there
    is no more. A numeric address is its own domain, under its last number. Host and rule meet in a join on
    the last labels of the host, as many as the longest rule has.
    """
    size = suffixes.agg(F.max(F.size(F.split("rule", r"\.")))).first()[0] or 1
    labels = F.split(_bare(F.col("host")), r"\.")
    parts = hosts.select("host", labels.alias("labels")).withColumn("k", F.explode(F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(size)))))

    def last(k: Column) -> Column:
        return F.array_join(F.slice("labels", F.size("labels") - k + 1, k), ".")

    whole = last(F.col("k"))
    keys = F.array(
        F.struct(whole.alias("rule"), F.col("k").alias("reach"), F.lit(False).alias("excepted")),
        F.struct(F.when(F.col("k") > 1, F.concat(F.lit("*."), last(F.col("k") - 1))).otherwise("*").alias("rule"), F.col("k").alias("reach"), F.lit(False).alias("excepted")),
        F.struct(F.concat(F.lit("!"), whole).alias("rule"), (F.col("k") - 1).alias("reach"), F.lit(True).alias("excepted")),
    )
    met = parts.select("host", F.inline(keys)).join(suffixes.select("rule").distinct(), "rule")
    best = met.groupBy("host").agg(F.max(F.struct("excepted", "reach")).alias("best")).select(F.col("host").alias("met_host"), "best.reach")
    placed = hosts.join(best, F.col("host") == F.col("met_host"), "left").drop("met_host")
    placed = placed.withColumns({"labels": labels, "reach": F.greatest(F.coalesce("reach", F.lit(1)), F.lit(1))})
    more = F.least(F.col("reach") + 1, F.size("labels"))
    # An empty label, as before a leading dot, is no name to register.
    named = F.when(F.get("labels", F.size("labels") - more) == "", last(F.col("reach"))).otherwise(last(more))
    domain = F.when(_bare(F.col("host")).rlike(r"^[0-9.]+$"), _bare(F.col("host"))).otherwise(named)
    return placed.withColumns({"suffix": last(F.col("reach")), "domain": domain}).drop("labels", "reach")


def _bare(host: Column) -> Column:
    """The host without user name and port."""
    return F.regexp_extract(host, r"^(?:.*@)?([^@:]*)(?::[0-9]*)?$", 1)


def _mean(strength: Column, parent: Column) -> Column:
    return (strength * parent + F.col("good")) / (strength + F.col("n"))


def _strength(groups: DataFrame, parent: Column) -> Column:
    """The prior strength of a level from the spread of its groups around their parents' means: one number."""
    clipped = F.greatest(F.least(parent, F.lit(0.999)), F.lit(0.001))
    rate = F.col("good") / F.col("n")
    ratio = F.col("n") * (rate - clipped) * (rate - clipped) / (clipped * (1 - clipped))
    pairs = F.sum(F.col("n") - 1)
    rho = F.when(pairs > 0, F.sum(ratio - 1) / pairs).otherwise(DEFAULT_RHO)
    rho = F.greatest(F.least(F.coalesce(rho, F.lit(DEFAULT_RHO)), F.lit(MOST_RHO)), F.lit(LEAST_RHO))
    return F.lit(groups.filter(F.col("n") > 0).agg((1 / rho - 1).alias("strength")).first()["strength"])


def host_reputation(
    pages: DataFrame, outcomes: DataFrame, z: float = 1.645, suffixes: DataFrame | None = None
) -> DataFrame:
    """One row per host: host, domain, suffix, n, good, posterior_mean, posterior_low.

    ``pages`` has page_id and host, ``outcomes`` page_id, n and good (labels seen, good ones among them),
    one row per page; ``suffixes`` are rules as ``registered_domains`` takes them. A host without labels stands where its domain does; without any label at all every
    mean is 0.5. Counts combine before each shuffle, so a hot host or domain costs a row per task.
    """
    seen = outcomes.select(F.col("page_id").alias("outcome_page"), "n", "good")
    counted = (
        pages.join(seen, F.col("page_id") == F.col("outcome_page"), "left")
        .groupBy("host")
        .agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"))
    )
    rules = default_suffixes(pages.sparkSession) if suffixes is None else suffixes
    hosts = written(registered_domains(written(counted, "counted"), rules), "hosts")
    sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    mean = F.coalesce(F.sum("good") / F.nullif(F.sum("n"), F.lit(0)), F.lit(0.5))
    overall = F.lit(hosts.agg(mean.alias("mean")).first()["mean"])

    suffixes = hosts.groupBy("suffix").agg(*sums)
    suffixes = suffixes.select("suffix", _mean(_strength(suffixes, overall), overall).alias("suffix_mean"))
    domains = hosts.groupBy("domain", "suffix").agg(*sums).join(suffixes, "suffix")
    mean = F.col("suffix_mean")
    domains = domains.select("domain", "suffix", _mean(_strength(domains, mean), mean).alias("domain_mean"))
    placed = hosts.join(domains, ["domain", "suffix"])
    mean = F.col("domain_mean")
    strength = _strength(placed, mean)
    a = strength * mean + F.col("good")
    b = strength * (1 - mean) + F.col("n") - F.col("good")
    posterior = placed.select("host", "domain", "suffix", "n", "good", a.alias("a"), b.alias("b"))
    total = F.col("a") + F.col("b")
    spread = F.sqrt(F.col("a") * F.col("b") / (total * total * (total + 1)))
    return posterior.select(
        "host", "domain", "suffix", "n", "good",
        (F.col("a") / total).alias("posterior_mean"),
        (F.col("a") / total - z * spread).alias("posterior_low"),
    )


def letters_digest(text: Column) -> Column:
    """A digest of the letters and digits of a text in order; null where there are none."""
    letters = F.regexp_replace(text, r"[^\p{L}\p{N}]+", "")
    return F.when(letters != "", F.md5(F.encode(letters, "UTF-8")))


def article_text(html: Column) -> Column:
    """The text of a page's article without its heading, tags and entities; null where there is no article."""
    article = F.regexp_extract(html, "(?s)<article>(.*?)</article>", 1)
    bare = F.regexp_replace(F.regexp_replace(article, "(?s)<h1>.*?</h1>", ""), "<[^>]*>|&[A-Za-z]+;|&#[0-9]+;", " ")
    return F.when(article != "", bare)


def page_outcomes(pages: DataFrame, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Outcomes of the pages whose article is a labelled text, letter by letter: page_id, n (1) and good (0 or 1).

    A text is good when most labels of the documents that hold it have quality 1 and toxic 0; half is not most.
    Labels with a null part say nothing, and neither do documents without letters. A page_id that stands on
    several pages has one outcome, good if all of them are; a null one has none. Texts become digests before
    anything is shuffled, and labels of copies are counted per digest before they meet pages.
    """
    known = labels.filter(F.col("quality").isNotNull() & F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
    good = ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("bigint")
    judged = known.groupBy(F.col(id_col).alias("label_id")).agg(F.count(F.lit(1)).alias("label_n"), F.sum(good).alias("label_good"))
    texts = docs.select(F.col(id_col).alias("label_id"), letters_digest(F.col("text")).alias("digest")).filter(F.col("digest").isNotNull())
    by_text = texts.join(judged, "label_id").groupBy("digest").agg((2 * F.sum("label_good") > F.sum("label_n")).cast("bigint").alias("good"))
    held = pages.select("page_id", letters_digest(article_text(F.col("html"))).alias("digest"))
    held = held.filter(F.col("page_id").isNotNull() & F.col("digest").isNotNull())
    met = held.join(by_text, "digest").groupBy("page_id").agg(F.min("good").alias("good"))
    return met.select("page_id", F.lit(1).cast("bigint").alias("n"), "good")


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: tuple[tuple[str, str], ...] = RULES,
    min_good: float = 0.5,
    z: float = 1.645,
    suffixes: DataFrame | None = None,
) -> DataFrame:
    """Every page with host, path, rule, verdict, host_labels, posterior_mean, posterior_low.

    ``outcomes`` are known outcomes of pages, page_id, n and good, such as ``page_outcomes`` gives.

    The longest rule that fits decides; where none fits, a page is allowed when its host's lower
    posterior bound reaches ``min_good``. A null url and one without ``://`` have an empty host, which is
    a host like any other. Pages repeated in the table are judged each; columns other than page_id and
    url are not looked at. The reputation joins on the host, a side adaptive execution broadcasts when
    it is small and otherwise splits where a host is hot.
    """
    named = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    named = named.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    known = host_reputation(named.select("page_id", "host"), outcomes, z, suffixes)
    known = known.select(
        F.col("host").alias("known_host"), F.col("n").alias("host_labels"), "posterior_mean", "posterior_low"
    )
    rule, said = matching_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("posterior_low") >= min_good, "allow").otherwise("block")
    return named.join(known, F.col("host") == F.col("known_host"), "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(said, method).alias("verdict"),
        "host_labels", "posterior_mean", "posterior_low",
    )
