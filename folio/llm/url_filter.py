"""URL filters: rules first, then a character language-model ratio (operator 7).

Two smoothed variable-order Markov models, of URLs that rules allow and of URLs
that rules block, judge every URL no rule fits by the difference of their
log-likelihoods per character.  DataFrame functions only.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import cut


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query, as host and path.
RULES = (
    Rule("block", "com", "/en/"),
    Rule("allow", "example.com", "/en/7"),
    Rule("allow", "net", "/de/"),
    Rule("block", "example.net", "/de/8"),
    Rule("block", "org", "/es/"),
)

ORDER = 3
PSEUDO_COUNT = 4.0
ALPHABET = 256.0
START, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in sorted(rules, key=lambda r: (-len(r.text), r.text))
    ]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def _grams(url: Column, order: int) -> Column:
    """Every character of a URL (and its end) with the `order` before it: the
    letters zipped with themselves, shifted, so that work follows the length."""
    letters = F.split(F.concat(F.lit(START * order), F.translate(url, UPPER, LOWER), F.lit(END)), "")
    count = F.length(url) + 1
    grams = F.slice(letters, F.lit(1), count)
    for shift in range(2, order + 2):
        grams = F.zip_with(grams, F.slice(letters, F.lit(shift), count), lambda x, y: F.concat(x, y))
    return grams


def ratios(urls: DataFrame, order: int = ORDER, pseudo: float = PSEUDO_COUNT) -> DataFrame:
    """gram, ratio: log P(c | h) under the allowed minus the blocked URLs.

    urls has url and label (allow, block or null).  At each order the estimate
    is (n(h, c) + pseudo * lower) / (n(h) + pseudo), down to a uniform character;
    a context never seen passes the lower order's estimate through.
    """
    counts = (
        urls.select("label", F.explode(_grams(F.col("url"), order)).alias("gram"))
        .groupBy("gram")
        .agg(F.count_if(F.col("label") == "allow").alias("allow"), F.count_if(F.col("label") == "block").alias("block"))
    )
    counts = cut(counts, "urls-grams")
    lower = None
    for k in range(order + 1):
        here = counts.groupBy(F.expr(f"right(gram, {k + 1})").alias("g")).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
        context = here.groupBy(F.expr(f"left(g, {k})").alias("h")).agg(F.sum("allow").alias("all_allow"), F.sum("block").alias("all_block"))
        here = here.withColumn("h", F.expr(f"left(g, {k})")).join(context, "h")
        if lower is None:
            here = here.withColumn("low_allow", F.lit(1 / ALPHABET)).withColumn("low_block", F.lit(1 / ALPHABET))
        else:
            here = here.withColumn("low", F.expr(f"right(g, {k})")).join(lower, "low")
        estimate = [
            ((F.col(c) + pseudo * F.col(f"low_{c}")) / (F.col(f"all_{c}") + pseudo)).alias(f"low_{c}") for c in ("allow", "block")
        ]
        lower = here.select(F.col("g").alias("low"), *estimate)
    return cut(lower.select(F.col("low").alias("gram"), (F.ln("low_allow") - F.ln("low_block")).alias("ratio")), "urls-ratios")


def scores(urls: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """number, score: mean ratio over the characters of each url (and its end).

    Grams carry their URL's number, not the URL, which may be long."""
    grams = urls.select("number", F.explode(_grams(F.col("url"), order)).alias("gram"))
    return grams.join(model, "gram").groupBy("number").agg(F.avg("ratio").alias("score"))


def dealt(urls: DataFrame) -> DataFrame:
    """urls over as many tasks as there is work for: a URL makes a row for each
    of its characters, but the table of URLs may be one small file."""
    rows, cores = urls.count(), urls.sparkSession.sparkContext.defaultParallelism
    return urls.repartition(max(min(2 * cores, rows // 500 + 1), rows // 50_000), "url")


def judge_urls(pages: DataFrame, rules=RULES, order: int = ORDER) -> DataFrame:
    """One row per row of pages(page_id, url): host, path, rule, verdict, score.

    The host runs from the first :// to the next /, ? or # (A-Z lower-cased), the
    path from there to ? or #; both are empty for a null url or one without ://.
    A rule fits its host and all subdomains if the path starts with the rule's;
    the longest fitting rule gives the verdict.  Otherwise score, the mean
    log-likelihood difference per character, is held against a threshold midway
    between the lowest twentieth of allowed and the highest twentieth of blocked
    URLs, on a fifth of the rule-judged URLs that the models haven't seen.  If
    rules judge no URL, or all alike, the models have nothing to tell apart and
    the verdict is allow.  Equal URLs get equal verdicts; repeated rows stay;
    further columns are ignored.
    """
    pages = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
    fit = rule_of(F.col("host"), F.col("path"), rules)
    parted = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))).withColumn("fit", fit)
    urls = parted.groupBy("url").agg(F.first("fit.verdict").alias("judged"))
    urls = urls.withColumn("apart", F.pmod(F.xxhash64("url"), F.lit(5)) == 0).withColumn("number", F.monotonically_increasing_id())
    urls = dealt(cut(urls, "urls"))
    model = ratios(urls.select("url", F.when(~F.col("apart"), F.col("judged")).alias("label")), order)
    scored = cut(scores(urls, model, order).join(urls, "number"), "urls-scored")
    quantile = scored.where("apart").agg(
        F.percentile_approx(F.when(F.col("judged") == "allow", F.col("score")), 0.05, 10_000).alias("allow"),
        F.percentile_approx(F.when(F.col("judged") == "block", F.col("score")), 0.95, 10_000).alias("block"),
    )
    low, high = quantile.first()
    threshold = (low + high) / 2 if low is not None and high is not None else float("-inf")
    by_model = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    # null and empty URLs may be most of all: their one score goes to them
    blank = F.broadcast(scored.where("url = ''").select("score"))  # one row at most
    named = parted.where("url <> ''").join(scored.select("url", "score"), "url").unionByName(parted.where("url = ''").join(blank))
    return named.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", by_model).alias("verdict"), "score")


def op7_url_filter(spark, sf_dir):
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
