"""URL filter by mined association rules.

Labelled URLs become sets of tokens (scheme, host labels and suffixes, path segments, query keys). Spark's FP-growth mines
the sets that are frequent among the bad ones; a set's support is its bad rows. How many labelled rows of either kind hold it is then
counted by an inverted index: each set is listed under its rarest token, a row looks up its own tokens, and the few sets found are checked
in full. Rules "tokens -> bad" stay if support, confidence and the lower bound of the confidence (Wilson, one-sided 95 %) pass the limits, so
that a few rows of one host make no rule, and if no rule on all but one of the tokens is as confident. URLs find the rules by the same index;
one that a rule fits is blocked, by the most confident one.

``labels_of`` takes the labels from the URLs themselves: the verdicts of the given rules, so what these block on some hosts is
mined and then also found on hosts that no given rule names. Support is at least ``MIN_SUPPORT`` rows and ``MIN_SHARE`` of the bad rows: the frequent
tokens, which FP-growth gathers on the driver, are then at most the tokens of a URL over ``MIN_SHARE``, however large the table.

Given rules on (host, path prefix) go first: a rule fits its host and all subdomains if the path starts
with the rule's, the longest one decides, and only URLs without one go to the mined rules.

Verdicts of the mined rules depend on the URL alone, so distinct URLs are matched and the result returns by a join
salted by page: a URL that a third of the pages share is looked up once. The index is broadcast if it has at
most ``BROADCAST_ROWS_MAX`` rows, which is counted, else joined with its tokens salted.

Null URLs, and those without ``://``, have empty host and path and no tokens: allowed. Repeated pages are judged
alike. Without labelled rows, or without rules that pass, everything else is allowed. An empty table gives an
empty result. Further columns play no part.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import BROADCAST_ROWS_MAX, salted_join, stored

MIN_SUPPORT = 5  # bad rows; below 1 a share of all labelled rows
MIN_SHARE = 0.01  # of the bad rows
MIN_CONFIDENCE = 0.8
#: Lower bound of the confidence: five bad rows of five pass, five of six don't.
MIN_BOUND = 0.6
_Z = 1.645


@dataclass(frozen=True)
class HostRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^/?#]*", 0)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def host_rule(host_col: Column, path_col: Column, rules: list[HostRule]) -> Column:
    """The longest rule that fits: struct (length, text, verdict), or null."""
    fits = [F.when(((host_col == r.host) | host_col.endswith("." + r.host)) & path_col.startswith(r.path),
                   F.struct(F.lit(len(r.text)).alias("length"), F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))) for r in rules]
    none = F.lit(None).cast("struct<length:int,text:string,verdict:string>")
    return F.array_max(F.array(none, *fits))


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL; numbers in segments count as one token."""
    rest = F.coalesce(_rest(url), F.lit(""))
    labels = F.filter(F.split(host(url), r"\."), lambda x: x != "")
    suffixes = F.when(F.size(labels) >= 2, F.array(F.concat(F.lit("site="), F.array_join(F.slice(labels, -2, 2), ".")))).otherwise(F.array().cast("array<string>"))
    segments = F.filter(F.split(path(url), "/"), lambda x: x != "")
    segments = F.transform(segments, lambda x: F.concat(F.lit("path="), F.regexp_replace(x, "[0-9]+", "0")))
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("query="), F.substring_index(x, "=", 1)))
    scheme = F.when(_rest(url).isNotNull(), F.array(F.concat(F.lit("scheme="), F.lower(F.substring_index(url, "://", 1))))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(scheme, F.transform(labels, lambda x: F.concat(F.lit("host="), x)), suffixes, segments, keys))


def labels_of(pages: DataFrame, rules: list[HostRule], url_col: str = "url") -> DataFrame:
    """(url, bad) of the distinct URLs that one of the given rules fits; bad if it blocks."""
    urls = pages.select(F.col(f"`{url_col}`").cast("string").alias("url"))
    verdict = host_rule(host(F.col("url")), path(F.col("url")), rules)["verdict"]
    return urls.select("url", (verdict == "block").alias("bad")).where("bad is not null").distinct()


def _bound(bad: Column, n: Column) -> Column:
    """Wilson's lower bound of the share ``bad`` of ``n``."""
    p, z = bad / n, F.lit(_Z)
    return (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def _looked_up(rows: DataFrame, listed: DataFrame, spread: str) -> DataFrame:
    """Each row of ``rows`` (tokens, …) with each of ``listed`` (items, anchor, …) whose items it has, found under its anchor."""
    open_rows = rows.withColumn("anchor", F.explode("tokens"))
    if listed.count() <= BROADCAST_ROWS_MAX:
        found = open_rows.join(F.broadcast(listed), "anchor")
    else:
        fields = [c for c in listed.columns if c != "anchor"]
        grouped = listed.groupBy("anchor").agg(F.collect_list(F.struct(*fields)).alias("listed"))
        found = salted_join(open_rows, grouped, ["anchor"], spread).select(*open_rows.columns, F.inline("listed"))
    return found.where(F.size(F.array_except("items", "tokens")) == 0)


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_share: float = MIN_SHARE, min_bound: float = MIN_BOUND) -> DataFrame:
    """Rules (rule_id, items, anchor, confidence, support) from rows (url, bad: boolean); null labels are left out."""
    rows = labelled.where(F.col("url").isNotNull() & F.col("bad").isNotNull())
    rows = stored(rows.select(tokens(F.col("url")).alias("tokens"), "bad", F.xxhash64("url").alias("hash")), "transactions")
    n, n_bad = rows.agg(F.count("*"), F.count(F.when(F.col("bad"), 1))).first()
    if not n_bad:
        return labelled.sparkSession.createDataFrame([], "rule_id string, items array<string>, anchor string, confidence double, support double")
    least = math.ceil(min_support * n) if min_support < 1 else max(min_support, math.ceil(min_share * n_bad))
    bad = rows.where("bad").select(F.col("tokens").alias("items"))
    parts = int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / n_bad), numPartitions=parts).fit(bad)
    sets = stored(model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("bad_rows")), "frequent-sets")
    single = sets.where(F.size("items") == 1).select(F.element_at("items", 1).alias("anchor"))
    frequency = rows.select(F.explode("tokens").alias("anchor")).groupBy("anchor").agg(F.count("*").alias("freq")).join(single, "anchor")
    rarest = (sets.select("items", F.explode("items").alias("anchor")).join(stored(frequency, "frequencies"), "anchor")
              .groupBy("items").agg(F.min_by("anchor", F.struct("freq", "anchor")).alias("anchor")))
    listed = stored(sets.join(rarest, "items"), "listed-sets")
    dealt = rows.select("tokens", "hash").repartition(parts, "hash")  # few bytes, much work a row
    held = _looked_up(dealt, listed.select("items", "anchor"), "hash").groupBy("items").agg(F.count("*").alias("all_rows"))
    passed = listed.join(held, "items").where((F.col("bad_rows") / F.col("all_rows") >= min_confidence) & (_bound(F.col("bad_rows"), F.col("all_rows")) >= min_bound))
    passed = passed.select("items", "anchor", (F.col("bad_rows") / F.col("all_rows")).alias("confidence"), (F.col("bad_rows") / F.lit(n)).alias("support"))
    found = stored(passed, "mined")
    # redundant: without one of its tokens the rule is at least as confident
    left_out = found.select("items", "confidence", F.explode("items").alias("left_out")).select(F.array_remove("items", F.col("left_out")).alias("part"), "items", "confidence")
    redundant = (left_out.join(found.select(F.col("items").alias("part"), F.col("confidence").alias("of_part")), "part")
                 .where("of_part >= confidence").select("items").distinct())
    kept = found.join(redundant, "items", "left_anti")
    return stored(kept.select(F.array_join("items", " ").alias("rule_id"), "items", "anchor", "confidence", "support"), "rules")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, mined_rule, confidence) of the distinct URLs that a mined rule fits, by the most confident one."""
    distinct = urls.where("url is not null").select("url").distinct()
    fits = _looked_up(distinct.select("url", tokens(F.col("url")).alias("tokens")), rules, "url")
    best = F.max(F.struct("confidence", "support", "rule_id")).alias("best")
    return fits.groupBy("url").agg(best).select("url", F.col("best.rule_id").alias("mined_rule"), F.col("best.confidence").alias("confidence"))


def judge(pages: DataFrame, labelled: DataFrame, host_rules: list[HostRule], url_col: str = "url", id_col: str = "page_id",
          min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_share: float = MIN_SHARE, min_bound: float = MIN_BOUND) -> DataFrame:
    """Per page: id, host, path, rule, verdict (allow or block), mined_rule, confidence."""
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    rules = mine(labelled, min_support, min_confidence, min_share, min_bound)
    out = salted_join(rows, match(rows, rules), ["url"], "page_id", "left")
    out = out.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "mined_rule", "confidence")
    out = out.withColumn("given", host_rule(F.col("host"), F.col("path"), host_rules))
    mined = F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")
    return out.select("page_id", "host", "path", F.col("given.text").alias("rule"), F.coalesce("given.verdict", mined).alias("verdict"), "mined_rule", "confidence")
