"""URL filters by association rules that Spark's FP-growth mines.

A URL becomes a basket of tokens: scheme, host labels, registered domain, all path
segments with digits generalised (the first four with their place), query keys. Baskets that the list rules judge
carry their verdict as one more item. Tokens that stand in exactly the same baskets
become one item first (the segments of a path that pages share, say), which the
rules state by its members: a URL holds the item if it holds any of them, as every
subset of them would make the same rule. FP-growth over the items gives rules
{items} -> verdict, kept by support and confidence among the judged. A rule that
merely restates the list is dropped: the tokens that a list rule names must be
joined by others, and its confidence must exceed that of its named tokens alone
(a domain brings its top label; of no token: the verdict's share) by more than chance, one-sided at 5 percent.
An inverted index holds each rule under its rarest token; a URL looks up its
tokens there, checks the whole antecedent, and takes the verdict of its most
confident rule (allow on a tie, and where no rule matches). List rules always
win; the longest fitting one decides.

Scale: FP-growth is distributed. Its frequent items are bounded by 1 / support times
the basket length, not by the pages; a path of any length that the same pages share is one
item. Items with different baskets that stand together often still combine: k of them
in one basket give up to 2^k sets, as the method has it. Equal basket sets are found by their number and
two 64-bit hashes of the basket ids, combined map-side. Only distinct undecided URLs are
matched; the index is broadcast after its rows are counted, else joined. Very long URLs are read whole.

Defined results: a null URL or one without ``://`` has an empty host and path,
fits no list rule and is judged by the method; repeated rows get one verdict
each; without labelled pages no rule is mined and all others are allowed; an empty table
yields no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from typing import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_small, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fixed values: (verdict, host and path) of the list rules.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))

SUPPORT, CONFIDENCE = 0.002, 0.9
#: Path segments whose tokens tell their place; deeper ones are tokens without it.
PLACED = 4
#: Standard errors by which a rule's confidence exceeds that of the tokens the list names.
BEYOND = 1.645


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    return F.translate(host, UPPER, LOWER), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def list_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]], what: int) -> Column:
    """The longest fitting rule (what=1) or its verdict (what=0); null where none fits."""
    out = None
    for rule in sorted(rules, key=lambda r: -len(r[1])):
        h, p = rule[1].split("/", 1)
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        out = F.when(fits, F.lit(rule[what])) if out is None else out.when(fits, F.lit(rule[what]))
    return F.lit(None).cast("string") if out is None else out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL; none for an empty host."""
    labels = F.split(host, r"\.")
    named = F.when(F.size(labels) > 2, F.slice(labels, 1, F.size(labels) - 2)).otherwise(F.array().cast("array<string>"))
    domain = F.concat(F.lit("domain="), F.element_at(labels, F.when(F.size(labels) > 1, -2).otherwise(-1)), F.lit("."), F.element_at(labels, -1))
    segments = F.filter(F.split(F.regexp_replace(path, r"[0-9]+", "0"), "/"), lambda s: s != "")
    placed = F.transform(segments, lambda s, i: F.concat(F.lit("path"), F.when(i < PLACED, i.cast("string")).otherwise(""), F.lit("="), s))
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda q: q != ""), lambda q: F.concat(F.lit("query="), F.split(q, "=", 2)[0]))
    found = F.concat(F.array(F.concat(F.lit("scheme="), F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))),
                             F.concat(F.lit("top="), F.element_at(labels, -1)), domain),
                     F.transform(named, lambda x: F.concat(F.lit("host="), x)), placed, keys)
    return F.when(host != "", F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def named_tokens(rules: Sequence[tuple[str, str]]) -> list[str]:
    """The tokens that list rules name."""
    out = set()
    for _, rule in rules:
        host, path = rule.split("/", 1)
        labels = host.split(".")
        out |= {f"top={labels[-1]}", *([f"domain={labels[-2]}.{labels[-1]}"] if len(labels) > 1 else []), *[f"host={x}" for x in labels[:-2]]}
        out |= {f"path{i if i < PLACED else ''}={x}" for i, x in enumerate(x for x in re.sub(r"[0-9]+", "0", path).split("/") if x)}
    return sorted(out)


def beyond_list(rules: DataFrame, sets: DataFrame, n: int, named: Sequence[str]) -> DataFrame:
    """The rules whose confidence their named tokens alone don't explain; ``sets`` are the frequent sets of n baskets."""
    listed = F.array(*[F.lit(x) for x in named]).cast("array<string>")
    is_verdict = lambda x: x.startswith("verdict=")
    s = sets.select(F.array_sort(F.filter("items", lambda x: ~is_verdict(x))).alias("part"),
                    F.substring_index(F.get(F.filter("items", is_verdict), 0), "verdict=", -1).alias("verdict"), "freq")
    s = s.where(F.size(F.array_except("part", listed)) == 0)
    nothing = s.sparkSession.range(1).select(F.array().cast("array<string>").alias("part"), F.lit(n).cast("long").alias("all"))
    whole = s.where(F.col("verdict").isNull()).select("part", F.col("freq").alias("all")).union(nothing)
    share = s.where(F.col("verdict").isNotNull()).join(whole, "part").select("part", "verdict", (F.col("freq") / F.col("all")).alias("share"))
    tops = F.transform(F.filter("antecedent", lambda x: x.startswith("domain=")), lambda x: F.concat(F.lit("top="), F.substring_index(x, ".", -1)))
    rules = rules.withColumn("part", F.array_sort(F.array_intersect(F.concat("antecedent", tops), listed))).join(share, ["part", "verdict"])
    error = F.sqrt(F.col("share") * (1 - F.col("share")) * F.col("confidence") / (F.col("support") * n))
    return rules.where((F.size(F.array_except("antecedent", "part")) > 0) & (F.col("confidence") - F.col("share") > BEYOND * error)).drop("part", "share")


def merged_items(baskets: DataFrame, least: int, named: Sequence[str]) -> DataFrame:
    """(item, members): tokens in at least ``least`` baskets (id, tokens), those of equal basket sets together.

    An item is called by its smallest member. Tokens that list rules name and
    domains (one in a basket) stay alone, since rules are held against them. A written table.
    """
    each = baskets.select("id", F.explode("tokens").alias("token"))
    sets = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), *[F.bit_xor(F.xxhash64("id", F.lit(i))).alias(f"h{i}") for i in (1, 2)])
    alone = F.col("token").isin(list(named)) | F.col("token").startswith("domain=") | F.col("token").startswith("top=")
    sets = sets.where(F.col("n") >= least).withColumn("own", F.when(alone, F.col("token")))
    same = sets.groupBy("own", "n", "h1", "h2").agg(F.sort_array(F.collect_list("token")).alias("members"))  # tokens of one basket
    return materialize(same.select(F.col("members")[0].alias("item"), "members", "n"), name="url-items")


NO_RULES = "rule_id long, antecedent array<string>, members array<array<string>>, verdict string, confidence double, token string"


def mine(judged: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, named: Sequence[str] = ()) -> DataFrame:
    """Rules (rule_id, antecedent, members, verdict, confidence, token) from (tokens, verdict or null); token is the rarest item.

    Support and confidence count all the rows given; ``named`` are the list rules'
    tokens. ``members`` lists, item by item, the tokens that stand for it.
    """
    baskets = materialize(judged.select(F.monotonically_increasing_id().alias("id"), "tokens", "verdict"), name="url-baskets")
    n = baskets.count()
    if not n:
        return judged.sparkSession.createDataFrame([], NO_RULES)
    items = merged_items(baskets, max(1, math.ceil(support * n)), named)
    of = items.select(F.explode("members").alias("__token"), "item")
    found = join_small(baskets.select("id", F.explode("tokens").alias("token")), of, F.col("token") == F.col("__token"), "inner")
    found = found.groupBy(F.col("id").alias("__id")).agg(F.collect_set("item").alias("found"))
    nothing = F.array().cast("array<string>")
    label = F.when(F.col("verdict").isNotNull(), F.array(F.concat(F.lit("verdict="), F.col("verdict")))).otherwise(nothing)
    rows = baskets.join(found, F.col("id") == F.col("__id"), "left").select(F.concat(F.coalesce("found", nothing), label).alias("items"))
    rows = materialize(rows, name="url-item-baskets")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(rows)
    rules = (model.associationRules.where(F.col("consequent")[0].startswith("verdict="))
             .select(F.array_sort("antecedent").alias("antecedent"), F.substring_index(F.col("consequent")[0], "verdict=", -1).alias("verdict"), "confidence", "support"))
    rules = beyond_list(rules, model.freqItemsets, n, named)
    rules = materialize(rules.withColumn("rule_id", F.xxhash64("antecedent", "verdict")), name="url-rules")
    parts = rules.select("rule_id", F.posexplode("antecedent").alias("at", "item")).join(items, "item")
    parts = parts.groupBy("rule_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "members"))), lambda x: x["members"]).alias("members"),
                                         F.min(F.struct("n", "item"))["item"].alias("token"))
    return materialize(rules.join(parts, "rule_id").select("rule_id", "antecedent", "members", "verdict", "confidence", "token"), name="url-index")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, verdict, confidence) of URLs (url, tokens) that fit a rule: the most confident one's."""
    rarest = F.element_at("members", F.array_position("antecedent", F.col("token")).cast("int"))
    r = materialize(rules.select(F.explode(rarest).alias("__token"), "members", F.col("verdict").alias("__verdict"), "confidence"), name="url-lookup")
    hits = join_small(urls.withColumn("__item", F.explode("tokens")), r, F.col("__item") == F.col("__token"), "inner")
    hits = hits.where(F.forall("members", lambda m: F.arrays_overlap(m, F.col("tokens"))))
    best = hits.groupBy("url").agg(F.max(F.struct("confidence", (F.col("__verdict") == "allow").alias("a"), "__verdict")).alias("b"))
    return best.select("url", F.col("b.__verdict").alias("verdict"), F.col("b.confidence").alias("confidence"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, support: float = SUPPORT,
          confidence: float = CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict and the mined rule's confidence (null where none decides)."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", list_rule(F.col("host"), F.col("path"), rules, 1)).withColumn("listed", list_rule(F.col("host"), F.col("path"), rules, 0))
    items = tokens(F.col("url"), F.col("host"), F.col("path"))
    judged = rows.where(F.col("listed").isNotNull()).select(items.alias("tokens"), F.col("listed").alias("verdict"))
    mined = mine(judged, support, confidence, named_tokens(rules))
    open_urls = rows.where(F.col("listed").isNull() & F.col("url").isNotNull()).select("url", items.alias("tokens")).distinct()
    digest = F.md5(F.col("url").cast("binary"))  # short, so that the rows counted before a broadcast bound its bytes
    found = match(open_urls, mined).select(digest.alias("__url"), F.col("verdict").alias("__verdict"), "confidence")
    found = materialize(found, name="url-verdicts")
    out = join_small(rows, found, (digest == F.col("__url")) & F.col("listed").isNull())
    return out.select("page_id", "host", "path", "rule", F.coalesce("listed", "__verdict", F.lit("allow")).alias("verdict"), "confidence")
