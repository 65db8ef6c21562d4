"""URL filters: listed rules first, mined association rules for the rest.

A listed rule is (host, path, verdict); it fits its host and all subdomains if
the path starts with the rule's, and the longest rule that fits wins.

Where no listed rule fits, association rules judge. Labelled pages (a listed
rule's verdict, else the page's row in ``labels``: low quality or toxic is
block) become transactions of URL tokens and a verdict item; tokens that occur
in the same labelled pages are one item, so a section's many fixed tokens are
not combined with each other. Spark's FP-growth finds the frequent combinations
over all transactions, and rules that end in a verdict are kept if their
confidence and support suffice. Rules are found by an inverted index: each is
posted under the tokens of its rarest item only, a URL looks up its own tokens,
and a hit counts if a token of every item of the rule is there: what the rules
over single tokens, one for each choice of them, would match. The most
confident rule that matches wins; without one the verdict is ``allow``.

URLs that differ only in numbers share their tokens, so matching runs once per
distinct token set and pages are joined back on it.

Defined cases: a null URL or one without ``://`` has an empty host and path
and no tokens; repeated pages are judged alike and all returned; a page with
several label rows is bad if any is; without labelled pages there are no mined
rules.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from audival.llm.shared import stages

#: Fixed: the listed rules.
LISTED = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
          ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: Smallest share of labelled pages and smallest confidence of a mined rule.
SUPPORT, CONFIDENCE = 0.005, 0.75
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)


def listed_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Sorted distinct tokens: parts of the host, words of the path (numbers
    as one token) and names of query parameters."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    part = lambda kind, text, cut: F.transform(F.split(text, cut), lambda t: F.when(t != "", F.concat(F.lit(kind), t)))
    words = F.lower(F.regexp_replace(path, r"[0-9]+", "0"))
    names = F.regexp_replace(F.lower(query), r"=[^&]*", "")
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(
        part("h:", host, r"[.:@-]"), part("p:", words, r"[/._-]+"), part("q:", names, "&")))))


def frequent_items(labelled: DataFrame, least: float) -> DataFrame:
    """(item, members, often): tokens in at least ``least`` of the rows of
    (tokens, n), those that occur in the same rows as one item with its
    smallest token as name. Equal rows are told by their number and 128 bits
    of the token sets they are in. A row has few tokens, so there are at most
    rows x tokens a row / least items, however many tokens there are."""
    lanes = [F.xxhash64("tokens").alias("_h1"), F.xxhash64(F.lit(1), F.reverse("tokens")).alias("_h2")]
    seen = (labelled.groupBy("tokens").agg(F.sum("n").alias("n")).select(F.explode("tokens").alias("token"), "n", *lanes)
            .groupBy("token").agg(F.sum("n").alias("often"), F.bit_xor("_h1").alias("_h1"), F.bit_xor("_h2").alias("_h2"))
            .filter(F.col("often") >= least))
    return seen.groupBy("often", "_h1", "_h2").agg(F.sort_array(F.collect_list("token")).alias("members")).select(
        F.col("members")[0].alias("item"), "members", "often")


def mine_rules(labelled: DataFrame, support: float, confidence: float) -> DataFrame:
    """(rule, mined, confidence, support) from rows of (tokens, verdict); a rule
    is a list of items, each the list of its tokens, of which any stands for
    all, as they always occur together in labelled rows."""
    store = stages(labelled.sparkSession)
    kinds = store.write(labelled.groupBy("tokens", "verdict").agg(F.count(F.lit(1)).alias("n")), "labelled")
    least = support * (kinds.agg(F.sum("n")).first()[0] or 0)
    items = store.write(frequent_items(kinds, least), "items")
    # names of frequent items only: their number does not grow with the rows
    names = [r[0] for r in items.select("item").collect()]
    baskets = labelled.select(F.concat(F.filter("tokens", lambda t: t.isin(names)),
                                       F.array(F.concat(F.lit("="), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    found = (model.associationRules
             .filter(F.col("consequent")[0].isin("=allow", "=block") & (F.col("lift") > 1))
             .select(F.monotonically_increasing_id().alias("id"), "antecedent",
                     F.substr(F.col("consequent")[0], F.lit(2)).alias("mined"), "confidence", "support"))
    found = store.write(found, "found")
    members = found.select("id", F.explode("antecedent").alias("item")).join(items, "item").groupBy("id").agg(
        F.sort_array(F.collect_list("members")).alias("rule"))
    return found.join(members, "id").select("rule", "mined", "confidence", "support")


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] | None = None,
          support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule (the tokens of the mined
    rule that decided, if one did)."""
    store = stages(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, listed = listed_rule(F.col("host"), F.col("path"), rules if rules is not None else LISTED)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), listed.alias("listed"),
                       url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"))
    rows = store.write(rows, "pages")

    bad = labels.groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    labelled = rows.filter(F.size("tokens") > 0).join(bad.filter("bad is not null"), "page_id", "left").select(
        "tokens", F.coalesce("listed", F.when(F.col("bad") == 1, "block").when(F.col("bad") == 0, "allow")).alias("verdict"))
    mined = store.write(mine_rules(labelled.filter("verdict is not null"), support, confidence), "rules")

    kinds = store.write(rows.filter("listed is null").groupBy("tokens").agg(F.count(F.lit(1)).alias("n")), "kinds")
    # tokens of the rules only; how often each item occurs decides the posting
    mined = mined.select("*", F.array_join(F.transform("rule", lambda g: F.array_join(g, "|")), " ").alias("mined_rule"))
    used = mined.select(F.explode(F.array_distinct(F.flatten("rule"))).alias("token")).distinct()
    seen = kinds.select(F.explode("tokens").alias("token"), "n").join(used, "token", "left_semi")
    often = seen.groupBy("token").agg(F.sum("n").alias("often"))
    # an item is as frequent as its tokens together; it is posted under each of them
    parts = mined.select("*", F.posexplode("rule").alias("place", "item"))
    totals = (parts.select("mined_rule", "mined", "place", F.explode("item").alias("token")).join(often, "token")
              .groupBy("mined_rule", "mined", "place").agg(F.sum("often").alias("often")))
    posting = (parts.join(totals, ["mined_rule", "mined", "place"])
               .withColumn("k", F.row_number().over(Window.partitionBy("mined_rule", "mined").orderBy("often", "place")))
               .filter("k = 1").select("rule", "mined", "mined_rule", "confidence", "support", F.explode("item").alias("token")))
    hits = (kinds.select("tokens", F.explode("tokens").alias("token")).join(posting, "token")
            .filter(F.forall("rule", lambda g: F.arrays_overlap(g, F.col("tokens")))))
    best = hits.groupBy("tokens").agg(F.max(F.struct("confidence", "support", "mined_rule", "mined")).alias("best"))
    best = best.select("tokens", F.col("best.mined").alias("mined"), F.col("best.mined_rule").alias("mined_rule"))
    # stored, so that a hot token set can be split in the join
    out = rows.join(store.write(best, "best"), "tokens", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("listed", "mined", F.lit("allow")).alias("verdict"),
                      F.when(F.col("listed").isNull(), F.col("mined_rule")).alias("mined_rule"))
