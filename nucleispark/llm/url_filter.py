"""URL filters: host and path rules, and association rules mined by FP-growth for the urls that no rule fits.

A url is a set of tokens: each host label with its place from the right (a numbered word counts as `#`), the path
segments with their place, and query keys. Tokens that the same labelled urls have, such as the segments of one template,
are one item. Labelled urls with their label as one more item are the transactions of Spark's FP-growth. Rules
`items -> label` with enough support and confidence stay, except those that a rule with fewer of the same items and at
least the same confidence makes needless; a rule of two tokens of one item would be such. A url has an item if it has
one of its tokens. A rule is listed under its rarest item; a url meets only the rules listed under its items, and of
those whose items it all has, the best one decides: highest confidence, then highest support, then the least tokens as text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nucleispark.session import checkpointed as cut

MIN_SUPPORT = 0.02
MIN_CONFIDENCE = 0.8
DEFAULT = "allow"


#: Items that stand for labels; tokens never begin so.
_LABEL = "label="


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased. Path: from there to `?`, `#` or the
    end. Both empty for null and where `://` is missing."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule as `host` + `path`, verdict) of the longest rule (verdict, host, path) that fits, else nulls. A rule fits its
    host and the hosts below it if the path starts with the rule's; equally long rules go by their text."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]), reverse=True):
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, say).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """Sorted distinct tokens: `h1=com`, `h2=example`, .. (labels from the right), `p1=en`, .. (path segments), `q=page` (query keys).
    Runs of digits count as `#`."""
    host, path = host_and_path(url)
    labels = F.reverse(F.split(host, r"\."))
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda s: F.regexp_extract(s, r"(?s)^[^=]*", 0))
    plain = lambda s: F.regexp_replace(s, "[0-9]+", "#")
    numbered = lambda xs, sign: F.transform(xs, lambda s, i: F.concat(F.lit(sign), (i + 1).cast("string"), F.lit("="), plain(s)))
    every = F.concat(numbered(F.filter(labels, lambda s: s != ""), "h"), numbered(segments, "p"), F.transform(F.filter(keys, lambda s: s != ""), lambda s: F.concat(F.lit("q="), plain(s))))
    return F.array_sort(F.array_distinct(F.coalesce(every, F.array().cast("array<string>"))))


def items_of(labelled: DataFrame, min_support: float) -> DataFrame:
    """(token, item) of the tokens with enough support in rows (tokens array<string>, label string): the least of all tokens that
    the same rows have. Rows are told apart by two hashes of tokens and label."""
    own = lambda seed: F.xxhash64(F.lit(seed), "tokens", "label").cast("decimal(20,0)")
    rows = labelled.filter("label is not null and size(tokens) > 0").select(own(1).alias("a"), own(2).alias("b"), F.explode("tokens").alias("token"))
    counts = rows.groupBy("token").agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    least = F.min("token").over(Window.partitionBy("n", "a", "b"))
    enough = min_support * labelled.filter("label is not null and size(tokens) > 0").count()
    return counts.filter(F.col("n") >= enough).select("token", least.alias("item"))


def mine(labelled: DataFrame, items: DataFrame, *, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (items, label, confidence, support, index) from rows (tokens array<string>, label string) and items_of() them.

    An item that only urls of one label have is a rule of confidence 1, which none with more items can beat: it is left out of the
    transactions, whose number stays. Of the other items, urls of t of them give up to 2^t / min_support itemsets, whatever the
    number of rows. Rows with a null label or without tokens are left out; none at all give no rules. index: the rule's rarest item
    among the labelled rows.
    """
    rows = labelled.filter("label is not null and size(tokens) > 0").groupBy("tokens", "label").agg(F.count("*").alias("n"))
    known = cut(rows.withColumn("token", F.explode("tokens")).join(items, "token").select("tokens", "label", "n", "item").distinct())
    counts = cut(known.groupBy("item").agg(F.sum("n").alias("n"), F.min("label").alias("label"), F.max("label").alias("other")))
    total = F.lit(max(1, rows.agg(F.sum("n")).first()[0] or 0))
    pure = counts.filter("label = other").select(F.array("item").alias("items"), "label", F.lit(1.0).alias("confidence"), (F.col("n") / total).alias("support"), F.col("item").alias("index"))

    open_items = known.join(counts.filter("label <> other").select("item"), "item").groupBy("tokens", "label").agg(F.collect_set("item").alias("items"))
    sets = rows.join(open_items, ["tokens", "label"], "left").withColumn("items", F.array_append(F.coalesce("items", F.array().cast("array<string>")), F.concat(F.lit(_LABEL), "label")))
    model = FPGrowth(itemsCol="items", minSupport=min_support).fit(sets.select("items", F.explode(F.sequence(F.lit(1), F.col("n")))).select("items"))
    rules = best_rules(model.freqItemsets, min_confidence).withColumn("support", F.col("both") / total)
    by_item = rules.withColumn("item", F.explode("items")).join(counts.select("item", "n"), "item")
    mined = by_item.groupBy("items", "label", "confidence", "support").agg(F.min_by("item", F.struct("n", "item")).alias("index"))
    return pure.filter(F.col("confidence") >= min_confidence).unionByName(mined)


def best_rules(itemsets: DataFrame, min_confidence: float) -> DataFrame:
    """Rules (items, label, both, confidence) from frequent itemsets (items, freq), labels among the items: those with enough
    confidence and more than any rule of the label has with fewer of the items. both: how many have the items and the label.

    Level by level: the best confidence of a rule's parts is that of the parts with one item less and of their parts.
    """
    is_label = lambda i: F.startswith(i, F.lit(_LABEL))
    plain = itemsets.filter(~F.exists("items", is_label)).select(F.array_sort("items").alias("items"), F.col("freq").alias("n"))
    named = itemsets.filter(F.exists("items", is_label)).select(
        F.array_sort(F.filter("items", lambda i: ~is_label(i))).alias("items"), F.substring(F.get(F.filter("items", is_label), F.lit(0)), len(_LABEL) + 1, 1 << 20).alias("label"), F.col("freq").alias("both")
    )
    rules = cut(named.join(plain, "items").select("items", "label", "both", (F.col("both") / F.col("n")).alias("confidence")))
    level = rules.filter("size(items) = 1").withColumn("best", F.col("confidence"))
    kept = level.filter(F.col("confidence") >= min_confidence)
    for size in range(2, (rules.agg(F.max(F.size("items"))).first()[0] or 0) + 1):
        parts = F.transform("items", lambda i: F.array_remove("items", i))
        here = rules.filter(F.size("items") == size).withColumn("part", F.explode(parts))
        had = here.join(level.select(F.col("items").alias("part"), "label", "best"), ["part", "label"])
        had = cut(had.groupBy("items", "label", "both", "confidence").agg(F.max("best").alias("had")))
        level = had.withColumn("best", F.greatest("confidence", "had"))
        kept = kept.unionByName(level.filter((F.col("confidence") >= min_confidence) & (F.col("had") < F.col("confidence"))).drop("had"))
    return kept.drop("best")


def match(urls: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct token sets of `urls` (tokens) with the label, confidence, support and tokens of the rule that decides; sets without one are absent."""
    sets = urls.select("tokens").distinct()
    has = sets.withColumn("token", F.explode("tokens")).join(items, "token").groupBy("tokens", "item").agg(F.min("token").alias("token"))
    has = has.groupBy("tokens").agg(F.map_from_entries(F.collect_list(F.struct("item", "token"))).alias("has"))
    near = has.withColumn("index", F.explode(F.map_keys("has"))).join(rules.select(F.col("items").alias("rule"), "label", "confidence", "support", "index"), "index")
    fit = near.filter(F.size(F.array_except("rule", F.map_keys("has"))) == 0).withColumn("rule_tokens", F.array_sort(F.transform("rule", lambda i: F.element_at("has", i))))
    best = F.min_by(F.struct("label", "confidence", "support", "rule_tokens"), F.struct(-F.col("confidence"), -F.col("support"), "rule_tokens"))
    return fit.groupBy("tokens").agg(best.alias("best")).select("tokens", "best.*")


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], labelled: DataFrame | None = None, *, id: str = "page_id", url: str = "url",
    min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, default: str = DEFAULT,
) -> DataFrame:
    """One row per row: id, host, path, rule, verdict, mined_tokens and confidence of the mined rule that decided.

    Verdict: the longest host and path rule's; else the best mined rule's; else `default`. labelled: (url, label) to mine
    from; None: the urls that a host and path rule fits, labelled by it. Null and malformed urls have an empty host and
    path and no tokens: the default. Repeated rows are judged alike; other columns are not looked at.
    """
    host, path = host_and_path(F.col("url"))
    split = pages.select(F.col(id).alias("id"), F.col(url).alias("url")).select("id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    split = split.select("id", "url", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
    if labelled is None:
        labelled = split.filter("verdict is not null").select("url", F.col("verdict").alias("label"))
    labelled = labelled.select(tokens(F.col("url")).alias("tokens"), "label")
    items = items_of(labelled, min_support)
    mined = mine(labelled, items, min_support=min_support, min_confidence=min_confidence)
    nothing = [F.lit(None).cast("array<string>").alias("mined_tokens"), F.lit(None).cast("double").alias("confidence")]
    ruled = split.filter("verdict is not null").select("id", "host", "path", "rule", "verdict", *nothing)
    rest = split.filter("verdict is null").withColumn("tokens", tokens(F.col("url")))
    bare = rest.filter("size(tokens) = 0").select("id", "host", "path", "rule", F.lit(default).alias("verdict"), *nothing)
    rest = rest.filter("size(tokens) > 0")
    other = rest.join(match(rest, mined, items), "tokens", "left").select("id", "host", "path", "rule", F.coalesce("label", F.lit(default)).alias("verdict"), F.col("rule_tokens").alias("mined_tokens"), "confidence")
    return ruled.unionByName(bare).unionByName(other).withColumnRenamed("id", id)
