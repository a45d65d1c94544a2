"""URL verdicts: explicit host and path rules first, then association rules mined from labelled URLs. DataFrame operations only.

A URL becomes a short set of tokens (host labels, directories, file type, query keys ...). Tokens that stand in exactly the
same labelled URLs are one class: rules with one or the other are the same rule, and mining them apart would double the
work with each. FP-growth finds the sets of classes that enough blocked URLs have; how many of all labelled URLs have them
gives confidence and lift. A rule sits in an inverted index under the members of its rarest class; a URL has the rule if
it holds a member of each class. The best rule's confidence goes with the URL, and blocks it from MIN_CONFIDENCE on.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: (verdict, host, path)
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]
#: Blocked URLs that a rule needs, how many times the blocked share of all labelled URLs its own must be, and the share that blocks.
MIN_COUNT, MIN_LIFT, MIN_CONFIDENCE = 20, 1.2, 0.6
#: Rules, or token sets that have one, that are broadcast after counting them; beyond it they are joined by shuffle, in SALTS parts.
BROADCAST_ROWS, SALTS = 50_000, 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without '://' or for null."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (n, rule, verdict); null if none does."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in rules]
    return F.array_max(F.array(*fits))


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens without bare numbers, sorted."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host="), x))
    folders = F.transform(F.filter(F.split(path, "/"), lambda x: ~x.rlike(r"^[0-9]*(\.[A-Za-z0-9]+)?$")), lambda x: F.concat(F.lit("path="), x))
    more = F.array(
        F.concat(F.lit("scheme="), F.regexp_extract(url, r"^([A-Za-z]+)://", 1)),
        F.concat(F.lit("type="), F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)),
        F.concat(F.lit("mark="), F.regexp_extract(url, r"#([^#?=&]*)", 1)),
    )
    keys = F.transform(F.regexp_extract_all(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(r"([^&=]+)=?[^&]*"), 1), lambda x: F.concat(F.lit("query="), x))
    return F.coalesce(F.array_sort(F.array_distinct(F.filter(F.concat(labels, folders, more, keys), lambda x: ~x.endswith("=")))), F.array().cast("array<string>"))


_RULES = "tokens array<string>, wanted array<array<string>>, n long, confidence double, lift double"


def mine(labelled: DataFrame, min_count: int = MIN_COUNT, min_lift: float = MIN_LIFT) -> DataFrame:
    """Rules from rows (tokens array, bad boolean): every set of token classes that min_count blocked rows have, with lift.

    tokens has one member of each class, wanted has them all.
    """
    spark = labelled.sparkSession
    sets = written(labelled.groupBy("tokens").agg(F.count_if("bad").alias("n_bad"), F.count("*").alias("n_all")), "token-sets")
    n_bad, n_all = sets.agg(F.coalesce(F.sum("n_bad"), F.lit(0)), F.sum("n_all")).first()
    if n_bad < min_count:
        return spark.createDataFrame([], _RULES)
    each = sets.select(F.explode("tokens").alias("token"), F.xxhash64("tokens").cast("decimal(20,0)").alias("h"), "n_bad", "n_all")
    held = each.groupBy("token").agg(F.sum("n_bad").alias("bad"), F.sum("n_all").alias("all"), F.sum("h").alias("h")).where(F.col("bad") >= min_count)
    classes = written(held.groupBy("bad", "all", "h").agg(F.array_sort(F.collect_list("token")).alias("members")), "token-classes")
    named = classes.select("members", F.col("members")[0].alias("name"), "all")
    member = named.select(F.explode("members").alias("token"), "name")
    baskets = sets.where("n_bad > 0").select("tokens", "n_bad", F.explode("tokens").alias("token")).join(member, "token").groupBy("tokens", "n_bad").agg(F.collect_set("name").alias("items"))
    baskets = baskets.select("items", F.explode(F.sequence(F.lit(1).cast("long"), "n_bad")).alias("copy")).select("items")
    need = max(min_count - 0.5, 0.5) / baskets.count()  # FP-growth rounds need * rows up: min_count, whatever the division loses
    mined = FPGrowth(itemsCol="items", minSupport=need, minConfidence=1.0).fit(baskets).freqItemsets
    found = written(mined.select(F.array_sort("items").alias("tokens"), F.col("freq").alias("n")), "itemsets")
    spread = found.select("tokens", "n", F.explode("tokens").alias("name")).join(named, "name").groupBy("tokens", "n")
    rules = written(spread.agg(F.collect_list("members").alias("wanted"), F.min(F.struct("all", "members"))["members"].alias("rarest")), "candidates")
    total = holders(sets, rules).groupBy("rule").agg(F.sum("n_all").alias("all")).withColumnRenamed("rule", "tokens")
    share = F.col("n") / F.col("all")
    known = rules.join(total, "tokens").select("tokens", "wanted", "n", share.alias("confidence"), (share * F.lit(n_all / n_bad)).alias("lift"), "rarest")
    return written(known.where(F.col("lift") >= min_lift), "rules")


def holders(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows of sets (tokens) with each rule they have: all columns of sets, rule, and confidence where rules has it."""
    index = rules.select(F.explode("rarest").alias("token"), "wanted", F.col("tokens").alias("rule"), *[c for c in rules.columns if c == "confidence"])
    index = F.broadcast(index) if index.count() <= BROADCAST_ROWS else index
    met = sets.withColumn("token", F.explode("tokens")).join(index, "token")
    return met.where(F.forall("wanted", lambda members: F.arrays_overlap(members, F.col("tokens")))).drop("token", "wanted").distinct()


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, min_count: int = MIN_COUNT, min_lift: float = MIN_LIFT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict, confidence for every page.

    A page's label is that of the document whose number ends its path's last folder or file; blocked means low quality or
    toxic. confidence is that of the best mined rule that the URL has, null without one; of equal ones any, the figure is the
    same. A null or odd url has empty host and path, no tokens and so is allowed; repeated rows are judged alike; without
    labels, or too few, only the explicit rules decide. Long URLs are read in whole: mining costs as much as there are sets of
    classes that min_count blocked URLs share. Empty tables give no rows; other columns are not read.
    """
    host, path = host_path(F.col("url"))
    parts = pages.select(F.col("page_id"), F.col("url"), host.alias("host"), path.alias("path"))
    parts = parts.select("page_id", "host", "path", fitting_rule(F.col("host"), F.col("path"), rules).alias("fit"), url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"), F.expr("try_cast(regexp_extract(path, '/([0-9]+)(/|[.][A-Za-z0-9]+)?$', 1) as bigint)").alias("doc_id"))
    bad = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)).alias("bad"))
    labelled = parts.where("doc_id is not null and size(tokens) > 0").select("doc_id", "tokens").join(bad, "doc_id").select("tokens", "bad")
    mined = mine(labelled, min_count, min_lift)
    if mined.isEmpty():
        joined = parts.withColumn("confidence", F.lit(None).cast("double"))
    else:
        met = written(holders(parts.select("tokens").distinct(), mined).groupBy("tokens").agg(F.max("confidence").alias("confidence")), "matched")
        if met.count() <= BROADCAST_ROWS:
            joined = parts.join(F.broadcast(met), "tokens", "left")
        else:  # a token set that a third of all pages have is SALTS tasks' work
            salt = F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(SALTS))
            joined = parts.withColumn("salt", salt).join(met.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), ["tokens", "salt"], "left")
    verdict = F.coalesce(F.col("fit.verdict"), F.when(F.col("confidence") >= min_confidence, "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), F.round("confidence", 6).alias("confidence"))


def oracle_sql(rules=RULES, min_count: int = MIN_COUNT, min_lift: float = MIN_LIFT, min_confidence: float = MIN_CONFIDENCE) -> str:
    """The same, with every token set of every URL counted outright."""
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return f"""
WITH r(verdict, host, path) AS (VALUES {values}),
u AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS i FROM u),
fit AS (SELECT i, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY i),
t AS (SELECT i, list_sort(list_distinct(list_filter(list_concat(
  list_transform(string_split(host, '.'), lambda x: 'host=' || x),
  list_transform(list_filter(string_split(path, '/'), lambda x: NOT regexp_matches(x, '^[0-9]*(\\.[A-Za-z0-9]+)?$')), lambda x: 'path=' || x),
  ['scheme=' || regexp_extract(url, '^([A-Za-z]+)://', 1), 'type=' || regexp_extract(path, '\\.([A-Za-z0-9]+)$', 1), 'mark=' || regexp_extract(url, '#([^#?=&]*)', 1)],
  list_transform(regexp_extract_all(regexp_extract(url, '\\?([^#]*)', 1), '([^&=]+)=?[^&]*', 1), lambda x: 'query=' || x)), lambda x: NOT ends_with(x, '=')))) AS tokens FROM p),
bad AS (SELECT doc_id, bool_or(quality = 0 OR toxic = 1) AS bad FROM labels GROUP BY doc_id),
lab AS (SELECT i, bad FROM p JOIN bad ON bad.doc_id = try_cast(regexp_extract(p.path, '/([0-9]+)(/|[.][A-Za-z0-9]+)?$', 1) AS BIGINT) JOIN t USING (i) WHERE len(tokens) > 0),
base AS (SELECT count(*) FILTER (bad) / count(*) AS share FROM lab),
m AS (SELECT i, tokens, unnest(range(1, (1 << len(tokens))::BIGINT)) AS m FROM t),
sets AS (SELECT i, list_filter(tokens, lambda x, k: (m >> (k - 1)::BIGINT) & 1 = 1) AS held FROM m),
good AS (SELECT held, count(*) FILTER (bad) / count(*) AS confidence FROM sets JOIN lab USING (i) GROUP BY held HAVING count(*) FILTER (bad) >= {min_count} AND count(*) FILTER (bad) / count(*) >= {min_lift} * (SELECT share FROM base)),
hit AS (SELECT i, max(confidence) AS confidence FROM sets JOIN good USING (held) GROUP BY i)
SELECT page_id, host, path, fit.rule, coalesce(fit.verdict, CASE WHEN confidence >= {min_confidence} THEN 'block' ELSE 'allow' END) AS verdict, round(confidence, 6) AS confidence
FROM p LEFT JOIN fit USING (i) LEFT JOIN hit USING (i)"""
