"""Registered queries of the engine, and SQL that gives the same rows.

The driver's tables hold no molecules, so they stand in for them: lineitem for activities (part = structure, price = value,
ship year = document year), part for structures, orders for documents, supplier and nation for targets, brand for
scaffold, words of documents for structure strings, signs of embeddings for fingerprint bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import columns as fn
from .operators import assays, distributions, split, vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem")
    return line.withColumn("pvalue", fn.minus_log10(F.col("l_extendedprice"))).withColumn("year", F.year("l_shipdate"))


ACT = "act AS (SELECT *, -log10(l_extendedprice / 1e9) AS pvalue, year(l_shipdate) AS year FROM lineitem)"
ORDER = ["year", *[c for c in LINE if c != "l_partkey"]]
BY = ", ".join(ORDER)
ranked = ORDER


# Sources and joins


@query("""SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice, s_name, n_name, p_brand, o_orderpriority FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN orders ON l_orderkey = o_orderkey WHERE n_name = (SELECT min(n_name) FROM nation)""")
def fetch_activities(spark, sf_dir):
    nation = read(spark, sf_dir, "nation")
    target = nation.join(nation.agg(F.min("n_name").alias("wanted")), F.col("n_name") == F.col("wanted"), "left_semi")
    supplier = read(spark, sf_dir, "supplier").join(target, F.col("s_nationkey") == F.col("n_nationkey"))
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    found = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    found = found.join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"), "left").join(read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return found.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "s_name", "n_name", "p_brand", "o_orderpriority")


@query("SELECT count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE n_name = (SELECT min(n_name) FROM nation)")
def count_probe(spark, sf_dir):
    return fetch_activities(spark, sf_dir).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def fetch_limited(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(100)


@query("SELECT o_orderkey, l_linenumber, l_extendedprice FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey")
def left_join_documents(spark, sf_dir):
    return read(spark, sf_dir, "orders").join(read(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "l_linenumber", "l_extendedprice")


# Filters and labels


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'N' AND l_linestatus = 'O' AND l_quantity IS NOT NULL AND l_extendedprice > 0
AND NOT regexp_matches(p_type, 'promo|economy', 'i') AND NOT regexp_matches(p_name, 'green', 'i')""")
def assay_filter(spark, sf_dir):
    part = read(spark, sf_dir, "part").where(~fn.mentions(F.col("p_type"), "promo|economy") & ~fn.mentions(F.col("p_name"), "green"))
    line = read(spark, sf_dir, "lineitem").where("l_returnflag = 'N' AND l_linestatus = 'O' AND l_quantity IS NOT NULL AND l_extendedprice > 0")
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("SELECT l_returnflag, l_linestatus, n, round(100.0 * n / (SELECT count(*) FROM lineitem), 4) AS percent FROM (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL) ORDER BY n DESC, l_returnflag, l_linestatus LIMIT 5")
def condition_top_n(spark, sf_dir):
    return assays.condition_frequency(read(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], 5)


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(-log10(l_extendedprice / 1e9), 6) AS pvalue FROM lineitem")
def pvalue(spark, sf_dir):
    return activities(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", F.round("pvalue", 6).alias("pvalue"))


@query("SELECT n_name, coalesce(label, 'unmapped') AS label FROM nation LEFT JOIN (VALUES ('CHINA', 'east'), ('FRANCE', 'west')) m(name, label) ON n_name = name")
def lookup_label(spark, sf_dir):
    names = F.create_map(*[F.lit(x) for x in ("CHINA", "east", "FRANCE", "west")])
    return read(spark, sf_dir, "nation").select("n_name", F.coalesce(F.try_element_at(names, F.col("n_name")), F.lit("unmapped")).alias("label"))


# Suspicious values, duplicates, representatives


@query(f"WITH {ACT} SELECT DISTINCT x.l_partkey FROM act x JOIN act y ON x.l_partkey = y.l_partkey AND abs(y.pvalue - x.pvalue - 1) < 1e-4")
def suspicious_keys(spark, sf_dir):
    return assays.suspicious_keys(activities(spark, sf_dir), "l_partkey", "pvalue", 1e-4, (1.0, 3.0))


@query(f"WITH {ACT}, bad AS (SELECT DISTINCT x.l_partkey FROM act x JOIN act y ON x.l_partkey = y.l_partkey AND abs(y.pvalue - x.pvalue - 1) < 1e-4) SELECT l_orderkey, l_linenumber, l_partkey FROM act WHERE l_partkey NOT IN (SELECT l_partkey FROM bad)")
def drop_suspicious(spark, sf_dir):
    act = activities(spark, sf_dir)
    return assays.drop_suspicious(act, assays.suspicious_keys(act, "l_partkey", "pvalue", 1e-4, (1.0, 3.0)), "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


STATS = "SELECT l_partkey, round(avg(pvalue), 6) AS mean, round(min(pvalue), 6) AS min, round(max(pvalue), 6) AS max, round(coalesce(stddev_samp(pvalue), 0), 6) AS std, count(pvalue) AS count FROM act GROUP BY l_partkey"


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


@query(f"WITH {ACT} {STATS}")
def duplicate_stats(spark, sf_dir):
    return rounded(assays.duplicate_stats(activities(spark, sf_dir), "l_partkey", "pvalue"), "mean", "min", "max", "std")


@query(f"WITH {ACT} {STATS} HAVING coalesce(stddev_samp(pvalue), 0) < 0.5 AND max(pvalue) - min(pvalue) < 1.0")
def consistent_groups(spark, sf_dir):
    return rounded(assays.consistent(assays.duplicate_stats(activities(spark, sf_dir), "l_partkey", "pvalue"), 0.5, 1.0), "mean", "min", "max", "std")


@query(f"WITH {ACT} SELECT l_partkey, year, l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY {BY}) AS r FROM act) WHERE r = 1")
def earliest_representative(spark, sf_dir):
    return assays.earliest_rows(activities(spark, sf_dir), "l_partkey", ranked).select("l_partkey", "year", "l_orderkey", "l_linenumber", "l_extendedprice")


@query(f"""WITH {ACT}, s AS (SELECT l_partkey, avg(pvalue) AS m, min(pvalue) AS lo, max(pvalue) AS hi, coalesce(stddev_samp(pvalue), 0) AS sd, count(pvalue) AS n FROM act WHERE l_returnflag = 'N' GROUP BY l_partkey),
r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY {BY}) AS r FROM act WHERE l_returnflag = 'N')
SELECT r.l_partkey, r.year, r.l_orderkey, r.l_linenumber, round(m, 6) AS pvalue, round(lo, 6) AS min, round(hi, 6) AS max, round(sd, 6) AS std, n AS count FROM r JOIN s USING (l_partkey) WHERE r.r = 1 AND sd < 0.5 AND hi - lo < 1.0
AND r.l_partkey NOT IN (SELECT x.l_partkey FROM act x JOIN act y ON x.l_partkey = y.l_partkey AND abs(y.pvalue - x.pvalue - 1) < 1e-4 WHERE x.l_returnflag = 'N' AND y.l_returnflag = 'N')""")
def curated_activities(spark, sf_dir):
    kept = activities(spark, sf_dir).where("l_returnflag = 'N'")
    clean = assays.drop_suspicious(kept, assays.suspicious_keys(kept, "l_partkey", "pvalue", 1e-4, (1.0, 3.0)), "l_partkey")
    best = assays.representatives(clean, "l_partkey", "pvalue", ranked, 0.5, 1.0)
    return rounded(best.select("l_partkey", "year", "l_orderkey", "l_linenumber", "pvalue", "min", "max", "std", "count"), "pvalue", "min", "max", "std")


@query("SELECT l_partkey, count(DISTINCT l_suppkey) AS n_ids FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def conflicting_ids(spark, sf_dir):
    return assays.conflicting_ids(read(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


@query("SELECT count(*) AS groups, count(*) FILTER (n = 1) AS singles, count(*) FILTER (n > 1 AND ok) AS aggregated, count(*) FILTER (NOT ok) AS removed FROM (SELECT count(*) AS n, coalesce(stddev_samp(v), 0) < 0.5 AND max(v) - min(v) < 1 AS ok FROM (SELECT l_partkey, -log10(l_extendedprice / 1e9) AS v FROM lineitem) GROUP BY l_partkey)")
def aggregation_summary(spark, sf_dir):
    return assays.summary(assays.duplicate_stats(activities(spark, sf_dir), "l_partkey", "pvalue"), 0.5, 1.0)


def _dedup(keep):
    def run(spark, sf_dir):
        docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
        return assays.dedup(docs, ["text"], [F.col("doc_id")], keep).select("doc_id", "lang")

    return run


for _name, _keep, _sql in (("dedup_first", "first", "row_number() OVER (PARTITION BY text ORDER BY doc_id)"), ("dedup_last", "last", "row_number() OVER (PARTITION BY text ORDER BY doc_id DESC)"), ("dedup_none", False, "count(*) OVER (PARTITION BY text)")):
    QUERIES[_name] = _dedup(_keep)
    ORACLE_SQL[_name] = f"SELECT doc_id, lang FROM (SELECT *, {_sql} AS r FROM documents) WHERE r = 1"


@query("SELECT count(*) AS rows, count(DISTINCT text) AS texts FROM documents")
def duplicate_probe(spark, sf_dir):
    return read(spark, sf_dir, "documents").agg(F.count("*").alias("rows"), F.count_distinct("text").alias("texts"))


# Tokens and vocabularies

TOK = r"tok AS (SELECT doc_id, list_concat(['^'], regexp_extract_all(text, '(?s)(\[[^\]]*\]|%[0-9]{2}|Br|Cl|.)', 1), ['$']) AS tokens FROM documents)"
VOC = "voc AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS id FROM (SELECT DISTINCT unnest(tokens) AS token FROM tok))"


def tokenized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", fn.tokenize(F.col("text")).alias("tokens"))


@query(f"WITH {TOK} SELECT doc_id, array_to_string(tokens, '|') AS tokens FROM tok")
def tokenize(spark, sf_dir):
    return tokenized(spark, sf_dir).select("doc_id", F.array_join("tokens", "|").alias("tokens"))


@query(f"WITH {TOK} SELECT doc_id, len(tokens)::BIGINT AS seqlen FROM tok")
def token_count(spark, sf_dir):
    return tokenized(spark, sf_dir).select("doc_id", F.size("tokens").cast("long").alias("seqlen"))


@query(f"WITH {TOK} SELECT doc_id, array_to_string(list_filter(tokens[1 : list_position(tokens, '$') - 1], lambda x: x <> '^'), '') AS text FROM tok")
def untokenize(spark, sf_dir):
    return tokenized(spark, sf_dir).select("doc_id", fn.untokenize(F.col("tokens")).alias("text"))


@query(f"WITH {TOK}, {VOC} SELECT token, id FROM voc")
def token_vocabulary(spark, sf_dir):
    return vocabulary.ids_frame(tokenized(spark, sf_dir))


@query(f"WITH {TOK}, {VOC} SELECT doc_id, string_agg(id::VARCHAR, ' ' ORDER BY i) AS ids FROM (SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS i FROM tok) JOIN voc USING (token) GROUP BY doc_id")
def encode(spark, sf_dir):
    tok = tokenized(spark, sf_dir)
    ids = F.create_map(*[F.lit(x) for r in vocabulary.ids_frame(tok).collect() for x in (r.token, int(r.id))])  # a row for each distinct character
    return tok.select("doc_id", F.array_join(fn.encode(F.col("tokens"), ids).cast("array<string>"), " ").alias("ids"))


DIFF = "a AS (SELECT DISTINCT token FROM (SELECT unnest(tokens) AS token FROM tok JOIN documents USING (doc_id) WHERE lang = 'en')), b AS (SELECT DISTINCT token FROM (SELECT unnest(tokens) AS token FROM tok JOIN documents USING (doc_id) WHERE lang = 'de'))"


@query(f"WITH {TOK}, {DIFF} SELECT token, 'unused' AS side FROM a WHERE token NOT IN (SELECT token FROM b) UNION ALL SELECT token, 'new' FROM b WHERE token NOT IN (SELECT token FROM a)")
def vocab_diff(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("lang", F.explode(fn.tokenize(F.col("text"))).alias("token")).distinct()
    side = lambda lang: docs.where(F.col("lang") == lang).select("token")
    return vocabulary.difference(side("en"), side("de"))


@query(f"WITH {TOK} SELECT DISTINCT unnest(tokens) AS token FROM tok JOIN documents USING (doc_id) WHERE lang IN ('en', 'fr')")
def vocab_union(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    side = lambda lang: docs.where(F.col("lang") == lang).select(F.explode(F.array_distinct(fn.tokenize(F.col("text")))).alias("token"))
    return side("en").union(side("fr")).distinct()


FREQ = "freq AS (SELECT token, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM tok), 6) AS percent FROM (SELECT doc_id, unnest(list_distinct(tokens)) AS token FROM tok) GROUP BY token)"


@query(f"WITH {TOK}, {FREQ} SELECT token, n, percent FROM freq")
def token_doc_freq(spark, sf_dir):
    return distributions.token_frequency(tokenized(spark, sf_dir))


@query(f"WITH {TOK}, {FREQ} SELECT doc_id FROM tok WHERE NOT list_has_any(tokens, (SELECT list(token) FROM freq WHERE percent < 5))")
def rare_token_filter(spark, sf_dir):
    tok = tokenized(spark, sf_dir)
    rare = [r.token for r in distributions.token_frequency(tok).where("percent < 5").collect()]
    return tok.where(fn.no_rare_tokens(F.col("tokens"), rare)).select("doc_id")


@query(f"WITH {TOK}, known AS (SELECT list(DISTINCT token) AS k FROM (SELECT unnest(tokens) AS token FROM tok JOIN documents USING (doc_id) WHERE lang = 'en')) SELECT doc_id FROM tok, known WHERE list_has_all(k, tokens)")
def unknown_token_filter(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", fn.tokenize(F.col("text")).alias("tokens"))
    known = [r.t for r in docs.where("lang = 'en'").select(F.explode("tokens").alias("t")).distinct().collect()]
    return docs.where(fn.known_tokens(F.col("tokens"), known)).select("doc_id")


# Distributions

PROPS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _skew(c):
    return f"(avg({c}*{c}*{c}) - 3*avg({c})*avg({c}*{c}) + 2*avg({c})**3) / pow(var_pop({c}), 1.5)"


@query(" UNION ALL ".join(f"SELECT '{c}' AS property, count({c}) AS count, round_even(avg({c}), 2) AS mean, round_even(stddev_samp({c}), 2) AS std, round_even(min({c}), 2) AS min, round_even(max({c}), 2) AS max, round_even(quantile_cont({c}, 0.5), 2) AS median, round_even({_skew(c)}, 2) + 0.0 AS skew, round_even(kurtosis_pop({c}), 2) AS kurtosis FROM lineitem" for c in PROPS))
def distribution_stats(spark, sf_dir):
    found = distributions.statistics(read(spark, sf_dir, "lineitem"), PROPS)
    return found.withColumn("skew", F.col("skew") + 0.0)  # no negative zero


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_quantity BETWEEN 5 AND 30 AND l_extendedprice <= 50000")
def filter_absolute(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem")
    limits = distributions.bounds(line, {"l_quantity": distributions.Threshold(min_value=5, max_value=30), "l_extendedprice": distributions.Threshold(max_value=50000)})
    return line.where(fn.within(F.col("l_quantity"), *limits["l_quantity"]) & fn.within(F.col("l_extendedprice"), *limits["l_extendedprice"])).select("l_orderkey", "l_linenumber", "l_partkey")


@query("WITH b AS (SELECT round_even(avg(l_extendedprice), 2) AS m, round_even(stddev_samp(l_extendedprice), 2) AS s FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem, b WHERE l_extendedprice BETWEEN greatest(0, m - 1.5 * s) AND greatest(0, m + 1.5 * s)")
def filter_statistical(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem")
    limits = distributions.bounds(line, {"l_extendedprice": distributions.Threshold(statistical_lower=-1.5, statistical_upper=1.5)})
    return line.where(fn.within(F.col("l_extendedprice"), *limits["l_extendedprice"])).select("l_orderkey", "l_linenumber", "l_partkey")


@query("WITH b AS (SELECT quantile_cont(l_extendedprice, 0.05) AS lo, quantile_cont(l_extendedprice, 0.9) AS hi FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem, b WHERE l_extendedprice BETWEEN lo AND hi")
def filter_quantile(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem")
    limits = distributions.bounds(line, {"l_extendedprice": distributions.Threshold(quantile_lower=0.05, quantile_upper=0.9)})
    return line.where(fn.within(F.col("l_extendedprice"), *limits["l_extendedprice"])).select("l_orderkey", "l_linenumber", "l_partkey")


FLAG = """tok2 AS (SELECT doc_id, n_chars::DOUBLE AS n_chars, tokens, (SELECT list(token) FROM freq WHERE percent < 5) AS rare FROM tok JOIN documents USING (doc_id)),
flag AS (SELECT doc_id, n_chars BETWEEN 400 AND 5000 AS properties_ok, NOT list_has_any(tokens, rare) AS tokens_ok, concat_ws('; ', CASE WHEN n_chars < 400 THEN 'n_chars:low' END, CASE WHEN n_chars > 5000 THEN 'n_chars:high' END, CASE WHEN list_has_any(tokens, rare) THEN 'tokens:rare' END) AS failures FROM tok2)"""


def _flagged(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("double").alias("n_chars"), fn.tokenize(F.col("text")).alias("tokens"))
    rare = [r.token for r in distributions.token_frequency(docs).where("percent < 5").collect()]
    return distributions.curate(docs, {"n_chars": (400.0, 5000.0)}, rare=rare, drop=False)


@query(f"WITH {TOK}, {FREQ}, {FLAG} SELECT doc_id, failures, properties_ok AND tokens_ok AS success FROM flag")
def filter_failures(spark, sf_dir):
    return _flagged(spark, sf_dir).select("doc_id", "failures", "success")


@query(f"WITH {TOK}, {FREQ}, {FLAG} SELECT count(*) AS total, count(*) FILTER (NOT properties_ok) AS removed_by_property, count(*) FILTER (properties_ok AND NOT tokens_ok) AS removed_by_token, count(*) FILTER (properties_ok AND tokens_ok) AS retained FROM flag")
def filter_funnel(spark, sf_dir):
    return distributions.funnel(_flagged(spark, sf_dir))


@query("SELECT property, passed, n - passed AS removed, round(passed / n, 6) AS pass_rate FROM (SELECT 'l_quantity' AS property, count(*) FILTER (l_quantity BETWEEN 5 AND 30) AS passed, count(*) AS n FROM lineitem UNION ALL SELECT 'l_tax', count(*) FILTER (l_tax <= 0.04), count(*) FROM lineitem)")
def property_pass_counts(spark, sf_dir):
    return distributions.pass_counts(read(spark, sf_dir, "lineitem"), {"l_quantity": (5.0, 30.0), "l_tax": (None, 0.04)})


@query("WITH b AS (SELECT quantile_cont(l_extendedprice, 0.01) AS lo, quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem) SELECT least(floor((l_extendedprice - lo) / ((hi - lo) / 50)), 49)::INTEGER AS bin, round(min(lo + (hi - lo) / 50 * least(floor((l_extendedprice - lo) / ((hi - lo) / 50)), 49)), 4) AS low, count(*) AS n FROM lineitem, b WHERE l_extendedprice BETWEEN lo AND hi GROUP BY bin")
def histogram(spark, sf_dir):
    return distributions.histogram(read(spark, sf_dir, "lineitem"), "l_extendedprice").select("bin", F.round("low", 4).alias("low"), "n")


@query("WITH m AS (SELECT avg(p_size) AS ma, stddev_pop(p_size) AS sa, avg(p_retailprice) AS mb, stddev_pop(p_retailprice) AS sb FROM part) SELECT p_partkey, round(abs((p_size - ma) / sa + (p_retailprice - mb) / sb) / sqrt(2), 6) AS plus, round(abs((p_size - ma) / sa - (p_retailprice - mb) / sb) / sqrt(2), 6) AS minus FROM part, m")
def pca_coords(spark, sf_dir):
    """Of two standardised columns the axes are their sum and their difference; which comes first depends on their correlation."""
    sizes = read(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("size"), "p_retailprice")
    found, _ = distributions.with_components(sizes, ["size", "p_retailprice"])
    same = sizes.agg(F.corr("size", "p_retailprice") >= 0).first()[0]
    x, y = F.round(F.abs("distribution_pca_x"), 6), F.round(F.abs("distribution_pca_y"), 6)
    return found.select("p_partkey", (x if same else y).alias("plus"), (y if same else x).alias("minus"))


# Splits

UNITS = "u AS (SELECT unit, size, row_number() OVER (ORDER BY first, unit) - 1 AS pos FROM (SELECT p_name AS unit, count(*) AS size, min(p_partkey) AS first FROM part GROUP BY p_name))"


def _units(spark, sf_dir):
    return split.units(read(spark, sf_dir, "part"), "p_name", F.col("p_partkey"))


@query(f"WITH {UNITS} SELECT unit, pos, size FROM u")
def unit_numbering(spark, sf_dir):
    return _units(spark, sf_dir)


GREEDY = f"""{UNITS}, tot AS (SELECT count(*) AS n FROM part), f AS (SELECT *, coalesce(sum(size) OVER (ORDER BY size DESC, pos DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, greatest(1, round_even(n * 0.1, 0)) AS t FROM u, tot),
sp AS (SELECT unit, size, CASE WHEN before < t THEN 'test' WHEN before - (SELECT max(before + size) FROM f WHERE before < t) < t THEN 'val' ELSE 'train' END AS split FROM f)"""


def _split(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    return split.greedy_fill(_units(spark, sf_dir), F.struct(-F.col("size"), -F.col("pos")), part.count())


@query(f"WITH {GREEDY} SELECT unit, split FROM sp")
def split_greedy(spark, sf_dir):
    return _split(spark, sf_dir).select("unit", "split")


@query()
def split_random(spark, sf_dir):
    found = _units(spark, sf_dir)
    ranks = split.random_ranks(found, found.count())
    return split.greedy_fill(found.join(ranks, "pos"), F.col("rank"), read(spark, sf_dir, "part").count()).select("unit", "split")


SPLIT = f"{GREEDY}, lab AS (SELECT p_partkey, p_brand AS scaffold, p_retailprice, split FROM part JOIN sp ON p_name = unit)"


def _labelled(spark, sf_dir):
    labels = _split(spark, sf_dir).select(F.col("unit").alias("p_name"), "split")
    return read(spark, sf_dir, "part").join(labels, "p_name").select("p_partkey", F.col("p_brand").alias("scaffold"), "p_retailprice", "split")


@query(f"WITH {SPLIT} SELECT split, count(*) AS n, round_even(count(*) / (SELECT count(*) FROM lab), 4) AS ratio FROM lab GROUP BY split")
def split_composition(spark, sf_dir):
    return split.composition(_labelled(spark, sf_dir))


@query(f"WITH {SPLIT}, c AS (SELECT split, scaffold, count(*) AS n FROM lab GROUP BY ALL) SELECT split, count(*) AS n_scaffolds, count(*) FILTER (n = 1) AS n_singletons, round(count(*) FILTER (n = 1) / count(*), 6) AS singleton_fraction, CASE WHEN count(*) > 1 THEN round(-sum(n / t * log2(n / t)) / log2(count(*)), 6) END AS entropy FROM (SELECT *, sum(n) OVER (PARTITION BY split) AS t FROM c) GROUP BY split")
def scaffold_entropy(spark, sf_dir):
    return split.scaffold_stats(_labelled(spark, sf_dir))


@query(f"WITH {SPLIT}, s AS (SELECT scaffold, bool_or(split = 'train') AS a, bool_or(split = 'val') AS b, bool_or(split = 'test') AS c FROM lab GROUP BY scaffold) SELECT count(*) FILTER (c AND a) AS test_train, count(*) FILTER (b AND a) AS val_train, count(*) FILTER (c AND b) AS test_val FROM s")
def scaffold_overlap(spark, sf_dir):
    return split.scaffold_overlap(_labelled(spark, sf_dir))


@query("SELECT p_brand, n, row_number() OVER w AS rank, sum(n) OVER (w ROWS UNBOUNDED PRECEDING)::BIGINT AS cumulative FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand) WINDOW w AS (ORDER BY n DESC, p_brand)")
def retrieval_curve(spark, sf_dir):
    return split.retrieval_curve(read(spark, sf_dir, "part"), "p_brand")


BITS = "e AS (SELECT vec_id AS id, label, embedding AS v FROM embeddings)"
PAIR = f"{BITS}, pr AS (SELECT x.id AS a, y.id AS b, CASE WHEN len(list_filter(list_zip(x.v, y.v), lambda t: t[1] > 0 OR t[2] > 0)) > 0 THEN 1 - len(list_filter(list_zip(x.v, y.v), lambda t: t[1] > 0 AND t[2] > 0)) / len(list_filter(list_zip(x.v, y.v), lambda t: t[1] > 0 OR t[2] > 0)) ELSE 1 END AS distance FROM e x JOIN e y ON x.id < y.id)"


def _vectors(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"), "label", fn.on_bits(F.col("embedding")).alias("bits"))


@query(f"WITH {PAIR} SELECT a, b, round(distance, 6) AS distance FROM pr")
def tanimoto_pairs(spark, sf_dir):
    found = split.pairs(_vectors(spark, sf_dir), None)
    return found.withColumn("distance", F.floor(F.col("distance") * 1e6 + 0.5) / 1e6)  # as round(), but not by decimals, which take longer than the pairs


@query(f"WITH {PAIR}, both_ways AS (SELECT a AS id, b AS other, distance FROM pr UNION ALL SELECT b, a, distance FROM pr) SELECT id, round(sum(distance * (o.label + 1)) / sum(o.label + 1), 6) AS score FROM both_ways JOIN (SELECT id AS other, label FROM e) o USING (other) GROUP BY id")
def isolation_scores(spark, sf_dir):
    sized = _vectors(spark, sf_dir).withColumn("size", (F.col("label") + 1).cast("long"))
    return rounded(split.isolation(sized, None), "score")


@query(f"""WITH {PAIR}, l AS (SELECT id, CASE WHEN label = 0 THEN 'test' WHEN label = 1 THEN 'val' ELSE 'train' END AS split FROM e), w AS (SELECT a, b, distance FROM pr UNION ALL SELECT b, a, distance FROM pr),
n AS (SELECT w.a, x.split AS query, y.split AS reference, min(distance) AS d FROM w JOIN l x ON x.id = w.a JOIN l y ON y.id = w.b GROUP BY ALL)
SELECT query, reference, round(avg(d), 6) AS mean, round(quantile_cont(d, 0.5), 6) AS median, round(quantile_cont(d, 0.1), 6) AS p10, round(quantile_cont(d, 0.9), 6) AS p90, count(*) AS n FROM n GROUP BY ALL""")
def nn_distances(spark, sf_dir):
    label = F.when(F.col("label") == 0, "test").when(F.col("label") == 1, "val").otherwise("train")
    return rounded(split.nearest_summary(_vectors(spark, sf_dir).withColumn("split", label), None), "mean", "median", "p10", "p90")


@query(f"WITH {SPLIT} SELECT split, round(avg(p_retailprice), 6) AS mean, round(stddev_pop(p_retailprice), 6) AS std, count(p_retailprice) AS n FROM lab GROUP BY split")
def activity_by_split(spark, sf_dir):
    return rounded(split.activity_summary(_labelled(spark, sf_dir), "p_retailprice"), "mean", "std")


@query(f"""WITH {SPLIT}, c AS (SELECT p_retailprice AS v, count(*) FILTER (split = 'train') AS a, count(*) FILTER (split = 'test') AS b FROM lab WHERE split IN ('train', 'test') GROUP BY 1),
r AS (SELECT sum(a) OVER (ORDER BY v) AS ra, sum(b) OVER (ORDER BY v) AS rb, sum(a) OVER () AS ta, sum(b) OVER () AS tb FROM c) SELECT round(max(abs(ra / ta - rb / tb)), 6) AS statistic, max(ta)::BIGINT AS n_a, max(tb)::BIGINT AS n_b FROM r""")
def ks_statistic(spark, sf_dir):
    return rounded(split.ks_statistic(_labelled(spark, sf_dir), "p_retailprice"), "statistic")


@query("SELECT p_partkey, CASE WHEN p_size > 0 THEN round(p_retailprice / p_size, 6) ELSE 0.0 END AS ratio FROM part")
def safe_ratios(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", F.round(fn.safe_ratio(F.col("p_retailprice"), F.col("p_size")), 6).alias("ratio"))


# Operators on activity columns, made from the tables by projection

SHAPED = """s AS (SELECT l_orderkey AS activity_id, l_linenumber AS line, p_type AS canonical_smiles, l_extendedprice AS standard_value, CASE l_returnflag WHEN 'N' THEN 'nM' ELSE 'uM' END AS standard_units, CASE l_linestatus WHEN 'O' THEN 'IC50' ELSE 'Ki' END AS standard_type,
CASE WHEN l_linenumber < 6 THEN '=' ELSE '>' END AS standard_relation, CASE WHEN l_quantity > 2 THEN 1 ELSE 0 END AS standard_flag, CASE WHEN l_quantity > 48 THEN 1 ELSE 0 END AS potential_duplicate, CASE WHEN l_discount > 0.01 THEN l_discount END AS pchembl_value,
CASE WHEN l_tax > 0.07 THEN 'odd' END AS data_validity_comment, year(l_shipdate) AS document_year, p_brand AS document_chembl_id, CASE WHEN p_size > 3 THEN 'B' ELSE 'F' END AS assay_type, p_name AS assay_description, 'Homo sapiens' AS target_organism,
CASE WHEN p_size > 5 THEN 'BAO_0000357' WHEN p_size > 4 THEN 'BAO_0000219' ELSE 'x' END AS bao_format FROM lineitem JOIN part ON l_partkey = p_partkey)"""
USABLE = "standard_flag = 1 AND potential_duplicate = 0 AND standard_value IS NOT NULL AND canonical_smiles IS NOT NULL AND document_year IS NOT NULL AND document_chembl_id IS NOT NULL AND data_validity_comment IS NULL AND pchembl_value IS NOT NULL"
PASSED = f"standard_type = 'IC50' AND assay_type = 'B' AND target_organism = 'Homo sapiens' AND bao_format = 'BAO_0000357' AND standard_units = 'nM' AND standard_relation = '=' AND {USABLE} AND NOT regexp_matches(assay_description, 'green', 'i') AND NOT regexp_matches(assay_description, 'red', 'i')"
CONDITIONS = "standard_type, assay_type, target_organism, bao_format"
ASSAY = assays.AssayParams(mutant_regex="green", allosteric_regex="red")


def shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "part")
    chosen = SHAPED[SHAPED.index("SELECT") + 7 : SHAPED.index(" FROM lineitem")]
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).selectExpr(*[c.strip() for c in chosen.replace("\n", " ").split(", ")])


@query(f"WITH {SHAPED} SELECT activity_id, line, canonical_smiles, round(-log10(standard_value / 1e9), 6) AS \"pIC50\" FROM s WHERE {PASSED}")
def assay_rules(spark, sf_dir):
    done = assays.standardise(assays.assay_filter(shaped(spark, sf_dir), ASSAY), ASSAY)
    return rounded(done.select("activity_id", "line", "canonical_smiles", "pIC50"), "pIC50")


@query(f"""WITH {SHAPED}, r AS (SELECT 'RAW' AS subset, {CONDITIONS}, count(*) AS n FROM s GROUP BY ALL UNION ALL SELECT 'VALID', {CONDITIONS}, count(*) FROM s WHERE {USABLE} GROUP BY ALL),
t AS (SELECT *, round(100.0 * n / sum(n) OVER (PARTITION BY subset), 4) AS percent, row_number() OVER (PARTITION BY subset ORDER BY n DESC, {CONDITIONS}) AS k FROM r)
SELECT subset, {CONDITIONS}, n, percent, CASE bao_format WHEN 'BAO_0000357' THEN 'protein' WHEN 'BAO_0000219' THEN 'cell' ELSE 'unmapped' END AS format FROM t WHERE k <= 5""")
def condition_report(spark, sf_dir):
    return assays.condition_report(shaped(spark, sf_dir), ASSAY)


@query("""WITH v AS (SELECT l_partkey AS k, l_linenumber * 1.5 AS v FROM lineitem) SELECT DISTINCT a.k AS l_partkey FROM v a JOIN v b ON a.k = b.k AND abs(b.v - a.v - 3) < 1e-4""")
def suspicious_keys_gap3(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_linenumber") * 1.5).alias("v"))
    return assays.suspicious_keys(line, "l_partkey", "v", 1e-4)


@query("WITH v AS (SELECT l_suppkey AS k, l_extendedprice AS v, row_number() OVER () AS i FROM lineitem) SELECT DISTINCT a.k AS l_suppkey FROM v a JOIN v b ON a.k = b.k AND a.i < b.i AND abs(b.v - a.v) <= 0.01")
def repeated_keys(spark, sf_dir):
    return assays.repeated_keys(read(spark, sf_dir, "lineitem"), "l_suppkey", "l_extendedprice", 0.01)


@query(f"WITH {TOK}, {VOC} SELECT doc_id, array_to_string(tokens, '|') AS tokens FROM tok")
def decode(spark, sf_dir):
    tok = tokenized(spark, sf_dir)
    known = vocabulary.Vocabulary.from_frame(tok)
    ids = fn.encode(F.col("tokens"), known.as_map())
    return tok.select("doc_id", F.array_join(fn.decode(ids, known.as_inverse_map()), "|").alias("tokens"))


@query("SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN round(c_nationkey / c_acctbal, 6) END AS ratio FROM customer")
def token_atom_ratios(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", F.round(fn.token_atom_ratio(F.col("c_nationkey"), F.col("c_acctbal")), 6).alias("ratio"))


@query(f"WITH {SPLIT} SELECT split, count(*) AS n_total, count(CASE WHEN p_retailprice > 950 THEN 1 END) AS n_valid, count(*) - count(CASE WHEN p_retailprice > 950 THEN 1 END) AS n_failed FROM lab GROUP BY split")
def fingerprint_counts(spark, sf_dir):
    bits = F.when(F.col("p_retailprice") > 950, F.array(F.lit(1)))
    return split.fingerprint_qc(_labelled(spark, sf_dir).withColumn("bits", bits))


@query(f"WITH {PAIR}, both_ways AS (SELECT a AS id, b AS other, distance FROM pr UNION ALL SELECT b, a, distance FROM pr), sc AS (SELECT id, round(sum(distance * (o.label + 1)) / sum(o.label + 1), 6) AS score FROM both_ways JOIN (SELECT id AS other, label FROM e) o USING (other) GROUP BY id), f AS (SELECT id, label + 1 AS size, coalesce(sum(label + 1) OVER (ORDER BY score DESC, id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, greatest(1, round_even((SELECT sum(label + 1) FROM e) * 0.1, 0)) AS t FROM sc JOIN e USING (id)) SELECT id, CASE WHEN before < t THEN 'test' WHEN before - (SELECT max(before + size) FROM f WHERE before < t) < t THEN 'val' ELSE 'train' END AS split FROM f")
def split_isolation(spark, sf_dir):
    sized = _vectors(spark, sf_dir).withColumn("size", (F.col("label") + 1).cast("long"))
    scores = rounded(split.isolation(sized, None), "score").join(sized.select("id", "size"), "id")
    total = sized.agg(F.sum("size")).first()[0]
    return split.greedy_fill(split.isolation_ranks(scores, "id"), F.col("rank"), total).select("id", "split")
