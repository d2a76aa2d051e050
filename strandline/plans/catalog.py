"""Named queries over the star-schema tables, each with its DuckDB equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.functions import alignment as A
from strandline.functions import columns as C
from strandline.functions import stats as S
from strandline.operators import joins as J
from strandline.operators import optimize as O
from strandline.operators import registry as G
from strandline.operators import relational as R
from strandline.operators import sampling as P
from strandline.operators import vectors as V
from strandline.session import table
from strandline.streaming import events as E

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under a name, with SQL that returns the same rows."""

    def keep(make: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = make
        if oracle is not None:
            ORACLES[name] = oracle
        return make

    return keep


@query(
    "range_join_annotate",
    """
    SELECT CASE WHEN o.o_orderstatus = 'F' THEN 'finished' WHEN o.o_orderstatus = 'O' THEN 'open'
                WHEN o.o_orderstatus IS NULL THEN 'unknown' ELSE 'other' END AS bucket,
           count(*) AS n
    FROM lineitem l
    JOIN part p ON l.l_partkey = p.p_partkey AND l.l_quantity BETWEEN p.p_size - 5 AND p.p_size + 5
    LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
    GROUP BY 1
    """,
)
def range_join_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") - 5).alias("low"), (F.col("p_size") + 5).alias("high"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    bucket = (
        F.when(F.col("o_orderstatus") == "F", "finished")
        .when(F.col("o_orderstatus") == "O", "open")
        .when(F.col("o_orderstatus").isNull(), "unknown")
        .otherwise("other")
    )
    return (
        J.point_in_interval_join(line, part, ("l_partkey", "p_partkey"), "l_quantity", "low", "high")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .groupBy(bucket.alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


@query("latest_event_per_user", """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest_event_per_user(spark, sf_dir):
    return R.latest_per_key(table(spark, sf_dir, "events"), "user_id", "ts", "event_id").select("user_id", "event_id", "event_type", "value")


@query("array_semi_join", """
SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (
  SELECT unnest(ids) FROM (SELECT event_type, list(DISTINCT user_id) AS ids FROM events WHERE event_type = 'purchase' GROUP BY 1))""")
def array_semi_join(spark, sf_dir):
    events = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    ids = events.groupBy("event_type", (F.col("user_id") % 64).alias("part")).agg(F.collect_set("user_id").alias("ids"))
    return J.array_semi_join(ids, "ids", table(spark, sf_dir, "customer"), "c_custkey").select("c_custkey", "c_mktsegment")


@query("interval_bin_join", """
SELECT l.l_orderkey, l.l_linenumber, p.p_partkey FROM lineitem l JOIN part p
ON l.l_returnflag = 'R' AND l.l_extendedprice BETWEEN p.p_retailprice * 50 AND p.p_retailprice * 50 + 20""")
def interval_bin_join(spark, sf_dir):
    spans = table(spark, sf_dir, "part").select("p_partkey", F.lit("R").alias("flag"), (F.col("p_retailprice") * 50).alias("low"))
    spans = spans.withColumn("high", F.col("low") + 20)
    points = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    joined = J.point_in_interval_join(points, spans, ("l_returnflag", "flag"), "l_extendedprice", "low", "high", bin_width=500)
    return joined.select("l_orderkey", "l_linenumber", "p_partkey")


@query("group_top_scaffold", """
SELECT p_brand, count(*) AS n, max(p_retailprice) AS best, min(p_name) AS example FROM part GROUP BY 1
ORDER BY n DESC, best DESC, p_brand LIMIT 8""")
def group_top_scaffold(spark, sf_dir):
    return R.scaffold_summary(table(spark, sf_dir, "part"), "p_brand", "p_retailprice", "p_name", 8)


@query("box_plot", """
SELECT event_type, min(value) AS min, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median,
  round(quantile_cont(value, 0.75), 6) AS q3, max(value) AS max FROM events GROUP BY 1""")
def box_plot(spark, sf_dir):
    five = R.five_numbers(table(spark, sf_dir, "events"), "event_type", "value")
    return five.select("event_type", "min", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")], "max")


@query("daily_trend", """
SELECT CAST(date_trunc('day', ts) AS DATE) AS day, count(DISTINCT user_id) AS n_keys, round(sum(value), 4) AS total FROM events GROUP BY 1""")
def daily_trend(spark, sf_dir):
    return R.daily_trend(table(spark, sf_dir, "events"), "ts", "user_id", "value").withColumn("total", F.round("total", 4))


@query("pathogenicity_buckets", """
SELECT CASE WHEN lower(o_orderpriority) LIKE '%urgent%' THEN 'pathogenic' WHEN lower(o_orderpriority) LIKE '%high%' THEN 'benign'
  WHEN lower(o_orderpriority) LIKE '%medium%' THEN 'uncertain' ELSE 'other' END AS bucket, o_orderstatus, count(*) AS n
FROM orders GROUP BY 1, 2""")
def pathogenicity_buckets(spark, sf_dir):
    text = F.lower("o_orderpriority")
    bucket = F.when(F.contains(text, F.lit("urgent")), "pathogenic").when(F.contains(text, F.lit("high")), "benign")
    bucket = bucket.when(F.contains(text, F.lit("medium")), "uncertain").otherwise("other").alias("bucket")
    return R.group_counts(table(spark, sf_dir, "orders"), bucket, "o_orderstatus")


@query("significance_labels", """
SELECT CASE WHEN s LIKE '%pathogenic%' THEN 'pathogenic' WHEN s LIKE '%benign%' THEN 'benign' WHEN s LIKE '%uncertain%' THEN 'uncertain'
  WHEN s LIKE '%conflict%' THEN 'conflicting' ELSE 'other' END AS bucket, count(*) AS n
FROM (SELECT lower(CASE p_partkey % 5 WHEN 0 THEN 'Conflicting_interpretations_of_pathogenicity' WHEN 1 THEN 'Likely_pathogenic'
  WHEN 2 THEN 'Benign/Likely_benign' WHEN 3 THEN 'Uncertain_significance' ELSE 'not_provided' END) AS s FROM part) GROUP BY 1""")
def significance_labels(spark, sf_dir):
    kind = F.col("p_partkey") % 5
    text = F.when(kind == 0, "Conflicting_interpretations_of_pathogenicity").when(kind == 1, "Likely_pathogenic").when(kind == 2, "Benign/Likely_benign")
    text = text.when(kind == 3, "Uncertain_significance").otherwise("not_provided")
    return R.group_counts(table(spark, sf_dir, "part"), C.significance_bucket(text).alias("bucket"))


@query("pivot_top_groups", """
WITH top AS (SELECT l_suppkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_suppkey LIMIT 15)
SELECT l_suppkey, count(*) FILTER (l_returnflag = 'A') AS "n_A", count(*) FILTER (l_returnflag = 'N') AS "n_N",
  count(*) FILTER (l_returnflag = 'R') AS "n_R" FROM lineitem SEMI JOIN top USING (l_suppkey) GROUP BY 1""")
def pivot_top_groups(spark, sf_dir):
    return R.pivot_top_groups(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_returnflag", ["A", "N", "R"])


@query("share_and_top3", """
WITH c AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2),
r AS (SELECT *, n * 100.0 / sum(n) OVER (PARTITION BY source) AS pct, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) AS rn FROM c)
SELECT source, string_agg(lang || ' (' || CAST(round(pct) AS INT) || '%)', '; ' ORDER BY rn) AS summary FROM r WHERE rn <= 3 GROUP BY 1""")
def share_and_top3(spark, sf_dir):
    return R.top_summary(table(spark, sf_dir, "documents"), "source", "lang")


@query("p95_outliers", """
WITH m AS (SELECT quantile_cont(l_extendedprice, 0.95) AS mark FROM lineitem)
SELECT round(mark, 6) AS mark, count(*) FILTER (l_extendedprice > mark) AS n_above FROM lineitem, m GROUP BY 1""")
def p95_outliers(spark, sf_dir):
    return R.above_percentile(table(spark, sf_dir, "lineitem"), "l_extendedprice").withColumn("mark", F.round("mark", 6))


@query("union_missing_cols", """
SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def union_missing_cols(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return customer.unionByName(supplier, allowMissingColumns=True)


@query("outer_join_multi", """
SELECT nation, n_customers, n_suppliers, n_big FROM
 (SELECT c_nationkey AS nation, count(*) AS n_customers FROM customer GROUP BY 1)
 FULL JOIN (SELECT s_nationkey AS nation, count(*) AS n_suppliers FROM supplier GROUP BY 1) USING (nation)
 FULL JOIN (SELECT c_nationkey AS nation, count(*) AS n_big FROM customer WHERE c_acctbal > 9000 GROUP BY 1) USING (nation)""")
def outer_join_multi(spark, sf_dir):
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    frames = [
        R.group_counts(customer, F.col("c_nationkey").alias("nation"), name="n_customers"),
        R.group_counts(supplier, F.col("s_nationkey").alias("nation"), name="n_suppliers"),
        R.group_counts(customer.where("c_acctbal > 9000"), F.col("c_nationkey").alias("nation"), name="n_big"),
    ]
    return J.outer_join_all(frames, "nation")


_KNN = """
 q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS x FROM embeddings WHERE vec_id % 50 = 0),
 s AS (SELECT query_id, vec_id AS id, list_cosine_similarity(x, embedding::DOUBLE[]) AS score FROM q, embeddings WHERE vec_id != query_id),
 k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s QUALIFY rank <= 10)
"""


def _knn(spark, sf_dir):
    corpus = table(spark, sf_dir, "embeddings")
    return V.knn(corpus, corpus.where("vec_id % 50 = 0"), 10)


@query("knn_cosine", f"WITH {_KNN} SELECT query_id, id, rank::INT AS rank, round(score, 6) AS score FROM k")
def knn_cosine(spark, sf_dir):
    return _knn(spark, sf_dir).withColumn("score", F.round("score", 6))


@query("ordered_lookup", f"""WITH {_KNN} SELECT query_id, (rank - 1)::INT AS pos, id AS vec_id, label FROM k JOIN embeddings ON vec_id = id""")
def ordered_lookup(spark, sf_dir):
    ids = F.transform(F.array_sort(F.collect_list(F.struct("rank", "id"))), lambda x: x["id"]).alias("ids")
    return J.ordered_lookup(_knn(spark, sf_dir).groupBy("query_id").agg(ids), "ids", table(spark, sf_dir, "embeddings").select("vec_id", "label"), "vec_id")


@query("idf_vote", f"""WITH {_KNN}, f AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)
SELECT query_id, label, round(sum(1 / ln(1 + greatest(1, n))), 6) AS weight FROM k JOIN embeddings ON vec_id = id JOIN f USING (label) GROUP BY 1, 2""")
def idf_vote(spark, sf_dir):
    labels = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return V.label_votes(_knn(spark, sf_dir), labels, "vec_id", "label", frequencies=R.group_counts(labels, "label")).withColumn("weight", F.round("weight", 6))


@query("cluster_annotation", f"""WITH {_KNN}, v AS (SELECT query_id, label, count(*) AS n FROM k JOIN embeddings ON vec_id = id GROUP BY 1, 2),
r AS (SELECT *, n / sum(n) OVER (PARTITION BY query_id) AS share, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, label) AS rn FROM v)
SELECT query_id, label, round(share, 6) AS confidence FROM r WHERE rn = 1""")
def cluster_annotation(spark, sf_dir):
    votes = V.label_votes(_knn(spark, sf_dir), table(spark, sf_dir, "embeddings"), "vec_id", "label")
    return V.annotate(votes, "label").select("query_id", "label", F.round("confidence", 6).alias("confidence"))


_REPRESENTATIVES = "r AS (SELECT label, arg_min(embedding::DOUBLE[], vec_id) AS x FROM embeddings GROUP BY 1)"


@query("pairwise_similarity", f"""WITH {_REPRESENTATIVES}
SELECT a.label AS a, b.label AS b, round(list_cosine_similarity(a.x, b.x), 6) AS cosine FROM r a JOIN r b ON a.label < b.label""")
def pairwise_similarity(spark, sf_dir):
    first = table(spark, sf_dir, "embeddings").groupBy("label").agg(F.min_by("embedding", "vec_id").alias("x"))
    return V.pairwise_cosine(first, "label", "x").withColumn("cosine", F.round("cosine", 6))


@query("neighbour_overlap", f"""WITH {_KNN}
SELECT x.query_id AS a, y.query_id AS b, count(*) AS overlap FROM k x JOIN k y ON x.id = y.id AND x.query_id < y.query_id GROUP BY 1, 2""")
def neighbour_overlap(spark, sf_dir):
    return J.set_overlaps(_knn(spark, sf_dir).groupBy("query_id").agg(F.collect_set("id").alias("ids")), "query_id", "ids")


@query("padjust", """
WITH p AS (SELECT event_type, event_id, abs(value) / (1 + (SELECT max(abs(value)) FROM events)) AS p FROM events)
SELECT event_type, event_id, round(least(1.0, p * count(*) OVER (PARTITION BY event_type) / row_number() OVER (PARTITION BY event_type ORDER BY p, event_id)), 8) AS p_adj
FROM p""")
def padjust(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    top = events.agg(F.max(F.abs("value")).alias("top"))
    p = events.join(F.broadcast(top)).select("event_type", "event_id", (F.abs("value") / (1 + F.col("top"))).alias("p"))
    return S.p_adjusted(p, "p", "event_id", "event_type").select("event_type", "event_id", F.round("p_adj", 8).alias("p_adj"))


@query("rank_sum", """
WITH e AS (SELECT event_type, value, avg(rn) OVER (PARTITION BY value) AS r FROM (
  SELECT event_type, value, row_number() OVER (ORDER BY value) AS rn FROM events WHERE event_type IN ('view', 'purchase')))
SELECT sum(r) FILTER (event_type = 'purchase') AS rank_sum_a, count(*) FILTER (event_type = 'purchase') AS n_a,
  count(*) FILTER (event_type = 'view') AS n_b,
  sum(r) FILTER (event_type = 'purchase') - count(*) FILTER (event_type = 'purchase') * (count(*) FILTER (event_type = 'purchase') + 1) / 2 AS u FROM e""")
def rank_sum(spark, sf_dir):
    events = table(spark, sf_dir, "events").where("event_type in ('view', 'purchase')")
    tested = S.mann_whitney(events.withColumn("gene", F.lit("value")), "gene", "value", F.col("event_type") == "purchase")
    return tested.select("rank_sum_a", "n_a", "n_b", "u")


_TERMS = """
 t AS (SELECT DISTINCT lang AS term, unnest(string_split(text, ' ')) AS gene FROM documents),
 q AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS gene FROM documents WHERE source = 'src1'),
 bg AS (SELECT DISTINCT gene FROM t)"""


@query("enrichment_counts", f"""WITH {_TERMS}, s AS (SELECT term, count(*) AS n_term, count(q.gene) AS a FROM t LEFT JOIN q USING (gene) GROUP BY 1)
SELECT term, a, (SELECT count(*) FROM q) - a AS b, n_term - a AS c, (SELECT count(*) FROM bg) - (SELECT count(*) FROM q) - n_term + a AS d FROM s WHERE a >= 1""")
def enrichment_counts(spark, sf_dir):
    words = F.explode(F.split("text", " ")).alias("gene")
    documents = table(spark, sf_dir, "documents")
    terms = documents.select(F.col("lang").alias("term"), words).distinct()
    return J.overlap_counts(documents.where("source = 'src1'").select(words), terms, terms.select("gene"))


@query("zscore_groups", """
WITH m AS (SELECT l_returnflag, l_linestatus, avg(l_extendedprice) AS mean FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, l_linestatus, round((mean - avg(mean) OVER (PARTITION BY l_linestatus)) / stddev_samp(mean) OVER (PARTITION BY l_linestatus), 5) AS z FROM m""")
def zscore_groups(spark, sf_dir):
    means = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.avg("l_extendedprice").alias("mean"))
    return S.z_scores(means, "l_linestatus", "mean").select("l_returnflag", "l_linestatus", F.round("z", 5).alias("z"))


@query("minmax_reward", """
WITH m AS (SELECT *, min(p_retailprice) OVER w AS lo, max(p_retailprice) OVER w AS hi, min(p_size) OVER w AS sl, max(p_size) OVER w AS sh
  FROM part WINDOW w AS (PARTITION BY p_brand))
SELECT p_partkey, round((2 * CASE WHEN hi > lo THEN (p_retailprice - lo) / (hi - lo) ELSE 0 END
  + 1 * CASE WHEN sh > sl THEN 1 - (p_size - sl)::DOUBLE / (sh - sl) ELSE 0 END) / 3, 6) AS reward FROM m""")
def minmax_reward(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("p_size", F.col("p_size").cast("double"))
    axes = [O.Axis("p_retailprice", 2.0), O.Axis("p_size", 1.0, lower_is_better=True)]
    return O.with_reward(part, axes, "p_brand").select("p_partkey", F.round("reward", 6).alias("reward"))


@query("stratified_cap", """
WITH r AS (SELECT doc_id, row_number() OVER (PARTITION BY lang, source ORDER BY md5(doc_id || ':42'), doc_id) AS rn FROM documents)
SELECT doc_id FROM r WHERE rn <= 3 ORDER BY md5(doc_id || ':42'), doc_id LIMIT 150""")
def stratified_cap(spark, sf_dir):
    return P.stratified_cap(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), ["lang", "source"], 3, 150, "doc_id").select("doc_id")


@query("proportional_sample", """
WITH s AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1),
q AS (SELECT lang, n, round_even(n * 100.0::DOUBLE / sum(n) OVER (), 0)::BIGINT AS quota FROM s),
f AS (SELECT lang, quota + CASE WHEN row_number() OVER (ORDER BY n DESC, lang) = 1 THEN 100 - sum(quota) OVER () ELSE 0 END AS quota FROM q),
r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || ':42'), doc_id) AS rn FROM documents)
SELECT doc_id, lang FROM r JOIN f USING (lang) WHERE rn <= quota""")
def proportional_sample(spark, sf_dir):
    return P.proportional(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", 100, "doc_id")


@query("hash_split", """
SELECT doc_id, CASE WHEN p < 80 THEN 'train' WHEN p < 90 THEN 'val' ELSE 'test' END AS split
FROM (SELECT doc_id, ('0x' || substr(md5(doc_id || ':0'), 1, 8))::BIGINT % 100 AS p FROM documents)""")
def hash_split(spark, sf_dir):
    return P.hash_split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


def _updates(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.where("c_custkey % 3 = 0").withColumn("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")).otherwise(F.col("c_custkey") + 1000000)).withColumn("c_acctbal", F.lit(0.0))


@query("upsert", """
WITH u AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE c_custkey + 1000000 END AS c_custkey, c_name, c_nationkey, 0.0::DOUBLE AS c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 3 = 0)
SELECT c_custkey, c_name, c_acctbal FROM u UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer ANTI JOIN u USING (c_custkey)""")
def upsert(spark, sf_dir):
    return G.upsert(table(spark, sf_dir, "customer"), _updates(spark, sf_dir), ["c_custkey"]).select("c_custkey", "c_name", "c_acctbal")


@query("soft_delete", "SELECT c_custkey, NOT coalesce(c_acctbal < 0, false) AS is_active FROM customer")
def soft_delete(spark, sf_dir):
    return G.soft_delete(table(spark, sf_dir, "customer").withColumn("is_active", F.lit(True)), F.col("c_acctbal") < 0).select("c_custkey", "is_active")


@query("replace_rows", """
SELECT r_regionkey, r_name FROM region WHERE r_name != 'ASIA' UNION ALL SELECT 100 + r_regionkey, r_name FROM region WHERE r_regionkey < 2""")
def replace_rows(spark, sf_dir):
    region = table(spark, sf_dir, "region")
    return G.replace_rows(region, F.col("r_name") == "ASIA", region.where("r_regionkey < 2").withColumn("r_regionkey", F.col("r_regionkey") + 100))


@query("json_path", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_path(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("json_dig", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_dig(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", C.json_path("k")(F.col("props")).alias("k"))


@query("dedup_keep_best", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def dedup_keep_best(spark, sf_dir):
    return R.best_per_key(table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice", "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


@query("early_late_mean", """
WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS k, count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type, round(avg(value) FILTER (k <= n // 2 OR n = 1), 6) AS early, round(avg(value) FILTER (k > n - n // 2 OR n = 1), 6) AS late FROM r GROUP BY 1""")
def early_late_mean(spark, sf_dir):
    return R.early_late_mean(table(spark, sf_dir, "events"), "event_type", "ts", "event_id", "value").select("event_type", F.round("early", 6).alias("early"), F.round("late", 6).alias("late"))


@query("running_stop_rule", """
WITH d AS (SELECT CAST(date_trunc('day', ts) AS DATE) AS iteration, max(value) AS top, count(*) FILTER (value > 90) AS good FROM events GROUP BY 1),
h AS (SELECT iteration, max(top) OVER w AS best, sum(good) OVER w AS n_good FROM d WINDOW w AS (ORDER BY iteration ROWS UNBOUNDED PRECEDING))
SELECT iteration, round(best, 6) AS best, n_good::BIGINT AS n_good, coalesce(best - lag(best, 3) OVER (ORDER BY iteration) < 0.01, false) AS converged FROM h""")
def running_stop_rule(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    days = events.groupBy(F.date_trunc("day", "ts").cast("date").alias("iteration")).agg(F.max("value").alias("top"), F.count_if(F.col("value") > 90).alias("good"))
    return O.history_rules(days, "iteration", "top", "good", window=3, threshold=0.01).select("iteration", F.round("best", 6).alias("best"), "n_good", "converged")


@query("kmers", """
SELECT doc_id, len(k) AS n_kmers, len(list_distinct(k)) AS n_distinct FROM (
  SELECT doc_id, list_transform(range(1, greatest(0, length(text) - 8) + 1), lambda i: substr(text, i, 9)) AS k FROM documents)""")
def kmers(spark, sf_dir):
    k = C.kmers(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(k).cast("long").alias("n_kmers"), F.size(F.array_distinct(k)).cast("long").alias("n_distinct"))


@query("regex_flags", """
SELECT p_partkey, p_name LIKE 'MT-%' AS mt, regexp_matches(p_name, '^(RPS|RPL)') AS ribo, regexp_matches(p_name, '^HB[^(P)]') AS hb,
  coalesce(nullif(trim(substr(trim(regexp_replace(regexp_replace(lower(p_brand), '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'), '_'), 1, 40)), ''), 'unnamed') AS name FROM part""")
def regex_flags(spark, sf_dir):
    flags = [v.alias(k) for k, v in C.gene_flags(F.col("p_name")).items()]
    return table(spark, sf_dir, "part").select("p_partkey", *flags, C.sanitized(F.col("p_brand")).alias("name"))


@query("anti_join_rest", """
WITH top AS (SELECT p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20)
SELECT p_partkey, p_retailprice FROM part ANTI JOIN top USING (p_partkey) ORDER BY p_retailprice DESC, p_partkey LIMIT 25""")
def anti_join_rest(spark, sf_dir):
    return R.top_and_rest(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), "p_partkey", "p_retailprice", 20)[1]


@query("left_join_dedup", """
SELECT o_orderkey, l_linenumber, l_quantity FROM (SELECT o_orderkey, l_linenumber, l_quantity,
  row_number() OVER (PARTITION BY o_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_quantity DESC) AS rn FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey) WHERE rn = 1""")
def left_join_dedup(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    joined = table(spark, sf_dir, "orders").select("o_orderkey").join(line, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return R.latest_per_key(joined, "o_orderkey", "l_shipdate", "l_linenumber", "l_quantity").select("o_orderkey", "l_linenumber", "l_quantity")


@query("column_stats", """
SELECT count(*) AS n_rows, count(DISTINCT vec_id) AS n_vec_id, count(DISTINCT label) AS n_label, min(len(embedding))::INT AS min_size, max(len(embedding))::INT AS max_size FROM embeddings""")
def column_stats(spark, sf_dir):
    return R.column_stats(table(spark, sf_dir, "embeddings"), ["vec_id", "label"], "embedding")


@query("class_shares", "SELECT round(avg(1 - quality), 6) AS quality_p0, round(avg(1 - toxic), 6) AS toxic_p0, round(avg(quality), 6) AS quality_p1, round(avg(toxic), 6) AS toxic_p1 FROM labels")
def class_shares(spark, sf_dir):
    df = R.class_shares(table(spark, sf_dir, "labels"), ["quality", "toxic"])
    return df.select(*[F.round(c, 6).alias(c) for c in df.columns])


@query("vocabulary", """
WITH w AS (SELECT unnest(string_split(lower(text), ' ')) AS token FROM documents),
c AS (SELECT token, count(*) AS freq FROM w GROUP BY 1 HAVING count(*) >= 5 ORDER BY freq DESC, token LIMIT 98)
SELECT token, freq, (row_number() OVER (ORDER BY freq DESC, token) + 1)::INT AS index FROM c""")
def vocabulary(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(F.explode(F.split(F.lower("text"), " ")).alias("token"))
    return R.vocabulary(words, "token", 5, 100)


@query("numeric_aware_order", "SELECT p_brand, (row_number() OVER (ORDER BY try_cast(regexp_replace(p_brand, '^Brand#', '') AS BIGINT) NULLS LAST, p_brand))::INT AS place FROM (SELECT DISTINCT p_brand FROM part)")
def numeric_aware_order(spark, sf_dir):
    names = table(spark, sf_dir, "part").select("p_brand", F.regexp_replace("p_brand", "^Brand#", "").alias("c")).distinct()
    order = Window.orderBy(*R.numeric_aware("c"), "p_brand")
    return names.select("p_brand", F.row_number().over(order).alias("place"))


@query("rank_encoding", """
SELECT o_custkey, o_orderkey, rank::INT AS rank, round(1 - (rank - 1) * 2.0 / 4, 6)::DOUBLE AS encoded FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 5""")
def rank_encoding(spark, sf_dir):
    return R.rank_encoding(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", "o_totalprice", 5).withColumn("encoded", F.round(F.col("encoded").cast("double"), 6))


@query("page_of_orders", """
SELECT o_orderkey, (SELECT count(*) FROM orders) > 60 AS has_more FROM (SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 20 OFFSET 40)""")
def page_of_orders(spark, sf_dir):
    return R.page_of(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), [F.desc("o_orderdate"), F.asc("o_orderkey")], 2).select("o_orderkey", "has_more")


@query("label_proportions", """
SELECT label, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6)::DOUBLE AS pct FROM embeddings WHERE label != 3 GROUP BY 1""")
def label_proportions(spark, sf_dir):
    df = R.label_proportions(table(spark, sf_dir, "embeddings"), "label", F.col("label") == 3)
    return df.withColumn("pct", F.round(F.col("pct").cast("double"), 6))


@query("scaler", """
SELECT p_partkey, round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER (), 6) AS scaled FROM part""")
def scaler(spark, sf_dir):
    return S.scaled(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), ["p_retailprice"]).select("p_partkey", F.round("p_retailprice", 6).alias("scaled"))


@query("regression_metrics", """
SELECT round(sqrt(avg((l_extendedprice - p) ** 2)), 4) AS rmse, round(avg(abs(l_extendedprice - p)), 4) AS mae,
  round(1 - sum((l_extendedprice - p) ** 2) / sum((l_extendedprice - m) ** 2), 6) AS r2
FROM (SELECT l_extendedprice, l_quantity * 1500 AS p, avg(l_extendedprice) OVER () AS m FROM lineitem)""")
def regression_metrics(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("p"))
    df = S.regression_metrics(line, "y", "p")
    return df.select(F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"))


@query("classification_metrics", """
WITH t AS (SELECT l_returnflag = 'R' AS y, l_discount * 10 AS s FROM lineitem),
r AS (SELECT y, s, avg(rn) OVER (PARTITION BY s) AS r FROM (SELECT *, row_number() OVER (ORDER BY s) AS rn FROM t))
SELECT round(avg((y = (s >= 0.5))::INT), 6) AS accuracy, round(avg((s >= 0.5)::INT) FILTER (y), 6) AS recall, round(avg((s < 0.5)::INT) FILTER (NOT y), 6) AS specificity,
  round((sum(r) FILTER (y) - count(*) FILTER (y) * (count(*) FILTER (y) + 1) / 2) / (count(*) FILTER (y) * count(*) FILTER (NOT y)::DOUBLE), 6) AS auc FROM r""")
def classification_metrics(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_discount") * 10).alias("s"))
    df = S.classification_metrics(line, "y", "s")
    return df.select(*[F.round(c, 6).alias(c) for c in ("accuracy", "recall", "specificity", "auc")])


@query("usage_dashboard", """
SELECT event_type AS module, count(DISTINCT user_id) AS users, round(sum(value), 4) AS usage, CAST(max(ts) AS DATE) AS last_day FROM events GROUP BY 1""")
def usage_dashboard(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.groupBy(F.col("event_type").alias("module")).agg(F.countDistinct("user_id").alias("users"), F.round(F.sum("value"), 4).alias("usage"), F.max("ts").cast("date").alias("last_day"))


@query("module_user_heatmap", "SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2")
def module_user_heatmap(spark, sf_dir):
    return R.group_counts(table(spark, sf_dir, "events"), "event_type", "user_id")


@query("filtered_counts", "SELECT count(*) AS total, count(*) FILTER (l_quantity > 25) AS large, count(*) FILTER (l_discount = 0) AS full_price FROM lineitem")
def filtered_counts(spark, sf_dir):
    return R.filtered_counts(table(spark, sf_dir, "lineitem"), large=F.col("l_quantity") > 25, full_price=F.col("l_discount") == 0)


@query("feasible_ranking", "SELECT p_partkey FROM part WHERE p_size >= 10 AND p_retailprice <= 1500 ORDER BY p_retailprice DESC, p_partkey LIMIT 30")
def feasible_ranking(spark, sf_dir):
    ok = (F.col("p_size") >= 10) & (F.col("p_retailprice") <= 1500)
    return R.feasible_or_all(table(spark, sf_dir, "part"), ok, "p_retailprice", "p_partkey", 30).select("p_partkey")


@query("tumbling_windows", """
SELECT time_bucket(INTERVAL '1 day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def tumbling_windows(spark, sf_dir):
    counted = E.windowed_counts(table(spark, sf_dir, "events"), "ts", "event_type", "value", "1 day")
    return counted.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("smith_waterman")
def smith_waterman(spark, sf_dir):
    """Local alignments of neighbouring parts' whole names."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.upper(F.regexp_replace("p_name", "[^A-Za-z]", "")).alias("s"))
    other = part.select((F.col("p_partkey") - 1).alias("k"), F.col("s").alias("t"))
    pairs = part.join(other, part.p_partkey == other.k)
    return A.aligned(pairs, "s", "t").select("p_partkey", "score", "identity", "coverage", "similarity")


@query("sequence_search")
def sequence_search(spark, sf_dir):
    """Vector funnel, then local alignment of the whole sequences and ranking, over parts' names with the vectors of the same id."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("seq_id"), F.upper(F.regexp_replace("p_name", "[^A-Za-z]", "")).alias("sequence"))
    vectors = table(spark, sf_dir, "embeddings")
    query_rows = parts.join(vectors.where("vec_id % 50 = 0"), F.col("seq_id") == F.col("vec_id")).select(F.col("vec_id"), "embedding", "sequence")
    return A.search(query_rows, vectors, parts, top_k=20, min_coverage=0.0)
