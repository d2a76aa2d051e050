"""Queries of the life-science, registry and dashboard operators, over the star-schema tables read as such data.

Each registers itself in the catalogue with its DuckDB equivalent. Orders stand for variants, line items for genotype
calls, counts of cells or p-values, parts for annotated variants and models, customers for permissions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import columns as C
from strandline.functions import stats as S
from strandline.operators import dashboards as D
from strandline.operators import genomics as V
from strandline.operators import joins as J
from strandline.operators import optimize as O
from strandline.operators import registry as G
from strandline.operators import relational as R
from strandline.operators import sampling as P
from strandline.operators import singlecell as X
from strandline.plans.catalog import query
from strandline.session import table

# --- variants -----------------------------------------------------------------------------------------


def _base(k):
    return F.substr(F.lit("ACGT"), (k % 4 + 1).cast("int"), F.lit(1))


def _variants(spark, sf_dir) -> DataFrame:
    key, other = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("chr"), (other % 5).cast("string")).alias("contigName"), (key % 1000).alias("start"),
        _base(key).alias("referenceAllele"), F.array(_base(other)).alias("alternateAlleles"),
    )


_VARIANTS = """
 v AS (SELECT o_orderkey, 'chr' || (o_custkey % 5) AS contig, o_orderkey % 1000 AS start, substr('ACGT', (o_orderkey % 4 + 1)::INT, 1) AS ref,
   substr('ACGT', (o_custkey % 4 + 1)::INT, 1) AS alt FROM orders)"""


@query("variant_annotation", f"""WITH {_VARIANTS}
SELECT o_orderkey, c_custkey FROM v LEFT JOIN customer ON replace(contig, 'chr', '') = (c_custkey % 5)::VARCHAR AND start = c_custkey % 1000
  AND ref = substr('ACGT', (c_custkey % 4 + 1)::INT, 1) AND alt = substr('ACGT', (c_nationkey % 4 + 1)::INT, 1)""")
def variant_annotation(spark, sf_dir):
    key = F.col("c_custkey")
    known = table(spark, sf_dir, "customer").select(
        (key % 5).cast("string").alias("contigName"), (key % 1000).alias("start"), _base(key).alias("referenceAllele"),
        F.array(_base(F.col("c_nationkey"))).alias("alternateAlleles"), "c_custkey",
    )
    return J.annotate_variants(_variants(spark, sf_dir), known, ["c_custkey"]).select("o_orderkey", "c_custkey")


@query("panel_genes", f"""WITH {_VARIANTS}
SELECT p_brand AS gene, count(*) AS n, sum(start)::BIGINT AS places FROM v JOIN part ON contig = 'chr' || (p_partkey % 5) AND start BETWEEN p_size * 10 AND p_size * 10 + 5
GROUP BY 1""")
def panel_genes(spark, sf_dir):
    low = F.col("p_size").cast("long") * 10
    chrom = F.concat(F.lit("chr"), (F.col("p_partkey") % 5).cast("string"))
    panel = table(spark, sf_dir, "part").select(chrom.alias("chrom"), low.alias("chromStart"), (low + 5).alias("chromEnd"), F.col("p_brand").alias("name"))
    return V.panel_counts(_variants(spark, sf_dir), panel, bin_width=50)


_REGIONS = [{"name": "first", "contig": "chr1", "start": 100, "end": 300}, {"name": "second", "contig": "chr3", "start": 0, "end": 999}]


@query("custom_regions", f"""WITH {_VARIANTS}
SELECT o_orderkey, CASE WHEN contig = 'chr1' THEN 'first' ELSE 'second' END AS gene FROM v
WHERE contig = 'chr1' AND start >= 100 AND start + 1 <= 300 OR contig = 'chr3' AND start >= 0 AND start + 1 <= 999""")
def custom_regions(spark, sf_dir):
    variants = _variants(spark, sf_dir).withColumn("end", F.col("start") + 1)
    return V.in_custom_regions(variants, _REGIONS).select("o_orderkey", "gene")


@query("variant_kinds", f"""WITH {_VARIANTS} SELECT o_orderkey, true AS biallelic, true AS snp, contig AS chromosome, ref, alt FROM v""")
def variant_kinds(spark, sf_dir):
    alleles = F.col("alternateAlleles")
    flags = {"biallelic": C.is_biallelic(alleles), "snp": C.is_snp(F.col("referenceAllele"), alleles)}
    return C.first_alleles(_variants(spark, sf_dir)).withColumns(flags).select("o_orderkey", "biallelic", "snp", "chromosome", "ref", "alt")


def _genotypes(spark, sf_dir) -> DataFrame:
    first = F.when(F.col("l_discount") < 0.015, -1).otherwise((F.col("l_linenumber") % 2).cast("int"))
    calls = F.array(first, (F.col("l_quantity").cast("int") % 2).cast("int"))
    own = F.struct(F.col("l_suppkey").cast("string").alias("sampleId"), calls.alias("calls"))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(own)).alias("genotypes"))


_CALLS = """
 c AS (SELECT l_orderkey, l_suppkey, CASE WHEN l_discount < 0.015 THEN -1 ELSE l_linenumber % 2 END AS a, l_quantity::INT % 2 AS b FROM lineitem),
 g AS (SELECT *, CASE WHEN a < 0 THEN -1 ELSE a + b END AS state FROM c),
 n AS (SELECT l_orderkey, count(*) FILTER (state >= 0)::INT AS called, count(*) FILTER (state < 0)::INT AS uncalled,
   coalesce(sum(state) FILTER (state >= 0), 0)::INT AS alts, count(*) FILTER (state = 0)::INT AS r, count(*) FILTER (state = 1)::INT AS h,
   count(*) FILTER (state = 2)::INT AS m, count(DISTINCT state) AS kinds FROM g GROUP BY 1)"""


@query("genotype_summary", f"""WITH {_CALLS}
SELECT l_orderkey, called AS "nCalled", uncalled AS "nUncalled", alts AS "nAlt", r AS "nHomRef", h AS "nHet", m AS "nHomAlt" FROM n""")
def genotype_summary(spark, sf_dir):
    return _genotypes(spark, sf_dir).select("l_orderkey", C.call_summary(F.col("genotypes")).alias("c")).select("l_orderkey", "c.*")


@query("equilibrium", f"""WITH {_CALLS}, f AS (SELECT *, (r + h + m)::DOUBLE AS t, (2 * r + h) / nullif(2.0 * (r + h + m), 0) AS p FROM n)
SELECT l_orderkey, round(2 * p * (1 - p), 6) AS het, round(
  CASE WHEN t * p * p > 0 THEN (r - t * p * p) ** 2 / (t * p * p) ELSE 0 END + CASE WHEN 2 * t * p * (1 - p) > 0 THEN (h - 2 * t * p * (1 - p)) ** 2 / (2 * t * p * (1 - p)) ELSE 0 END
  + CASE WHEN t * (1 - p) * (1 - p) > 0 THEN (m - t * (1 - p) * (1 - p)) ** 2 / (t * (1 - p) * (1 - p)) ELSE 0 END, 5) AS chi2 FROM f""")
def equilibrium(spark, sf_dir):
    """Frequencies and chi-square; the exact p, which SQL lacks, is tested against a plain count of outcomes."""
    tested = V.with_statistics(_genotypes(spark, sf_dir).withColumn("alternateAlleles", F.array(F.lit("A"))))
    return tested.select("l_orderkey", F.round("hetFreqHwe", 6).alias("het"), F.round("chi2Hwe", 5).alias("chi2"))


@query("mean_substitution", f"""WITH {_CALLS}
SELECT l_orderkey, round(alts + uncalled * alts / nullif(called, 0)::DOUBLE, 6) AS total, kinds > 1 AS varied FROM n WHERE called > 0""")
def mean_substitution(spark, sf_dir):
    states = _genotypes(spark, sf_dir).select("l_orderkey", C.genotype_states(F.col("genotypes")).alias("s"))
    filled = states.where(F.exists("s", lambda x: x >= 0)).withColumn("f", C.mean_substituted(F.col("s")))
    total = F.aggregate("f", F.lit(0.0), lambda a, x: a + x)
    return filled.select("l_orderkey", F.round(total, 6).alias("total"), C.is_varied(F.col("s")).alias("varied"))


@query("variant_carriers", f"WITH {_CALLS} SELECT s_suppkey, s_nationkey FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM c WHERE a + b >= 1)")
def variant_carriers(spark, sf_dir):
    phenotype = table(spark, sf_dir, "supplier").withColumn("sampleId", F.col("s_suppkey").cast("string"))
    return V.carried_variants(_genotypes(spark, sf_dir), phenotype).select("s_suppkey", "s_nationkey")


@query("sample_restriction", """
SELECT l_orderkey, count(s_suppkey)::INT AS kept FROM lineitem LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) ON l_suppkey = s_suppkey GROUP BY 1""")
def sample_restriction(spark, sf_dir):
    samples = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").cast("string").alias("sampleId"))
    return V.restrict_samples(_genotypes(spark, sf_dir), samples).select("l_orderkey", F.size("genotypes").alias("kept"))


def _results(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("contigName"), F.col("l_linenumber").cast("long").alias("start"), F.pow(F.lit(10.0), -F.col("l_quantity") / 5.3).alias("pvalue")
    )


@query("association_summary", """
WITH p AS (SELECT pow(10, -l_quantity / 5.3) AS p FROM lineitem), s AS (SELECT count(*) AS total, count(*) FILTER (p < 5e-8) AS strict, count(*) FILTER (p < 1e-5) AS suggestive, min(p) AS low FROM p)
SELECT total, CASE WHEN strict > 0 THEN strict ELSE suggestive END AS significant, suggestive, round(-log10(low), 6) AS min_p FROM s""")
def association_summary(spark, sf_dir):
    return V.gwas_summary(_results(spark, sf_dir)).withColumn("min_p", F.round(-F.log10("min_p"), 6))


@query("association_top", """
SELECT l_orderkey::VARCHAR AS contigName, l_linenumber::BIGINT AS start, round(l_quantity / 5.3, 6) AS neg_log10_p FROM lineitem ORDER BY l_quantity DESC, 1, 2 LIMIT 50""")
def association_top(spark, sf_dir):
    return V.top_results(_results(spark, sf_dir))[1].select("contigName", "start", F.round("neg_log10_p", 6).alias("neg_log10_p"))


def _annotated(spark, sf_dir) -> DataFrame:
    key, texts = F.col("p_partkey"), "array<string>"
    marks = F.when(key % 4 == 0, F.array(F.lit("Pathogenic"))).when(key % 4 == 1, F.array(F.lit("Benign"), F.lit("Likely_pathogenic")))
    marks = marks.when(key % 4 == 2, F.array(F.when(key % 3 == 0, "Uncertain_significance").otherwise("Benign"))).otherwise(F.lit(None).cast(texts))
    return table(spark, sf_dir, "part").select(
        F.lit("run").alias("run_name"), F.col("p_brand").alias("gene"), F.when(key % 6 != 0, F.col("p_type")).alias("category"), F.lit(None).cast("string").alias("condition"),
        F.concat(F.lit("chr"), (key % 5).cast("string")).alias("chromosome"), F.col("p_size").cast("long").alias("start"), _base(key).alias("ref"), _base(key + 1).alias("alt"),
        F.when(key % 2 == 0, "Homozygous Alt").otherwise("Heterozygous").alias("zygosity"), F.col("p_retailprice").alias("qual"), marks.alias("clinical_significance"),
        F.array("p_type").alias("disease_name"), F.array(key.cast("string"), F.lit("x")).alias("variant_ids"),
    )


_ANNOTATED = """
 a AS (SELECT p_brand AS gene, CASE WHEN p_partkey % 6 != 0 THEN p_type END AS category, 'chr' || (p_partkey % 5) AS chromosome, p_size::BIGINT AS start,
   substr('ACGT', (p_partkey % 4 + 1)::INT, 1) AS ref, substr('ACGT', ((p_partkey + 1) % 4 + 1)::INT, 1) AS alt,
   CASE WHEN p_partkey % 2 = 0 THEN 'Homozygous Alt' ELSE 'Heterozygous' END AS zygosity, p_retailprice AS qual,
   CASE p_partkey % 4 WHEN 0 THEN 'Pathogenic' WHEN 1 THEN 'Benign, Likely_pathogenic' WHEN 2 THEN CASE WHEN p_partkey % 3 = 0 THEN 'Uncertain_significance' ELSE 'Benign' END END AS marks,
   p_type AS disease, p_partkey || ', x' AS ids, coalesce(p_partkey % 4 IN (0, 1), false) AS bad FROM part)"""


@query("pathogenic_totals", f"WITH {_ANNOTATED} SELECT count(*) AS total, count(*) FILTER (bad) AS pathogenic FROM a")
def pathogenic_totals(spark, sf_dir):
    return V.pathogenic_totals(_annotated(spark, sf_dir))


@query("pathogenic_details", f"""WITH {_ANNOTATED}
SELECT gene, coalesce(category, '') AS category, '' AS condition, chromosome, start, ref, alt, zygosity, qual, marks AS clinical_significance, disease AS disease_name, ids AS variant_ids
FROM a WHERE bad""")
def pathogenic_details(spark, sf_dir):
    return V.pathogenic_details(V.pathogenic(_annotated(spark, sf_dir)))


@query("gene_zygosity_counts", f"WITH {_ANNOTATED} SELECT gene, zygosity, count(*) AS n FROM a GROUP BY 1, 2")
def gene_zygosity_counts(spark, sf_dir):
    return V.gene_counts(_annotated(spark, sf_dir), "gene", "zygosity")


@query("disease_counts", f"WITH {_ANNOTATED} SELECT marks AS clinical_significance, count(*) AS n FROM a GROUP BY 1")
def disease_counts(spark, sf_dir):
    return V.gene_counts(_annotated(spark, sf_dir), "clinical_significance")


@query("pathogenicity_of_runs", f"""WITH {_ANNOTATED}, hits AS (SELECT DISTINCT chromosome, start, ref, alt FROM a WHERE bad)
SELECT CASE WHEN h.ref IS NOT NULL THEN 'Pathogenic' WHEN marks LIKE '%Benign%' THEN 'Benign' WHEN marks LIKE '%Uncertain%' THEN 'Uncertain' ELSE 'Other' END AS bucket, count(*) AS n
FROM a LEFT JOIN hits h USING (chromosome, start, ref, alt) GROUP BY 1""")
def pathogenicity_of_runs(spark, sf_dir):
    rows = _annotated(spark, sf_dir)
    return V.pathogenicity_buckets(rows, V.pathogenic(rows))


# --- statistics ---------------------------------------------------------------------------------------

_TAIL = """least(1, t * exp(-x * x + (((((((((0.17087277 * t - 0.82215223) * t + 1.48851587) * t - 1.13520398) * t + 0.27886807) * t - 0.18628806) * t
  + 0.09678418) * t + 0.37409196) * t + 1.00002368) * t - 1.26551223)))"""


@query("differential_expression", f"""
WITH e AS (SELECT l_suppkey % 7 AS gene, l_extendedprice AS v, l_returnflag = 'R' AS ina FROM lineitem),
r AS (SELECT *, rank() OVER (PARTITION BY gene ORDER BY v) + (count(*) OVER (PARTITION BY gene, v) - 1) / 2.0 AS r FROM e),
t AS (SELECT gene, sum(n * (n * n - 1)) AS ties FROM (SELECT gene, v, count(*)::DOUBLE AS n FROM e GROUP BY 1, 2) GROUP BY 1),
s AS (SELECT gene, sum(r) FILTER (ina) AS ra, count(*) FILTER (ina)::DOUBLE AS na, count(*) FILTER (NOT ina)::DOUBLE AS nb, avg(v) FILTER (ina) AS ma, avg(v) FILTER (NOT ina) AS mb FROM r GROUP BY 1),
z AS (SELECT *, ra - na * (na + 1) / 2 AS u, sqrt(na * nb / 12 * ((na + nb + 1) - ties / ((na + nb) * (na + nb - 1)))) AS sd FROM s JOIN t USING (gene)),
x AS (SELECT *, greatest(abs(u - na * nb / 2) - 0.5, 0) / sd / sqrt(2) AS x FROM z),
p AS (SELECT *, {_TAIL} AS p FROM (SELECT *, 1 / (1 + x / 2) AS t FROM x)),
a AS (SELECT *, least(1.0, p * count(*) OVER () / row_number() OVER (ORDER BY p, gene)) AS adj FROM p)
SELECT gene, u, round(log2((ma + 1e-9) / (mb + 1e-9)), 6) AS log2fc, round(p, 6) AS p, round(adj, 6) AS p_adj, adj < 0.05 AND abs(log2((ma + 1e-9) / (mb + 1e-9))) > 1 AS significant FROM a""")
def differential_expression(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 7).alias("gene"), F.col("l_extendedprice").alias("v"), "l_returnflag")
    found = S.differential_expression(rows, "gene", "v", F.col("l_returnflag") == "R")
    return found.select("gene", "u", *[F.round(c, 6).alias(c) for c in ("log2fc", "p", "p_adj")], "significant")


@query("term_enrichment", """
WITH c AS (SELECT l_suppkey AS term, l_quantity > 25 AS x, l_discount > 0.055 AS y FROM lineitem),
t AS (SELECT term, count(*) FILTER (x AND y) AS a, count(*) FILTER (x AND NOT y) AS b, count(*) FILTER (NOT x AND y) AS c, count(*) FILTER (NOT x AND NOT y) AS d FROM c GROUP BY 1),
k AS (SELECT *, a + b AS r, a + c AS q, a + b + c + d AS n, unnest(range(a, least(a + b, a + c) + 1)) AS k FROM t),
p AS (SELECT term, least(1.0, sum(exp(lgamma(r + 1) - lgamma(k + 1) - lgamma(r - k + 1) + lgamma(n - r + 1) - lgamma(q - k + 1) - lgamma(n - r - q + k + 1)
  - lgamma(n + 1) + lgamma(q + 1) + lgamma(n - q + 1)))) AS p FROM k WHERE n - r - q + k >= 0 GROUP BY 1)
SELECT term, round(p, 7) AS p, round(least(1.0, p * count(*) OVER () / row_number() OVER (ORDER BY p, term)), 7) AS p_adj FROM p""")
def term_enrichment(spark, sf_dir):
    x, y = F.col("l_quantity") > 25, F.col("l_discount") > 0.055
    cells = {"a": x & y, "b": x & ~y, "c": ~x & y, "d": ~x & ~y}
    tables = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("term")).agg(*[F.count_if(v).alias(k) for k, v in cells.items()])
    return S.enrichment(tables).select("term", F.round("p", 7).alias("p"), F.round("p_adj", 7).alias("p_adj"))


@query("padjust_all", """
WITH p AS (SELECT event_id, abs(value) / (1 + (SELECT max(abs(value)) FROM events)) AS p FROM events WHERE value IS NOT NULL)
SELECT event_id, round(least(1.0, p * count(*) OVER () / row_number() OVER (ORDER BY p, event_id)), 8) AS p_adj FROM p""")
def padjust_all(spark, sf_dir):
    events = table(spark, sf_dir, "events").where("value is not null")
    top = events.agg(F.max(F.abs("value")).alias("top"))
    p = events.join(F.broadcast(top)).select("event_id", (F.abs("value") / (1 + F.col("top"))).alias("p"))
    return S.p_adjusted(p, "p", "event_id").select("event_id", F.round("p_adj", 8).alias("p_adj"))


@query("rank_correlation", """
SELECT round(corr(a, b), 6) AS spearman FROM (SELECT avg(x) OVER (PARTITION BY l_quantity) AS a, avg(y) OVER (PARTITION BY l_extendedprice) AS b FROM (
  SELECT l_quantity, l_extendedprice, row_number() OVER (ORDER BY l_quantity) AS x, row_number() OVER (ORDER BY l_extendedprice) AS y FROM lineitem))""")
def rank_correlation(spark, sf_dir):
    return S.spearman(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice").select(F.round("spearman", 6).alias("spearman"))


@query("file_folds", "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS fold FROM orders")
def file_folds(spark, sf_dir):
    return P.folds(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 1000)


@query("uniform_sample", "SELECT doc_id FROM documents ORDER BY md5(doc_id || ':42'), doc_id LIMIT 100")
def uniform_sample(spark, sf_dir):
    return P.uniform(table(spark, sf_dir, "documents").select("doc_id"), 100, "doc_id")


@query("sample_with_floor", """
WITH s AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1), w AS (SELECT sum(n) AS whole FROM s),
q AS (SELECT c_mktsegment, CASE WHEN c_mktsegment = 'BUILDING' THEN n ELSE greatest(least(n, floor(n * 60.0::DOUBLE / whole)), least(n, 15)) END AS quota FROM s, w),
r AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(c_custkey || ':42'), c_custkey) AS k FROM customer)
SELECT c_custkey, c_mktsegment FROM r JOIN q USING (c_mktsegment) WHERE k <= quota""")
def sample_with_floor(spark, sf_dir):
    return P.with_floor(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", ["BUILDING"], 60, 15, "c_custkey")


# --- single cells -------------------------------------------------------------------------------------


def _matrix(spark, sf_dir) -> DataFrame:
    kind = F.get(F.array(*[F.lit(x) for x in ("MT-", "RPS", "HB", "G", "K")]), (F.col("l_partkey") % 5).cast("int"))
    gene = F.concat(kind, (F.col("l_partkey") % 40).cast("string"))
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("cell_id"), gene.alias("gene")).agg(F.sum("l_quantity").alias("value"))


_MATRIX = """
 m AS (SELECT l_orderkey AS cell_id, (['MT-', 'RPS', 'HB', 'G', 'K'])[l_partkey % 5 + 1] || (l_partkey % 40) AS gene, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2)"""
_CELLS = """
 q AS (SELECT cell_id, sum(value) AS total, count(*) FILTER (value > 0) AS genes, 100 * coalesce(sum(value) FILTER (gene LIKE 'MT-%'), 0) / sum(value) AS mt,
   100 * coalesce(sum(value) FILTER (regexp_matches(gene, '^HB[^(P)]')), 0) / sum(value) AS hb FROM m GROUP BY 1)"""


@query("cell_quality", f"""WITH {_MATRIX}, {_CELLS}
SELECT cell_id, total AS total_counts, genes AS n_genes_by_counts, round(mt, 6) AS pct_counts_mt, round(hb, 6) AS pct_counts_hb, round(ln(1 + total), 6) AS log1p_total_counts FROM q""")
def cell_quality(spark, sf_dir):
    rounded = [F.round(c, 6).alias(c) for c in ("pct_counts_mt", "pct_counts_hb", "log1p_total_counts")]
    return X.quality(_matrix(spark, sf_dir)).select("cell_id", "total_counts", "n_genes_by_counts", *rounded)


@query("cell_filter", f"""WITH {_MATRIX}, {_CELLS}, k AS (SELECT m.*, genes, mt FROM m JOIN q USING (cell_id) WHERE genes >= 3),
g AS (SELECT gene FROM k GROUP BY 1 HAVING count(*) FILTER (value > 0) >= 20)
SELECT cell_id, gene, value FROM k SEMI JOIN g USING (gene) WHERE genes < 7 AND mt < 50""")
def cell_filter(spark, sf_dir):
    return X.filtered(_matrix(spark, sf_dir), min_genes=3, min_cells=20, max_genes=7, max_pct_mt=50.0)


@query("gene_sums_normalised", f"""WITH {_MATRIX}, {_CELLS}
SELECT gene, round(sum(ln(1 + value / total * 10000)), 4) AS total FROM m JOIN q USING (cell_id) GROUP BY 1""")
def gene_sums_normalised(spark, sf_dir):
    return X.log_normalised(_matrix(spark, sf_dir)).groupBy("gene").agg(F.round(F.sum("value"), 4).alias("total"))


def _clusters(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("cell_id"), F.col("o_orderstatus").alias("cluster"))


_MEANS = f"{_MATRIX}, c AS (SELECT o_orderstatus AS cluster, gene, avg(value) AS mean FROM m JOIN orders ON cell_id = o_orderkey GROUP BY 1, 2)"


@query("cluster_gene_means", f"WITH {_MEANS} SELECT cluster, gene, round(mean, 6) AS mean FROM c")
def cluster_gene_means(spark, sf_dir):
    return X.cluster_means(_matrix(spark, sf_dir), _clusters(spark, sf_dir)).withColumn("mean", F.round("mean", 6))


@query("cluster_top_genes", f"WITH {_MEANS} SELECT gene FROM c WHERE cluster = 'O' ORDER BY mean DESC, gene LIMIT 10")
def cluster_top_genes(spark, sf_dir):
    return X.enrichment_genes(None, X.cluster_means(_matrix(spark, sf_dir), _clusters(spark, sf_dir)), "O", 10)


@query("marker_dot_plot", f"""WITH {_MEANS}, z AS (SELECT cluster, gene, (mean - avg(mean) OVER (PARTITION BY gene)) / stddev_samp(mean) OVER (PARTITION BY gene) AS z FROM c WHERE gene IN ('MT-0', 'RPS1', 'G3'))
SELECT cluster, gene, round(z, 5) AS value, round(abs(z), 5) AS size FROM z WHERE z IS NOT NULL""")
def marker_dot_plot(spark, sf_dir):
    means = X.cluster_means(_matrix(spark, sf_dir), _clusters(spark, sf_dir))
    return X.dot_plot(means, ["MT-0", "RPS1", "G3"]).select("cluster", "gene", F.round("value", 5).alias("value"), F.round("size", 5).alias("size"))


@query("cluster_rank_tests", f"""WITH {_MATRIX}, x AS (SELECT o_orderstatus AS cluster, gene, value FROM m JOIN orders ON cell_id = o_orderkey),
r AS (SELECT *, rank() OVER (PARTITION BY gene ORDER BY value) + (count(*) OVER (PARTITION BY gene, value) - 1) / 2.0 AS r FROM x),
s AS (SELECT gene, cluster, sum(r) AS r, count(*)::DOUBLE AS n, sum(value) AS v FROM r GROUP BY 1, 2), w AS (SELECT gene, count(*) AS n, sum(value) AS v FROM x GROUP BY 1)
SELECT s.cluster, s.gene, s.r - s.n * (s.n + 1) / 2 AS u,
  CASE WHEN w.n = s.n THEN 0 ELSE round(log2((s.v / s.n + 1e-9) / ((w.v - s.v) / (w.n - s.n) + 1e-9)), 6) END AS log2fc FROM s JOIN w USING (gene)""")
def cluster_rank_tests(spark, sf_dir):
    found = X.cluster_markers(_matrix(spark, sf_dir), _clusters(spark, sf_dir))
    return found.select("cluster", "gene", "u", F.round("log2fc", 6).alias("log2fc"))


@query("variable_genes", f"""WITH {_MATRIX}, n AS (SELECT count(DISTINCT cell_id) AS n FROM m), s AS (SELECT gene, sum(value) AS s, sum(value * value) AS ss FROM m GROUP BY 1),
d AS (SELECT gene, s / n AS mean, ln((ss - s * s / n) / (n - 1) / (s / n) + 1e-12) AS d FROM s, n),
b AS (SELECT *, ntile(5) OVER (ORDER BY mean, gene) AS bin FROM d),
z AS (SELECT gene, (d - avg(d) OVER (PARTITION BY bin)) / coalesce(nullif(stddev_samp(d) OVER (PARTITION BY bin), 0), 1) AS z FROM b)
SELECT gene, round(z, 4) AS score FROM z ORDER BY z DESC, gene LIMIT 10""")
def variable_genes(spark, sf_dir):
    return X.variable_genes(_matrix(spark, sf_dir), 10, bins=5).select("gene", F.round("score", 4).alias("score"))


@query("gene_alignment", f"""WITH {_MATRIX}, g AS (SELECT unnest(['MT-0', 'G3', 'none']) AS gene)
SELECT g.gene, count(*) AS n, sum(coalesce(value, 0)) AS total FROM (SELECT DISTINCT cell_id FROM m) CROSS JOIN g LEFT JOIN m USING (cell_id, gene) GROUP BY 1""")
def gene_alignment(spark, sf_dir):
    genes = spark.createDataFrame([("MT-0",), ("G3",), ("none",)], "gene string")
    return X.aligned_to_genes(_matrix(spark, sf_dir), genes).groupBy("gene").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("cluster_centroids", """
SELECT c_mktsegment AS cluster, round(avg(c_acctbal), 5) AS x, round(avg(c_custkey), 5) AS y, round(avg(c_nationkey), 5) AS pseudotime, count(*) AS n FROM customer WHERE c_acctbal >= 0 GROUP BY 1""")
def cluster_centroids(spark, sf_dir):
    cells = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("cluster"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).otherwise(float("nan")).alias("UMAP_0"),
        F.col("c_custkey").cast("double").alias("UMAP_1"), F.col("c_nationkey").cast("double").alias("dpt_pseudotime"),
    )
    return X.centroids(cells).select("cluster", *[F.round(c, 5).alias(c) for c in ("x", "y", "pseudotime")], "n")


@query("group_means", """
SELECT p_brand, avg(p_size) AS avg_p_size, count(p_size) AS count_p_size, round(avg(p_retailprice) FILTER (p_size > 5), 6) AS avg_price, count(p_retailprice) FILTER (p_size > 5) AS count_price
FROM part GROUP BY 1 ORDER BY 1 LIMIT 10""")
def group_means(spark, sf_dir):
    price = F.when(F.col("p_size") > 5, F.col("p_retailprice")).otherwise(float("nan"))
    rows = table(spark, sf_dir, "part").select("p_brand", F.col("p_size").cast("double").alias("p_size"), price.alias("price"))
    return R.group_mean_counts(rows, "p_brand", ["p_size", "price"]).withColumn("avg_price", F.round("avg_price", 6))


# --- registry -----------------------------------------------------------------------------------------


def _models(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("model_id"), F.col("p_name").alias("model_name"), F.upper("p_name").alias("model_display_name"), F.lit("v1").alias("model_source_version"),
        F.col("p_type").alias("model_uc_name"), F.col("p_size").alias("model_uc_version"), F.col("p_brand").alias("model_category"), (F.col("p_size") % 2 == 0).alias("is_active"),
    )


def _deployments(spark, sf_dir) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("deployment_id"), (key % 97).alias("model_id"), F.concat(F.lit("d"), key.cast("string")).alias("deployment_name"),
        F.col("o_orderpriority").alias("deployment_description"), F.lit("e").alias("model_endpoint_name"), (F.col("o_orderstatus") == "O").alias("is_active"),
    )


@query("available_models", """
SELECT p_partkey AS model_id, p_name AS model_name, upper(p_name) AS model_display_name, 'v1' AS model_source_version, p_type AS model_uc_name, p_size AS model_uc_version
FROM part WHERE p_brand = 'Brand#13' AND p_size % 2 = 0 ORDER BY 1 DESC""")
def available_models(spark, sf_dir):
    return G.available_models(_models(spark, sf_dir), "Brand#13")


@query("deployed_models", """
SELECT p_partkey AS model_id, o_orderkey AS deployment_id, 'd' || o_orderkey AS deployment_name, o_orderpriority AS deployment_description, upper(p_name) AS model_display_name,
  'v1' AS model_source_version, p_type || '/' || p_size AS uc_name, 'e' AS model_endpoint_name
FROM orders JOIN part ON o_orderkey % 97 = p_partkey WHERE o_orderstatus = 'O' AND p_brand = 'Brand#13' ORDER BY 2 DESC""")
def deployed_models(spark, sf_dir):
    return G.deployed_models(_deployments(spark, sf_dir), _models(spark, sf_dir), "Brand#13")


@query("latest_deployment", """
SELECT max(o_orderkey) AS deployment_id FROM orders JOIN part ON o_orderkey % 97 = p_partkey WHERE o_orderstatus = 'O' AND p_brand = 'Brand#13'""")
def latest_deployment(spark, sf_dir):
    models = _models(spark, sf_dir).drop("is_active")
    return G.latest_active(_deployments(spark, sf_dir), models, F.col("model_category") == "Brand#13").select("deployment_id")


@query("batch_models", """
SELECT s_name AS model_display_name, 'b' AS model_category, (s_nationkey % 3)::VARCHAR AS module, 'cpu' AS cluster_type, 'j' AS job_name, s_suppkey AS job_id FROM supplier WHERE s_acctbal > 0""")
def batch_models(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("model_display_name"), F.lit("b").alias("model_category"), (F.col("s_nationkey") % 3).cast("string").alias("module"),
        F.lit("cpu").alias("cluster_type"), F.lit("j").alias("job_name"), F.col("s_suppkey").alias("job_id"), (F.col("s_acctbal") > 0).alias("is_active"),
    )
    return G.batch_models(rows)


@query("group_removal", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey % 2 = 0 AND c_acctbal > 0 THEN 'lab' ELSE 'users,lab' || CASE WHEN c_nationkey % 3 = 0 THEN ',users' ELSE '' END END AS groups,
  CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey % 2 = 0 AND c_acctbal > 0 THEN 'me' ELSE 'setup' END AS updated_by FROM customer""")
def group_removal(spark, sf_dir):
    users, lab = F.lit("users"), F.lit("lab")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("module_name"), F.when(F.col("c_nationkey") % 2 == 1, "sub").alias("submodule_name"),
        F.when(F.col("c_nationkey") % 3 == 0, F.array(users, lab, users)).otherwise(F.array(users, lab)).alias("groups"),
        (F.col("c_acctbal") > 0).alias("is_active"), F.lit(None).cast("timestamp").alias("updated_at"), F.lit("setup").alias("updated_by"),
    )
    done = G.remove_group(rows, "BUILDING", None, "users", "me")
    return done.select("c_custkey", F.array_join("groups", ",").alias("groups"), "updated_by")


def _weights(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ft_id"), F.col("o_orderpriority").alias("ft_label"), F.col("o_orderstatus").alias("dataset_type"), F.lit("t").alias("task_names"),
        F.lit("r").alias("run_id"), F.col("o_orderdate").alias("created_datetime"), F.lit("w").alias("weights_volume_location"), (F.col("o_totalprice") > 200000).alias("is_active"),
    )


@query("active_fine_tunes", """
SELECT o_orderkey::VARCHAR AS ft_id, o_orderpriority AS ft_label, o_orderstatus AS dataset_type, 't' AS task_names, 'r' AS run_id FROM orders WHERE o_totalprice > 200000""")
def active_fine_tunes(spark, sf_dir):
    return G.active_fine_tunes(_weights(spark, sf_dir)).drop("created_datetime")


@query("latest_fine_tune", """
SELECT o_orderkey AS ft_id, o_orderpriority AS ft_label, o_orderstatus AS dataset_type, 't' AS task_names, 'w' AS weights_volume_location FROM orders WHERE o_totalprice > 200000
ORDER BY 1 DESC LIMIT 1""")
def latest_fine_tune(spark, sf_dir):
    return G.fine_tune(_weights(spark, sf_dir))


@query("list_removal", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'x,z' ELSE 'x,y' || p_size || ',z' END AS ids FROM part")
def list_removal(spark, sf_dir):
    item = F.when(F.col("p_size") % 3 == 0, "7").otherwise(F.concat(F.lit("y"), F.col("p_size").cast("string")))
    csv = F.concat_ws(",", F.lit("x"), item, F.lit("z"))
    return table(spark, sf_dir, "part").select("p_partkey", G.remove_from_list(csv, "7").alias("ids"))


@query("access_by_level", """
SELECT bool_or(c_acctbal > 0 AND c_mktsegment = 'BUILDING' AND c_nationkey IN (3, 6) AND c_custkey % 2 = 0) AS granted FROM customer""")
def access_by_level(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("module_name"), F.lit(None).cast("string").alias("submodule_name"), F.when(F.col("c_custkey") % 2 == 0, "full").otherwise("view").alias("access_level"),
        F.array(F.concat(F.lit("g"), F.col("c_nationkey").cast("string"))).alias("groups"), (F.col("c_acctbal") > 0).alias("is_active"),
    )
    return G.has_access(rows, "BUILDING", "any", "full", ["g3", "g6"])


@query("user_settings", "SELECT count(DISTINCT event_type)::INT AS n, 'on' AS click FROM events WHERE user_id = 3 AND event_type != 'error'")
def user_settings(spark, sf_dir):
    rows = table(spark, sf_dir, "events").where("event_type != 'error'").select(F.col("user_id").cast("string").alias("user_email"), F.col("event_type").alias("key"), F.lit("on").alias("value"))
    return G.settings_map(rows.distinct(), "3").select(F.size("settings").alias("n"), F.coalesce(F.try_element_at("settings", F.lit("click")), F.lit("on")).alias("click"))


@query("setting_value", "SELECT r_name AS value FROM region WHERE r_regionkey = 2")
def setting_value(spark, sf_dir):
    return G.lookup_value(table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("key"), F.col("r_name").alias("value")), "2")


@query("run_search", """
SELECT event_id AS run_id FROM events WHERE event_type = 'purchase' AND lower('Run ' || user_id) LIKE '%run 1%' ORDER BY ts DESC, event_id LIMIT 100""")
def run_search(spark, sf_dir):
    runs = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"), F.concat(F.lit("Run "), F.col("user_id").cast("string")).alias("run_name"),
        F.create_map(F.lit("kind"), F.col("event_type")).alias("tags"), F.unix_micros(F.col("ts").cast("timestamp")).alias("start_time"),
    )
    return G.search_runs(runs, {"kind": "purchase"}, "RUN 1").select("run_id")


@query("run_metrics", "SELECT event_id AS step, value FROM events WHERE user_id = 5 AND event_type = 'view' ORDER BY 1")
def run_metrics(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("name"), F.col("event_id").alias("step"), "value")
    return G.metric_history(rows, "5", "view")


@query("run_status", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND upper(o_orderpriority) NOT IN ('COMPLETE', '5-LOW') OR o_orderstatus = 'F' THEN 'failed' ELSE o_orderpriority END AS status FROM orders""")
def run_status(spark, sf_dir):
    life = F.when(F.col("o_orderstatus") == "F", "KILLED").otherwise("RUNNING")
    return table(spark, sf_dir, "orders").select("o_orderkey", G.reconciled_status(life, F.col("o_orderpriority")).alias("status"))


@query("published_rows", "SELECT n_name, 'a' AS source FROM nation WHERE n_regionkey != 1 UNION ALL SELECT r_name, 'b' FROM region")
def published_rows(spark, sf_dir):
    old = table(spark, sf_dir, "nation").select("n_name", F.when(F.col("n_regionkey") == 1, "b").otherwise("a").alias("source"))
    return G.publish(old, table(spark, sf_dir, "region").select(F.col("r_name").alias("n_name")), "b")


@query("catalogue_nodes", "SELECT r_name AS type, r_regionkey AS size FROM region WHERE r_regionkey < 3")
def catalogue_nodes(spark, sf_dir):
    node = F.when(F.col("r_regionkey") < 3, F.to_json(F.struct(F.col("r_name").alias("type"), F.col("r_regionkey").alias("size")))).otherwise("{broken")
    rows = table(spark, sf_dir, "region").select(F.col("r_name").alias("type"), node.alias("node_json"), F.lit(True).alias("is_active"))
    return G.catalog_nodes(rows, rows.where("false"), "type string, size int")


# --- joins, searches, expressions, dashboards ---------------------------------------------------------


@query("first_match", """
SELECT c_custkey, o_orderkey FROM customer JOIN (SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS o_orderkey FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def first_match(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderkey").alias("place"))
    return J.first_match_join(table(spark, sf_dir, "customer").select("c_custkey"), orders, "c_custkey", "o_orderkey", "place")


_SYMBOLS = "m AS (SELECT n_name, 'ENSG' || n_nationkey AS gene FROM nation WHERE n_nationkey % 2 = 0), s AS (SELECT n_name AS symbol FROM nation UNION ALL SELECT 'ENSG7' UNION ALL SELECT 'none')"


def _symbols(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    known = nation.where("n_nationkey % 2 = 0").select("n_name", F.concat(F.lit("ENSG"), F.col("n_nationkey").cast("string")).alias("gene"))
    return nation.select(F.col("n_name").alias("symbol")).unionByName(spark.createDataFrame([("ENSG7",), ("none",)], "symbol string")), known


@query("gene_symbols", f"WITH {_SYMBOLS} SELECT upper(coalesce(gene, symbol)) AS symbol FROM s LEFT JOIN m ON symbol = n_name")
def gene_symbols(spark, sf_dir):
    symbols, known = _symbols(spark, sf_dir)
    return J.lookup_or_keep(symbols, "symbol", known, "n_name", "gene")


@query("gene_symbol_counts", f"""WITH {_SYMBOLS}
SELECT count(*) AS total, count(*) FILTER (symbol LIKE 'ENSG%') AS already_ids, count(*) FILTER (symbol NOT LIKE 'ENSG%' AND gene IS NOT NULL) AS mapped,
  count(*) FILTER (symbol NOT LIKE 'ENSG%' AND gene IS NULL) AS unmapped FROM s LEFT JOIN m ON symbol = n_name""")
def gene_symbol_counts(spark, sf_dir):
    symbols, known = _symbols(spark, sf_dir)
    return J.lookup_counters(symbols, "symbol", known, "n_name", "gene")


@query("valid_scores", "SELECT p_partkey, CASE WHEN p_size > 10 THEN p_retailprice * 2 END AS score FROM part")
def valid_scores(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    return J.score_valid(part, "p_partkey", F.col("p_size") > 10, lambda df: df.withColumn("score", F.col("p_retailprice") * 2)).select("p_partkey", "score")


@query("top_by_field", "SELECT event_id FROM events ORDER BY coalesce(value, 0) DESC, event_id LIMIT 7")
def top_by_field(spark, sf_dir):
    return R.select_top_k(table(spark, sf_dir, "events"), "value", 7, "event_id").select("event_id")


@query("first_of_group", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def first_of_group(spark, sf_dir):
    return R.first_per_key(table(spark, sf_dir, "events"), "user_id", "event_id").select("user_id", "event_id")


@query("label_codes", "SELECT c_custkey, coalesce(dense_rank() OVER (ORDER BY c_mktsegment) - 1, -1)::INT AS phenotype FROM customer")
def label_codes(spark, sf_dir):
    return C.label_encoded(table(spark, sf_dir, "customer"), "c_mktsegment").select("c_custkey", "phenotype")


@query("prepared_phenotype", "SELECT c_custkey AS \"sampleId\", c_nationkey AS phenotype FROM customer")
def prepared_phenotype(spark, sf_dir):
    return V.prepare_phenotype(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("Sample name"), F.col("c_nationkey").alias("the group")), "the group")


@query("scalar_expressions", """
SELECT p_partkey, round(log2((p_retailprice + 1e-9) / (p_size + 1e-9)), 6) AS ratio, round(-log10(greatest(p_size / 100.0, 1e-300)), 6) AS capped,
  round(1 / (1 + exp(-((p_size - 25) / 5.0))), 6) AS anchored, substr(p_name, 1, 7) AS cut, CASE WHEN p_size >= 35 THEN 'High' WHEN p_size >= 15 THEN 'Medium' ELSE 'Low' END AS band,
  coalesce(nullif(CASE WHEN p_size % 2 = 0 THEN '' ELSE p_name END, ''), p_brand) AS kept, try_cast(CASE WHEN p_size % 4 = 0 THEN p_size::VARCHAR ELSE p_brand END AS DOUBLE) AS number,
  substr(regexp_replace(p_brand, '[^A-Za-z0-9_.\\-]+', '_', 'g'), 1, 100) AS artifact, p_name || ' [OS=' || p_type || ']' || CASE WHEN p_size % 2 = 0 THEN '' ELSE ' [GN=' || p_brand || ']' END AS described,
  CASE WHEN p_size > 0 THEN round(-log10(p_size / 50.0), 6) + 0.0 END AS score, p_size % 2 = 0 AS finite FROM part""")
def scalar_expressions(spark, sf_dir):
    size, even = F.col("p_size").cast("double"), F.col("p_size") % 2 == 0
    text = F.when(F.col("p_size") % 4 == 0, F.col("p_size").cast("string")).otherwise(F.col("p_brand"))
    columns = {
        "ratio": F.round(C.log2_ratio(F.col("p_retailprice"), size), 6), "capped": F.round(C.capped_log10(size / 100), 6), "anchored": F.round(C.anchored_sigmoid(size, 25, 5), 6),
        "cut": C.truncated(F.col("p_name"), 7), "band": C.risk_band(size / 50), "kept": C.or_else(F.when(even, "").otherwise(F.col("p_name")), F.col("p_brand")),
        "number": C.as_number(text), "artifact": C.artifact_name(F.col("p_brand")), "described": C.described(F.col("p_name"), F.col("p_type"), F.when(~even, F.col("p_brand"))),
        "score": F.round(C.minus_log10(size / 50), 6) + 0.0, "finite": C.is_finite(F.when(even, size).otherwise(float("nan"))),
    }
    return table(spark, sf_dir, "part").withColumns(columns).select("p_partkey", *columns)


@query("perturbed_expression", "SELECT vec_id, list_transform(embedding, lambda x, i: CASE WHEN i IN (2, 3) THEN list_max(embedding) ELSE x END) AS levels FROM embeddings")
def perturbed_expression(spark, sf_dir):
    genes = F.transform(F.sequence(F.lit(1), F.size("embedding")), lambda i: F.concat(F.lit("g"), i.cast("string")))
    return table(spark, sf_dir, "embeddings").select("vec_id", C.perturbed(F.col("embedding"), genes, ["g2", "g3"], knockout=False).alias("levels"))


@query("marked_regions", "SELECT p_partkey, 3 AS start, 3 + length(p_brand) AS \"end\", 'abc' || p_brand || p_name AS raw FROM part")
def marked_regions(spark, sf_dir):
    marked = C.marked_region(F.concat(F.lit("abc["), F.col("p_brand"), F.lit("]"), F.col("p_name")))
    return table(spark, sf_dir, "part").select("p_partkey", marked.alias("m")).select("p_partkey", "m.*")


@query("pooled_vectors", "SELECT label, round(avg(embedding[1]), 5) AS first, round(avg(embedding[2]), 5) AS second FROM embeddings WHERE vec_id % 3 != 0 GROUP BY 1")
def pooled_vectors(spark, sf_dir):
    kept = F.when(F.col("vec_id") % 3 != 0, 1).otherwise(0)
    grouped = table(spark, sf_dir, "embeddings").groupBy("label").agg(
        F.collect_list(F.struct(F.slice(F.transform("embedding", lambda x: x.cast("double")), 1, 2).alias("h"), kept.alias("m"))).alias("r")
    )
    pooled = grouped.select("label", C.mean_pooled(F.col("r.h"), F.col("r.m")).alias("p"))
    return pooled.select("label", F.round(F.get("p", F.lit(0)), 5).alias("first"), F.round(F.get("p", F.lit(1)), 5).alias("second"))


@query("extracted_fields", "SELECT event_id, json_extract_string(props, '$.k') AS taken, json_extract_string(props, '$.k') AS k, NULL::VARCHAR AS other FROM events")
def extracted_fields(spark, sf_dir):
    props = F.col("props")
    events = table(spark, sf_dir, "events").select("event_id", C.extracted(props, "*").alias("taken"), C.mapped(props, {"k": "k", "other": "k.none"}).alias("m"))
    return events.select("event_id", "taken", "m.k", "m.other")


@query("invalid_residues", "SELECT p_partkey, len(list_distinct(list_filter(string_split(upper(p_name), ''), lambda x: NOT contains('ACDEFGHIKLMNPQRSTVWY', x))))::INT AS n FROM part")
def invalid_residues(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.size(C.invalid_residues(F.col("p_name"))).alias("n"))


@query("iteration_summary", """
SELECT CAST(date_trunc('day', ts) AS DATE) AS iteration, max(value) AS max_reward, round(avg(value), 6) AS mean_reward, count(*) FILTER (value > 50 AND user_id <= 40) AS survivors, count(*) AS n
FROM events GROUP BY 1""")
def iteration_summary(spark, sf_dir):
    scored = table(spark, sf_dir, "events").select(F.date_trunc("day", "ts").cast("date").alias("iteration"), F.col("value").alias("reward"), "user_id")
    found = O.iteration_summary(scored, O.feasible(F.col("reward"), F.col("user_id"), 50.0000001, 40))
    return found.withColumn("mean_reward", F.round("mean_reward", 6))


@query("stop_reasons", """
WITH d AS (SELECT (epoch(date_trunc('day', ts)) // 86400)::INT AS iteration, max(value) AS top, count(*) FILTER (value > 90) AS good FROM events GROUP BY 1),
h AS (SELECT iteration, max(top) OVER w AS best, sum(good) OVER w AS n FROM d WINDOW w AS (ORDER BY iteration ROWS UNBOUNDED PRECEDING)),
c AS (SELECT *, coalesce(best - lag(best, 3) OVER (ORDER BY iteration) < 0.01, false) AS done FROM h)
SELECT iteration, CASE WHEN best >= 1e9 THEN 'target_reward' WHEN n >= 200 THEN 'best_k' WHEN done THEN 'converged' WHEN iteration >= 19740 THEN 'max_iterations' END AS stop_reason FROM c""")
def stop_reasons(spark, sf_dir):
    day = F.date_diff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")).alias("iteration")
    days = table(spark, sf_dir, "events").groupBy(day).agg(F.max("value").alias("top"), F.count_if(F.col("value") > 90).alias("good"))
    rules = O.history_rules(days, "iteration", "top", "good", window=3, threshold=0.01)
    return O.stop_reason(rules, "iteration", 1e9, 200, 19740).select("iteration", "stop_reason")


def _usage(spark, sf_dir) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    usage = line.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").cast("string")).alias("record_id"), (F.col("l_suppkey") % 3).cast("string").alias("workspace_id"),
        F.col("l_shipdate").alias("usage_start_time"), (F.col("l_shipdate") + F.expr("interval 90 minutes")).alias("usage_end_time"), F.col("l_shipdate").cast("date").alias("usage_date"),
        F.col("l_quantity").alias("usage_quantity"), F.struct((F.col("l_partkey") % 50).alias("job_id"), (F.col("l_linenumber") % 4).alias("job_run_id")).alias("usage_metadata"),
        F.create_map(F.lit("application"), F.when(F.col("l_returnflag") == "R", "bench").otherwise("other"), F.lit("module"), F.col("l_linestatus"), F.lit("user"), (F.col("l_suppkey") % 5).cast("string")).alias("custom_tags"),
        F.lit("JOBS").alias("billing_origin_product"),
    )
    timeline = table(spark, sf_dir, "part").select(
        (F.col("p_partkey") % 3).cast("string").alias("workspace_id"), (F.col("p_partkey") % 50).alias("job_id"), (F.col("p_size") % 4).alias("run_id"),
        F.col("p_partkey").alias("period_start_time"), F.col("p_brand").alias("termination_code"),
    )
    return D.usage_fact(usage, timeline, "bench")


_USAGE = """
 u AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::INT) AS record_id, l_suppkey % 3 AS w, l_partkey % 50 AS j, l_linenumber % 4 AS r, l_linestatus AS module, (l_suppkey % 5)::VARCHAR AS "user", l_quantity AS q
   FROM lineitem WHERE l_returnflag = 'R'),
 f AS (SELECT u.*, p_partkey, p_brand, row_number() OVER (PARTITION BY record_id ORDER BY p_partkey DESC NULLS LAST, p_brand DESC NULLS LAST) AS k
   FROM u LEFT JOIN part ON w = p_partkey % 3 AND j = p_partkey % 50 AND r = p_size % 4)"""


@query("usage_fact", f"""WITH {_USAGE} SELECT record_id, module, "user", q AS usage_quantity, 5400::BIGINT AS seconds, p_partkey AS period_start_time, p_brand AS termination_code FROM f WHERE k = 1""")
def usage_fact(spark, sf_dir):
    return _usage(spark, sf_dir).select("record_id", "module", "user", "usage_quantity", "seconds", "period_start_time", "termination_code")


@query("usage_widgets", f"""WITH {_USAGE} SELECT module, "user", count(*) AS n FROM f WHERE k = 1 GROUP BY 1, 2""")
def usage_widgets(spark, sf_dir):
    return D.widgets(_usage(spark, sf_dir))["heatmap"]


@query("usage_counters", f"""WITH {_USAGE} SELECT count(DISTINCT "user") AS users, count(DISTINCT module) AS modules, sum(q) AS quantity FROM f WHERE k = 1""")
def usage_counters(spark, sf_dir):
    return D.widgets(_usage(spark, sf_dir))["counters"]
