"""Operators that SQL does not express, against values worked out by hand or by numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.functions import alignment, columns, stats
from strandline.operators import dashboards, genomics, joins, optimize, registry, relational, sampling, scoring, singlecell
from strandline.plans import catalog
from strandline.sources import files, sinks

VCF = """##fileformat=VCFv4.2
##INFO=<ID=AC,Number=A,Type=Integer,Description="count">
##INFO=<ID=CLINVAR,Number=0,Type=Flag,Description="flag">
##INFO=<ID=GENE,Number=1,Type=String,Description="gene">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2
chr1\t101\trs1\tA\tG\t50\tPASS\tAC=2;GENE=BRCA;CLINVAR\tGT:DP\t0/1:80\t1|1:20
chrX\t20\t.\tAG\tA\t.\t.\tAC=1,3\tGT\t./.\t0/0
"""


def joined_rows(df):
    """Rows made by the joins of a DataFrame's plan when it is collected."""
    df.collect()

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        made = node.metrics().get("numOutputRows") if "Join" in name else None
        children = node.children()
        return (made.get().value() if made is not None and made.isDefined() else 0) + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_vcf(spark, tmp_path):
    (tmp_path / "a.vcf").write_text(VCF)
    a, b = files.read_vcf(spark, str(tmp_path / "a.vcf")).orderBy("contigName").collect()
    assert (a.start, a.end, a.names, a.qual, a.INFO_AC, a.INFO_CLINVAR, a.INFO_GENE) == (100, 101, ["rs1"], 50.0, [2], True, "BRCA")
    assert [g.calls for g in a.genotypes] == [[0, 1], [1, 1]] and [g.calls for g in b.genotypes] == [[-1, -1], [0, 0]]
    assert b.names == [] and b.qual is None and b.INFO_AC == [1, 3] and b.INFO_CLINVAR is False


def test_text_formats(spark, tmp_path):
    (tmp_path / "x.fasta").write_text(">a one two\nMKT\nAYI\n\n>sp|P1|E_H Some protein OS=Homo sapiens OX=9 GN=TP53 PE=1\nGGG")
    fasta = files.read_fasta(spark, str(tmp_path / "x.fasta")).collect()
    assert [(r.seq_id, r.sequence, r.seq_length) for r in fasta] == [("a", "MKTAYI", 6), ("sp|P1|E_H", "GGG", 3)]
    u = files.read_uniprot(spark, str(tmp_path / "x.fasta")).first()
    assert (u.gene, u.accession, u.entry_name, u.protein_name, u.organism) == ("TP53", "P1", "E_H", "Some protein", "Homo sapiens")
    (tmp_path / "g.gmt").write_text("T1\td\tA\tB\nshort\td\nT1\td\tC\t\tC\n")
    assert [tuple(r) for r in files.read_gmt(spark, str(tmp_path / "g.gmt")).collect()] == [("T1", "C")]
    (tmp_path / "b.tsv").write_text("!note\nx\ty\n1\t2\n3\n")
    assert [tuple(r) for r in files.read_commented_tsv(spark, str(tmp_path / "b.tsv")).collect()] == [("1", "2"), ("3", "")]
    (tmp_path / "p.bed").write_text("#c\nchr1\t10\t20\tG\t0\t+\tcat\tcond\n")
    assert files.read_bed(spark, str(tmp_path / "p.bed")).first().chromEnd == 20
    (tmp_path / "c.csv").write_text("name,score\na,1\n")
    assert files.csv_column(spark, str(tmp_path / "c.csv"), "score").first().value == 1
    assert files.csv_column(spark, str(tmp_path / "c.csv"), "nope").count() == 0
    (tmp_path / "s.sto").write_text("# STOCKHOLM 1.0\ns1 AB-\ns2 ABC\n\ns1 D\ns2 E\n//\n")
    assert {r.name: r.sequence for r in files.read_stockholm(spark, str(tmp_path / "s.sto")).collect()} == {"s1": "AB-D", "s2": "ABCE"}
    atom = "ATOM      1  CA  ALA A   1      11.104   6.134  -6.504  1.00 80.00           C"
    pdb = spark.createDataFrame([(atom + "\n" + atom.replace("80.00", "60.00"),), ("",)], "p string")
    assert [r[0] for r in pdb.select(files.mean_plddt(F.col("p"))).collect()] == [70.0, 0.0]
    (tmp_path / "m.a3m").write_text(">q\nAB\n>t\nAxyB\n")
    assert [(r.aligned, r.deletions) for r in files.read_a3m(spark, str(tmp_path / "m.a3m")).collect()][1] == ("AB", [0, 2])


def test_sinks(spark, tmp_path):
    df = spark.range(10).withColumn("v", F.array(F.lit(1.0), F.lit(2.0)))
    sinks.stage_shards(df, "id", 3, str(tmp_path / "s"))
    assert sinks.parquet_dir(spark, str(tmp_path / "s")).count() == 10
    assert {r._change for r in sinks.changes(df.limit(0), df.select("id", "v")).collect()} == {"insert"}
    assert not sinks.populated(spark, "no_such_table")
    assert sinks.run_table("t", "My Run!", "0123456789") == "t__my_run_01234567"


def test_genotypes(spark):
    rows = [("1", 5, "A", ["G"], [("a", [0, 1]), ("b", [1, 1]), ("c", [-1, -1]), ("d", [0, 0])])]
    schema = "contigName string, start long, referenceAllele string, alternateAlleles array<string>, genotypes array<struct<sampleId:string,calls:array<int>>>"
    v = spark.createDataFrame(rows, schema)
    states = columns.genotype_states(F.col("genotypes"))
    r = v.select(columns.carriers(F.col("genotypes")).alias("c"), states.alias("s"), columns.mean_substituted(states).alias("m"), columns.zygosity(F.col("genotypes")).alias("z")).first()
    assert (r.c, r.s, r.m, r.z) == (["a", "b"], [1.0, 2.0, -1.0, 0.0], [1.0, 2.0, 1.0, 0.0], "Heterozygous")
    h = genomics.with_statistics(v).first()
    assert (h.nCalled, h.nHomRef, h.nHet, h.nHomAlt) == (3, 1, 1, 1) and h.pValueHwe == pytest.approx(1.0)
    assert stats._hwe_exact(50, 0, 50) < 1e-20 and stats._hwe_exact(25, 50, 25) == pytest.approx(1.0, abs=1e-6)


def test_variant_normalisation(spark):
    rows = [("1", 10, "CAAG", ["CAG"]), ("1", 3, "A", ["T"]), ("1", 6, "AA", ["A"])]
    v = spark.createDataFrame(rows, "contigName string, start long, referenceAllele string, alternateAlleles array<string>")
    got = sorted((r.start, r.referenceAllele, r.alternateAlleles[0]) for r in genomics.trimmed(v).collect())
    assert got == [(3, "A", "T"), (6, "AA", "A"), (10, "CA", "C")]
    shifted = genomics.left_aligned(v.where("start = 6"), {"1": "GGCTTAAAA"}).first()
    assert (shifted.start, shifted.referenceAllele, shifted.alternateAlleles) == (4, "TA", ["T"])


def test_association_finds_the_effect(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 300)
    x = {"hit": np.clip(y + rng.integers(0, 2, 300), 0, 2), "null": rng.integers(0, 3, 300)}
    calls = lambda n: [[0, 0], [0, 1], [1, 1]][n]
    rows = [("1", k, "A", ["G"], [(f"s{i}", calls(int(v))) for i, v in enumerate(values)]) for k, values in enumerate(x.values())]
    schema = "contigName string, start long, referenceAllele string, alternateAlleles array<string>, genotypes array<struct<sampleId:string,calls:array<int>>>"
    phenotype = spark.createDataFrame([(f"s{i}", int(v)) for i, v in enumerate(y)], "sampleId string, phenotype int")
    got = {r.start: r for r in genomics.association(spark.createDataFrame(rows, schema), phenotype).collect()}
    assert got[0].pvalue < 1e-10 and got[0].effect > 0 and got[1].pvalue > 0.01
    summary = genomics.gwas_summary(spark.createDataFrame([(1e-6,), (0.5,), (None,)], "pvalue double")).first()
    assert (summary.total, summary.significant, summary.suggestive) == (3, 1, 1)


def test_panel_counts_without_pairs(spark):
    """Equal places and intervals are joined once, and counted as the pairs are."""
    v = spark.range(3000).selectExpr("if(id % 7 = 0, null, concat('chr', id % 2)) contigName", "if(id % 11 = 0, null, id % 30) start")
    panel = spark.range(500).selectExpr("concat('chr', id % 3) chrom", "id % 5 * 6 chromStart", "id % 5 * 6 + if(id % 4 = 3, -1, 9) chromEnd", "if(id % 10 = 0, null, concat('g', id % 4)) name")
    pairs = genomics.in_panel(v, panel, 7).groupBy("gene").agg(F.count("*").alias("n"), F.sum("start").alias("places"))
    found = genomics.panel_counts(v, panel, 7)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, pairs.collect()), key=repr) != []
    assert 100 * joined_rows(genomics.panel_counts(v, panel, 7)) < genomics.in_panel(v, panel, 7).count()


def test_samples_are_looked_up(spark):
    """The ids are no column of the rows; unknown and null ids go, null and empty lists stay."""
    rows = [(1, [("a", [0, 1]), ("b", [1, 1]), (None, [0, 0]), ("a", [0, 0])]), (2, None), (3, []), (4, [("c", [0, 0])]), (5, [("b", None), None])]
    v = spark.createDataFrame(rows, "id long, genotypes array<struct<sampleId:string,calls:array<int>>>").repartition(2)
    for ids, want in ((["a", "a", None, "z"], {1: ["a", "a"], 2: None, 3: [], 4: [], 5: []}), (["b", "c"], {1: ["b"], 2: None, 3: [], 4: ["c"], 5: ["b"]}), ([], {1: [], 2: None, 3: [], 4: [], 5: []})):
        kept = genomics.restrict_samples(v, spark.createDataFrame([(x,) for x in ids], "sampleId string"))
        assert {r.id: r.genotypes and [g.sampleId for g in r.genotypes] for r in kept.collect()} == want and kept.columns == v.columns
        assert "Join" not in kept._jdf.queryExecution().toString()


def test_annotation(spark):
    v = spark.createDataFrame([("chr1", 15, "A", ["G"], 9.0, [("s", [1, 1])]), ("chr2", 15, "A", ["G"], 9.0, [("s", [0, 1])])],
        "contigName string, start long, referenceAllele string, alternateAlleles array<string>, qual double, genotypes array<struct<sampleId:string,calls:array<int>>>")
    panel = spark.createDataFrame([("chr1", 10, 20, "BRCA", 0, "+", "c", "d")], files.BED_SCHEMA)
    clin = spark.createDataFrame([("1", 15, "A", ["G"], ["Pathogenic"], ["dis"], ["id"])],
        "contigName string, start long, referenceAllele string, alternateAlleles array<string>, INFO_CLNSIG array<string>, INFO_CLNDN array<string>, INFO_CLNVI array<string>")
    rows = genomics.annotated(genomics.in_panel(v, panel, 7), clin)
    got = rows.collect()
    assert [(r.gene, r.zygosity, r.clinical_significance) for r in got] == [("BRCA", "Homozygous Alt", ["Pathogenic"])]
    assert genomics.pathogenic(rows).count() == 1 and genomics.pathogenic_totals(rows).first().pathogenic == 1
    assert genomics.pathogenic_details(rows).first().disease_name == "dis"
    boxes = [{"name": "G", "contig": "chr2", "start": 10, "end": 30}]
    assert genomics.in_custom_regions(v.withColumn("end", F.col("start") + 1), boxes).first().gene == "G"


def test_rank_test_and_enrichment(spark):
    rows = [("g", float(v), a) for a, vs in ((True, [5, 6, 7, 7]), (False, [1, 2, 3, 7])) for v in vs] + [("h", 1.0, True), ("n", float("nan"), False), ("n", 2.0, True)]
    df = spark.createDataFrame(rows, "gene string, value double, a boolean")
    got = {r.gene: r for r in stats.differential_expression(df, "gene", "value", F.col("a")).collect()}
    assert got["g"].u == 13.0 and got["h"].p == 1.0 and got["h"].log2fc == 0.0
    ties = 3**3 - 3
    z = (13 - 8 - 0.5) / math.sqrt(16 / 12 * (9 - ties / 56))
    assert got["g"].p == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-4)
    table = spark.createDataFrame([("t", 3, 1, 1, 3)], "term string, a long, b long, c long, d long")
    assert stats.enrichment(table).first().p == pytest.approx(17 / 70)


def test_alignment():
    assert alignment.local_alignment("AWGHE", "AWHE") == (4 + 11 - 11 + 8 + 5, "AWGHE", "AW-HE")
    assert alignment.local_alignment("", "A") == (0, "", "") and alignment.local_alignment("WWW", "PPP")[0] == 0


def test_alignment_columns(spark):
    r = alignment.aligned(spark.createDataFrame([("AWGHE", "AWHE"), ("A", "")], "q string, t string"), "q", "t").collect()
    assert (r[0].score, r[0].identity, r[0].coverage, r[0].similarity) == (17, 80.0, 100.0, 80.0) and r[1].similarity == 0.0


def test_single_cell(spark):
    rows = [(f"c{i}", g, float(v)) for i in range(6) for g, v in (("MT-1", i), ("RPS2", 1), ("GENE", 10 * (i % 2)), ("FLAT", 2)) if v]
    m = spark.createDataFrame(rows, "cell_id string, gene string, value double")
    q = {r.cell_id: r for r in singlecell.quality(m).collect()}
    assert q["c1"].total_counts == 14.0 and q["c1"].pct_counts_mt == pytest.approx(100 / 14) and q["c0"].n_genes_by_counts == 2
    assert singlecell.filtered(m, 3, 5, None, 30).select("gene").distinct().count() == 3
    clusters = spark.createDataFrame([(f"c{i}", str(i % 2)) for i in range(6)], "cell_id string, cluster string")
    assert {(r.cluster, r.gene) for r in singlecell.cluster_markers(m, clusters, 1).collect()}
    means = singlecell.cluster_means(singlecell.aligned_to_genes(m, m.select("gene").distinct()), clusters)
    assert {r.size for r in singlecell.dot_plot(means, ["GENE"], False).collect()} == {0.0, 10.0}
    assert singlecell.variable_genes(m, 2, bins=1).count() == 2
    assert len(singlecell.principal_components(m, ["GENE", "MT-1"], 2).first().pc) == 2
    cells = spark.createDataFrame([("a", 0.0, 0.0, 0.3), ("b", 1.0, 0.0, 0.1), ("c", 5.0, 0.0, 0.9)], "cluster string, UMAP_0 double, UMAP_1 double, dpt_pseudotime double")
    assert sorted(tuple(r)[:2] for r in singlecell.trajectory(singlecell.centroids(cells)).collect()) == [("b", "a"), ("b", "c")]


def test_communities(spark):
    clique = [(a, b) for k in (0, 10) for a in range(k, k + 5) for b in range(a + 1, k + 5)] + [(4, 10)]
    edges = spark.createDataFrame([(a, b, 1.0) for a, b in clique], "a long, b long, w double")
    labels = {r.node: r.label for r in singlecell.communities(edges, rounds=6).collect()}
    assert len({labels[i] for i in range(5)}) <= 2 and len(labels) == 10 and labels[0] != labels[13]


def test_sampling(spark):
    df = spark.range(200).select(F.col("id"), F.when(F.col("id") < 150, "a").otherwise("b").alias("g"))
    assert sampling.uniform(df, 17, "id").count() == 17
    got = {r.g: r["count"] for r in sampling.with_floor(df, "g", ["b"], 20, 5, "id").groupBy("g").count().collect()}
    assert got == {"a": 15, "b": 50}
    scaffolds = df.withColumn("s", (F.col("id") % 20).cast("string"))
    for balanced in (False, True):
        split = sampling.scaffold_split(scaffolds, "s", balanced=balanced)
        assert split.groupBy("s").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
        assert {r.split: r["count"] for r in split.groupBy("split").count().collect()} == {"train": 160, "val": 20, "test": 20}
    sizes = [r["count"] for r in sampling.folds(df, "id", 64).groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [64, 64, 64, 8]


def test_registry(spark):
    models = spark.createDataFrame([(1, "a", True), (2, "b", False)], "model_id long, name string, is_active boolean")
    new = spark.createDataFrame([(9, "a", True), (3, "c", True)], "model_id long, name string, is_active boolean")
    got = {r.name: r.model_id for r in registry.upsert(models, new, ["name"], ["model_id"]).collect()}
    assert got == {"a": 1, "b": 2, "c": 3}
    only = registry.upsert(models, new.withColumn("name", F.lit("b")).limit(1), ["name"], when=F.col("is_active"))
    assert only.count() == 3
    texts = registry.soft_delete(models.withColumn("is_active", F.col("is_active").cast("string")), F.col("name") == "a")
    assert {r.is_active for r in texts.collect()} == {"false"}
    csv = spark.createDataFrame([("1,2,3",)], "v string").select(registry.remove_from_list(F.col("v"), "2"), registry.reconciled_status(F.lit("KILLED"), F.lit("running"))).first()
    assert tuple(csv) == ("1,3", "failed")
    s = spark.createDataFrame([("u", "k", "1"), ("w", "k", "2")], "user_email string, key string, value string")
    assert registry.settings_map(s, "u").first().settings == {"k": "1"}
    runs = spark.createDataFrame([("r1", "Alpha", {"t": "x"}, 5), ("r2", "beta", {}, 9)], "run_id string, run_name string, tags map<string,string>, start_time long")
    assert [r.run_id for r in registry.search_runs(runs, {"t": "x"}, "alp").collect()] == ["r1"]


def test_optimisation(spark):
    rows = [(0, "a", 1.0, 5.0), (0, "b", 3.0, None), (0, "c", float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "iteration int, candidate string, up double, down double")
    axes = [optimize.Axis("up", 1.0), optimize.Axis("down", 3.0, lower_is_better=True), optimize.Axis("none", 0.0)]
    got = {r.candidate: r.reward for r in optimize.with_reward(df, axes).collect()}
    assert got == {"a": 0.0, "b": 0.25, "c": 0.75}
    seeds = spark.createDataFrame([("s", 1.0)], "candidate string, x double")

    def propose(parents, i):
        return parents.select(F.concat("candidate", F.lit(f"{i}")).alias("candidate"), (F.col("x") + 1).alias("x")).unionByName(parents.select("candidate", "x"))

    top, rest, path = optimize.optimise(seeds, propose, [optimize.Axis("x", 1.0)], F.lit(True), 3, key="candidate")
    assert path.select("iteration").distinct().count() == 3 and top.count() + rest.count() == path.select("candidate").distinct().count()


def test_scorers_and_columns(spark):
    df = spark.createDataFrame([("MKT",), ("",)], "s string")
    got = scoring.score_axes(df, "s", {"n": lambda: (lambda v: [len(x) for x in v]), "bad": lambda: (lambda v: [1 / len(x) for x in v])}).collect()
    assert [(r.n, r.bad) for r in got] == [(3.0, pytest.approx(1 / 3)), (0.0, None)] and got[1].bad_error
    vectors = scoring.embedded(df, "s", F.col("s"), lambda: (lambda v: [[float(len(x))] for x in v]), rows=2).collect()
    assert {r.s: r.embedding for r in vectors} == {"MKT": [3.0], "": [0.0]}
    marked = spark.createDataFrame([("MKT[AY]Q",)], "s string").select(columns.marked_region(F.col("s")).alias("r")).first().r
    assert tuple(marked) == (3, 5, "MKTAYQ")
    assert spark.createDataFrame([([0.0, 5.0, 10.0],)], "v array<double>").select(columns.equal_width_bins(F.col("v"), 5)).first()[0] == [0, 1, 3]
    assert scoring.call_styles([{"a": 1, "b": 2}], "inputs") == {"inputs": [1]}


def test_joins(spark):
    left = spark.createDataFrame([("q", [3, 1, 9])], "q string, ids array<long>")
    meta = spark.createDataFrame([(1, "x"), (3, "y")], "id long, m string")
    got = joins.ordered_lookup(left, "ids", meta, "id").orderBy("pos").collect()
    assert [(r.id, r.m) for r in got] == [(3, "y"), (1, "x"), (9, None)]
    mapping = spark.createDataFrame([("tp53", "ensg1")], "s string, t string")
    names = spark.createDataFrame([("tp53",), ("zz",), ("ENSG9",)], "g string")
    assert sorted(r.g for r in joins.lookup_or_keep(names, "g", mapping, "s", "t").collect()) == ["ENSG1", "ENSG9", "ZZ"]
    assert tuple(joins.lookup_counters(names, "g", mapping, "s", "t").first()) == (3, 1, 1, 1)


def test_dashboard(spark):
    usage = spark.sql("""SELECT 'r' record_id, 'w' workspace_id, timestamp'2024-01-01 00:00:00' usage_start_time, timestamp'2024-01-01 00:01:00' usage_end_time,
        date'2024-01-01' usage_date, 2.0D usage_quantity, map('application', 'app', 'module', 'm', 'user', 'u') custom_tags,
        named_struct('job_id', 'j', 'job_run_id', 'x') usage_metadata, 'JOBS' billing_origin_product""")
    timeline = spark.sql("""SELECT 'w' workspace_id, 'j' job_id, 'x' run_id, timestamp(d) period_start_time, c termination_code
        FROM VALUES ('2024-01-01', 'OLD'), ('2024-01-02', 'NEW') AS t(d, c)""")
    fact = dashboards.usage_fact(usage, timeline, "app")
    assert [(r.seconds, r.termination_code, r.module) for r in fact.collect()] == [(60, "NEW", "m")]
    assert {k: v.count() for k, v in dashboards.widgets(fact).items()} == dict.fromkeys(("counters", "trend", "products", "heatmap", "boxes"), 1)


def test_usage_records_meet_one_run_each(spark):
    """A job with many rows does not multiply its records; nulls count as older than all, and no run leaves nulls."""
    usage = spark.range(300).selectExpr("concat('r', id) record_id", "cast(id % 3 as string) workspace_id", "timestamp'2024-01-01 00:00:00' usage_start_time",
        "timestamp'2024-01-01 00:01:00' usage_end_time", "date'2024-01-01' usage_date", "1.0D usage_quantity", "map('application', 'app') custom_tags",
        "named_struct('job_id', 1, 'job_run_id', id % 2) usage_metadata", "'JOBS' billing_origin_product")
    timeline = spark.range(2000).selectExpr("cast(id % 2 as string) workspace_id", "1 job_id", "0 run_id", "if(id < 10, null, id div 4) period_start_time", "if(id % 4 < 2, null, 'c' || id) termination_code")
    fact = dashboards.usage_fact(usage, timeline, "app")
    assert joined_rows(fact) <= 300
    want = {"0": (499, "c1998"), "1": (499, "c1999"), "2": (None, None)}
    got = fact.join(usage.select("record_id", "usage_metadata.job_run_id"), "record_id").collect()
    assert len(got) == 300 and all((r.period_start_time, r.termination_code) == (want[r.workspace_id] if r.job_run_id == 0 else (None, None)) for r in got)


def test_relational_extras(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 9.0)], "ord long, s double")
    assert [r.ord for r in relational.select_top_k(df, "s", 2).collect()] == [3, 1]
    assert [r.ord for r in relational.feasible_or_all(df, F.col("s") > 100, "s", "ord", 1).collect()] == [3]
    fitted = stats.lowess(spark.createDataFrame([("g", float(x), 2.0 * x) for x in range(20)], "g string, x double, y double"), "g", "x", "y").toPandas()
    assert np.allclose(fitted["fitted"], 2 * fitted["x"])
    xy = spark.createDataFrame([(1.0, 3.0), (2.0, 2.0), (3.0, 1.0)], "x double, y double")
    assert stats.spearman(xy, "x", "y").first()[0] == pytest.approx(-1.0)
    a = np.random.default_rng(0).normal(size=(6, 3))
    turn = np.array([[0, -1, 0], [1, 0, 0], [0, 0, 1.0]])
    assert stats.superposed_rmsd(a, a @ turn + 3) == pytest.approx(0, abs=1e-6) and math.isnan(stats.superposed_rmsd(a, a[:2]))


def test_row_numbers_and_adjusted_p(spark):
    df = spark.range(100).select(F.col("id"), ((F.col("id") * 37) % 101 / 200.0).alias("p")).repartition(5)
    got = relational.with_row_number(df, F.desc("p"), "id").orderBy("row_no").collect()
    assert [r.row_no for r in got] == list(range(100)) and [r.p for r in got] == sorted((r.p for r in got), reverse=True)
    adjusted = sorted((r.p, r.p_adj) for r in stats.p_adjusted(df, "p", "id").collect())
    assert all(a == pytest.approx(min(1.0, p * 100 / (k + 1))) for k, (p, a) in enumerate(adjusted))


def test_chains(spark):
    df = spark.createDataFrame([("MKT",), ("",)], "s string")
    scorers = {"n": lambda: (lambda v: [len(x) for x in v]), "bad": lambda: (lambda v: [1 / len(x) for x in v]), "off": lambda: (lambda v: v)}
    got = scoring.screen(df, "s", scorers, ["n", "bad"]).collect()
    assert [(r.n, r.failed) for r in got] == [(3.0, []), (0.0, ["bad"])] and "off" not in got[0]
    steps = [("up", lambda: (lambda v: [x + "!" for x in v]), "string"), ("size", lambda: (lambda v: [float(len(x)) for x in v]), "double")]
    assert [r["size"] for r in scoring.chained(df, "s", steps).collect()] == [4.0, 1.0]


def test_overlapping_backbones():
    assert alignment.common_places("ABCD", "XBD") == [(1, 1), (3, 2)] and alignment.common_places("", "A") == []
    atoms = np.arange(12.0).reshape(4, 3) ** 1.5
    chains = {"A": ("ZZ", np.zeros((2, 3))), "B": ("BCD", atoms[1:] + 5)}
    assert alignment.best_chain("ABCD", {k: v[0] for k, v in chains.items()})[0] == "B"
    assert alignment.overlapping_rmsd("ABCD", atoms, chains) == pytest.approx(0, abs=1e-6)
    assert math.isnan(alignment.overlapping_rmsd("A", atoms, {}))


def test_kmers_and_words_of_whole_texts(spark, tmp_path):
    long = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(2500)) + "é日🙂xyzw"
    rows = [(1, long, "en", "src1"), (2, "", "en", "src2"), (3, "abcdefgh", "de", "src1"), (4, "abcdefghi " * 300 + "last", "de", "src2"), (5, "w " * 500 + "last", "fr", "src1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_kmers, r.n_distinct) for r in catalog.QUERIES["kmers"](spark, str(tmp_path)).collect()}
    cut = {i: [t[k : k + 9] for k in range(len(t) - 8)] for i, t, *_ in rows}
    assert got == {i: (len(k), len(set(k))) for i, k in cut.items()}
    assert df.where("doc_id = 1").select(columns.kmers(F.col("text"))).first()[0] == cut[1]
    terms, asked = {}, set()
    for _, t, lang, source in rows:
        terms.setdefault(lang, set()).update(t.split(" "))
        asked |= set(t.split(" ")) if source == "src1" else set()
    every = set().union(*terms.values())
    want = {x: (len(g & asked), len(asked - g), len(g - asked), len(every - g - asked)) for x, g in terms.items() if g & asked}
    assert {r.term: (r.a, r.b, r.c, r.d) for r in catalog.QUERIES["enrichment_counts"](spark, str(tmp_path)).collect()} == want


def test_every_fiftieth_vector_is_a_query(spark, tmp_path, monkeypatch):
    vectors = np.random.default_rng(3).normal(size=(620, 8))
    rows = [(i, v.tolist(), i % 4) for i, v in enumerate(vectors)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scores = unit @ unit.T
    np.fill_diagonal(scores, -2)
    want = {q: np.argsort(-scores[q], kind="stable")[:10].tolist() for q in range(0, 620, 50)}
    monkeypatch.setattr(catalog.V, "QUERY_ROWS", 5)
    got = {}
    for r in catalog.QUERIES["knn_cosine"](spark, str(tmp_path)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    assert got == want


def test_interval_join_of_whole_tables(spark, tmp_path):
    part = [(i, 1000.0 + i % 40) for i in range(1, 60)]
    line = [(i, 1 + i % 3, "RNA"[i % 3], 50000.0 + 7 * i) for i in range(300)]
    spark.createDataFrame(part, "p_partkey long, p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    schema = "l_orderkey long, l_linenumber int, l_returnflag string, l_extendedprice double"
    spark.createDataFrame(line, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    want = sorted((o, n, p) for o, n, f, x in line for p, r in part if f == "R" and r * 50 <= x <= r * 50 + 20)
    assert sorted(map(tuple, catalog.QUERIES["interval_bin_join"](spark, str(tmp_path)).collect())) == want and want


def test_search_ranks_within_each_query(spark):
    vectors = spark.createDataFrame([(i, [1.0, i / 1200]) for i in range(1200)], "vec_id long, embedding array<double>")
    letters = spark.createDataFrame([(i, "ACDE" + "FGHIKLMNPQ"[i % 10]) for i in range(1200)], "seq_id long, sequence string")
    asked = vectors.join(letters, vectors.vec_id == letters.seq_id).select("vec_id", "embedding", "sequence")
    found = alignment.search(asked, vectors, letters, top_k=1).groupBy("query_id").count().collect()
    assert len(found) == 1200 and {r["count"] for r in found} == {1}


def test_row_numbers_of_a_large_table(spark, tmp_path):
    """Numbers are 0 to n - 1 in order, though the range partitions are drawn by a sample."""
    n = 300_000
    spark.range(n).selectExpr("(id * 7919) % 300007 as v", "id % 11 as g").repartition(9).write.parquet(str(tmp_path / "t"))
    numbered = relational.with_row_number(spark.read.parquet(str(tmp_path / "t")).repartition(6), "v", "g")
    found = numbered.agg(F.countDistinct("row_no"), F.min("row_no"), F.max("row_no")).first()
    assert tuple(found) == (n, 0, n - 1)
    step = numbered.orderBy("row_no").limit(50_000).select("v").toPandas()["v"]
    assert step.is_monotonic_increasing
    sums = relational.sums_before(spark.range(50_000).selectExpr("id as k", "1 as one", "id % 3 as x"), "k", "one", "x")
    assert sums.where("before_one != k").count() == 0 and sums.where("k = 49999").first().before_x == sum(i % 3 for i in range(49_999))


def test_covariates_take_up_what_they_explain(spark):
    rng = np.random.default_rng(0)
    batch, noise = rng.integers(0, 2, 80), rng.random(80) < 0.1
    ill = np.where(noise, 1 - batch, batch)
    calls = [("chr1", 5, "A", ["C"], [(f"s{i}", [int(batch[i]), int(rng.random() < 0.3)]) for i in range(80)])]
    variants = spark.createDataFrame(calls, "contigName string, start long, referenceAllele string, alternateAlleles array<string>, genotypes array<struct<sampleId: string, calls: array<int>>>")
    phenotype = spark.createDataFrame([(f"s{i}", int(ill[i])) for i in range(80)], "sampleId string, phenotype int")
    beside = spark.createDataFrame([(f"s{i}", float(batch[i])) for i in range(80)], "sampleId string, batch double")
    plain = genomics.association(variants, phenotype).first().pvalue
    assert plain < 0.001 < 0.05 < genomics.association(variants, phenotype, covariates=beside).first().pvalue


def test_parents_come_from_different_scaffolds(spark):
    rows = [("a", 0.9, "s1", 0.0), ("b", 0.8, "s1", 0.0), ("c", 0.7, "s2", 0.0), ("d", 0.6, "s3", 5.0)]
    scored = spark.createDataFrame(rows, "candidate string, reward double, scaffold string, over double")
    ids = lambda df: [r.candidate for r in df.collect()]
    ok = F.col("over") == 0
    assert ids(optimize.next_parents(scored, ok, 3, "candidate", "scaffold")) == ["a", "c"]
    worse = scored.withColumn("over", F.col("over") + F.when(F.col("candidate") == "c", 1).otherwise(2))
    assert ids(optimize.next_parents(worse, ok, 2, "candidate", violation=F.col("over"))) == ["c", "a"]


def test_cell_ranger_dispersion(spark):
    rng = np.random.default_rng(2)
    counts = {f"g{k}": rng.poisson(3, 40).astype(float) for k in range(12)} | {"odd": np.where(rng.random(40) < 0.1, 30.0, 0.0)}
    rows = [(f"c{i}", g, float(v[i])) for g, v in counts.items() for i in range(40)]
    matrix = spark.createDataFrame(rows, "cell_id string, gene string, value double")
    best = singlecell.variable_genes(matrix, 3, bins=1, flavour="cell_ranger").select("gene", "score").collect()
    ratio = {g: v.var(ddof=1) / v.mean() for g, v in counts.items()}
    middle = np.median(list(ratio.values()))
    spread = np.median([abs(x - middle) for x in ratio.values()])
    want = sorted(((x - middle) / spread, g) for g, x in ratio.items())[::-1][:3]
    assert [r.gene for r in best] == [g for _, g in want] and best[0].score == pytest.approx(want[0][0])


def test_registry_changes_only_what_they_name(spark):
    rows = [("m", None, ["a", "b", "a"], True), ("m", "sub", ["a"], True), ("m", None, ["a"], False)]
    table = spark.createDataFrame(rows, "module_name string, submodule_name string, groups array<string>, is_active boolean")
    table = table.withColumns({"updated_at": F.lit(None).cast("timestamp"), "updated_by": F.lit("old")})
    done = registry.remove_group(table, "m", None, "a", "new").collect()
    assert [(r.groups, r.updated_by) for r in done] == [(["b"], "new"), (["a"], "old"), (["a"], "old")]
    weights = spark.createDataFrame([(1, True), (4, True), (9, False)], "ft_id long, is_active boolean")
    weights = weights.withColumns({c: F.lit("x") for c in ("ft_label", "dataset_type", "task_names", "weights_volume_location")})
    assert [r.ft_id for r in registry.fine_tune(weights).collect()] == [4] and registry.fine_tune(weights, 9).count() == 0
