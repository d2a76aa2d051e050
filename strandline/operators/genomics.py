"""Variant tables: preparation, association, annotation and summaries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import columns as C
from strandline.functions.stats import hardy_weinberg, hwe_filter, logistic_test
from strandline.operators.joins import annotate_variants, array_semi_join, point_in_interval_join

#: Samples whose phenotypes may be sent to all tasks.
SAMPLES = 5_000_000


def prepare_phenotype(df: DataFrame, phenotype: str) -> DataFrame:
    """(sampleId, phenotype int): known sample column, blanks in names replaced, texts label-encoded."""
    named = C.rename_sample_column(df)
    return C.label_encoded(named, phenotype.replace(" ", "_")).select("sampleId", "phenotype")


def carried_variants(variants: DataFrame, phenotype: DataFrame) -> DataFrame:
    """Phenotype rows of samples that carry any variant."""
    return array_semi_join(variants.select(C.carriers(F.col("genotypes")).alias("carriers")), "carriers", phenotype, "sampleId")


def restrict_samples(variants: DataFrame, samples: DataFrame) -> DataFrame:
    """Genotypes of the given samples only; the ids, SAMPLES at most, travel to the tasks, which look each genotype's id up."""
    ids = samples.select("sampleId").where("sampleId is not null").distinct().limit(SAMPLES + 1).toArrow().column(0)
    if len(ids) > SAMPLES:
        raise ValueError(f"more than {SAMPLES} samples")
    known = variants.sparkSession.sparkContext.broadcast(ids.combine_chunks())

    @F.arrow_udf("array<boolean>")
    def among(own: pa.Array) -> pa.Array:
        found = pc.is_in(own.flatten(), value_set=known.value)
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(own), 0).to_numpy(zero_copy_only=False))])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)

    marked = variants.withColumn("__among", among(F.transform("genotypes", lambda g: g["sampleId"])))
    return marked.withColumn("genotypes", F.filter("genotypes", lambda g, i: F.get("__among", i))).drop("__among")


def trimmed(variants: DataFrame) -> DataFrame:
    """Parsimonious alleles: the shared ending goes first, then the shared beginning, one base stays."""

    @F.pandas_udf("start long, ref string, alt string")
    def trim(start: pd.Series, ref: pd.Series, alt: pd.Series) -> pd.DataFrame:
        rows = []
        for s, r, a in zip(start, ref, alt):
            while r and a and len(r) > 1 and len(a) > 1 and r[-1] == a[-1]:
                r, a = r[:-1], a[:-1]
            while r and a and len(r) > 1 and len(a) > 1 and r[0] == a[0]:
                s, r, a = s + 1, r[1:], a[1:]
            rows.append((s, r, a))
        return pd.DataFrame(rows, columns=["start", "ref", "alt"])

    done = variants.withColumn("__t", trim("start", "referenceAllele", F.get("alternateAlleles", F.lit(0))))
    fixed = done.withColumns({"start": F.col("__t.start"), "referenceAllele": F.col("__t.ref"), "alternateAlleles": F.array("__t.alt")})
    return fixed.withColumn("end", F.col("start") + F.length("referenceAllele")).drop("__t") if "end" in variants.columns else fixed.drop("__t")


def left_aligned(variants: DataFrame, reference: dict[str, str]) -> DataFrame:
    """Indels shifted left as far as the reference allows; the reference (bounded contigs) travels to the tasks."""

    @F.pandas_udf("start long, ref string, alt string")
    def shift(contig: pd.Series, start: pd.Series, ref: pd.Series, alt: pd.Series) -> pd.DataFrame:
        rows = []
        for c, s, r, a in zip(contig, start, ref, alt):
            bases = reference.get(c, "")
            while bases and len(r) != len(a):
                if r and a and r[-1] == a[-1]:
                    r, a = r[:-1], a[:-1]
                if r and a:
                    break
                if s == 0:
                    break
                s -= 1
                r, a = bases[s] + r, bases[s] + a
            while len(r) > 1 and len(a) > 1 and r[0] == a[0]:
                s, r, a = s + 1, r[1:], a[1:]
            rows.append((s, r, a))
        return pd.DataFrame(rows, columns=["start", "ref", "alt"])

    done = variants.withColumn("__t", shift("contigName", "start", "referenceAllele", F.get("alternateAlleles", F.lit(0))))
    return done.withColumns({"start": F.col("__t.start"), "referenceAllele": F.col("__t.ref"), "alternateAlleles": F.array("__t.alt")}).drop("__t")


def normalised_variants(variants: DataFrame, reference: dict[str, str] | None = None) -> DataFrame:
    """Single bases as they are, indels trimmed and (with a reference) left-aligned; the split column drops out."""
    snp = C.is_snp(F.col("referenceAllele"), F.col("alternateAlleles"))
    indels = trimmed(variants.where(~snp))
    indels = left_aligned(indels, reference) if reference else indels
    both = variants.where(snp).unionByName(indels)
    return both.drop("splitFromMultiAllelic")


def with_statistics(variants: DataFrame) -> DataFrame:
    """Call summary columns and the equilibrium test of each biallelic variant."""
    summed = variants.where(C.is_biallelic(F.col("alternateAlleles"))).withColumn("__c", C.call_summary(F.col("genotypes")))
    spliced = summed.select(*variants.columns, "__c.*")
    return hardy_weinberg(spliced, "nHomRef", "nHet", "nHomAlt")


def association(
    variants: DataFrame, phenotype: DataFrame, contigs: Sequence[str] | None = None, pvalue_threshold: float = 0.05, firth: bool = True,
    covariates: DataFrame | None = None,
) -> DataFrame:
    """Logistic association of each variant with a 0/1 phenotype: contigName, start, alleles, effect, pvalue.

    Missing genotypes take the mean; constant variants drop out. ``covariates`` has a sampleId and number columns;
    samples without all of them are left out. The phenotypes and covariates of at most SAMPLES samples travel to
    the tasks; variants are tested where they lie, without a shuffle.
    """
    named = phenotype.select("sampleId", F.col("phenotype").cast("double")).where("phenotype >= 0")
    extra = [c for c in covariates.columns if c != "sampleId"] if covariates is not None else []
    if covariates is not None:
        named = named.join(covariates.select("sampleId", *[F.col(c).cast("double").alias(c) for c in extra]), "sampleId").dropna()
    known = named.limit(SAMPLES + 1).toPandas()
    if len(known) > SAMPLES:
        raise ValueError(f"more than {SAMPLES} samples")
    target = dict(zip(known["sampleId"], known["phenotype"]))
    beside = dict(zip(known["sampleId"], known[extra].to_numpy(float)))
    chosen = variants if contigs is None else variants.where(F.col("contigName").isin(list(contigs)))
    values = C.mean_substituted(C.genotype_states(F.col("genotypes")))
    prepared = chosen.withColumn("__v", values).where(C.is_varied(F.col("__v")))
    columns = ["contigName", "start", "referenceAllele", "alternateAlleles"]
    ids = F.transform("genotypes", lambda g: g["sampleId"])

    def test(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            effects, ps = [], []
            for own, x in zip(frame["ids"], frame["values"]):
                use = np.array([s in target for s in own])
                y = np.array([target[s] for s in own if s in target])
                v = np.asarray(x, float)[use]
                if len(y) < 3 or len(set(y)) < 2 or np.ptp(v) == 0:
                    effect, p = float("nan"), float("nan")
                else:
                    with_ = np.array([beside[s] for s in own if s in target]) if extra else None
                    effect, p = logistic_test(v, y, with_, firth_below=pvalue_threshold if firth else None)
                effects.append(effect)
                ps.append(p)
            yield frame[columns].assign(phenotype="phenotype", effect=effects, pvalue=ps)

    schema = "contigName string, start long, referenceAllele string, alternateAlleles array<string>, phenotype string, effect double, pvalue double"
    return prepared.select(*columns, ids.alias("ids"), F.col("__v").alias("values")).mapInPandas(test, schema)


def gwas(variants: DataFrame, phenotype: DataFrame, hwe_cutoff: float = 0.01, contigs: Sequence[str] | None = None, pvalue_threshold: float = 0.05) -> DataFrame:
    """From variants to results: restrict samples, normalise, test equilibrium, keep what deviates, test association."""
    kept = restrict_samples(variants, carried_variants(variants, phenotype))
    tested = hwe_filter(with_statistics(normalised_variants(kept)), hwe_cutoff)
    return association(tested, phenotype, contigs, pvalue_threshold)


def gwas_summary(results: DataFrame) -> DataFrame:
    """Total, significant at 5e-8 (at 1e-5 if none is), suggestive at 1e-5, and the smallest p."""
    strict, loose = F.count_if(F.col("pvalue") < 5e-8), F.count_if(F.col("pvalue") < 1e-5)
    counts = results.agg(F.count("*").alias("total"), strict.alias("__s"), loose.alias("suggestive"), F.min("pvalue").alias("min_p"))
    significant = F.when(F.col("__s") > 0, F.col("__s")).otherwise(F.col("suggestive"))
    return counts.select("total", significant.alias("significant"), "suggestive", "min_p")


def top_results(results: DataFrame, plotted: int = 10_000, listed: int = 50) -> tuple[DataFrame, DataFrame]:
    """The most significant rows with -log10 p: those to plot, and of them those to list."""
    order = [F.asc_nulls_last("pvalue"), "contigName", "start"]
    top = results.orderBy(*order).limit(plotted).withColumn("neg_log10_p", C.minus_log10(F.col("pvalue")))
    return top, top.orderBy(*order).limit(listed)


def in_panel(variants: DataFrame, panel: DataFrame, bin_width: int | None = 1_000_000) -> DataFrame:
    """Variants whose start lies in a panel interval, both ends included, with gene, category and condition."""
    joined = point_in_interval_join(variants, panel, ("contigName", "chrom"), "start", "chromStart", "chromEnd", bin_width)
    return joined.withColumnRenamed("name", "gene")


def panel_counts(variants: DataFrame, panel: DataFrame, bin_width: int | None = 1_000_000) -> DataFrame:
    """(gene, n, places): pairs of in_panel() for each gene, and the sum of their starts, without making the pairs.

    Equal places and equal intervals are counted first and joined once, weighted by how often they are there.
    """
    places = variants.groupBy("contigName", "start").agg(F.count("*").alias("__variants"))
    spans = panel.groupBy("chrom", "chromStart", "chromEnd", "name").agg(F.count("*").alias("__spans"))
    pairs = in_panel(places, spans, bin_width).withColumn("__n", F.col("__variants") * F.col("__spans"))
    return pairs.groupBy("gene").agg(F.sum("__n").alias("n"), F.sum(F.col("start") * F.col("__n")).alias("places"))


def in_custom_regions(variants: DataFrame, regions: Sequence[dict]) -> DataFrame:
    """Variants inside given boxes, with the region's name as gene."""
    return variants.where(C.in_regions(regions)).withColumn("gene", C.region_label(regions))


def annotated(gene_variants: DataFrame, clinvar: DataFrame) -> DataFrame:
    """Panel variants with clinical significance, disease, ids and zygosity."""
    right = clinvar.select("*")
    joined = annotate_variants(C.first_alleles(gene_variants), right, ["INFO_CLNSIG", "INFO_CLNDN", "INFO_CLNVI"])
    extra = [F.col(c) if c in gene_variants.columns else F.lit(None).cast("string").alias(c) for c in ("category", "condition")]
    return joined.select(
        "gene", *extra, "chromosome", "start", "ref", "alt", C.zygosity(F.col("genotypes")).alias("zygosity"), "qual",
        F.col("INFO_CLNSIG").alias("clinical_significance"), F.col("INFO_CLNDN").alias("disease_name"),
        F.col("INFO_CLNVI").alias("variant_ids"), "genotypes",
    )


def pathogenic(annotated_rows: DataFrame) -> DataFrame:
    return annotated_rows.where(C.is_pathogenic(F.col("clinical_significance")))


def spiked(variants: DataFrame, extra: DataFrame) -> DataFrame:
    """Union by name; columns that one side lacks are null."""
    return variants.unionByName(extra, allowMissingColumns=True)


def in_long_range(counts: DataFrame, column: str, low: int = 6000, high: int = 8000) -> DataFrame:
    """Counts strictly between two bounds."""
    return counts.where((F.col(column) > low) & (F.col(column) < high))


def pathogenicity_buckets(rows: DataFrame, hits: DataFrame, keys: Sequence[str] = ("run_name", "chromosome", "start", "ref", "alt")) -> DataFrame:
    """Counts by significance bucket: pathogenic rows first, then text matches in order."""
    flagged = hits.select(*keys, F.lit(1).alias("__hit")).distinct()
    text = F.array_join("clinical_significance", ",")
    bucket = F.when(F.col("__hit") == 1, "Pathogenic").when(text.like("%Benign%"), "Benign").when(text.like("%Uncertain%"), "Uncertain")
    joined = rows.join(flagged, list(keys), "left")
    return joined.groupBy(bucket.otherwise("Other").alias("bucket")).agg(F.count("*").alias("n"))


def pathogenic_details(rows: DataFrame) -> DataFrame:
    """List for a report: missing texts filled, arrays joined, by gene and position."""
    filled: list[Column] = [F.coalesce("gene", F.lit("Unknown")).alias("gene"), F.coalesce("category", F.lit("")).alias("category")]
    filled += [F.coalesce("condition", F.lit("")).alias("condition"), F.col("chromosome"), F.col("start"), F.col("ref"), F.col("alt"), F.col("zygosity"), F.col("qual")]
    filled += [F.array_join(c, ", ").alias(c) for c in ("clinical_significance", "disease_name", "variant_ids")]
    return rows.select(filled).orderBy("gene", "start")


def gene_counts(rows: DataFrame, *keys: str) -> DataFrame:
    """Counts by gene, category, gene and zygosity, or disease (arrays joined)."""
    columns = [F.array_join(k, ", ").alias(k) if dict(rows.dtypes)[k].startswith("array") else F.col(k) for k in keys]
    return rows.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys)


def pathogenic_totals(rows: DataFrame) -> DataFrame:
    """All rows and pathogenic rows in one pass."""
    return rows.agg(F.count("*").alias("total"), F.count_if(C.is_pathogenic(F.col("clinical_significance"))).alias("pathogenic"))
