"""Scalar, array, map and JSON expressions; all but the path resolver are built-in functions."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_NAMES = ("sampleId", "sample_id", "SampleID", "Sample name", "sample")  # fixed values: accepted spellings
RIBOSOMAL, MITOCHONDRIAL, HAEMOGLOBIN = "^(RPS|RPL)", "MT-", "^HB[^(P)]"  # fixed values: gene name patterns
AMINO_ACIDS = "ACDEFGHIKLMNPQRSTVWY"


def field(header: str, key: str) -> str:
    """Value of a key in a '##INFO=<...>' line."""
    m = re.search(rf"[<,]{key}=([^,>]*)", header)
    return m[1] if m else ""


def safe_name(text: str, most: int = 40) -> str:
    """Identifier in lower case with single underscores."""
    return re.sub(r"_+", "_", re.sub(r"[^a-z0-9_]", "_", text.lower())).strip("_")[:most] or "unnamed"


def sanitized(text: Column, most: int = 40) -> Column:
    """safe_name() of a column."""
    parts = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9_]", "_"), "_+", "_")
    return F.coalesce(F.nullif(F.substring(F.regexp_replace(parts, "^_+|_+$", ""), 1, most), F.lit("")), F.lit("unnamed"))


def artifact_name(text: Column, most: int = 100) -> Column:
    return F.substring(F.regexp_replace(text, r"[^A-Za-z0-9_.\-]+", "_"), 1, most)


def rename_sample_column(df: DataFrame) -> DataFrame:
    """Call the first known sample column, or else the first column, sampleId; blanks in names become '_'."""
    found = next((n for n in SAMPLE_NAMES if n in df.columns), df.columns[0])
    return df.toDF(*["sampleId" if c == found else c.replace(" ", "_") for c in df.columns])


def label_encoded(df: DataFrame, column: str, target: str = "phenotype") -> DataFrame:
    """Codes 0, 1, ... of the sorted distinct texts, -1 for null; numbers are cast to int."""
    if dict(df.dtypes)[column] != "string":
        return df.withColumn(target, F.col(column).cast("int"))
    from pyspark.sql import Window

    codes = df.select(F.col(column).alias("__v")).where("__v is not null").distinct()
    codes = codes.withColumn("__code", F.row_number().over(Window.orderBy("__v")) - 1)
    joined = df.join(codes, df[column] == codes["__v"], "left").drop("__v")
    return joined.withColumn(target, F.coalesce("__code", F.lit(-1)).cast("int")).drop("__code")


def minus_log10(p: Column, at_zero: float | None = None) -> Column:
    """-log10(p); zero and below give ``at_zero`` (null if none)."""
    return F.when(p > 0, -F.log10(p)).otherwise(F.lit(at_zero).cast("double"))


def first_alleles(df: DataFrame) -> DataFrame:
    return df.withColumns({"chromosome": F.col("contigName"), "ref": F.col("referenceAllele"), "alt": F.get("alternateAlleles", F.lit(0))})


def zygosity(genotypes: Column) -> Column:
    """Equal first two calls of the first genotype are homozygous, also 0/0; anything else is heterozygous."""
    calls = F.get(genotypes, F.lit(0))["calls"]
    same = F.get(calls, F.lit(0)) == F.get(calls, F.lit(1))
    return F.when(same, "Homozygous Alt").otherwise("Heterozygous")


def in_regions(regions: Sequence[dict], contig: str = "contigName", start: str = "start", end: str = "end") -> Column:
    """Inside any of the given boxes."""
    boxes = [(F.col(contig) == r["contig"]) & (F.col(start) >= r["start"]) & (F.col(end) <= r["end"]) for r in regions]
    return reduce(lambda a, b: a | b, boxes, F.lit(False))


def region_label(regions: Sequence[dict], contig: str = "contigName", start: str = "start") -> Column:
    """Name of the first region that holds the position, or 'Unknown'."""
    label = F.lit("Unknown")
    for r in reversed(regions):
        label = F.when((F.col(contig) == r["contig"]) & F.col(start).between(r["start"], r["end"]), r["name"]).otherwise(label)
    return label


def is_biallelic(alleles: Column) -> Column:
    return F.size(alleles) == 1


def is_snp(ref: Column, alleles: Column) -> Column:
    return (F.length(ref) == 1) & F.forall(alleles, lambda a: F.length(a) == 1)


def is_varied(values: Column) -> Column:
    return F.size(F.array_distinct(values)) > 1


def is_pathogenic(significance: Column) -> Column:
    return F.array_contains(significance, "Pathogenic") | F.array_contains(significance, "Likely_pathogenic")


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def significance_bucket(text: Column) -> Column:
    """Strongest label of a significance text; 'conflicting ... pathogenicity' counts as pathogenic."""
    low = F.lower(text)
    chain = F.when(F.contains(low, F.lit("pathogenic")), "pathogenic").when(F.contains(low, F.lit("benign")), "benign")
    return chain.when(F.contains(low, F.lit("uncertain")), "uncertain").when(F.contains(low, F.lit("conflict")), "conflicting").otherwise("other")


def invalid_residues(sequence: Column) -> Column:
    return F.array_except(F.split(F.upper(sequence), ""), F.array(*[F.lit(c) for c in [*AMINO_ACIDS, ""]]))


def described(name: Column, organism: Column, gene: Column) -> Column:
    """'name [OS=organism] [GN=gene]' without empty parts."""
    part = lambda tag, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"[{tag}="), c, F.lit("]")))
    return F.concat_ws(" ", F.nullif(name, F.lit("")), part("OS", organism), part("GN", gene))


def cluster_column(columns: Sequence[str]) -> str:
    """First of the known cluster columns."""
    for name in ("cluster", "leiden", "louvain"):
        if name in columns:
            return name
    raise ValueError("no cluster column")


def classified_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """Text and boolean columns, and number columns, without expression and embedding coordinates."""
    skip = re.compile(r"^(expr_|UMAP_|PCA_)")
    kinds = [(n, k) for n, k in df.dtypes if not skip.match(n)]
    numeric = re.compile(r"^(tinyint|smallint|int|bigint|float|double|decimal)")
    return [n for n, k in kinds if k in ("string", "boolean")], [n for n, k in kinds if numeric.match(k)]


def gene_flags(gene: Column) -> dict[str, Column]:
    return {"mt": F.startswith(gene, F.lit(MITOCHONDRIAL)), "ribo": gene.rlike(RIBOSOMAL), "hb": gene.rlike(HAEMOGLOBIN)}


def carriers(genotypes: Column) -> Column:
    """Samples whose calls add up to 1 or more."""
    total = lambda g: F.aggregate(g["calls"], F.lit(0), lambda s, c: s + c)
    return F.transform(F.filter(genotypes, lambda g: total(g) >= 1), lambda g: g["sampleId"])


def kept_samples(genotypes: Column, ids: Column) -> Column:
    return F.filter(genotypes, lambda g: F.array_contains(ids, g["sampleId"]))


def genotype_states(genotypes: Column) -> Column:
    """Sum of calls of each sample, -1 if any call is missing."""

    def state(g: Column) -> Column:
        return F.when(F.exists(g["calls"], lambda c: c < 0), -1.0).otherwise(F.aggregate(g["calls"], F.lit(0), lambda s, c: s + c).cast("double"))

    return F.transform(genotypes, state)


def mean_substituted(values: Column) -> Column:
    """Missing (negative) values replaced by the mean of the others."""
    known = F.filter(values, lambda x: x >= 0)
    mean = F.aggregate(known, F.lit(0.0), lambda s, x: s + x) / F.nullif(F.size(known), F.lit(0))
    return F.transform(values, lambda x: F.when(x >= 0, x).otherwise(mean))


def call_summary(genotypes: Column) -> Column:
    """Struct of called samples, uncalled samples, alternate allele count, and counts of 0, 1 and 2 alternates."""
    states = genotype_states(genotypes)
    count = lambda v: F.size(F.filter(states, lambda x: x == v))
    called = F.size(F.filter(states, lambda x: x >= 0))
    alts = F.aggregate(F.filter(states, lambda x: x >= 0), F.lit(0.0), lambda s, x: s + x)
    return F.struct(
        called.alias("nCalled"), (F.size(genotypes) - called).alias("nUncalled"), alts.cast("int").alias("nAlt"),
        count(0.0).alias("nHomRef"), count(1.0).alias("nHet"), count(2.0).alias("nHomAlt"),
    )


def log2_ratio(a: Column, b: Column) -> Column:
    return F.log2((a + 1e-9) / (b + 1e-9))


def capped_log10(p: Column) -> Column:
    return -F.log10(F.greatest(p, F.lit(1e-300)))


def normalised(value: Column, total: Column, target: float = 1e4) -> Column:
    """log1p of a value scaled to a library of ``target``; an empty library counts as 1."""
    return F.log1p(value / F.when(total == 0, 1.0).otherwise(F.coalesce(total, F.lit(1.0))) * target)


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def anchored_sigmoid(x: Column, threshold: float, beta: float) -> Column:
    return sigmoid((x - threshold) / max(beta, 1e-6))


def idf_weight(count: Column) -> Column:
    return 1 / F.log1p(F.greatest(F.lit(1), F.coalesce(count, F.lit(1))).cast("double"))


def kmers(sequence: Column, k: int = 9, block: int = 100) -> Column:
    """All substrings of length k in order, cut from blocks so that long sequences take linear time."""

    def within(text: Column) -> Column:
        n = F.length(text) - (k - 1)
        at = F.when(n >= 1, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.substr(text, i, F.lit(k)))

    starts = F.sequence(F.lit(1), F.greatest(F.length(sequence), F.lit(1)), F.lit(block))
    blocks = F.transform(starts, lambda i: F.substr(sequence, i, F.lit(block + k - 1)))
    return F.flatten(F.transform(blocks, within))


def truncated(sequence: Column, most: int = 1022) -> Column:
    return F.substring(sequence, 1, most)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column, floor: float = 1e-9) -> Column:
    return dot(a, b) / (F.greatest(norm(a), F.lit(floor)) * F.greatest(norm(b), F.lit(floor)))


def mean_pooled(hidden: Column, mask: Column) -> Column:
    """Mean of the vectors whose mask is 1."""
    kept = F.transform(F.filter(F.arrays_zip(hidden.alias("h"), mask.alias("m")), lambda x: x["m"] == 1), lambda x: x["h"])
    zero = F.transform(F.get(hidden, F.lit(0)), lambda x: F.lit(0.0))
    total = F.aggregate(kept, zero, lambda s, v: F.zip_with(s, v, lambda x, y: x + y))
    return F.transform(total, lambda x: x / F.greatest(F.size(kept), F.lit(1)))


def marked_region(sequence: Column) -> Column:
    """Struct (start, end, raw) of a sequence with one bracketed part, as a half-open range from 0; an error without one."""
    open_, close = F.instr(sequence, "["), F.instr(sequence, "]")
    raw = F.regexp_replace(sequence, r"[\[\]]", "")
    made = F.struct((open_ - 1).alias("start"), (close - 2).alias("end"), raw.alias("raw"))
    return F.when((open_ > 0) & (close > open_ + 1), made).otherwise(F.raise_error(F.lit("no [region] in the sequence")).cast("struct<start:int,end:int,raw:string>"))


def risk_band(v: Column) -> Column:
    return F.when(v >= 0.7, "High").when(v >= 0.3, "Medium").otherwise("Low")


def equal_width_bins(values: Column, n: int) -> Column:
    """Bin of each value between 0 and the greatest, by n edges."""
    top = F.array_max(values) + 1e-6
    return F.transform(values, lambda v: F.least(F.greatest(F.floor(v / top * (n - 1)), F.lit(0)), F.lit(n - 1)).cast("int"))


def perturbed(expression: Column, genes: Column, chosen: Sequence[str], knockout: bool) -> Column:
    """Expression with the chosen genes at 0, or at the greatest value."""
    level = F.lit(0.0) if knockout else F.array_max(expression)
    hit = F.array(*[F.lit(g) for g in chosen]).cast("array<string>")
    return F.zip_with(expression, genes, lambda x, g: F.when(F.array_contains(hit, g), level).otherwise(x))


def or_else(new: Column, old: Column) -> Column:
    return F.coalesce(F.nullif(new, F.lit("")), old)


def as_number(text: Column) -> Column:
    value = text.try_cast("double")
    return F.when(~F.isnan(value), value)


@lru_cache(maxsize=1024)
def path_steps(path: str) -> tuple[tuple[str, str], ...]:
    """A dotted path as (kind, text) steps: ``any`` for '*', ``place`` for whole numbers, bare or in brackets, else ``name``."""
    texts = [t.removeprefix("[").removesuffix("]") if re.fullmatch(r"\[.*\]", t) else t for t in path.split(".") if t]
    return tuple(("any" if t == "*" else "place" if re.fullmatch(r"-?\d+", t) else "name", t) for t in texts)


def dig(value: object, path: str) -> object:
    """Part of a nested value by a dotted path; None where it does not lead anywhere.

    Numbers index lists, also as [0] and from the end; '*' takes the first entry of a map or list;
    a name on a list of one goes into its element.
    """
    for step in path_steps(path or ""):
        match step, value:
            case ("any", _), dict() | list():
                value = next(iter(value.values() if isinstance(value, dict) else value), None)
            case ("place", at), list():
                value = value[int(at)] if -len(value) <= int(at) < len(value) else None
            case ("name", name), [dict() as only]:
                value = only.get(name)
            case ("place" | "name", name), dict():
                value = value.get(name)
            case _:
                return None
    return value


def json_path(path: str):
    """Arrow-batched dig() over JSON texts; results are JSON texts."""
    @F.pandas_udf("string")
    def resolve(texts: pd.Series) -> pd.Series:
        found = [dig(json.loads(t), path) if t is not None else None for t in texts]
        return pd.Series([None if x is None else x if isinstance(x, str) else json.dumps(x) for x in found], dtype=object)

    return resolve


def extracted(data: Column, path: str) -> Column:
    """Value at a path, an error if there is none."""
    value = json_path(path)(data)
    return F.coalesce(value, F.raise_error(F.lit(f"path '{path}' did not resolve")).cast("string"))


def mapped(data: Column, mappings: dict[str, str]) -> Column:
    """Struct of the values at several paths, an error if all are missing."""
    values = {name: json_path(path)(data) for name, path in mappings.items()}
    made = F.struct(*[v.alias(n) for n, v in values.items()])
    failed = F.raise_error(F.lit("none of the source paths resolved"))
    return F.when(F.coalesce(*values.values()).isNotNull(), made).otherwise(failed.cast("struct<" + ",".join(f"{n}:string" for n in values) + ">"))
