"""Readers of domain text formats, each one lazy plan over a text or CSV scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions.columns import field

BED_SCHEMA = "chrom string, chromStart long, chromEnd long, name string, score int, strand string, category string, condition string"


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """CSV, or TSV by suffix, with a header and inferred types."""
    return spark.read.csv(path, sep="\t" if path.endswith(".tsv") else ",", header=True, inferSchema=True)


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", comment="#", schema=BED_SCHEMA)


def csv_column(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One column as ``value``; no rows if there is no such column."""
    df = read_delimited(spark, path)
    if column not in df.columns:
        return spark.createDataFrame([], "value string")
    return df.select(F.col(column).alias("value"))


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Each file as one text."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("text"))


def read_commented_tsv(spark: SparkSession, path: str) -> DataFrame:
    """TSV after a block of lines that start with '!'; short rows are padded with ''."""
    lines = spark.read.text(path).where("not startswith(value, '!') and value != ''")
    head = lines.first()
    if head is None:
        return spark.createDataFrame([], T.StructType([]))
    names = head[0].split("\t")
    cells = F.split("value", "\t")
    columns = [F.coalesce(F.get(cells, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)]
    return lines.where(F.col("value") != head[0]).select(columns)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """Records of a FASTA file: seq_id, sequence, description, seq_length."""
    records = spark.read.text(path, lineSep="\n>").where("trim(value) != ''")
    record = F.regexp_replace("value", r"^\s*>", "")
    head = F.regexp_extract(record, r"^([^\n]*)", 1)
    sequence = F.regexp_replace(F.regexp_replace(record, r"^[^\n]*", ""), r"\s", "")
    rows = records.select(head.alias("head"), sequence.alias("sequence"))
    return rows.select(
        F.regexp_extract("head", r"^(\S*)", 1).alias("seq_id"),
        "sequence",
        F.trim(F.regexp_replace("head", r"^\S*", "")).alias("description"),
        F.length("sequence").alias("seq_length"),
    ).where("seq_length > 0 or seq_id != ''")


def read_uniprot(spark: SparkSession, path: str) -> DataFrame:
    """Gene, accession, entry, protein, organism and sequence from UniProt headers; rows without a gene drop out."""
    raw = read_fasta(spark, path)
    rest = F.col("description")
    protein = F.trim(F.regexp_extract(rest, r"^(.*?)(?:\s+[A-Z]{2}=|$)", 1))
    parsed = raw.select(
        F.regexp_extract(rest, r"GN=(\S+)", 1).alias("gene"),
        F.regexp_extract("seq_id", r"^\w+\|([^|]+)\|", 1).alias("accession"),
        F.regexp_extract("seq_id", r"^\w+\|[^|]+\|(\S+)", 1).alias("entry_name"),
        protein.alias("protein_name"),
        F.trim(F.regexp_extract(rest, r"OS=(.*?)(?:\s+[A-Z]{2}=|$)", 1)).alias("organism"),
        "sequence",
        "seq_length",
    )
    return parsed.where("gene != ''")


def read_gmt(spark: SparkSession, path: str) -> DataFrame:
    """(term, gene) rows; lines of fewer than three fields are skipped and the last line of a term wins."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    parts = lines.select("line_no", F.split("line", "\t").alias("p")).where("size(p) >= 3")
    genes = F.filter(F.transform(F.slice("p", 3, 1_000_000), F.trim), lambda g: g != "")
    last = parts.select(F.trim(F.col("p")[0]).alias("term"), "line_no", genes.alias("genes")).groupBy("term").agg(
        F.max_by("genes", "line_no").alias("genes")
    )
    return last.select("term", F.explode(F.array_distinct("genes")).alias("gene"))


def read_vcf(spark: SparkSession, path: str, info_types: dict[str, str] | None = None) -> DataFrame:
    """Variants of a VCF file, plain or compressed, with nested genotypes and one INFO_ column for each key.

    ``start`` counts from 0 and ``end`` is start plus the length of the reference allele. INFO keys and
    sample names come from the header; flags are true where present, comma lists are arrays of text
    unless ``info_types`` casts them, and no-calls are -1.
    """
    lines = spark.read.text(path)
    header = [r[0] for r in lines.where("startswith(value, '#')").collect()]
    samples = next((h.split("\t")[9:] for h in header if h.startswith("#CHROM")), [])
    infos = {}
    for h in header:
        if h.startswith("##INFO=<ID="):
            key = h[len("##INFO=<ID=") :].split(",")[0].rstrip(">")
            infos[key] = (field(h, "Number"), field(h, "Type"))
    cells = F.split("value", "\t")
    rows = lines.where("not startswith(value, '#') and trim(value) != ''").select(cells.alias("c"))
    get = lambda i: F.get("c", F.lit(i))
    missing = lambda col: F.when(col != ".", col)
    info = F.str_to_map(get(7), F.lit(";"), F.lit("="))
    columns = [
        get(0).alias("contigName"),
        (get(1).cast("long") - 1).alias("start"),
        (get(1).cast("long") - 1 + F.length(get(3))).alias("end"),
        F.coalesce(F.split(missing(get(2)), ";"), F.array().cast("array<string>")).alias("names"),
        get(3).alias("referenceAllele"),
        F.coalesce(F.split(missing(get(4)), ","), F.array().cast("array<string>")).alias("alternateAlleles"),
        F.expr("try_cast(get(c, 5) as double)").alias("qual"),
        F.coalesce(F.split(missing(get(6)), ";"), F.array().cast("array<string>")).alias("filters"),
        F.lit(False).alias("splitFromMultiAllelic"),
    ]
    for key, (number, kind) in infos.items():
        value: Column = F.try_element_at(info, F.lit(key))
        if kind == "Flag":
            value = F.array_contains(F.split(get(7), ";"), key)
        else:
            target = (info_types or {}).get(key) or {"Integer": "int", "Float": "double"}.get(kind, "string")
            value = F.split(value, ",").cast(f"array<{target}>") if number != "1" else value.try_cast(target)
        columns.append(value.alias(f"INFO_{key}"))
    keys = F.split(get(8), ":")
    genotypes = []
    for k, name in enumerate(samples):
        values = F.split(get(9 + k), ":")
        gt = F.get(values, (F.array_position(keys, "GT") - 1).cast("int"))
        calls = F.transform(F.split(gt, "[/|]"), lambda x: F.when(x == ".", -1).otherwise(x.try_cast("int")))
        genotypes.append(F.struct(F.lit(name).alias("sampleId"), calls.alias("calls")))
    empty = F.array().cast("array<struct<sampleId:string,calls:array<int>>>")
    columns.append((F.array(*genotypes) if genotypes else empty).alias("genotypes"))
    return rows.select(columns)


def mean_plddt(pdb: Column) -> Column:
    """Mean B-factor of the alpha carbons of a PDB text; 0 if it has none."""
    atoms = F.filter(F.split(pdb, "\n"), lambda x: F.startswith(x, F.lit("ATOM")) & (F.trim(F.substring(x, 13, 4)) == "CA"))
    values = F.transform(atoms, lambda x: F.trim(F.substring(x, 61, 6)).try_cast("double"))
    total = F.aggregate(values, F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0)))
    return F.when(F.size(values) > 0, total / F.size(values)).otherwise(0.0)


def sdf_to_hetatm(sdf: Column) -> Column:
    """HETATM lines from the atom block of an SDF text; '' if it is malformed."""
    lines = F.split(sdf, "\n")
    count = F.trim(F.substring(F.get(lines, F.lit(3)), 1, 3)).try_cast("int")
    block = F.slice(lines, 5, F.greatest(F.coalesce(count, F.lit(0)), F.lit(0)))

    def atom(line: Column, i: Column) -> Column:
        xyz = [F.trim(F.substring(line, 1 + 10 * k, 10)).try_cast("double") for k in range(3)]
        name = F.trim(F.substring(line, 32, 3))
        return F.format_string("HETATM%5d %-4s LIG A   1    %8.3f%8.3f%8.3f  1.00  0.00          %2s", i + 1, name, *xyz, name)

    made = F.array_join(F.transform(block, atom), "\n")
    return F.when((F.size(block) > 0) & (F.size(block) == count), made).otherwise("")


def read_stockholm(spark: SparkSession, path: str) -> DataFrame:
    """(name, sequence) rows of a Stockholm alignment, blocks joined in order."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("n", "line"))
    rows = lines.where("trim(line) != '' and not startswith(line, '#') and not startswith(line, '//')")
    cells = rows.select("n", F.split(F.trim("line"), r"\s+").alias("c")).where("size(c) = 2")
    parts = F.array_sort(F.collect_list(F.struct("n", F.col("c")[1].alias("s"))))
    grouped = cells.groupBy(F.col("c")[0].alias("name")).agg(F.min("n").alias("ord"), parts.alias("parts"))
    return grouped.select("ord", "name", F.array_join(F.transform("parts", lambda p: p["s"]), "").alias("sequence"))


def read_a3m(spark: SparkSession, path: str) -> DataFrame:
    """FASTA rows of an A3M alignment with the aligned columns and the deletions before each."""
    rows = read_fasta(spark, path)
    aligned = F.regexp_replace("sequence", "[a-z]", "")
    runs = F.transform(F.regexp_extract_all("sequence", F.lit("([a-z]*)[^a-z]"), 1), F.length)
    return rows.select("seq_id", aligned.alias("aligned"), runs.alias("deletions"))


def read_tblout(spark: SparkSession, path: str) -> DataFrame:
    """Target, query, e-value and score of a sequence search's table."""
    rows = spark.read.text(path).where("not startswith(value, '#') and trim(value) != ''")
    c = F.split(F.trim("value"), r"\s+")
    return rows.select(
        F.get(c, F.lit(0)).alias("target"),
        F.get(c, F.lit(2)).alias("query"),
        F.get(c, F.lit(4)).try_cast("double").alias("e_value"),
        F.get(c, F.lit(5)).try_cast("double").alias("score"),
    )


def read_graph(spark: SparkSession, path: str) -> DataFrame:
    """A workflow graph from its JSON file."""
    return spark.read.json(path, multiLine=True)
