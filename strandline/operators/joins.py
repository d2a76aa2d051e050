"""Join shapes that plan badly, or lose their order, if written plainly."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a checked side up to which it is broadcast.
BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if the side has at most ``limit`` rows; reads no more than that."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def array_semi_join(left: DataFrame, array_col: str, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``right`` whose key is in the array of any row of ``left``: explode, then an equality semi join."""
    members = left.select(F.explode(array_col).alias("__member")).distinct()
    return right.join(members, right[key] == members["__member"], "left_semi")


def point_in_interval_join(
    points: DataFrame, spans: DataFrame, equal: tuple[str, str], point: str, low: str, high: str, bin_width: int | None = None
) -> DataFrame:
    """Points joined to the spans of their contig that hold them, both ends included.

    With ``bin_width`` the spans are spread over bins and the join is an equality on contig and bin, so a
    contig with most of the rows is split; without, it is an equality on the contig alone.
    """
    inside = points[point].between(spans[low], spans[high])
    if bin_width is None:
        return points.join(spans, (points[equal[0]] == spans[equal[1]]) & inside)
    bins = F.sequence(F.floor(F.col(low) / bin_width), F.floor(F.col(high) / bin_width))
    binned = spans.where(F.col(low) <= F.col(high)).withColumn("__bin", F.explode(bins))
    marked = points.withColumn("__at", F.floor(F.col(point) / bin_width))
    on = (marked[equal[0]] == binned[equal[1]]) & (marked["__at"] == binned["__bin"])
    return marked.join(binned, on & marked[point].between(binned[low], binned[high])).drop("__bin", "__at")


def annotate_variants(variants: DataFrame, annotations: DataFrame, picked: Sequence[str]) -> DataFrame:
    """Left join on contig without 'chr', start, reference and first alternate allele; duplicates multiply rows."""
    keyed = variants.select(
        "*",
        F.regexp_replace("contigName", "chr", "").alias("__contig"),
        F.get("alternateAlleles", F.lit(0)).alias("__alt"),
    )
    right = annotations.select(
        F.col("contigName").alias("__c"),
        F.col("start").alias("__s"),
        F.col("referenceAllele").alias("__r"),
        F.get("alternateAlleles", F.lit(0)).alias("__a"),
        *picked,
    )
    on = (F.col("__contig") == F.col("__c")) & (F.col("start") == F.col("__s"))
    on = on & (F.col("referenceAllele") == F.col("__r")) & (F.col("__alt") == F.col("__a"))
    return keyed.join(right, on, "left").drop("__contig", "__alt", "__c", "__s", "__r", "__a")


def ordered_lookup(keyed: DataFrame, ids_col: str, metadata: DataFrame, key: str, inner: bool = False) -> DataFrame:
    """One row for each id of an array column with its position, left (or inner) joined to metadata."""
    spread = keyed.select(*[c for c in keyed.columns if c != ids_col], F.posexplode(ids_col).alias("pos", key))
    return spread.join(metadata, key, "inner" if inner else "left")


def outer_join_all(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer join of several frames on one key."""
    return reduce(lambda a, b: a.join(b, key, "full_outer"), frames)


def first_match_join(left: DataFrame, right: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Inner join to the first value, by ``order``, of each key of the right side."""
    first = right.groupBy(key).agg(F.min_by(value, order).alias(value))
    return left.join(first, key)


def lookup_or_keep(left: DataFrame, name: str, mapping: DataFrame, source: str, target: str) -> DataFrame:
    """Replace a name by its mapped id, in upper case; names without one stay."""
    right = mapping.select(F.col(source).alias("__from"), F.col(target).alias("__to")).dropDuplicates(["__from"])
    joined = left.join(broadcast_if_small(right), left[name] == right["__from"], "left")
    return joined.withColumn(name, F.upper(F.coalesce("__to", name))).drop("__from", "__to")


def lookup_counters(names: DataFrame, name: str, mapping: DataFrame, source: str, target: str) -> DataFrame:
    """Counters of a symbol lookup: total, already ids, mapped, unmapped."""
    right = mapping.select(F.col(source).alias("__from"), F.col(target).alias("__to")).dropDuplicates(["__from"])
    joined = names.join(broadcast_if_small(right), names[name] == right["__from"], "left")
    is_id = F.col(name).startswith("ENSG")
    return joined.agg(
        F.count("*").alias("total"),
        F.count_if(is_id).alias("already_ids"),
        F.count_if(~is_id & F.col("__to").isNotNull()).alias("mapped"),
        F.count_if(~is_id & F.col("__to").isNull()).alias("unmapped"),
    )


def overlap_counts(query: DataFrame, terms: DataFrame, background: DataFrame) -> DataFrame:
    """The 2x2 table of each term: genes of query and term (a), query only (b), term only (c), neither (d).

    ``query`` and ``background`` have a column gene, ``terms`` has (term, gene); only genes of the
    background count, and only terms that share a gene with the query are returned.
    """
    universe = background.select("gene").distinct()
    asked = query.select("gene").distinct().join(universe, "gene", "left_semi").withColumn("asked", F.lit(1))
    known = terms.select("term", "gene").distinct().join(universe, "gene", "left_semi")
    sizes = universe.agg(F.count("*").alias("n_background")).join(F.broadcast(asked.agg(F.count("*").alias("n_query"))))
    table = known.join(asked, "gene", "left").groupBy("term").agg(F.count("asked").alias("a"), F.count("*").alias("n_term"))
    joined = table.where("a >= 1").join(F.broadcast(sizes))
    return joined.select(
        "term",
        "a",
        (F.col("n_query") - F.col("a")).alias("b"),
        (F.col("n_term") - F.col("a")).alias("c"),
        (F.col("n_background") - F.col("n_query") - F.col("n_term") + F.col("a")).alias("d"),
    )


def score_valid(rows: DataFrame, ordinal: str, valid: Column, scored_by) -> DataFrame:
    """Score the valid rows only; the others keep their place with a null score."""
    scored = scored_by(rows.where(valid)).select(F.col(ordinal).alias("__ord"), "score")
    return rows.join(scored, rows[ordinal] == scored["__ord"], "left").drop("__ord")


def set_overlaps(sets: DataFrame, key: str, items: str) -> DataFrame:
    """Shared items of each two keys that share any: (a, b, overlap), a < b, over an item equality join."""
    spread = sets.select(F.col(key).alias("k"), F.explode(F.array_distinct(items)).alias("item"))
    left, right = spread.toDF("a", "item"), spread.toDF("b", "item")
    return left.join(right, "item").where("a < b").groupBy("a", "b").agg(F.count("*").alias("overlap"))
