"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.lineage import cut

#: Fixed value: what parts words, as a regular expression.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Passes over a source that the mix takes at most.
PASSES = 3
#: Points of the unit interval, and the step between neighbouring slots (odd, nearest to 2^31 / golden ratio).
POINTS = 1 << 31
STEP = 1327217885
#: Slots are shared out in units of this part of a slot.
UNITS = 65536
#: Intervals into which the points are cut to find their source by an equality join.
CELLS = 4096
#: Slots that are ranked in one task.
RUN = 1 << 16
#: A block has about this share of all tokens, within bounds.
BLOCK_SHARE = 1 << 20
BLOCK_LEAST, BLOCK_MOST = 16, 4096


def targets(sizes: DataFrame, passes: int = PASSES, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Target tokens of each (source, source_size) row.

    Sources in code point order, null last, weigh ``weights`` in turn and share the sum of all sizes;
    what exceeds ``passes`` times a source's size is shared again by weight. So a target is the smaller
    of that bound and weight times the level at which all targets add up. One row for each source
    passes through one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    numbered = sizes.withColumn("source_no", F.row_number().over(order).cast("long") - 1)
    bounded = numbered.withColumn("weight", weight.cast("long")).withColumn("bound", F.col("source_size") * passes)
    rising = Window.orderBy((F.col("bound") / F.col("weight")), "source_no")
    whole = Window.partitionBy()
    before = F.coalesce(F.sum("bound").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    levelled = (
        bounded.withColumn("total", F.sum("source_size").over(whole))
        .withColumn("level", (F.col("total") - before).cast("double") / rest)
        .withColumn("place", F.row_number().over(rising))
    )
    fits = F.col("level") <= F.col("bound") / F.col("weight")
    level = F.min_by("level", F.when(fits, F.col("place"))).over(whole)
    return levelled.select(
        "source", "source_no", "source_size", "total", F.least(F.col("bound").cast("double"), level * F.col("weight")).alias("target")
    )


def schedule(goals: DataFrame, block: int) -> DataFrame:
    """Slots of the mix in order: (slot, source_no, block_no, pass_no).

    Slot k lies at the fractional part of k + 1 golden ratios and belongs to the source whose
    stretch of the cumulative needs holds that point; its rank among the slots of that source gives
    the block. A source needs as many slots as its target has blocks, where a small source's blocks are
    smaller than others; no source with a target is without a point. Slots after the last allowed pass of a
    source are left out.
    """
    spark = goals.sparkSession
    blocks = F.ceil(F.col("source_size") / block)
    units = F.floor(F.col("target") / F.col("source_size") * blocks * UNITS).cast("long")
    needed = goals.where("target > 0").withColumns({"blocks": blocks, "units": units}).where("units > 0")
    sources, all_units = needed.agg(F.count("*"), F.coalesce(F.sum("units"), F.lit(0))).first()
    slots = -(-all_units // UNITS)
    share = F.floor(F.col("units") / F.lit(float(all_units)) * (POINTS - sources)).cast("long") + 1
    upto = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    stretches = needed.withColumn("high", F.sum(share).over(upto)).withColumn("low", F.col("high") - share)
    width = POINTS // CELLS
    cells = F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width)))
    stretches = stretches.select("source_no", "blocks", "low", "high", cells.alias("cell"))
    points = spark.range(slots).select(
        F.col("id").alias("slot"), (((F.col("id") + 1) % POINTS) * STEP % POINTS).alias("point")
    )
    drawn = points.withColumn("cell", F.floor(F.col("point") / width)).join(stretches, "cell")
    drawn = drawn.where("point >= low and point < high").select("slot", "source_no", "blocks", F.floor(F.col("slot") / RUN).alias("run"))
    counts = drawn.groupBy("source_no", "run").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source_no").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("source_no", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source_no", "run").orderBy("slot")
    ranked = drawn.withColumn("k", F.row_number().over(inside) - 1).join(offsets, ["source_no", "run"])
    rank = F.col("offset") + F.col("k")
    return ranked.select(
        "slot",
        "source_no",
        (rank % F.col("blocks")).alias("block_no"),
        F.floor(rank / F.col("blocks")).alias("pass_no"),
    ).where(F.col("pass_no") < PASSES)


def _laid(sized: DataFrame, seed: str) -> DataFrame:
    """Documents with their first token's place in the shuffled line of their source."""
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":" + seed)))
    keyed = sized.withColumn("key", key).withColumn("bin", F.substring("key", 1, 4))
    sums = keyed.groupBy("source_no", "bin").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source_no").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source_no", "bin", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = (
        Window.partitionBy("source_no", "bin")
        .orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return keyed.join(offsets, ["source_no", "bin"]).withColumn("start", start).drop("bin", "offset", "key")


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix"
) -> DataFrame:
    """How many words of each document a mix of the sources takes.

    Returns the id, ``size`` (words of the text), ``source``, ``source_size``, ``target`` (tokens of
    its source in the mix; see targets()) and ``taken`` (words that the mix takes, repeats
    counted). Each source's documents are put in a line by a hash of their id and cut into equal
    blocks of tokens; the schedule's slots take the blocks of their source in turn, up to three times
    around. So taken words of a source differ from its target by a few blocks, and a document is
    taken three times at most.

    A null text has no words; null is a source of its own; an empty document is never taken. Rows with
    a null or repeated id count as rows of their own. Other columns are ignored; an empty table gives
    no rows. The same rows give the same mix in any partitioning.
    """
    sized = cut(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), words_of(F.col(text_col)).alias("size")
        )
    )
    goals = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))))
    total = goals.agg(F.max("total")).first()[0] or 0
    block = min(BLOCK_MOST, max(BLOCK_LEAST, -(-total // BLOCK_SHARE)))
    named = sized.join(goals, sized.source.eqNullSafe(goals.source)).drop(goals.source)
    laid = cut(_laid(named.drop("total"), seed))
    times = schedule(goals, block).groupBy("source_no", "block_no").agg(F.count("*").alias("times"))
    full = laid.where("size > 0")
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    parts = full.withColumn("block_no", F.explode(F.sequence(first, last)))
    ends = F.least(F.col("start") + F.col("size"), (F.col("block_no") + 1) * block)
    begins = F.greatest(F.col("start"), F.col("block_no") * block)
    taken = (
        parts.join(times, ["source_no", "block_no"], "left")
        .withColumn("part", (ends - begins) * F.coalesce("times", F.lit(0)))
        .groupBy("doc_id", "size", "source", "source_no", "source_size", "target", "start")
        .agg(F.sum("part").alias("taken"))
    )
    columns = [F.col("doc_id").alias(id_col), "size", "source", "source_size", "target", "taken"]
    empty = laid.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return taken.select(*columns).unionByName(empty.select(*columns))


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
numbered AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS source_no FROM sizes),
bounded AS (
  SELECT *, CASE source_no % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS bound FROM numbered),
levels AS (
  SELECT *, sum(source_size) OVER ()::BIGINT AS total,
    row_number() OVER rising AS place,
    ((sum(source_size) OVER ()) - coalesce(sum(bound) OVER (rising ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / sum(weight) OVER (rising ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM bounded WINDOW rising AS (ORDER BY bound::DOUBLE / weight, source_no)),
chosen AS (SELECT arg_min(level, place) AS level FROM levels WHERE level <= bound::DOUBLE / weight),
goals AS (
  SELECT source, source_no, source_size, total, least(bound::DOUBLE, chosen.level * weight) AS target FROM levels, chosen),
shape AS (
  SELECT least(4096, greatest(16, ceil(max(total) / 1048576.0)))::BIGINT AS block, max(total) AS total FROM goals),
needs AS (
  SELECT source_no, ceil(source_size / block::DOUBLE)::BIGINT AS blocks,
    floor(target / source_size * ceil(source_size / block::DOUBLE)::BIGINT * 65536)::BIGINT AS units
  FROM goals, shape WHERE target > 0),
whole AS (SELECT sum(units)::BIGINT AS all_units, count(*) AS sources FROM needs WHERE units > 0),
stretches AS (
  SELECT source_no, blocks, floor(units::DOUBLE / all_units * (2147483648 - sources))::BIGINT + 1 AS share,
    sum(floor(units::DOUBLE / all_units * (2147483648 - sources))::BIGINT + 1) OVER (ORDER BY source_no)::BIGINT AS high
  FROM needs, whole WHERE units > 0),
points AS (
  SELECT slot, ((slot + 1) % 2147483648) * 1327217885 % 2147483648 AS point
  FROM (SELECT unnest(range(ceil(all_units / 65536.0)::BIGINT)) AS slot FROM whole)),
drawn AS (
  SELECT slot, source_no, blocks, row_number() OVER (PARTITION BY source_no ORDER BY slot) - 1 AS k
  FROM points JOIN stretches ON point >= high - share AND point < high),
times AS (SELECT source_no, k % blocks AS block_no, count(*) AS times FROM drawn WHERE k < 3 * blocks GROUP BY 1, 2),
laid AS (
  SELECT doc_id, size, sized.source, source_no, source_size, target,
    coalesce(sum(size) OVER (PARTITION BY source_no ORDER BY md5(coalesce(doc_id::VARCHAR, '') || ':mix'), doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source),
parts AS (
  SELECT laid.*, block, unnest(range(start // block, (start + size - 1) // block + 1)) AS block_no FROM laid, shape WHERE size > 0),
taken AS (
  SELECT doc_id, size, source, source_size, target,
    sum((least(start + size, (parts.block_no + 1) * block) - greatest(start, parts.block_no * block)) * coalesce(times, 0))::BIGINT AS taken
  FROM parts LEFT JOIN times USING (source_no, block_no) GROUP BY doc_id, size, source, source_no, source_size, target, start)
SELECT * FROM taken UNION ALL SELECT doc_id, size, source, source_size, target, 0 FROM laid WHERE size = 0
"""
