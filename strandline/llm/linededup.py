"""Removal of repeated passages of lines, bounded by their content. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.lineage import cut

#: Repeated hashes may be broadcast up to this many (8 bytes each).
BROADCAST_HASHES = 1_000_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value worked out once; a plain column would be worked out at each use in a lambda."""
    return F.transform(F.array(value), body)[0]


def windows(text: Column, with_lines: bool = True) -> Column:
    """Every two neighbouring lines of a text as (first, last, mark, run): line numbers from 1, rolling hash, digest.

    ``run`` is the first 128 bits of the lines' SHA-256, so that what is shuffled for a window does not grow with its lines.

    The rolling hash (a cyclic polynomial) of a window follows from the hashes of its lines alone, so a passage
    has the same hashes wherever it stands.
    """

    def pairs(lines: Column, hashes: Column) -> Column:
        def window(i: Column) -> Column:
            own = F.get(hashes, i)
            turned = F.shiftleft(own, 1).bitwiseXOR(F.shiftrightunsigned(own, 63))
            mark = turned.bitwiseXOR(F.get(hashes, i + 1)).alias("mark")
            both = F.concat(F.get(lines, i), F.lit("\n"), F.get(lines, i + 1)).cast("binary")
            run = F.unhex(F.substring(F.sha2(both, 256), 1, 32)).alias("run")
            return F.struct((i + 1).alias("first"), (i + 2).alias("last"), mark, *[run] * with_lines)

        count = F.size(lines) - 1
        return F.transform(F.filter(F.sequence(F.lit(0), F.greatest(count, F.lit(1))), lambda i: i < count), window)

    return _let(F.split(text, "\n", -1), lambda lines: _let(F.transform(lines, lambda x: F.xxhash64(x)), lambda h: pairs(lines, h)))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove the lines of chunks of two lines or more that occur before, anywhere in the table.

    A chunk is a run of lines whose windows of two have rolling hashes that occur elsewhere too: its boundaries
    are where the text stops being repeated, and do not move with what is inserted further up. Windows of
    equal hashes are told apart by 128 bits of SHA-256 of their lines. A line is removed if it and a
    neighbour follow each other in the same way in a text of smaller id or further up, so a repeated
    chunk goes from its first line to its last. Lines of the first copy of two lines are not removed as part of a
    copy that overlaps it ("x" four times leaves it twice). Every line stays somewhere in the table; a repeated
    line whose neighbours are new stays.

    Returns all columns and rows of the input with the text replaced, and ``n_lines`` and ``n_removed`` (lines
    of the input text, lines removed; columns of these names are replaced). A null text stays null with no
    lines; an empty text has one empty line. Rows that repeat both id and text are one document and keep the
    same lines; a null id comes before all others. A document that loses all lines stays with an empty text; an
    empty table gives no rows.
    """
    names = list(docs.columns)
    own = [c for c in names if c not in ("n_lines", "n_removed")]
    source = docs.select(
        F.struct(*own).alias("row"),
        F.col(text_col).alias("body"),
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"),
    )
    texts = source.select("id", "key", "body").where("body is not null")
    marks = texts.select(F.explode(windows(F.col("body"), with_lines=False)).alias("w")).select("w.mark")
    repeated = cut(marks.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark"))
    if repeated.count() <= BROADCAST_HASHES:
        repeated = F.broadcast(repeated)
    occurrences = texts.select("id", "key", F.explode(windows(F.col("body"))).alias("w")).select("id", "key", "w.*")
    again = cut(occurrences.join(repeated, "mark", "left_semi").select("id", "key", "first", "last", "run"))
    here = F.struct("id", "key", "first")
    keepers = cut(again.groupBy("run").agg(F.min(here).alias("keeper"), F.count("*").alias("n")).where("n > 1"))
    behind = F.col("keeper.first") + F.col("last") - F.col("first") + 1
    within = (F.col("key") == F.col("keeper.key")) & F.col("id").eqNullSafe(F.col("keeper.id"))
    start = F.when(within, F.greatest("first", behind)).otherwise(F.col("first"))
    removed = (
        again.join(keepers, "run")
        .where(~here.eqNullSafe(F.col("keeper")))
        .groupBy(F.col("key").alias("gone_key"), F.col("id").alias("gone_id"))
        .agg(F.array_distinct(F.flatten(F.collect_set(F.sequence(start, F.col("last"))))).alias("gone"))
    )
    removed = cut(removed.withColumn("n_gone", F.size("gone")))
    found = source.join(removed, (F.col("key") == F.col("gone_key")) & F.col("id").eqNullSafe(F.col("gone_id")), "left")
    lines = F.split("body", "\n", -1)
    kept = _let(lines, lambda x: F.transform(F.array_except(F.sequence(F.lit(1), F.size(x)), "gone"), lambda i: F.get(x, i - 1)))
    rebuilt = found.select(
        "row",
        F.when(F.col("gone").isNull(), F.col("body")).otherwise(F.array_join(kept, "\n")).alias("body"),
        F.when(F.col("body").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce("n_gone", F.lit(0)).cast("long").alias("n_removed"),
    )
    columns = [F.col("body").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in own]
    return rebuilt.select(*columns, "n_lines", "n_removed")


#: SQL for the rows of dedup_lines over documents.
ORACLE = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
    FROM documents WHERE text IS NOT NULL),
  pairs AS (SELECT doc_id, i, line, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM lines),
  firsts AS (
    SELECT *, first_value(doc_id) OVER w AS first_id, first_value(i) OVER w AS first_i FROM pairs WHERE next IS NOT NULL
    WINDOW w AS (PARTITION BY line, next ORDER BY doc_id, i)),
  copies AS (SELECT * FROM firsts WHERE NOT (doc_id = first_id AND i = first_i)),
  gone AS (
    SELECT doc_id, i FROM copies WHERE NOT (doc_id = first_id AND i = first_i + 1) UNION SELECT doc_id, i + 1 FROM copies),
  marked AS (SELECT lines.*, gone.i IS NOT NULL AS gone FROM lines LEFT JOIN gone USING (doc_id, i)),
  kept AS (
    SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text, count(*) AS n_lines,
      count(*) FILTER (gone) AS n_removed FROM marked GROUP BY 1)
SELECT doc_id, n_lines, n_removed, strlen(text)::BIGINT AS n_bytes, sha256(text) AS kept_sha256 FROM kept
"""
