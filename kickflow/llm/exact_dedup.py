"""Exact duplicates by a tree of merges over sorted runs of digests (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickflow.llm.common import stored

RUNS = 64
FAN_IN = 8


def normalised(text: F.Column) -> F.Column:
    """Each run of blanks, tabs and line ends is one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def fingerprint(text: F.Column) -> F.Column:
    """The digest that orders runs, and a second hash and the length that verify it."""
    plain = normalised(text)
    return F.struct(
        F.unhex(F.sha2(plain, 256)).alias("digest"),
        F.xxhash64(plain).alias("check"),
        F.octet_length(plain).alias("length"),
    )


def merge_runs(entries: DataFrame, runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """Per fingerprint the smallest identifier and the number of rows.

    ``entries`` has ``run`` (the partition a row was read in), ``print`` (a fingerprint) and
    ``id`` (any type with an order; nulls last). A task first sorts and combines its own run.
    In each round groups of ``fan_in`` runs meet and are merged in digest order; what goes on is
    one entry per fingerprint and group, with the smallest identifier verified so far. A round
    spreads over (run, fingerprint), so neither a run nor a frequent text is one task's work.
    """
    smallest = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id")))
    level = entries.select(F.pmod("run", F.lit(runs)).alias("run"), "print", "id")
    level = level.groupBy("run", "print").agg(smallest.alias("least"), F.count("*").alias("n"))
    while runs > 1:
        runs = -(-runs // fan_in)
        level = (
            level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
            .groupBy("run", "print")
            .agg(F.min("least").alias("least"), F.sum("n").alias("n"))
        )
    return level.select("print", F.col("least.id").alias("keep"), "n")


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its group of equal texts, and whether it is the one to keep.

    Columns: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``digest`` (binary). Equal
    means identical after ``normalised``. The smallest id stays; null ids come last; of rows
    that repeat one id, exactly one is kept. Null texts equal empty ones. Columns of ``docs``
    other than ``id`` and ``text`` are not read. An empty table gives an empty table.
    """
    entries = stored(
        docs.select(
            F.col(id).alias("doc_id"),
            F.spark_partition_id().alias("run"),
            F.monotonically_increasing_id().alias("row"),
            fingerprint(F.col(text)).alias("print"),
        ),
        "digests",
    )
    # The row number separates rows of one id; a struct of nulls would not count as null.
    ids = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    groups = merge_runs(entries.select("run", "print", ids.alias("id")))
    return entries.join(groups, "print").select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.col("print.digest").alias("digest"),
    )


def drop_exact(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns.

    Rows that repeat both the smallest id and the text are told apart by their other columns;
    the smallest stays.
    """
    names = docs.columns
    taken = docs.select(
        F.struct(*[docs[name] for name in names]).alias("whole"),
        docs[id].alias("id"),
        fingerprint(docs[text]).alias("print"),
    )
    entries = stored(
        taken.select("id", "print", F.spark_partition_id().alias("run")), "digests"
    )
    keys = F.struct(F.col("id").isNull().alias("none"), "id")
    groups = merge_runs(entries.select("run", "print", keys.alias("id")))
    # Only groups of several rows have anything to drop; the others need no text in a shuffle.
    groups = stored(
        entries.groupBy("print", "id").agg(F.count("*").alias("same"))
        .join(groups, "print")
        .where("n > 1")
        .select("print", "id", (F.col("keep.id").eqNullSafe(F.col("id"))).alias("stays"), "same"),
        "groups",
    )
    gone = groups.where(~F.col("stays")).select("print", "id")
    same_row = (taken["print"] == gone["print"]) & taken["id"].eqNullSafe(gone["id"])
    rest = taken.join(gone, same_row, "left_anti")
    again = groups.where("stays AND same > 1").select(F.col("print").alias("twice"))
    marked = rest.join(again, rest["print"] == again["twice"], "left")
    once = marked.where("twice IS NULL").select("whole.*")
    several = marked.where("twice IS NOT NULL").groupBy("print").agg(F.min("whole").alias("whole"))
    return once.unionByName(several.select("whole.*"))
