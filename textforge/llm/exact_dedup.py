"""Exact de-duplication with two passes over a Bloom filter, in DataFrame operations only.

Texts are equal when they are identical after lower-casing A-Z; a null text counts as empty.

Pass 1 hashes every normalised text to a counter position (16 to 32 positions per row) and counts the
rows per position, combined before the shuffle; the positions counted twice or more become the bits
of a Bloom filter, 64 to a word, folded to at most ``filter_words`` words. That bounds the broadcast
whatever the input; a filter too small for its table only passes more rows. Pass 2 tests every row
against the broadcast filter: a row whose bit is not set has no copy and passes straight through, the
others shuffle with their SHA-256 digest, which decides. Texts never shuffle: the passes work on a
written table of ids and digests. A large group of copies is one row per task after partial
aggregation, and its rows meet the kept one in several parts.

Defined cases: of equal texts the row with the largest id stays; a null id is smaller than any id;
of rows that are equal in text and id exactly one is kept; an id may carry several texts; an empty
table gives an empty result; ``drop_copies`` keeps all extra columns and their values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textforge.llm.frames import checked_broadcast, fresh, table
from textforge.session import materialize

FILTER_WORDS = 1 << 20
SALTS = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case; pure ASCII takes the built-in, which is the same there."""
    text = F.coalesce(text, F.lit(""))
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, digest`` of every row, written once."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.sha2(ascii_lower(F.col(text_col)), 256).alias("digest")
    )
    return materialize(rows, "digests")


def _with_slot(rows: DataFrame, n_slots: int, filter_words: int) -> DataFrame:
    """Adds each row's counter position, the filter word that holds its bit, and the bit."""
    slot = F.pmod(F.xxhash64("digest"), F.lit(n_slots))
    return (
        rows.withColumn("slot", slot)
        .withColumn("word", F.expr(f"shiftright(slot, 6) % {filter_words}"))
        .withColumn("bit", F.expr("shiftleft(1L, cast(slot & 63 as int))"))
    )


def copies(rows: DataFrame, filter_words: int = FILTER_WORDS) -> DataFrame:
    """``id, digest, keep_id, group_size, kept`` of the rows of ``digests``."""
    n_slots = 1 << max(10, (16 * rows.count()).bit_length())
    rows = _with_slot(rows, n_slots, filter_words)
    repeated = rows.groupBy("slot", "word", "bit").agg(F.count("*").alias("n")).where("n > 1")
    bloom = repeated.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    bloom = F.broadcast(materialize(bloom, "bloom"))  # at most filter_words rows of 16 bytes
    probed = rows.join(bloom, "word", "left")
    maybe = F.coalesce(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.lit(False))
    straight = probed.where(~maybe).select(
        "id", "digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    same = probed.where(maybe).groupBy("digest", "id").agg(F.count("*").alias("n"))
    groups = same.groupBy("digest").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"))
    # A large group meets its kept row in SALTS parts.
    salts = F.explode(F.array(*(F.lit(i) for i in range(SALTS))))
    salted = same.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    met = salted.join(groups.withColumn("salt", salts), ["digest", "salt"])
    # Equal rows were one row with a count until here.
    each = met.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    shuffled = each.select(
        "id", "digest", "keep_id", "group_size", (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept")
    )
    return straight.union(shuffled)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows that stay, with their own columns; only rows whose id is not unique shuffle."""
    rows = digests(docs, id_col, text_col)
    found = materialize(copies(rows, **options), "copies")
    several = rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 OR id IS NULL").select("id")
    dropped = found.where("NOT kept").select("id").distinct()
    lost, digest = fresh(docs, "lost_id"), fresh(docs, "digest")
    here = F.col(f"`{id_col}`").cast("long")
    not_here = materialize(dropped.union(several).distinct().withColumnRenamed("id", lost), "not_here")
    single = docs.where(here.isNotNull()).join(checked_broadcast(not_here), here == F.col(lost), "left_anti")
    several = materialize(several.withColumnRenamed("id", lost), "several")
    unclear = docs.join(checked_broadcast(several), here.eqNullSafe(F.col(lost)), "left_semi")
    unclear = unclear.withColumn(digest, F.sha2(ascii_lower(F.col(f"`{text_col}`")), 256))
    wanted = fresh(docs, "wanted")
    stays = found.where("kept").select(F.col("id").alias(lost), F.col("digest").alias(wanted))
    stays = stays.join(several.withColumnRenamed(lost, "s"), F.col(lost).eqNullSafe(F.col("s")), "left_semi")
    kept = unclear.join(
        stays, here.eqNullSafe(F.col(lost)) & (F.col(digest) == F.col(wanted)), "left_semi"
    ).dropDuplicates([id_col, digest])
    return single.unionByName(kept.drop(digest))


def op7_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = copies(digests(docs, "doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )
