"""Exact deduplication by deterministic block naming, in Spark expressions.

A normalised text is cut into blocks of fixed size. Equal blocks get one integer name: distinct blocks are
sorted and numbered. Then adjacent names are paired, distinct pairs are sorted and numbered in the same
way, and so on until each text has a single name. Two texts get the same name exactly when they are equal:
a digest only routes blocks, and blocks with equal digests but different content get names of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .store import Keep, scratch, written

BLOCK = 4096  # code points
SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Runs of white space become one blank; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _blocks(size: int) -> Column:
    """The blocks of the column ``text``; an empty text has one empty block."""
    last = F.greatest(F.lit(0), F.ceil(F.char_length("text") / F.lit(size)) - 1)
    cut = F.transform(F.sequence(F.lit(0), last.cast("int")), lambda i: F.substring("text", i * size + 1, F.lit(size)))
    return F.when(F.char_length("text") <= size, F.array("text")).otherwise(cut)


def _block_names(blocks: DataFrame) -> DataFrame:
    """(digest, block, name): distinct blocks in sorted order, numbered.

    The set of one digest holds one block unless digests collide, so no group grows with the data. The block
    itself is only carried where it is needed to tell colliding ones apart.
    """
    sets = blocks.groupBy("digest").agg(F.array_sort(F.collect_set("block")).alias("set"))
    ranked = sets.sortWithinPartitions("digest").select("digest", F.size("set").alias("many"), F.explode("set").alias("block"))
    return ranked.select(
        "digest", F.when(F.col("many") > 1, F.col("block")).alias("block"), F.monotonically_increasing_id().alias("name")
    )


def identities(
    docs: DataFrame, id_col: str, text_col: str, keep: Keep, size: int = BLOCK,
    digest: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """(row, doc_id, sha256, level, name) per input row; normalised texts are equal when (level, name) is.

    ``level`` is the number of pairings that a text of so many blocks needs. ``keep`` writes the table of a
    step and reads it back.
    """
    text = docs.select(F.col(f"`{id_col}`").alias("doc_id"), normalised(F.col(f"`{text_col}`")).alias("text"))
    pieces = text.select(F.explode(_blocks(size)).alias("block")).select(digest(F.col("block")).alias("digest"), "block")
    names = keep(_block_names(pieces), "block-names")
    # as a rule no digests collide; then this is an empty table and no text moves to meet it
    clashing = keep(names.where("block is not null").select("digest", "block", F.col("name").alias("exact")), "clashing")
    plain = names.where("block is null").select("digest", "name")

    rows = text.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"),
        _blocks(size).alias("blocks"),
    ).withColumn("n", F.size("blocks"))
    spread = rows.select("doc_id", "row", "sha256", "n", F.posexplode("blocks").alias("pos", "block"))
    first = F.col("pos") == 0
    spread = spread.select(
        "row", "n", "pos", "block", digest(F.col("block")).alias("digest"),
        F.when(first, F.col("doc_id")).alias("doc_id"), F.when(first, F.col("sha256")).alias("sha256"),
    )
    told = keep(spread.join(clashing, ["digest", "block"], "left").drop("block"), "blocks")
    level = keep(told.join(plain, "digest", "left").withColumn("name", F.coalesce("exact", "name")).drop("digest", "exact"), "names")
    most = level.agg(F.max("n")).first()[0] or 1
    done, depth = [], 0
    while True:
        done.append(level.where("n = 1").select("row", "doc_id", "sha256", F.lit(depth).alias("level"), "name"))
        if most == 1:
            break
        left = F.col("pos") % 2 == 0
        pairs = keep(
            level.where("n > 1")
            .groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(
                F.max(F.when(left, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(~left, F.col("name"))), F.lit(-1)).alias("right"),  # -1: nothing follows
                F.ceil(F.max("n") / 2).cast("int").alias("n"),
                F.first("doc_id", True).alias("doc_id"),
                F.first("sha256", True).alias("sha256"),
            ),
            "pairs",
        )
        distinct = pairs.select("left", "right").distinct().sortWithinPartitions("left", "right")
        named = keep(distinct.withColumn("name", F.monotonically_increasing_id()), "pair-names")
        level = keep(pairs.join(named, ["left", "right"]).drop("left", "right"), "names")
        most, depth = -(-most // 2), depth + 1
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out


def groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = BLOCK,
    digest: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per input row: (id, keep_id, group_size, kept, text_sha256).

    NULL texts count as empty, so they are equal to one another and to blank texts of no character. Of
    equal texts the row with the smallest id stays, a NULL id only where there is no other; of repeated rows
    with that id exactly one is kept. An empty table gives no rows. Other columns are not looked at.
    """
    with scratch(docs.sparkSession, "names") as keep:
        named = written(identities(docs, id_col, text_col, keep, size, digest), "identities")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    best = written(
        named.groupBy("level", "name").agg(F.min(key).alias("best"), F.count(F.lit(1)).alias("group_size")), "groups"
    )
    return named.join(best, ["level", "name"]).select(
        F.col("doc_id").alias(id_col),
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows that stay, with all their columns."""
    made = written(groups(docs, id_col, text_col, **options), "copies")
    per_id = made.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("stay"))
    odd = written(per_id.where("n > stay"), "dropped")
    gone = odd.where("stay = 0").select(id_col)
    rest = docs.join(gone, docs[id_col].eqNullSafe(gone[id_col]), "left_anti")
    repeated = odd.where("stay > 0").select(id_col)
    if repeated.isEmpty():
        return rest
    # an id that stands for several rows, of which some stay: equal texts of it count once
    sure = rest.join(repeated, rest[id_col].eqNullSafe(repeated[id_col]), "left_anti")
    keyed = rest.join(repeated, rest[id_col].eqNullSafe(repeated[id_col]), "left_semi")
    key = F.sha2(normalised(F.col(f"`{text_col}`")).cast("binary"), 256).alias("text_sha256")
    kept = made.where("kept").select(F.col(id_col).alias("__id"), F.col("text_sha256").alias("__sha"))
    once = keyed.withColumn("__key", key).dropDuplicates([id_col, "__key"])
    return sure.unionByName(
        once.join(kept, once[id_col].eqNullSafe(kept["__id"]) & (once["__key"] == kept["__sha"]), "left_semi").drop("__key")
    )
