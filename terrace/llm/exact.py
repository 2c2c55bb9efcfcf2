"""Exact duplicates by content-defined chunk recipes.

A text is cut where its own characters say so, so equal texts are cut alike.
Chunks are grouped by their characters, which verifies the identifiers; a
document is then the ordered list of its chunk identifiers, and only these
lists are grouped and joined. A text crosses the network at most once, as
chunks after map-side deduplication, whatever its length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import stored, text_or_empty

# A cut follows a line end, or a character of the first class that stands
# before a blank and one of the second; LEAST to MOST characters lie between two.
LEAST, MOST = 1024, 8192
_CUT = r"(?<=\n)|(?<=[aeiouyàéèöüó.,;0-9])(?=[ \t][b-dm-rA-HÀ-Ö])"


def chunks_of(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The chunks of a text in order; joined they are the text. An empty text has none."""
    pattern = rf"(?s).{{{least},{most}}}?(?:{_CUT}|\z)|.{{{most}}}|.+"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def with_recipes(docs: DataFrame, hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """doc_id, text_sha256, recipe: the verified identifiers of the chunks in order.

    An identifier is the chunk's hash where no other chunk of the data has that
    hash. Hashes that different chunks share are found by grouping the chunks
    themselves; there it is the hash and the chunk's rank among them.
    """
    cut = docs.select(
        "doc_id", F.sha2(text_or_empty(), 256).alias("text_sha256"), chunks_of(text_or_empty()).alias("chunks")
    )
    different = cut.select(F.explode("chunks").alias("chunk")).select(hash_of(F.col("chunk")).alias("h"), "chunk").distinct()
    shared = stored(different.groupBy("h").count().where("count > 1").select("h"), "shared-hashes")
    plain = F.transform("chunks", lambda c: F.struct(hash_of(c).alias("h"), F.lit(0).alias("rank")))
    if shared.isEmpty():
        return cut.select("doc_id", "text_sha256", plain.alias("recipe"))
    ranked = different.join(shared, "h").withColumn("rank", F.row_number().over(Window.partitionBy("h").orderBy("chunk")))
    cut = cut.withColumn("row", F.coalesce("doc_id", F.lit(-(1 << 63))))
    key = ["row", "text_sha256"]
    placed = cut.distinct().select(*key, F.posexplode("chunks").alias("pos", "chunk"))
    named = placed.withColumn("h", hash_of(F.col("chunk"))).join(ranked, ["h", "chunk"], "left")
    part = F.struct("pos", F.struct("h", F.coalesce("rank", F.lit(0)).alias("rank")).alias("id"))
    recipes = named.groupBy(*key).agg(F.sort_array(F.collect_list(part)).alias("parts"))
    none = F.slice(F.array(F.struct(F.lit(0).cast("bigint").alias("h"), F.lit(0).alias("rank"))), 1, 0)
    return cut.select("doc_id", *key).join(recipes, key, "left").select(
        "doc_id", "text_sha256", F.coalesce(F.transform("parts", lambda p: p["id"]), none).alias("recipe")
    )


def exact_duplicates(docs: DataFrame, hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays; a null text is the
    empty text. Rows that repeat a doc_id and its text are members like any
    other, and of those with the doc_id that stays every one says kept. A group
    without any doc_id keeps no row. An empty table gives an empty result;
    further columns are ignored. `hash_of` is there to test shared hashes.
    """
    listed = with_recipes(docs, hash_of)
    groups = listed.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Only groups of several rows are joined back; a row without partner is its own group.
    several = groups.where("group_size > 1")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return listed.join(several, "recipe", "left").select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(F.col("doc_id") == keep, F.lit(False)).alias("kept"),
        "text_sha256",
    )
