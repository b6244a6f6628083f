"""Exact copies by content-defined chunk recipes.

A text is cut where its content says so: after the first line end or sentence end that
follows at least MIN_CHUNK characters, and after MAX_CHUNK characters at the latest. A
chunk is known by a 64-bit hash. Chunks are reduced to distinct (hash, content) pairs,
map-side first, so each content moves once however many documents share it; wherever one
hash stands for two contents, the contents are told apart by their rank. That makes an
identifier verified against content, and a document's recipe, the ordered list of its
identifiers, equal exactly when the text is. From there on only recipes move, some two
hundredths of the text.

Defined results: null text is empty text, with an empty recipe; texts are compared as
they are, without normalising; of equal texts the largest doc_id stays; a null doc_id
never wins against a number, and is ``keep_id`` only if the whole group has none; of rows
equal in doc_id and text one is kept. A group's size and keeper come from a partial
aggregate, and the join back on the recipe is one that Spark splits when skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from purchaseflow.sources.scratch import staged

MIN_CHUNK, MAX_CHUNK = 256, 4096


def chunks(text: Column) -> Column:
    """The chunks of a text, in order; joined they are the text."""
    cut = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?(?:\n|[.!?] )|.{{1,{MAX_CHUNK}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def ambiguous(pieces: DataFrame) -> DataFrame:
    """Identifiers of contents that share their hash: ``h``, ``c`` and ``rank`` from 1.

    ``pieces`` has the distinct pairs of hash ``h`` and content ``c``. As a rule none
    share one, and the result is empty.
    """
    counted = pieces.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    shared = staged(counted.select("h"), "shared")
    if shared.isEmpty():
        # so that contents move once only: the join below would read and move them again
        return shared.select("h", F.lit("").alias("c"), F.lit(1).alias("rank"))
    again = pieces.join(shared, "h", "left_semi")
    rank = F.row_number().over(Window.partitionBy("h").orderBy("c"))
    return again.withColumn("rank", rank)


def recipes(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", hash_bits: int = 64
) -> DataFrame:
    """Per distinct (doc_id, text): ``doc_id``, ``text_sha256``, ``recipe``, ``copies`` (rows).

    ``hash_bits`` below 64 make chunk hashes collide, for tests.
    """
    whole = F.coalesce(F.col(text), F.lit(""))

    def hashed(chunk: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(chunk), 64 - hash_bits)

    cut = df.select(F.explode(chunks(whole)).alias("c"))
    shared = staged(ambiguous(cut.select(hashed(F.col("c")).alias("h"), "c").distinct()), "chunks")
    rows = (
        df.select(
            F.col(doc_id).alias("doc_id"),
            F.sha2(whole, 256).alias("text_sha256"),
            F.transform(chunks(whole), hashed).alias("recipe"),
        )
        .groupBy("doc_id", "text_sha256", "recipe")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    if shared.isEmpty():
        return rows

    # rare: spell out the recipes that hold a shared hash, and rank their chunks by content
    spelt = df.select(
        F.col(doc_id).alias("doc_id"),
        F.sha2(whole, 256).alias("text_sha256"),
        F.posexplode(chunks(whole)).alias("at", "c"),
    ).withColumn("h", hashed(F.col("c")))
    ranked = spelt.join(shared, ["h", "c"]).select(
        "doc_id", "text_sha256", F.struct("at", "rank").alias("ranked")
    )
    told = ranked.groupBy("doc_id", "text_sha256").agg(
        F.array_sort(F.collect_set("ranked")).alias("ranks")
    )
    same = rows["doc_id"].eqNullSafe(told["doc_id"]) & (
        rows["text_sha256"] == told["text_sha256"]
    )
    # ranks follow the hashes as (place + 1, rank) pairs: a longer list, but one type
    extra = F.flatten(
        F.transform(
            "ranks",
            lambda x: F.array((x["at"] + 1).cast("long"), x["rank"].cast("long")),
        )
    )
    return rows.join(told, same, "left").select(
        rows["doc_id"],
        rows["text_sha256"],
        F.when(F.col("ranks").isNull(), F.col("recipe"))
        .otherwise(F.concat("recipe", F.array(F.lit(-1).cast("long")), extra))
        .alias("recipe"),
        "copies",
    )


def find_copies(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", hash_bits: int = 64
) -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256."""
    own = staged(recipes(df, doc_id, text, hash_bits), "recipes")
    groups = (
        own.groupBy("recipe")
        .agg(
            F.count(F.lit(1)).alias("__rows"),
            F.max("doc_id").alias("keep_id"),
            F.sum("copies").alias("group_size"),
        )
        .filter(F.col("__rows") > 1)
        .drop("__rows")
    )
    # written first: a join with a bare aggregate is one that Spark does not split
    joined = own.join(staged(groups, "groups"), "recipe", "left")
    alone = F.col("group_size").isNull()
    return (
        joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .withColumns(
            {
                "keep_id": F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")),
                "group_size": F.coalesce("group_size", "copies"),
            }
        )
        .select(
            "doc_id",
            "keep_id",
            F.col("group_size").cast("long").alias("group_size"),
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )
