"""Document fingerprints that add up: homomorphic multiset hashes.

The paragraphs (lines with content) of a text are hashed to vectors of WIDE lanes of 32
bits, the 512 bits of their SHA-512, which are summed modulo 2^32. The sum does not depend
on their order, and a paragraph can be added to it or taken away without the rest of the
text. A second vector
of SIGNS lanes takes each run of RUN words of a paragraph and adds its sign to its lane; its
direction tells how much two texts have in common, as such sums keep inner products, with
noise of about one in the square root of SIGNS. In scripts without blanks each sign is a word.

A fingerprint is a struct of ``wide`` (array of long) and ``signs`` (array of int). All of
it is a sum over parts, so ``combine`` works on texts, paragraphs and edits alike.

Defined results: null and empty texts and texts of only white space have the empty
fingerprint (all zeros), which is as like another empty one as can be (1) and unlike any
other (0); equal texts have equal fingerprints, and so have texts that differ in the
order of lines, in empty lines or in white space around lines only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from purchaseflow.llm.keys import keyed
from purchaseflow.llm.line_dedup import BLANKS, SIGNS as NO_BLANKS
from purchaseflow.sources.scratch import staged

WIDE = 16
SIGNS = 256
RUN = 2
_LOW = 0xFFFFFFFF
_WORD_ENDS = (
    f"[{BLANKS}]+|(?<=[{NO_BLANKS}])(?=[^{BLANKS}])|(?=[{NO_BLANKS}])(?<=[^{BLANKS}])"
)


def _bound(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once, even where ``then`` uses it in lambdas."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def fingerprint(text: str | Column) -> Column:
    """The fingerprint of a whole text."""
    whole = F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit(""))
    lines = F.transform(F.split(whole, "\n", -1), lambda x: F.btrim(x, F.lit(" \t\r")))
    filled = F.filter(lines, lambda x: x != "")
    paragraphs = F.transform(filled, lambda x: F.sha2(x, 512))

    def runs(line: Column) -> Column:
        """Hashes of the runs of RUN words of a line; one if it has fewer words."""

        def hashed(words: Column) -> Column:
            each = F.transform(
                words,
                lambda x, i: F.xxhash64(x, *[F.get(words, i + k) for k in range(1, RUN)]),
            )
            return F.slice(each, F.lit(1), F.greatest(F.size(words) - (RUN - 1), F.lit(1)))

        return _bound(F.split(line, _WORD_ENDS, -1), hashed)

    # a run is an even number for its lane and sign; sorted among all odd numbers, whose
    # places then tell how many runs lie between
    marked = F.transform(
        F.flatten(F.transform(filled, runs)),
        lambda x: F.pmod(x, F.lit(2 * SIGNS)).cast("int") * 2,
    )
    marks = F.transform(F.sequence(F.lit(0), F.lit(2 * SIGNS - 1)), lambda i: i * 2 + 1)
    placed = F.transform(
        F.sort_array(F.concat(marked, marks)), lambda x, i: F.when(x % 2 == 1, i).otherwise(-1)
    )

    def signs(ends: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(SIGNS - 1)),
            lambda i: F.get(ends, i * 2 + 1)
            - F.get(ends, i * 2) * 2
            + F.coalesce(F.get(ends, i * 2 - 1), F.lit(-1)),
        )

    def lane(hashes: Column, i: Column) -> Column:
        added = F.aggregate(
            hashes,
            F.lit(0).cast("long"),
            lambda acc, x: acc + F.conv(F.substring(x, i * 8 + 1, F.lit(8)), 16, 10).cast("long"),
        )
        return added.bitwiseAND(F.lit(_LOW))

    def over(count: int, hashes: Column, of) -> Column:
        return _bound(
            hashes, lambda h: F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: of(h, i))
        )

    return F.struct(
        over(WIDE, paragraphs, lane).alias("wide"),
        _bound(F.filter(placed, lambda x: x >= 0), signs).alias("signs"),
    )


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of both multisets together, or with ``sign=-1`` of ``a`` without ``b``."""

    def each(x: Column, y: Column) -> Column:
        return x + y if sign > 0 else x - y

    return F.struct(
        F.zip_with(
            a["wide"], b["wide"], lambda x, y: each(x, y).bitwiseAND(F.lit(_LOW))
        ).alias("wide"),
        F.zip_with(a["signs"], b["signs"], each).alias("signs"),
    )


def as_text(print_: Column) -> Column:
    """The fingerprint as lowercase hex: WIDE lanes of 8 digits, SIGNS lanes of 4."""

    def digits(lanes: Column, width: int) -> Column:
        shown = F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), width, "0"))
        return F.array_join(shown, "")

    signs = F.transform(print_["signs"], lambda x: x.bitwiseAND(F.lit(0xFFFF)))
    return F.concat(digits(print_["wide"], 8), digits(signs, 4))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the cosine of the two sign vectors where it is positive; 1 if all is equal."""

    def product(x: Column, y: Column) -> Column:
        added = F.zip_with(x, y, lambda p, q: p.cast("double") * q)
        return F.aggregate(added, F.lit(0.0), lambda acc, v: acc + v)

    def cosine(signed: Column) -> Column:
        x, y = signed["x"], signed["y"]
        size = F.sqrt(product(x, x) * product(y, y))
        return F.when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), product(x, y) / size)))

    both = F.struct(a["signs"].alias("x"), b["signs"].alias("y"))
    return F.when(a == b, 1.0).otherwise(F.coalesce(_bound(both, cosine), F.lit(0.0)))


KEY = ["__present", "__id", "__hash"]


def _rows(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Key without nulls, and text: an absent id is ``__present`` false and 0.

    The id itself is left to be read from the key: with one column more or less on one
    side, the joins below could not share their shuffle.
    """
    return keyed(df, doc_id, text).select(
        F.col("__id").isNotNull().alias("__present"),
        F.coalesce("__id", F.lit(0)).alias("__id"),
        "__hash",
        "__text",
    )


def successors(rows: DataFrame) -> DataFrame:
    """Per distinct key: the key of the next document by descending id, and ``__need``.

    Only keys move. They are dealt out by ranges and written once, so that each range
    is ordered in its own task; the first key of a range is lent to the range before it,
    and the very first to the very last.
    """
    spark = rows.sparkSession
    order = [F.desc("__present"), F.desc("__id"), F.asc("__hash")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = rows.select(*KEY, F.length("__text").alias("__chars")).distinct()
    ranged = keys.repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id())
    ranged = staged(ranged, "order")
    inside = Window.partitionBy("__range").orderBy(*order)
    key = F.struct(*KEY)
    placed = ranged.select(
        *KEY,
        "__chars",
        "__range",
        F.lead(key).over(inside).alias("__next"),
        F.row_number().over(inside).alias("__place"),
    )
    # one row for each range: as many as there are shuffle partitions, whatever the input
    heads = placed.filter(F.col("__place") == 1).select("__range", key.alias("__head"))
    along = Window.orderBy("__range")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select(
        "__range",
        F.coalesce(F.lead("__head").over(along), F.first("__head").over(whole)).alias("__over"),
    )
    return placed.join(heads, "__range").select(
        *KEY,
        F.floor(F.col("__chars") / 2).cast("int").alias("__need"),
        F.coalesce("__next", "__over").alias("__next"),
    )


def with_edited(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its fingerprint, that of its edited text, and how like they are.

    In the edited text the last half of the characters gives way to as many of the next
    document's first ones. The next document follows by descending doc_id (equal ids by
    text hash, null ids last), and the first follows the last.
    """
    # one shuffle by key serves both joins: whole texts move once, and their openings once
    rows = _rows(df, doc_id, text).withColumn("__print", fingerprint("__text"))
    links = successors(_rows(df, doc_id, text))
    renamed = {c: f"__of{c}" for c in KEY}
    wanted = links.select(
        *[F.col(c).alias(renamed[c]) for c in KEY], "__need", F.col("__next.*")
    )
    openings = (
        rows.join(wanted, KEY)
        .select(
            *[F.col(renamed[c]).alias(c) for c in KEY],
            F.substring(F.col("__text"), F.lit(1), F.col("__need")).alias("__opening"),
            F.col("__print").alias("__next_print"),
        )
        .groupBy(*KEY)
        .agg(
            F.first("__opening").alias("__opening"), F.first("__next_print").alias("__next_print")
        )
    )
    chars = F.length("__text")
    kept = F.substring(F.col("__text"), F.lit(1), chars - F.floor(chars / 2).cast("int"))
    return (
        rows.join(openings, KEY)
        .withColumn("__edited", F.concat(kept, "__opening"))
        .select(
            F.when(F.col("__present"), F.col("__id")).alias("doc_id"),
            chars.cast("long").alias("n_chars"),
            F.sha2("__edited", 256).alias("edited_sha256"),
            "__print",
            "__next_print",
            fingerprint("__edited").alias("__edited_print"),
        )
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            as_text(F.col("__print")).alias("fingerprint"),
            as_text(F.col("__edited_print")).alias("edited_fingerprint"),
            likeness(F.col("__print"), F.col("__edited_print")).alias("near_edited"),
            likeness(F.col("__print"), F.col("__next_print")).alias("near_next"),
        )
    )
