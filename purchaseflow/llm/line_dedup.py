"""Deletes runs of lines that have stood earlier in the corpus, by winnowed line hashes.

A line that has words is hashed without its outer white space. A window starts at any
such line and takes the lines that follow until it holds ``min_words`` words, so a long
paragraph is a window by itself. The smallest line hash of each window is its
fingerprint (winnowing): a run of ``min_words`` words or more that stands twice shares
at least one, wherever it begins, and only windows around a fingerprint that was seen at
two places go on. From there a match is extended to both sides: forward by the windows
that begin in it, backward by the windows that end in it, each compared by the hash of
its whole sequence of lines. A run is found twice exactly if one of these windows is at
each of its lines, so the outcome is exact up to 128-bit hash collisions:

    a line goes if it lies in a run of lines with at least ``min_words`` words which
    also begins at an earlier place, places being ordered by (doc_id, text hash, line).

Defined results: null text is empty text and has no line to delete; a null doc_id comes
first; lines without words never begin or end a run, and go with a run around them that would
be too short without its first or its last line; rows
equal in doc_id and text are one document and are treated alike; words are counted by
single spaces. Groups of equal windows are reduced to their first place by a partial
aggregate before any shuffle, and the join back is one that Spark splits when skewed, so
a line that a third of all documents share stays bounded. Nothing is collected beyond
the lines of one document.

``deleted_pieces`` cuts lines into pieces, which take the place of lines in all of this, so
that passages within lines are found too (see ``_starts``); words are then parted by white
space of any kind. The pipeline's stage uses it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from purchaseflow.llm.keys import HASH, ID, TEXT, keyed, same_key, text_hash
from purchaseflow.sources.scratch import staged

MIN_WORDS = 25
LINE_END = "\n"
REACH = 13  # words of a line that decide together where it is cut
BLANKS = " \t\r\v\f\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
BLANKS += "\u2028\u2029\u202f\u205f\u3000"
# signs of scripts written without blanks: South-East Asian, Tibetan, Japanese, Chinese
SIGNS = "\u0e00-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf"
SIGNS += "\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f" + r"\x{20000}-\x{3ffff}"
_NEW_WORD = f"(?=[^{BLANKS}])(?<=[{BLANKS}{SIGNS}])|(?=[{SIGNS}])(?<=[^{BLANKS}])"

# texts in which nothing but a blank or a line end parts words: most, and much cheaper to cut
_PLAIN = "\\A[\\n -~\u00a1-\u0dff\u2010-\u2027\u2030-\u205e]*+\\z"


def _lines(text: str | Column) -> Column:
    return F.split(text, LINE_END, -1)


def _bound(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once, even where ``then`` uses it in lambdas."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _words(line: Column) -> Column:
    """The words of a line without outer white space, each with the white space after it.

    White space of any kind, and any run of it, parts words. In scripts written without
    blanks each sign is a word, so passages there count by their length.
    """
    return F.split(line, _NEW_WORD, -1)


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda x: F.xxhash64(F.rtrim(x, F.lit(BLANKS))))


def _starts(hashes: Column) -> Column:
    """Where the pieces of a line begin: at its first word and at the winnowed ones.

    Of any REACH words in a row the one with the lowest hash, the first of equals, begins
    a piece, so pieces have REACH words at most and cuts depend on the words around them
    alone. A passage of n words that stands twice inside lines has at least
    n - 2 * REACH + 1 words of the same pieces at both places (25 of 50), and no fewer if
    it goes on over line ends.
    """

    def lowest(codes: Column) -> Column:
        for step in (1, 2, 4, REACH - 8):  # the lowest of 2, 4, 8 and REACH words from here on
            codes = _shifted(codes, step)
        return codes

    def _shifted(codes: Column, step: int) -> Column:
        # beyond the end are nulls, which least() leaves out
        return _bound(
            codes,
            lambda c: F.zip_with(c, F.slice(c, step + 1, F.size(c)), lambda x, y: F.least(x, y)),
        )

    codes = F.transform(
        hashes,
        lambda x, i: F.shiftleft(x.bitwiseAND(F.lit(0x7FFFFFFF)), 32) + i.cast("long"),
    )
    whole = F.slice(lowest(codes), F.lit(1), F.size(hashes) - (REACH - 1))
    chosen = F.transform(whole, lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))
    first = F.array(F.lit(0))
    cut = F.array_distinct(F.concat(first, chosen))
    return F.when(F.size(hashes) < REACH, first).otherwise(cut)


def _spans(starts: Column, count: Column, then) -> Column:
    """``then(first word, words, number)`` for each piece of a line."""
    return F.transform(
        starts, lambda s, k: then(s, F.coalesce(F.get(starts, k + 1), count) - s, k)
    )


def _pieces(text: str | Column) -> Column:
    """Per piece of each line: hash and number of words (0 for a line without words)."""
    text = F.col(text) if isinstance(text, str) else text

    def of(hashes: Column) -> Column:
        nothing = F.array(F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("w")))
        found = _bound(
            _starts(hashes),
            lambda starts: _spans(
                starts,
                F.size(hashes),
                lambda s, n, _: F.struct(
                    F.xxhash64(F.slice(hashes, s + 1, n)).alias("h"), n.alias("w")
                ),
            ),
        )
        return F.when(F.size(hashes) == 0, nothing).otherwise(found)

    def any_script(line: Column) -> Column:
        body = F.btrim(line, F.lit(BLANKS))
        words = F.when(body == "", F.array().cast("array<string>")).otherwise(_words(body))
        return _bound(_hashes(words), of)

    def blanks_only(line: Column) -> Column:
        words = F.filter(F.split(line, " ", -1), lambda x: x != "")
        return _bound(F.transform(words, lambda x: F.xxhash64(x)), of)

    lines = _lines(text)
    return F.when(text.rlike(_PLAIN), F.flatten(F.transform(lines, blanks_only))).otherwise(
        F.flatten(F.transform(lines, any_script))
    )


def _parts(text: str | Column) -> Column:
    """The same pieces as they stand: ``line`` and ``part``; the parts of a line make it up."""
    text = F.col(text) if isinstance(text, str) else text

    def any_script(line: Column, at: Column) -> Column:
        def shown(words: Column) -> Column:
            body = F.btrim(line, F.lit(BLANKS))
            lead = F.substring(line, F.lit(1), F.instr(line, body) - 1)
            tail = F.substring(line, F.instr(line, body) + F.length(body), F.length(line))

            def part(s: Column, n: Column, _) -> Column:
                return F.concat(
                    F.when(s == 0, lead).otherwise(""),
                    F.array_join(F.slice(words, s + 1, n), ""),
                    F.when(s + n == F.size(words), tail).otherwise(""),
                )

            return _bound(
                _starts(_hashes(words)),
                lambda starts: _spans(
                    starts,
                    F.size(words),
                    lambda *span: F.struct(at.alias("line"), part(*span).alias("part")),
                ),
            )

        return _bound(_words(F.btrim(line, F.lit(BLANKS))), shown)

    def blanks_only(line: Column, at: Column) -> Column:
        """A line's parts from what stands between its blanks, which is nothing between two."""

        def shown(between: Column) -> Column:
            places = F.filter(
                F.sequence(F.lit(0), F.size(between) - 1), lambda k: F.get(between, k) != ""
            )

            def cut(words: Column) -> Column:
                hashes = F.transform(words, lambda k: F.xxhash64(F.get(between, k)))

                def part(s: Column, n: Column, _) -> Column:
                    low = F.when(s == 0, 0).otherwise(F.get(words, s))
                    high = F.coalesce(F.get(words, s + n), F.size(between))
                    own = F.array_join(F.slice(between, low + 1, high - low), " ")
                    ended = F.when(high < F.size(between), " ").otherwise("")
                    return F.struct(at.alias("line"), F.concat(own, ended).alias("part"))

                found = _bound(
                    _bound(hashes, _starts), lambda starts: _spans(starts, F.size(words), part)
                )
                whole = F.array(F.struct(at.alias("line"), line.alias("part")))
                return F.when(F.size(words) == 0, whole).otherwise(found)

            return _bound(places, cut)

        return _bound(F.split(line, " ", -1), shown)

    lines = _lines(text)
    return F.when(text.rlike(_PLAIN), F.flatten(F.transform(lines, blanks_only))).otherwise(
        F.flatten(F.transform(lines, any_script))
    )


def windows(df: DataFrame, min_words: int) -> DataFrame:
    """Per line with words: the windows that begin and end there, and their fingerprint.

    ``ahead`` and ``behind`` are structs (key, start, end) or null where the document
    has too few words on that side; ``print`` and ``print_at`` are the smallest hash of
    the window ahead and its line; ``print_behind`` is the one of the window ahead of the
    line where ``behind`` begins.
    """
    trimmed = F.transform(_lines(TEXT), lambda x: F.btrim(x, F.lit(" \t\r")))
    measured = F.transform(
        trimmed,
        lambda x: F.struct(
            F.xxhash64(x).alias("h"),
            F.when(x == "", 0)
            .otherwise(1 + F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))))
            .alias("w"),
        ),
    )
    once = (
        df.select(ID, HASH, measured.alias("__lines"))
        .groupBy(ID, HASH)
        .agg(F.first("__lines").alias("__lines"))
    )
    lines = (
        once.select(ID, HASH, F.posexplode("__lines").alias("at", "line"))
        .select(ID, HASH, "at", F.col("line.h").alias("h"), F.col("line.w").alias("w"))
        .filter(F.col("w") > 0)
    )
    own = Window.partitionBy(ID, HASH)
    upto = F.sum("w").over(own.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    placed = lines.withColumn("upto", upto).withColumn("from", F.col("upto") - F.col("w"))
    ahead = own.orderBy("from").rangeBetween(0, min_words - 1)
    behind = own.orderBy("upto").rangeBetween(1 - min_words, 0)

    def window(over, start: Column, end: Column) -> Column:
        listed = F.collect_list("h").over(over)
        key = F.struct(F.xxhash64(listed).alias("a"), F.xxhash64(F.lit(1), listed).alias("b"))
        found = F.struct(key.alias("key"), start.alias("start"), end.alias("end"))
        return F.when(F.sum("w").over(over) >= min_words, found)

    lowest = F.min(F.struct("h", "at")).over(ahead)
    found = placed.withColumns(
        {"ahead": window(ahead, F.col("at"), F.max("at").over(ahead)), "lowest": lowest}
    )
    return found.withColumns(
        {
            "behind": window(behind, F.min("at").over(behind), F.col("at")),
            "print_behind": F.first("lowest.h").over(behind),
        }
    ).select(
        ID,
        HASH,
        "ahead",
        "behind",
        F.col("lowest.h").alias("print"),
        F.col("lowest.at").alias("print_at"),
        "print_behind",
    ).filter(F.col("ahead").isNotNull() | F.col("behind").isNotNull())


def deleted_lines(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """ID, HASH and ``gone``: the numbers, from 0, of a document's lines to delete."""
    found = staged(windows(keyed(df, doc_id, text), min_words), "lines")
    place = F.struct(ID, HASH, "print_at")
    twice = (
        found.filter(F.col("ahead").isNotNull())
        .groupBy("print")
        .agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
        .filter(~F.col("lo").eqNullSafe(F.col("hi")))
        .select(F.col("print").alias("__print"))
    )
    sides = F.array(
        F.struct(F.col("print").alias("print"), F.col("ahead").alias("window")),
        F.struct(F.col("print_behind").alias("print"), F.col("behind").alias("window")),
    )
    # each aggregate is written before it is joined: a join with a bare aggregate shares
    # its partitioning, and Spark does not split that when a key is hot
    seen = staged(
        found.select(ID, HASH, F.inline(sides))
        .filter(F.col("window").isNotNull())
        .join(staged(twice, "prints"), F.col("print") == F.col("__print"), "left_semi")
        .select(ID, HASH, "window.*"),
        "windows",
    )
    here = F.struct(ID, HASH, "start")
    first = (
        seen.groupBy("key")
        .agg(F.min(here).alias("__first"), F.count(F.lit(1)).alias("__times"))
        .filter(F.col("__times") > 1)
    )
    later = seen.join(staged(first, "first"), "key").filter(here > F.col("__first"))
    return (
        later.select(ID, HASH, F.explode(F.sequence("start", "end")).alias("line"))
        .groupBy(ID, HASH)
        .agg(F.collect_set("line").alias("gone"))
    )


def _window_ends(words: Column, min_words: int, then) -> Column:
    """``then(piece_of, first)``: the piece of each word, and each piece's first word.

    The shortest window ahead of a piece ends in the piece of its first word's
    ``min_words``-th; likewise backwards.
    """
    of = F.flatten(F.transform(words, lambda w, i: F.array_repeat(i, w)))

    def firsts(piece_of: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(piece_of) - 1)
        begins = F.filter(
            places, lambda k: (k == 0) | (F.get(piece_of, k) != F.get(piece_of, k - 1))
        )
        return _bound(begins, lambda first: then(piece_of, first))

    return _bound(of, firsts)


def _prints(h: str, w: str, min_words: int) -> Column:
    """The different window minima of a text's pieces; those of two pieces stand twice."""
    # bound, as fields of an array of structs would be taken out of it at every use
    return _bound(F.col(h), lambda h: _bound(F.col(w), lambda w: _minima(h, w, min_words)))


def _minima(h: Column, w: Column, min_words: int) -> Column:
    def minima(piece_of: Column, first: Column) -> Column:
        def lowest(at: Column, i: Column) -> Column:
            end = F.get(piece_of, at + (min_words - 1))
            return F.when(end.isNotNull(), F.array_min(F.slice(h, i + 1, end - i + 1)))

        return F.array_distinct(F.filter(F.transform(first, lowest), lambda x: x.isNotNull()))

    def with_repeats(found: Column) -> Column:
        again = _bound(
            F.sort_array(h),
            lambda a: F.filter(a, lambda x, i: (i > 0) & (x == F.get(a, i - 1))),
        )
        repeated = F.size(F.array_distinct(h)) < F.size(h)
        return F.when(repeated, F.concat(found, F.array_intersect(found, again))).otherwise(found)

    return _bound(_window_ends(w, min_words, minima), with_repeats)


def _among(value: Column, sorted_values: str) -> Column:
    """Whether ``value`` is one of the sorted ones, by binary search if they are many."""
    values = F.col(sorted_values)
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(31))])

    def on(low: Column, step: Column) -> Column:
        far = low.cast("long") + step
        here = (far <= F.size(values)) & (F.get(values, (far - 1).cast("int")) <= value)
        return F.when(here, far.cast("int")).otherwise(low)

    last = F.aggregate(steps, F.lit(0), on)
    found = F.coalesce(F.get(values, last - 1) == value, F.lit(False))
    return F.when(F.size(values) <= 256, F.array_contains(values, value)).otherwise(found)


def _repeated_windows(min_words: int) -> Column:
    """Structs (key, start, end) of the windows of ``h``, ``w`` with a minimum in ``prints``.

    Ahead of each piece and, where that is another one, behind it.
    """

    def found(piece_of: Column, first: Column) -> Column:
        words = F.size(piece_of)

        def shown(begin: Column, end: Column) -> Column:
            listed = F.slice("h", begin + 1, end - begin + 1)
            return F.struct(
                F.xxhash64(listed).alias("a"),
                F.xxhash64(F.lit(1), listed).alias("b"),
                begin.alias("start"),
                end.alias("end"),
            )

        def lowest(begin: Column) -> Column:
            end = F.get(piece_of, F.get(first, begin) + (min_words - 1))
            return F.array_min(F.slice("h", begin + 1, end - begin + 1))

        def ahead(at: Column, i: Column) -> Column:
            end = F.get(piece_of, at + (min_words - 1))
            return F.when(end.isNotNull() & _among(lowest(i), "prints"), shown(i, end))

        def behind(at: Column, i: Column) -> Column:
            upto = F.coalesce(F.get(first, i + 1), words)
            begin = F.get(piece_of, upto - min_words)
            enough = (upto >= min_words) & begin.isNotNull()
            # the window ahead of ``begin`` lies inside this one; if it is this one, it is there
            other = F.get(piece_of, F.get(first, begin) + (min_words - 1)) != i
            here = enough & other & _among(lowest(begin), "prints")
            return F.when(here, shown(begin, i))

        both = F.concat(F.transform(first, ahead), F.transform(first, behind))
        return F.filter(both, lambda x: x.isNotNull())

    return _window_ends(F.col("w"), min_words, found)


def deleted_pieces(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """ID, HASH, ``gone`` (numbers of the pieces to delete, from 0) and ``whole``.

    The same rule as for lines, with less to move. A text is worked on once, at its first
    place; its later copies are repeated as a whole, and go by that. Of the windows of the
    different texts only the distinct minima are counted. Windows themselves are built
    for texts with a minimum that was seen twice, and only around such minima.
    """
    rows = keyed(df, doc_id, text)
    second = F.xxhash64(F.lit(1), TEXT).alias("__hash2")
    numbered = F.transform(
        _pieces(TEXT), lambda x, i: F.struct(x["h"].alias("h"), x["w"].alias("w"), i.alias("at"))
    )
    once = (
        rows.select(ID, HASH, second, F.filter(numbered, lambda x: x["w"] > 0).alias("__pieces"))
        .groupBy(HASH, "__hash2")
        .agg(
            F.min(F.struct(ID)).alias("__place"),
            F.count(F.lit(1)).alias("__copies"),
            F.first("__pieces").alias("__pieces"),
        )
        .filter(F.size("__pieces") > 0)
        .select(
            F.col(f"__place.{ID}").alias(ID),
            HASH,
            "__hash2",
            "__copies",
            F.col("__pieces.h").alias("h"),
            F.col("__pieces.w").alias("w"),
            F.col("__pieces.at").alias("at"),
        )
    )
    texts = staged(once.withColumn("prints", _prints("h", "w", min_words)), "texts")
    own = texts.filter(F.size("prints") > 0).select(HASH, "__hash2", F.explode("prints").alias("print"))
    twice = own.groupBy("print").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    # each aggregate is written before it is joined: a join with a bare aggregate shares
    # its partitioning, and Spark does not split that when a key is hot
    seen = staged(twice.select(F.col("print").alias("__print")), "prints")
    marked = (
        own.join(seen, F.col("print") == F.col("__print"), "left_semi")
        .groupBy(F.col(HASH).alias("__h"), F.col("__hash2").alias("__h2"))
        .agg(F.sort_array(F.collect_set("print")).alias("prints"))
    )
    same_text = (F.col(HASH) == F.col("__h")) & (F.col("__hash2") == F.col("__h2"))
    around = texts.drop("prints").join(marked, same_text)
    built = staged(
        around.select(ID, HASH, "at", F.explode(_repeated_windows(min_words)).alias("x")).select(
            "x.a",
            "x.b",
            ID,
            HASH,
            F.get("at", "x.start").alias("start"),
            F.get("at", "x.end").alias("end"),
        ),
        "windows",
    )
    here = F.struct(ID, HASH, "start")
    first = (
        built.groupBy("a", "b")
        .agg(F.min(here).alias("__first"), F.count(F.lit(1)).alias("__times"))
        .filter(F.col("__times") > 1)
        .drop("__times")
    )
    later = built.join(staged(first, "first"), ["a", "b"]).filter(here > F.col("__first"))
    parts = (
        later.groupBy(ID, HASH)
        .agg(F.collect_set(F.struct("start", "end")).alias("__runs"))
        .select(
            ID,
            HASH,
            F.array_distinct(
                F.flatten(F.transform("__runs", lambda r: F.sequence(r["start"], r["end"])))
            ).alias("gone"),
            F.lit(False).alias("whole"),
        )
    )
    enough = F.aggregate("w", F.lit(0).cast("long"), lambda n, w: n + w) >= min_words
    repeated = staged(
        texts.filter((F.col("__copies") > 1) & enough).select(
            F.col(HASH).alias("__h"), F.col("__hash2").alias("__h2"), F.col(ID).alias("__rep")
        ),
        "copied",
    )
    copies = (
        rows.select(ID, HASH, second)
        .join(repeated, same_text)
        .filter(~F.col(ID).eqNullSafe(F.col("__rep")))
        .select(ID, HASH)
        .distinct()
    )
    none = F.lit(None).cast("array<int>").alias("gone")
    return parts.unionByName(copies.select(ID, HASH, none, F.lit(True).alias("whole")))


def without(text: str | Column, gone: str | Column) -> Column:
    """``text`` without the lines numbered in ``gone``."""

    def rebuilt(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.transform(kept, lambda i: F.get(lines, i))

    # the outer array binds the lines once: inside the lambda they would be split again
    kept = F.get(F.transform(F.array(_lines(text)), rebuilt), F.lit(0))
    return F.array_join(kept, LINE_END)


def without_pieces(text: str | Column, gone: str | Column) -> Column:
    """``text`` without the pieces numbered in ``gone``; a line goes if all its pieces go."""

    def rebuilt(parts: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone)
        return F.transform(kept, lambda i: F.get(parts, i))

    def joined(kept: Column) -> Column:
        def part(x: Column, i: Column) -> Column:
            begins = (i > 0) & (F.get(kept, i - 1)["line"] != x["line"])
            return F.concat(F.when(begins, LINE_END).otherwise(""), x["part"])

        return F.array_join(F.transform(kept, part), "")

    return _bound(_bound(_parts(text), rebuilt), joined)


def dedup_lines(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Per row of ``df``: ID, HASH, TEXT (whole), ``gone`` (null if nothing goes), ``left``.

    ``left`` is the text without the lines that go.
    """
    rows = keyed(df, doc_id, text)
    gone = deleted_lines(df, doc_id, text, min_words)
    joined = rows.join(gone, same_key(rows, gone), "left").select(
        rows[ID], rows[HASH], rows[TEXT], gone["gone"]
    )
    left = F.when(F.col("gone").isNull(), F.col(TEXT)).otherwise(without(TEXT, F.col("gone")))
    return joined.withColumn("left", left)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without repeated runs; those left without a word go.

    Runs are of pieces, so passages within lines go too. Other columns stay as they are,
    ``n_chars`` is counted anew.
    """
    names = {ID: "__gone_id", HASH: "__gone_hash", "gone": "__gone", "whole": "__whole"}
    gone = deleted_pieces(docs).withColumnsRenamed(names)
    same = docs["doc_id"].eqNullSafe(gone["__gone_id"]) & (
        text_hash(docs["text"]) == gone["__gone_hash"]
    )
    touched = F.col("__whole").isNotNull()
    left = (
        F.when(~touched, F.col("text"))
        .when(F.col("__whole"), F.lit(""))
        .otherwise(without_pieces("text", F.col("__gone")))
    )
    # a generator makes the text once, where a filter on it would make it once more
    kept = _bound(
        left,
        lambda text: F.when(~touched | text.rlike(r"\S"), F.array(text)).otherwise(F.array()),
    )
    joined = docs.join(gone, same, "left").withColumn("__left", F.explode(kept))
    anew = {"text": F.col("__left")}
    if "n_chars" in docs.columns:
        anew["n_chars"] = F.length("__left").cast(docs.schema["n_chars"].dataType)
    return joined.select(*[anew.get(c, F.col(c)).alias(c) for c in docs.columns])
