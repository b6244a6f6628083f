"""Histories dealt by key once and written, for several analyses to read.

Follow-ups, exact sets and journeys each need all events of a key together. ``deal``
shuffles the table once, lays each key's events out as one list in their order, and writes
the lists; each analysis then reads them where they are, without a shuffle of events.
A list holds a page of ``page_items`` events at most (and the very first), so no list grows
with a history; each page knows the key's first event and the event that follows it.
Hot keys (see ``hot``) are dealt by chunks, and a page across two chunks stands in two
rows. What of an analysis spans several rows of a key, a set or such a page, meets in a
shuffle of one row for each of these rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from purchaseflow.operators.hot import CHUNK, CHUNK_ROWS, Split, running, split
from purchaseflow.operators.journeys import PAGE_ITEMS, POSITION, SEGMENT
from purchaseflow.sources.scratch import staged

_EVENTS, _OPENING, _AFTER = "__events", "__opening", "__after"


@dataclass(frozen=True)
class History:
    """Pages of events by key: ``rows`` has the keys, SEGMENT, CHUNK (null for ordinary
    keys) and the lists; ``order`` and ``item`` name the events' fields."""

    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    item: str
    cut: bool

    def followed_by(self, first: str, then: str) -> DataFrame:
        """What ``sequence.followed_by`` returns."""
        fields = dict.fromkeys([*self.order, self.item])
        events = F.transform(_EVENTS, lambda e: F.struct(*[e[c].alias(c) for c in fields]))
        upcoming = F.concat(F.slice(events, F.lit(2), F.size(_EVENTS)), F.array(_AFTER))
        pairs = F.zip_with(events, upcoming, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        found = F.filter(
            pairs, lambda p: (p["a"][self.item] == first) & (p["b"][self.item] == then)
        )
        date = self.order[0]
        return self.rows.select(*self.keys, F.explode(found).alias("__pair")).select(
            *self.keys,
            *[F.col(f"__pair.a.{c}").alias(f"first_{c}") for c in self.order],
            *[F.col(f"__pair.b.{c}").alias(f"then_{c}") for c in self.order],
            F.datediff(f"__pair.b.{date}", f"__pair.a.{date}").alias("days_between"),
        )

    def exactly(self, allowed: Sequence[str], name: str = "items") -> DataFrame:
        """What ``sets.exactly`` returns."""
        wanted = sorted(set(allowed))
        if not wanted:
            raise ValueError("allowed must name at least one item")
        only = F.forall(
            _EVENTS, lambda e: F.coalesce(e[self.item].isin(wanted), F.lit(False))
        )
        seen = F.array_intersect(
            F.transform(_EVENTS, lambda e: e[self.item]), F.array(*[F.lit(w) for w in wanted])
        )
        listed = F.array(*[F.lit(w) for w in wanted]).alias(name)
        flags = self.rows.select(*self.keys, _AFTER, SEGMENT, POSITION, only.alias("__only"), seen.alias("__seen"))
        whole = (F.col(POSITION) == 1) & F.col(_AFTER).isNull()
        alone = flags.filter(whole & F.col("__only") & (F.size("__seen") == len(wanted)))
        # histories of several rows; what disqualifies a key is kept, the rest is a set
        several = (
            flags.filter(~whole)
            .select(*self.keys, F.explode_outer("__seen").alias("__item"), "__only")
            .groupBy(*self.keys)
            .agg(F.bool_and("__only").alias("__only"), F.collect_set("__item").alias("__seen"))
            .filter(F.col("__only") & (F.size("__seen") == len(wanted)))
        )
        return alone.select(*self.keys, listed).unionByName(several.select(*self.keys, listed))

    def first_and_rest(self) -> DataFrame:
        """What ``journeys.first_and_rest`` returns, without attributes."""

        def shown(pages: DataFrame) -> DataFrame:
            later = F.filter(_EVENTS, lambda e: e[POSITION] > 1)
            return pages.select(
                *self.keys,
                F.col(f"{_OPENING}.{self.item}").alias("first_item"),
                F.col(f"{_OPENING}.{self.order[0]}").alias(f"first_{self.order[0]}"),
                F.transform(later, lambda e: e[self.item]).alias("later_items"),
                SEGMENT,
            )

        if not self.cut:
            return shown(self.rows)
        parts = self.rows.filter(F.col(CHUNK).isNotNull())
        whole = parts.groupBy(*self.keys, SEGMENT).agg(
            F.first(_OPENING).alias(_OPENING),
            F.sort_array(F.flatten(F.collect_list(_EVENTS))).alias(_EVENTS),
        )
        return shown(self.rows.filter(F.col(CHUNK).isNull())).unionByName(shown(whole))


def pages(
    parts: Split, keys: Sequence[str], order: Sequence[str], item: str, page_items: int
) -> DataFrame:
    """The rows of a History, in one shuffle of the events of ordinary keys and one of hot ones."""
    fields = list(dict.fromkeys([*order, item]))
    event = F.struct(*fields)
    count = {POSITION: F.lit(1).cast("long")}
    ordinary, hot = running(parts, keys, order, count, opening=event, following=event)
    page = F.floor(F.greatest(F.col(POSITION) - 2, F.lit(0)) / page_items).cast("long")

    def listed(frame: DataFrame, *chunk: str) -> DataFrame:
        return (
            frame.withColumn(SEGMENT, page)
            .groupBy(*keys, *chunk, SEGMENT)
            .agg(
                F.first("__opening").alias(_OPENING),
                F.sort_array(F.collect_list(F.struct(POSITION, *fields))).alias(_EVENTS),
                F.max_by("__following", POSITION).alias(_AFTER),
                F.min(POSITION).alias(POSITION),
            )
        )

    found = listed(ordinary).withColumn(CHUNK, F.lit(None).cast("long"))
    return found if hot is None else found.unionByName(listed(hot, CHUNK))


def deal(
    df: DataFrame | Split,
    keys: Sequence[str],
    order: Sequence[str],
    item: str,
    chunk_rows: int | None = CHUNK_ROWS,
    page_items: int = PAGE_ITEMS,
    base: str | None = None,
) -> History:
    """The table's events by key, written to ``base`` (see scratch_dir)."""
    keys, order = list(keys), list(order)
    slim = df.select(*dict.fromkeys([*keys, *order, item]))
    parts = slim if isinstance(slim, Split) else split(slim, keys, order, chunk_rows, base)
    written = staged(pages(parts, keys, order, item, page_items), "history", base)
    return History(written, tuple(keys), tuple(order), item, parts.cut)
