"""Source divergence audit: how far each source of a language lies from its peers, by systolic rotation.

Terms are runs of letters; a language keeps those in `least` of its documents. Each
(language, source) group is a vector of counts over the kept terms. A language's terms
are dealt to cells by hash, its groups to seats; a cell of a seat's groups is one row of
compressed vectors. The rows stay where they are, partitioned by cell and seat, while
copies travel: in each round of a round-robin tournament every seat meets one other, and
one of the two travels to the home of the other. A meeting gives both directions of all
its pairs. Groups of one seat meet at home, where heaps also rank each group's terms
against the language. Values are whole numbers and add up over the cells.

Sizes: a cell's row holds at most about CELL counts, whatever the table, as the terms a
cell gets shrink where seats hold more groups; at most SEATS rounds are made. Work is that
of all pairs of a language's sources, which is what the audit returns.

Defined results: null text, lang and source are empty strings; groups without kept terms
take part with a count of 0 for each; a language without kept terms gives its pairs the
value 0; rows that repeat a doc_id are documents of their own; ties go by UTF-8 order;
an empty table gives an empty result; extra columns are ignored. Exact while a language
has fewer than 9 * 10^15 words.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from placemark.llm.common import meet, stored

LEAST, TOP, SCALE = 10, 10, 1_000_000_000
#: Groups of a seat at least, seats at most, counts in a cell of a seat.
A_SEAT, SEATS, CELL = 4, 32, 1 << 18
#: A task holds so many counts before it passes them on.
HELD = 400_000
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and of code points beyond ASCII, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).split() if text else []


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, text -> occurrences and documents of each term in a part of the table."""
    held: dict[tuple, tuple[Counter, Counter]] = {}
    size = 0

    def given() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, df) in held.items():
            terms = list(n)
            for at in range(0, len(terms), 50_000):
                part = terms[at : at + 50_000]
                same = lambda v, k=len(part): pa.array([v] * k, pa.string())
                columns = [same(lang), same(source), pa.array(part, pa.binary()).cast(pa.string()), pa.array([n[t] for t in part], pa.int64()), pa.array([df[t] for t in part], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "df"])
        held.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            terms = terms_of(text)
            n, df = held.setdefault((lang, source), (Counter(), Counter()))
            before = len(n)
            n.update(terms)
            df.update(set(terms))
            size += len(n) - before
            if size > HELD:
                yield from given()
                size = 0
    yield from given()


def packed(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending ids and their counts, compressed."""
    return zlib.compress(np.diff(ids, prepend=0).astype("<i4").tobytes() + counts.astype("<i8").tobytes(), 1)


def unpacked(raw: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    data = zlib.decompress(raw) if raw else b""
    n = len(data) // 12
    return np.cumsum(np.frombuffer(data, "<i4", n), dtype=np.int64), np.frombuffer(data, "<i8", n, 4 * n)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for held in batch.column(3):
            inner = held.values
            out.append(packed(inner.field(0).to_numpy().astype(np.int64), inner.field(1).to_numpy().astype(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(out, pa.binary())], names=["lang", "cell", "source", "vector"])


def probability(counts: np.ndarray, words: int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (words + 2 * terms)), in steps that stay within 64 bits."""
    of = words + 2 * terms
    whole, rest = np.divmod(counts.astype(np.int64) + 2, of)
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, of)
        whole = whole * 1000 + step
    return whole + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Group:
    """One group's vector in a cell of `size` terms."""

    def __init__(self, member: dict, terms: int, size: int):
        self.number, self.size = member["number"], size
        self.ids, counts = unpacked(member["vector"])
        self.p = probability(counts, member["words"], terms)
        self.counts = counts
        self.none = int(probability(np.zeros(1, np.int64), member["words"], terms)[0])
        self.dense = np.full(size, self.none, np.int64)
        self.dense[self.ids] = self.p
        self.has = np.zeros(size, bool)
        self.has[self.ids] = True

    def against(self, peer: Group) -> int:
        """The sum over all terms of the cell: the peer's, then those that only this group has, then the rest."""
        alone = ~peer.has[self.ids]
        total = int(apart(self.dense[peer.ids], peer.p).sum()) + int(apart(self.p[alone], np.int64(peer.none)).sum())
        return total + (self.size - len(peer.ids) - int(alone.sum())) * ((self.none - peer.none) ** 2 // (self.none + peer.none))


_FOUND = "lang string, cell int, a int, b int, id int, value long"


def _found(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
    kinds = [pa.string(), *[pa.int32()] * 4, pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "cell", "a", "b", "id", "value"])


def _seated(members: list[dict], terms: int, size: int) -> list[Group]:
    return [Group(m, terms, size) for m in members] if size else []


def _at_home(top: int):
    """lang, cell, terms, size, words of the lang, members, totals -> pairs of one seat; each group's best terms of the cell (b null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, cell, terms, size, words, members, totals in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                own = _seated(members, terms, size)
                out = [(lang, cell, g.number, h.number, None, g.against(h)) for i, g in enumerate(own) for h in own[i + 1 :]]
                q = probability(np.array(totals or [], np.int64), words, terms) if size else None
                for g in own:
                    above = np.flatnonzero((g.counts > 0) & (g.p > q[g.ids]))
                    value = apart(g.p[above], q[g.ids[above]])
                    best = heapq.nsmallest(top, zip((-value).tolist(), g.ids[above].tolist(), strict=True))
                    out += [(lang, cell, g.number, None, i, -v) for v, i in best]
                yield _found(out)

    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, cell, terms, size, members, visitors -> a value for each pair of one resident and one visitor."""
    for batch in batches:
        for lang, cell, terms, size, members, visitors in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
            own, guests = _seated(members, terms, size), _seated(visitors, terms, size)
            yield _found([(lang, cell, g.number, h.number, None, g.against(h)) for g in own for h in guests])


def partner(seat: Column, seats: Column, turn: int) -> Column:
    """Who a seat meets in a turn of 0 to seats - 2; seats is even, the last one stays and the others go round it."""
    ring = seats - 1
    other = F.pmod(F.lit(2 * turn) - seat, ring)
    return F.when(seat == ring, F.pmod(F.lit(turn), ring)).when(other == seat, ring).otherwise(other)


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP, a_seat: int = A_SEAT, max_seats: int = SEATS, cell: int = CELL) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part 'pair': every other source of the lang and how far it is; part 'term': the
    top terms that the source has more often than the lang.
    """
    spark = docs.sparkSession
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    own = docs.select(text("lang"), text("source"), text("text"))
    counts = own.mapInArrow(_counted, "lang string, source string, term string, n long, df long")
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("df").alias("df"), F.collect_list(F.struct("source", "n")).alias("holders"))
    terms = stored(terms.where(F.col("df") >= least).drop("df"), "audit-terms")
    words = terms.select("lang", F.explode("holders").alias("h")).groupBy("lang", F.col("h.source").alias("source")).agg(F.sum("h.n").alias("words"))
    number = F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1
    groups = own.select("lang", "source").distinct().join(words, ["lang", "source"], "left")
    groups = stored(groups.select("lang", "source", F.coalesce("words", F.lit(0)).alias("words"), number.alias("number")), "audit-groups")
    langs = groups.groupBy("lang").agg(F.count("*").alias("n"), F.sum("words").alias("lang_words"))
    langs = langs.join(terms.groupBy("lang").agg(F.count("*").alias("terms")), "lang", "left").withColumn("terms", F.coalesce("terms", F.lit(0)))
    langs = langs.withColumn("a_seat", F.greatest(F.lit(a_seat), F.ceil(F.col("n") / max_seats)).cast("int"))
    langs = langs.withColumn("seats", F.ceil(F.col("n") / F.col("a_seat")).cast("int"))
    langs = stored(langs.withColumn("cells", F.greatest(F.lit(1), F.ceil(F.col("terms") * F.col("a_seat") / cell)).cast("int")), "audit-langs")

    by_cell = meet(terms, langs.where("terms > 0").select("lang", "cells", F.col("terms").alias("n")), ["lang"]).withColumn("cell", F.pmod(F.xxhash64("term"), "cells").cast("int"))
    place = (F.row_number().over(W.partitionBy("lang", "cell").orderBy("term")) - 1).alias("id")
    placed = stored(by_cell.select("lang", "cell", place, "term", "total", "holders"), "audit-placed")
    totals = placed.groupBy("lang", "cell").agg(F.sort_array(F.collect_list(F.struct("id", "total")))["total"].alias("totals"))
    held = placed.select("lang", "cell", "id", F.explode("holders").alias("h")).groupBy("lang", "cell", F.col("h.source").alias("source"))
    vectors = held.agg(F.sort_array(F.collect_list(F.struct("id", "h.n"))).alias("counts")).mapInArrow(_packed, "lang string, cell int, source string, vector binary")
    grid = meet(groups, langs, ["lang"]).withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    grid = grid.join(vectors, ["lang", "cell", "source"], "left").withColumn("seat", F.expr("number div a_seat").cast("int"))
    one = lambda name: F.first(name).alias(name)
    seats = grid.groupBy("lang", "cell", "seat").agg(one("seats"), one("terms"), one("lang_words"), F.sort_array(F.collect_list(F.struct("number", "words", "vector"))).alias("members"))
    seats = stored(seats.join(totals.select("lang", "cell", F.size("totals").alias("size")), ["lang", "cell"], "left").withColumn("size", F.coalesce("size", F.lit(0))), "audit-seats")

    home = seats.join(totals, ["lang", "cell"], "left").select("lang", "cell", "terms", "size", "lang_words", "members", "totals").mapInArrow(_at_home(top), _FOUND)
    found = [stored(home, "audit-home")]
    turns = (langs.agg(F.max("seats")).first()[0] or 0) + 1
    even = F.col("seats") + F.col("seats") % 2
    here = ["lang", "cell", "seat"]
    # Residents are dealt out once; each turn shuffles the travellers alone.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    residents = seats.select(*here, "members").repartition(parts, *here).persist(StorageLevel.DISK_ONLY)
    for turn in range(turns // 2 * 2 - 1):
        meets = seats.where(even - 1 > turn).withColumn("host", partner(F.col("seat"), even, turn)).where(F.col("host") < F.col("seats"))
        # Of two that meet, the lower goes in even turns and the higher in odd ones.
        goes = meets.where((F.col("seat") < F.col("host")) == F.lit(turn % 2 == 0))
        visit = goes.select("lang", "cell", F.col("host").cast("int").alias("seat"), "terms", "size", F.col("members").alias("visitors"))
        met = residents.hint("merge").join(visit, here).select("lang", "cell", "terms", "size", "members", "visitors").mapInArrow(_met, _FOUND)
        found.append(stored(met.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "audit-turn"))
    residents.unpersist()

    sums = found[0].where("b is not null").select("lang", "a", "b", "value")
    for part in found[1:]:
        sums = sums.union(part)
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    # A language without kept terms has no vectors to meet: its pairs have the value 0.
    bare = groups.join(langs.where("terms = 0").select("lang"), "lang", "left_semi").alias("x")
    bare = bare.join(bare.alias("y"), F.expr("x.lang = y.lang and x.number < y.number")).select("x.lang", F.col("x.number").alias("a"), F.col("y.number").alias("b"), F.lit(0).cast("long").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    pairs = sums.union(bare).select("lang", both.alias("d"), "value").select("lang", "d.*", "value")
    named = lambda of, to: groups.select("lang", F.col("number").alias(of), F.col("source").alias(to))
    pairs = pairs.join(named("a", "source"), ["lang", "a"]).join(named("b", "item"), ["lang", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    best = found[0].where("b is null").join(placed.select("lang", "cell", "id", F.col("term").alias("item")), ["lang", "cell", "id"])
    best = best.join(named("a", "source"), ["lang", "a"]).select("lang", "source", F.lit("term").alias("part"), "item", "value")
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).union(best.withColumn("rank", rank).where(F.col("rank") <= top))
