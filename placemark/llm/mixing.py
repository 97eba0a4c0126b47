"""Mixing sources to target weights on a low-discrepancy schedule.

Slot k of the mix takes the point frac(k * golden ratio); the point falls in
one source's share of the cumulative weights, so every stretch of the mix holds
the sources in proportion. Slots are ranked per source. Each source's documents
are shuffled by a hash of their ids and laid end to end, and the r-th slot of a
source is joined with its r-th block; its target, in whole words, is dealt out
evenly among its slots, so that each source gives its target at any number of
slots, and one that draws none has a slot of its own after the others. A source
that must give more than it has starts over. The whole path is DataFrame
expressions.

Sizes are words of the text (null: 0). A source's target is its share by weight,
at most max_repeats times its size, the excess reshared by weight: the level is
found in closed form, as a prefix of the sources ordered by cap over weight.
Orders over all sources are cut into ranges, so that any number of them will do.

Defined results: a null source is a source of its own, ordered last; documents
without words take part with size 0 and are never taken; rows that repeat a
doc_id are separate documents, ordered by their text's hash; rows equal in id,
source and text are laid out as one and share what it gives evenly; a null
doc_id is an id of its own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placemark.llm.common import WHITE, meet, multiplied, stored

GOLDEN = 0.6180339887498949
WEIGHTS = (5, 2, 1)
SLOTS = 1 << 18
GRID = 4096


def by_name() -> Column:
    return F.col("source").asc_nulls_last()


def word_count(text: Column) -> Column:
    """Words of a text: the gaps between white space, without the empty ends."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), f"^[{WHITE}]+|[{WHITE}]+$", "")
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, f"[{WHITE}]+"))).cast("long")


def running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """df and, under each name, the sum of its column over the rows before it in the order, which must be total.

    Rows are dealt to ranges of the order, one a shuffle partition; sums of whole
    ranges go before those inside a range, so that no task sees all rows.
    """
    spread = stored(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "mix-ranges")
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    whole = spread.groupBy("__part").agg(*(F.sum(c).alias("__" + name) for name, c in sums.items()))
    whole = whole.select("__part", *(F.coalesce(F.sum("__" + name).over(before), F.lit(0)).alias("__" + name) for name in sums))
    inside = W.partitionBy("__part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    own = spread.select("*", *(F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(name) for name, c in sums.items()))
    return own.join(F.broadcast(whole), "__part").select(*df.columns, *((F.col(name) + F.col("__" + name)).alias(name) for name in sums))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = 3) -> DataFrame:
    """(source, source_size) -> and weight, cap, target; one row a source."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("position") % len(weights)).cast("int") + 1)
    weighed = (
        running(sizes, [by_name()], {"position": F.lit(1)})
        .withColumns({"weight": weight, "cap": F.col("source_size") * max_repeats})
        .withColumn("fills_at", F.col("cap") / F.col("weight"))
    )
    filled = running(weighed, [F.col("fills_at").asc(), by_name()], {"cap_before": F.col("cap"), "weight_before": F.col("weight")})
    size, weigh = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (F.lit(size) - F.col("cap_before")) / (F.lit(weigh) - F.col("weight_before"))
    # The first source that its share doesn't fill sets the level; those after it, had they set it, would set no higher one.
    final = filled.agg(F.max(F.when(level <= F.col("fills_at"), level))).first()[0]
    share = F.lit(final).cast("double") * F.col("weight")
    return filled.select("source", "source_size", "weight", "cap", F.least(F.col("cap").cast("double"), F.coalesce(share, F.col("cap").cast("double"))).alias("target"))


def document_key() -> Column:
    """What tells documents apart, and shuffles a source's; rows equal in id, text and source share it."""
    source = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("-"))
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), source, F.sha2(F.coalesce("text", F.lit("")), 256)))


def schedule(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = 3,
    slots: int = SLOTS,
    docs_a_bucket: int = 20_000,
) -> tuple[DataFrame, DataFrame]:
    """The mix and the documents it is made of.

    mix: (slot, source, block, round, start, words, doc_id, key): in slot order, words
    from the offset start of the source's laid-out words belong to that document.
    placed: (doc_id, key, source, size, copies, source_size, target, first) a row a
    document; rows that are equal lie behind one another, copies times size words.
    slots is how finely sources alternate: a block holds about total words / slots.
    """
    own = docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), document_key().alias("key"))
    sized = stored(own.groupBy("source", "key", "doc_id").agg(F.min("size").alias("size"), F.count("*").alias("copies")), "mix-sizes")
    total, rows = sized.agg(F.coalesce(F.sum(F.col("size") * F.col("copies")), F.lit(0)), F.count("*")).first()
    block = max(1, -(-total // slots))
    # A source's order is (bucket, key); running sums go bucket by bucket, so
    # that no source, however large, is ordered in one task.
    buckets = max(256, -(-rows // docs_a_bucket))
    sized = sized.withColumn("bucket", (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * buckets / F.lit(1 << 32)).cast("int"))
    by_bucket = sized.groupBy("source", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("bucket_size"))
    goal = targets(by_bucket.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, max_repeats)
    goal = goal.withColumn("gives", F.when(F.col("target") > 0, F.greatest(F.lit(1), F.round("target"))).otherwise(0).cast("long"))
    # Whole words are summed, so that the shares are the same at every run.
    goal = stored(running(goal, [by_name()], {"lower": F.col("gives")}), "mix-goals")
    given = goal.agg(F.coalesce(F.sum("gives"), F.lit(0))).first()[0]
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = by_bucket.withColumn("bucket_first", F.coalesce(F.sum("bucket_size").over(before), F.lit(0))).drop("bucket_size")
    same = lambda a, b, *names: reduce(lambda x, y: x & y, [a[n].eqNullSafe(b[n]) for n in names])
    inside = W.partitionBy("source", "bucket").orderBy("key").rowsBetween(W.unboundedPreceding, -1)
    placed = sized.withColumn("inside", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(inside), F.lit(0)))
    at = offsets.alias("o").join(goal.alias("g"), F.col("o.source").eqNullSafe(F.col("g.source"))).select("o.*", "g.source_size", "g.target")
    placed = (
        placed.join(at, same(placed, at, "source", "bucket"))
        .select(placed.doc_id, placed.key, placed.source, "size", "copies", "source_size", "target", (F.col("bucket_first") + F.col("inside")).alias("first"))
    )
    placed = stored(placed, "mix-placed")
    # The slots: point -> source by its share, rank within the source.
    n_slots = -(-total // block) if total else 0
    portion = lambda words: F.try_divide(words, F.lit(given))
    share = goal.where("gives > 0").select("source", "source_size", "gives", portion(F.col("lower")).alias("lower"), portion(F.col("lower") + F.col("gives")).alias("upper"))
    # Points and shares meet on the cells of a grid over [0, 1) that they touch.
    share = share.withColumn("cell", F.explode(F.expr(f"sequence(least(int(lower * {GRID}), {GRID - 1}), least(int(upper * {GRID}), {GRID - 1}))")))
    point = F.col("slot") * F.lit(GOLDEN)
    drawn = docs.sparkSession.range(n_slots).select(F.col("id").alias("slot")).withColumn("point", point - F.floor(point))
    drawn = drawn.withColumn("cell", (F.col("point") * GRID).cast("int")).join(share, "cell").where("point >= lower and point < upper")
    drawn = drawn.select("slot", "source", "source_size", "gives")
    # Ranks by stretches of slots: sums of whole stretches first, then within each.
    stretch = (F.col("slot") / 4096).cast("long")
    drawn = drawn.withColumn("stretch", stretch)
    counted = stored(drawn.groupBy("source", "stretch").agg(F.count("*").alias("n")), "mix-counted")
    earlier = F.sum("n").over(W.partitionBy("source").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1))
    numbered = counted.select("source", "stretch", F.coalesce(earlier, F.lit(0)).alias("earlier"), F.sum("n").over(W.partitionBy("source")).alias("own"))
    ranked = drawn.withColumn("rank", F.row_number().over(W.partitionBy("source", "stretch").orderBy("slot")) - 1)
    ranked = ranked.join(numbered, same(ranked, numbered, "source", "stretch")).select(
        "slot", ranked.source, (F.col("rank") + F.col("earlier")).alias("block"), "source_size", "gives", "own"
    )
    # A source whose share no point falls into.
    missed = goal.where("gives > 0").alias("g").join(counted.select("source").distinct().alias("c"), F.col("g.source").eqNullSafe(F.col("c.source")), "left_anti")
    missed = running(missed.select("g.source", "source_size", "gives"), [by_name()], {"after": F.lit(1)})
    ranked = ranked.union(missed.select((F.lit(n_slots) + F.col("after")).cast("long").alias("slot"), "source", F.lit(0).cast("long").alias("block"), "source_size", "gives", F.lit(1).cast("long").alias("own")))
    # Block r of n is words [r / n, (r + 1) / n) of what the source gives, laid out over
    # and over; cut where the source ends, so that a piece lies in one round.
    start, end = F.expr("block * gives div own"), F.expr("(block + 1) * gives div own")
    rounds = ranked.withColumns({"start": start, "end": end}).where("end > start").withColumn(
        "round", F.explode(F.expr("sequence(start div source_size, (end - 1) div source_size)"))
    )
    cut = rounds.select(
        "slot", "source", "block", "round",
        (F.greatest("start", F.col("round") * F.col("source_size")) - F.col("round") * F.col("source_size")).alias("start"),
        (F.least("end", (F.col("round") + 1) * F.col("source_size")) - F.col("round") * F.col("source_size")).alias("end"),
    )
    # Documents and pieces meet on the cells of one block's length they touch.
    cells = lambda a, b: F.explode(F.expr(f"sequence({a} div {block}, ({b} - 1) div {block})"))
    pieces = cut.withColumn("cell", cells("start", "end"))
    lying = placed.where("size > 0").select("doc_id", "key", "source", "first", (F.col("first") + F.col("size") * F.col("copies")).alias("last")).withColumn("cell", cells("first", "last"))
    lo, hi = F.greatest("start", "first", F.col("p.cell") * block), F.least("end", "last", (F.col("p.cell") + 1) * block)
    mix = (
        pieces.alias("p").join(lying.alias("d"), F.col("p.source").eqNullSafe(F.col("d.source")) & (F.col("p.cell") == F.col("d.cell")))
        .withColumns({"lo": lo, "words": hi - lo})
        .where("words > 0")
        .select("slot", "p.source", "block", "round", F.col("lo").alias("start"), "words", "doc_id", "key")
    )
    return mix, placed


def mixed(docs: DataFrame, **parameters) -> DataFrame:
    """A row a document: doc_id, key, size, source_size, target, taken (words the mix takes, repeats counted)."""
    mix, placed = schedule(docs, **parameters)
    taken = stored(mix.groupBy("key").agg(F.sum("words").alias("taken")), "mix-taken")
    # The words that equal rows give are dealt out evenly among them: some have one more.
    given = placed.join(taken, "key", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
    shares = given.select("doc_id", "key", "size", "source_size", "target", F.expr("taken div copies").alias("taken"), (F.col("taken") % F.col("copies")).alias("more"), "copies")
    part = F.explode(F.array(F.struct(F.col("taken"), (F.col("copies") - F.col("more")).alias("rows")), F.struct((F.col("taken") + 1).alias("taken"), F.col("more").alias("rows"))))
    shares = shares.select("doc_id", "key", "size", "source_size", "target", part.alias("part"))
    shares = shares.select("doc_id", "key", "size", "source_size", "target", "part.taken", "part.rows")
    return multiplied(shares, F.col("rows")).drop("rows")


def copy_numbers(rows: DataFrame) -> DataFrame:
    """rows with __number, from 0 among those of one __key, counted by parts of the table."""
    parts = stored(rows.withColumn("__part", F.spark_partition_id()), "mix-copies")
    before = W.partitionBy("__key").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    counts = parts.groupBy("__key", "__part").agg(F.count("*").alias("__n"))
    counts = counts.select("__key", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__earlier"))
    inside = F.row_number().over(W.partitionBy("__key", "__part").orderBy("__key")) - 1
    return parts.withColumn("__inside", inside).join(counts, ["__key", "__part"]).withColumn("__number", F.col("__inside") + F.col("__earlier")).drop("__part", "__inside", "__earlier")


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The documents as the mix takes them, whole: one row for each time that at
    least half of a document's words are taken. A document is cut by the mix only
    where its source's last round ends, so this rounds one document a source."""
    mix, placed = schedule(docs, **parameters)
    rounds = mix.groupBy(F.col("key").alias("__key"), "round").agg(F.sum("words").alias("__words"))
    rounds = stored(rounds.select("__key", "__words"), "mix-rounds")
    keyed = docs.withColumns({"__key": document_key(), "__size": word_count(F.col("text"))})
    again = placed.where("copies > 1").select(F.col("key").alias("__key"), F.col("copies").alias("n"))
    if again.isEmpty():
        return keyed.join(rounds, "__key").where(F.col("__words") * 2 >= F.col("__size")).select(*docs.columns)
    single = keyed.join(again.select("__key"), "__key", "left_anti").withColumn("__number", F.lit(0).cast("long"))
    copies = copy_numbers(meet(keyed, again, ["__key"]).drop("n"))
    # Of equal rows a round takes the first ones: they lie behind one another.
    half = (F.col("__words") - F.col("__number") * F.col("__size")) * 2 >= F.col("__size")
    each = rounds.groupBy("__key").agg(F.collect_list("__words").alias("__rounds"), F.lit(1).alias("n"))
    taken = meet(copies, stored(each.join(again.drop("n"), "__key"), "mix-again"), ["__key"]).drop("n").withColumn("__words", F.explode("__rounds")).drop("__rounds")
    single = single.join(rounds, "__key")
    return single.unionByName(taken.select(*single.columns)).where(half).select(*docs.columns)
