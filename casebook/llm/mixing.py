"""Mixing sources to target weights by pivotal dependent rounding.

A source's target is a share of all words, and each of its documents should be taken
target / source size times, say 1.4: once for sure, and once more with probability 0.4.
The fractional parts are rounded in pairs: of two open documents one gains the words the
other loses, in the one or the other direction by a drawn number, until one of them is at
0 or 1. So each document keeps its probability, and each source its number of words, to
within the one document still open at the end, which is drawn alone. A large document is
paired with all smaller ones of its group together where they can take up its words, so
that one is a small one.

How the work is spread: documents alike in id, source and size are one unit with a
count. A source's units are dealt by hash into groups of about ``GROUP_UNITS``; each group
is rounded in one task, in falling order of size, and leaves at most one unit open. The
open ones are grouped again, until each source has one group: a reduction tree whose
depth is the logarithm of the source's units. Draws are hashes of the units, so reruns and
recomputed tasks agree.

Targets: the sources in order of code points, null last, weigh 1, 2, 3, 1, ... and share
all words; none is above ``MOST`` times its size, what is above is shared again by weight.
This too is a table of Spark, one row a source; a round of sharing is one aggregate.

Defined results: null texts have no words; documents without words are never open and
take the copies all of their source have; repeated rows and rows without an id are each a
document; an empty table gives no rows. Other columns, whatever their names, are left
behind (:func:`mixture` gives the documents themselves, with all columns, as often as they are
taken).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import stage
from casebook.operators.ranges import number_rows

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
GROUP_UNITS = 4096
ALIKE_ROWS = 10_000  # rows alike that one row is unfolded into at a time
SEED = 12
SPARE = 2.0  # what smaller units must be able to take up, of what they may have to, to put a large one off


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, units, number, target`` from rows ``source, size, n``:
    each source's share of all words, and its place in the order of sources (from 0)."""
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count(F.lit(1)).alias("units"))
    numbered = number_rows(per, [F.col("source").isNull(), F.col("source")], "number", start=0)
    weigh = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    per = stage(numbered.withColumn("weight", weigh.cast("long")), "mixing-sources")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    # a weight of one is worth words / weight; those it brings above their limit leave the sharing
    words, weight, capped = total, None, -1
    while True:
        over = F.lit(False) if weight is None else _exact(F.lit(words) * F.col("weight")) > _exact(F.lit(most) * F.col("source_size") * F.lit(weight))
        row = per.agg(F.count(F.when(over, 1)).alias("n"), F.coalesce(F.sum(F.when(over, F.col("source_size"))), F.lit(0)).alias("size"),
                      F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("weight")).first()
        if row["n"] == capped:
            break
        words, weight, capped = total - most * row["size"], row["weight"], row["n"]
    share = F.lit(float(words)) * F.col("weight") / F.lit(float(max(weight, 1)))
    return per.withColumn("target", F.when(over, (F.lit(most) * F.col("source_size")).cast("double")).otherwise(share)).drop("weight")


def _exact(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def _uniform(key: int, level: int) -> float:
    """A number in [0, 1) from a unit's hash (public splitmix64 constants)."""
    mask = (1 << 64) - 1
    x = (key + (level + 1) * 0x9E3779B97F4A7C15) & mask
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
    return ((x ^ (x >> 31)) >> 11) / (1 << 53)


def round_group(sizes: list[int], chances: list[float], keys: list[int], level: int) -> list[float]:
    """Pivotal rounding of one group in falling order of size: all become 0.0 or 1.0 but
    for at most one. The sum of size x chance stays as it is, and so does each chance's mean.

    A unit is paired with the next smaller one, or, as long as that can take up all it may
    gain or lose, with all smaller ones together, whose chances then shift alike. The
    latter is put off to where it is last possible; it keeps a large unit from staying open.
    """
    out = list(chances)
    todo = [i for i, c in enumerate(out) if 0.0 < c < 1.0]
    words, least, most = [0.0], [1.0], [0.0]  # of the units from each place of todo on
    for i in reversed(todo):
        words.append(words[-1] + sizes[i])
        least.append(min(least[-1], out[i]))
        most.append(max(most[-1], out[i]))
    words.reverse(), least.reverse(), most.reverse()
    held, shift = -1, 0.0  # shift: of all chances not yet paired

    def takes_up(at: int, spare: float = 1.0) -> bool:
        gain, lose = spare * (1.0 - out[held]) * sizes[held], spare * out[held] * sizes[held]
        return least[at] + shift > 1e-9 + gain / max(words[at], 1) and most[at] + shift + lose / max(words[at], 1) < 1.0 - 1e-9

    for at, i in enumerate(todo):
        if held >= 0 and takes_up(at) and not takes_up(at + 1, SPARE):
            up = _uniform(keys[held], level) < out[held]
            shift += (out[held] - up) * sizes[held] / words[at]
            out[held], held = float(up), -1
        out[i] = _snap(out[i] + shift)
        if held < 0 or not 0.0 < out[i] < 1.0:
            held = i if held < 0 and 0.0 < out[i] < 1.0 else held
            continue
        a, b, ratio = out[held], out[i], sizes[i] / sizes[held]
        up = min(1.0 - a, b * ratio)  # held gains this, i loses it
        down = min(a, (1.0 - b) * ratio)
        if _uniform(keys[held] ^ keys[i], level) * (up + down) < down:
            one, other = (1.0, b - (1.0 - a) / ratio) if 1.0 - a <= b * ratio else (a + b * ratio, 0.0)
        else:
            one, other = (0.0, b + a / ratio) if a <= (1.0 - b) * ratio else (a - (1.0 - b) * ratio, 1.0)
        out[held], out[i] = _snap(one), _snap(other)
        if 0.0 < out[i] < 1.0:
            held = i
        elif not 0.0 < out[held] < 1.0:
            held = -1
    return out


def _snap(chance: float) -> float:
    """Rounding errors of a finished chance taken off."""
    return 0.0 if chance < 1e-12 else 1.0 if chance > 1.0 - 1e-12 else chance


def _round_level(units: DataFrame, level: int) -> DataFrame:
    """One level of the tree: units with ``chance`` 0 are settled, the others still open."""
    columns = units.columns

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("size", "descending"), ("key", "ascending"), ("doc_id", "ascending")])
        names = ("size", "chance", "key", "extra")
        sizes, chances, keys, extra = (rows.column(c).to_pylist() for c in names)
        done = round_group(sizes, chances, keys, level)
        if rows.num_rows and rows.column("groups")[0].as_py() == 1:  # the source's last group: what is open is drawn alone
            done = [c if c in (0.0, 1.0) else float(_uniform(k, level + 64) < c) for c, k in zip(done, keys, strict=True)]
        extra = [e + (c == 1.0) for e, c in zip(extra, done, strict=True)]
        done = [0.0 if c == 1.0 else c for c in done]
        rows = rows.select(columns)
        rows = rows.set_column(rows.schema.get_field_index("chance"), "chance", pa.array(done, pa.float64()))
        return rows.set_column(rows.schema.get_field_index("extra"), "extra", pa.array(extra, pa.int64()))

    group = F.pmod(F.xxhash64("key", F.lit(level)), F.col("groups"))
    return units.withColumn("group", group).groupBy("number", "group").applyInArrow(run, units.schema)


def choose(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED,
           most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The decisions, one row for each group of rows alike: doc_id, source, size, n (the
    rows), source_size, target, sure (copies each row has), extra (rows with one more)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"), n_words(F.col(f"`{text_col}`")).alias("size"))
    units = stage(rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mixing-units")
    shares = stage(targets(units, most, weights), "mixing-targets")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shares = shares.withColumn("sure", F.floor(each + 1e-12)).withColumn("part", F.greatest(each - F.col("sure"), F.lit(0.0)))
    joined = units.join(shares, units["source"].eqNullSafe(shares["source"])).drop(shares["source"])
    wanted = F.when(F.col("size") > 0, F.col("n") * F.col("part")).otherwise(0.0)
    whole = F.floor(wanted + 1e-12)
    left = F.when(wanted - whole > 1e-12, wanted - whole).otherwise(0.0)
    key = F.xxhash64(F.lit(seed), "number", "doc_id", "size")
    joined = stage(joined.withColumn("key", key).withColumn("extra", whole.cast("long")).withColumn("chance", left), "mixing-open")

    start = joined.select("number", "doc_id", "size", "n", "key", F.ceil(F.col("units") / GROUP_UNITS).alias("groups"), "chance", "extra")
    settled, still = start.where(F.col("chance") == 0), start.where(F.col("chance") > 0)
    level, groups = 0, shares.agg(F.max("units")).first()[0] or 0
    while groups:
        done = stage(_round_level(still, level), f"mixing-level{level}")
        settled = settled.unionByName(done.where(F.col("chance") == 0))
        groups = -(-groups // GROUP_UNITS)
        if groups == 1:
            break
        level, still = level + 1, done.where(F.col("chance") > 0).withColumn("groups", F.ceil(F.col("groups") / GROUP_UNITS))
    return settled.join(shares, "number").select("doc_id", "source", "size", "n", "source_size", "target", "sure", "extra")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """One row for each document: doc_id, source, size, source_size, target (its
    source's), nth (from 0 among rows alike), copies, taken (its words in the mix,
    repeats counted)."""
    chosen = choose(docs, id_col, text_col, source_col, **how)
    # rows alike are unfolded in two steps, so that very many of them are several tasks' work
    blocks = chosen.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {ALIKE_ROWS}"))))
    blocks = blocks.repartition("doc_id", "source", "size", "block")
    first = F.col("block") * ALIKE_ROWS
    rows = blocks.withColumn("nth", F.explode(F.sequence(first, F.least(first + ALIKE_ROWS, F.col("n")) - 1)))
    copies = F.col("sure") + (F.col("nth") < F.col("extra")).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", "nth", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: each row of ``docs`` with all its columns, as often as it is taken."""
    mixed = mix(docs, id_col, text_col, source_col, **how)
    key = F.struct(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"), n_words(F.col(f"`{text_col}`")).alias("size"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    rows = number_rows(rows, ["key", F.xxhash64("row"), F.monotonically_increasing_id()], "at")
    firsts = rows.groupBy("key").agg(F.min("at").alias("first"))  # a row's place among rows alike
    taken = mixed.where(F.col("copies") > 0).select(F.struct("doc_id", "source", "size").alias("key"), "nth", "copies").join(firsts, "key").select((F.col("first") + F.col("nth")).alias("at"), "copies")
    return rows.join(taken, "at").select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")
