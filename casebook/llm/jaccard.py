"""N-gram Jaccard join: size-aware heavy-light, and the components of its links.

A document's set are its distinct word n-grams. Documents with the same set are one
class; only classes are joined. Candidate lists come in two kinds:

* light: for sets of at most ``boundary`` n-grams, every subset of the fixed size that
  two linked sets must share (ceil(t * threshold) of the larger's t) is a list;
* heavy: larger sets scan inverted lists of the n-grams, rarest first, and only of the
  few that a linked pair can't avoid.

The boundary is the largest size at which enumerating subsets costs no more than
scanning lists does. Rarity is a count over the whole corpus, in a table of hash cells
that grows with the bytes of text up to ``MAX_CELLS`` (a byte each where it is broadcast);
it steers which n-grams are scanned, never which pairs are found.

A list that thousands of near copies share would give all their pairs. Instead its
members are first held against a few pivots, of which the first have the fewest n-grams
of their own; members that a verified link already connects need no further pair, and at
the end every pair of a list between different components that its bounds allow is
verified, which leaves no link out that could join two components. No
list, set or component is ever gathered in one task or on the driver.

Defined results: null and empty texts, and texts without words, have an empty set and
are linked with nothing; with fewer words than n the whole sequence is the one n-gram;
repeated rows fall into one class; a null id never becomes a component's id unless the
whole component has no other.
"""

from __future__ import annotations

import zlib
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.common import blocks, column, id_text, mix, spread, stage, tidy, word_lists

BLOCK_BYTES = 4 << 20
CELL_BYTES = 64  # of text for each cell of the rarity table
CELL_PARTS = 256
MIN_CELLS, MAX_CELLS = 1 << 20, 1 << 25
SMALL = 24  # sets up to this size keep all their n-grams for subset enumeration
PIVOTS = 4  # per list and round
ROUNDS = 2  # of pivots, before all pairs left are verified


def ceil_share(n, percent: int):
    return -(-percent * n // 100)


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(end of each text's set, 64-bit hashes of its distinct n-grams, ascending)."""
    ends, codes, words = word_lists(pc.ascii_lower(pc.fill_null(texts, "")))
    if not len(codes):
        return np.zeros(len(texts), np.int64), np.zeros(0, np.uint64)
    h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))[codes]
    starts = np.concatenate([[0], ends[:-1]])
    n_words = ends - starts
    n_grams = np.where(n_words >= n, n_words - n + 1, np.minimum(n_words, 1))
    doc = np.repeat(np.arange(len(ends)), n_grams)
    at = spread(n_grams, starts)
    last = np.minimum(n, n_words)[doc]  # a short text's one n-gram has fewer words
    grams = np.zeros(len(at), np.uint64)
    for j in range(n):
        with np.errstate(over="ignore"):
            grams = np.where(j < last, mix(grams * np.uint64(3) + h[np.minimum(at + j, len(h) - 1)]), grams)
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    return np.cumsum(np.bincount(doc[new], minlength=len(ends))), grams[new]


def cells_for(n_bytes: int) -> int:
    """Cells of the rarity table for a corpus of so many bytes, in whole parts."""
    wanted = min(max(n_bytes // CELL_BYTES, MIN_CELLS), MAX_CELLS)
    return -(-wanted // CELL_PARTS) * CELL_PARTS


def _cell(grams: np.ndarray, cells: int) -> np.ndarray:
    return (((grams >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)).astype(np.int64)


def graded(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes in the same order: exact to 127, then eighths of a doubling."""
    high = 128 + np.minimum(8 * (np.log2(np.maximum(counts, 128)) - 7), 127)
    return np.where(counts < 128, counts, high).astype(np.uint8)


def rarity(docs: DataFrame, n: int) -> np.ndarray:
    """How many documents' n-grams fall into each cell, over all documents, graded."""
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = cells_for(n_bytes)
    width = cells // CELL_PARTS

    packed = lambda x, kind: zlib.compress(x.astype(kind).tobytes(), 1)
    unpacked = lambda b, kind: np.frombuffer(zlib.decompress(b), kind)

    def count(batches):
        total = np.zeros(cells, np.uint32)
        for table in blocks(batches, "text", BLOCK_BYTES):
            _, grams = shingle_sets(column(table, "text"), n)
            np.add.at(total, _cell(grams, cells), 1)
        for part, x in enumerate(total.reshape(CELL_PARTS, width)):
            if x.any():
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([packed(x, "<u4")], pa.binary())], ["part", "counts"])

    def adder(finish, kind):
        def add(key, table):
            total = np.zeros(width, np.int64)
            for x in column(table, "counts"):
                total += unpacked(x.as_py(), "<u4")
            return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([packed(finish(total), kind)], pa.binary())})
        return add

    counted = docs.select("text").mapInArrow(tidy(count), "part int, counts binary")
    # Two levels: 64 tasks' parts are added first, so that few meet in the second.
    lane = F.floor(F.spark_partition_id() / 64)
    capped = lambda x: np.minimum(x, (1 << 32) - 1)
    first = counted.withColumn("lane", lane).groupBy("part", "lane").applyInArrow(adder(capped, "<u4"), "part int, counts binary")
    parts = first.groupBy("part").applyInArrow(adder(graded, "u1"), "part int, counts binary").collect()  # at most MAX_CELLS bytes
    table = np.zeros((CELL_PARTS, width), np.uint8)
    for r in parts:
        table[r["part"]] = unpacked(r["counts"], "u1")
    return table.ravel()


def set_key(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def signatures(docs: DataFrame, n: int, percent: int, cells: np.ndarray) -> DataFrame:
    """``doc_id, t, key, size, tokens``: the set's digest, its size and the n-grams whose
    lists it must scan, rarest first (all of them for small sets)."""
    shared = docs.sparkSession.sparkContext.broadcast(cells)  # at most MAX_CELLS bytes

    def run(batches):
        for table in blocks(batches, "text", BLOCK_BYTES):
            ends, grams = shingle_sets(column(table, "text"), n)
            # The count leads and the hash follows: one order of all n-grams everywhere.
            ranked = (shared.value[_cell(grams, len(shared.value))].astype(np.uint64) << np.uint64(55)) | (grams >> np.uint64(9))
            keys, sizes, tokens, a = [], [], [], 0
            for e in ends:
                own = grams[a:e]
                size = len(own)
                keep = size if size <= SMALL else size - int(ceil_share(size, percent)) + 1
                keys.append(set_key(own) if size else None)
                sizes.append(size)
                tokens.append(np.sort(ranked[a:e])[:keep].astype(np.int64).tobytes())
                a = e
            yield pa.RecordBatch.from_arrays([column(table, "doc_id"), column(table, "t"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(tokens, pa.binary())],
                                             ["doc_id", "t", "key", "size", "tokens"])

    return docs.withColumn("t", F.xxhash64("text")).mapInArrow(run, "doc_id long, t long, key binary, size long, tokens binary")


def choose_boundary(mean_list: float, percent: int) -> int:
    """The largest size up to which enumerating subsets costs no more than scanning the
    lists of the n-grams that a set must scan, at the mean length of a list met."""
    boundary = 0
    for size in range(1, SMALL + 1):
        # At its own size a set has the most subsets to enumerate.
        if comb(size, ceil_share(size, percent)) > (size - ceil_share(size, percent) + 1) * max(mean_list, 1.0):
            break
        boundary = size
    return boundary


LISTS = "token long, cid long, size long, place long"


def heavy_lists(classes: DataFrame, percent: int) -> DataFrame:
    """(n-gram, class, size, place in its order) for the n-grams to be scanned."""

    def run(batches):
        for batch in batches:
            size = np.asarray(batch.column("size"))
            tokens = [np.frombuffer(t, np.int64)[:s - ceil_share(s, percent) + 1] for t, s in zip(batch.column("tokens").to_pylist(), size.tolist())]
            n = np.fromiter(map(len, tokens), np.int64, len(tokens))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens) if len(tokens) else np.zeros(0, np.int64)), pa.array(np.repeat(np.asarray(batch.column("cid")), n)),
                                              pa.array(np.repeat(size, n)), pa.array(spread(n, np.zeros(len(n), np.int64)))], ["token", "cid", "size", "place"])

    return classes.select("cid", "size", "tokens").mapInArrow(tidy(run), LISTS)


def light_lists(classes: DataFrame, boundary: int, percent: int) -> DataFrame:
    """(subset, class, size, -1): subsets of the size that a linked pair whose larger set
    has t n-grams must share, for each t up to the boundary that the set can meet."""

    def run(batches):
        for batch in batches:
            out = []
            for cid, size, tokens in zip(*(batch.column(c).to_pylist() for c in ("cid", "size", "tokens"))):
                grams = np.frombuffer(tokens, np.int64).tolist()
                for t in range(size, boundary + 1):
                    c = ceil_share(t, percent)
                    if size < c:
                        break
                    for subset in combinations(grams, c):
                        out.append((xxhash.xxh3_64_intdigest(np.array([t, *subset], np.int64).tobytes()) - (1 << 63), cid, size, -1))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["token", "cid", "size", "place"])

    return classes.where(F.col("size") <= boundary).select("cid", "size", "tokens").mapInArrow(tidy(run), LISTS)


def shared_lists(lists: DataFrame, percent: int) -> DataFrame:
    """Only the members of a list that another is near enough in size: the next smaller or
    larger, as it is the nearest. A list of one member has none."""
    by_size = Window.partitionBy("token").orderBy("size", "cid")
    near = (F.lag("size").over(by_size) * 100 >= F.col("size") * percent) | (F.col("size") * 100 >= F.lead("size").over(by_size) * percent)
    return lists.withColumn("near_", near).where("near_").drop("near_")


def with_live(lists: DataFrame, percent: int) -> DataFrame:
    """``live``: how many of the n-grams that a set must scan are, from this one on, found
    in another set's list. ``lone``: how many of its whole scan are found in none."""
    from_here = F.row_number().over(Window.partitionBy("cid").orderBy(F.desc("place"), F.desc("token")))
    counted = lists.withColumn("live", from_here.cast("long"))
    scanned = F.col("size") - F.floor((F.col("size") * percent + 99) / 100) + 1
    return counted.withColumn("lone", scanned - F.count(F.lit(1)).over(Window.partitionBy("cid")))


def compatible(a: str, b: str, percent: int, boundary: int) -> Column:
    """Whether two members of a list can be linked: sizes, and for n-grams what can still
    be shared from their first common one on; one of them above the boundary.

    What both scan from here on is live in both; of the set whose scan ends at the more
    common n-gram, what comes after its scan may be shared too, and nothing else."""
    sa, sb, pa_, pb, la, lb = (F.col(f"{x}.{y}") for y in ("size", "place", "live") for x in (a, b))
    sizes = F.least(sa, sb) * 100 >= F.greatest(sa, sb) * percent
    unscanned = F.floor((F.greatest(sa, sb) * percent + 99) / 100) - 1
    most = F.least(sa - pa_, sb - pb, F.least(la, lb) + unscanned)
    heavy = (F.greatest(sa, sb) > boundary) & (most * (100 + percent) >= (sa + sb) * percent)
    return sizes & F.when(pa_ < 0, F.lit(True)).otherwise(heavy)


def _pairs(left: DataFrame, right: DataFrame, percent: int, boundary: int) -> DataFrame:
    a, b = left.alias("a"), right.alias("b")
    on = (F.col("a.token") == F.col("b.token")) & (F.col("a.comp") != F.col("b.comp")) & compatible("a", "b", percent, boundary)
    return a.join(b, on).select(F.least("a.cid", "b.cid").alias("a"), F.greatest("a.cid", "b.cid").alias("b")).distinct()


def pivot_pairs(lists: DataFrame, percent: int, boundary: int, salt: int) -> DataFrame:
    """Members against a few of their list: first those with the fewest n-grams of their
    own, as the origin of many near copies has, then by a hash (another in each round)."""
    by_hash = F.xxhash64("cid", F.lit(salt))
    rank = F.row_number().over(Window.partitionBy("token").orderBy(*(["lone", by_hash] if salt == 0 else [by_hash])))
    pivots = lists.withColumn("rank_", rank).where(F.col("rank_") <= PIVOTS).drop("rank_")
    return _pairs(pivots, lists, percent, boundary)


def crossing_pairs(lists: DataFrame, percent: int, boundary: int) -> DataFrame:
    """All pairs of a list between different components. One side leaves out the list's
    largest component, so a list of one component and a few others costs their product."""
    sizes = lists.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("n_"))
    largest = sizes.groupBy("token").agg(F.max(F.struct("n_", "comp")).alias("m_")).select("token", F.col("m_.comp").alias("main"))
    others = lists.join(largest, "token").where("comp <> main").drop("main")
    return _pairs(others, lists, percent, boundary)


def open_lists(lists: DataFrame, comps: DataFrame) -> DataFrame:
    """The lists that still hold two components, with each member's."""
    with_comp = lists.join(comps, "cid")
    still = with_comp.groupBy("token").agg(F.min("comp").alias("x_"), F.max("comp").alias("y_")).where("x_ <> y_").select("token")
    return with_comp.join(still, "token")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets reach the threshold, by exact intersection."""

    def run(batches):
        for batch in batches:
            x, y = (batch.column(c) for c in ("grams_a", "grams_b"))
            ok = []
            for g, h in zip(x, y):
                g, h = np.frombuffer(g.as_buffer(), np.uint64), np.frombuffer(h.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(h, g), len(h) - 1)
                both = int((h[at] == g).sum())
                ok.append(100 * both >= percent * (len(g) + len(h) - both))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])

    # Only the sets in question travel.
    ids = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    sets = sets.join(ids, "cid", "left_semi")
    with_a = pairs.join(sets.select(F.col("cid").alias("a"), F.col("grams").alias("grams_a")), "a")
    with_b = with_a.join(sets.select(F.col("cid").alias("b"), F.col("grams").alias("grams_b")), "b")
    return with_b.select("a", "b", "grams_a", "grams_b").mapInArrow(tidy(run), "a long, b long")


def connected(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``cid, comp``: components after adding ``links`` between classes.

    Works on the components as nodes: each takes the smallest neighbour's label, then its
    label's label, until nothing changes; every round is staged.
    """
    a = links.join(comps.select(F.col("cid").alias("a"), F.col("comp").alias("x")), "a").join(comps.select(F.col("cid").alias("b"), F.col("comp").alias("y")), "b")
    edges = a.where("x <> y").select("x", "y").distinct()
    edges = stage(edges.union(edges.select("y", "x")), "join-edges")
    labels = stage(edges.select("x").distinct().withColumn("label", F.col("x")), "join-labels")
    while True:
        near = edges.join(labels.withColumnRenamed("x", "y").withColumnRenamed("label", "seen"), "y").groupBy("x").agg(F.min("seen").alias("seen"))
        hop = labels.join(near, "x").select("x", "label", F.least("label", "seen").alias("next"))
        target = hop.select(F.col("x").alias("t"), F.col("next").alias("its"))
        new = stage(hop.join(target, hop["next"] == target["t"], "left").select("x", F.least("next", F.coalesce("its", "next")).alias("label"), (F.col("label") != F.least("next", F.coalesce("its", "next"))).alias("changed")), "join-labels")
        labels = new.select("x", "label")
        if new.where("changed").isEmpty():
            break
    merged = comps.join(labels.withColumnRenamed("x", "comp"), "comp", "left")
    return stage(merged.select("cid", F.coalesce("label", "comp").alias("comp")), "join-components")


def ident(doc_id: Column) -> Column:
    """An id to join on: null is one value."""
    return F.coalesce(doc_id, F.lit(-(1 << 63)))


def sets_of(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``cid, grams`` of the wanted classes, from one document of each."""

    def run(batches):
        for table in blocks(batches, "text", BLOCK_BYTES):
            ends, grams = shingle_sets(column(table, "text"), n)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            own = [grams[a:b] for a, b in zip(starts, ends)]
            same = np.array([set_key(g) == k for g, k in zip(own, table.column("key").to_pylist())], bool)
            yield pa.RecordBatch.from_arrays([column(table, "cid").filter(pa.array(same)), pa.array([g.tobytes() for g, s in zip(own, same) if s], pa.binary())], ["cid", "grams"])

    # One row of each wanted text: joined and thinned by the same key, so texts move once.
    w = wanted.select(ident(F.col("first_id")).alias("d__"), "first_t", "cid", "key")
    found = docs.select(ident(F.col("doc_id")).alias("d__"), "text").join(w, "d__").where(F.xxhash64("text") == F.col("first_t"))
    return found.dropDuplicates(["d__", "cid"]).select("cid", "key", "text").mapInArrow(run, "cid long, grams binary")


def jaccard_components(documents: DataFrame, n: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, t`` of every row: the smallest id reachable by
    links, where 100 * |A and B| >= percent * |A or B|; t is a hash of the text."""
    docs = id_text(documents, id_col, text_col)
    signed = stage(signatures(docs, n, percent, rarity(docs, n)), "join-signatures")  # read again at the end, without the n-grams
    classes = (signed.where("size > 0").groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "t")).alias("first"), F.min("size").alias("size"), F.min("tokens").alias("tokens")))
    classes = classes.select("key", F.col("first.doc_id").alias("first_id"), F.col("first.t").alias("first_t"), "size", "tokens")
    classes = stage(classes.withColumn("cid", F.monotonically_increasing_id()), "join-classes")

    heavy = stage(with_live(shared_lists(heavy_lists(classes, percent), percent), percent), "join-lists")
    lengths = heavy.groupBy("token").agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") * F.col("n")).alias("squares"), F.sum("n").alias("n")).first()
    boundary = choose_boundary((lengths["squares"] or 0) / max(lengths["n"] or 0, 1), percent)
    subsets = shared_lists(light_lists(classes, boundary, percent), percent)
    lists = heavy.unionByName(stage(subsets.withColumns({"live": F.lit(0).cast("long"), "lone": F.lit(0).cast("long")}), "join-subsets"))

    members = lists.select("cid").distinct()
    wanted = stage(classes.join(members, "cid").select("cid", "key", "first_id", "first_t"), "join-members")
    sets = stage(sets_of(docs, wanted, n), "join-sets")
    comps = wanted.select("cid", F.col("cid").alias("comp"))

    seen, still = None, lists.withColumn("comp", F.col("cid"))
    for step in range(ROUNDS + 1):
        if step:  # a list that has closed stays so
            still = stage(open_lists(still.drop("comp"), comps), "join-open")
        pairs = pivot_pairs(still, percent, boundary, step) if step < ROUNDS else crossing_pairs(still, percent, boundary)
        if seen is not None:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        pairs = stage(pairs, "join-pairs")
        comps = connected(comps, stage(verify(pairs, sets, percent), "join-links"))
        seen = pairs if seen is None else seen.unionByName(pairs)

    of_class = classes.select("key", "first_id", "cid").join(comps, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    ids = of_class.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    by_key = of_class.join(ids, "comp").select("key", "component_id")
    out = signed.select("doc_id", "t", "key", F.col("size").alias("n_shingles")).join(by_key, "key", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "t")


SPACES = " \t\n\x0b\x0c\r"


def one_of_each(documents: DataFrame, n: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, of one document per component: that with the
    smallest id. Rows without a word are linked with nothing, so all of them stay; of rows
    that repeat an id and its text one stays, the same in every run."""
    found = jaccard_components(documents, n, percent, id_col, text_col).where("n_shingles > 0")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t")
    first = found.groupBy("component_id").agg(F.min(order).alias("first"))
    first = stage(first.select(ident(F.col("first.doc_id")).alias("d"), F.col("first.t").alias("t")).distinct(), "join-kept")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    wordless = F.rtrim(text, F.lit(SPACES)) == ""
    # the row is kept whole in a struct, so its columns clash with none here
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    rows = documents.where(~wordless).select(ident(F.col(f"`{id_col}`")).alias("d"), F.xxhash64(text).alias("t"), row).join(first, ["d", "t"])
    one = rows.groupBy("d", "t").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")
    return one.unionByName(documents.where(wordless))
