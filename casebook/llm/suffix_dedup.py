"""Suffix-array dedup: remove every byte that a repeated string of ``LENGTH`` bytes covers.

A window of ``LENGTH`` bytes is found twice exactly when its suffix has a neighbour in
the corpus' suffix array with a common prefix that long. The array is cut into parts
that can be sorted alone: equal windows have the same smallest ``GRAM``-byte hash at the
same place (their anchor), so only windows of one anchor hash need be sorted together.

1. Each text yields its anchors, with the run of windows that each one stands for.
2. Anchor hashes found once end there. Where all runs of a hash have the same bytes,
   all of their windows are repeated. Only runs that differ go on, one of each content.
3. Their bytes are concatenated by anchor hash and suffix-sorted in two stages:
   suffixes smaller than their successor are sorted directly, the others induced by a
   scan over the buckets of first bytes; adjacent common prefixes then tell which
   windows are repeated. An anchor hash with more than ``CROWD`` different runs is
   split further, into its windows, which are counted by content.
4. Repeated windows are joined back to the texts, merged and cut out.

Matches never cross texts; overlaps count; strings are judged on the input.

Defined results: null and empty texts have no bytes; texts shorter than ``LENGTH`` are
kept whole; repeated rows count as separate occurrences, so such texts are removed
whole if long enough; rows with null ids are treated like others.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import blocks, column, id_text, mix, own_name, spread, stage, tidy

LENGTH = 200
GRAM = 40
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
PLACE_BITS = 21  # of a gram's hash give way to its place when the smallest is looked for
BLOCK_BYTES = 1 << 20
SORT_BYTES = 1 << 20  # bytes sorted at once; a part of one anchor hash stays whole
CROWD = 20_000  # different runs of one anchor hash that are still sorted in one part


# Anchors

def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64."""
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for base in (BASE, inverse):
        p = np.full(n, np.uint64(base), np.uint64)
        if n:
            p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def gram_hashes(data: np.ndarray, powers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Hash of the GRAM bytes from each position on."""
    up, down = powers
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    n = max(len(data) - GRAM + 1, 0)
    return mix((sums[GRAM:GRAM + n] - sums[:n]) * down[:n])


def leftmost_minima(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest value, by the bits above ``PLACE_BITS``, in each window of
    ``width`` values; the leftmost of equals."""
    out = np.zeros(max(len(h) - width + 1, 0), np.int64)
    step = (1 << PLACE_BITS) - width
    low = np.uint64((1 << PLACE_BITS) - 1)
    for a in range(0, len(out), step):  # value and place in one number, so places must fit
        part = h[a:a + step + width - 1]
        v = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        size = 1
        while size < width:  # the smallest of ``size`` values; at last of ``width``
            more = min(size, width - size)
            v = np.minimum(v[:-more], v[more:])
            size += more
        out[a:a + step] = (v & low).view(np.int64)
        out[a:a + step] += a
    return out


def anchors_of(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, powers) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, first window, number of windows) of every run; windows are
    positions in ``data``."""
    long = np.flatnonzero(lens >= LENGTH)
    if not len(long):
        return (np.zeros(0, np.int64),) * 4
    h = gram_hashes(data, powers)
    minima = leftmost_minima(h, LENGTH - GRAM + 1)
    n_windows = lens[long] - LENGTH + 1
    p, text = spread(n_windows, starts[long]), np.repeat(long, n_windows)
    anchor = minima[p]
    new = np.ones(len(p), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return text[first], h[anchor[first]], p[first], np.diff(np.append(first, len(p)))


def anchors(keyed: DataFrame) -> DataFrame:
    """``doc_id, t, h, c, p, n``: per run its anchor hash, a digest of its bytes, its first
    window and the number of windows."""

    def run(batches):
        powers = _powers(0)
        for table in blocks(batches, "text", BLOCK_BYTES):
            raw = [b.as_buffer() for b in column(table, "text").cast(pa.binary())]
            lens = np.fromiter((len(b) for b in raw), np.int64, len(raw))
            data = b"".join(raw)
            if len(data) > len(powers[0]):
                powers = _powers(max(len(data), BLOCK_BYTES + (BLOCK_BYTES >> 2)))
            starts = np.cumsum(lens) - lens
            text, h, p, n = anchors_of(np.frombuffer(data, np.uint8), starts, lens, powers)
            c = np.fromiter((xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(p.tolist(), (p + n - 1 + LENGTH).tolist())), np.uint64, len(p))
            own = pa.array(text)
            for a in range(0, max(len(p), 1), 100_000):
                s = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [column(table, "doc_id").take(own[s]), column(table, "t").take(own[s]), pa.array(h[s].view(np.int64)), pa.array(c[s].view(np.int64)),
                     pa.array((p - starts[text])[s]), pa.array(n[s].astype(np.int32))], ["doc_id", "t", "h", "c", "p", "n"])

    return keyed.mapInArrow(run, "doc_id long, t long, h long, c long, p long, n int")


# Suffix sorting

def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as a number that sorts like them; zeros
    follow the end, over which ``LENGTH`` bytes may reach."""
    padded = np.concatenate([data, np.zeros(LENGTH + 8, np.uint8)])
    out = np.zeros(len(data) + LENGTH, np.uint64)
    for i in range(8):
        out <<= np.uint64(8)
        out |= padded[i:i + len(out)]
    return out


def smaller_than_next(data: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor (the end is smallest)."""
    step = np.zeros(len(data), np.int8)
    step[:-1] = np.sign(data[1:].astype(np.int16) - data[:-1])
    step[-1] = -1
    nonzero = np.where(step != 0, np.arange(len(data)), len(data) - 1)
    return step[np.minimum.accumulate(nonzero[::-1])[::-1]] > 0


def by_group(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The order by ``group``, which is ascending, and ``key``."""
    order = np.argsort(key)
    of = np.cumsum(np.diff(group, prepend=group[0]) != 0)
    if of[-1] < 1 << 16:  # sorted by digits
        of = of.astype(np.uint16)
    return order[np.argsort(of[order], kind="stable")]


def sort_directly(pos: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """``pos`` by the ``depth`` bytes from there on: eight bytes at a time, and only
    those still tied. Ties whose next bytes are all alike are in order already."""
    key = words[pos]
    order = np.argsort(key)
    pos, key = pos[order], key[order]
    at, p = np.arange(len(pos)), pos  # places of what is tied, and what is there
    like_last = np.zeros(len(pos), bool)  # tied with the one before
    like_last[1:] = key[1:] == key[:-1]
    for d in range(8, depth, 8):
        tied = like_last.copy()
        tied[:-1] |= like_last[1:]
        at, p, like_last = at[tied], p[tied], like_last[tied]
        if not len(at):
            break
        key = words[p + d]
        same = np.zeros(len(at), bool)
        same[1:] = key[1:] == key[:-1]
        group = np.cumsum(~like_last) - 1
        mixed = np.zeros(group[-1] + 1, bool)
        mixed[group[like_last & ~same]] = True
        some = np.flatnonzero(mixed[group])
        if len(some):
            order = some[by_group(group[some], key[some])]
            p[some], key[some] = p[order], key[order]
            pos[at[some]] = p[some]
            same[1:] = key[1:] == key[:-1]
        like_last &= same
    return pos


def suffix_array(data: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes, in two stages."""
    small = smaller_than_next(data)
    direct = sort_directly(np.flatnonzero(small), words, depth)
    bounds = np.searchsorted(data[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[data[-1]].append(np.array([len(data) - 1]))  # its successor, the end, is smallest
    out: list[np.ndarray] = []

    def induce(scanned: np.ndarray, c: int) -> np.ndarray:
        """Put the predecessors that are larger than what was scanned into their
        buckets, in scan order; returns those of this very bucket."""
        before = scanned[scanned > 0] - 1
        before = before[~small[before]]
        first = data[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cuts = np.flatnonzero(np.diff(first, prepend=-1)) if len(first) else []
        own = before[:0]
        for a, b in zip(cuts, [*cuts[1:], len(first)]):
            if first[a] == c:
                own = before[a:b]
            else:
                waiting[first[a]].append(before[a:b])
        return own

    for c in range(256):
        scanned = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(scanned):
            out.append(scanned)
            scanned = induce(scanned, c)
        scanned = direct[bounds[c]:bounds[c + 1]]
        if len(scanned):
            out.append(scanned)
            induce(scanned, c)
    return np.concatenate(out)


def repeated_windows(data: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Which of the valid positions start a window that another valid one starts too."""
    words = words_at(data)
    order = suffix_array(data, words, LENGTH)
    same = np.ones(len(order) - 1, bool)  # adjacent common prefix of LENGTH or more
    for d in reversed(range(0, LENGTH, 8)):  # most that differ somewhere do so at the end
        at = np.flatnonzero(same)
        x, y = words[order[at] + d], words[order[at + 1] + d]
        if LENGTH - d < 8:
            keep = np.uint64(64 - 8 * (LENGTH - d))
            x, y = x >> keep, y >> keep
        same[at[x != y]] = False
    group = np.concatenate([[0], np.cumsum(~same)])
    many = np.bincount(group, weights=valid[order]) > 1
    out = np.zeros(len(data), bool)
    out[order] = many[group]
    return out & valid


# The parts

PARTS = "h long, c long, n int, run binary"


def runs_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of one run of each content."""
    w = wanted.groupBy("first.doc_id", "first.t").agg(F.collect_list(F.struct("h", "c", "first.p", "first.n")).alias("runs"))  # of one text
    w = w.select(F.col("doc_id").alias("w_id"), F.col("t").alias("w_t"), "runs")
    found = docs.join(w, docs["doc_id"].eqNullSafe(w["w_id"]) & (docs["t"] == w["w_t"])).select("text", "runs")

    def run(batches):
        for batch in batches:
            for text, runs in zip(batch.column("text"), batch.column("runs").to_pylist()):
                data = text.as_py().encode()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["h"] for r in runs], pa.int64()), pa.array([r["c"] for r in runs], pa.int64()), pa.array([r["n"] for r in runs], pa.int32()),
                     pa.array([data[r["p"]:r["p"] + r["n"] - 1 + LENGTH] for r in runs], pa.binary())], ["h", "c", "n", "run"])

    # Repeated rows yield a run more than once.
    return found.mapInArrow(tidy(run), PARTS).dropDuplicates(["h", "c"])


REPEATS = "h long, c long, low int, high int"


def sort_parts(runs: DataFrame) -> DataFrame:
    """Ranges of repeated windows in each run, found by suffix-sorting its part."""

    def solve(h, c, n, run):
        lens = np.fromiter(map(len, run), np.int64, len(run))
        starts = np.cumsum(lens) - lens
        data = np.frombuffer(b"".join(run), np.uint8)
        valid = np.zeros(len(data), bool)
        valid[spread(n, starts)] = True
        hit = repeated_windows(data, valid)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
        low, high = edge[::2], edge[1::2] - 1  # windows of neighbouring runs never touch
        own = np.searchsorted(starts, low, side="right") - 1
        return pa.RecordBatch.from_arrays([pa.array(h[own]), pa.array(c[own]), pa.array((low - starts[own]).astype(np.int32)), pa.array((high - starts[own]).astype(np.int32))], ["h", "c", "low", "high"])

    def run(batches):
        held: list = []
        size = 0

        def ready(whole: bool):
            """Solve what is held, but for the last part unless the input has ended."""
            nonlocal held, size
            h = np.array([r[0] for r in held], np.int64)
            cut = len(h) if whole else int(np.searchsorted(h, h[-1]))
            out = None
            if cut:
                part, held = held[:cut], held[cut:]
                size = sum(len(r[3]) for r in held)
                out = solve(h[:cut], np.array([r[1] for r in part], np.int64), np.array([r[2] for r in part], np.int64), [r[3] for r in part])
            return out

        for batch in batches:
            for row in zip(*(batch.column(x).to_pylist() for x in ("h", "c", "n", "run"))):
                held.append(row)
                size += len(row[3])
                if size >= SORT_BYTES and (len(held) < 2 or held[-2][0] != row[0]):
                    if (out := ready(False)) is not None:
                        yield out
        if held:
            yield ready(True)

    return runs.repartition("h").sortWithinPartitions("h", "c").mapInArrow(tidy(run), REPEATS)


def count_windows(runs: DataFrame) -> DataFrame:
    """The same ranges for crowded anchor hashes: windows counted by content."""

    def run(batches):
        for batch in batches:
            for h, c, n, data in zip(*(batch.column(x).to_pylist() for x in ("h", "c", "n", "run"))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h] * n, pa.int64()), pa.array([c] * n, pa.int64()), pa.array(range(n), pa.int32()),
                     pa.array([xxhash.xxh3_128_digest(data[i:i + LENGTH]) for i in range(n)], pa.binary())], ["h", "c", "i", "window"])

    windows = runs.mapInArrow(tidy(run), "h long, c long, i int, window binary")
    twice = windows.groupBy("window").agg(F.count(F.lit(1)).alias("k_")).where("k_ > 1").select("window")
    return windows.join(twice, "window").select("h", "c", F.col("i").alias("low"), F.col("i").alias("high"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, t, spans``: byte ranges that repeated windows cover, per text."""
    found = anchors(docs)
    alike = found.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.min("c").alias("c0"), F.max("c").alias("c1")).where("k > 1").select("h", (F.col("c0") != F.col("c1")).alias("mixed"))
    hits = stage(found.join(alike, "h"), "dedup-hits")

    contents = hits.where("mixed").groupBy("h", "c").agg(F.count(F.lit(1)).alias("k"), F.min(F.struct("doc_id", "t", "p", "n")).alias("first"))
    contents = stage(contents, "dedup-contents")
    crowded = contents.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > CROWD).select("h")
    runs = stage(runs_of(docs, contents).join(crowded.withColumn("crowded", F.lit(True)), "h", "left"), "dedup-runs")
    ranges = sort_parts(runs.where("crowded is null").drop("crowded")).unionByName(count_windows(runs.where("crowded").drop("crowded")))
    # A content found twice is repeated from end to end.
    twice = contents.where("k > 1").select("h", "c", F.lit(0).alias("low"), (F.col("first.n") - 1).alias("high"))
    ranges = stage(ranges.unionByName(twice), "dedup-ranges")

    whole = hits.where("not mixed").select("doc_id", "t", F.struct(F.col("p").alias("a"), (F.col("p") + F.col("n") - 1 + LENGTH).alias("b")).alias("span"))
    some = hits.where("mixed").join(ranges, ["h", "c"]).select("doc_id", "t", F.struct((F.col("p") + F.col("low")).alias("a"), (F.col("p") + F.col("high") + LENGTH).alias("b")).alias("span"))
    return whole.unionByName(some).groupBy("doc_id", "t").agg(F.collect_set("span").alias("spans"))  # of one text


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def keyed_texts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, t``; t tells rows of the same id apart."""
    return id_text(documents, id_col, text_col).withColumn("t", F.xxhash64("text"))


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    s = spans.select(F.col("doc_id").alias("s_id"), F.col("t").alias("s_t"), "spans")
    return docs.join(s, docs["doc_id"].eqNullSafe(s["s_id"]) & (docs["t"] == s["s_t"]), "left").drop("s_id", "s_t")


def kept_bytes(data: bytes, cuts: list[tuple[int, int]]) -> bytes:
    out, end = [], 0
    for a, b in cuts:
        out.append(data[end:a])
        end = b
    return b"".join([*out, data[end:]])


def deduplicate(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, kept`` (binary: the bytes left)`, n_bytes, n_removed, n_spans`` of every row."""
    docs = keyed_texts(documents, id_col, text_col)

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text, spans in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                data, cuts = text.encode(), merged(spans)
                out.append((doc_id, kept_bytes(data, cuts), len(data), sum(b - a for a, b in cuts), len(cuts)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))],
                                             ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    found = with_spans(docs, repeated_spans(docs)).select("doc_id", "text", "spans")
    return found.mapInArrow(tidy(run), "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def inside_characters(data: bytes, cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The cuts narrowed to whole UTF-8 characters, so that what is left is text."""
    out = []
    for a, b in cuts:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def remove_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The rows, with all their columns, less the whole characters that repeated strings
    cover; ``length_col``, where there is one, is brought up to date."""
    docs = keyed_texts(documents, id_col, text_col)
    mine = own_name(documents.columns, "spans__")
    spans = repeated_spans(docs).select(F.col("doc_id").alias(own_name(documents.columns, "id__")), F.col("t").alias(own_name(documents.columns, "t__")), F.col("spans").alias(mine))
    its_id, its_t = spans.columns[:2]
    on = F.col(f"`{id_col}`").eqNullSafe(F.col(its_id)) & (F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))) == F.col(its_t))
    joined = documents.join(spans, on, "left").drop(its_id, its_t)

    def run(batches):
        for table in blocks(batches, text_col, BLOCK_BYTES):
            texts = []
            for text, cuts in zip(column(table, text_col).to_pylist(), column(table, mine).to_pylist()):
                if cuts:
                    data = text.encode()
                    text = kept_bytes(data, inside_characters(data, merged(cuts))).decode()
                texts.append(text)
            table = table.drop_columns([mine])
            new = pa.array(texts, pa.string())
            table = table.set_column(table.schema.get_field_index(text_col), text_col, new)
            if length_col in table.schema.names:
                at = table.schema.get_field_index(length_col)
                table = table.set_column(at, length_col, pc.utf8_length(new).cast(table.schema.field(at).type))
            yield from table.to_batches()

    return joined.mapInArrow(tidy(run), documents.schema)


def digests(documents: DataFrame) -> DataFrame:
    d = deduplicate(documents)
    return d.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
