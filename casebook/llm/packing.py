"""Best-fit packing by bin completion.

Documents become token ids plus an end mark; longer ones are cut into full pieces and
a rest. What must be packed is described by its histogram of lengths, which has at
most ``capacity`` entries whatever the number of documents, so the search runs on the
driver over that histogram: branch and bound completes the bin of the largest
remaining length with undominated fillings, prunes by the waste that an improvement
still allows, and starts from best-fit decreasing as incumbent. The resulting fillings
are dealt out by Spark: pieces of a length are numbered in two levels (so a length that
a third of all pieces share is split) and the number selects the place.

Defined results: a null or empty text is one piece of length 1 (the end mark alone);
repeated rows are packed one by one; an empty table packs into nothing.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.common import blocks, column, id_text, spread, stage, tidy, word_lists

CAPACITY = 4096
END_ID = 1
BLOCK_BYTES = 8 << 20  # smaller ones hold less memory and look more words up
SPLITS = 64  # parts of the numbering of one length
NODE_LIMIT = 2000  # search nodes before the best packing found is taken, at least
LEAVES = 4  # and so many for each distinct length: a step mostly uses up one
FILLINGS = 24  # fillings tried for one bin
STEPS_A_FILLING = 50  # and steps to find each of them
WORDS_HELD = 800_000  # words whose ids a task keeps
ENCODED_AT_ONCE = 4_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# Tokenising

def load_tokenizer(data: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(data)


# Small Latin letters alone, or marks alone: nothing to normalise or to cut, so the
# tokenizer's model can be asked directly.
ALONE = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|[.,;:!?]*").fullmatch


class WordIds:
    """Ids of words, each word encoded once as long as it is held. What is held is
    bounded: beyond ``WORDS_HELD`` words all are given up, and encoded anew when met."""

    def __init__(self, tokenizer):
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.model = tokenizer, tokenizer.model
        of_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = str.maketrans({c: of_bytes(c)[0][0] for c in map(chr, range(0xDF, 0x100))})
        self.clear()

    def encode(self, words: list[str]) -> list[list[int]]:
        alone = [ALONE(w) is not None for w in words]
        got = iter(self.tokenizer.encode_batch_fast([w for w, a in zip(words, alone, strict=True) if not a], add_special_tokens=False))
        tokens = self.model.tokenize
        return [[t.id for t in tokens(w if w.isascii() else w.translate(self.letters))] if a else next(got).ids for w, a in zip(words, alone, strict=True)]

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ends, self.ids = [np.zeros(1, np.int64)], []

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of ids per word, start per word, ids)."""
        if len(self.place) > WORDS_HELD:
            self.clear()
        place = self.place
        new = [w for w in words if w not in place]
        for i in range(0, len(new), ENCODED_AT_ONCE):
            some = new[i:i + ENCODED_AT_ONCE]
            got = self.encode(some)
            place.update(zip(some, range(len(place), len(place) + len(some)), strict=True))
            self.ends.append(self.ends[-1][-1] + np.cumsum(np.fromiter(map(len, got), np.int64, len(got))))
            self.ids.append(np.array(list(chain.from_iterable(got)), np.uint32))
        self.ends, self.ids = [np.concatenate(self.ends)], [np.concatenate(self.ids)] if self.ids else []
        at = np.array(list(map(place.__getitem__, words)), np.int64)
        ends = self.ends[0]
        return ends[at + 1] - ends[at], ends[at], self.ids[0] if self.ids else np.zeros(0, np.uint32)


# Latin letters, then marks at the end: the tokenizer lower-cases the letters one by one and
# takes letters and marks apart, so both parts can be encoded alone.
PLAIN = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[.,;:!?]*)$"


def word_ids(words: pa.Array, held: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """(number of ids per word, the ids of all words in order). Words that differ only in
    capitals and in marks at the end share what is encoded."""
    found = pc.extract_regex(words, PLAIN)
    plain = found.is_valid()
    stems = pc.if_else(plain, pc.utf8_lower(pc.struct_field(found, "letters")), words)
    marks = pc.if_else(plain, pc.struct_field(found, "marks"), "")
    coded = pa.concat_arrays([stems, marks]).dictionary_encode()
    n, at, ids = held.of(coded.dictionary.to_pylist())
    both = np.asarray(coded.indices).astype(np.int64).reshape(2, -1).T.ravel()  # each word's two parts
    lens = n[both]
    return lens.reshape(-1, 2).sum(axis=1), ids[spread(lens, at[both])]


def pieces_of(table: pa.Table, held: WordIds, capacity: int) -> pa.RecordBatch:
    """The pieces of one block. A function of its own, so that what a block needs is
    given up before the next is read."""
    ends, codes, words = word_lists(column(table, "text"))
    n, ids = word_ids(words, held)
    at = np.cumsum(n) - n
    per_word = n[codes]
    token_ends = np.concatenate([[0], np.cumsum(per_word)])[np.concatenate([[0], ends])]
    # each document's ids with the end mark after them
    flat = np.insert(ids[spread(per_word, at[codes])].astype("<u4"), token_ends[1:], np.uint32(END_ID))
    lens = np.diff(token_ends) + 1
    pieces = -(-lens // capacity)
    rows = np.repeat(np.arange(len(lens)), pieces)
    piece = spread(pieces, np.zeros(len(lens), np.int64))
    start = piece * capacity
    length = np.minimum(lens[rows] - start, capacity)
    first = (np.cumsum(lens) - lens)[rows] + start
    crc = np.fromiter((zlib.crc32(flat[a:a + n]) for a, n in zip(first.tolist(), length.tolist(), strict=True)), np.int64, len(rows))
    return pa.RecordBatch.from_arrays([column(table, "doc_id").take(pa.array(rows)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)],
                                      ["doc_id", "piece", "start", "length", "ids_crc32"])


def cut_pieces(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, block_bytes: int | None = None) -> DataFrame:
    """One row per piece. The tokenizer drops white space and works on the words
    between it one by one (its special strings, which hold none, are found within them),
    so each distinct word of a task is encoded once."""
    with open(tokenizer_path, encoding="utf-8") as f:
        data = documents.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary of fixed size
    at_once = block_bytes or BLOCK_BYTES

    def run(batches):
        held = WordIds(load_tokenizer(data.value))
        for table in blocks(batches, "text", at_once):
            yield pieces_of(table, held, capacity)

    return id_text(documents).mapInArrow(tidy(run), PIECES)


# The search

@dataclass
class Filling:
    """``count`` bins, each holding ``items``: (length, how many), lengths descending."""

    count: int
    items: list[tuple[int, int]]


def best_fit_decreasing(histogram: dict[int, int], capacity: int) -> list[Filling]:
    """Best-fit decreasing over lengths with multiplicities: bins alike are one entry."""
    open_bins: dict[int, list[Filling]] = {}  # by room left
    done: list[Filling] = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for room in sorted(r for r in open_bins if r >= length):
            if not left:
                break
            fit, waiting = room // length, open_bins.pop(room)
            while waiting and left:
                bin_ = waiting.pop()
                full = min(bin_.count, left // fit)
                for bins, each in ((full, fit), (1, left - full * fit) if full < bin_.count else (0, 0)):
                    if bins and each:
                        open_bins.setdefault(room - each * length, []).append(Filling(bins, [*bin_.items, (length, each)]))
                        bin_.count -= bins
                        left -= bins * each
                if bin_.count:
                    waiting.append(bin_)
                    if left:
                        raise AssertionError("a bin was passed over")
            if waiting:
                open_bins.setdefault(room, []).extend(waiting)
        fit = capacity // length
        for bins, each in ((left // fit, fit), (1, left % fit)):
            if bins and each:
                open_bins.setdefault(capacity - each * length, []).append(Filling(bins, [(length, each)]))
    for same in open_bins.values():
        done += same
    return done


def lower_bound(histogram: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs, see :func:`fewest`."""
    sizes = np.array(sorted(histogram), np.int64)
    return fewest(sizes, np.array([histogram[s] for s in sizes.tolist()], np.int64), capacity)


def fewest(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """The larger of the volume bound and, over all thresholds k, the bound that counts
    items too large to share a bin: those over capacity - k take a bin each, those over
    half of it too, and what lies between k and half must fill up the latter or take more.
    ``sizes`` ascend; prefix sums answer all thresholds at once."""
    n, volume = (np.concatenate([[0], np.cumsum(x)]) for x in (counts, sizes * counts))
    best = -(-int(volume[-1]) // capacity)
    half = int(np.searchsorted(sizes, capacity // 2, side="right"))
    if half:
        big = np.searchsorted(sizes, capacity - sizes[:half], side="right")
        n_mid, v_mid = n[big] - n[half], volume[big] - volume[half]
        rest = volume[half] - volume[:half] - (n_mid * capacity - v_mid)
        best = max(best, int((n[-1] - n[half] + np.maximum(0, -(-rest // capacity))).max()))
    return best


def undominated_fillings(sizes: list[int], left: list[int], room: int, most_waste: int, limit: int) -> list[list[int]]:
    """Fillings of ``room`` with the largest lengths first, least waste first. ``sizes``
    fall, and there are ``left`` of each, at least one.

    Only maximal ones within the waste allowed; a filling is dominated when another of
    the same or less waste has the same number of lengths or fewer, each at least as
    large as its counterpart.
    """
    found: list[list[int]] = []
    budget, used = STEPS_A_FILLING * limit, {}

    def maximal(room: int) -> bool:
        """Whether none of the lengths still there fits: look from the smallest on."""
        for i in range(len(sizes) - 1, -1, -1):
            if sizes[i] > room:
                return True
            if used.get(i, 0) < left[i]:
                return False
        return True

    def grow(chosen: list[int], room: int, start: int) -> None:
        nonlocal budget
        fits = False
        for i in range(max(start, bisect_left(sizes, -room, key=lambda s: -s)), len(sizes)):  # lengths that fit
            if used.get(i, 0) >= left[i]:
                continue
            fits = True
            budget -= 1
            if budget < 0 or len(found) >= limit:
                return
            used[i] = used.get(i, 0) + 1
            grow([*chosen, sizes[i]], room - sizes[i], i)
            used[i] -= 1
        if not fits and room <= most_waste and maximal(room):
            found.append(chosen)

    grow([], room, 0)
    covers = lambda a, b: len(a) <= len(b) and sum(a) >= sum(b) and all(x >= y for x, y in zip(a, b))
    kept: list[list[int]] = []
    for f in sorted(found, key=lambda f: (-sum(f), len(f))):
        if not any(covers(k, f) for k in kept):
            kept.append(f)
    return kept


def bin_completion(histogram: dict[int, int], capacity: int = CAPACITY, node_limit: int = NODE_LIMIT) -> list[Filling]:
    """Fillings of as few bins as the search finds.

    Depth-first: the largest remaining length opens a bin, each undominated filling
    completes it (as often as the counts allow at once), and a branch ends when its
    waste exceeds what one bin less than the incumbent would leave.
    """
    histogram = {s: n for s, n in histogram.items() if n}
    if not histogram:
        return []
    best = best_fit_decreasing(histogram, capacity)
    n_best = sum(f.count for f in best)
    sizes = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[s] for s in sizes.tolist()], np.int64)
    place = {s: i for i, s in enumerate(sizes.tolist())}
    bound, total = fewest(sizes, counts, capacity), int((sizes * counts).sum())
    nodes, node_limit = 0, max(node_limit, LEAVES * len(histogram))

    def branch(left: np.ndarray, used, n_used: int, waste: int):
        """Yields the next choices; kept on an explicit stack, as bins may be many."""
        there = np.flatnonzero(left)
        largest = int(sizes[there[-1]])
        now = left.copy()
        now[there[-1]] -= 1
        allowed = (n_best - 1) * capacity - total - waste
        if allowed < 0:
            return
        there = np.flatnonzero(now)[::-1]
        for filling in undominated_fillings(sizes[there].tolist(), now[there].tolist(), capacity - largest, allowed, FILLINGS):
            need: dict[int, int] = {largest: 1}
            for s in filling:
                need[s] = need.get(s, 0) + 1
            each = capacity - largest - sum(filling)
            times = min(int(left[place[s]]) // n for s, n in need.items())
            if each:
                times = min(times, max(1, allowed // each))
            after = left.copy()
            for s, n in need.items():
                after[place[s]] -= n * times
            # what was chosen so far is a chain of pairs, as deep branches share it
            yield after, (used, Filling(times, sorted(need.items(), reverse=True))), n_used + times, waste + times * each

    stack = [branch(counts, None, 0, 0)] if n_best > bound else []
    while stack and nodes < node_limit and n_best > bound:
        step = next(stack[-1], None)
        nodes += 1
        if step is None:
            stack.pop()
            continue
        left, used, n_used, waste = step
        some = left > 0
        if not some.any():
            if n_used < n_best:
                best, n_best = [], n_used
                while used:
                    used, filling = used
                    best.append(filling)
        elif waste <= (n_best - 1) * capacity - total and n_used + fewest(sizes[some], left[some], capacity) < n_best:
            stack.append(branch(left, used, n_used, waste))
    return best


# Dealing out

def places(fillings: list[Filling]) -> np.ndarray:
    """Rows (length, first number, bins' first id, of this length per bin, offset), by
    length and number: where the pieces of each length go."""
    rows, taken, first = [], {}, 0
    for f in fillings:
        offset = 0
        for length, each in f.items:
            rows.append((length, taken.get(length, 0), first, each, offset))
            taken[length] = taken.get(length, 0) + f.count * each
            offset += length * each
        first += f.count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def numbered(pieces: DataFrame) -> DataFrame:
    """Adds ``number_``: 0, 1, ... among the pieces of a length, in two levels."""
    split = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SPLITS))
    parted = pieces.withColumn("split_", split)
    sizes = parted.groupBy("length", "split_").agg(F.count(F.lit(1)).alias("n_"))  # at most capacity * SPLITS rows
    before = F.sum("n_").over(Window.partitionBy("length").orderBy("split_").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("length", "split_", F.coalesce(before, F.lit(0)).alias("before_"))
    within = F.row_number().over(Window.partitionBy("length", "split_").orderBy("doc_id", "piece", "ids_crc32")) - 1
    return parted.withColumn("within_", within).join(offsets, ["length", "split_"]).withColumn("number_", F.col("before_") + F.col("within_")).drop("split_", "within_", "before_")


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    plan = pieces.sparkSession.sparkContext.broadcast(places(bin_completion(histogram, capacity)))  # bounded by capacity

    def run(batches):
        rows = plan.value
        keys = (rows[:, 0] << 44) + rows[:, 1]
        for batch in batches:
            length, number = (np.asarray(batch.column(c)).astype(np.int64) for c in ("length", "number_"))
            _, first_number, first_bin, each, offset = rows[np.searchsorted(keys, (length << 44) + number, side="right") - 1].T
            t = number - first_number
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(first_bin + t // each), pa.array(offset + (t % each) * length)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ready = numbered(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "number_")
    return ready.mapInArrow(run, PIECES + ", sequence_id long, offset long")


def pack(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, block_bytes: int | None = None) -> DataFrame:
    return pack_pieces(stage(cut_pieces(documents, tokenizer_path, capacity, block_bytes), "pack-pieces"), capacity)
