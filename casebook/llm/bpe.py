"""Byte-level BPE encoding and decoding through a global shuffle of distinct words.

Texts are cut into pre-tokens. A block of texts lists each distinct pre-token once and
keeps, per text, the positions as indices into that list. The lists are shuffled by a
hash bucket of the word, where each distinct word of the whole corpus is encoded once;
the ids go back to the blocks and are reassembled by position. So a word's text moves
once per block instead of once per occurrence, and a word as common as you like costs
its bucket one entry per block.

Decoding joins the ids with the table of token bytes, whose size the vocabulary fixes.

The two passes over the texts must see the same blocks, so ``encode`` wants a table
(or any relation that gives the same rows in the same partitions when read again).

Defined results: null and empty texts have no ids and decode to no bytes; rows are
encoded one by one, so repeated rows and null ids keep their own result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import blocks, column, id_text, spread

BLOCK_BYTES = 16 << 20  # of text per block
BUCKET_BYTES = 16 << 20  # of text per word bucket
CODES_PART = 1 << 20  # positions per row of a block


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank is merged first, the
    leftmost of equals, until no pair has a rank. A heap keeps long words n log n."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    parts: list[bytes | None] = [word[i:i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else n
        if j >= n or ranks.get(parts[i] + parts[j]) != r:  # a part was merged meanwhile
            continue
        parts[i] += parts[j]
        parts[j] = None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(parts[i] + parts[after[i]])) is not None:
                heapq.heappush(heap, (r, i))
        if before[i] >= 0 and (r := ranks.get(parts[before[i]] + parts[i])) is not None:
            heapq.heappush(heap, (r, before[i]))
    return [ranks[p] for p in parts if p is not None]


# Pre-tokens

SPACE = re.compile(r"\s")


def positions(texts: pa.Array, pattern: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(ends per text, index of each pre-token, the distinct pre-tokens).

    A space followed by something other than white space always starts a pre-token of
    the pattern, and no pre-token looks back. So the texts are cut there first, and
    the pattern runs on each distinct piece only. A text with other white space next
    to a space is run through the pattern whole.
    """
    find = regex.compile(pattern).findall
    lists = pc.split_pattern(texts, " ")
    offsets = np.asarray(lists.offsets).astype(np.int64)
    offsets -= offsets[0]
    coded = lists.flatten().dictionary_encode()
    codes = np.asarray(coded.indices).astype(np.int64)
    pieces = coded.dictionary.to_pylist()
    odd = np.fromiter((not p or SPACE.match(p) is not None for p in pieces), bool, len(pieces))

    first = np.zeros(len(codes), bool)
    starts = offsets[:-1][np.diff(offsets) > 0]
    first[starts] = True
    irregular = np.zeros(len(texts), bool)
    bad = np.flatnonzero(odd[codes] & ~first)
    irregular[np.searchsorted(offsets, bad, side="right") - 1] = True

    keys = 2 * codes + ~first
    used = np.zeros(2 * len(pieces), bool)
    used[keys] = True
    index: dict[str, int] = {}
    found: list[int] = []
    chunk_len, chunk_at = np.zeros(len(used), np.int64), np.zeros(len(used), np.int64)
    for key in np.flatnonzero(used):
        piece = pieces[key >> 1]
        words = find(" " + piece if key & 1 else piece)
        chunk_at[key], chunk_len[key] = len(found), len(words)
        found += [index.setdefault(w, len(index)) for w in words]
    extra_at, extra_len = [], []
    for i in np.flatnonzero(irregular):
        words = find(texts[int(i)].as_py())
        extra_at.append(len(found))
        extra_len.append(len(words))
        found += [index.setdefault(w, len(index)) for w in words]

    lens, at = chunk_len[keys], chunk_at[keys]
    if len(extra_at):  # an irregular text's first piece stands for all of it
        inside = np.repeat(irregular, np.diff(offsets))
        lens[inside] = 0
        lens[offsets[:-1][irregular]], at[offsets[:-1][irregular]] = extra_len, extra_at
    ends = np.concatenate([[0], np.cumsum(lens)])[offsets[1:]]
    return ends, np.asarray(found, np.int64)[spread(lens, at)] if len(found) else np.zeros(0, np.int64), list(index)


def bucket_of(word: bytes, buckets: int) -> int:
    return zlib.crc32(word) % buckets


def block_name(k: int) -> int:
    """Of this task's k-th block."""
    return (TaskContext.get().partitionId() << 20) | k


def in_buckets(words: list[str], buckets: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words by bucket, in the order given; their buckets; the place of each given word).
    A block's words come in the order of its rows, so both passes get the same places."""
    raw = [w.encode() for w in words]
    bucket = np.fromiter((bucket_of(w, buckets) for w in raw), np.int64, len(raw))
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(raw), np.int64)
    place[order] = np.arange(len(raw))
    return [raw[i] for i in order.tolist()], bucket[order], place


def planes(x: np.ndarray) -> bytes:
    """32-bit numbers as four planes of bytes, which compress better than whole numbers."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


WORDS = "block long, bucket int, words array<binary>"
CODES = "block long, part int, ids array<bigint>, lens binary, codes binary"


def block_words(docs: DataFrame, pattern: str, buckets: int) -> DataFrame:
    """The distinct pre-tokens of each block, one row per block and bucket."""

    def run(batches):
        for k, table in enumerate(blocks(batches, "text", BLOCK_BYTES)):
            _, _, words = positions(column(table, "text"), pattern)
            raw, bucket, _ = in_buckets(words, buckets)
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1)) if len(raw) else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array([*cuts, len(raw)], pa.int32()), pa.array(raw, pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array([block_name(k)] * len(cuts), pa.int64()), pa.array(bucket[cuts], pa.int32()), lists], ["block", "bucket", "words"])

    return docs.select("doc_id", "text").mapInArrow(run, WORDS)  # the columns of block_codes, for the same batches


def block_codes(docs: DataFrame, pattern: str, buckets: int) -> DataFrame:
    """Per block its texts' positions, as indices into the block's words."""

    def run(batches):
        for k, table in enumerate(blocks(batches, "text", BLOCK_BYTES)):
            ends, codes, words = positions(column(table, "text"), pattern)
            _, _, place = in_buckets(words, buckets)
            codes = place[codes] if len(words) else codes
            ids, a, part = table.column("doc_id").to_pylist(), 0, 0
            ends0 = np.concatenate([[0], ends])
            while a < len(ids):
                b = max(a + 1, int(np.searchsorted(ends, ends0[a] + CODES_PART, side="right")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block_name(k)], pa.int64()), pa.array([part], pa.int32()), pa.array([ids[a:b]], pa.list_(pa.int64())),
                     pa.array([planes(np.diff(ends0[a:b + 1]))], pa.binary()), pa.array([zlib.compress(planes(codes[ends0[a]:ends0[b]]), 1)], pa.binary())],
                    ["block", "part", "ids", "lens", "codes"])
                a, part = b, part + 1

    return docs.select("doc_id", "text").mapInArrow(run, CODES)


def word_ids(words: DataFrame, ranks) -> DataFrame:
    """Every bucket's words encoded, each distinct one once: per block and bucket the
    number of ids of each word and the ids."""

    def run(table: pa.Table) -> pa.Table:
        lists = column(table, "words")
        coded = lists.flatten().dictionary_encode()
        distinct = [merge(w, ranks.value) for w in coded.dictionary.to_pylist()]
        n = np.fromiter(map(len, distinct), np.int64, len(distinct))
        at, flat = np.cumsum(n) - n, np.fromiter((i for ids in distinct for i in ids), np.int64, int(n.sum()))
        codes, offsets = np.asarray(coded.indices).astype(np.int64), np.asarray(lists.offsets).astype(np.int64)
        offsets -= offsets[0]
        lens, ids = [], []
        for a, b in zip(offsets[:-1], offsets[1:]):
            own = codes[a:b]
            lens.append(planes(n[own]))
            ids.append(planes(flat[spread(n[own], at[own])]))
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "lens": pa.array(lens, pa.binary()), "ids": pa.array(ids, pa.binary())})

    return words.groupBy("bucket").applyInArrow(run, "block long, bucket int, lens binary, ids binary")


def encode(documents: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int) for every row."""
    docs = id_text(documents, id_col, text_col)
    sc = documents.sparkSession.sparkContext
    shared = sc.broadcast(ranks)  # a vocabulary of fixed size
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, -(-size // BUCKET_BYTES))  # grows with the input, so a bucket does not
    encoded = word_ids(block_words(docs, pattern, buckets), shared)

    def reassemble(key, codes: pa.Table, words: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(words.column("bucket")), kind="stable")
        words = words.take(pa.array(order))
        n = np.concatenate([from_planes(x) for x in words.column("lens").to_pylist()] or [np.zeros(0, np.uint32)]).astype(np.int64)
        flat = np.concatenate([from_planes(x) for x in words.column("ids").to_pylist()] or [np.zeros(0, np.uint32)]).astype(np.int32)
        at = np.cumsum(n) - n
        out = []
        for ids, lens, coded in zip(codes.column("ids").to_pylist(), codes.column("lens").to_pylist(), codes.column("codes").to_pylist()):
            own = from_planes(zlib.decompress(coded)).astype(np.int64)
            per_word = n[own] if len(own) else own
            tokens = flat[spread(per_word, at[own])] if len(own) else np.zeros(0, np.int32)
            ends = np.concatenate([[0], np.cumsum(per_word)])[np.concatenate([[0], np.cumsum(from_planes(lens).astype(np.int64))])]
            out.append(pa.table({"doc_id": pa.array(ids, pa.int64()), "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens))}))
        return pa.concat_tables(out)

    codes = block_codes(docs, pattern, buckets)
    return codes.groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(_left_only(reassemble), "doc_id long, ids array<int>")


def _left_only(f):
    """Skips groups without texts."""
    def run(key, left, right):
        return f(key, left, right) if left.num_rows else pa.table({"doc_id": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int32()))})
    return run


class TokenBytes:
    """The table of token bytes: one run of bytes with the start and length of each id."""

    def __init__(self, ranks: dict[bytes, int]):
        top = max(ranks.values(), default=-1) + 1
        tokens = [b""] * top
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lens = np.fromiter(map(len, tokens), np.int64, top)
        self.at = np.cumsum(self.lens) - self.lens
        self.all = np.frombuffer(b"".join(tokens), np.uint8)

    def join(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids in order, end of each id's bytes)."""
        lens = self.lens[ids]
        return self.all[spread(lens, self.at[ids])], np.cumsum(lens)


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``doc_id, ids, decoded`` (binary) from ``doc_id, ids``."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary of fixed size

    def run(batches):
        table = TokenBytes(shared.value)
        for batch in batches:
            decoded = [b.tobytes() for b in _decoded(batch.column("ids"), table)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def _decoded(ids: pa.ListArray, table: TokenBytes):
    """Bytes per row, a few rows at a time."""
    for a in range(0, len(ids), 256):
        part = ids.slice(a, 256)
        offsets = np.asarray(part.offsets).astype(np.int64)
        offsets -= offsets[0]
        data, ends = table.join(np.asarray(part.flatten()).astype(np.int64))
        cuts = np.concatenate([[0], ends])[offsets]
        yield from (data[x:y] for x, y in zip(cuts[:-1], cuts[1:]))


def digests(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of encoded rows, decoding them."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        table = TokenBytes(shared.value)
        for batch in batches:
            ids = batch.column("ids")
            ids_sha = [hashlib.sha256(np.asarray(ids[i].values).astype("<u4").tobytes()).hexdigest() for i in range(len(ids))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.list_value_length(ids).cast(pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array([hashlib.sha256(b.tobytes()).hexdigest() for b in _decoded(ids, table)], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


