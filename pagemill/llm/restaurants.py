"""A word language model: a hierarchical Pitman-Yor process, seated by Gibbs sampling, that scores whole documents.

Every word that precedes another is a context with a restaurant of its own; all of them share the restaurant without
context as parent, whose own parent is uniform over the known words and one unknown. A customer is an occurrence of a
word in its context; the tables at which a word is served in a restaurant are its customers in the parent. A sweep takes
all customers of each dish from their tables and seats them anew at once, drawn from the posterior of their seatings (blocked
Gibbs sampling); predictive probabilities are averaged over the states of several rounds.

Work is dealt out twice. *Buckets* own pairs (word, context), by ranges of the word's hash; a word too common for one bucket is
dealt by word and context. *Owners* own words, by the same ranges: their counts, their restaurants' totals and their place in the parent. Tables
of a pair depend on others only through its restaurant's number of tables and the parent's probability of the word, so a round is
two steps: buckets seat all pairs, owners add up and seat the parent. Rows that Spark shuffles are ``letters`` with packed
arrays, one from each sender to each address: a word or pair comes at most once from a block of documents, however common.
"""

from __future__ import annotations

import functools
import math
import re
import struct
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Scratch, give_back, sampled, schema_of, small_batches, utf8

#: Tokens of a block of whole documents; text bytes of a bucket, and buckets at least; bytes of text encoded at once.
BLOCK, BUCKET_BYTES, BUCKETS, PIECE = 2_000_000, 16 << 20, 12, 1 << 20
#: Rounds that are not used and rounds whose states are averaged; each seats all customers anew.
BURN_IN, SAMPLES = 1, 2
#: Customers of a dish up to which its seatings are counted one customer after the other, numbers held at once there, and points of an integral beyond.
LISTED, HELD, POINTS = 2048, 1 << 20, 64
#: Strength of a context's restaurant and of the parent; discounts come from the counts, within these bounds.
STRENGTH, PARENT_STRENGTH, DISCOUNTS = 0.5, 1.0, (0.1, 0.95)
#: Documents that are looked at to find words too common for one bucket, and the most such words (8 bytes each, sent to all tasks).
LOOK_ROWS, WIDE_WORDS = 20_000, 100_000
SPACES, BLANKS = re.compile(rb"[\x20\x09-\x0D]"), b" \t\n\v\f\r"
BLANK = np.isin(np.arange(256), list(BLANKS))
#: No word holds a space: these stand for the end of a text and for what precedes its first word.
END, START = xxhash.xxh64_intdigest(b"\n"), xxhash.xxh64_intdigest(b" ")

LETTER = "to bigint, kind int, sender bigint, data binary, s1 double, s2 double, s3 double, s4 double"
#: Kinds of letters, in the order in which an address reads them.
PAIRS, MULTI, WORDS, OWNED, STATE, TABLES, ASK, ASK_MULTI, EXTRA, REPLY = range(10)
#: STATE, TABLES and EXTRA of round r are of kind STATES + 20 r + their own.
STATES, POSTINGS, DOCS, SUMS = 100, 100_000, 100_001, 100_002


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes: sorted hashes as differences, all by planes of equal significance."""
    parts = [struct.pack("<B", len(arrays))]
    for a in arrays:
        code = a.dtype.str[1:].encode()
        a = np.diff(a, prepend=a.dtype.type(0)) if code == b"u8" else np.ascontiguousarray(a)
        parts += [struct.pack("<2sQ", code, len(a)), np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).data]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(data: bytes, most: int = 256) -> list[np.ndarray]:
    """The arrays, or the first few of them."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    n, at, out = raw[0], 1, []
    for _ in range(min(n, most)):
        code, size = struct.unpack_from("<2sQ", raw, at)
        kind = np.dtype("<" + code.decode())
        at += 10
        planes = np.frombuffer(raw, np.uint8, size * kind.itemsize, at).reshape(kind.itemsize, size)
        at += size * kind.itemsize
        a = np.empty(size, kind)
        for k, plane in enumerate(planes):
            a.view(np.uint8).reshape(size, kind.itemsize)[:, k] = plane
        out.append(np.cumsum(a, dtype=kind) if code == b"u8" else a)
    return out


def small(a: np.ndarray) -> np.ndarray:
    """Counts and places in as few bytes as they need."""
    most = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if most < 256 else np.uint16 if most < 65536 else np.uint32 if most < 1 << 32 else np.int64)


def letter(to: int, kind: int, sender: int, data: bytes, *stats: float) -> tuple:
    return to, kind, sender, data, *stats, *(0.0,) * (4 - len(stats))


_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), *[pa.float64()] * 4]
_NAMES = [x.split()[0] for x in LETTER.split(", ")]


def posted(letters: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Letters as batches of bounded bytes."""
    held, size = [], 0
    for x in letters:
        held.append(x)
        size += len(x[3])
        if size > 8 << 20 or len(held) >= 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), _KINDS, strict=True)], _NAMES)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), _KINDS, strict=True)], _NAMES)


def delivered(letters: DataFrame, addresses: int, answer: Callable[[int, Iterator[tuple]], Iterator], ddl: str = LETTER) -> DataFrame:
    """What ``answer`` makes of each address's letters (kind, sender, data), which come by kind and sender."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            to, kind, sender = (batch.column(k).to_pylist() for k in range(3))
            for i in range(batch.num_rows):
                yield to[i], kind[i], sender[i], batch.column(3)[i].as_py()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def all_answers():
            for to, own in groupby(rows(batches), key=lambda x: x[0]):
                yield from answer(to, (x[1:] for x in own))

        try:
            yield from posted(all_answers()) if ddl == LETTER else all_answers()
        finally:
            give_back()

    dealt = letters.select("to", "kind", "sender", "data").repartition(addresses, "to").sortWithinPartitions("to", "kind", "sender")
    return dealt.mapInArrow(run, schema_of(ddl))


def address(keys: np.ndarray, n: int) -> np.ndarray:
    """The range of the hash space, one of ``n``, that a key falls into; larger keys never come earlier."""
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def by_address(keys: np.ndarray, n: int) -> Iterator[tuple[int, int, int]]:
    """(address, first, end) of the stretches of sorted keys."""
    to = address(keys, n)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(to)) + 1, [len(to)]]) if len(to) else np.zeros(1, np.int64)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(to[a]), int(a), int(b)


# ---- Blocks of documents -------------------------------------------------------------------------------------------


def turned(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def hashes_of(words: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 of the words that begin at ``first`` in an array of bytes: of words under 32 bytes step by step for all at once."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    data = np.concatenate([words, np.zeros(8, np.uint8)])
    eights, fours = (np.ndarray(len(data) - k + 1, f"<u{k}", data, strides=(1,)) for k in (8, 4))
    h = p5 + size.astype(np.uint64)
    for k in range(3):
        own = np.flatnonzero((size >= 8 * k + 8) & (size < 32))
        x = turned(eights[first[own] + 8 * k] * p2, 31) * p1
        h[own] = turned(h[own] ^ x, 27) * p1 + p4
    own = np.flatnonzero(size & 4)
    x = fours[first[own] + (size[own] & 24)].astype(np.uint64) * p1
    h[own] = turned(h[own] ^ x, 23) * p2 + p3
    for k in range(3):
        own = np.flatnonzero((size & 3) > k)
        x = data[first[own] + (size[own] & 28) + k].astype(np.uint64) * p5
        h[own] = turned(h[own] ^ x, 11) * p1
    h = (h ^ h >> np.uint64(33)) * p2
    h = (h ^ h >> np.uint64(29)) * p3
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(size >= 32):
        h[i] = xxhash.xxh64_intdigest(words[first[i] : first[i] + size[i]])
    return h


def pieces(text: bytes) -> Iterator[bytes]:
    """A text in stretches that end where a word does, so that a very long one is never encoded at once."""
    at = 0
    while at < len(text):
        found = SPACES.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = found.start() if found else len(text)
        yield text[at:end] if at or found else text
        at = end


class Block:
    """Tokens of whole documents as places in a sorted list of hashes."""

    def __init__(self):
        self.hashes, self.places = [np.array([START, END], np.uint64)], []
        self.known, self.size, self.rows = 2, 0, []
        self.held, self.bytes, self.ends = [], 0, []

    def add(self, row: tuple, text: bytes) -> None:
        for piece in pieces(text):
            self.held += piece, b" "
            self.bytes += len(piece) + 1
            self.encode(PIECE)
        self.held.append(b" ")
        self.bytes += 1
        self.ends.append(self.bytes)
        self.rows.append(row)
        self.encode(PIECE)

    def encode(self, least: int) -> None:
        """Words of the texts that are held, without a Python object for each, and the end of each text that ends there."""
        if self.bytes < least:
            return
        raw = b"".join(self.held)
        space = np.concatenate([[True], BLANK[np.frombuffer(raw, np.uint8)]])  # one more, before the first
        edge = np.flatnonzero(space[1:] != space[:-1])
        first, last = edge[::2], edge[1::2]
        offsets = np.concatenate([[0], np.cumsum(last - first)])
        words = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(raw.translate(LOWER, BLANKS))])
        coded = words.dictionary_encode()
        _, ends, data = coded.dictionary.buffers()
        ends = np.frombuffer(ends or bytes(8), np.int64, len(coded.dictionary) + 1)
        self.hashes.append(hashes_of(np.frombuffer(data or b"", np.uint8), ends[:-1], np.diff(ends)))
        place = np.insert(coded.indices.to_numpy() + np.int32(self.known), np.searchsorted(first, self.ends), 1)
        self.places.append(place)
        self.known += len(coded.dictionary)
        self.size += len(place)
        self.held, self.bytes, self.ends = [], 0, []

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, word, context, document): the last three one for each token."""
        self.encode(0)
        keys, at = np.unique(np.concatenate(self.hashes), return_inverse=True)
        at = at.astype(np.int32)
        place = np.concatenate(self.places)
        lengths = self.lengths = np.diff(np.flatnonzero(place == 1), prepend=-1)
        word = at[place]
        self.hashes, self.places = [], []
        context = np.concatenate([word[:1], word[:-1]])
        context[np.cumsum(lengths) - lengths] = at[0]
        return keys, word, context, np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)


def coded(first: np.ndarray, *more: tuple[int, np.ndarray]) -> np.ndarray:
    """Places of several lists as one sorted list of numbers, in one array."""
    codes = first.astype(np.int64)
    for size, place in more:
        codes *= size
        codes += place
    codes.sort()
    return codes


def runs(codes: np.ndarray) -> np.ndarray:
    """Where runs of equal sorted codes begin."""
    return np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)


def distinct(lists: list[np.ndarray]) -> np.ndarray:
    """What occurs in any of the lists, sorted; np.unique hashes, which takes several times longer."""
    x = np.sort(np.concatenate(lists))
    return x[runs(x)]


def dealt_pairs(keys: np.ndarray, word: np.ndarray, context: np.ndarray, n: int, wide: np.ndarray) -> np.ndarray:
    """The bucket of each pair: the word's range, or for a wide word that of a mixture with its context."""
    w = keys[word]
    to = address(w, n)
    if len(wide):
        often = np.isin(keys, wide)[word]
        mixed = (w[often] ^ (keys[context[often]] * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        to[often] = address(mixed, n)
    return to


def used(place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of a list of ``size`` that occur, and where each stands among them."""
    seen = np.zeros(size, bool)
    seen[place] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[place]


def pair_lists(w: np.ndarray, u: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted pairs as (words, pairs of each, contexts, context of each pair)."""
    first = runs(w)
    contexts, place = used(u, len(keys))
    return keys[w[first]], small(np.diff(np.append(first, len(w)))), keys[contexts], small(place)


def block_letters(batches: Iterator[pa.RecordBatch], n: int, wide: np.ndarray, emit: Callable[[Block, int], Iterator[tuple]]) -> Iterator[tuple]:
    """Blocks of a task's rows (id, learn, held_out, text); their numbers are the task's and their own."""
    block, number = Block(), TaskContext.get().partitionId() << 20
    try:
        for batch in batches:
            ids, learn, held, texts = batch.columns
            for i in range(batch.num_rows):
                block.add((ids[i].as_py(), learn[i].as_py(), held[i].as_py()), texts[i].as_py())
                if block.size >= BLOCK:
                    yield from emit(block, number)
                    block, number = Block(), number + 1
        if block.rows:
            yield from emit(block, number)
    finally:
        give_back()


def count_letters(n: int, wide: np.ndarray) -> Callable:
    """All pairs of a block with their occurrences in rows that are learned from, and the counts of words."""

    def emit(block: Block, number: int) -> Iterator[tuple]:
        keys, word, context, doc = block.arrays()
        learn = np.array([r[1] for r in block.rows], bool)
        own = learn[doc]
        counts = np.bincount(word[own], minlength=len(keys))
        counts[keys == START] = learn.sum()
        seen = np.flatnonzero(counts)
        for to, a, b in by_address(keys[seen], n):
            yield letter(to, WORDS, number, pack(keys[seen[a:b]], small(counts[seen[a:b]])))
        codes = coded(word, (len(keys), context), (2, own))
        del word, context, doc, own
        first = runs(codes >> 1)
        c = np.add.reduceat(codes & 1, first)
        pair = codes[first] >> 1
        word, context = np.divmod(pair, len(keys))
        to = dealt_pairs(keys, word, context, n, wide)
        order = np.argsort(to, kind="stable")
        to, word, context, c = to[order], word[order], context[order], c[order]
        cuts = np.append(runs(to), len(to))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield letter(int(to[a]), PAIRS, number, pack(*pair_lists(word[a:b], context[a:b], keys), small(c[a:b])))

    return lambda batches: posted(block_letters(batches, n, wide, emit))


def posting_letters(n: int, wide: np.ndarray) -> Callable:
    """All pairs of a block with their occurrences to learn from and the documents that hold them, and the documents themselves for the block's own address, -1 - number."""

    def emit(block: Block, number: int) -> Iterator[tuple]:
        keys, word, context, doc = block.arrays()
        docs, learn = len(block.rows), np.array([r[1] for r in block.rows], bool)
        ids = [r[0] for r in block.rows]
        null = np.array([i is None for i in ids], np.uint8)
        yield letter(-1 - number, DOCS, 0, pack(np.array([i or 0 for i in ids], np.int64), null, np.array([r[2] for r in block.rows], np.uint8), small(block.lengths)))
        codes = coded(word, (len(keys), context), (docs, doc))
        del word, context, doc
        first = runs(codes)
        times = small(np.diff(np.append(first, len(codes))))
        pair, doc = np.divmod(codes[first], docs)
        doc = small(doc)
        del codes, first
        start = runs(pair)
        each = np.diff(np.append(start, len(pair)))
        c = np.add.reduceat(np.where(learn[doc], times, 0).astype(np.int64), start)
        word, context = np.divmod(pair[start], len(keys))
        del pair
        to = dealt_pairs(keys, word, context, n, wide)
        order = np.argsort(to, kind="stable")
        rows = np.repeat(start[order], each[order]) + np.arange(len(doc)) - np.repeat(np.cumsum(each[order]) - each[order], each[order])
        to, word, context, c, each, doc, times = to[order], word[order], context[order], c[order], each[order], doc[rows], times[rows]
        ends = np.concatenate([[0], np.cumsum(each)])
        cuts = np.append(runs(to), len(to))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            x, y = ends[a], ends[b]
            yield letter(int(to[a]), POSTINGS, -1 - number, pack(*pair_lists(word[a:b], context[a:b], keys), small(c[a:b]), small(each[a:b]), small(doc[x:y]), small(times[x:y])))

    return lambda batches: posted(block_letters(batches, n, wide, emit))


# ---- Buckets and owners --------------------------------------------------------------------------------------------


def merged_pairs(letters: list[list[np.ndarray]]) -> tuple[np.ndarray, ...]:
    """Pairs of several lists as one, their counts added."""
    uw, uu = distinct([x[0] for x in letters]), distinct([x[2] for x in letters])
    codes = [np.repeat(np.searchsorted(uw, w) * len(uu), n) + np.searchsorted(uu, u)[k] for w, n, u, k, _ in letters]
    codes, c = np.concatenate(codes), np.concatenate([x[4].astype(np.int64) for x in letters])
    order = np.argsort(codes)
    codes, c = codes[order], c[order]
    first = runs(codes)
    return uw, uu, codes[first], np.add.reduceat(c, first) if len(first) else c


def counted(n: int) -> Callable:
    """Merges counts at each address: how many pairs occur once and twice, those that occur again, its words, and what it asks the owners."""

    def answer(to: int, letters: Iterator[tuple]) -> Iterator[tuple]:
        for kind, own in groupby(letters, key=lambda x: x[0]):
            lists = [unpack(data) for _, _, data in own]
            if kind == WORDS:
                x, at = np.unique(np.concatenate([k for k, _ in lists]), return_inverse=True)
                count = np.bincount(at, weights=np.concatenate([c for _, c in lists])).astype(np.int64)
                yield letter(to, WORDS, to, pack(x, small(count)))
                continue
            uw, uu, codes, c = merged_pairs(lists)
            yield letter(to, PAIRS, to, b"", float((c == 1).sum()), float((c == 2).sum()))
            w, u = np.divmod(codes, len(uu))
            asked = distinct([uw, uu])
            followers, before = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
            followers[np.searchsorted(asked, uu)] = np.bincount(u[c > 0], minlength=len(uu))
            before[np.searchsorted(asked, uw)] = np.bincount(w[c > 0], minlength=len(uw))
            for o, a, b in by_address(asked, n):
                yield letter(o, ASK, to, pack(asked[a:b], small(followers[a:b]), small(before[a:b])))
            again = c > 1
            if again.any():
                (ww, w), (wu, u) = used(w[again], len(uw)), used(u[again], len(uu))
                yield letter(to, MULTI, to, pack(uw[ww], uu[wu], small(w), small(u), small(c[again])))
                asked = distinct([uw[ww], uu[wu]])
                for o, a, b in by_address(asked, n):
                    yield letter(o, ASK_MULTI, to, pack(asked[a:b]))

    return answer


def added(x: np.ndarray, asked: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """Values by key as columns beside the sorted keys ``x``; keys that are not there are dropped."""
    at = np.searchsorted(x, asked)
    ok = at < len(x)
    ok[ok] = x[at[ok]] == asked[ok]
    return [np.bincount(at[ok], weights=c[ok], minlength=len(x)) for c in columns]


def owned(to: int, letters: Iterator[tuple]) -> Iterator[tuple]:
    """An owner's words: (hash, occurrences, distinct followers, distinct predecessors); sums of tokens, words, and of words with one and two predecessors."""
    x = None
    for kind, _, data in letters:
        if kind == WORDS:
            x, n = unpack(data)
            followers, before = np.zeros(len(x)), np.zeros(len(x))
        elif x is not None:
            f, b = added(x, *unpack(data))
            followers, before = followers + f, before + b
    if x is not None:
        real = x != np.uint64(START)
        yield letter(to, OWNED, to, pack(x, n, small(followers.astype(np.int64)), small(before.astype(np.int64))), float(n[real].sum()), float(real.sum()), float((before == 1).sum()), float((before == 2).sum()))


def log_ways(n: np.ndarray, tables: np.ndarray, discount: float) -> np.ndarray:
    """Logarithms of how many seatings of ``n`` customers have so many tables, each weighted by (size - 1 - discount) ... (1 - discount) of its tables.

    Up to a summand of ``n`` alone. They are n! / tables! times the coefficient of x ** n in ((1 - (1 - x) ** d) / d) ** tables: an integral along a
    parabola about the branch cut, through the saddle or near 1, by the trapezoidal rule, which here converges like a geometric series.
    """
    d = discount
    low, high = np.full(len(n), -80.0), np.zeros(len(n))
    for _ in range(60):  # the saddle, by the logarithm of its distance from 1
        z = (low + high) / 2
        above = np.log(tables * d) + np.log(-np.expm1(np.minimum(z, -1e-15))) + (d - 1) * z - np.log(-np.expm1(np.minimum(d * z, -1e-15))) > np.log(n)
        low, high = np.where(above, z, low), np.where(above, high, z)
    m = np.maximum(-np.log(-np.expm1(np.minimum(high, -1e-12))), 2 / n)
    width = np.minimum(2 + np.sqrt(20 / (n * m * (1 - d))), math.pi / (2 * m))
    step = 1 + 1j * np.linspace(0, 1, POINTS) * width[:, None]
    x = -m[:, None] * step**2
    e = tables[:, None] * np.log((1 - np.exp(d * np.log(-np.expm1(x)))) / d) - n[:, None] * x
    top = e[:, :1].real
    f = (step * np.exp(e - top)).real
    area = (f.sum(axis=1) - f[:, 0] / 2) * m * width
    return top[:, 0] + np.log(np.maximum(area, 1e-300)) - np.array([math.lgamma(t + 1) for t in tables])


def _crowd(c: int, a: float, discount: float, rng: np.random.Generator) -> int:
    """Tables of one dish with many customers: numbers about the mean, in cells of at most an eighth of their spread, of single numbers where that is small."""
    z = np.array([-200.0, 0.0])
    for _ in range(60):  # of sums weighted by a ** tables the saddle, as above
        y = z.mean()
        z[0 if math.log(a) + math.log(-math.expm1(min(y, -1e-15))) + (discount - 1) * y > math.log(c) else 1] = y
    y = math.exp(z[1])
    mean = a * -math.expm1(discount * z[1]) / discount
    spread = math.sqrt(max(1.0, mean - a * y**discount * (1 - y) / (y + (1 - discount) * (1 - y))))
    cell = max(1, int(spread / 8) // 2 * 2 - 1)
    first = max(1, int(mean - 9 * spread))
    middle = np.arange(min(first + cell // 2, c), min(c, int(mean + 9 * spread + 12)) + 1, cell).astype(float)
    weight = log_ways(np.full(len(middle), float(c)), middle, discount) + middle * math.log(a)
    share = np.cumsum(np.exp(weight - weight.max()))
    at = np.searchsorted(share, rng.random() * share[-1], "right")
    return int(min(c, middle[at] - cell // 2 + rng.integers(cell)))


@functools.lru_cache(maxsize=2)
def _kept(discount: float) -> dict[int, np.ndarray]:
    """Rows of numbers of ways that a worker keeps for the rounds and buckets to come: at most 16 MB for all up to LISTED."""
    return {1: np.zeros(1)}


def listed_ways(n: int, discount: float) -> np.ndarray:
    """Logarithms of the ways to seat ``n`` customers at 1 to n tables, counted one customer after the other from the nearest row kept."""
    rows = _kept(discount)
    if n not in rows:
        now = max(k for k in rows if k < n)
        ways = rows[now]
        for k in range(now, n):  # ways of k + 1 customers from those of k
            ways = np.logaddexp(np.append(ways + np.log(k - discount * np.arange(1, k + 1)), -np.inf), np.append(-np.inf, ways))
        rows[n] = ways
    return rows[n]


def seated(customers: np.ndarray, opening: np.ndarray, discount: float, rng: np.random.Generator, listed: int = LISTED) -> np.ndarray:
    """Numbers of tables of dishes, all customers of each seated anew; ``opening``: the weight of a new table, (strength + discount x tables) x probability.

    A seating's probability is the product of its tables' weights, that of one with k customers opening x (1 - discount) ... (k - 1 - discount).
    This draws from it, whatever the dish had before, as endless single moves of its customers would. Seatings by tables are counted one customer
    after the other for all dishes of up to ``listed``, then by an integral for each larger one, so that a very common pair takes no longer.
    """
    c = customers.astype(np.int64)
    tables = np.ones(len(c), np.int64)
    order = np.argsort(c, kind="stable")
    order = order[np.searchsorted(c[order], 2) :]
    cuts = np.append(runs(c[order]), len(order))
    for first, end in zip(cuts[:-1], cuts[1:], strict=True):
        n = int(c[order[first]])
        if n > listed:
            for i in order[first:]:
                tables[i] = _crowd(int(c[i]), float(opening[i]), discount, rng)
            break
        ways, t = listed_ways(n, discount), np.arange(1, n + 1)
        for at in range(first, end, max(1, HELD // n)):
            own = order[at : min(end, at + max(1, HELD // n))]
            share = ways + t * np.log(opening[own])[:, None]
            share = np.cumsum(np.exp(share - share.max(axis=1, keepdims=True)), axis=1)
            tables[own] = 1 + (share[:, :-1] <= (rng.random(len(own)) * share[:, -1])[:, None]).sum(axis=1)
    return tables


class Sums:
    """What is known of a round's whole state: customers and tables of the parent, and fixed numbers of the corpus."""

    def __init__(self, tokens: float, words: float, discount: float, parent_discount: float):
        self.tokens, self.words, self.discount, self.parent_discount = tokens, words, discount, parent_discount
        self.customers = self.tables = 0.0

    def parent(self, excess: np.ndarray) -> np.ndarray:
        """The parent's probabilities of words with so many discounted customers."""
        base = (PARENT_STRENGTH + self.parent_discount * self.tables) / (self.words + 1)
        return (excess + base) / (PARENT_STRENGTH + self.customers)


def owner_round(sums: Sums, r: int, seed: int) -> Callable:
    """Owners add the tables that buckets report, seat the parent, keep the state and answer what buckets ask of it."""

    def answer(to: int, letters: Iterator[tuple]) -> Iterator[tuple]:
        x, asked = None, {}
        for kind, sender, data in letters:
            if kind == OWNED:
                x, _, tables, customers = unpack(data)
                tables, customers = tables.astype(np.float64), customers.astype(np.float64)
            elif kind == ASK_MULTI:
                asked[sender] = unpack(data)[0]
            elif x is not None:
                t, c = added(x, asked[sender], *unpack(data))
                tables, customers = tables + t, customers + c
        excess = np.zeros(0)
        if x is not None:
            served = np.flatnonzero(customers > 0)
            opening = np.full(len(served), (PARENT_STRENGTH + sums.parent_discount * max(sums.tables, sums.words)) / (sums.words + 1))
            seats = seated(customers[served], opening, sums.parent_discount, np.random.default_rng([seed, r, 0, to]))
            excess = np.zeros(len(x))
            excess[served] = customers[served] - sums.parent_discount * seats
            yield letter(to, STATES + 20 * r + STATE, to, pack(small(tables.astype(np.int64)), excess), float(customers.sum()), float(seats.sum()))
        for sender, keys in asked.items():
            t, g = added(keys, x, tables, excess) if x is not None else (np.zeros(len(keys)),) * 2
            yield letter(sender, REPLY, to, pack(small(t.astype(np.int64)), g))

    return answer


def bucket_round(sums: Sums, n: int, r: int, seed: int) -> Callable:
    """Buckets seat their pairs that occur again and report the tables beyond the first."""

    def answer(to: int, letters: Iterator[tuple]) -> Iterator[tuple]:
        replies = []
        for kind, _, data in letters:
            if kind == MULTI:
                uw, uu, w, u, c = unpack(data)
            else:
                replies.append(unpack(data))
        keys = distinct([uw, uu])
        t, g = (np.concatenate(column) for column in zip(*replies, strict=True))
        at_w, at_u = np.searchsorted(keys, uw)[w], np.searchsorted(keys, uu)[u]
        opening = (STRENGTH + sums.discount * t[at_u]) * sums.parent(g[at_w])
        extra = seated(c, opening, sums.discount, np.random.default_rng([seed, r, 1, to])) - 1
        yield letter(to, STATES + 20 * r + TABLES, to, pack(small(extra)))
        of_u, of_w = (np.bincount(at, weights=extra, minlength=len(keys)).astype(np.int64) for at in (at_u, at_w))
        for o, a, b in by_address(keys, n):
            yield letter(o, STATES + 20 * r + EXTRA, to, pack(small(of_u[a:b]), small(of_w[a:b])))

    return answer


def final_replies(to: int, letters: Iterator[tuple]) -> Iterator[tuple]:
    """Owners answer for every word of a bucket: occurrences, and of each kept state tables and discounted customers."""
    x, states, asks = None, [], []
    for kind, sender, data in letters:
        if kind == OWNED:
            x, n, _, _ = unpack(data)
        elif kind >= STATES:
            states += unpack(data)
        else:
            asks.append((sender, data))
    for sender, data in asks:
        keys = unpack(data)[0]
        columns = [np.zeros(len(keys))] * (1 + 2 * SAMPLES) if x is None else added(keys, x, n, *states)
        yield letter(sender, REPLY, to, pack(*(small(c.astype(np.int64)) if k == 0 or k % 2 else c for k, c in enumerate(columns))))


def scored(sums: list[Sums]) -> Callable:
    """Buckets sum, for each block, what its documents owe to their pairs: (document, score, base, known tokens)."""

    def answer(to: int, letters: Iterator[tuple]) -> Iterator[tuple]:
        replies, tables, blocks = [], [], []
        for kind, sender, data in letters:
            if kind == DOCS:
                yield letter(to, DOCS, sender, data)
            elif kind == REPLY:
                replies.append(unpack(data))
            elif kind == POSTINGS:
                blocks.append((sender, data))
            else:
                tables.append(unpack(data)[0])
        if not blocks:
            return
        uw, uu, codes, c = merged_pairs([unpack(data, 5) for _, data in blocks])
        w, u = np.divmod(codes, len(uu))
        keys = distinct([uw, uu])
        n, *states = (np.concatenate(column) for column in zip(*replies, strict=True))
        at_w, at_u = np.searchsorted(keys, uw)[w], np.searchsorted(keys, uu)[u]
        mean = np.zeros(len(c))
        for s, now in enumerate(sums):
            t = np.minimum(c, 1)
            if tables:
                t[c > 1] += tables[s]
            room = STRENGTH + now.discount * states[2 * s][at_u]
            mean += (c - now.discount * t + room * now.parent(states[2 * s + 1])[at_w]) / (STRENGTH + n[at_u])
        score, base, known = np.log10(mean / len(sums)), np.log10(n + 1.0)[at_w], (n > 0)[at_w]
        del keys, states, replies, mean, at_w, at_u, w, u, c
        for sender, data in blocks:
            lw, size, lu, k, _, each, doc, times = unpack(data)
            own = np.repeat(np.searchsorted(uw, lw) * len(uu), size) + np.searchsorted(uu, lu)[k]
            own = np.searchsorted(codes, own)
            docs = np.flatnonzero(np.bincount(doc))
            total = [np.bincount(doc, weights=np.repeat(value[own], each) * times)[docs] for value in (score, base, known)]
            yield letter(sender, SUMS, to, pack(small(docs), total[0], total[1], small(total[2].astype(np.int64))))

    return answer


def finished(sums: Sums, id_col: str) -> tuple[Callable, str]:
    """Blocks add their documents' sums up."""

    def answer(_: int, letters: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        for kind, _, data in letters:
            if kind == DOCS:
                ids, null, held, n = unpack(data)
                score, base, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), np.int64)
            else:
                docs, s, b, k = unpack(data)
                score[docs] += s
                base[docs] += b
                known[docs] += k
        n = n.astype(np.int64)
        base -= n * np.log10(sums.tokens + sums.words + 1)
        columns = [pa.array(ids, pa.int64(), mask=null.astype(bool)), pa.array(held.astype(bool)), n, known, np.full(len(n), int(sums.tokens)), base, score, 10 ** (-score / n)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [x.split()[0] for x in ddl.split(", ")])

    ddl = f"{id_col} bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, perplexity double"
    return answer, ddl


# ---- The whole job -------------------------------------------------------------------------------------------------


def wide_words(texts: DataFrame, rows: int, buckets: int) -> np.ndarray:
    """Hashes of words with over an eighth of a bucket's share of tokens, judged on a bounded sample; they only change who does the work."""
    lower = F.translate(F.col("text").cast("string"), "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123))))
    look = texts.where(sampled(LOOK_ROWS / max(1, rows), "text"))
    words = look.select(F.explode(F.split(lower, r"[\x20\x09-\x0D]+")).alias("word")).where("word <> ''")
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = [r.word for r in counts.where(F.col("n") * 8 * buckets > total).orderBy(F.desc("n"), "word").limit(WIDE_WORDS).collect()]
    return np.sort(np.array([END, *(xxhash.xxh64_intdigest(w.encode()) for w in often)], np.uint64))


def score_texts(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", seed: int = 5) -> DataFrame:
    """One row per document: (id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity).

    Tokens are the words, A-Z lower-cased, and one end. ``base_score`` is the log10 probability by counts plus one, ``score`` that of the
    model, ``perplexity`` the latter's per token. Rows for which ``learn`` is true are learned from; ``held_out`` is where it is not.
    A null text counts as empty: its one token is the end. Repeated rows count and are scored each; null ids stay null. Where nothing is
    learned, every token is the one unknown word, of probability 1. Other columns are ignored; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    small_batches(spark)
    learn = F.coalesce(learn, F.lit(False))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), learn.alias("learn"), (~learn).alias("held_out"), utf8(text_col).alias("text"))
    rows, size = texts.agg(F.count("*"), F.sum(F.length("text"))).first()
    n = max(BUCKETS, (size or 0) // BUCKET_BYTES + 1)
    wide = wide_words(texts, rows, n)
    scratch, schema = Scratch(spark, "restaurants"), schema_of(LETTER)

    def of(frame: DataFrame, *kinds: int) -> DataFrame:
        return frame.where(F.col("kind").isin(*kinds))

    def total(frame: DataFrame, kind: int) -> list[float]:
        return [x or 0.0 for x in of(frame, kind).agg(*(F.sum(f"s{k}") for k in range(1, 5))).first()]

    def discount(one: float, two: float) -> float:
        return float(np.clip(one / max(1.0, one + 2 * two), *DISCOUNTS))

    counts = scratch.put(delivered(texts.mapInArrow(count_letters(n, wide), schema), n, counted(n)))
    owners = scratch.put(delivered(of(counts, WORDS, ASK), n, owned))
    scratch.release()
    one, two, *_ = total(counts, PAIRS)
    tokens, words, parent_one, parent_two = total(owners, OWNED)
    now = Sums(tokens, words, discount(one, two), discount(parent_one, parent_two))
    asks, reports, states, tables, kept = of(counts, ASK_MULTI), None, [], [], []
    for r in range(BURN_IN + SAMPLES + 1):
        incoming = owners.union(asks) if reports is None else owners.union(asks).union(reports)
        found = scratch.put(delivered(incoming, n, owner_round(now, r, seed)))
        customers, seats, *_ = total(found, STATES + 20 * r + STATE)
        now = Sums(now.tokens, now.words, now.discount, now.parent_discount)
        now.customers, now.tables = customers, seats
        if r > BURN_IN:
            states.append(of(found, STATES + 20 * r + STATE))
            kept.append(now)
        if r == BURN_IN + SAMPLES:
            break
        moved = scratch.put(delivered(of(counts, MULTI).union(of(found, REPLY)), n, bucket_round(now, n, r, seed)))
        reports = of(moved, STATES + 20 * r + EXTRA)
        if r >= BURN_IN:
            tables.append(of(moved, STATES + 20 * r + TABLES))
    scratch.release()
    replies = owners.union(of(counts, ASK))
    for state in states:
        replies = replies.union(state)
    letters = texts.mapInArrow(posting_letters(n, wide), schema).union(delivered(replies, n, final_replies))
    for t in tables:
        letters = letters.union(t)
    answer, ddl = finished(now, id_col)
    return delivered(delivered(letters, n, scored(kept)), n, answer, ddl)
