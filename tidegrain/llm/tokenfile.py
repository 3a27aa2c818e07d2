"""Token-id files: an adaptive context-mixing range coder over independent blocks.

An id is predicted by three orders, each a distribution over ids: order 0 is the frequencies of the buffer's ids, which its
head holds; order 1 is the two ids that a block last saw after the id before, order 2 the one that it last saw after the
two before, and these adapt within the block. Weights mix the orders by context, which is how sure the long orders are and
whether they agree; they are fitted to how often each was the first that was right in the buffer, and its head holds them.
An id takes the part of the coder's range that is the first right long order's, any other its share of order 0's part.
Each block of BLOCK ids starts anew from what the head says and has a checksum, so a damaged or lost block costs no other. All blocks of a buffer are coded side by side,
one numpy lane each. Whatever the coder's range depends on is an integer, so that writing and reading agree on any machine.

File format: a folder of Parquet files whose rows (part, seq, n_ids, payload) hold one buffer of whole documents each;
payload: magic, then a head with counts, document ids and lengths, the distinct ids with their numbers in the buffer (their
shares of order 0 and their places, by frequency, follow from these) and, for those seen OFTEN times, the ids that most often follow them, the weights, block lengths and
checksums, then the blocks' bytes. A buffer of more than TWICE blocks has its head once more at its end, so that a damaged
head costs no block. Rows are in document order by (part, seq). A damaged block, or a head with no sound copy, raises
ValueError on reading.

Defined cases: a null text has no ids of its own, only the end id; documents are in order of doc_id, nulls last, ties
by a hash of the text; equal rows are documents of their own; a document longer than a buffer is a buffer of its own;
an empty table gives files without rows; extra columns, whatever their names, are left out.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrain.llm.bpe import byte_alphabet
from tidegrain.llm.common import HELD, LOWER, parts, save, strings, tidied

BLOCK, BUFFER, MAGIC = 4096, 4096 * 2048, b"TGTF5\0"
OFTEN, TWICE = 16, 64
SLOTS_BITS = 11  # of each long order's table
U8, U32, U64, I64 = np.uint8, np.uint32, np.uint64, np.int64
LEAST = np.array(1 << 32, U64)  # the coder's range after a settled step; constants of the steps are arrays, which numpy takes faster
LOW, HALF = LEAST - U64(1), np.array(32, U64)
ONE, TWO, FOUR, ALL = (np.array(x, U32) for x in (1, 2, 4, 2**32 - 1))
WEIGHTS, LOWEST = 12, 16  # bits of a weight, and the lowest: no order is ever certain
# by hits: the first order that was right
FIRST = np.array([3, 0, 1, 0, 2, 0, 1, 0], U8)
SPECIAL = b"<|"  # how the vocabulary's special tokens begin
LETTER = rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])"  # small letters of Latin-1, which no rule changes
PLAIN, RUNS = re.compile(rb"(?:[!-&(-@\[-`{-~]|" + LETTER + rb")+"), re.compile(LETTER + rb"+|[0-9]|[!-/:-@\[-`{-~]+")


class Start:
    """What every block starts from: the distinct ids by how often they occur, their numbers, and what most often follows each.

    Ids are coded by their places among the distinct ones, of which the most frequent is first. Shares of order 0 sum to 2^bits, each at least one.
    """

    def __init__(self, ids: np.ndarray, times: np.ndarray, follow: np.ndarray):
        self.ids, self.times, self.follow = ids, times, follow
        self.bits = 16 if len(ids) <= 1 << 13 else 20
        k, total = len(ids), 1 << self.bits
        share = 1 + times.astype(I64) * (total - k) // int(times.sum())
        share[np.argmax(share)] += total - share.sum()
        cum = np.concatenate([[0], np.cumsum(share, dtype=np.int64)])
        self.cum, self.size = cum[:-1].astype(U64), share.astype(U64)
        self.place = np.repeat(np.arange(len(ids), dtype=U32), share)  # of each point of the order-0 range

    @staticmethod
    def of(ids: np.ndarray) -> tuple[Start, np.ndarray]:
        """The start of a buffer, and its ids as places."""
        top = int(ids.max())
        if top < 1 << 24:
            n = np.bincount(ids)
            distinct = np.flatnonzero(n)
            distinct = distinct[by_number(n[distinct])]
            n = n[distinct]
            place = np.zeros(top + 1, U32)
            place[distinct] = np.arange(len(distinct), dtype=U32)
            at = place[ids]
        else:
            distinct, at, n = np.unique(ids, return_inverse=True, return_counts=True)
            order = by_number(n)
            place = np.empty(len(n), U32)
            place[order] = np.arange(len(n), dtype=U32)
            distinct, at, n = distinct[order], place[at], n[order]
        k = len(distinct)
        if 2 * k > 1 << 20:
            raise ValueError(f"{k} distinct ids in a buffer: the file format is for vocabularies of up to 2^19")
        # the two ids that follow each id most often
        kind = U32 if k * k < 1 << 32 else U64
        pairs = np.sort(at[:-1].astype(kind) * kind(k) + at[1:])
        edge = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, I64)
        m, pairs = np.diff(np.append(edge, len(pairs))), pairs[edge].astype(I64)
        own, order = pairs // k, np.lexsort((-m, pairs // k))
        own, then = own[order], pairs[order] % k
        head = np.concatenate([[True], own[1:] != own[:-1]]) if len(own) else np.zeros(0, bool)
        next_ = np.concatenate([[False], head[:-1]]) & ~head if len(own) else head
        follow = np.zeros((k, 2), U32)
        follow[own[head]] = then[head, None]
        follow[own[next_], 1] = then[next_]
        follow[~Start.told(n)] = 0
        return Start(distinct.astype(U32), n.astype(U64), follow), at.astype(U32)

    @staticmethod
    def told(times: np.ndarray) -> np.ndarray:
        """The places whose followers the head holds."""
        return (times >= OFTEN) & (np.arange(len(times)) < 1 << SLOTS_BITS)

    def arrays(self) -> list[bytes]:
        """Ids by their distances, and their numbers, in order of ids; followers by their places."""
        by = np.argsort(self.ids)
        return [packed(np.diff(self.ids[by], prepend=U32(0)), "<u4"), packed(self.times[by], "<u8"), packed(self.follow[Start.told(self.times)].ravel(), "<u4")]

    @staticmethod
    def of_arrays(data: list[bytes]) -> Start:
        ids, times = np.cumsum(unpacked(data[0], "<u4"), dtype=U32), unpacked(data[1], "<u8")
        by = by_number(times)
        s = Start(ids[by], times[by], np.zeros((len(ids), 2), U32))
        s.follow[Start.told(s.times)] = unpacked(data[2], "<u4").reshape(-1, 2)
        return s


def by_number(times: np.ndarray) -> np.ndarray:
    """The order of places: most frequent ids first, so that what is often looked up lies close together."""
    return np.argsort(-times.astype(I64), kind="stable")


def packed(x: np.ndarray, kind: str) -> bytes:
    """An array's bytes compressed: the lowest byte of all numbers, then the next of all."""
    kind = np.dtype(kind)
    return zlib.compress(np.ascontiguousarray(x.astype(kind)).view("u1").reshape(len(x), kind.itemsize).T.tobytes(), 9)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    kind = np.dtype(kind)
    flat = np.frombuffer(zlib.decompress(data), "u1")
    return np.ascontiguousarray(flat.reshape(kind.itemsize, -1).T).view(kind).ravel()


class Model:
    """The predictions of one lane per block; encoder and decoder take the same steps. Entries are place << 2 | confidence.

    An order's slots of one lane lie side by side, those of frequent places first, which keeps them in the processor's cache.
    """

    SPREAD, MIXED = np.array(0x9E3779B1, U32), np.array(0x27D4EB2F, U32)
    SHIFT, SLOTS = np.array(32 - SLOTS_BITS, U32), np.array((1 << SLOTS_BITS) - 1, U32)

    def __init__(self, lanes: int, start: Start):
        slots = 1 << SLOTS_BITS
        one = np.ones((slots, 2), U32)
        k = min(len(start.ids), slots)
        one[:k] |= start.follow[:k] << TWO
        self.table = np.zeros(lanes * slots * 3, U32)  # order 2: one entry a slot; then order 1: two
        self.table[lanes * slots :].reshape(lanes, -1)[:] = one.ravel()
        far, near = np.arange(lanes) * slots, lanes * slots + np.arange(lanes) * slots * 2
        self.base = np.stack([far, near, near])

    def slots(self, before: np.ndarray, prev: np.ndarray) -> np.ndarray:
        """Of each lane where the entry of order 2 and the two of order 1 are, by the two places before."""
        far, at = prev * self.SPREAD, np.empty((*prev.shape[:-1], *self.base.shape), U32)
        far ^= before
        far *= self.MIXED
        np.right_shift(far, self.SHIFT, out=at[..., 0, :])
        np.bitwise_and(prev, self.SLOTS, out=far)
        np.left_shift(far, ONE, out=at[..., 1, :])
        np.bitwise_or(at[..., 1, :], ONE, out=at[..., 2, :])
        at = at.astype(I64)
        at += self.base
        return at

    def learn(self, at: np.ndarray, e: np.ndarray, fresh: np.ndarray) -> None:
        """fresh: the entries of the places that came. An entry that was right is surer, another less so, or fresh if it wasn't sure.

        What is chosen lane by lane is chosen by masks of all bits, as no branch foresees it.
        """
        old, new = e[:2], np.empty_like(e)
        hit = ((old ^ fresh) < FOUR) * ALL
        kept = old & TWO
        kept = (kept > 0) * ALL
        kept |= hit
        step = hit & TWO
        step -= ONE
        step += old
        most = ~hit
        most |= fresh | TWO
        np.minimum(step, most, out=step)
        step ^= fresh
        step &= kept
        np.bitwise_xor(step, fresh, out=new[:2])
        second = fresh ^ e[2]
        second &= hit[1]
        second ^= fresh
        second ^= e[1]
        second &= kept[1]
        np.bitwise_xor(second, e[1], out=new[2])
        self.table[at] = new


def context(e0: np.ndarray, e1: np.ndarray, e2: np.ndarray) -> np.ndarray:
    """4 times the number of the context."""
    kind = e1.astype("u1")
    kind &= U8(3)
    kind <<= U8(4)
    kind |= e0.astype("u1") << U8(6)
    kind |= ((e0 ^ e1) < FOUR).view("u1") << U8(2)
    kind |= ((e0 ^ e2) < FOUR).view("u1") << U8(3)
    return kind


class Coder:
    """The range coder's lanes: 64-bit registers that shed 32 bits whenever the upper half is settled."""

    def __init__(self, lanes: int):
        self.low, self.rng = np.zeros(lanes, U64), np.full(lanes, 2**64 - 1, U64)
        self.lanes, self.at = lanes, np.arange(lanes, dtype=I64)  # the next 32 bits are at this place, then lanes further on

    def settle(self, a: int, move) -> None:
        """Lanes of a range under LEAST shed 32 bits, after which it is at least that; it is cut where they aren't settled."""
        r = self.rng[:a]
        go = np.flatnonzero(r < LEAST)
        lo, at = self.low.take(go), self.at.take(go)
        r = np.minimum(r.take(go), LEAST - (lo & LOW))
        move(go, lo, at)
        self.at[go] = at + self.lanes
        self.low[go], self.rng[go] = lo << HALF, r << HALF


def fitted(hist: np.ndarray, last: int) -> np.ndarray:
    """The weights of the long orders in each context, of 2^WEIGHTS in all: how often each was the first that was right."""
    n = np.bincount(hist[: len(hist) // 2 * 2].ravel().view("<u2"), minlength=1 << 16).reshape(256, 256)
    n = n.sum(0) + n.sum(1) + np.bincount(hist[len(hist) // 2 * 2 :].ravel(), minlength=256)
    n -= np.bincount(hist[last:, -1], minlength=256)  # the last lane ends early
    n = n.reshape(64, 4)
    return LOWEST + n[:, :3] * ((1 << WEIGHTS) - 4 * LOWEST) // np.maximum(n.sum(1, keepdims=True), 1)


def shares(weights: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For each context and order: where its part of the range begins, and its size; for order 0 the size of one of its points."""
    every = np.concatenate([weights, (1 << WEIGHTS) - weights.sum(1, keepdims=True)], axis=1).astype(U64)
    begin = (np.cumsum(every, axis=1, dtype=U64) - every) << U64(bits)
    every[:, :3] <<= U64(bits)
    return begin.ravel(), every.ravel()


def encode_blocks(at: np.ndarray, start: Start) -> tuple[list[bytes], np.ndarray]:
    """The coded blocks of ids, given as places, and the weights they are coded with."""
    n = len(at)
    lanes, steps = -(-n // BLOCK), min(BLOCK, n)
    flat = np.zeros(lanes * BLOCK, U32)
    flat[:n] = at
    grid = np.zeros((2 + steps, lanes), U32)  # two places of 0 come before each block's
    grid[2:] = flat.reshape(lanes, BLOCK).T[:steps]
    last = n - (lanes - 1) * BLOCK
    m, hist = Model(lanes, start), np.empty((steps, lanes), "u1")
    for some in range(0, steps, 32):
        x = grid[some + 2 : some + 34]
        at = m.slots(grid[some : some + len(x)], grid[some + 1 : some + 1 + len(x)])
        fresh, seen = x << TWO | ONE, np.empty(at.shape, U32)
        for slots, e, came in zip(at, seen, fresh, strict=True):
            m.table.take(slots, out=e, mode="clip")
            m.learn(slots, e, came)
        e0, e1, e2 = seen[:, 0], seen[:, 1], seen[:, 2]
        hit = [((e ^ fresh) < FOUR).view("u1") for e in (e0, e1, e2)]
        hist[some : some + 32] = context(e0, e1, e2) | FIRST.take(hit[0] | hit[1] << U8(1) | hit[2] << U8(2))
    weights = fitted(hist, last)
    begin, size = shares(weights, start.bits)
    c = Coder(lanes)
    out = np.zeros((2 * steps + 4) * lanes, "<u4")  # lane by lane for each place; an id takes 32 bits at most, and what the range loses by rounding

    def emit(sel, lo, at):
        out[at] = lo >> HALF

    shift = U64(start.bits + WEIGHTS)
    for some in range(0, steps, 32):
        kind = hist[some : some + 32]
        below, own = begin.take(kind), size.take(kind)
        rest = np.flatnonzero(kind & U8(3) == U8(3))
        x, w = grid[some + 2 : some + 34].ravel().take(rest), own.ravel().take(rest)
        below.ravel()[rest] += w * start.cum.take(x)
        own.ravel()[rest] = w * start.size.take(x)
        for t, lower, part in zip(range(some, steps), below, own, strict=False):
            a = lanes if t < last else lanes - 1
            r = c.rng[:a] >> shift
            c.low[:a] += r * lower[:a]
            c.rng[:a] = r * part[:a]
            c.settle(a, emit)
    for s in (32, 0):
        out[c.at] = (c.low >> U64(s)) & U64(2**32 - 1)
        c.at += lanes
    sizes = c.at // lanes
    out = np.ascontiguousarray(out.reshape(-1, lanes)[: sizes.max()].T)
    return [out[i, : sizes[i]].tobytes() for i in range(lanes)], weights


def decode_blocks(blocks: list[bytes], n: int, start: Start, weights: np.ndarray) -> np.ndarray:
    """The places of all ids."""
    lanes = len(blocks)
    width = max(map(len, blocks)) // 4 + 4
    data = np.zeros((lanes, width), "<u4")
    for i, b in enumerate(blocks):
        data[i, : len(b) // 4] = np.frombuffer(b, "<u4", len(b) // 4)
    data = np.ascontiguousarray(data.T).ravel()
    grid = np.zeros((BLOCK + 2, lanes), U32)  # two places of 0 come before each block's
    m, c = Model(lanes, start), Coder(lanes)
    code = data[:lanes].astype(U64) << U64(32) | data[lanes : 2 * lanes]
    c.at += 2 * lanes

    def refill(sel, lo, at):
        code[sel] = code.take(sel) << HALF | data.take(at, mode="clip")

    begin, size = shares(weights, start.bits)
    ends = (begin.reshape(64, 4)[:, 1:] >> U64(start.bits)).astype(I64)
    orders = (np.arange(1 << WEIGHTS) >= ends[:, :, None]).sum(1, dtype="u1").ravel()  # by context and part of the range
    bits, shift, top = np.array(start.bits, U64), np.array(start.bits + WEIGHTS, U64), np.array((1 << WEIGHTS) - 1, I64)
    e, every, three = np.zeros((4, lanes), U32), np.arange(lanes), np.array(3, "u1")
    for t in range(min(BLOCK, n)):  # the last lane goes on behind its end, where nobody reads it
        at = m.slots(grid[t], grid[t + 1])
        m.table.take(at, out=e[:3], mode="clip")
        kind = context(e[0], e[1], e[2]).astype(I64)
        r = c.rng >> shift
        v = code - c.low
        v //= r
        place = (v >> bits).view(I64)
        np.minimum(place, top, out=place)
        place += kind << np.int64(WEIGHTS - 2)
        order = orders.take(place)
        kind += order
        lower, part = begin.take(kind), size.take(kind)
        x = e.ravel().take(order * np.int64(lanes) + every) >> TWO
        rest = np.flatnonzero(order == three)
        w, under = part.take(rest), lower.take(rest)
        v = v.take(rest)
        v -= under
        v //= w
        own = start.place.take(v.view(I64), mode="clip")
        x[rest] = own
        lower[rest] = under + w * start.cum.take(own)
        part[rest] = w * start.size.take(own)
        lower *= r
        c.low += lower
        np.multiply(r, part, out=c.rng)
        c.settle(lanes, refill)
        grid[t + 2] = x
        fresh = x << TWO
        fresh |= ONE
        m.learn(at, e[:3], fresh)
    return np.ascontiguousarray(grid[2:].T).ravel()[:n]


def pack(doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    """One buffer of whole documents as bytes."""
    start, at = Start.of(ids) if len(ids) else (None, ids)
    blocks, weights = encode_blocks(at, start) if start else ([], None)
    sums = [zlib.crc32(ids[i : i + BLOCK].astype("<u4").tobytes()) for i in range(0, len(ids), BLOCK)]
    known = np.array([d is not None for d in doc_ids], "u1")
    arrays = [packed(known, "u1"), packed(np.diff(np.array([d or 0 for d in doc_ids], "<i8"), prepend=np.int64(0)), "<i8"), packed(np.array(lengths, "<u8"), "<u8"), packed(np.array([len(b) for b in blocks], "<u4"), "<u4"), np.array(sums, "<u4").tobytes()]
    arrays += [*start.arrays(), packed(weights.ravel(), "<u2")] if start else [b""] * 4
    head = b"".join([struct.pack("<QII9I", len(ids), len(doc_ids), len(blocks), *map(len, arrays)), *arrays])
    check = struct.pack("<QI", len(head), zlib.crc32(head))
    return b"".join([MAGIC, check, head, *blocks, *([head, check, MAGIC] if len(blocks) > TWICE else [])])


def head_of(data: bytes) -> tuple[bytes, int | None, int | None]:
    """The head, and where the blocks begin or, where the copy at the end was taken, where they end."""
    size = len(MAGIC) + 12
    places = [(data[: len(MAGIC)], data[len(MAGIC) : size], True), (data[-len(MAGIC) :], data[-size : -len(MAGIC)], False)]
    if all(m != MAGIC for m, _, _ in places):
        raise ValueError("not a token file")
    for magic, check, first in places:
        if magic != MAGIC or len(check) != 12:
            continue
        room, crc = struct.unpack("<QI", check)
        at = size if first else len(data) - size - room
        if at >= 0 and zlib.crc32(head := data[at : at + room]) == crc and len(head) == room:
            return head, at + room if first else None, None if first else at
    raise ValueError("the head is damaged")


def unpack(data: bytes) -> tuple[list, list[int], np.ndarray]:
    head, begin, end = head_of(data)
    n, _, count, *rooms = struct.unpack_from("<QII9I", head)
    cuts = struct.calcsize("<QII9I") + np.concatenate([[0], np.cumsum(rooms, dtype=np.int64)])
    arrays = [head[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    known, ids, lengths, sizes = (unpacked(x, kind) for x, kind in zip(arrays, ("u1", "<i8", "<u8", "<u4"), strict=False))
    ids, sums = np.cumsum(ids), np.frombuffer(arrays[4], "<u4")
    start = Start.of_arrays(arrays[5:8]) if n else None
    begin = end - int(sizes.sum(dtype=np.int64)) if begin is None else begin
    ends = begin + np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    out = np.zeros(0, U32)
    if n:
        out = start.ids[decode_blocks([data[ends[i] : ends[i + 1]] for i in range(count)], n, start, unpacked(arrays[8], "<u2").reshape(64, 3).astype(I64))]
    for i in range(count):
        if zlib.crc32(out[i * BLOCK : (i + 1) * BLOCK].astype("<u4").tobytes()) != sums[i]:
            raise ValueError(f"block {i} is damaged")
    return [int(d) if k else None for d, k in zip(ids, known, strict=True)], lengths.tolist(), out


class Encoder(dict):
    """Whole texts to ids with the tokenizers library; pieces between spaces are encoded once and held, piece to ids.

    The vocabulary's rules turn white space into one space and never join what a space parts, so a text's ids are those
    of its pieces in a row. Pieces are held in lower case, as the vocabulary's rules take them, but for those that may hold
    one of its special tokens, which the library finds in the text as it is. In a piece of small Latin-1 letters and other
    printable ASCII signs without these tokens and without an apostrophe, the rules change nothing and part runs of letters,
    single digits and runs of signs, so the library's model takes the bytes of each of these; other pieces go through the
    whole library. Of many texts these units are found and told apart by numpy, so that each distinct one is looked up once,
    and the model takes all new runs in one call. When half of LIMIT pieces are held, they become the old ones, and only those that come again stay.
    """

    LIMIT = 800_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.model = self.lib.model.tokenize
        self.signs = {b: c for c, b in byte_alphabet().items()}
        self.letters = {b: c for b, c in self.signs.items() if b != 32}
        self.runs = Tokenizer(self.lib.model)  # the model alone, for runs with spaces between them
        self.runs.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        suffix = self.lib.model.end_of_word_suffix or "</w>"
        self.last = np.zeros(1 + max(self.lib.get_vocab().values()), bool)
        self.last[[i for t, i in self.lib.get_vocab(False).items() if t.endswith(suffix)]] = True
        self.four = [i.to_bytes(4, "little") for i in range(1 + max(self.lib.get_vocab().values()))]
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, p: bytes) -> bytes:
        got = self.old.get(p)
        if got is None:
            got = self.learn(p)
        if len(self) >= self.LIMIT // 2:
            self.old = dict(self)
            self.clear()
        self[p] = got
        return got

    def learn(self, p: bytes) -> bytes:
        if p.isalpha():
            ids = [t.id for t in self.model(p.decode())]
        elif p[-1:] in (b",", b".") and p[:-1].isalpha():
            return self[p[:-1]] + self[p[-1:]]
        elif PLAIN.fullmatch(p) and SPECIAL not in p:
            runs = RUNS.findall(p)
            if len(runs) > 1:
                return b"".join([self[r] for r in runs])
            ids = [t.id for t in self.model(p.decode("latin-1").translate(self.signs))]
        else:
            ids = self.lib.encode([p.decode()], is_pretokenized=True, add_special_tokens=False).ids if p else []
        return b"".join([self.four[i] for i in ids])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """ids of each text as little-endian 32-bit integers."""
        flat, lengths = self.encode_many([t.encode("utf-8") for t in texts])
        ends = 4 * np.cumsum(lengths)
        data = flat.tobytes()
        return [data[b - 4 * n : b] for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)]

    def encode_many(self, texts: list[bytes], end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each with the ids of end behind it, and how many there are of each text.

        Units are what the model takes alone: runs of plain pieces, and other pieces whole. Each distinct one is looked up once.
        """
        marked = [i for i, t in enumerate(texts) if SPECIAL in t]  # these go piece by piece
        apart = {i: self.encode(texts[i].decode()) for i in marked}
        data = b"\n".join([*(b"" if i in apart else t.replace(b"\n", b" ") for i, t in enumerate(texts)), b""]).translate(LOWER)
        begin, size, kind = units(data)
        rep = alike(data, begin, size)
        first = np.flatnonzero(rep == np.arange(len(rep), dtype=rep.dtype))
        number = np.zeros(len(rep), np.int32)
        number[first] = np.arange(len(first), dtype=np.int32)
        own, at = number.take(rep), begin[first]
        held = self.all_of([data[i:j] for i, j in zip(at.tolist(), (at + size[first]).tolist(), strict=True)], kind[first] == OTHER, end)
        many = np.fromiter(map(len, held), np.int32, len(held)) // 4
        pool, before = np.frombuffer(b"".join(held), "<u4"), np.cumsum(many, dtype=I64) - many
        each = many.take(own)
        till = np.cumsum(each, dtype=I64)
        flat = pool.take(np.repeat(before.take(own) - till + each, each) + np.arange(int(till[-1]) if len(till) else 0))
        lengths = np.diff(till[kind == END], prepend=0)
        if marked:
            own = np.split(flat, np.cumsum(lengths)[:-1])
            for i, ids in apart.items():
                own[i] = np.frombuffer(ids + end, "<u4")
            flat, lengths = np.concatenate(own), np.array([len(x) for x in own], I64)
        return flat, lengths

    def all_of(self, pieces: list[bytes], odd: np.ndarray, end: bytes) -> list[bytes]:
        """What stands for each unit; the model takes all plain ones that aren't held in few calls."""
        held = list(map(self.get, pieces))
        fresh = [i for i, x in enumerate(held) if x is None]
        for i in fresh:
            held[i] = self.old.get(pieces[i]) if pieces[i] != b"\n" else end
        new = [i for i in fresh if held[i] is None and not odd[i]]
        for k in range(0, len(new), 50_000):
            some = new[k : k + 50_000]
            ids = np.array(self.runs.encode_batch_fast([b" ".join([pieces[i] for i in some]).decode("latin-1").translate(self.letters)], add_special_tokens=False)[0].ids, "<u4")
            cuts = 4 * (1 + np.flatnonzero(self.last.take(ids)))
            if len(cuts) != len(some):  # a vocabulary without ends of words
                break
            data, a = ids.tobytes(), 0
            for i, b in zip(some, cuts.tolist(), strict=True):
                held[i] = data[a:b]
                a = b
        for i in fresh:
            p = pieces[i]
            if held[i] is None:
                held[i] = self.learn(p)
            if p != b"\n":
                self[p] = held[i]
            if len(self) >= self.LIMIT // 2:
                self.old = dict(self)
                self.clear()
        return held

    @staticmethod
    def pieces(text: bytes) -> list[bytes]:
        if SPECIAL not in text:
            return text.translate(LOWER).replace(b"\n", b" ").split(b" ")
        return [p if SPECIAL in p else p.translate(LOWER) for p in text.replace(b"\n", b" ").split(b" ")]

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pieces(text.encode("utf-8"))))


#: Of each byte: a space's, a Latin-1 letter's, a digit's or a sign's run, another piece's, the end of a text.
SPACE, SMALL, DIGIT, SIGN, OTHER, END = range(6)
KIND = bytearray([OTHER]) * 256
for _kind, _signs in ((SIGN, rb"!\"#$%&()*+,-./:;<=>?@[\]^_`{|}~"), (DIGIT, b"0123456789"), (SMALL, bytes(range(97, 123))), (SPACE, b" "), (END, b"\n")):
    for _sign in _signs:
        KIND[_sign] = _kind
SECOND = np.zeros(256, bool)  # what stands behind 0xc3 in a small letter
SECOND[[*range(0x9F, 0xB7), *range(0xB8, 0xC0)]] = True


def units(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the units of texts in lower case, each with a line break behind it, begin, their sizes and kinds; line breaks count as units."""
    b, kind = np.frombuffer(data, "u1"), np.frombuffer(bytearray(data.translate(KIND)), "u1")
    lead = np.flatnonzero(b == 0xC3)
    lead = lead[SECOND.take(b.take(lead + 1))]
    kind[lead] = kind[lead + 1] = SMALL
    if len(odd := np.flatnonzero(kind == OTHER)):  # the whole piece is one unit
        gaps = np.flatnonzero((kind == SPACE) | (kind == END))
        piece = np.unique(np.searchsorted(gaps, odd))
        begin = np.where(piece > 0, gaps.take(piece - 1, mode="clip") + 1, 0)
        size = gaps[piece] - begin
        kind[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())] = OTHER
    cut = np.ones(len(b), bool)
    np.not_equal(kind[1:], kind[:-1], out=cut[1:])
    cut |= (kind == DIGIT) | (kind == END)
    begin = np.flatnonzero(cut)
    size, kind = np.diff(begin, append=len(b)).astype(np.int32), kind.take(begin)
    real = np.flatnonzero(kind != SPACE)
    return begin[real], size[real], kind[real]


def alike(data: bytes, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each unit the number of one with the same bytes, the same for all of these; units of over 16 bytes stand for themselves.

    Units meet in the slots of a table by a hash and are compared there; those that meet others go on to the next table.
    """
    words = np.ndarray((len(data) + 9,), "<u8", data + bytes(16), strides=(1,))
    masks = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)
    w0, w1 = words[begin] & masks.take(np.minimum(size, 8)), np.zeros(len(begin), U64)
    more = np.flatnonzero(size > 8)
    w1[more] = words[begin[more] + 8] & masks.take(np.minimum(size[more] - 8, 8))
    rep, rest = np.arange(len(begin), dtype=np.int32), np.flatnonzero(size <= 16)
    slots, salt = np.zeros(1 << 20, np.int32), 0x9E3779B97F4A7C15
    a, b, n = w0[rest], w1[rest], size[rest]
    while len(rest):
        h = (a ^ (b + n.astype(U64)) * U64(0xD6E8FEB86659FD93)) * U64(salt)
        h = ((h ^ h >> U64(32)) * U64(salt) >> U64(44)).astype(I64)
        slots[h] = rest
        r = slots.take(h)
        same = (w0.take(r) == a) & (w1.take(r) == b) & (size.take(r) == n)
        rep[rest[same]] = r[same]
        over = np.flatnonzero(~same)
        rest, a, b, n = rest[over], a[over], b[over], n[over]
        salt = (salt + 0x2545F4914F6CDD1E) % 2**64 | 1
    return rep


def encoder(path: str) -> Encoder:
    """One encoder, with what it has learnt, for each Python worker and file."""
    held = HELD.setdefault("tokenfile", {})
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def write(docs: DataFrame, path: str, end: int = 1) -> DataFrame:
    """Writes the files of docs (doc_id, text) and returns them as (part, seq, n_ids, payload); path: the vocabulary file."""

    def run(batches):
        from pyspark import TaskContext

        enc, part, seq = encoder(path), TaskContext.get().partitionId(), 0
        stop = np.array([end], "<u4").tobytes()
        ids, data, size = [], [], 0

        def out():
            lengths = [len(d) for d in data]
            flat = np.concatenate(data)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([len(flat)], pa.int64()), pa.array([pack(ids, lengths, flat)], pa.binary())], names=["part", "seq", "n_ids", "payload"])

        def coded(ids, texts):
            flat, lengths = enc.encode_many(texts, stop)
            yield from zip(ids, np.split(flat, np.cumsum(lengths)[:-1]), strict=True)

        def coded_rows():
            for b in batches:
                some, room = ([], []), 0
                for d, t in zip(b.column(0).to_pylist(), strings(b.column(1)), strict=True):
                    some[0].append(d)
                    some[1].append(t)
                    room += len(t)
                    if room > 8_000_000:
                        yield from coded(*some)
                        some, room = ([], []), 0
                if some[0]:
                    yield from coded(*some)

        for d, own in coded_rows():
            if ids and size + len(own) > BUFFER:
                yield out()
                seq, ids, data, size = seq + 1, [], [], 0
            ids.append(d)
            data.append(own)
            size += len(own)
        if ids:
            yield out()

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("th")]
    d = d.repartitionByRange(parts(docs.sparkSession), *order).sortWithinPartitions(*order).select("doc_id", "text")
    return save(d.mapInArrow(tidied(run, "tokenfile"), "part int, seq long, n_ids long, payload binary"), "tokens")


def read(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files; start counts the ids of all files before."""
    per = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    per = per.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    marks = files.select("part", "seq", "n_ids").withColumn("local", F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    marks = marks.join(per, marks["part"] == per["p"]).select(F.col("part").alias("p"), F.col("seq").alias("s"), (F.col("base") + F.col("local")).alias("start"))
    rows = files.join(marks, (files["part"] == marks["p"]) & (files["seq"] == marks["s"])).select("start", "payload")

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                start = b.column(0)[i].as_py()
                docs, lengths, ids = unpack(b.column(1)[i].as_py())
                at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
                ids = ids.astype("<u4")
                crc = [zlib.crc32(ids[at[j] : at[j + 1]].tobytes()) for j in range(len(docs))]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(start + at[:-1], pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
