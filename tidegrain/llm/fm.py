"""Substring dedup: a compressed FM-index per shard, and windows of words that occur earlier.

A window is WINDOW consecutive words of one document. Windows that could repeat are routed by content: the window's
anchor is the least hash among its GRAM-word runs, so equal windows have equal anchors, and neighbouring windows with
one anchor travel as one segment of text. Only segments whose anchor occurs more than once travel at all.

A shard is a stretch of anchors, with all distinct segments of them: a segment that stands in several places is held once,
with its first place (document, then position) and how many there are. Its index is a Burrows-Wheeler transform over word
ids in a wavelet matrix for rank queries, suffix positions in 32 bits, and running sums of the numbers of places. The
segments are then streamed through the index: backward search, from the interval of the last SEED words on, gives for each
word that a whole window ends at its matching statistic, the length (up to WINDOW) of the longest run of words that ends
there and stands in more than one place. Runs that reach WINDOW are repeated windows; a window's first place is the
least in its suffix interval. What the search says of a segment holds for all of its places, so it is searched once; of
equal segments a task sends the first place and their number, and the later places are late as wholes, as the search of
the first finds (it stands in more places). Repeated windows are reported as intervals of words.

Anchors that very many places share (a passage in a third of all texts, a repeated word pair) would make one shard of
one key: their segments are cut into single windows (hot anchors are found beforehand, on one document in PROBED), dealt by the window's own hash, which is indexed and searched like
any other segment. Of equal segments or windows each task sends its first place only; they arrive sorted by place and
only the first is held, so one that stands in any number of places makes a row for each task.

A word is removed if a window that covers it also starts earlier: in a smaller doc_id (nulls last, then by a hash of the
text, for rows that share an id) or earlier in the same document. Windows are judged on the input. Equal rows (same id
and text) are one document with a result for each row. Null and empty texts have no words; texts are read whole, however
long; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tidegrain.llm.common import WordHash, docs_of, grams, mapped, mix, names, strings, tidied

WINDOW, GRAM, HEAVY, SHARD, CHUNK = 20, 6, 1024, 100_000, 100_000
#: One document in PROBED is looked at to find the anchors, HOT at most, that very many places share.
PROBED, HOT = 32, 2**16
SEED, LANES = 4, 8192  # words of a run whose interval is looked up; searches side by side, so many that they stay in a cache
NO_ID = 2**63 - 1


# --- routing


def runs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of a document's windows (word hashes a): hash and place of each run of windows with one anchor.

    A place holds the run's first window, from which word of it the anchor starts (4 bits), and its number of windows (4 bits).
    """
    g = grams(a, GRAM)
    n, span = len(a) - WINDOW + 1, WINDOW - GRAM + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2
    # leftmost least of each stretch of ``span`` hashes, by doubling
    best = np.arange(len(g))
    width = 1
    while width < span:
        step = min(width, span - width)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(g[right] < g[left], right, left)
        width += step
    first = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
    count = np.diff(np.concatenate([first, [n]]))
    return g[best[first]].view(np.int64), first << 8 | (best[first] - first) << 4 | count


def anchors(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """Rows (h, k, at): anchors of all runs; k names the document, at is the run's place in it. Runs of the sorted anchors
    ``hot`` have -1 - place, and for h a number that spreads them."""

    def run(batches):
        w = WordHash()
        for b in batches:
            hs, ks, at = [], [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = t.split()
                if len(words) >= WINDOW:
                    h, place = runs(w.of(words))
                    if len(hot):
                        known = hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h
                        h = np.where(known, mix(place.astype(np.uint64) + np.uint64(k & (2**64 - 1))).view(np.int64), h)
                        place = np.where(known, -1 - place, place)
                    hs.append(h)
                    ks.append(np.full(len(h), k, np.int64))
                    at.append(place)
            if hs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (hs, ks, at)], names=["h", "k", "at"])

    return docs.select("k", "text").mapInArrow(tidied(run), "h long, k long, at long")


def hot_anchors(docs: DataFrame, heavy: int) -> np.ndarray:
    """Anchors that more than about ``heavy`` places share, by one document in PROBED; the HOT of them that most share, sorted.

    They only choose a way: any set gives the same windows, as long as all places of an anchor go the same way.
    """
    some = docs.where(F.pmod(F.xxhash64(F.col("k"), F.lit(1)), F.lit(PROBED)) == 0)
    many = anchors(some, np.zeros(0, np.int64)).groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") * PROBED > heavy).where("n > 8")
    return np.sort(np.array([r["h"] for r in many.orderBy(F.desc("n"), "h").limit(HOT).collect()], np.int64))


def repeated(docs: DataFrame, heavy: int) -> DataFrame:
    """Rows (k, at): for each document the places of its runs whose anchor is repeated; -1 - place where it is in more than
    ``heavy`` places. Places come sorted by anchor and are read once; at most ``heavy`` and a batch are held. Places of hot
    anchors are known to be such where they are made, and spread over all tasks."""

    def out(k, at, hard):
        return pa.RecordBatch.from_arrays([pa.array(k), pa.array(np.where(hard, -1 - at, at))], names=["k", "at"])

    def run(batches):
        none = np.zeros(0, np.int64)
        held, hot = (none, none, none), None  # the anchor of the last rows; its hash once it is known to be heavy
        for b in batches:
            new = [b.column(i).to_numpy() for i in range(3)]
            if (known := new[2] < 0).any():
                yield pa.RecordBatch.from_arrays([pa.array(new[1][known]), pa.array(new[2][known])], names=["k", "at"])
                new = [x[~known] for x in new]
            h, k, at = (np.concatenate(x) for x in zip(held, new, strict=True))
            if hot is not None:
                n = int(np.searchsorted(h, hot, side="right"))
                yield out(k[:n], at[:n], True)
                h, k, at = h[n:], k[n:], at[n:]
                hot = hot if not len(h) else None
            if not len(h):
                held = (none, none, none)
                continue
            cut = int(np.searchsorted(h, h[-1]))
            yield from whole(h[:cut], k[:cut], at[:cut])
            held = h[cut:], k[cut:], at[cut:]
            if len(held[0]) > heavy:
                yield out(held[1], held[2], True)
                hot, held = int(h[-1]), (none, none, none)
        yield from whole(*held)

    def whole(h, k, at):
        if len(h):
            edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]]))
            size = np.repeat(np.diff(edge), np.diff(edge))
            more = size > 1
            yield out(k[more], at[more], size[more] > heavy)

    dealt = anchors(docs, hot_anchors(docs, heavy)).repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(tidied(run), "k long, at long").groupBy("k").agg(F.collect_set("at").alias("at"))


def packed(docs: DataFrame) -> DataFrame:
    """docs with the column text as zstd bytes, which halves what a shuffle moves."""
    at = docs.columns.index("text")

    def run(batches):
        c = zstandard.ZstdCompressor(level=3)
        for b in batches:
            cols = list(b.columns)
            cols[at] = pa.array([None if t is None else c.compress(t) for t in strings(cols[at])], pa.binary())
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    schema = StructType([f if f.name != "text" else StructField("text", BinaryType()) for f in docs.schema])
    return mapped(docs, run, schema)


def segments(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows (key, name, text, doc, k, start, n, copies): segments of documents' repeated anchors, with n windows each.

    name is a 128-bit hash of the text. Of equal segments that a task holds at one time (CHUNK at most) only the first place
    goes on with its text, and their number. The others are late whatever comes: their windows go out as merged spans, with
    no name and with a key that spreads them.
    """
    j = packed(docs).join(marks, "k").select("doc", "k", "text", "at")
    columns = ["key", "name", "text", "doc", "k", "start", "n", "copies"]
    kinds = [pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 5]

    def run(batches):
        unzip = zstandard.ZstdDecompressor()
        first_of: dict[bytes, tuple] = {}  # name: place, key, n, text, copies
        late: list[tuple] = []  # k, start, n

        def out():
            rows = [(key, name, text, *place, n, copies) for name, (place, key, n, text, copies) in first_of.items()]
            late.sort()
            now = None
            for k, s, n in late:
                if now and now[0] == k and s <= now[1] + now[2]:
                    now[2] = max(now[2], s + n - now[1])
                else:
                    if now:
                        rows.append((now[0], None, None, 0, *now, 0))
                    now = [k, s, n]
            if now:
                rows.append((now[0], None, None, 0, *now, 0))
            first_of.clear()
            late.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t_) for c, t_ in zip(zip(*rows, strict=True) if rows else [()] * 8, kinds, strict=True)], names=columns)

        for b in batches:
            for d, k, t, at in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                words = unzip.decompress(t).split()
                for code in at:
                    hard, code = code < 0, code if code >= 0 else -1 - code
                    s, c, anchor = code >> 8, code & 15, (code >> 8) + (code >> 4 & 15)
                    own = 0 if hard else xxhash.xxh3_64_intdigest(b" ".join(words[anchor : anchor + GRAM])) - 2**63
                    for f, n in ((s + o, 1) for o in range(c)) if hard else ((s, c),):
                        text = b" ".join(words[f : f + n + WINDOW - 1])
                        name = xxhash.xxh3_128_digest(text)
                        place, old = (d, k, f), first_of.get(name)
                        if old is None:
                            first_of[name] = (place, int.from_bytes(name[:8], "little", signed=True) if hard else own, n, text, 1)
                        elif place != old[0]:
                            least, other = min(place, old[0]), max(place, old[0])
                            first_of[name] = (least, *old[1:4], old[4] + 1)
                            late.append((*other[1:], n))
                if len(first_of) + len(late) > CHUNK:
                    yield out()
        yield out()

    return j.mapInArrow(tidied(run), "key long, name binary, text binary, doc long, k long, start long, n long, copies long")


# --- the index


#: Masks of the bits below each of 64.
BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class Wavelet:
    """A wavelet matrix over ids below 2^bits: rank queries in bits steps, each two lookups and a count of bits."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.bits, self.words, self.ahead, self.zeros = bits, [], [], []
        now = seq
        for k in reversed(range(bits)):
            bit = (now >> k) & 1
            pad = np.zeros(-(-(len(now) + 1) // 64) * 64, np.uint8)
            pad[: len(now)] = bit
            word = np.packbits(pad, bitorder="little").view("<u8")
            ahead = np.concatenate([[0], np.cumsum(np.bitwise_count(word), dtype=np.int64)])
            self.words.append(word)
            self.ahead.append(ahead)
            order = np.argsort(bit, kind="stable")
            self.zeros.append(len(now) - int(bit.sum()))
            now = now[order]

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each c before position i, counted from the start of c's block; i may have several rows."""
        for level in range(self.bits):
            at = i >> 6
            one = self.ahead[level].take(at)
            one += np.bitwise_count(self.words[level].take(at) & BELOW.take(i & 63))
            i = np.where(c & (1 << (self.bits - 1 - level)), self.zeros[level] + one, i - one)
        return i


class FMIndex:
    """Of a sequence of positive word ids in which 0 parts the segments; copies: in how many places each position stands."""

    def __init__(self, seq: np.ndarray, copies: np.ndarray | None = None, depth: int = WINDOW):
        top = int(seq.max())
        self.bits = max(1, top.bit_length())
        self.seed = min(SEED, 62 // self.bits)
        order = suffix_order(seq, depth + 1)
        self.seeds = packed_words(seq, np.arange(len(seq)), self.seed, self.bits)[order]  # sorted, as suffixes are
        self.tree = Wavelet(seq[order - 1], self.bits)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=top + 1))])
        every = np.arange(top + 1)
        self.begin = self.tree.rank(every, np.zeros(top + 1, np.int64))  # where each id's block starts in the last level
        self.at = order.astype(np.int32)  # the position of each suffix
        self.places = np.concatenate([[0], np.cumsum((seq > 0 if copies is None else copies)[order], dtype=np.int64)])

    def step(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of strings, one word longer at their front."""
        base = self.less[c] - self.begin[c]
        lo, hi = base + self.tree.rank(c, np.stack([lo, hi]))
        return lo, hi

    def matching_statistics(self, seq: np.ndarray, ends: np.ndarray, most: np.ndarray):
        """For each position of seq among ends the length, up to its ``most``, of the longest run of words that ends there and
        stands in more than one place of the index (0 where it is under ``seed`` words, whose suffix interval is looked up among
        the sorted runs of so many words); and which reach ``most``, with their suffix intervals."""
        length, found = np.zeros(len(ends), np.int64), [(np.zeros(0, np.int64),) * 3]
        for first in range(0, len(ends), LANES):
            own = ends[first : first + LANES]
            live, key = np.arange(len(own)), packed_words(seq, own - self.seed + 1, self.seed, self.bits)
            lo, hi = np.searchsorted(self.seeds, key), np.searchsorted(self.seeds, key, side="right")
            upto = most[first : first + LANES]
            for k in range(self.seed - 1, int(upto.max())):
                if k >= self.seed:
                    if (done := upto[live] == k).any():
                        found.append((first + live[done], lo[done], hi[done]))
                        live, lo, hi = live[~done], lo[~done], hi[~done]
                    lo, hi = self.step(seq[own[live] - k], lo, hi)
                more = self.places[hi] - self.places[lo] > 1
                live, lo, hi = live[more], lo[more], hi[more]
                length[first + live] = k + 1
            found.append((first + live, lo, hi))
        return length, *(np.concatenate(x) for x in zip(*found, strict=True))


def packed_words(seq: np.ndarray, at: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The n words from each position on as one integer; beyond the end there are zeros."""
    key = np.zeros(len(at), np.int64)
    if len(at) and at[-1] + n > len(seq):
        seq = np.concatenate([seq, np.zeros(n, seq.dtype)])
    for i in range(n):
        key <<= bits
        key |= seq.take(at + i)
    return key


def suffix_order(seq: np.ndarray, depth: int) -> np.ndarray:
    """Positions in order of the ``depth`` words that follow them, at least: several words to a key, then doubling."""
    n, bits = len(seq), max(1, int(seq.max()).bit_length())
    width = max(1, 62 // bits)
    key = packed_words(seq, np.arange(n), width, bits)
    while True:
        order = np.argsort(key)
        if width >= depth:
            return order
        k = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], k[1:] != k[:-1]]))
        key = rank * (n + 2)
        key[: max(n - width, 0)] += rank[width:]
        width *= 2


def shard(texts: list[bytes], place: np.ndarray, copies: list[int] | None = None, alone: list[bool] | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """For each distinct segment, the offsets of its windows that have an earlier place; place: (document, start, k) of its
    first place; copies: its number of places; alone: whether it is the only one with its anchor, so that its windows can
    stand in no other. And the matching statistics of all windows' ends, segment after segment.

    A segment that is alone is searched as one run, from its last word to its first: if all of it stands in more than one
    place, so do its windows. Of the others each window is searched.
    """
    words = [t.split() for t in texts]
    ids: dict[bytes, int] = {}
    flat: list[int] = []
    for ws in words:
        flat += [ids.setdefault(w, len(ids) + 1) for w in ws]
        flat.append(0)
    seq = np.array(flat, np.int64)
    size = np.array([len(w) for w in words])
    begin = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    many = np.repeat(np.ones(len(words), np.int64) if copies is None else np.array(copies, np.int64), size + 1)
    many[begin + size] = 0  # what parts segments stands nowhere
    one = np.zeros(len(words), bool) if alone is None else np.array(alone)
    index = FMIndex(seq, many, int(size[one].max()) if one.any() else WINDOW)
    whole = np.zeros(len(words), bool)
    at = np.flatnonzero(one)
    run = index.matching_statistics(seq, begin[at] + size[at] - 1, size[at])[0]
    whole[at] = run == size[at]
    count = size - WINDOW + 1
    seg = np.repeat(np.arange(len(words)), count)
    off = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = begin[seg] + off
    length = np.where(whole[seg], WINDOW, 0)
    ask = np.flatnonzero(~whole[seg])
    length[ask], live, lo, hi = index.matching_statistics(seq, at[ask] + WINDOW - 1, np.full(len(ask), WINDOW))
    live = ask[live]
    out = [np.zeros(0, np.int64)] * len(words)
    if not len(live):
        return out, length
    # the first place of each interval: windows' order keys along the suffixes
    doc, start = place[seg, 0], place[seg, 1] + off
    k2 = place[seg, 2]
    order = np.lexsort((start, k2, doc))
    key = np.empty(len(order), np.int32)
    d, k_, s = doc[order], k2[order], start[order]
    key[order] = np.concatenate([[0], np.cumsum((d[1:] != d[:-1]) | (k_[1:] != k_[:-1]) | (s[1:] != s[:-1]))])
    by_pos = np.full(len(seq), np.iinfo(np.int32).max, np.int32)
    by_pos[at] = key
    along = np.append(by_pos[index.at], np.int32(np.iinfo(np.int32).max))
    uniq, inv = np.unique(lo, return_inverse=True)
    last = np.empty(len(uniq), np.int64)
    last[inv] = hi
    least = np.minimum.reduceat(along, np.stack([uniq, last], axis=1).ravel())[::2]
    late = live[key[live] > least[inv]]
    cut = np.searchsorted(seg[late], np.arange(len(words) + 1))
    return [off[late[cut[i] : cut[i + 1]]] for i in range(len(words))], length


def spans(offsets: np.ndarray) -> list[int]:
    """Sorted offsets as a flat list of first, last, first, last, ..."""
    if not len(offsets):
        return []
    edge = np.flatnonzero(np.diff(offsets) > 1)
    return np.stack([offsets[np.concatenate([[0], edge + 1])], offsets[np.concatenate([edge, [len(offsets) - 1]])]], axis=1).ravel().tolist()


def judge(segs: DataFrame, size: int = SHARD) -> DataFrame:
    """Rows (k, a, b): spans of windows (first and last start) of document k that also start earlier.

    Segments come sorted by key, name and place, so the first row of a name is its first place; every later one is late
    as a whole (its text stands in more places than one), and goes out at once, as do spans without a name. Only distinct
    segments are held, up to ``size`` words of whole keys, and indexed: all but those that stand alone with their key.
    """

    def out(rows):
        cols = list(zip(*rows, strict=True)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["k", "a", "b"])

    def indexed(own):
        """own: [doc, k, start, text, copies, alone] of distinct segments."""
        late, _ = shard([x[3] for x in own], np.array([(x[0], x[2], x[1]) for x in own], np.int64), [x[4] for x in own], [x[5] for x in own])
        for (_, k, start, *_), x in zip(own, late, strict=True):
            at = spans(x)
            yield from ((k, start + at[i], start + at[i + 1]) for i in range(0, len(at), 2))

    def run(batches):
        held, room, own, key, name, rows = [], 0, [], None, None, []

        def close():
            nonlocal room
            if len(own) > 1 or own and own[0][4] > 1:
                held.extend([*x, len(own) == 1] for x in own)
                room += sum(len(x[3]) for x in own) // 6
            if room > size:
                rows.extend(indexed(held))
                held.clear()
                room = 0

        for b in batches:
            for key_, name_, text, doc, k, start, n, copies in zip(*(b.column(i).to_pylist() for i in range(8)), strict=True):
                if name_ is None:
                    rows.append((k, start, start + n - 1))
                    continue
                if key_ != key:
                    close()
                    own, key, name = [], key_, None
                if name_ != name:
                    own.append([doc, k, start, text, copies])
                    name = name_
                    continue
                if (doc, k, start) != tuple(own[-1][:3]):
                    own[-1][4] += copies
                    rows.append((k, start, start + n - 1))
            yield out(rows)
            rows = []
        close()
        if held:
            rows.extend(indexed(held))
        yield out(rows)

    dealt = segs.repartition("key").sortWithinPartitions("key", "name", "doc", "k", "start")
    return dealt.mapInArrow(tidied(run), "k long, a long, b long")


def repeats(docs: DataFrame, name: Column, heavy: int = HEAVY) -> DataFrame:
    """Rows (k, late): for each document that has any, the spans (first, last, ...) of its windows that also start earlier."""
    d = docs_of(docs, name).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "k", "text")
    late = judge(segments(d, repeated(d.select("k", "text"), heavy)))
    return late.groupBy("k").agg(F.flatten(F.collect_set(F.array("a", "b"))).alias("late"))


def covered(n: int, late: list[int] | None) -> np.ndarray:
    """Which of a text's n words a late window covers."""
    step = np.zeros(n + 1, np.int64)
    if late:
        x = np.array(late, np.int64).reshape(-1, 2)
        np.add.at(step, x[:, 0], 1)
        np.add.at(step, np.minimum(x[:, 1] + WINDOW, n), -1)
    return np.cumsum(step[:n]) > 0


def dedup(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """The columns of docs, and _n_words and _n_removed: texts are their kept words joined by one space, or as they were if
    none is removed; n_chars, if there is such a column, follows the text."""
    name = names(docs)
    late = repeats(docs, name, heavy).select(F.col("k").alias("_fm_k"), F.col("late").alias("_fm_late"))
    own = docs.withColumn("_fm_own", name)
    j = packed(own).join(late, F.col("_fm_own") == F.col("_fm_k"), "left").select(*[f"`{c}`" for c in docs.columns], "_fm_late")
    at, chars = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    schema = docs.schema.jsonValue()

    def run(batches):
        unzip = zstandard.ZstdDecompressor()
        for b in batches:
            n, gone, text = [], [], []
            for z, x in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
                t = None if z is None else unzip.decompress(z)
                words = (t or b"").split()
                out = covered(len(words), x)
                n.append(len(words))
                gone.append(int(out.sum()))
                left = b" ".join([w for w, o in zip(words, out.tolist(), strict=True) if not o]) if gone[-1] else t
                text.append(None if left is None else left.decode("utf-8"))
            cols = b.columns[:-1]
            cols[at] = pa.array(text, pa.string())
            if chars is not None:
                cols[chars] = pa.array([None if t is None and c is None else c if not g else len(t) for t, g, c in zip(text, gone, cols[chars].to_pylist(), strict=True)], pa.int64()).cast(cols[chars].type)
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(gone, pa.int64())], names=[*b.schema.names[:-1], "_n_words", "_n_removed"])

    return mapped(j, run, StructType.fromJson(schema).add("_n_words", "long").add("_n_removed", "long"))


def digest(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""

    def run(batches):
        for b in batches:
            sha = [hashlib.sha256(b" ".join((t or "").encode("utf-8").split())).hexdigest() for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return dedup(own, heavy).select("doc_id", "_n_words", "_n_removed", "text").mapInArrow(tidied(run), "doc_id long, n_words long, n_removed long, kept_sha256 string")
