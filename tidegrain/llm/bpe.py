"""BPE encoding and decoding by prefix-sharing trie traversal.

The encoding of a string by rank-ordered merges has one property that the traversal rests on: the encoding of every
prefix is the encoding of a shorter prefix plus one last token, and that token is the only vocabulary entry ending
there which merging would leave standing beside the token before it. So the state of a trie node is its last token.
Distinct words go into a path-compressed byte trie, laid out as their sorted list; a depth-first walk gives every node
its last token from the states above it, and words that share a prefix share its states.

Nulls count as empty texts, which have no tokens. Texts of any length are encoded whole: a word longer than any token
costs time in proportion to its length. Rows are mapped one by one, so repeated rows, ties and extra columns change
nothing, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrain.llm.common import HELD, tidied

# Fixed value: the word pattern of byte-level BPE tokenizers.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


#: A space that no non-space follows, and one that a non-space follows.
SPACED, CUT = regex.compile(r" (?!\S)"), regex.compile(r" (?=\S)")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, and back."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieBPE:
    """Encoder and decoder of one vocabulary file; both directions agree with the file's own library."""

    HELD_WORDS, SEAMS = 1_000_000, 300_000  # words, and pieces, whose encodings are held; pairs of tokens known to stand or not
    ROOM = 4_000_000  # characters that are encoded at a time

    def __init__(self, path: str, held: int = HELD_WORDS):
        self.most = held
        spec = json.load(open(path, encoding="utf-8"))
        alphabet = byte_alphabet()
        raw = lambda s: bytes(alphabet[c] for c in s)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {raw(t): i for t, i in vocab.items() if t not in self.special}
        self.bytes = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.product: dict[int, tuple[int, int]] = {}  # a token's two halves
        self.made: dict[int, int] = {}  # a token's merge rank
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = (vocab[x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            t = self.ids[self.bytes[a] + self.bytes[b]]
            self.rank[a, b] = r
            if t not in self.made:
                self.made[t], self.product[t] = r, (a, b)
        self.heads = {b[:n] for b in self.ids for n in range(1, len(b) + 1)}
        self.cuts = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.size = {i: len(b) for i, b in self.bytes.items()}
        self.beside: dict[int, bool] = {}
        self.word_ids: dict[str, tuple[int, ...]] = {}
        self.chunk_ids: dict[str, tuple[int, ...]] = {}

    # --- last-token states

    def stands(self, a: int, b: int) -> bool:
        """Whether merging leaves tokens a and b apart when their strings stand side by side.

        Undoes the merges beside the seam, latest first: a merge across the seam that ranks before one undone would have
        come first, and of two overlapping merges of one rank the left one does.
        """
        made, parts, rank = self.made, self.product, self.rank
        until, tie = len(rank) + 1, False
        while True:
            r = rank.get((a, b))
            if r is not None and (r < until or r == until and tie):
                return False
            ra, rb = made.get(a, -1), made.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            if ra > rb:  # a merge across the seam starts right of the one that made a and loses a tie
                until, tie, a = ra, False, parts[a][1]
            else:  # it starts left of the one that made b and wins a tie
                until, tie, b = rb, True, parts[b][0]

    def encode_words(self, words: list[str]) -> None:
        """Adds the encodings of words to word_ids.

        The sorted words are the path-compressed trie in depth-first order: a word branches off the path to the word
        before it where the two first differ, and only the edge below the branch gets new states. A state is the last
        token of the path so far, with the length of the longest tail that begins some token.
        """
        ids, heads, beside, stands, out = self.ids, self.heads, self.beside, self.stands, self.word_ids
        if len(beside) > min(self.SEAMS, self.most):
            beside.clear()
        states, reaches, path = [0], [0], b""
        for raw, word in sorted((w.encode("utf-8", "surrogatepass"), w) for w in words):
            depth, most = 0, min(len(raw), len(path))
            while depth < most and raw[depth] == path[depth]:
                depth += 1
            del states[depth + 1 :], reaches[depth + 1 :]
            reach = reaches[depth]
            for n in range(depth + 1, len(raw) + 1):
                start = n - reach - 1
                while raw[start:n] not in heads:
                    start += 1
                reach = n - start
                while True:
                    t = ids.get(raw[start:n])
                    if t is not None:
                        if not start:
                            break
                        key = states[start] << 20 | t
                        ok = beside.get(key)
                        if ok is None:
                            ok = beside[key] = stands(states[start], t)
                        if ok:
                            break
                    start += 1
                states.append(t)
                reaches.append(reach)
            path, n, tokens, size = raw, len(raw), [], self.size
            while n:
                tokens.append(states[n])
                n -= size[states[n]]
            out[word] = tuple(reversed(tokens))

    # --- texts

    @staticmethod
    def chunks(text: str) -> tuple[str, list[str]]:
        """Pieces that the word pattern never crosses: a cut stands in place of each space that a non-space follows."""
        if not SPACED.search(text):
            first, *rest = text.split(" ")
            return first, rest
        first, *rest = CUT.split(text)
        return first, rest

    def learn(self, chunks: list[str], into: dict[str, tuple[int, ...]], before: str) -> None:
        """Adds to into the encodings of chunks that stand behind before."""
        if len(self.word_ids) > self.most:
            self.word_ids.clear()
        known = self.word_ids
        split = [WORDS.findall(before + c) for c in chunks]
        if new := {w for ws in split for w in ws if w not in known}:
            self.encode_words(new)
        for c, ws in zip(chunks, split, strict=True):
            into[c] = known[ws[0]] if len(ws) == 1 else tuple(chain.from_iterable(map(known.__getitem__, ws)))

    def encode_plain(self, texts: list[str]) -> list[list[int]]:
        """Encodings of texts without special tokens; their unknown chunks go into one trie."""
        own = [self.chunks(t) for t in texts]
        known = self.chunk_ids
        if missing := {c for _, cs in own for c in cs if c not in known}:
            if len(known) + len(missing) > self.most:
                known.clear()
                missing = {c for _, cs in own for c in cs}
            self.learn(list(missing), known, " ")
        first: dict[str, tuple[int, ...]] = {}
        self.learn(list({f for f, _ in own}), first, "")
        return [[*first[f], *chain.from_iterable(map(known.__getitem__, cs))] for f, cs in own]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        if not self.cuts or not any(s in t for s in self.special for t in texts):
            return self.encode_plain(texts)
        out = []
        for t in texts:
            plain, marks = self.cuts.split(t), self.cuts.findall(t)
            ids = self.encode_plain(plain)
            out.append(list(chain(ids[0], *((self.special[m], *x) for m, x in zip(marks, ids[1:], strict=True)))))
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def stream(self, texts: Iterable[str | None], room: int = ROOM):
        """Encodings of texts, some million characters at a time; null counts as empty."""
        some, size = [], 0
        for t in texts:
            some.append(t or "")
            size += len(t or "")
            if size > room:
                yield from self.encode_all(some)
                some, size = [], 0
        yield from self.encode_all(some)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


def codec(path: str, most: int = TrieBPE.HELD_WORDS) -> TrieBPE:
    """One codec for each Python worker and file, held until a task of another operator comes."""
    held = HELD.setdefault("bpe", {})
    if path not in held:
        held[path] = TrieBPE(path)
    held[path].most = most
    return held[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array of int) of each row's whole text; path: a vocabulary file that every executor holds."""

    def run(batches):
        c = codec(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(c.stream(b.column(1).to_pylist())), pa.list_(pa.int32()))], names=["doc_id", "ids"])

    d = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return d.mapInArrow(tidied(run, "bpe"), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of each row's ids (null: no ids)."""

    def run(batches):
        c = codec(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), F.col("ids")).mapInArrow(tidied(run, "bpe"), "doc_id long, text string")


def texts_of(col: pa.Array, rows: int = 64):
    """The texts of a column, of which few are Python's at a time: a batch holds thousands of whole texts."""
    for i in range(0, len(col), rows):
        yield from col.slice(i, rows).to_pylist()


def digest(docs: DataFrame, path: str, held: int = TrieBPE.HELD_WORDS, room: int = TrieBPE.ROOM) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text encoded, and its ids decoded again, in one pass.

    held: words whose encodings a Python worker holds; room: characters that it encodes at a time. Fewer take less memory
    and more time, with the same results.
    """

    def run(batches):
        c = codec(path, held)
        name = {i: str(i) for i in c.bytes}
        for b in batches:
            n, one, two = [], [], []
            for ids in c.stream(texts_of(b.column(1)), room):
                n.append(len(ids))
                one.append(hashlib.sha256(",".join(map(name.__getitem__, ids)).encode()).hexdigest())
                two.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(one), pa.array(two)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    d = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return d.mapInArrow(tidied(run, "bpe"), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
