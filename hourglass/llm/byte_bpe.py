"""Operator 13: byte-level BPE encoding and decoding by replaying the merges over a corpus of words.

Texts are cut by the tokenizer's pattern.  The distinct words of a slice that the task has not met
before become one array of bytes, and an inverted index from the rank of a token pair to the positions
where that pair begins is built over all of them.  Ranks are taken from the index lowest first; each
merge is applied at all its positions at once, and only the pairs on both sides of a merged token are
looked up and indexed again.  Within a word that is the order in which the lowest pair, leftmost
first, is merged; a word that is a token itself is that token.

Texts are encoded where they lie: nothing is shuffled, a task holds one slice of texts and the words it
remembers (``WORD_BYTES``; a cache, whose size changes no result).
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hourglass.llm.common import map_texts

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
#: Bytes of texts worked on at a time, and of the words a task remembers.
SLICE_BYTES, WORD_BYTES = 1 << 23, 1 << 24
#: No merge.
NONE = np.iinfo(np.int32).max


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, which is also the id; read on the driver (under a megabyte)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def class_repairs(pattern: str) -> dict[int, str]:
    """Code points that Python's ``regex`` and the tiktoken library put into different classes, each
    with a character of the class that tiktoken sees.

    The two follow different Unicode versions.  Tiktoken is asked through a vocabulary in which only a
    letter (or digit) and the first byte of a character behind it merge, which they do in one word only.
    """
    import regex
    import tiktoken

    lead = range(0xC2, 0xF5)
    probes = {}
    for sign in ("a", "1"):
        ranks = {bytes([b]): b for b in range(256)} | {sign.encode() + bytes([b]): 256 + b for b in lead}
        probes[sign] = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    repairs = {}
    points = [p for p in range(0x80, 0x110000) if not 0xD800 <= p < 0xE000]
    for k in range(0, len(points), 1 << 16):
        chars = [chr(p) for p in points[k:k + (1 << 16)]]
        theirs, ours = [], []
        for sign, kind in (("a", r"\p{L}"), ("1", r"\p{N}")):
            ids = probes[sign].encode_ordinary("".join(f"{sign}{c}\n" for c in chars))
            ends = np.flatnonzero(np.array(ids) == 10)
            first = np.array(ids)[np.append(0, ends[:-1] + 1)]
            theirs.append((first >= 256).tolist())
            known = set(regex.findall(kind, "".join(chars)))
            ours.append([c in known for c in chars])
        for c, letter, digit, our_letter, our_digit in zip(chars, *theirs, *ours, strict=True):
            if (letter, digit) != (our_letter, our_digit):
                repairs[ord(c)] = "a" if letter else "1" if digit else "."
    return repairs


class Splitter:
    """Cuts a text as the pattern says, with the character classes of the tiktoken library."""

    def __init__(self, pattern: str, repairs: dict[int, str]):
        import regex

        self.pattern, self.repairs, self.odd = regex.compile(pattern), repairs, frozenset(map(chr, repairs))

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or self.odd.isdisjoint(text):
            return self.pattern.findall(text)
        return [text[m.start():m.end()] for m in self.pattern.finditer(text.translate(self.repairs))]


class Merges:
    """All pairs of tokens that make a token, with its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.end = ranks, max(ranks.values()) + 1
        self.size = self.end + 1
        self.pairs: dict[int, int] = {}
        #: Tokens that begin or end an earlier one: merging one place may bring a lower pair beside it.
        self.early = np.zeros(self.size, dtype=bool)
        for token, r in ranks.items():
            for i in range(1, len(token)):
                x, y = ranks.get(token[:i]), ranks.get(token[i:])
                if x is not None and y is not None:
                    self.pairs[x * self.size + y] = r
                for part in (x, y):
                    if part is not None and part > r:
                        self.early[part] = True
        codes = sorted(self.pairs)
        self.codes = np.array([*codes, np.iinfo(np.int64).max], dtype=np.int64)
        self.rank = np.array([*map(self.pairs.__getitem__, codes), NONE], dtype=np.int32)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)

    def of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Rank of every pair, NONE where two tokens do not merge."""
        code = x.astype(np.int64) * self.size + y
        at = np.searchsorted(self.codes, code)
        return np.where(self.codes[at] == code, self.rank[at], NONE)

    def one(self, x: int, y: int) -> int:
        return self.pairs.get(int(x) * self.size + int(y), NONE)


class Replay:
    """The words as one linked list of tokens, and the index from rank to positions."""

    def __init__(self, merges: Merges, words: list[bytes]):
        self.m = merges
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        self.ends = np.cumsum(sizes) - 1
        self.token = merges.byte[np.frombuffer(b"\0".join(words) + b"\0", dtype=np.uint8)]
        self.token[self.ends] = merges.end
        n = len(self.token)
        self.next = np.minimum(np.arange(1, n + 1), n - 1).astype(np.int32)
        self.prior = np.arange(-1, n - 1, dtype=np.int32)  # position -1 is the last end
        self.word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        self.rank = np.full(n, NONE, dtype=np.int32)
        self.rank[:-1] = merges.of(self.token[:-1], self.token[1:])
        self.index: dict[int, list[np.ndarray]] = {}
        self.heap: list[int] = []
        self._add(np.arange(n, dtype=np.int32))

    def _add(self, at: np.ndarray) -> None:
        """Index the pairs that begin at these positions."""
        r = self.rank[at]
        at, r = at[r != NONE], r[r != NONE]
        if not len(at):
            return
        order = np.argsort(r, kind="stable")
        at, r = at[order], r[order]
        cuts = np.flatnonzero(np.diff(r)) + 1
        for k, part in zip(r[np.append(0, cuts)].tolist(), np.split(at, cuts), strict=True):
            if k not in self.index:
                self.index[k] = []
                heapq.heappush(self.heap, k)
            self.index[k].append(part)

    def _join(self, at: np.ndarray, r: int) -> np.ndarray:
        """Merge the pairs at these positions; the positions whose pairs have changed."""
        right = self.next[at]
        after = self.next[right]
        self.token[at], self.token[right] = r, -1
        self.next[at], self.prior[after] = after, at
        self.rank[right] = NONE
        touched = np.concatenate([at, self.prior[at]])
        self.rank[touched] = self.m.of(self.token[touched], self.token[self.next[touched]])
        return touched

    def _one_by_one(self, at: np.ndarray, r: int) -> list[int]:
        """Merge places of the same words from left to right; a lower pair that this brings beside the
        merged token goes before the next place."""
        changed: list[int] = []
        for start in at.tolist():
            here, rank = start, r
            if self.rank[here] != r or self.token[here] < 0:
                continue
            while True:
                right = self.next[here]
                after = self.next[right]
                self.token[here], self.token[right], self.rank[right] = rank, -1, NONE
                self.next[here], self.prior[after] = after, here
                before = int(self.prior[here])
                self.rank[here] = self.m.one(rank, self.token[after])
                self.rank[before] = self.m.one(self.token[before], rank)
                changed += [here, before]
                if min(self.rank[here], self.rank[before]) >= r:
                    break
                here = before if self.rank[before] <= self.rank[here] else here
                rank = int(self.rank[here])
        return changed

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all words, number of ids of each word)``."""
        while self.heap:
            r = heapq.heappop(self.heap)
            at = np.concatenate(self.index.pop(r))
            at = np.unique(at[self.rank[at] == r])
            if not len(at):
                continue
            if self.m.early[r]:
                word = self.word[at]
                twice = np.append(False, word[1:] == word[:-1])
                twice[:-1] |= twice[1:]
                self._add(np.array(sorted(set(self._one_by_one(at[twice], r))), dtype=np.int32))
                at = at[~twice]
            elif len(at) > 1:
                # of places that overlap, the first, third, ...
                place = np.arange(len(at))
                chained = np.append(False, self.next[at[:-1]] == at[1:])
                at = at[(place - np.maximum.accumulate(np.where(chained, 0, place))) % 2 == 0]
            if len(at):
                self._add(self._join(at, r))
        live = self.token >= 0
        live[self.ends] = False
        return self.token[live], np.add.reduceat(live.astype(np.int64), np.append(0, self.ends[:-1] + 1))


class Encoder:
    """Encodes slices of texts; remembers the ids of words until they take ``WORD_BYTES``."""

    def __init__(self, merges: Merges, split: Splitter):
        self.merges, self.split = merges, split
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(0, dtype=np.int32)
        self.counts = np.empty(0, dtype=np.int64)
        self.held = 0

    def _learn(self, new: list[str]) -> None:
        for w in new:
            self.known[w] = len(self.known)
        raw = [w.encode() for w in new]
        whole = [self.merges.ranks.get(w, -1) for w in raw]
        rest = [w for w, k in zip(raw, whole, strict=True) if k < 0]
        ids, counts = Replay(self.merges, rest).run() if rest else (np.empty(0, np.int32), np.empty(0, np.int64))
        whole = np.array(whole, dtype=np.int32)
        size = np.ones(len(new), dtype=np.int64)
        size[whole < 0] = counts
        out = np.empty(int(size.sum()), dtype=np.int32)
        merged = np.repeat(whole < 0, size)
        out[merged], out[~merged] = ids, whole[whole >= 0]
        self.ids, self.counts = np.concatenate([self.ids, out]), np.concatenate([self.counts, size])
        self.held += sum(map(len, raw))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.held > WORD_BYTES:
            self._forget()
        words = [self.split(t) for t in texts]
        self._learn(list(dict.fromkeys(w for ws in words for w in ws if w not in self.known)))
        if not self.known:
            return [np.empty(0, dtype=np.int32) for _ in texts]
        first = np.cumsum(self.counts) - self.counts
        out = []
        for ws in words:
            at = np.fromiter(map(self.known.__getitem__, ws), dtype=np.int64, count=len(ws))
            size = self.counts[at]
            begin = np.cumsum(size) - size
            out.append(self.ids[np.repeat(first[at] - begin, size) + np.arange(int(size.sum()))])
        return out


def decoder(ranks: dict[bytes, int]):
    """Function from ids to the bytes they stand for; an unknown id raises."""
    table = {r: token for token, r in ranks.items()}
    return lambda ids: b"".join(map(table.__getitem__, ids))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``ids`` and ``n_tokens`` (replacing columns so named).

    A null text is taken as empty; an empty text has no ids.  Repeated rows are encoded each, an empty
    table gives an empty result, and a text is encoded whole, whatever its length.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern, class_repairs(pattern)))

    def start():
        table, cut, repairs = shared.value
        encoder = Encoder(Merges(table), Splitter(cut, repairs))

        def run(texts: list) -> tuple[None, dict[str, list]]:
            ids = encoder.encode([t or "" for t in texts])
            return None, {"ids": ids, "n_tokens": [len(i) for i in ids]}

        return run

    return map_texts(docs, text, start, {"ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
                                         "n_tokens": (T.LongType(), pa.int64())}, slice_bytes=SLICE_BYTES)


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", name: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and the bytes of ``ids`` (null for null), as binary."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def start():
        text = decoder(shared.value)
        return lambda rows: (None, {name: [None if r is None else text(r) for r in rows]})

    return map_texts(encoded, ids, start, {name: (T.BinaryType(), pa.binary())})


def digests(encoded: DataFrame, ranks: dict[bytes, int], key: str = "doc_id") -> DataFrame:
    """``(key, n_tokens, ids_sha256, decoded_sha256)``: the ids as little-endian unsigned 32-bit integers
    and the bytes they decode to, both hashed."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    kind = encoded.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = decoder(shared.value)
        for batch in batches:
            rows = [r.values.to_numpy(zero_copy_only=False) for r in batch.column("ids")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), batch.column("n_tokens"),
                 pa.array([hashlib.sha256(r.astype("<u4").tobytes()).hexdigest() for r in rows], pa.string()),
                 pa.array([hashlib.sha256(text(r.tolist())).hexdigest() for r in rows], pa.string())], names=schema.names)

    return encoded.select(key, "n_tokens", "ids").mapInArrow(run, schema)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path(RANK_FILE))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    encoded = encode(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids")
    return digests(encoded, ranks)
