"""Operator 1: n-gram Jaccard join with token-combination prefixes.

A document's tokens are its distinct 5-word shingles (64-bit hashes); two documents link when
``100 * intersection >= 75 * union``.  Equal sets are one *node*; copies are counted, never paired.

*Order.*  Tokens that repeat within a batch of documents are counted over the whole corpus; the
most frequent ones are the frequent class.  Every set is ordered rare tokens first, frequent ones
last by count.  Any common order is right; this one keeps shared passages out of the prefixes.

*Keys.*  With ``p = n - ceil(0.75 n) + 1``, linked sets share a token of their first ``p``, and two
tokens of their first ``p + 1``, and l tokens of their first ``p + l - 1``.  For short sets every rare token of the extended prefix is a key, and frequent tokens
are keys in pairs (up to ``SHORT`` shingles, where boilerplate can fill a prefix); longer sets have
single keys from a prefix extended by a half, and must share as many of them as that prefix
guarantees; sets up to a third longer than ``SHORT`` give both kinds, so that every pair that may
link meets under one of its schemes.

*Candidates.*  Every round compares each set of a bucket with one pivot, the set with most copies there (edits of
a text that is copied often link with it, not with each other), merges what links, and only
sets that are not yet in the pivot's component remain.  What no round has merged is compared at the end
across components, so no link between components is lost: sets that lie in fewer buckets than they would
share with any linked one are left out; buckets of less than ``LARGE`` sets are joined with themselves (so a
set has less than ``LARGE`` pairs a key); the sets of larger ones are gathered by pivot, once however many buckets
they share, and compared whole in blocks as below, those outside the pivot's component with all.

*Links.*  All links lie within components, so they are counted there at the end: a component is worked on
in blocks of ``BLOCK`` nodes against ``BLOCK`` nodes, a block's whole sets being compared at once by a
product of token columns; pairs never leave a task.

*Verification* reads the candidates' whole texts again and compares the complete sets.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm.common import checkpoint, release, shared_dir, shuffled, tidy
from hourglass.llm.components import connected_components
from hourglass.llm.textvec import MIX, P, hashed_shingles, hashed_words, lower_ascii

SHINGLE = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Repeats within batches from which on a token may be frequent, and how many are kept (8 bytes each).
LEAST_COUNT, MOST_FREQUENT = 2, 200_000
#: Largest set whose frequent tokens are keys in pairs only.
SHORT = 40
#: Sets up to this size give pairs of frequent tokens (those over SHORT single ones too).
BOTH = SHORT * 100 // PERCENT + 1
#: Prefix tokens in one part of the index of rare tokens.
PART_TOKENS = 1_000_000
#: Cells of the filter that keeps unwanted texts out of a shuffle (its size is fixed, whatever the data).
SIEVE = 1 << 18
#: Pairs whose sets a task holds at a time, characters that it cuts into shingles at a time.
VERIFIED, CHARS = 500, 1 << 22
#: Nodes of one side of a block in which links are counted, and token columns multiplied at a time.
BLOCK, COLUMNS = 256, 4096
#: Sets in a bucket from which on what no pivot has merged is compared in blocks.
LARGE = 32
#: Rounds of pivot comparisons before what is left is compared pair by pair.
ROUNDS = 1


def _is_word(ch: str) -> bool:
    return ch not in " \t\n\v\f\r"


def shingle_sets(texts: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, one without words none."""
    words, owner = hashed_words(texts, _is_word, lower_ascii)
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    n = np.diff(ends)
    every = hashed_shingles(words, size)
    out = []
    for i, k in enumerate(n.tolist()):
        a = ends[i]
        if k >= size:
            out.append(np.unique(every[a:a + k - size + 1]))
        else:
            out.append(hashed_shingles(words[a:a + k], k) if k else np.empty(0, dtype=np.uint64))
    return out


def _parts(texts: list[str], chars: int) -> Iterator[tuple[int, int]]:
    """Runs of texts with about so many characters (a longer text stands alone)."""
    ends = np.cumsum([len(t) for t in texts])
    cuts = np.flatnonzero(np.diff(ends // chars)) + 1
    yield from itertools.pairwise([0, *cuts.tolist(), len(texts)])


def _identity(s: np.ndarray, seed: int) -> tuple[int, int]:
    """Two 64-bit names of a set, whatever its order."""
    a = (s ^ np.uint64(seed * 2 + 1)) * P
    a = (a ^ (a >> np.uint64(32))) * MIX
    b = (s + np.uint64(0x632BE59BD9B4E019)) * MIX
    b = (b ^ (b >> np.uint64(29))) * P
    return int(a.sum(dtype=np.uint64).astype(np.int64)), int(b.sum(dtype=np.uint64).astype(np.int64))


def _describe(docs: DataFrame, seed: int) -> DataFrame:
    """Kind 0: a row per document (its set's size and names); kind 1: tokens repeated within a batch."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["_text"].tolist()
            sets = [s for a, b in _parts(texts, CHARS) for s in shingle_sets(texts[a:b])]
            names = [_identity(s, seed) for s in sets]
            yield pd.DataFrame({"kind": 0, "_key": frame["_key"], "tid": frame["tid"], "n": [len(s) for s in sets],
                                "node": [a for a, _ in names], "check": [b for _, b in names]})
            once = {name: s for name, s in zip(names, sets, strict=True)}
            if once:
                tokens, counts = np.unique(np.concatenate(list(once.values())), return_counts=True)
                many = counts > 1
                yield pd.DataFrame({"kind": 1, "_key": None,
                                    "tid": 0, "n": counts[many], "node": tokens[many].astype(np.int64), "check": 0})
                del tokens, counts, many
            del sets, once, texts
            release()

    return docs.mapInPandas(run, "kind int, _key string, tid long, n long, node long, check long")


def frequent_tokens(repeats: DataFrame, most: int = MOST_FREQUENT) -> np.ndarray:
    """The tokens with the greatest counts, least first: all from a count on, ``most`` at most.

    The count comes from a histogram (exact below 1024, eight bins an octave above), so the driver sees
    a thousand bins and then ``most`` numbers at most, never a candidate more.
    """
    counts = checkpoint(repeats.groupBy("node").agg(F.sum("n").alias("c")).where(F.col("c") >= LEAST_COUNT).withColumn(
        "bin", F.when(F.col("c") < 1024, F.col("c")).otherwise(F.floor(944 + 8 * F.log2("c"))).cast("int")))
    left, least = most, None
    for r in sorted(counts.groupBy("bin").count().collect(), reverse=True):
        left -= r["count"]
        if left < 0:
            break
        least = r["bin"]
    if least is None:
        return np.empty(0, dtype=np.uint64)
    top = counts.where(F.col("bin") >= least).select("node", "bin").toPandas()
    order = np.lexsort((top["node"].to_numpy(), top["bin"].to_numpy()))
    return top["node"].to_numpy(np.int64)[order].astype(np.uint64)


def _ordered(s: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, int]:
    """The set in global order (rare by hash, then frequent by rank) and its number of rare tokens."""
    rare = rank < 0
    order = np.argsort(rank[~rare], kind="stable")
    return np.concatenate([s[rare], s[~rare][order]]), int(rare.sum())


def least_shared(n: int) -> int:
    """Tokens that a set longer than BOTH shares with any linked one among its first
    ``p + least_shared - 1``: the prefix is half as long again as it must be for one shared token."""
    return 1 + (n - -(-PERCENT * n // 100) + 1) // 2 if n > BOTH else 1


def prefix_keys(s: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(rare keys, frequent keys)`` of a set; rank -1 is a rare token."""
    n = len(s)
    if n < 3:  # smaller sets link with equal ones only
        return s[:0], s[:0]
    p = n - -(-PERCENT * n // 100) + 1
    tokens, rare = _ordered(s, rank)
    extended = tokens[:p + 1]
    singles, common = extended[:rare], extended[rare:]
    keys = []
    if n > BOTH:
        longer = tokens[:p + least_shared(n) - 1]
        return longer[:rare], longer[rare:]
    if len(common) > 1:
        i, j = np.triu_indices(len(common), 1)
        low, high = np.minimum(common[i], common[j]), np.maximum(common[i], common[j])
        pair = (low * P) ^ (high + (low >> np.uint64(31)))
        keys.append((pair ^ (pair >> np.uint64(30))) * MIX)
    if n > SHORT:
        keys.append(tokens[:p][rare:])
    return singles, np.concatenate(keys) if keys else s[:0]


def _postings(docs: DataFrame, seed: int, shared: Broadcast, parts: int) -> DataFrame:
    """Rows ``(part, keys, nodes, sizes, copies)``: packed rare keys by part; parts below 0 hold frequent keys."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_count = shared.value
        order = np.argsort(by_count)
        lookup = by_count[order]
        for texts in (texts[a:b] for frame in frames for texts in [frame["_text"].tolist()] for a, b in _parts(texts, CHARS)):
            once: dict[tuple[int, int], np.ndarray] = {}
            copies: Counter[tuple[int, int]] = Counter()
            for s in shingle_sets(texts):
                if len(s):
                    name = _identity(s, seed)
                    once.setdefault(name, s)
                    copies[name] += 1
            found: tuple[list, list] = ([], [])
            sets = list(once.items())
            if not sets:
                continue
            every = np.concatenate([s for _, s in sets])
            if len(lookup):
                at = np.minimum(np.searchsorted(lookup, every), len(lookup) - 1)
                rank = np.where(lookup[at] == every, order[at], -1)
            else:
                rank = np.full(len(every), -1)
            ends = np.cumsum([len(s) for _, s in sets])
            for (name, s), end in zip(sets, ends.tolist(), strict=True):
                for kind, keys in enumerate(prefix_keys(s, rank[end - len(s):end])):
                    if len(keys):
                        found[kind].append((keys, name[0], len(s), copies[name]))
            for kind, rows in enumerate(found):
                if not rows:
                    continue
                keys = np.concatenate([row[0] for row in rows])
                sizes = [len(row[0]) for row in rows]
                nodes, ns, cs = (np.repeat(np.array([row[i] for row in rows], dtype=t), sizes)
                                 for i, t in ((1, np.int64), (2, np.int32), (3, np.int32)))
                if kind:  # frequent keys are only carried along: every slice is a part of its own
                    cuts = np.arange(0, len(keys), 1 << 16)
                    part = [-1 - (hash((rows[0][1], int(c), len(keys))) & (2**62 - 1)) for c in cuts]
                    stops = np.append(cuts[1:], len(keys))
                else:
                    of = ((keys >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
                    by = np.argsort(of, kind="stable")
                    # half of the hash within a part: equal halves of unequal tokens only add candidates
                    keys, nodes, ns, cs, of = keys[by].astype(np.uint32), nodes[by], ns[by], cs[by], of[by]
                    cuts = np.flatnonzero(np.diff(of, prepend=-1))
                    part, stops = of[cuts], np.append(cuts[1:], len(keys))
                yield pd.DataFrame({"part": part,
                                    "keys": [keys[a:b].tobytes() for a, b in zip(cuts, stops, strict=True)],
                                    "nodes": [nodes[a:b].tobytes() for a, b in zip(cuts, stops, strict=True)],
                                    "sizes": [ns[a:b].tobytes() for a, b in zip(cuts, stops, strict=True)],
                                    "copies": [cs[a:b].tobytes() for a, b in zip(cuts, stops, strict=True)]})
            del once, copies, found, sets, every
            release()

    return docs.mapInPandas(run, "part long, keys binary, nodes binary, sizes binary, copies binary")


#: ``n`` holds the set's size in its lower half and the copies that a task has seen in its upper half.
POSTING = "key long, node long, n long"


def _bucket_rows(frame: pd.DataFrame) -> pd.DataFrame:
    """Postings of one part: of rare keys those that two or more sets have, of frequent keys all."""
    part = int(frame["part"].iloc[0])
    raw = b"".join(frame["keys"])
    node = np.frombuffer(b"".join(frame["nodes"]), dtype=np.int64)
    n = np.frombuffer(b"".join(frame["sizes"]), dtype=np.int32).astype(np.int64)
    copies = np.frombuffer(b"".join(frame["copies"]), dtype=np.int32).astype(np.int64)
    if part < 0:
        return pd.DataFrame({"key": np.frombuffer(raw, dtype=np.int64), "node": node, "n": n + (copies << 32)})
    key = np.frombuffer(raw, dtype=np.uint32)
    order = np.lexsort((node, key))
    key, node, n, copies = key[order], node[order], n[order], copies[order]
    first = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))  # batches may repeat a set
    if len(first):
        n, copies = n[first], np.minimum(np.add.reduceat(copies, np.flatnonzero(first)), 2**31 - 1)
    key, node = key[first], node[first]
    same = key[1:] == key[:-1]
    keep = np.append(False, same) | np.append(same, False)
    return pd.DataFrame({"key": key[keep].astype(np.int64) + (part << 32), "node": node[keep], "n": n[keep] + (copies[keep] << 32)})


def _fits(a: str, b: str):
    """Length filter: the smaller set may still reach the threshold."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _in_components(post: DataFrame, components: DataFrame | None) -> DataFrame:
    if components is None:
        return post.withColumn("component", F.col("node"))
    return post.join(shuffled(components), "node", "left").withColumn("component", F.coalesce("component", "node"))


def _split_buckets(post: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Buckets whose sets lie in several components, with a pivot each, and their postings."""
    by = F.struct((-F.col("copies")).alias("often"), F.xxhash64("component", F.lit(turn)).alias("h"), "component", "n", "node")
    buckets = post.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min(by).alias("p"), F.count(F.lit(1)).alias("m"))
    buckets = checkpoint(buckets.where("lo != hi").select(
        "key", F.col("p.node").alias("pivot"), F.col("p.n").alias("pn"), F.col("p.component").alias("pc"), "m"))
    return buckets, post.drop("copies").join(shuffled(buckets), "key")


def _pivot_pairs(rows: DataFrame) -> DataFrame:
    """Every set of a bucket with the bucket's pivot, unless they are in one component already."""
    return (rows.where((F.col("component") != F.col("pc")) & _fits("n", "pn"))
                .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct())


def _least_shared(n):
    """``least_shared`` of a column."""
    return F.when(n > BOTH, 1 + F.floor((n - F.ceil(n * PERCENT / F.lit(100)) + 1) / 2)).otherwise(1)


def _able(post: DataFrame) -> DataFrame:
    """Postings of the sets with at least as many keys as they share with the smallest set that may link."""
    smallest = F.ceil(F.col("n") * PERCENT / F.lit(100))
    able = post.groupBy("node", "n").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= _least_shared(smallest))
    return post.join(shuffled(able.select("node")), "node", "left_semi")


def _rest_pairs(rows: DataFrame) -> DataFrame:
    """All pairs of a bucket of less than LARGE sets that lie in different components: those outside the pivot's with all."""
    rows = rows.where(F.col("m") < LARGE)
    outside = rows.where(F.col("component") != F.col("pc")).select("key", F.col("node").alias("x"), F.col("n").alias("xn"), F.col("component").alias("xc"))
    both = outside.join(shuffled(rows), "key").where(
        (F.col("xc") != F.col("component")) & _fits("xn", "n") & ((F.col("component") == F.col("pc")) | (F.col("x") < F.col("node"))))
    # the pair meets in every bucket that it shares, so its rows count the shared keys
    shared = both.groupBy(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).agg(
        F.count(F.lit(1)).alias("k"), F.min(F.least("xn", "n")).alias("n"))
    return shared.where(F.col("k") >= _least_shared(F.col("n"))).select("a", "b")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose complete sets link, VERIFIED pairs at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, VERIFIED):
            part = batch.slice(start, VERIFIED).to_pydict()
            texts = dict(zip(part["a"], part["ta"], strict=True)) | dict(zip(part["b"], part["tb"], strict=True))
            sets = dict(zip(texts, shingle_sets(list(texts.values())), strict=True))
            linked = []
            for a, b in zip(part["a"], part["b"], strict=True):
                x, y = sorted((sets[a], sets[b]), key=len)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                if 100 * both >= PERCENT * (len(x) + len(y) - both):
                    linked.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([pair[k] for pair in linked], pa.int64()) for k in (0, 1)], names=["a", "b"])
            del part, texts, sets
        del batch
        release()


def _texts(nodes: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``(node, _text)``: the text of the first document of every node, written."""
    spark = docs.sparkSession
    wanted = checkpoint(nodes.join(shuffled(classes), "node").select(
        "node", F.col("first.tid").alias("_tid"), _sieve(F.col("first.tid")).alias("_sieve")))
    # a filter of at most SIEVE rows keeps most texts that nobody wants out of the shuffle
    near = docs.withColumn("_sieve", _sieve(F.col("tid"))).join(F.broadcast(wanted.select("_sieve").distinct()), "_sieve", "left_semi")
    # one row per node: its first document; equal rows of that document count once
    texts = near.join(shuffled(wanted.select("node", F.col("_tid").alias("tid"))), "tid").select("tid", "node", "_text").dropDuplicates(["tid"])
    path = f"{shared_dir(spark)}/texts-{uuid.uuid4().hex}"
    texts.select("node", "_text").write.option("compression", "zstd").parquet(path)  # half of a checkpoint's size
    return spark.read.parquet(path)


def _links(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose whole sets link."""
    pairs = checkpoint(pairs)
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    texts = _texts(nodes, docs, classes)
    both = (pairs.join(shuffled(texts.select(F.col("node").alias("a"), F.col("_text").alias("ta"))), "a")
                 .join(shuffled(texts.select(F.col("node").alias("b"), F.col("_text").alias("tb"))), "b"))
    return checkpoint(both.select("a", "b", "ta", "tb").mapInArrow(_verify, "a long, b long"))


def shared_tokens(sets: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two of the sets share."""
    both = np.zeros((len(sets), len(sets)))
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    token, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:] if len(sets) else (owner, owner)
    column = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)[token]  # tokens of one set are shared by nobody
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        has = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        has[owner[a:b], column[a:b] - start] = 1
        both += has @ has.T
    return both


def _blocks(frames: Iterator[pd.DataFrame], by: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Rows of whole blocks, their names and where each begins, in order of ``by``; a block may go on in the next batch."""
    rest = None
    for frame in itertools.chain(frames, [None]):
        if frame is None:
            ready, rest = rest, None
        else:
            rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            names = rest[by].to_numpy()
            other = np.flatnonzero((names != names[-1]).any(axis=1)) if len(rest) else []
            cut = int(other[-1]) + 1 if len(other) else 0
            ready, rest = rest.iloc[:cut], rest.iloc[cut:]
        if ready is None or not len(ready):
            continue
        names = ready[by].to_numpy()
        yield ready, names, np.append(np.flatnonzero(np.append(True, (names[1:] != names[:-1]).any(axis=1))), len(ready))


def _linked(sets: list[np.ndarray]) -> np.ndarray:
    """Which two of the sets link."""
    size = np.array([len(x) for x in sets], dtype=np.float64)
    both = shared_tokens(sets)
    return 100 * both >= PERCENT * (size[:, None] + size[None, :] - both)


def _merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges that join the nodes of a block which links connect, one a node at most."""
    for ready, _, cuts in _blocks(frames, ["pivot", "i", "j"]):
        for a, b in zip(cuts, cuts[1:], strict=False):
            block = ready.iloc[a:b].drop_duplicates("node")
            linked = _linked(shingle_sets(list(block["_text"])))
            own = of = np.arange(len(block))
            while True:
                low = np.minimum(of, np.where(linked, of, len(of)).min(axis=1))
                if (low == of).all():
                    break
                of = low
            node = block["node"].to_numpy(np.int64)
            yield pd.DataFrame({"a": node[of != own], "b": node[of[of != own]]})
            del block, linked
        release()


def _group_links(rows: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges between the components that links join in buckets of LARGE sets or more.

    The sets that meet a pivot in such buckets form its group.  Those outside the pivot's component are compared
    with the whole group, in blocks of ``BLOCK`` of them against ``BLOCK`` of the group.
    """
    outside = F.max((F.col("component") != F.col("pc")).cast("int"))
    members = checkpoint(rows.where(F.col("m") >= LARGE).groupBy("pivot", "node").agg(outside.alias("out")))
    sizes = members.groupBy("pivot").agg(F.sum("out").alias("o"), F.count(F.lit(1)).alias("g")).where("o > 0")
    nodes = checkpoint(members.join(shuffled(sizes), "pivot"))
    if nodes.isEmpty():
        return checkpoint(nodes.select(F.col("node").alias("a"), F.col("node").alias("b")))

    def blocks(size: str):
        return F.ceil(F.col(size) / F.lit(BLOCK)).cast("int")

    def own(size: str):
        return F.pmod(F.xxhash64("node"), blocks(size)).cast("int")

    def every(size: str):
        return F.explode(F.sequence(F.lit(0), blocks(size) - 1))

    dealt = nodes.where("out = 1").select("node", "pivot", own("o").alias("i"), every("g").alias("j")).union(
        nodes.select("node", "pivot", every("o").alias("i"), own("g").alias("j")))
    tasks = dealt.join(shuffled(_texts(nodes.select("node").distinct(), docs, classes)), "node")
    tasks = tasks.repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j")
    return checkpoint(tasks.select("pivot", "i", "j", "node", "_text").mapInPandas(_merge, "a long, b long"))


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of every node found in the blocks."""
    for ready, names, cuts in _blocks(frames, ["component", "i", "j"]):
        links = np.zeros(len(ready), dtype=np.int64)
        copies, side, texts = ready["copies"].to_numpy(np.int64), ready["side"].to_numpy(), list(ready["_text"])
        for a, b in zip(cuts, cuts[1:], strict=False):
            linked = _linked(shingle_sets(texts[a:b]))
            linked &= (side[a:b, None] != side[None, a:b]) if names[a, 1] != names[a, 2] else ~np.eye(b - a, dtype=bool)
            links[a:b] = linked @ copies[a:b]
            del linked
        yield pd.DataFrame({"node": ready["node"].to_numpy(np.int64), "links": links})
        release()


def _link_counts(of: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``(node, links)``: rows of other nodes that link with it, for the nodes of components of two or more.

    ``of`` is ``(node, component, copies)``.  A node's text is sent once for every ``BLOCK`` nodes of its component.
    """
    many = of.groupBy("component").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    nodes = checkpoint(of.join(shuffled(many), "component"))
    blocks = F.ceil(F.col("m") / F.lit(BLOCK)).cast("int")
    dealt = nodes.withColumn("side", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn(
        "t", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "node", "component", "copies", F.least("side", "t").alias("i"), F.greatest("side", "t").alias("j"), "side")
    tasks = dealt.join(shuffled(_texts(nodes.select("node"), docs, classes)), "node")
    tasks = tasks.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    found = tasks.select("component", "i", "j", "side", "node", "copies", "_text").mapInPandas(_count, "node long, links long")
    return checkpoint(found.groupBy("node").agg(F.sum("links").alias("links")))


def _sieve(tid):
    return F.pmod(tid, F.lit(SIEVE)).cast("int")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS,
                       stays: bool = False, count: bool = False) -> DataFrame:
    """``(key, tid, n_shingles, component_id)``, one row per input row; ``tid`` is
    xxhash64 of the key as text and the text.  With ``count`` a column ``n_links`` follows: the other rows
    that a row links with directly, equal texts among them (0 for empty sets).

    ``component_id`` is the least key reachable by links, the row's own included.  Texts that are null
    or hold no word have empty sets and link with nothing (component: their own key); rows of fewer
    than five words link by their whole word sequence; repeated rows and equal texts share a component;
    null keys are ignored by the least key (a component of null keys only has null).  Other columns are
    not read.  An empty table gives an empty result.  With ``stays`` a last column tells the rows of the
    least ``(key, tid)`` of each component, null keys last, and the rows with empty sets.
    """
    kind = docs.schema[key].dataType
    # as text: pandas has no whole numbers beside nulls
    d = docs.select(F.col(key).cast("string").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    d = d.withColumn("tid", F.xxhash64("_key", "_text"))
    # the row that stays, found class by class and then per component, so no key gathers a group's rows
    row = F.struct(F.col("_key").isNull().alias("none"), F.col("_key").cast(kind).alias("key"), "tid")
    best = ["best"] if stays else []
    for seed in range(8):
        told = checkpoint(_describe(d, seed))
        rows = told.where("kind = 0 and n > 0")
        classes = checkpoint(rows.groupBy("node").agg(
            F.min(F.col("_key").cast(kind)).alias("least"), F.min(F.struct("_key", "tid")).alias("first"),
            F.min("check").alias("c0"), F.max("check").alias("c1"), F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("copies"),
            *[F.min(row).alias(c) for c in best]))
        if classes.where("c0 != c1").isEmpty():  # no two sets share a 64-bit name
            break
    else:
        raise RuntimeError("64-bit names of sets collide under every seed")
    tidy(docs.sparkSession)
    frequent = frequent_tokens(told.where("kind = 1"))
    tokens = classes.agg(F.sum(F.col("tokens") / F.col("copies"))).first()[0] or 0
    parts = max(64, math.ceil(tokens * (100 - PERCENT) / 100 * 1.5 / PART_TOKENS))

    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # at most MOST_FREQUENT numbers
    post = checkpoint(_postings(d, seed, shared, parts).groupBy("part").applyInPandas(_bucket_rows, POSTING))
    post = post.select("key", "node", F.col("n").bitwiseAND(F.lit(2**32 - 1)).cast("int").alias("n"), F.shiftright("n", 32).cast("int").alias("copies"))
    shared.destroy()  # the postings are written
    tidy(docs.sparkSession)

    components, links = None, None
    for turn in range(rounds + 1):
        last = turn == rounds
        buckets, rest = _split_buckets(_in_components(_able(post) if last else post, components), turn)
        if buckets.isEmpty():
            break
        found = _links(_rest_pairs(rest) if last else _pivot_pairs(rest), d, classes)
        if last:
            found = found.union(_group_links(rest, d, classes))
        links = found if links is None else links.union(found)
        tidy(docs.sparkSession)
        components = checkpoint(connected_components(links))
        tidy(docs.sparkSession)

    if components is None:
        named = classes.select("node", F.col("least").alias("component_id"), *best)
    else:
        of = classes.join(shuffled(components), "node", "left").withColumn("component", F.coalesce("component", "node")).select("node", "component", "least", *best)
        least = checkpoint(of.groupBy("component").agg(F.min("least").alias("component_id"), *[F.min(c).alias(f"_{c}") for c in best]))
        named = of.join(shuffled(least), "component").select("node", "component_id", *[F.col(f"_{c}").alias(c) for c in best])
    if count:
        tidy(docs.sparkSession)
        links = F.col("copies") - 1
        if components is not None:
            inside = _link_counts(checkpoint(of.join(shuffled(classes.select("node", "copies")), "node").select("node", "component", "copies")), d, classes)
            counted = classes.join(shuffled(inside), "node", "left").select("node", (links + F.coalesce("links", F.lit(0))).alias("n_links"))
        else:
            counted = classes.select("node", links.alias("n_links"))
        named = named.join(shuffled(counted), "node")
    named = checkpoint(named)
    every = told.where("kind = 0").select("_key", "tid", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("node")).alias("node"))
    out = every.join(shuffled(named), "node", "left")
    own = F.col("_key").cast(kind)
    chosen = (F.col("n_shingles") == 0) | (own.eqNullSafe(F.col("best.key")) & (F.col("tid") == F.col("best.tid"))) if stays else None
    return out.select(own.alias(key), "tid", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(own).alias("component_id"),
                      *([F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")] if count else []),
                      *([chosen.alias("stays")] if stays else []))


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), count=True).drop("tid")


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group the row with the least ``(key, tid)`` stays, null keys last (of repeated rows one)."""
    tid = F.xxhash64(F.col("doc_id").cast("string"), F.coalesce(F.col("text"), F.lit("")))
    found = jaccard_components(docs, stays=True).withColumnsRenamed({"doc_id": "_key", "tid": "_tid"})
    gone = found.where(~F.col("stays")).select("_key", "_tid").distinct()
    kept = docs.join(gone, docs["doc_id"].eqNullSafe(F.col("_key")) & (tid == F.col("_tid")), "left_anti")
    again = found.groupBy("_key", "_tid").count().where("count > 1").select("_key", "_tid")
    if again.isEmpty():
        return kept
    same = kept["doc_id"].eqNullSafe(F.col("_key")) & (tid == F.col("_tid"))
    once = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, same, "left_anti").unionByName(once)


ORACLE_OP1 = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT rid, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct([array_to_string(ws[i : i + 4], ' ') FOR i IN range(1, len(ws) - 3)]) END AS ss FROM w),
t AS (SELECT rid, len(ss) AS n, unnest(ss) AS token FROM s),
met AS (
  SELECT a.rid AS x, b.rid AS y, a.n AS xn, b.n AS yn, count(*) AS k
  FROM t a JOIN t b ON a.token = b.token AND a.rid < b.rid GROUP BY ALL),
links AS (SELECT x, y FROM met WHERE 100 * k >= 75 * (xn + yn - k)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT rid, rid FROM s UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
least AS (SELECT reach.x AS rid, min(s.doc_id) AS component_id FROM reach JOIN s ON s.rid = reach.y GROUP BY reach.x)
SELECT s.doc_id, len(ss)::BIGINT AS n_shingles, least.component_id,
       (SELECT count(*) FROM edges WHERE edges.x = s.rid)::BIGINT AS n_links
FROM s JOIN least ON least.rid = s.rid
"""
