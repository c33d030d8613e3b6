"""SimHash near-duplicates (operator 1).

A document's fingerprint is the bitwise majority of the XXH64 hashes of its word
shingles.  Fingerprints that differ in few bits link; connected documents are
one component.

Links are found by blocks of bits: with radius r and b blocks, two fingerprints
within the radius agree in at least b - r blocks, so each fingerprint is dealt
to every choice of b - r blocks and met there by all that agree.  A bucket is
compared bit-sliced: its fingerprints are stored as 64 bit planes, lanes of 64
fingerprints to a word; differing planes are added into carry-save counters, and
words all of whose lanes are beyond the radius are abandoned.

A bucket gives about a spanning forest of its links, not its pairs, and one copy
of a text stands for all of them (fingerprints are distinct).  Many buckets of up
to ``MEDIUM`` fingerprints are compared by one call; in a larger one many
fingerprints meet all others at once, and those that are one component already
needn't meet each other, so a bucket of near copies costs about its size.  A
bucket larger than ``block`` is compared block against block, each pair of blocks
a group of its own, so no task holds an unbounded bucket.

Defined results: null and empty texts have fingerprint zero and link like any
other; a null doc_id is never a component's id unless it has no other; repeated
rows each come back; very long texts are hashed whole, in runs of shingles; a bit
set in just half the hashes is 0; extra columns, whatever their names, are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_rows, discard, fresh, small_batches, stored
from .components import components
from .minhash import near_copies

WORDS, RADIUS, SEED = 4, 4, 42
BLOCKS, BLOCK_ROWS = 6, 1 << 14
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: White space of the word rule, so that bytes.split() can be used: 28 to 31 aren't spaces here, nor there.


def fingerprint(text: str, words: int = WORDS) -> int:
    """Majority of the shingles' hashes; 0 without a word."""
    w = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not w:
        return 0
    if len(w) <= words:
        return xxhash.xxh64_intdigest(b" ".join(w), SEED)
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    n = len(w) - words + 1
    b, e = begins[:n].tolist(), ends[words - 1 :].tolist()
    return majority(np.array([digest(joined[x:y], SEED) for x, y in zip(b[i : i + 4096], e[i : i + 4096], strict=True)], dtype=np.uint64) for i in range(0, n, 4096))


def majority(runs: Iterable[np.ndarray]) -> int:
    """Fingerprint of hashes, given in runs: the bits set in over half of them."""
    total, n = np.zeros(64, np.int64), 0
    for h in runs:
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    bits = (2 * total > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = WORDS) -> DataFrame:
    """``docs`` without the text, with ``fp``: the fingerprint as a signed 64-bit number."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = np.fromiter((fingerprint(x or "", words) for x in pdf[text]), np.uint64, len(pdf))
            out = pdf.drop(columns=[text]).assign(fp=fp.view(np.int64))
            yield out.astype({"doc_id": "Int64"})

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text)
    return docs.mapInPandas(run, f"{kept}, fp long")


_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def planes(fp: np.ndarray) -> np.ndarray:
    """64 bit planes of uint64 fingerprints, each plane packed 64 lanes to a word (last word filled with zeros)."""
    lanes = np.zeros(-(-max(len(fp), 1) // 64) * 64, np.uint64)
    lanes[: len(fp)] = fp
    bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within(p: np.ndarray, flip: np.ndarray | None = None, radius: int = RADIUS, step: int = 8) -> np.ndarray:
    """Lanes (packed) with at most ``radius`` planes set, after the planes that ``flip`` names are inverted.

    Counters are kept as planes too: ones, twos, fours, and ``over`` for lanes
    that went beyond 7.  After every ``step`` planes, words in which all lanes
    are beyond the radius are abandoned.
    """
    if radius > 7:
        raise ValueError("the counters hold up to 7")
    alive = None
    ones, twos, fours, over = (np.zeros(p.shape[1], np.uint64) for _ in range(4))
    beyond = over
    for k in range(0, 64, step):
        x = p[k : k + step] if alive is None else p[k : k + step, alive]
        if flip is not None:
            x = x ^ flip[k : k + step, None]
        for row in x:
            c = ones & row
            ones = ones ^ row
            c2 = twos & c
            twos = twos ^ c
            over = over | (fours & c2)
            fours = fours ^ c2
        beyond = over | _greater(ones, twos, fours, radius)
        live = beyond != _FULL
        if not live.all():
            alive = np.flatnonzero(live) if alive is None else alive[live]
            ones, twos, fours, over, beyond = ones[live], twos[live], fours[live], over[live], beyond[live]
            if not len(alive):
                break
    if alive is None:
        return ~beyond
    out = np.zeros(p.shape[1], np.uint64)
    out[alive] = ~beyond
    return out


def _greater(ones: np.ndarray, twos: np.ndarray, fours: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count (0 to 7) is above the radius."""
    above, equal = np.zeros_like(ones), np.full_like(ones, 0xFFFFFFFFFFFFFFFF)
    for plane, bit in ((fours, radius >> 2 & 1), (twos, radius >> 1 & 1), (ones, radius & 1)):
        if bit:
            equal = equal & plane
        else:
            above, equal = above | (equal & plane), equal & ~plane
    return above


def lanes(packed: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(packed.view(np.uint8), bitorder="little", count=n))


def _flips(fp: np.ndarray) -> np.ndarray:
    """64 rows of words: all bits of a word are those of its fingerprint's bit."""
    return np.uint64(0) - ((fp[None, :] >> np.arange(64, dtype=np.uint64)[:, None]) & np.uint64(1))


#: Words of lanes that are compared by one call, so that its cost is the words' own.
WORDS_AT_ONCE = 1 << 12


def forest(fp: np.ndarray, radius: int = RADIUS) -> tuple[list[int], list[int]]:
    """Edges (places) that connect what links: many fingerprints at once meet the lanes left, until these are one component."""
    left, right, n = [], [], len(fp)
    tree, rest = np.arange(n), np.arange(n)  # the tree of each, and who hasn't met all others yet
    at, p, together = rest, planes(fp), 4  # few at first: they find out what is one large tree
    while True:
        trees = tree[rest]
        if len(rest) < 2 or (trees == trees[0]).all():
            return left, right
        # members of the largest tree come last: they needn't meet each other
        most = np.bincount(trees).argmax()
        turn = np.concatenate([np.flatnonzero(trees != most), np.flatnonzero(trees == most)])[: max(1, min(together, WORDS_AT_ONCE // p.shape[1]))]
        own, together = rest[turn], 8 * together
        met = (p[:, None, :] ^ _flips(fp[own])[:, :, None]).reshape(64, -1)
        hit = within(met, None, radius).view(np.uint8).reshape(len(own), -1)
        row, lane = np.nonzero(np.unpackbits(hit, axis=1, bitorder="little", count=len(at)))
        apart = tree[own[row]] != tree[at[lane]]
        row, lane = row[apart], at[lane[apart]]
        for r in np.unique(row).tolist():
            q, found = own[r], lane[np.searchsorted(row, r) : np.searchsorted(row, r, "right")]
            found = found[tree[found] != tree[q]]
            if len(found):
                joined, first = np.unique(tree[found], return_index=True)
                left += [int(q)] * len(first)
                right += found[first].tolist()
                named = np.zeros(n, bool)
                named[joined] = True
                tree[named[tree]] = tree[q]
        rest = np.delete(rest, turn)
        if 2 * len(rest) < len(at) and len(at) > 256:
            at, p = rest, planes(fp[rest])


#: Buckets up to this size are compared together, larger ones one by one.
MEDIUM = 1 << 8


def _spans(end: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (places) of each place with the next ones before its ``end``, less those that others make needless.

    All fingerprints lie in the lanes of one row of words; a place meets the words from it to its end.
    """
    left, right, p = [np.empty(0, np.int64)], [np.empty(0, np.int64)], planes(fp)
    place = np.flatnonzero(np.arange(1, len(fp) + 1) < end)
    begin, last = (place + 1) >> 6, (end[place] - 1) >> 6
    upto = np.cumsum(last - begin + 1)
    cut = 0
    while cut < len(place):
        done = int(upto[cut - 1]) if cut else 0
        to = max(cut + 1, int(np.searchsorted(upto, done + WORDS_AT_ONCE, "right")))
        n = last[cut:to] - begin[cut:to] + 1
        q = np.repeat(place[cut:to], n)
        word = np.arange(len(q)) - np.repeat(upto[cut:to] - n - done, n) + np.repeat(begin[cut:to], n)
        hit = within(p[:, word] ^ _flips(fp[q]), None, radius)
        after, upper = q + 1, end[q] - 1  # lanes from the next one to the bucket's last
        hit &= np.where(word == after >> 6, _FULL << (after & 63).astype(np.uint64), _FULL)
        hit &= np.where(word == upper >> 6, _FULL >> (63 - (upper & 63)).astype(np.uint64), _FULL)
        some = np.flatnonzero(hit)
        if len(some):
            row, lane = np.nonzero(np.unpackbits(hit[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            a, b = q[some[row]], (word[some[row]] << 6) + lane
            # the first that links to b stands for it; every other one needs one link to that first one's
            _, first, of = np.unique(b, return_index=True, return_inverse=True)
            _, other = np.unique(a[first][of] * len(fp) + a, return_index=True)
            keep = np.union1d(first, other)
            left.append(a[keep])
            right.append(b[keep])
        cut = to
    return np.concatenate(left), np.concatenate(right)


def bucket_edges(key: np.ndarray, fp: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal keys (sorted): about a spanning forest of each.  Runs up to ``MEDIUM`` are compared together."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(key)]]))
    of = np.repeat(sizes, sizes)
    some = (of > 1) & (of <= MEDIUM)
    own, length = fp[some], sizes[(sizes > 1) & (sizes <= MEDIUM)]
    a, b = _spans(np.repeat(np.cumsum(length), length), own, radius)
    left, right = [own[a]], [own[b]]
    for r in np.flatnonzero(sizes > MEDIUM):
        own = fp[starts[r] : starts[r] + sizes[r]]
        a, b = forest(own, radius)
        left.append(own[a])
        right.append(own[b])
    return np.concatenate(left), np.concatenate(right)


def _links(radius: int):
    """Streams over sorted buckets; holds one bucket (bounded by two blocks) besides a batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_k, held_f = [], []

        def done(k: np.ndarray, f: np.ndarray) -> pd.DataFrame:
            a, b = bucket_edges(k, f, radius)
            return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)}).drop_duplicates()

        last = None
        for pdf in batches:
            k, f = pdf["bucket"].to_numpy(np.int64), pdf["fp"].to_numpy(np.int64).view(np.uint64)
            if not len(k):
                continue
            cut = int(np.searchsorted(k, k[-1]))  # from here on the last bucket may go on in the next batch
            if cut or (last is not None and k[0] != last):
                yield done(np.concatenate([*held_k, k[:cut]]), np.concatenate([*held_f, f[:cut]]))
                held_k, held_f = [], []
            held_k.append(k[cut:])
            held_f.append(f[cut:])
            last = k[-1]
        if held_k:
            yield done(np.concatenate(held_k), np.concatenate(held_f))

    return run


def bands(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Rows (bucket, fp): each fingerprint under the hash of every choice of ``blocks - radius`` of its blocks."""
    edge = [round(64 * i / blocks) for i in range(blocks + 1)]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << edge[i + 1]) - (1 << edge[i])) for i in chosen)
        keys.append(F.xxhash64(F.lit(n), F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))))
    return distinct.select("fp", F.explode(F.array(*keys)).alias("bucket"))


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, block: int = BLOCK_ROWS) -> DataFrame:
    """Edges (a, b) that connect distinct fingerprints within the radius."""
    dealt = bands(distinct, radius, blocks)
    sizes = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    # blocks of a large bucket: every two of them meet in a group of their own
    parts = F.coalesce(F.ceil(F.col("n") / block), F.lit(1)).cast("int")
    mine = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts")).cast("int")
    split = dealt.join(sizes, "bucket", "left").withColumn("parts", parts).withColumn("mine", mine)
    met = F.when(F.col("parts") == 1, F.array(F.col("bucket"))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.xxhash64(F.col("bucket"), F.least(j, F.col("mine")), F.greatest(j, F.col("mine"))))
    )
    dealt = split.select("fp", F.explode(met).alias("bucket"))
    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(_links(radius), "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", words: int = WORDS, radius: int = RADIUS, blocks: int = BLOCKS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (doc_id, columns to keep, fp, component_id, root), one for each row; root is a fingerprint that names the component."""
    docs = docs.select("doc_id", text, *keep)
    prints = stored(fingerprints(docs, text, words), "fingerprints")
    first = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("id")), "distinct")
    with batch_rows(docs.sparkSession, 1 << 16):
        edges = stored(links(first.select("fp"), radius, blocks), "links")
    joined = components(edges)  # only fingerprints that have a link
    linked = joined.join(first, joined["node"] == first["fp"]).select("fp", "root", "id")
    least = linked.groupBy("root").agg(F.min("id").alias("component"))
    named = linked.join(least, "root").select("fp", "root", "component")
    # written first, so that adaptive execution can split the join of a fingerprint that very many rows have
    roots = stored(first.join(named, "fp", "left").select("fp", F.coalesce("component", "id").alias("component_id"), F.coalesce("root", "fp").alias("root")), "roots")
    discard(first, edges)
    return prints.join(roots, "fp").select(*prints.columns, "component_id", "root")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = near_duplicates(docs)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


STAGE_RADIUS, STAGE_BLOCKS = 6, 8


def set_fingerprint(hashes: np.ndarray) -> int:
    """Fingerprint of a set of shingles' hashes."""
    return majority(hashes[i : i + 4096] for i in range(0, len(hashes), 4096))


def stage_links(distinct: DataFrame) -> DataFrame:
    """Operator 1's links of distinct fingerprints, with the stage's radius."""
    return links(distinct, STAGE_RADIUS, STAGE_BLOCKS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each component of near copies stays, that with the smallest id.

    Operator 1's fingerprints and links find candidates, with parameters of the
    stage: five-word shingles, each once, and 6 bits by 8 blocks.  An exact test of
    each candidate follows: sets of shingles of similarity 0.8 or more link.  Copies
    at 0.8 differ in some 10 bits of 64, which no choice of blocks can search, so
    bands of least hashes add the candidates beyond the radius (see ``minhash``) and
    none is lost.  Of rows that repeat id and text, one stays; where no row of a
    component has an id, one of its rows does.
    """
    name, digest, at = fresh(docs, "_id", "_hash", "_at")
    keyed = docs.withColumns({name: F.coalesce(F.col("doc_id").cast("string"), F.lit("")), digest: F.xxhash64(F.coalesce("text", F.lit("")))})
    named = keyed.withColumn(at, F.struct(F.col("doc_id").isNull().alias("n"), "doc_id"))
    groups = near_copies(named.select(name, digest, at, "text"), (name, digest), (at,), fingerprint=set_fingerprint, linked=stage_links)
    keep = groups.groupBy("root").agg(F.min(F.struct(at, name, digest)).alias("r")).select(F.col("r")[name].alias(name), F.col("r")[digest].alias(digest)).distinct()
    keep = stored(keep, "kept")
    return keyed.join(keep, [name, digest], "left_semi").dropDuplicates([name, digest]).select(*docs.columns)
