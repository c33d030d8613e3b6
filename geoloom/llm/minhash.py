"""Near copies by the similarity of their word shingles, for the pipeline's stage.

Two texts link where the Jaccard similarity of their sets of ``WORDS``-word
shingles is ``LEAST`` or more; connected texts are one component.

Texts whose fingerprints link are candidates (operator 1, see ``simhash``), and so are those beyond its
radius that bands find: texts that agree in all ``ROWS`` least hashes of one of ``BANDS`` bands meet: a
pair at similarity s does with probability 1 - (1 - s ** ROWS) ** BANDS, 0.9999
at 0.8 and more above, so one link in ten thousand at the limit itself is missed
and fewer beyond.  Texts that meet, directly or over others, go to one group
each text once, and there the similarity itself decides: every text that is
reached is compared with all that aren't yet.  A group beyond ``BLOCK_CHARS`` or
``BLOCK_TEXTS`` is compared block against block, each pair of blocks a group of
its own, so no task holds an unbounded group.

Defined results: words are those of operator 1; a text of at most ``WORDS`` words
has itself as its one shingle; null texts and texts without a word are copies of
each other; texts with the same set of shingles count once in all comparisons; a
similarity of just the limit links; very long texts are compared whole; columns
other than those asked for are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_rows, discard, small_batches, stored
from .components import components

WORDS, LEAST, SEED = 5, 0.8, 42
BANDS, ROWS = 40, 7
BLOCK_CHARS, BLOCK_TEXTS = 1 << 24, 1 << 12
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_RANDOM = np.random.Generator(np.random.PCG64(13))
_TIMES = (_RANDOM.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_PLUS = _RANDOM.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)[:, None]


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words."""
    w = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not w:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(w) <= words:
        return np.array([digest(b" ".join(w), SEED)], np.uint64)
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    n = len(w) - words + 1
    pairs = zip(begins[:n].tolist(), ends[words - 1 :].tolist(), strict=True)
    return np.unique(np.fromiter((digest(joined[x:y], SEED) for x, y in pairs), np.uint64, n))


def band_keys(s: np.ndarray) -> np.ndarray:
    """One key for each band, of the least values of the shingles under its ``ROWS`` hash functions.

    The functions work on 32 bits, which processors multiply many at a time; chance agreement of values is for the exact test.
    """
    low = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    s = s.astype(np.uint32)
    for i in range(0, len(s), 512):
        x = s[None, i : i + 512] * _TIMES
        x += _PLUS
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x85EBCA6B)  # the upper half decides
        low = np.minimum(low, x.min(axis=1))
    key = np.arange(BANDS, dtype=np.uint64)
    for column in low.astype(np.uint64).reshape(BANDS, ROWS).T:
        key = (key * np.uint64(0x9FB21C651E98DF25)) ^ column
        key ^= key >> np.uint64(29)
        key *= np.uint64(0xBF58476D1CE4E5B9)
    return key ^ (key >> np.uint64(32))


def signatures(docs: DataFrame, text: str, fingerprint: Callable[[np.ndarray], int] | None = None) -> DataFrame:
    """``docs`` without the text, with ``key`` (hash of the set of shingles), its characters, its band keys and ``fp``, its fingerprint (0 without a function for it)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys, fp, bands = np.empty(len(pdf), np.uint64), np.zeros(len(pdf), np.uint64), []
            for i, x in enumerate(pdf[text]):
                s = shingles(x or "")
                keys[i] = xxhash.xxh64_intdigest(s.tobytes(), SEED)
                if fingerprint is not None:
                    fp[i] = fingerprint(s)
                bands.append(band_keys(s).view(np.int64))
            sizes = [len(x or "") for x in pdf[text]]
            yield pdf.drop(columns=[text]).assign(key=keys.view(np.int64), chars=sizes, bands=bands, fp=fp.view(np.int64))

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text)
    return docs.mapInPandas(run, f"{kept}, key long, chars long, bands array<long>, fp long")


def forest(sets: list[np.ndarray], least: float = LEAST) -> tuple[list[int], list[int]]:
    """Edges (places) that connect the sets that link: what is reached is compared with all that isn't yet."""
    sizes = np.array([len(s) for s in sets], np.int64)
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1] if sizes.sum() else np.empty(0, np.int64)
    ends = np.cumsum(sizes)
    mark = np.zeros(int(codes.max()) + 1 if len(codes) else 1, bool)
    left, right, queue = [], [], []
    rest = np.arange(len(sets))
    own, of = codes, np.repeat(rest, sizes)  # of those not reached
    live = np.ones(len(sets), bool)
    while len(rest):
        if queue:
            q = queue.pop()
        else:
            q = int(rest[0])
            live[q] = False
            rest = rest[1:]
            if not len(rest):
                break
        mine = codes[ends[q] - sizes[q] : ends[q]]
        mark[mine] = True
        both = np.bincount(of[mark[own]], minlength=len(sets))[rest]
        mark[mine] = False
        total = sizes[q] + sizes[rest] - both
        # whole numbers on both sides, so that a similarity of just the limit counts
        found = rest[(both >= least * total - 1e-9) & (total > 0)]
        if len(found):
            left += [q] * len(found)
            right += found.tolist()
            queue += found.tolist()
            live[found] = False
            rest = rest[live[rest]]
        if len(own) > 2 * int(sizes[rest].sum()):
            keep = live[of]
            own, of = own[keep], of[keep]
    return left, right


def _compared(least: float):
    """Streams over sorted groups; holds one group besides a batch."""

    def edges_of(keys: list[int], texts: list[str]) -> tuple[list[int], list[int]]:
        of = dict(zip(keys, texts, strict=True))  # repeated rows once
        names = list(of)
        a, b = forest([shingles(x) for x in of.values()], least)
        return [names[i] for i in a], [names[i] for i in b]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, keys, texts, a, b = None, [], [], [], []
        for pdf in batches:
            for g, k, x in zip(pdf["group"].tolist(), pdf["key"].tolist(), pdf["text"].tolist(), strict=True):
                if g != last and keys:
                    x_, y_ = edges_of(keys, texts)
                    a += x_
                    b += y_
                    keys, texts = [], []
                last = g
                keys.append(k)
                texts.append(x or "")
            if a:
                yield pd.DataFrame({"a": a, "b": b}, dtype="int64")
                a, b = [], []
        if keys:
            a, b = edges_of(keys, texts)
            if a:
                yield pd.DataFrame({"a": a, "b": b}, dtype="int64")

    return run


def _by_fingerprints(first: DataFrame, linked: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Edges (a, b) of keys: sets with one fingerprint, and one set for each of two that link."""
    heads = stored(first.groupBy("fp").agg(F.min("key").alias("head")), "heads")
    same = first.join(heads, "fp").where("key <> head").select(F.col("head").alias("a"), F.col("key").alias("b"))
    edges = stored(linked(heads.select("fp")).distinct(), "links")
    ends = [heads.select(F.col("fp").alias(c), F.col("head").alias(f"key_{c}")) for c in "ab"]
    return same.unionByName(edges.join(ends[0], "a").join(ends[1], "b").select(F.col("key_a").alias("a"), F.col("key_b").alias("b")))


def near_copies(docs: DataFrame, ids: tuple[str, ...], keep: tuple[str, ...] = (), text: str = "text", least: float = LEAST, block_chars: int = BLOCK_CHARS, block_texts: int = BLOCK_TEXTS, fingerprint: Callable[[np.ndarray], int] | None = None, linked: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows (ids, columns to keep, root), one for each row; rows of one root are one component.

    ``ids`` name a text: rows that repeat them have the same one.  ``fingerprint`` of a
    set of shingles and ``linked``, edges (a, b) of a table of distinct ``fp``, give
    candidates besides those of the bands.
    """
    docs = docs.select(*ids, *keep, text)
    prints = stored(signatures(docs, text, fingerprint), "signatures")
    first = prints.groupBy("key").agg(F.min(F.struct(*ids)).alias("one"), F.max("chars").alias("chars"), F.first("bands").alias("bands"), F.first("fp").alias("fp"))
    first = stored(first, "sets")
    with batch_rows(docs.sparkSession, 1 << 16):
        met = first.select("key", F.explode("bands").alias("bucket"))
        hubs = met.groupBy("bucket").agg(F.min("key").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
        # tables that are joined by a key which very many rows may have are written first, so that adaptive execution can split the join
        hubs = stored(hubs, "hubs")
        met = met.join(hubs, "bucket").where("key <> hub").select(F.col("hub").alias("a"), F.col("key").alias("b"))
        if linked is not None:
            met = met.unionByName(_by_fingerprints(first, linked))
        near = components(stored(met.distinct(), "met"))
    near = stored(near, "groups")
    sizes = near.join(first.select(F.col("key").alias("node"), "chars"), "node").groupBy("root").agg(F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("n"))
    parts = F.greatest(F.ceil(F.col("chars") / block_chars), F.ceil(F.col("n") / block_texts), F.lit(1)).cast("int")
    sizes = stored(sizes.select("root", parts.alias("parts")), "sizes")
    mine = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int")
    # blocks of a large group: every two of them meet in a group of their own
    pairs = F.when(F.col("parts") == 1, F.array(F.xxhash64("root"))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.xxhash64("root", F.least(j, F.col("mine")), F.greatest(j, F.col("mine"))))
    )
    dealt = near.join(sizes, "root").withColumn("mine", mine).select(F.col("node").alias("key"), F.explode(pairs).alias("group"))
    dealt = dealt.join(first.select("key", "one.*"), "key")
    whole = docs.select(*ids, F.col(text).alias("text")).join(dealt, list(ids)).select("group", "key", "text")
    links = whole.repartition("group").sortWithinPartitions("group").mapInPandas(_compared(least), "a long, b long")
    joined = stored(components(stored(links.distinct(), "links")), "components")
    discard(hubs, near, sizes, first)
    return prints.select(*ids, *keep, "key").join(joined, prints["key"] == joined["node"], "left").select(*ids, *keep, F.coalesce("root", "key").alias("root"))
