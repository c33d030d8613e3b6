"""Removal of long repeated strings with suffix arrays (operator 7).

Every byte that lies in a string of ``length`` bytes which also starts elsewhere,
in any document, goes.  The same order tells which bytes lie in repeated strings
of ``shorter`` bytes; these are counted and stay.

1. Candidates.  Each window of ``shorter`` bytes has one anchor, the 32-byte gram
   in it with the least hash (the leftmost of equals).  Equal windows have equal
   anchors at the same place, so a window whose anchor gram occurs once in the
   corpus occurs once.  Windows of a document in a row share anchors; only one row
   for about 113 bytes is shuffled, and counts are combined before the shuffle.
2. The stretches of text around repeated anchors are dealt by anchor and sorted
   in blocks by two-stage suffix sorting: suffixes smaller than their successors
   are sorted directly, the others induced by one scan over the buckets.  Windows
   that are adjacent in that order and share ``length`` bytes occur twice.
3. The stretches of an anchor with more windows than a block are dealt over
   several groups from the start, by their texts.  The distinct windows of each
   such block meet again by digest, so what repeats across blocks is found too,
   without any task holding, or streaming over, the whole anchor.

Texts that occur several times are looked at once: they go as a whole if they
have ``length`` bytes.

Defined results: a null or empty text has no byte and no span; a repeated row is
a copy of its text; repeats count wherever they start, overlapping themselves
too; of grams with equal hashes in a window the leftmost is the anchor, which no
bound of a slice or block changes; very long texts are cut into no pieces; extra
columns, whatever their names, are ignored; rows with a null doc_id are judged
like any other; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, small_batches, stored, text_of

LENGTH, SHORTER, GRAM = 400, 256, 32
BLOCK = 1 << 16  # windows sorted together
SLICE = 1 << 18  # bytes looked at together
_PLACE = np.uint64(34)  # bits of a key that hold the place in a slice; the others hold the hash
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


def _words8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number."""
    n = len(data) - 7
    out = np.empty(max(n, 0), np.uint64)
    for o in range(min(8, max(n, 0))):
        m = (len(data) - o) // 8
        out[o::8] = data[o : o + 8 * m].view("<u8")[: len(out[o::8])]
    return out


def anchors(texts: list[bytes], length: int = SHORTER) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, last window, hash of the anchor) for each run of windows with one anchor."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    begins = ends - np.array([len(t) for t in texts])
    x = _words8(data)
    n = len(x) - GRAM + 8
    h = x[:n] * _M[0]
    for j in range(1, GRAM // 8):
        h ^= h >> np.uint64(29)
        h += x[8 * j : 8 * j + n]
        h *= _M[j]
    h ^= h >> np.uint64(32)
    bits, place = _PLACE, np.arange(n, dtype=np.uint64)
    key = (h >> bits << bits) | place
    width, have, m = length - GRAM + 1, 1, key
    while 2 * have <= width:
        m = np.minimum(m[: len(m) - have], m[have:])
        have *= 2
    if have < width:
        m = np.minimum(m[: len(m) - (width - have)], m[width - have :])
    good = ends - begins >= length
    lo, hi = begins[good], ends[good] - length + 1  # first windows, one past the last
    count = hi - lo
    s = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    if not len(s):
        e = np.empty(0, np.int64)
        return e, e, e, np.empty(0, np.uint64)
    at = (m[s] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (s[1:] != s[:-1] + 1)]))
    last = np.concatenate([new[1:], [len(s)]]) - 1
    text = np.searchsorted(ends, s[new], side="right")
    return text, s[new] - begins[text], s[last] - begins[text], h[at[new]]


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with its text (null as empty) and two 64-bit hashes of it, which name the text."""
    t = text_of(text)
    return docs.withColumn(text, t).withColumns({"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit("b"), F.col(text))})


def _anchor_rows(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            data = [x.encode("utf-8", "surrogatepass") for x in pdf["text"]]
            h1, h2 = pdf["h1"].to_numpy(), pdf["h2"].to_numpy()
            begin, size = 0, 0
            for i in range(len(data) + 1):
                if i == len(data) or size and size + len(data[i]) > SLICE:
                    if size >= length:
                        t, a, b, h = anchors(data[begin:i], length)
                        if len(t):
                            t = t + begin
                            yield pd.DataFrame({"h1": h1[t], "h2": h2[t], "a": a.astype(np.int32), "b": b.astype(np.int32), "anchor": h.view(np.int64)})
                    begin, size = i, 0
                if i < len(data):
                    size += len(data[i])

    return run


def two_stage(data: bytes, positions: np.ndarray, depth: int = LENGTH) -> list[int]:
    """The given places (ascending) in the order of their suffixes, up to ``depth`` bytes.

    Type B suffixes, smaller than their successors, are sorted directly; each
    type A suffix is put into its first byte's bucket when the scan comes past its
    successor.  The data must end with a byte that is smaller than the one after
    it, so that every run of type A ends.
    """
    x = np.frombuffer(data, np.uint8)
    differ = x[:-1] != x[1:]
    nxt = np.where(differ, np.arange(len(x) - 1), len(x))
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]  # first place from here on where a byte differs from the next
    rising = np.zeros(len(x), bool)
    ok = nxt < len(x) - 1
    rising[:-1][ok] = x[nxt[ok]] < x[nxt[ok] + 1]
    wanted = np.zeros(len(x), bool)
    wanted[positions] = True
    todo = positions[~rising[positions]] + 1  # successors of type A suffixes are needed too
    while len(todo):
        todo = todo[~wanted[todo]]
        wanted[todo] = True
        todo = todo[~rising[todo]] + 1
    every = np.flatnonzero(wanted)
    direct = every[rising[every]].tolist()
    direct.sort(key=lambda i: data[i : i + depth])
    sorted_b: list[list[int]] = [[] for _ in range(256)]
    for i in direct:
        sorted_b[data[i]].append(i)
    induced: list[list[int]] = [[] for _ in range(256)]
    # for each place: the bucket of its predecessor, if that is wanted and of type A
    before = np.full(len(x), -1, np.int16)
    fit = every[(every > 0)]
    fit = fit[wanted[fit - 1] & ~rising[fit - 1]]
    before[fit] = x[fit - 1]
    before = before.tolist()
    order: list[int] = []
    for c in range(256):
        own = induced[c]
        for i in own:  # grows while it is read
            k = before[i]
            if k >= 0:
                induced[k].append(i - 1)
        for i in sorted_b[c]:
            k = before[i]
            if k >= 0:
                induced[k].append(i - 1)
        order += own
        order += sorted_b[c]
    if len(every) == len(positions):
        return order
    asked = np.zeros(len(x), bool)
    asked[positions] = True
    at = np.array(order)
    return at[asked[at]].tolist()


def common_prefixes(data: bytes, order: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Common prefix of each place with the one before it in the order, in whole words of eight bytes, up to ``most``."""
    x = _words8(np.frombuffer(data, np.uint8))
    out = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for k in range(0, most, 8):
        live = live[x[order[live] + k] == x[order[live - 1] + k]]
        if not len(live):
            break
        out[live] += 8
    return out


FOUND = "part int, h1 long, h2 long, lo array<int>, hi array<int>, lo2 array<int>, hi2 array<int>, digests binary, refs binary"
#: (h1, h2, first window) of each text that has the stretch; a stretch is its bytes and its number of windows.
Refs = list[tuple[int, int, int]]
Rows = dict[tuple[bytes, int], Refs]


def _runs(starts: np.ndarray) -> tuple[list[int], list[int]]:
    """Ascending places as ranges, ends included."""
    if not len(starts):
        return [], []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.concatenate([[0], cut + 1])].tolist(), starts[np.concatenate([cut, [len(starts) - 1]])].tolist()


def _sorted_block(rows: Rows, split: bool, parts: int, length: int, shorter: int) -> list[tuple]:
    """Repeated windows of a block of stretches; of a split anchor's block also its distinct windows, by digest."""
    out = []
    stretches = list(rows)
    sizes, count = np.array([len(s) for s, _ in stretches]), np.array([n for _, n in stretches])
    offs = np.cumsum(sizes) - sizes
    data = b"".join(s for s, _ in stretches) + b"\x00\xff" + bytes(length + 16)
    positions = np.repeat(offs - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    order = np.array(two_stage(data, positions, length))
    same = common_prefixes(data, order, length)
    # near a text's end a window may have fewer bytes than ``length``: then it has none of that length
    room = (offs + sizes)[np.searchsorted(offs, order, side="right") - 1] - order
    flags, leaders = [], []
    for size in (length, shorter):
        whole, run = room >= size, np.cumsum(same < size)
        found = np.zeros(len(data), bool)
        found[order[whole & (np.bincount(run[whole], minlength=int(run[-1]) + 1)[run] > 1)]] = True
        flags.append(found)
        if split:
            at = np.flatnonzero(whole)
            leaders.append(order[at[np.unique(run[at], return_index=True)[1]]])
    for (s, n), o in zip(stretches, offs.tolist(), strict=True):
        refs = rows[s, n]
        hits = [np.arange(max(0, min(n, len(s) - size + 1))) if len(refs) > 1 else np.flatnonzero(f[o : o + n]) for f, size in zip(flags, (length, shorter), strict=True)]
        if len(hits[1]):
            (lo, hi), (lo2, hi2) = map(_runs, hits)
            for h1, h2, a in refs:
                out.append((-1, h1, h2, [a + v for v in lo], [a + v for v in hi], [a + v for v in lo2], [a + v for v in hi2], None, None))
    for kind, (size, first) in enumerate(zip((length, shorter), leaders, strict=False)):
        if not len(first):
            continue
        digests = np.frombuffer(b"".join(hashlib.blake2b(data[i : i + size], digest_size=16).digest() for i in first.tolist()), np.uint64).reshape(-1, 2)
        which = np.searchsorted(offs, first, side="right") - 1
        one = np.array([rows[s][0] for s in stretches], np.int64)[which]
        one[:, 2] += first - offs[which]
        part = (digests[:, 0] % np.uint64(parts)).astype(np.int64)
        for p in np.unique(part).tolist():
            k = part == p
            out.append((kind * parts + p, 0, 0, [], [], [], [], digests[k].tobytes(), one[k].tobytes()))
    return out


def _blocks(parts: int, length: int, shorter: int, block: int):
    """Sorts stretches in blocks of whole anchors; an anchor that is split, or doesn't fit, goes in several blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        closed: Rows = {}  # stretches of whole anchors
        open_: Rows = {}  # of the anchor being read
        windows, own, now, split = 0, 0, None, False

        def made(rows: Rows, part_of_split: bool) -> Iterator[pd.DataFrame]:
            found = _sorted_block(rows, part_of_split, parts, length, shorter)
            if found:
                yield pd.DataFrame(found, columns=[c.split()[0] for c in FOUND.split(", ")])

        def close() -> None:
            """The open anchor is whole: sort it with others, unless it is one stretch seen once."""
            nonlocal windows, own, open_
            for s, refs in open_.items():
                if len(open_) > 1 or len(refs) > 1:
                    closed.setdefault(s, []).extend(refs)
                    windows += s[1]
            open_, own = {}, 0

        for pdf in batches:
            columns = (pdf[c].tolist() for c in ("anchor", "deal", "parts", "h1", "h2", "a", "n"))
            for anchor, deal, of, h1, h2, a, n, stretch in zip(*columns, pdf["stretch"], strict=True):
                if (anchor, deal) != now:
                    if split:
                        if open_:
                            yield from made(open_, True)
                        open_, own = {}, 0
                    close()
                    now, split = (anchor, deal), of > 1
                    if windows >= block:
                        yield from made(closed, False)
                        closed, windows = {}, 0
                key = (bytes(stretch), n)
                refs = open_.get(key)
                if refs is None:
                    open_[key] = [(h1, h2, a)]
                    own += n
                else:
                    refs.append((h1, h2, a))
                    own += 8  # a long list of copies ends the block too
                if own >= 2 * block:
                    yield from made(open_, True)
                    open_, own, split = {}, 0, True
        if split:
            if open_:
                yield from made(open_, True)
            open_ = {}
        close()
        if closed:
            yield from made(closed, False)

    return run


def _across(batches: Iterator[pd.DataFrame], parts: int) -> Iterator[pd.DataFrame]:
    """Windows whose digest came from two blocks or more; one part at a time."""
    now, digests, refs = None, [], []

    def done() -> Iterator[pd.DataFrame]:
        d = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
        r = np.frombuffer(b"".join(refs), np.int64).reshape(-1, 3)
        order = np.lexsort((d[:, 1], d[:, 0]))
        d, r = d[order], r[order]
        same = (d[1:] == d[:-1]).all(axis=1)
        hit = np.zeros(len(d), bool)
        hit[1:] |= same
        hit[:-1] |= same
        if hit.any():
            r = r[hit]
            r = r[np.lexsort((r[:, 2], r[:, 1], r[:, 0]))]
            cut = np.flatnonzero((r[1:, :2] != r[:-1, :2]).any(axis=1)) + 1
            ranges = ((int(g[0, 0]), int(g[0, 1]), *_runs(np.unique(g[:, 2]))) for g in np.split(r, cut))
            rows = [(h1, h2, lo, hi, [], []) if now < parts else (h1, h2, [], [], lo, hi) for h1, h2, lo, hi in ranges]
            yield pd.DataFrame(rows, columns=["h1", "h2", "lo", "hi", "lo2", "hi2"])

    for pdf in batches:
        for p, d, r in zip(pdf["part"].tolist(), pdf["digests"], pdf["refs"], strict=True):
            if p != now and digests:
                yield from done()
                digests, refs = [], []
            now = p
            digests.append(bytes(d))
            refs.append(bytes(r))
    if digests:
        yield from done()


RANGES = "h1 long, h2 long, lo array<int>, hi array<int>, lo2 array<int>, hi2 array<int>"


def repeated(texts: DataFrame, windows: int, length: int = LENGTH, shorter: int = SHORTER, block: int = BLOCK) -> DataFrame:
    """Rows (h1, h2, lo, hi, lo2, hi2): ranges of first bytes of windows of ``length`` and of ``shorter`` bytes that occur twice.

    ``texts``: distinct candidates with their ``cells`` (a, b, anchor, parts); ``windows``: how many those have.
    """

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for h1, h2, text, cell in zip(pdf["h1"], pdf["h2"], pdf["text"], pdf["cells"], strict=True):
                data = text.encode("utf-8", "surrogatepass")
                rows += [(c["anchor"], (h1 ^ c["a"] * 0x9E3779B1) % c["parts"], c["parts"], h1, h2, c["a"], c["b"] - c["a"] + 1, data[c["a"] : c["b"] + length]) for c in cell]
            if rows:
                yield pd.DataFrame(rows, columns=["anchor", "deal", "parts", "h1", "h2", "a", "n", "stretch"])

    cut = texts.mapInPandas(stretches, "anchor long, deal int, parts int, h1 long, h2 long, a int, n int, stretch binary")
    parts = max(16, windows // 2_000_000)
    dealt = cut.repartition("anchor", "deal").sortWithinPartitions("anchor", "deal", "h1", "h2", "a")
    found = stored(dealt.mapInPandas(_blocks(parts, length, shorter, block), FOUND), "windows")
    inside = found.where("part < 0").select("h1", "h2", "lo", "hi", "lo2", "hi2")
    across = found.where("part >= 0").select("part", "digests", "refs").repartition("part").sortWithinPartitions("part")
    return inside.unionByName(across.mapInPandas(lambda batches: _across(batches, parts), RANGES))


def removed(text: bytes, lo: list[int], hi: list[int], length: int = LENGTH) -> tuple[int, int, bytes]:
    """(bytes removed, spans, bytes kept) for ranges of first bytes of repeated windows."""
    spans: list[list[int]] = []
    for a, b in sorted(zip(lo, hi, strict=True)):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b + length)
        else:
            spans.append([a, b + length])
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return sum(b - a for a, b in spans), len(spans), b"".join(kept)


def deduplicated(docs: DataFrame, length: int = LENGTH, shorter: int = SHORTER, block: int = BLOCK) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_repeated), one for each row of ``docs``."""
    small_batches(docs.sparkSession)
    named = keyed(docs.select("doc_id", "text"))
    size = F.octet_length("text")
    slim = stored(named.select("doc_id", "h1", "h2", size.cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")), "texts")
    long_enough = named.where(size >= shorter)
    runs = stored(long_enough.select("h1", "h2", "text").mapInPandas(_anchor_rows(shorter), "h1 long, h2 long, a int, b int, anchor long"), "anchors")
    who, some = F.xxhash64("h1", "h2", "a"), block // 4
    again = runs.groupBy("anchor").agg(F.min(who).alias("x"), F.max(who).alias("y"), F.sum(F.col("b") - F.col("a") + 1).alias("windows")).where("x <> y")
    # written first, so that adaptive execution can split the join of an anchor that many runs have
    again = stored(again.select("anchor", F.when(F.col("windows") > block, F.ceil(F.col("windows") / some)).otherwise(1).cast("int").alias("parts")), "repeated-anchors")
    cells = runs.join(again, "anchor")
    of_text = stored(cells.groupBy("h1", "h2").agg(F.collect_set(F.struct("a", "b", "anchor", "parts")).alias("cells")), "cells")
    discard(runs, again)
    # the copies of a text are combined before the shuffle, which the join then needs no more
    once = long_enough.groupBy("h1", "h2").agg(F.first("text").alias("text"))
    texts = stored(once.join(of_text, ["h1", "h2"]), "candidates")
    windows = of_text.select(F.aggregate("cells", F.lit(0).cast("long"), lambda t, c: t + c["b"] - c["a"] + 1).alias("n")).agg(F.sum("n")).first()[0] or 0
    discard(of_text)
    flat = [F.flatten(F.collect_list(c)).alias(c) for c in ("lo", "hi", "lo2", "hi2")]
    hits = repeated(texts, windows, length, shorter, block).groupBy("h1", "h2").agg(*flat)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for h1, h2, text, *ranges in zip(*(pdf[c] for c in ("h1", "h2", "text", "lo", "hi", "lo2", "hi2")), strict=True):
                lo, hi, lo2, hi2 = (x.tolist() for x in ranges)
                data = text.encode("utf-8", "surrogatepass")
                n, spans, kept = removed(data, lo, hi, length)
                rows.append((h1, h2, n, spans, hashlib.sha256(kept).hexdigest(), removed(data, lo2, hi2, shorter)[0]))
            yield pd.DataFrame(rows, columns=["h1", "h2", "removed", "spans", "kept", "repeated"])

    judged = texts.drop("cells").join(hits, ["h1", "h2"]).mapInPandas(cut, "h1 long, h2 long, removed long, spans long, kept string, repeated long")
    copies = slim.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("copies"))
    # written first for the same reason: a text may have very many copies
    verdict = stored(copies.join(judged, ["h1", "h2"], "left").where((F.col("copies") > 1) | F.col("removed").isNotNull()), "verdicts")
    discard(texts)
    twice = F.col("copies") > 1
    pick = lambda all_, some, none, least=length: F.when(twice & (F.col("n_bytes") >= least), all_).otherwise(F.coalesce(some, none))
    return slim.join(verdict, ["h1", "h2"], "left").select(
        "doc_id", "n_bytes",
        pick(F.col("n_bytes"), F.col("removed"), F.lit(0)).cast("long").alias("n_removed"),
        pick(F.lit(1), F.col("spans"), F.lit(0)).cast("long").alias("n_spans"),
        pick(F.lit(hashlib.sha256(b"").hexdigest()), F.col("kept"), F.col("sha")).alias("kept_sha256"),
        pick(F.col("n_bytes"), F.col("repeated"), F.lit(0), shorter).cast("long").alias("n_repeated"),
    )


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, and after them n_repeated: bytes covered by strings of 256 bytes that also start elsewhere."""
    return deduplicated(spark.read.parquet(f"{sf_dir}/documents.parquet"))
