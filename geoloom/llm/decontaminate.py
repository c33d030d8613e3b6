"""Benchmark decontamination (operator 9).

A passage that aligns with a test item by Smith-Waterman over words (match 2,
mismatch and gap -1) is a copy, edited or not, if its score is at least ``least``
of the item's own, or as high as ``long_run`` words in a row.  Seeds find the
passages: pairs of words that stand next to each other or with one word between,
in the item and in the text.  No link is lost by them: two matches of an alignment
with two or more edits between them gain nothing over one, so an alignment of
score s has at least (s - 2) / 2 places of the item where a match and the next one
have at most one edit between them, and each such place is a seed.  Hence all but
that number of an item's places, less ``AGREEING``, may go without a seed: the
commonest go, the rare ones are kept, and a passage needs ``AGREEING`` of them.
So the result is that of aligning every document with every item, and a document's
doesn't depend on the other documents.  What seeds find is set aside without an
alignment where no alignment could reach the score: by the words that text and
item share, then by the places that meet that condition in the passage.

The pass is narrow: the documents aren't shuffled, and a filter needs no join.
Tasks make the index of the items, in blocks of about ``block_chars`` characters,
and write each to the shared folder; the tasks over the documents read them from
there, one at a time, and keep the one that they use.  Beyond one block, texts of
``MANY_CHARS`` characters together meet each block.  So neither the driver nor a
plan holds an item, and a task holds one block, however large the test sets are.

Words are compared in lower case without punctuation.  Defined results: null and
empty texts or items match nothing; an item of up to four words matches where all
of its words stand in a row, and longer ones need the score of four words at least;
ids of items may have any type that can be cast to text and back; repeated rows each count; very long texts
are searched whole; a score of just the limit counts, and of ties in a document
the first passage; extra columns, whatever their names, are ignored or pass
through; empty tables of documents or items give no match; rows of the same
doc_id and item come back once, with the best score.
"""

from __future__ import annotations

import math
import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import remember, shared_dir, slices, small_batches, store_of

#: Items of up to this many words are found whole only; longer ones need the score of as many.
WHOLE = 4
MATCH, MISS, GAP = 2, -1, -1
LEAST, LONG_RUN = 0.4, 40
#: Seeds at different places of an item that a passage must have; more mean more seeds and fewer passages.
AGREEING = 4
#: Places of items that are looked at together.
MANY_PLACES = 1 << 22
BLOCK_CHARS = 8_000_000
#: Characters of documents that meet each block of items together, where there are several.
MANY_CHARS = 1 << 24

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_VALUE = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 21)
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            f = np.full(size, b, np.uint64)
            f[0] = 1
            _powers[k] = np.multiply.accumulate(f)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, and where each text's words begin (one more than texts)."""
    parts = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*parts, b""]) or b"\n", np.uint8)
    inside = _WORD_BYTE[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate([[0], edge])
    begins, ends = edge[::2], edge[1::2]  # the data ends with a line feed
    up, down = _power_table(len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[data] * up[: len(data)], dtype=np.uint64)])
    h = (total[ends] - total[begins]) * down[begins]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    of_text = np.cumsum([0] + [len(p) + 1 for p in parts])
    return h, np.searchsorted(begins, of_text)


def pair_hashes(h: np.ndarray, apart: int) -> np.ndarray:
    """Hash of each word with the one ``apart`` words on (0: of the word alone); across texts too, which the caller leaves out."""
    m = max(len(h) - apart, 0)
    out = h[:m] * np.uint64(0x9FB21C651E98DF25)
    out ^= out >> np.uint64(31)
    if apart:
        out = (out ^ h[apart:]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out


def needed(size: int, least: float = LEAST, long_run: int = LONG_RUN) -> int:
    """Least score of a copy of an item of so many words."""
    if size <= WHOLE:
        return MATCH * size
    return math.ceil(min(max(least * MATCH * size, MATCH * WHOLE), MATCH * long_run) - 1e-9)


@dataclass
class Items:
    """A block of test items with their seeds; places are numbered through all items."""

    ids: list[str]
    words: list[np.ndarray]
    need: np.ndarray
    agreeing: np.ndarray
    #: The item of each place.
    item_of: np.ndarray
    #: Sorted hashes of seeds, and the places of each: from ``begins`` in ``places``.
    seeds: np.ndarray
    begins: np.ndarray
    places: np.ndarray
    singles: bool

    @classmethod
    def of(cls, rows: list[tuple[str, str]], least: float = LEAST, long_run: int = LONG_RUN) -> Items:
        words = [word_hashes([t])[0] for _, t in rows]
        sizes = np.array([len(w) for w in words], np.int64)
        first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        need = np.array([needed(n, least, long_run) for n in sizes.tolist()], np.int64)
        hashes, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for w, f in zip(words, first.tolist(), strict=False):
            for apart in (0,) if len(w) == 1 else (1, 2):
                g = pair_hashes(w, apart)
                hashes.append(g)
                at.append(np.arange(f, f + len(g)))
        flat, at = np.concatenate(hashes), np.concatenate(at)
        _, number, count = np.unique(flat, return_inverse=True, return_counts=True)
        common = np.zeros(first[-1], np.int64)
        np.add.at(common, at, count[number])
        chosen = np.zeros(first[-1], bool)
        agreeing = np.ones(len(rows), np.int64)
        for i, n in enumerate(sizes.tolist()):
            sure = (int(need[i]) - MATCH + 1) // MATCH  # places that any copy has
            if n:
                agreeing[i] = max(1, min(AGREEING, sure))
                spare = max(sure - int(agreeing[i]), 0)
                own = first[i] + np.argsort(common[first[i] : first[i] + max(n - 1, 1)], kind="stable")
                chosen[own[: len(own) - spare]] = True
        use = chosen[at]
        flat, at = flat[use], at[use]
        order = np.lexsort((at, flat))
        seeds, begins = np.unique(flat[order], return_index=True)
        item_of = np.repeat(np.arange(len(rows)), sizes)
        return cls([i for i, _ in rows], words, need, agreeing, item_of, seeds, np.append(begins, len(flat)), at[order], bool((sizes == 1).any()))

    def hits(self, h: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, word place, seed number) of the seeds found inside texts, by text and place."""
        out = []
        if len(self.seeds):
            filled, shift = self._filter()
            for apart in (0, 1, 2) if self.singles else (1, 2):
                g = pair_hashes(h, apart)
                maybe = np.flatnonzero(filled[(g >> shift).astype(np.int64)])
                at = np.minimum(np.searchsorted(self.seeds, g[maybe]), len(self.seeds) - 1)
                sure = self.seeds[at] == g[maybe]
                place, number = maybe[sure], at[sure]
                text = np.searchsorted(begins, place, side="right") - 1
                within = place + apart < begins[text + 1]
                out.append(np.stack([text[within], place[within], number[within]]))
        if not out:
            return (np.zeros(0, np.int64),) * 3
        text, place, number = np.concatenate(out, axis=1)
        order = np.argsort(place, kind="stable")
        return text[order], place[order], number[order]

    def _filter(self) -> tuple[np.ndarray, np.uint64]:
        """Which leading bits any seed has, about one in eight or fewer."""
        if "_made" not in self.__dict__:
            bits = min(max(len(self.seeds).bit_length() + 3, 12), 26)
            shift = np.uint64(64 - bits)
            f = np.zeros(1 << bits, bool)
            f[(self.seeds >> shift).astype(np.int64)] = True
            self.__dict__["_made"] = f, shift
        return self.__dict__["_made"]

    def agreed(self, text: np.ndarray, number: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(text, items) with enough seeds at different places of the item; a step holds the places of some texts, or of one."""
        if not len(text):
            return
        code = np.unique(text * len(self.seeds) + number)
        t, s = code // len(self.seeds), code % len(self.seeds)
        count = self.begins[s + 1] - self.begins[s]
        heads = np.append(np.flatnonzero(np.append(True, t[1:] != t[:-1])), len(t))
        before = np.append(0, np.cumsum(count))
        k = 0
        while k < len(heads) - 1:
            last = max(k + 1, int(np.searchsorted(before[heads], before[heads[k]] + MANY_PLACES, side="right")) - 1)
            a, b = heads[k], heads[last]
            n = count[a:b]
            at = np.repeat(self.begins[s[a:b]] - (before[a:b] - before[a]), n) + np.arange(n.sum())
            both = np.unique(np.repeat(t[a:b], n) * len(self.item_of) + self.places[at])
            pair, seen = np.unique(both // len(self.item_of) * len(self.words) + self.item_of[both % len(self.item_of)], return_counts=True)
            of, item = pair // len(self.words), pair % len(self.words)
            enough = seen >= self.agreeing[item]
            of, item = of[enough], item[enough]
            cuts = np.flatnonzero(of[1:] != of[:-1]) + 1
            for x, y in zip(np.split(of, cuts), np.split(item, cuts), strict=True):
                if len(x):
                    yield int(x[0]), y
            k = last

    def own(self, i: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Seed numbers of an item, how many of its pairs each may be, and all of its pairs by distance."""
        made = self.__dict__.setdefault("_own", {})
        if i not in made:
            w = self.words[i]
            pairs = [pair_hashes(w, apart) for apart in ((0,) if len(w) == 1 else (1, 2))]
            g = np.concatenate(pairs)
            at = np.minimum(np.searchsorted(self.seeds, g), len(self.seeds) - 1)
            made[i] = (*np.unique(at[self.seeds[at] == g], return_counts=True), pairs)
        return made[i]

    def reachable(self, own: list[int], words: np.ndarray) -> np.ndarray:
        """Bound on the score of each of these items in a text with these words: all of its words that the text has, matched."""
        known = np.unique(words)
        sizes = np.array([len(self.words[i]) for i in own])
        flat = np.concatenate([self.words[i] for i in own])
        found = known[np.minimum(np.searchsorted(known, flat), len(known) - 1)] == flat
        return MATCH * np.add.reduceat(found.astype(np.int64), np.cumsum(sizes) - sizes)


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys a sorted array has."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def highest(passage: np.ndarray, pairs: list[np.ndarray]) -> int:
    """Bound on the score of an item with these pairs: two points, two for each place where a pair of the passage follows at once, one where with an edit between."""
    if len(pairs) == 1:
        return MATCH
    near, far = (np.sort(pair_hashes(passage, apart)) for apart in (1, 2))
    at_once, edited = _among(pairs[0], near), _among(pairs[0], far)
    edited[: len(pairs[1])] |= _among(pairs[1], near) | _among(pairs[1], far)
    return MATCH + 2 * int(at_once.sum()) + int((edited & ~at_once).sum())


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Best Smith-Waterman score of words a against words b, and the place in a where it ends."""
    n = len(a)
    row = np.zeros(n + 1, np.int32)
    gaps = np.arange(n + 1, dtype=np.int32) * -GAP
    best, end = 0, 0
    for w in b:
        new = np.zeros(n + 1, np.int32)
        new[1:] = np.maximum(row[:-1] + np.where(a == w, MATCH, MISS), row[1:] + GAP)
        np.maximum(new, 0, out=new)
        new = np.maximum.accumulate(new + gaps) - gaps  # gaps along a
        k = int(new.argmax())
        if new[k] > best:
            best, end = int(new[k]), k
        row = new
    return best, end


def copies(h: np.ndarray, begins: np.ndarray, items: Items) -> list[tuple[int, int, int]]:
    """(text, item, score) of the texts that hold copies, with the best score of each."""
    text, place, number = items.hits(h, begins)
    out = []
    for t, own in items.agreed(text, number):
        lo, hi = int(begins[t]), int(begins[t + 1])
        own = own[items.reachable(own.tolist(), h[lo:hi]) >= items.need[own]]
        a, b = np.searchsorted(text, [t, t + 1])
        for i in own.tolist():
            word, need, top = items.words[i], int(items.need[i]), 0
            full = MATCH * len(word)
            # no copy is longer: each word of the item matched, and a point lost for each word between
            reach = 3 * len(word) - need + 2
            seeds, times, pairs = items.own(i)
            at = np.minimum(np.searchsorted(seeds, number[a:b]), len(seeds) - 1)
            met = seeds[at] == number[a:b]
            found = place[a:b][met]
            heads = np.append(0, np.flatnonzero(np.diff(found) > reach) + 1)
            lasts = np.append(heads[1:], len(found)) - 1
            enough = np.add.reduceat(times[at[met]], heads) >= items.agreeing[i]
            for x, y in zip(found[heads[enough]].tolist(), found[lasts[enough]].tolist(), strict=True):
                passage = h[max(lo, x - reach) : min(hi, y + reach)]
                if highest(passage, pairs) >= max(need, top + 1):
                    top = max(top, align(passage, word)[0])
                    if top == full:
                        break
            if top >= need:
                out.append((t, i, top))
    return out


def _indexer(uri: str, least: float):
    """Writes the index of each block of items; a second attempt writes the same again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = store_of(uri)
        now, rows = None, []

        def done() -> pd.DataFrame:
            temp = f"{path}/_{now}-{uuid.uuid4().hex}"
            with store.open_output_stream(temp) as f:
                f.write(pickle.dumps(Items.of(rows, least)))
            store.move(temp, f"{path}/{now}")
            return pd.DataFrame({"block": [now]})

        for pdf in batches:
            for part, item, text in zip(pdf["part"].tolist(), pdf["item_id"].tolist(), pdf["text"], strict=True):
                if part != now and rows:
                    yield done()
                    rows = []
                now = part
                rows.append((item, text))
        if rows:
            yield done()

    return run


@dataclass(frozen=True)
class Index:
    """Blocks of items in a folder that all executors reach."""

    uri: str
    blocks: tuple[int, ...]

    def each(self) -> Iterator[Items]:
        for k in self.blocks:
            yield _block(self.uri, k)


@lru_cache(maxsize=1)
def _block(uri: str, k: int) -> Items:
    store, path = store_of(uri)
    with store.open_input_stream(f"{path}/{k}") as f:
        return pickle.loads(f.read())


def indexed(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, block_chars: int = BLOCK_CHARS) -> Index:
    """The index of the items, made by tasks; what reaches the driver is the number of characters and the names of the blocks."""
    spark = docs.sparkSession
    small_batches(spark)
    uri = f"{shared_dir(spark)}/geoloom-items-{uuid.uuid4().hex}"
    store, path = store_of(uri)
    store.create_dir(path, recursive=True)
    remember(spark, uri)
    rows = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(-(-size // block_chars) or 1))
    dealt = rows.withColumn("part", part).repartition("part").sortWithinPartitions("part", "item_id", "text")
    made = dealt.select("part", F.col("item_id").cast("string"), "text").mapInPandas(_indexer(uri, least), "block long").collect()
    return Index(uri, tuple(sorted(r["block"] for r in made)))


def _gathered(batches: Iterator[pd.DataFrame], text: str, most: int) -> Iterator[pd.DataFrame]:
    """Batches of about ``most`` characters or more."""
    held, size = [], 0
    for pdf in batches:
        held.append(pdf)
        size += sum(len(x or "") for x in pdf[text]) if most else 0
        if size >= most:
            yield pd.concat(held, ignore_index=True) if len(held) > 1 else pdf
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _matches(index: Index, text: str):
    """(batch, [(place of the text, Items, item, score)]) for batches of documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list]]:
        for pdf in _gathered(batches, text, MANY_CHARS if len(index.blocks) > 1 else 0):
            texts, found = [x or "" for x in pdf[text]], []
            hashed = [(a, *word_hashes(texts[a:b])) for a, b in slices(texts)] if index.blocks else []
            for items in index.each():
                found += [(a + t, items, i, s) for a, h, begins in hashed for t, i, s in copies(h, begins, items)]
            yield pdf, found

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows (key, item_id, score, share): documents with copies of items; share is the score over the item's own."""
    schema = f"`{key}` {dict(docs.dtypes)[key]}, item_id string, score long, share double"
    matches = _matches(indexed(docs, benchmark, least, block_chars), text)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, found in matches(batches):
            if found:
                keys = pdf[key].tolist()
                frame = pd.DataFrame([(keys[t], items.ids[i], s, s / (MATCH * len(items.words[i]))) for t, items, i, s in found], columns=[key, "item_id", "score", "share"])
                yield frame.astype({key: "Int64"}) if pd.api.types.is_numeric_dtype(frame[key]) else frame

    out = docs.select(key, text).mapInPandas(run, schema)
    out = out.withColumn("item_id", F.col("item_id").cast(benchmark.schema["item_id"].dataType))
    return out.groupBy(key, "item_id").agg(F.max("score").alias("score"), F.max("share").alias("share"))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", least: float = LEAST, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows that hold a copy of an item; rows stay where they are."""
    matches = _matches(indexed(docs, benchmark, least, block_chars), text)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, found in matches(batches):
            good = np.ones(len(pdf), bool)
            good[[t for t, *_ in found]] = False
            yield pdf[good]

    return docs.mapInPandas(run, docs.schema)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with a copy of a test item go."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
