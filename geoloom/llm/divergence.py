"""Source divergence audit (operator 13): sketch-prefiltered counting, then sparse pair joins.

Which sources of a language use which terms otherwise than the language does, and
how far two sources are apart.  Four steps:

1. Each task counts in how many of its documents a term of a language occurs and
   adds the counts to the cells of a count-min sketch of two rows; the tasks'
   cells are dealt by slice and added up.  A cell holds at least the documents of
   each of its terms, so a term with a cell below ``least`` can't be kept.
2. One bit a cell (reached ``least`` or not) goes to all tasks: two bits for a
   cell of each row, at most ``2 * MOST_CELLS / 8`` bytes (32 MiB) for any corpus.
   The number of cells follows the number of documents up to that bound; a
   narrower sketch lets more terms through and changes no result.  Tasks count
   again, drop terms that a bit rules out, and shuffle only the rest.
3. Survivors are counted exactly by (lang, term, source) and kept by their exact
   document frequency.  One shuffle by (lang, term) serves both.
4. Pairs of sources are joined only over terms that both have.  A term that one
   source lacks adds a value that depends on the other source's count alone, so
   these are summed from histograms of counts, and terms that both lack are a
   multiple of one value; nothing is approximated.

A term is a run of letters A-Z, a-z and characters beyond ASCII, only A-Z
lower-cased.  Definitions of p, f, parts and ranks are those of ``audit``.

Defined results: null text, lang and source are empty strings, and an empty text
has no term, while its (lang, source) is still a group; very long texts are
counted whole; repeated rows count each; ties in a rank go by the item's UTF-8
bytes; a language without kept terms (V = 0) has value 0 in all pairs and no term
rows; a language with one source has no pair rows; extra columns are ignored,
whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small_batches, stored

#: A term keeps from this many documents of its language; smoothing, scale, and ranks of the part ``term``.
LEAST, SCALE, TOP = 10, 1_000_000_000, 10
#: Cells of a row of the sketch, a power of two: so many for each document, between these bounds.
CELLS_A_DOCUMENT, FEWEST_CELLS, MOST_CELLS = 64, 1 << 20, 1 << 27
#: Cells of a slice, the unit in which sketches are merged; bytes hashed at a time; entries after which a task hands over what it counted.
SLICE, CHUNK, MOST_HELD = 1 << 16, 1 << 20, 600_000
_term = re.compile(rb"[a-z\x80-\xff]+")


def _terms(value: pa.Scalar) -> list[bytes]:
    """Terms in UTF-8; ``lower`` of bytes changes A-Z alone."""
    b = value.as_py()
    return _term.findall(b.lower()) if b else []


#: Each byte of a term, A-Z lower-cased; 0 for all others.
_CODES = np.array([b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)
#: An odd base of the terms' hash and its inverse modulo 2 ** 64; both are free choices.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """64-bit hashes of the terms of a buffer, without a Python object for each: differences of prefix sums."""

    def __init__(self) -> None:
        self.up, self.down = _powers(_BASE, CHUNK), _powers(_INVERSE, CHUNK)

    def _grown(self, n: int) -> None:
        if n > len(self.up):  # a term that is longer than a chunk
            self.up, self.down = _powers(_BASE, n), _powers(_INVERSE, n)

    def __call__(self, data: np.ndarray, breaks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(begin of each term, hash) for runs of terms; no term crosses one of the ``breaks``."""
        begin = 0
        while begin < len(data):
            end = min(len(data), begin + CHUNK)
            while end < len(data) and _CODES[data[end]] and _CODES[data[end - 1]]:  # not within a term
                tail = _CODES[data[end : end + CHUNK]] == 0
                end += int(tail.argmax()) if tail.any() else len(tail)
            code = _CODES[data[begin:end]]
            self._grown(len(code))
            word = np.concatenate([[False], code != 0, [False]])
            cut = np.zeros(len(code) + 1, bool)
            cut[breaks[np.searchsorted(breaks, begin) : np.searchsorted(breaks, end, "right")] - begin] = True
            first = np.flatnonzero(word[1:-1] & (~word[:-2] | cut[:-1]))
            last = np.flatnonzero(word[1:-1] & (~word[2:] | cut[1:]))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * self.up[: len(code)], dtype=np.uint64)])
            yield first + begin, (sums[last + 1] - sums[first]) * self.down[first]
            begin = end


def _mixed(h: np.ndarray, seed: np.ndarray | np.uint64) -> np.ndarray:
    """Hashes of terms of languages, every bit of which depends on all."""
    h = (h ^ seed) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _seed(lang: bytes) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang))


def _cells(h: np.ndarray, cells: int) -> np.ndarray:
    """Places in the two rows of the sketch, as an array of shape (2, terms)."""
    mask = np.uint64(cells - 1)
    return np.stack([h & mask, (h >> np.uint64(32) & mask) + np.uint64(cells)]).astype(np.int64)


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, and where each begins (and the last ends)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8, offsets[-1] - offsets[0], offsets[0]) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _added(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h, kind="stable")
    h, n = h[order], n[order]
    at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])[: len(h)])
    return h[at], np.add.reduceat(n, at) if len(at) else n


def _sketching(cells: int):
    """Cells that a task's documents touch, as slices: places in the slice and counts up to 255."""

    def emit(h: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        place, count = _added(_cells(h, cells).ravel(), np.tile(n, 2))
        count = np.minimum(count, 255).astype(np.uint8)
        slices, begin = np.unique(place // SLICE, return_index=True)
        end = [*begin[1:], len(place)]
        low = (place % SLICE).astype(np.uint16)
        rows = [low[a:b].tobytes() + count[a:b].tobytes() for a, b in zip(begin, end, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(slices, pa.int32()), pa.array(rows, pa.binary())], ["slice", "cells"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, size = Hasher(), [], 0
        for batch in batches:
            langs, texts = batch.column(0).cast(pa.large_binary()).to_pylist(), batch.column(2).cast(pa.large_binary())
            seeds = {x: _seed(x) for x in set(langs)}
            of_doc = np.array([seeds[x] for x in langs], np.uint64)
            data, offsets = _buffer(texts)
            for first, h in hasher(data, offsets[1:-1]):
                doc = np.searchsorted(offsets, first, "right") - 1
                h = _mixed(h, of_doc[doc])
                order = np.argsort(h, kind="stable")  # keeps the order of documents
                h, doc = h[order], doc[order]
                new = np.concatenate([[True], h[1:] != h[:-1]])[: len(h)]
                other = new | np.concatenate([[True], doc[1:] != doc[:-1]])[: len(h)]
                at = np.flatnonzero(new)
                if len(at):
                    held.append((h[at], np.add.reduceat(other.astype(np.int64), at)))
                    size += len(at)
            if size >= 4 * MOST_HELD:
                held = [_added(*map(np.concatenate, zip(*held, strict=True)))]
                size = len(held[0][0])
                if size >= 2 * MOST_HELD:
                    yield from emit(*held[0])
                    held, size = [], 0
        if held:
            yield from emit(*_added(*map(np.concatenate, zip(*held, strict=True))))

    return run


def _merging(least: int):
    """Sums of the cells of each slice, of rows that come sorted by slice; one bit a cell leaves."""

    def row(k: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.packbits(total >= least).tobytes()], pa.binary())], ["slice", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(SLICE, np.int64)
        for batch in batches:
            for k, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != now:
                    if now is not None:
                        yield row(now, total)
                    now, total = k, np.zeros(SLICE, np.int64)
                n = len(cells) // 3
                total[np.frombuffer(cells, np.uint16, n)] += np.frombuffer(cells, np.uint8, n, 2 * n)
        if now is not None:
            yield row(now, total)

    return run


def cells_for(documents: int) -> int:
    """Cells of a row of the sketch for so many documents."""
    return min(MOST_CELLS, max(FEWEST_CELLS, 1 << max(0, CELLS_A_DOCUMENT * documents - 1).bit_length()))


def possible(docs: DataFrame, cells: int, least: int = LEAST) -> bytes:
    """One bit for each cell of both rows: whether it reached ``least``.  At most ``MOST_CELLS / 4`` bytes come to the driver."""
    parts = docs.mapInArrow(_sketching(cells), "slice int, cells binary")
    merged = parts.repartition("slice").sortWithinPartitions("slice").mapInArrow(_merging(least), "slice int, bits binary")
    bits = bytearray(2 * cells // 8)
    for r in merged.collect():
        at = r["slice"] * SLICE // 8
        bits[at : at + SLICE // 8] = r["bits"]
    return bytes(bits)


_COUNTED = "lang string, term string, df long, uses array<struct<source: string, n: long>>"


def _counting(shared, cells: int):
    """(lang, term, df, uses by source) of a task's documents, without terms that the sketch rules out."""

    def emit(bits: np.ndarray, hasher: Hasher, held: dict[bytes, tuple[Counter, dict[bytes, Counter]]]) -> Iterator[pa.RecordBatch]:
        for lang, (df, by_source) in held.items():
            terms = list(df)
            joined = np.frombuffer(b" ".join(terms), np.uint8)
            at = _cells(_mixed(np.concatenate([h for _, h in hasher(joined, np.zeros(0, np.int64))]), _seed(lang)), cells)
            good = ((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)
            left = [t for t, g in zip(terms, good, strict=True) if g]
            place = {t: k for k, t in enumerate(left)}
            which, uses, names = [], [], []
            for k, (source, n) in enumerate(by_source.items()):
                row = np.fromiter((place.get(t, -1) for t in n), np.int64, len(n))
                which.append(row[row >= 0])
                uses.append(np.fromiter(n.values(), np.int64, len(n))[row >= 0])
                names.append(np.full(len(which[-1]), k, np.int32))
            if not left:
                continue
            which, uses, names = map(np.concatenate, (which, uses, names))
            order = np.argsort(which, kind="stable")
            offsets = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(left)))]).astype(np.int32)
            sources = pa.DictionaryArray.from_arrays(pa.array(names[order]), pa.array(list(by_source), pa.binary()).cast(pa.string())).cast(pa.string())
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([sources, pa.array(uses[order])], ["source", "n"]))
            lang_column = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(left), np.int32)), pa.array([lang], pa.binary()).cast(pa.string())).cast(pa.string())
            whole = pa.RecordBatch.from_arrays([lang_column, pa.array(left, pa.binary()).cast(pa.string()), pa.array([df[t] for t in left], pa.int64()), lists], ["lang", "term", "df", "uses"])
            for k in range(0, len(left), 50_000):
                yield whole.slice(k, 50_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hasher = np.frombuffer(shared.value, np.uint8), Hasher()
        held: dict[bytes, tuple[Counter, dict[bytes, Counter]]] = {}
        for batch in batches:
            langs, sources, texts = (batch.column(k).cast(pa.large_binary()) for k in range(3))
            for lang, source, text in zip(langs.to_pylist(), sources.to_pylist(), texts, strict=True):
                if terms := _terms(text):
                    df, by_source = held.setdefault(lang, (Counter(), {}))
                    by_source.setdefault(source, Counter()).update(terms)
                    df.update(set(terms))
            if sum(len(n) for _, by_source in held.values() for n in by_source.values()) >= MOST_HELD:
                yield from emit(bits, hasher, held)
                held = {}
        yield from emit(bits, hasher, held)

    return run


def counted(docs: DataFrame, least: int = LEAST, cells: int | None = None) -> DataFrame:
    """(lang, term, source, n, lang_n, head): exact counts of the kept terms; head marks one row of each (lang, term)."""
    spark = docs.sparkSession
    cells = cells or cells_for(docs.count())
    shared = spark.sparkContext.broadcast(possible(docs, cells, least))
    rows = docs.mapInArrow(_counting(shared, cells), _COUNTED).repartition("lang", "term")
    # the documents of a row count once, with the first of its sources
    uses = rows.select("lang", "term", "df", F.posexplode("uses").alias("at", "use"))
    uses = uses.select("lang", "term", "use.source", "use.n", F.when(F.col("at") == 0, F.col("df")).otherwise(0).alias("df"))
    each = uses.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    own = Window.partitionBy("lang", "term")
    each = each.withColumns({"lang_df": F.sum("df").over(own), "lang_n": F.sum("n").over(own), "head": (F.row_number().over(own.orderBy("source")) == 1).cast("int")})
    return each.where(F.col("lang_df") >= least).select("lang", "term", "source", "n", "lang_n", "head")


def _p(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)), in whole numbers of up to 38 digits."""
    whole = "decimal(38,0)"
    return F.lit(1) + F.call_function("div", (F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")).cast(whole), F.greatest(F.lit(1).cast(whole), total.cast(whole) + 2 * kept.cast("decimal(20,0)")))


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST, top: int = TOP, cells: int | None = None) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group (lang, source).

    V: terms in at least ``least`` documents of the language.  For a group and for
    a language, p = 1 + floor(10**9 * (count + 2) / (N + 2 * V)), where N sums
    the counts of the kept terms; f = floor((p - q)**2 / (p + q)).  Part ``pair``: f
    summed over all kept terms against each other source of the language; part
    ``term``: f of the terms that the group uses more than its language, up to
    ``top`` ranks.
    """
    small_batches(docs.sparkSession)
    slim = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    kept = stored(counted(slim, least, cells), "terms")
    of_lang = kept.groupBy("lang").agg(F.sum("head").alias("v"), F.sum("n").alias("total"))
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"), F.count(F.lit(1)).alias("distinct"))
    groups = slim.select("lang", "source").distinct().join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = stored(groups.select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("own", "distinct", "v", "total")]), "groups")
    groups = groups.withColumn("none", _p(F.lit(0).cast("long"), F.col("own"), F.col("v")))
    used = kept.join(groups, ["lang", "source"]).withColumn("p", _p(F.col("n"), F.col("own"), F.col("v")))

    q = _p(F.col("lang_n"), F.col("total"), F.col("v"))
    more = used.withColumn("q", q).where(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _f(F.col("p"), F.col("q")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = more.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)

    # terms of one source alone, by how many of its terms have the same p
    bars = used.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("none").alias("item_none"))
    alone = bars.join(other, "lang").where(F.col("source") != F.col("item")).groupBy("lang", "source", "item").agg(F.sum(F.col("m") * _f(F.col("p"), F.col("item_none"))).alias("value"))
    # terms of both: what they add in place of the two terms above
    a = used.select("lang", "term", "source", "p", "none")
    b = used.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("item_p"), F.col("none").alias("item_none"))
    change = _f(F.col("p"), F.col("item_p")) - _f(F.col("p"), F.col("item_none")) - _f(F.col("none"), F.col("item_p")) + _f(F.col("none"), F.col("item_none"))
    both = a.join(b, ["lang", "term"]).where(F.col("source") < F.col("item")).groupBy("lang", "source", "item").agg(F.sum(change).alias("value"))
    # terms of neither
    sides = groups.select("lang", "source", "none", "distinct", "v").join(groups.select("lang", F.col("source").alias("item"), F.col("none").alias("item_none"), F.col("distinct").alias("item_distinct")), "lang")
    rest = sides.where(F.col("source") < F.col("item")).select("lang", "source", "item", F.when(F.col("v") == 0, F.lit(0).cast("long")).otherwise((F.col("v") - F.col("distinct") - F.col("item_distinct")) * _f(F.col("none"), F.col("item_none"))).alias("value"))
    ordered = alone.select("lang", F.least("source", "item").alias("source"), F.greatest("source", "item").alias("item"), "value")
    half = stored(ordered.unionByName(both).unionByName(rest).groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "pairs")
    whole = half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    pairs = whole.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(by_value))
    return pairs.unionByName(terms)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS u FROM documents),
t AS (SELECT k, lang, source, unnest(u) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT k) >= {LEAST}),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT x.lang, x.source, coalesce(l.v, 0) AS v, coalesce(sum(c.n), 0) AS own FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN l USING (lang) LEFT JOIN c ON c.lang = x.lang AND c.source = x.source GROUP BY ALL),
gp AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + CAST({SCALE} * CAST(coalesce(c.n, 0) + 2 AS HUGEINT) // (g.own + 2 * g.v) AS BIGINT) AS p FROM g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
lp AS (SELECT k.lang, k.term, 1 + CAST({SCALE} * CAST(k.n + 2 AS HUGEINT) // (l.total + 2 * l.v) AS BIGINT) AS q FROM kept k JOIN l USING (lang)),
pair AS (SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(p.value, 0) AS value FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN pair p ON p.lang = x.lang AND p.source = x.source AND p.item = y.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM gp JOIN lp USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM r WHERE part = 'pair' OR rank <= {TOP}
"""
