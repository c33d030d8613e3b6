"""Language identification with hyperdimensional profiles (operator 6).

Every letter has a random vector of +1 and -1, drawn from its code point and a
seed.  A letter trigram is bound as the product of its letters' vectors, each
shifted by its place in the trigram; a text is bundled as the sum of its
trigrams' vectors, a language as the sum over all its training texts.  A text
gets the language whose prototype has the largest cosine with its bundle.

Runs of other characters count as one word border, which is a letter of its
own inside trigrams.  Trigrams are counted first, so that a vector is made once
for each trigram of a batch; prototypes are sums of whole numbers, the same for
any order of the rows.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
a null id is held out like the text '' (it isn't); without a training row every
text is ``und``; repeated rows and very long texts count in full; extra columns
pass through, but for those with the names of results, which are replaced; ties
go to the language first in order; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, slices, small_batches, stored

DIM, SEED = 1024, 7
SLICE = 1 << 18  # characters looked at together
UNKNOWN = "und"
_BITS = 21  # a code point


@cache
def _letters() -> np.ndarray:
    """Lower-case code point of each letter, 0 for every other character."""
    out = np.zeros(0x110000, dtype=np.int32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes of all texts one after the other, and where each text's codes begin (one more than texts)."""
    joined = "\n" + "\n".join(texts) + "\n"
    x = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    ends = np.cumsum([len(t) + 1 for t in texts])  # place of the border after each text
    keep = np.ones(len(x), dtype=bool)
    keep[1:] = (x[1:] != 0) | (x[:-1] != 0)
    keep[ends] = True
    kept = np.cumsum(keep)
    x = x[keep].astype(np.int64)
    code = (x[:-2] << (2 * _BITS)) | (x[1:-1] << _BITS) | x[2:]
    good = x[1:-1] != 0
    begins = np.concatenate([[0], kept[ends] - 1])  # border before each text, among those kept
    before = np.concatenate([[0], np.cumsum(good)])
    return code[good], before[np.minimum(begins, len(good))]


class Vectors:
    """Trigram vectors, made when first asked for; forgets them beyond ``most``."""

    def __init__(self, dim: int = DIM, seed: int = SEED, most: int = 20_000) -> None:
        self.dim, self.seed, self.most = dim, seed, most
        self.letter: dict[int, np.ndarray] = {}
        self.codes, self.rows = np.empty(0, np.int64), np.empty((0, dim), np.int8)

    def of_letter(self, c: int) -> np.ndarray:
        if c not in self.letter:
            if len(self.letter) > self.most:
                self.letter.clear()
            bits = np.random.Generator(np.random.PCG64([self.seed, c])).integers(0, 2, self.dim, dtype=np.int8)
            self.letter[c] = bits * np.int8(2) - np.int8(1)
        return self.letter[c]

    def make(self, codes: np.ndarray) -> np.ndarray:
        mask, out = (1 << _BITS) - 1, np.ones((len(codes), self.dim), np.int8)
        for place in range(3):
            of, back = np.unique((codes >> (_BITS * (2 - place))) & mask, return_inverse=True)
            table = np.stack([np.roll(self.of_letter(int(c)), 2 - place) for c in of]) if len(of) else np.empty((0, self.dim), np.int8)
            out *= table[back]
        return out

    def of(self, codes: np.ndarray) -> np.ndarray:
        """Row numbers in ``rows`` of sorted distinct codes."""
        at = np.searchsorted(self.codes, codes)
        new = codes[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != codes)] if len(self.codes) else codes
        if len(new):
            if len(self.codes) + len(new) > self.most:
                self.codes, self.rows, new = np.empty(0, np.int64), np.empty((0, self.dim), np.int8), codes
            both = np.concatenate([self.codes, new])
            order = np.argsort(both, kind="stable")
            n, rows = len(self.codes), np.empty((len(both), self.dim), np.int8)
            back = np.argsort(order, kind="stable")  # where each goes; the new ones are made a few at a time
            rows[back[:n]] = self.rows
            for i in range(0, len(new), 1024):
                rows[back[n + i : n + i + 1024]] = self.make(new[i : i + 1024])
            self.codes, self.rows = both[order], rows
        return np.searchsorted(self.codes, codes)


def _train(dim: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors, sums, counts = Vectors(dim, seed), {}, {}

        def flush() -> None:
            for lang, c in counts.items():
                codes, n = np.fromiter(c, np.int64, len(c)), np.fromiter(c.values(), np.int64, len(c))
                for i in range(0, len(codes), 1024):
                    sums[lang] = sums.get(lang, 0) + n[i : i + 1024] @ vectors.make(codes[i : i + 1024]).astype(np.int64)
            counts.clear()

        for pdf in batches:
            for lang, texts in pdf.groupby("lang")["text"]:
                texts, into = texts.tolist(), counts.setdefault(lang, {})
                for a, b in slices(texts, SLICE):
                    codes, n = np.unique(trigrams(texts[a:b])[0], return_counts=True)
                    for c, k in zip(codes.tolist(), n.tolist(), strict=True):
                        into[c] = into.get(c, 0) + k
            if sum(map(len, counts.values())) > 200_000:
                flush()
        flush()
        if sums:
            yield pd.DataFrame({"lang": list(sums), "v": [v.tolist() for v in sums.values()]})

    return run


def fit(training: DataFrame, dim: int = DIM, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototypes of length 1, from rows (text, lang), all of them.

    What reaches the driver is one number for each language and dimension.
    """
    small_batches(training.sparkSession)
    rows = training.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    part = rows.mapInPandas(_train(dim, seed), "lang string, v array<bigint>")
    sums = part.select("lang", F.posexplode("v").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x")).collect()
    langs = sorted({r["lang"] for r in sums})
    out = np.zeros((len(langs), dim))
    for r in sums:
        out[langs.index(r["lang"]), r["k"]] = r["x"]
    return langs, out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def predict(texts: list[str], langs: list[str], prototypes: np.ndarray, vectors: Vectors) -> tuple[list[str], list[float]]:
    names, scores = [], []
    flat = prototypes.T.astype(np.float32)
    for a, b in slices(texts, SLICE):
        codes, begins = trigrams(texts[a:b])
        used, back = np.unique(codes, return_inverse=True)
        rows = vectors.of(used)
        near = np.concatenate([np.zeros((0, len(langs)), np.float32), *[vectors.rows[rows[i : i + 2048]].astype(np.float32) @ flat for i in range(0, len(rows), 2048)]])
        for i in range(b - a):
            own = back[begins[i] : begins[i + 1]]
            if not len(own) or not langs:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            n = np.bincount(own)
            of = np.flatnonzero(n)
            w = n[of].astype(np.float32)
            size = float(np.linalg.norm(w @ vectors.rows[rows[of]].astype(np.float32)))
            cos = (w @ near[of]) / max(size, 1e-9)
            k = int(np.argmax(cos))
            names.append(langs[k])
            scores.append(min(1.0, max(0.0, float(cos[k]))))
    return names, scores


def identified(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", dim: int = DIM, seed: int = SEED, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, or columns of other names; other columns pass through."""
    small_batches(docs.sparkSession)
    langs, prototypes = model

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors = Vectors(dim, seed)
        for pdf in batches:
            found = predict(["" if x is None else x for x in pdf[text]], langs, prototypes, vectors)
            yield pdf.assign(**dict(zip(names, found, strict=True)))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name not in names)
    return docs.drop(*names).mapInPandas(run, f"{schema}, `{names[0]}` string, `{names[1]}` double")


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, by the CRC-32 of the id as text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    out = identified(docs.select("doc_id", "text"), model, dim=DIM)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


#: Of the stage: more dimensions than operator 6, so that the cosine of a random direction (1 over the root of the dimension) is small.
STAGE_DIM = 4096
#: A text is too far from all languages below this share of the score that all but ``FEW`` of the labelled texts of about its length have, and always below ``NOISE`` random cosines.
SLACK, FEW, NOISE = 0.75, 0.001, 4.0


def size_class(text: Column) -> Column:
    """About the binary logarithm of a text's length, by its characters."""
    return F.floor(F.log2(F.greatest(F.length(F.coalesce(text, F.lit(""))), F.lit(1)))).cast("int")


def limits(labelled: DataFrame, dim: int = DIM) -> dict[int, float]:
    """Least score by size class, from all rows (size, score) of labelled texts; what reaches the driver is a row for each class."""
    rows = labelled.groupBy("size").agg(F.percentile_approx("score", FEW, 100_000).alias("q")).collect()
    low = {r["size"]: r["q"] for r in rows}
    # a class borrows from its neighbours, as it may have few texts
    return {c: max(NOISE / dim**0.5, SLACK * min(low[k] for k in (c - 1, c, c + 1) if k in low)) for c in low}


def of_a_language(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", training: Column | None = None, dim: int = DIM, seed: int = SEED) -> DataFrame:
    """``docs`` without the rows of no language, or far from all.

    ``training``: which rows set the limits; without them, or for a length that
    none of them has nearby, only the limit of noise holds.
    """
    pred, score, size = fresh(docs, "_pred", "_score", "_size")
    scored = stored(identified(docs, model, text, dim, seed, (pred, score)).withColumn(size, size_class(F.col(text))), "scored")
    least = limits(scored.where(training).where(F.col(pred) != UNKNOWN).select(F.col(size).alias("size"), F.col(score).alias("score")), dim) if training is not None else {}
    floor = F.lit(NOISE / dim**0.5)
    limit = F.coalesce(F.create_map(*[F.lit(x) for c in least.items() for x in c])[F.col(size)], floor) if least else floor
    return scored.where((F.col(pred) != UNKNOWN) & (F.col(score) >= limit)).select(*[F.col(f"`{c}`") for c in docs.columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents of no language go, by limits from the scores of all labelled documents."""
    training = ~held_out(F.col("doc_id")) & F.col("lang").isNotNull()
    model = fit(docs.where(training).select("text", "lang"), STAGE_DIM)
    return of_a_language(docs, model, training=training, dim=STAGE_DIM)
