"""Fill-in-middle transformation (operator 12): constant-memory two-pass streaming matcher.

A text is cut into units, each a word with the white space before it, or white
space at the end.  Two ranks drawn from a hash of the row's key cut the units
into prefix, middle and suffix.  The first pass over the matches counts the units;
the second takes matches from a lazy iterator up to the smaller and then the
larger rank.  No list of units exists at any time: beside the text itself, a task
holds one match.  Python returns three numbers a row; hashes, forms, outputs and
their inversion are column expressions.

Defined results: a null text is an empty text and is plain; a null key is hashed
as an empty string; texts that hold one of the marks are plain, so that outputs
can always be undone; very long texts are cut whole; repeated rows, and different
rows of the same key and text, get the same output; both ranks may be equal (the
middle is empty) or 0 or n; keys of any type are hashed as text; extra columns
pass through, but those with the names of results are replaced; an empty table
gives an empty table.
"""

from __future__ import annotations

import re
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, small_batches, text_of

#: The marks, and the units of a text.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
#: Seed, and the percentages of rows that are transformed and, of those, that take the suffix first.
SEED, RATE, SUFFIX_FIRST = 42, 50, 80
_OUT = ("n", "form", "prefix_chars", "middle_chars", "output")

_unit = re.compile(UNIT)


def cuts(text: str, h1: int, h2: int) -> tuple[int, int, int]:
    """(units, end of the prefix, end of the middle), in code points."""
    n = sum(1 for _ in _unit.finditer(text))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    matches, first = _unit.finditer(text), 0
    if low:
        first = next(islice(matches, low - 1, None)).end()
    second = next(islice(matches, high - low - 1, None)).end() if high > low else first
    return n, first, second


def _cuts(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    # one text at a time: the batch isn't turned into Python strings as a whole
    rows = [cuts(t.as_py(), a, b) for t, a, b in zip(text, h1.to_pylist(), h2.to_pylist(), strict=True)]
    return pa.StructArray.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["n", "first", "second"])


def draws(key: str, seed: int) -> list[Column]:
    """Four numbers of 32 bits from the SHA-256 of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transformed(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """All columns of ``docs`` with n, form (plain, psm, spm), prefix_chars, middle_chars (null if plain) and output."""
    small_batches(docs.sparkSession)
    docs = docs.select(*[c for c in docs.columns if c in (key, text) or c not in _OUT])
    row, t, h, c = fresh(docs, "row", "t", "h", "c")
    a = docs.select(F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias(row), text_of(text).alias(t), F.array(*draws(key, seed)).alias(h))
    a = a.withColumn(c, F.arrow_udf(_cuts, "struct<n: long, first: long, second: long>")(F.col(t), F.get(h, F.lit(0)), F.get(h, F.lit(1))))
    marked = F.contains(F.col(t), F.lit(PREFIX)) | F.contains(F.col(t), F.lit(SUFFIX)) | F.contains(F.col(t), F.lit(MIDDLE))
    form = F.when((F.col(t) == "") | marked | (F.get(h, F.lit(2)) % 100 >= rate), "plain").when(F.get(h, F.lit(3)) % 100 < suffix_first, "spm").otherwise("psm")
    first, second = F.col(c)["first"].cast("int"), F.col(c)["second"].cast("int")
    parts = F.substring(F.col(t), F.lit(1), first), F.substring(F.col(t), first + 1, second - first), F.substring(F.col(t), second + 1, F.lit(2**31 - 1))
    prefix, middle, suffix = (F.concat(F.lit(m), p) for m, p in zip((PREFIX, MIDDLE, SUFFIX), parts, strict=True))
    output = F.when(F.col("form") == "psm", F.concat(prefix, suffix, middle)).when(F.col("form") == "spm", F.concat(suffix, prefix, middle)).otherwise(F.col(t))
    chars = [F.when(F.col("form") != "plain", x) for x in (F.col(c)["first"], F.col(c)["second"] - F.col(c)["first"])]
    kept = [F.col(row)[x].alias(x) for x in docs.columns if x not in _OUT]
    return a.withColumn("form", form).select(*kept, F.col(c)["n"].alias("n"), "form", chars[0].alias("prefix_chars"), chars[1].alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        a = F.split(F.substring(output, F.lit(4), F.lit(2**31 - 1)), second, 2)
        b = F.split(F.get(a, F.lit(1)), MIDDLE, 2)
        return F.get(a, F.lit(0)), F.get(b, F.lit(0)), F.get(b, F.lit(1))

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    suffix2, prefix2, middle2 = parts(SUFFIX, PREFIX)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(prefix2, middle2, suffix2)).otherwise(output)


def op12_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    hashed = F.sha2(F.col("output"), 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return transformed(docs).select("doc_id", "n", "form", "prefix_chars", "middle_chars", *hashed)


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '{UNIT}') AS u, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
r AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
 CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 % 100 >= {RATE} THEN 'plain' WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM r)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
 sha256(CASE form WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle WHEN 'spm' THEN '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle ELSE t END) AS output_sha256,
 sha256(CASE form WHEN 'plain' THEN t ELSE prefix || middle || suffix END) AS restored_sha256 FROM p
"""
