"""Personal data by weak supervision (operator 5).

Base spans (email, ip, card, phone) follow fixed patterns and always stay.  A
wider search proposes further candidates: numbers without a country prefix,
spelled-out addresses, identity numbers, bank accounts, access tokens.  For every
candidate, labelers vote personal, not personal or abstain: the strict regex, a
checksum or range test, a gazetteer (known top-level domains, card and calling
prefixes, key names), the words before it, the words that speak against it, and
its borders.  Vote patterns of all candidates of all documents are counted;
expectation maximisation over the counts estimates, kind by kind, how each labeler
votes on personal and on other spans; its posteriors are the targets of the final span
classifier, a logistic regression over the shape of a span and its surroundings,
which decides about the candidates that aren't base spans.

What reaches the driver is the table of (kind, votes, shape) counts, whose size
is bounded by the number of such cells and not by the corpus.

Defined results: a null text is empty and has no span; repeated rows and very
long texts are searched in full; every search takes time in proportion to the
text; of candidates that begin at one place the longest counts, and none that
overlaps a base span; a probability of just ``least`` accepts, but 0.5 itself
doesn't; extra columns pass through, but for those with the names of results,
which are replaced; an empty table gives an empty table, and without candidates
nothing is added.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "identity", "account", "secret")

#: Fixed values of the base patterns.  A run of digits can only match from its first digit, as it must reach its end.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")

#: Wider searches, each bounded in length but for the last, whose run of one class of characters always ends at a border.
_WIDE = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}\x20?(?:\[dot\]|\(dot\)|\x20dot\x20)\x20?[A-Za-z]{2,12}(?![A-Za-z0-9])"), ("at",)),
    ("phone", re.compile(r"(?<![0-9A-Za-z+])\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])"), ("digit",)),
    ("identity", re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"), ("digit",)),
    ("account", re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"), ("digit",)),
    ("secret", re.compile(r"(?<![0-9A-Za-z])[0-9A-Za-z_+/=-]{24,}(?![0-9A-Za-z])"), ("digit",)),
)

#: Gazetteers.
_TLDS = frozenset("com org net edu gov io co de fr es uk us info biz me app dev eu it nl ch at be ca au jp cn in br ru pl se no".split())
_CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "36", "38", "6011", "65", "35", "22", "23", "24", "25", "26", "27")
_CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "94", "95", "98")
_NAMES = {
    "email": ("mail", "contact", "write", "courriel", "correo"), "ip": ("ip", "host", "address", "server", "client"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"), "phone": ("phone", "tel", "call", "mobile", "fax", "cell"),
    "identity": ("ssn", "social", "identity", "passport"), "account": ("iban", "account", "bank", "konto", "compte"),
    "secret": ("token", "key", "secret", "password", "passwd", "pwd", "auth", "bearer"),
}
_AGAINST = ("version", "isbn", "page", "figure", "chapter", "section", "http", "doi", "sha", "commit", "order", "invoice", "price")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, one look at each ``@``: what stands before it back to the last match, then the domain."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > floor and text[a - 1] in _LOCAL:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            out.append((a, m.end()))
            floor = m.end()
        at = text.find("@", max(at + 1, floor))
        floor = max(floor, 0)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, in order."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p[-4:] if len(p) > 4 else p) <= 255 for p in m[0].split(".")):
                out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            d = _digits(m[0]) if m.end() - m.start() < 64 else ""
            if 13 <= len(d) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(48 <= ord(c) <= 57 for c in m[0]) <= 15:
                    out.append((3, m.start(), m.end()))
    return out


def candidates(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and what the wider searches add outside of them."""
    base = base_spans(text)
    digit = bool(_DIGIT.search(text))
    if not digit and not ("dot" in text and "at" in text):
        return base, []
    more = []
    for name, pattern, (needs,) in _WIDE:
        if needs == "digit" and digit or needs == "at" and "dot" in text:
            more += [(KINDS.index(name), m.start(), m.end()) for m in pattern.finditer(text)]
    if not more:
        return base, []
    more.sort(key=lambda s: (s[1], -s[2]))
    taken = sorted((a, b) for _, a, b in base)
    kept, last, i = [], -1, 0
    for k, a, b in more:
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if a >= last and not (i < len(taken) and taken[i][0] < b):
            kept.append((k, a, b))
            last = b
    return base, kept


def _iban(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


LABELERS = ("regex", "checksum", "gazetteer", "context", "against", "border")


def votes_of(text: str, kind: int, a: int, b: int, strict: bool) -> tuple[int, ...]:
    """One vote of each labeler: 1 personal, -1 not, 0 abstains."""
    s, name = text[a:b], KINDS[kind]
    before = text[max(0, a - 32) : a].lower()
    d = _digits(s)
    regex = 1 if strict or name in ("identity", "account") else 0
    if name == "card":
        check = 1 if luhn(d) else -1
    elif name == "account":
        check = 1 if _iban(s) else -1
    elif name == "ip":
        check = 1
    elif name == "phone":
        check = 1 if 9 <= len(d) <= 15 else -1
    elif name == "identity":
        check = -1 if s.startswith(("000", "666", "9")) else 1
    elif name == "secret":
        kinds = sum(any(lo <= c <= hi for c in s) for lo, hi in (("0", "9"), ("a", "z"), ("A", "Z")))
        check = 1 if len(set(s)) >= 10 and kinds >= 2 and len(d) >= 4 else -1
    else:
        check = 0
    if name == "email":
        listed = 1 if s.rsplit(".", 1)[-1].lower() in _TLDS or s.rsplit(" ", 1)[-1].lower() in _TLDS else -1
    elif name == "card":
        listed = 1 if d.startswith(_CARD_PREFIXES) else -1
    elif name == "phone" and s.startswith("+"):
        listed = 1 if d.startswith(_CALLING) else -1
    elif name == "secret":
        listed = 1 if re.fullmatch(r"[0-9a-f]{32,64}", s) else 0
    else:
        listed = 0
    context = 1 if any(w in before for w in _NAMES[name]) else (-1 if name == "secret" else 0)
    against = -1 if any(w in before for w in _AGAINST) else 0
    left, right = text[a - 1 : a], text[b : b + 1]
    border = -1 if left.isalnum() or right.isalnum() else 1
    return regex, check, listed, context, against, border


def shape_of(text: str, kind: int, a: int, b: int) -> tuple[int, ...]:
    """What the final classifier sees: kind, length, share of digits, variety, separators, borders, a key name or ``=`` before."""
    s = text[a:b]
    n, d = b - a, sum(48 <= ord(c) <= 57 for c in s)
    before = text[max(0, a - 32) : a].lower()
    return (
        kind, min(7, n // 8), min(4, 5 * d // max(n, 1)), min(4, len(set(s)) // 5), min(3, sum(c in " -.()" for c in s)),
        int(text[a - 1 : a].isalnum() or text[b : b + 1].isalnum()), int(any(w in before for w in _NAMES[KINDS[kind]])), int(text[max(0, a - 3) : a].rstrip(' "').endswith(("=", ":"))),
    )


#: How many values each part of a shape has.
SHAPE_SIZES = (len(KINDS), 8, 5, 5, 4, 2, 2, 2)


def cells(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows (cell, n): candidates of all documents counted by votes and shape, first within each partition."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            for x in pdf[text]:
                base, more = candidates(x or "")
                for strict, spans in ((True, base), (False, more)):
                    for k, a, b in spans:
                        seen[(*votes_of(x, k, a, b, strict), *shape_of(x, k, a, b))] += 1
        if seen:
            yield pd.DataFrame({"cell": [",".join(map(str, c)) for c in seen], "n": list(seen.values())})

    return docs.select(text).mapInPandas(run, "cell string, n long").groupBy("cell").agg(F.sum("n").alias("n"))


#: How votes (-1, 0, 1) are believed to fall on personal and on other spans before any is seen.
GOOD, BAD = np.array([0.12, 0.4, 0.48]), np.array([0.36, 0.4, 0.24])


def label_em(votes: np.ndarray, n: np.ndarray, rounds: int = 60, edge: float = 0.005, anchor: float = 0.1) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """For the vote patterns of one kind: posterior of "personal"; prior; shares of each labeler's votes on personal and on other spans.

    An abstention is a vote of its own, as some labelers only ever speak against
    a span.  The first beliefs count as a share ``anchor`` of all candidates (ten at
    least), so they keep their meaning in small and large tables alike.
    """
    share = max(10.0, anchor * float(n.sum()))
    hot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    prior, good, bad = 0.7, np.tile(GOOD, (votes.shape[1], 1)), np.tile(BAD, (votes.shape[1], 1))
    for _ in range(rounds):
        odds = math.log(prior / (1 - prior)) + np.einsum("ijv,jv->i", hot, np.log(good) - np.log(bad))
        p = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        yes, no = n * p, n * (1 - p)
        prior = float(np.clip((yes.sum() + 1) / (n.sum() + 2), edge, 1 - edge))
        good = (np.einsum("i,ijv->jv", yes, hot) + share * GOOD) / (yes.sum() + share)
        bad = (np.einsum("i,ijv->jv", no, hot) + share * BAD) / (no.sum() + share)
    return p, prior, good, bad


def targets(kinds: np.ndarray, votes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Posterior of each pattern; every kind has reliabilities of its own, as a checksum says more of some kinds than of others."""
    out = np.zeros(len(n))
    for k in np.unique(kinds):
        own = kinds == k
        out[own] = label_em(votes[own], n[own])[0]
    return out


def _encoded(shapes: np.ndarray) -> np.ndarray:
    """One column for each value of each part of the shape, and one for the constant."""
    begins = np.concatenate([[0], np.cumsum(SHAPE_SIZES)])
    x = np.zeros((len(shapes), begins[-1] + 1))
    x[:, -1] = 1
    for j, b in enumerate(begins[:-1]):
        x[np.arange(len(shapes)), b + shapes[:, j]] = 1
    return x


def fit_logistic(x: np.ndarray, target: np.ndarray, n: np.ndarray, rounds: int = 25, ridge: float = 1.0) -> np.ndarray:
    """Newton steps on weighted soft targets."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (target - p)) - ridge * w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Weights of the span classifier, from all candidates of all documents."""
    rows = sorted((tuple(map(int, r["cell"].split(","))), r["n"]) for r in cells(docs, text).collect())
    if not rows:
        return np.zeros(sum(SHAPE_SIZES) + 1)
    table, n = np.array([r[0] for r in rows]), np.array([float(r[1]) for r in rows])
    m = len(LABELERS)
    return fit_logistic(_encoded(table[:, m:]), targets(table[:, m], table[:, :m], n), n)


def all_spans(text: str, weights: np.ndarray, least: float = 0.5) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and the added ones that the classifier accepts."""
    base, more = candidates(text)
    if more:
        p = 1 / (1 + np.exp(-np.clip(_encoded(np.array([shape_of(text, *s) for s in more])) @ weights, -30, 30)))
        more = [s for s, q in zip(more, p, strict=True) if q >= least and q > 0.5]
    return base, more


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def found(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` without the text, with counts, base_sha256, spans and their number in place of columns of those names."""
    small_batches(docs.sparkSession)
    docs = docs.drop(*_OUT)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for x in pdf[text]:
                base, more = all_spans(x or "", weights)
                n = Counter(k for k, _, _ in base)
                rows.append((*(n[k] for k in range(4)), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + more), len(base) + len(more)))
            yield pd.concat([pdf.drop(columns=[text]).reset_index(drop=True), pd.DataFrame(rows, columns=_OUT)], axis=1)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text)
    return docs.mapInPandas(run, f"{kept}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long")


_OUT = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans"]


def redact(text: str, weights: np.ndarray) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans are replaced as one."""
    base, more = all_spans(text, weights)
    if not base and not more:
        return text
    out, at, end = [], 0, 0
    for a, b, k in sorted((a, b, k) for k, a, b in base + more):
        if a >= end:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        end = max(end, b)
        at = end
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with personal data replaced in the text; a null text stays null."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf[text] = [None if x is None else redact(x, weights) for x in pdf[text]]
            yield pdf

    return docs.mapInPandas(run, docs.schema)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return found(docs, fit(docs))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: personal data is replaced, every document stays; n_chars follows the text."""
    out = redacted(docs, fit(docs))
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns)
