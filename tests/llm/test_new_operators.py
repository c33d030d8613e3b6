"""URL filters, fill-in-middle and the divergence audit against brute force, with nulls, empties, ties, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from geoloom.llm import divergence, middle, queries, urls
from test_corpus import odd_docs

UNIT = re.compile(middle.UNIT)


@pytest.mark.parametrize("name", ["op12_middle", "op13_divergence"])
def test_against_sql(spark, sf_dir, duck, name):
    got, want = queries.queries()[name](spark, sf_dir).toPandas(), duck.execute(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got, sorted(got.columns)) == rows_of(want, sorted(got.columns))


# --- 11 ---


def brute_parts(url):
    after = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host = re.match("[^/?#]*", after)[0]
    path = re.match("[^?#]*", after[len(host) :])[0]
    query = after.partition("#")[0].partition("?")[2]
    host = re.sub("[A-Z]+", lambda m: m[0].lower(), host)
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), path)
    words = ["#" if re.fullmatch("[0-9]+", w) else w for w in re.split("[^a-z0-9\x80-\U0010ffff]+", low) if w]
    tokens = {f"h:{x}" for x in host.split(".") if x} | {f"p:{x}" for x in words} | {f"q:{x.partition('=')[0]}" for x in query.split("&") if x.partition("=")[0]}
    return host, path, tokens


def brute_rule(host, path, rules):
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def brute_urls(all_urls, rules, labels=None, support=urls.SUPPORT, fewest=urls.FEWEST, confidence=urls.CONFIDENCE):
    """(host, path, rule, verdict) of each URL: every combination of every labelled URL is counted."""
    parts = [brute_parts(u) for u in all_urls]
    named = [brute_rule(h, p, rules) for h, p, _ in parts]
    labelled = [(t, v) for (_, _, t), (_, v) in zip(parts, named, strict=True) if v] if labels is None else [(brute_parts(u)[2], v) for u, v in labels]
    least = max(support * len(labelled), fewest)
    hits, n = Counter(), Counter()
    for tokens, v in labelled:
        for k in range(1, len(tokens) + 1):
            for c in itertools.combinations(sorted(tokens), k):
                n[c] += 1
                hits[c, v] += 1
    share = {v: k / len(labelled) for v, k in Counter(v for _, v in labelled).items()}
    sure = {(c, v): (k / n[c], k) for (c, v), k in hits.items() if k >= least and k / n[c] >= confidence and k / n[c] > share[v]}
    out = []
    for (host, path, tokens), (rule, v) in zip(parts, named, strict=True):
        if v is None:
            fits = [(-q, -k, len(c), c, v2) for (c, v2), (q, k) in sure.items() if tokens.issuperset(c)]
            v = min(fits)[4] if fits else urls.DEFAULT
        out.append((host, path, rule, v))
    return out


def test_urls_query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r["page_id"]: tuple(r[c] for c in ("host", "path", "rule", "verdict")) for r in queries.queries()["op11_urls"](spark, sf_dir).collect()}
    want = brute_urls([p["url"] for p in pages], urls.LIST)
    assert got == dict(zip([p["page_id"] for p in pages], want, strict=True))


def test_urls_mined_rules_decide(spark):
    rng = random.Random(4)
    known = [(f"https://{rng.choice('abc')}.x.com/{'buy' if bad else rng.choice(['news', 'wiki'])}/{rng.choice(['p', 'q'])}/{rng.randint(1, 999)}?s={rng.random()}", "block" if bad and rng.random() < 0.95 else "allow") for bad in (rng.random() < 0.4 for _ in range(300))]
    fresh = [f"http://{rng.choice('xyz')}.y.net/{w}/{rng.randint(1, 99)}" for w in ("buy", "news", "wiki", "other") for _ in range(10)]
    rules = spark.createDataFrame([("none.org", "/", "block")], "host string, path string, verdict string")
    got = urls.judged(spark.createDataFrame([(u,) for u in fresh], "url string"), rules, spark.createDataFrame(known, "url string, verdict string"))
    have = {r["url"]: r["verdict"] for r in got.collect()}
    want = brute_urls(fresh, [("none.org", "/", "block")], known)
    assert have == {u: w[3] for u, w in zip(fresh, want, strict=True)}
    assert {have[u] for u in fresh if "/buy/" in u} == {"block"} and {have[u] for u in fresh if "/news/" in u} == {"allow"}


def test_urls_odd_rows(spark):
    odd = [None, "", "no scheme/x", "http://", "HTTP://ORG", "x://ORG/?a", "x://a.ORG/b://c", "x://example.org/en/1?q#f", "x://example.org/en/2#z?y", "x://notexample.org/es/", "x://sub.example.org/es/", "x://example.com/de", "x://example.com/de/É", "x://u@com:80/fr/", "x://.com/fr/", "x://" + "a." * 500 + "org/" + "b/" * 5000]
    rows = [(k, u, "keep", 1) for k, u in enumerate(odd * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, row int").withColumns({"HOST": F.lit(1), "tokens": F.lit(2), "signature": F.lit(3), "head": F.lit(4)})
    rules = spark.createDataFrame([*urls.LIST, ("com", "/fr/", "block"), ("com", "/fr/", "allow")], "host string, path string, verdict string")
    got = urls.judged(pages.drop("HOST"), rules)
    assert [c for c in got.columns if c not in ("host", "path", "rule", "verdict", "mined_rule", "confidence")] == ["page_id", "url", "row", "tokens", "signature", "head"]
    listed = [r for r in urls.LIST if r[:2] != ("com", "/fr/")] + [("com", "/fr/", "block")]
    want = dict(enumerate((*brute_parts(u)[:2], *brute_rule(*brute_parts(u)[:2], listed)) for u in odd * 2))
    have = {r["page_id"]: r for r in got.collect()}
    for k, (host, path, rule, verdict) in want.items():
        assert (have[k]["host"], have[k]["path"], have[k]["rule"]) == (host, path, rule)
        assert have[k]["verdict"] == verdict if verdict else have[k]["verdict"] in ("allow", "block")
    assert have[0]["verdict"] == urls.DEFAULT
    assert urls.judged(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in urls.judged(pages, rules.limit(0)).collect()} == {urls.DEFAULT}


# --- 12 ---


def brute_middle(key, text):
    text = text or ""
    units = [m[0] for m in UNIT.finditer(text)]
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    parts = ["".join(x) for x in (units[:a], units[a:b], units[b:])]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(parts[0]), len(parts[1]), f"<S>{parts[2]}<P>{parts[0]}<M>{parts[1]}"
    return len(units), "psm", len(parts[0]), len(parts[1]), f"<P>{parts[0]}<S>{parts[2]}<M>{parts[1]}"


def test_middle_odd_rows(spark):
    long = " ".join(random.Random(2).choices(["alpha", "bétâ", "\U0001d11e", "<S", "P>"], k=60_000)) + " \t\n"
    texts = [None, "", " ", " \n a", "a <P> b", "a<", "<S", "a\x00b c\x85d\x0be", "one two  three\tfour ", "é \U0001d11e x", long, *(f"w{i} " * (i % 7) + "<P" for i in range(80))]
    rows = [(k, t, "x", k) for k, t in enumerate(texts)] + [(None, "some words here", "x", 0), (5, "a<", "x", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string, n int").withColumns({"row": F.lit(1), "t": F.lit(2), "first": F.lit(3)})
    got = middle.transformed(df).withColumn("back", middle.restored(F.col("output"), F.col("form")))
    assert got.columns == ["doc_id", "text", "row", "t", "first", "n", "form", "prefix_chars", "middle_chars", "output", "back"]
    have = Counter((r["doc_id"], r["text"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in got.collect())
    assert have == Counter((k, t, *brute_middle(k, t)) for k, t, *_ in rows)
    assert {f for _, _, _, f, *_ in have} == {"plain", "psm", "spm"}
    assert got.where(F.col("back") != F.coalesce("text", F.lit(""))).count() == 0
    assert middle.transformed(df.limit(0)).count() == 0
    named = spark.createDataFrame([("https://a/b", "x y z " * 9), ("u-7", "p q r s t")], "id string, body string")
    for r in middle.transformed(named, "id", "body").collect():
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute_middle(r["id"], r["body"])


def test_middle_holds_no_units():
    assert middle.cuts("a b c d", 1, 3) == (4, 1, 5) and middle.cuts("a b c d", 4, 4) == (4, 7, 7) and middle.cuts("", 5, 9) == (0, 0, 0)
    assert middle.cuts("a  ", 2, 2) == (2, 3, 3) and middle.cuts("a b c d", 5, 0) == (4, 0, 0)


# --- 13 ---


def brute_audit(rows, least=10, top=10):
    term = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    df, n, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in ((lang or "", source or "", text or "") for lang, source, text in rows):
        words = term.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text))
        df[lang].update(set(words))
        n[lang, source].update(words)
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, k in df[lang].items() if k >= least]
        v = len(kept)

        def p(counts, v=v, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * v) for t in kept}

        of = {s: p(n[lang, s]) for s in sources}
        whole = p(sum((n[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = sorted((-sum(f(of[s][t], of[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            out |= {(lang, s, "pair", o, -x, k + 1) for k, (x, _, o) in enumerate(pairs)}
            terms = sorted((-f(of[s][t], whole[t]), t.encode(), t) for t in kept if n[lang, s][t] and of[s][t] > whole[t])
            out |= {(lang, s, "term", t, -x, k + 1) for k, (x, _, t) in enumerate(terms[:top])}
    return out


def test_audit_odd_rows(spark):
    rng = random.Random(8)
    words = ["alpha", "Beta", "É", "é", "x1y", "ÀB", "日本", "don't", "Z", "\U0001d11e"]
    rows = [(rng.choice(["en", "fr", None, ""]), rng.choice(["a", "b", "c", None]), " ".join(rng.choices(words, k=rng.randint(0, 12)))) for _ in range(160)]
    rows += [("en", "void", None), ("en", "void", ""), ("de", "one", "lonely words"), ("de", "one", None), ("it", "x", "rare"), ("it", "y", "terms"), ("en", "a", "alpha " * 30_000), rows[0], rows[0]]
    df = spark.createDataFrame(rows, "lang string, source string, text string").withColumns({c: F.lit(1) for c in ("doc_id", "term", "n", "v", "item", "value", "rank", "p", "head")})
    for cells in (None, 1 << 16):  # a sketch as narrow as can be lets every term through and changes nothing
        got = divergence.audit(df.repartition(5), cells=cells)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        have = [tuple(r) for r in got.collect()]
        assert len(have) == len(set(have)) and set(have) == brute_audit(rows)
    assert divergence.audit(df.limit(0)).count() == 0


def test_audit_hashes_agree_with_terms():
    """The vectorised hash sees the terms that the pattern finds, wherever chunks end, and the sketch never underestimates."""
    rng = random.Random(3)
    texts = ["".join(rng.choices("abXYZ é1 \n'", k=rng.randint(0, 400))) for _ in range(60)] + ["q" * 5000, "", "A"]
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    joined = np.frombuffer(b"".join(data), np.uint8)
    terms = [t for b in data for t in divergence._term.findall(b.lower())]
    big, small = divergence.Hasher(), divergence.Hasher()
    before, divergence.CHUNK = divergence.CHUNK, 64
    try:
        parts = list(small(joined, offsets[1:-1]))
    finally:
        divergence.CHUNK = before
    once = np.concatenate([h for _, h in big(joined, offsets[1:-1])])
    assert len(parts) > 20 and np.array_equal(np.concatenate([h for _, h in parts]), once) and len(once) == len(terms)
    by_term = dict(zip(terms, once.tolist(), strict=True))
    assert all(by_term[t] == h for t, h in zip(terms, once.tolist(), strict=True)) and len(set(by_term.values())) == len(by_term)


def test_audit_sketch_never_underestimates(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["en", "fr"]), "s", " ".join(f"t{chr(97 + rng.randint(0, 25))}{chr(97 + int(rng.random() ** 3 * 26))}" for _ in range(30))) for _ in range(120)]
    df = defaultdict(Counter)
    for lang, _, text in rows:
        df[lang].update(set(text.split()))
    cells = 1 << 16
    bits = np.frombuffer(divergence.possible(spark.createDataFrame(rows, "lang string, source string, text string").repartition(4), cells), np.uint8)
    hasher, kept, let = divergence.Hasher(), 0, 0
    for lang, c in df.items():
        joined = np.frombuffer(" ".join(c).encode(), np.uint8)
        h = np.concatenate([h for _, h in hasher(joined, np.zeros(0, np.int64))])
        at = divergence._cells(divergence._mixed(h, divergence._seed(lang.encode())), cells)
        good = ((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)
        often = np.array([n >= 10 for n in c.values()])
        assert good[often].all()
        kept, let = kept + often.sum(), let + good.sum()
    assert let - kept < 0.05 * sum(map(len, df.values()))
