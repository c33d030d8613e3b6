"""Corpus operators against brute force, round trips and held-out accuracy, with nulls, empties, ties, repeats and clashing columns."""

from __future__ import annotations

import collections
import hashlib
import itertools
import json
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from geoloom.llm import chat, components, decontaminate, html, langid, pieces, pii, quality, queries, simhash, suffixes, warc
from geoloom.llm.common import fresh, shared_dir, slices, store_of, stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns with names used inside."""
    long = " ".join(random.Random(1).choices(["alpha", "beta", "gamma", "delta"], k=30_000))
    rows = [(1, "the cat sat on the mat and was seen by the dog", "en", "s", 10), (1, "the cat sat on the mat and was seen by the dog", "en", "s", 10), (2, None, None, None, None), (3, "", "en", "s", 0), (None, "the cat sat on the mat and was seen by a dog", "en", "s", 5), (None, None, None, None, None), (4, long, "en", "s", len(long)), (5, " \n\t ", "en", None, 3), (6, "x", None, "s", 1), (7, "▁ odd \x01 text\x02 \U0001d11e", "en", "s", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(1) for c in ("_q", "_w", "fp", "h1", "id", "root", "score", "lang_pred", "pieces", "n_email", "_id", "_hash", "kept", "item_id", "component", "anchor")})


def test_helpers(spark):
    assert list(slices(["a" * 5, "b", "c" * 9, "d"], 6)) == [(0, 2), (2, 3), (3, 4)] and list(slices([])) == []
    assert fresh(spark.range(1).withColumn("A", F.lit(1)), "a", "id", "a") == ["a_", "id_", "a__"]
    assert shared_dir(spark)


# --- 1 ---


def brute_fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    sh = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_components(ids, prints):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(least[r], d)
    return [least[find(i)] for i in range(len(ids))]


def test_simhash_query(spark, sf_dir, docs):
    got = {r["doc_id"]: r for r in queries.queries()["op1_simhash"](spark, sf_dir).collect()}
    ids = sorted(docs)
    prints = [brute_fingerprint(docs[i]) for i in ids]
    assert [got[i]["fingerprint"] for i in ids] == [f"{p:016x}" for p in prints]
    assert [got[i]["component_id"] for i in ids] == brute_components(ids, prints)


def test_simhash_odd(spark):
    rows = simhash.near_duplicates(odd_docs(spark)).collect()
    assert len(rows) == 10
    ids = [r["doc_id"] for r in rows]
    assert [r["component_id"] for r in rows] == brute_components(ids, [r["fp"] & (2**64 - 1) for r in rows])
    assert simhash.near_duplicates(odd_docs(spark).limit(0)).count() == 0


@pytest.mark.parametrize("block", [8, 1 << 14])
def test_simhash_buckets(spark, block):
    """Dense groups, and buckets larger than a block."""
    rng = random.Random(block)
    bases = [rng.getrandbits(64) for _ in range(6)]
    prints = set()
    for b in bases:
        for _ in range(60):
            x = b
            for k in rng.sample(range(64), rng.randint(0, 6)):
                x ^= 1 << k
            prints.add(x)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), block=block)
    roots = {r["node"]: r["root"] for r in components.components(edges).collect()}
    want = brute_components(signed, prints)
    got = [roots.get(s, s) for s in signed]
    assert [w for w in want] == [min(s for s, r in zip(signed, got, strict=True) if r == g) for g in got]


def test_bit_slices():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    b = a.copy()
    for i in range(500):
        for k in rng.integers(0, 64, rng.integers(0, 9)):
            b[i] ^= np.uint64(1 << int(k))
    for radius in range(8):
        hit = np.zeros(500, bool)
        hit[simhash.lanes(simhash.within(simhash.planes(a ^ b), None, radius), 500)] = True
        assert (hit == (np.bitwise_count(a ^ b) <= radius)).all()


def test_components(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


# --- 2 ---


def test_pieces_round_trip_and_samples(docs):
    m = pieces.Model()
    texts = ["", "\n", " ", "a  b   c", " lead", "trail ", "\n\nx\n y \n", "é　x☃\U0001d11e", "x" * 300, "日本語。", *list(docs.values())[:150]]
    for a, b in slices(texts):
        for t, (own, more) in zip(texts[a:b], pieces.sampled(m, texts[a:b], [str(i) for i in range(a, b)], 3), strict=True):
            assert own.tolist() == m.sp.encode(t) and m.sp.decode(own.tolist()) == t
            assert len({tuple(i.tolist()) for i, *_ in more}) == len(more)
            assert all(m.sp.decode(i.tolist()) == t and 0 <= q <= 1 for i, _, _, q in more)
            assert [g for _, _, g, _ in more] == sorted((g for _, _, g, _ in more), reverse=True)


def test_pieces_sample_without_replacement():
    """Frequencies of first and second samples against the enumerated distribution."""
    m = pieces.Model()
    word = "▁abc"
    known = {m.sp.id_to_piece(i): i for i in range(m.size)}
    p = {}
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, cur = [], word[0]
        for c, ch in zip(cuts, word[1:], strict=True):
            parts, cur = ([*parts, cur], ch) if c else (parts, cur + ch)
        parts.append(cur)
        if all(x in known for x in parts):
            p[tuple(known[x] for x in parts)] = math.exp(sum(m.weight[known[x]] for x in parts))
    z = sum(p.values())
    n = 6000
    drawn = pieces.sampled(m, ["abc"] * n, [str(i) for i in range(n)], 2)
    pairs = collections.Counter(tuple(tuple(x[0].tolist()) for x in more) for _, more in drawn)
    for a, b in itertools.permutations(p, 2):
        assert pairs[a, b] / n == pytest.approx(p[a] / z * p[b] / (z - p[a]), abs=0.02)
    short = pieces.sampled(m, ["▁"[:0] + "q"], ["k"], 50)[0][1]
    assert all(q == 1.0 for *_, q in short)  # all segmentations came


def test_pieces_query(spark, sf_dir, docs):
    rows = queries.queries()["op2_pieces"](spark, sf_dir).collect()
    m = pieces.Model()
    assert len(rows) == len(docs) and all(r["lossless"] for r in rows)
    for r in rows[:50]:
        assert r["ids_sha256"] == hashlib.sha256(np.array(m.sp.encode(docs[r["doc_id"]]), "<i4").tobytes()).hexdigest()
    odd = pieces.encoded(odd_docs(spark)).collect()
    assert len(odd) == 10 and [r["lossless"] for r in odd if r["doc_id"] == 7] == [False]
    assert odd[0]["sampled"] == odd[1]["sampled"]  # repeated rows


# --- 3 ---


def test_chat_query_against_sql(spark, sf_dir, duck):
    got = {tuple(r) for r in queries.queries()["op3_chat"](spark, sf_dir).collect()}
    assert got == set(duck.execute(queries.oracle_sql()["op3_chat"]).fetchall())


def test_chat_odd_rows(spark):
    t = "<|im_end|> <\\| <\\\\|x|> \\n"
    rows = [(5, 1, "assistant", t), (5, 0, "us<|er\n\\n", None), (5, 0, None, t), (None, 0, "assistant", ""), (5, 1, "assistant", t), (6, None, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(0))
    got = {r["conv_id"]: r for r in chat.conversation_digests(df).collect()}
    turns = [("", t), ("us<|er\n\\n", ""), ("assistant", t), ("assistant", t)]
    assert got[5]["n_turns"] == 4 and got[5]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
    assert got[5]["loss_sha256"] == hashlib.sha256((t + t).encode()).hexdigest() and got[5]["loss_chars"] == 2 * len(t)
    assert set(got) == {5, 6, None}
    whole = {r["conv_id"]: r for r in chat.format_conversations(df).collect()}[5]
    assert len(whole["formatted"]) == got[5]["formatted_chars"]
    assert [chat.unescape(whole["formatted"][s["start"] : s["end"]]) for s in whole["loss_spans"]] == [t, t]
    assert chat.conversation_digests(df.limit(0)).count() == 0


def test_chat_layouts(spark):
    records = [
        ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}, "messages", [("user", "a"), ("assistant", "b")]),
        ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, "conversations", [("user", "a"), ("assistant", "b")]),
        ({"prompt": "p", "response": "r"}, "prompt_response", [("user", "p"), ("assistant", "r")]),
        ({"instruction": "i", "input": None, "output": "o"}, "instruction_input", [("user", "i"), ("assistant", "o")]),
        ({"messages": [{"role": "user", "content": None}]}, "messages", [("user", "")]),
        ({"other": 1}, "unknown", None),
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r, _, _ in records] + [("not json",)], "record string")
    got = chat.record_turns(df).collect()
    for r, (_, name, turns) in zip(got, records, strict=False):
        assert r["layout"] == name and (None if r["turns"] is None else [tuple(t) for t in r["turns"]]) == turns
    assert got[-1]["layout"] == "unknown"


def test_chat_heterogeneous_records(spark):
    """JSON records and typed tables of every layout, with nulls and other names of roles, against plain Python."""
    rng = random.Random(12)
    some = lambda: rng.choice([None, "", "a <|im_end|> b", "line\nline", "<\\\\|x"])
    records, want = [], {}
    for i in range(120):
        x = rng.choice([y for y in chat.LAYOUTS if not y.row])
        if x.items:
            top, role, text = x.items
            turns = [(rng.choice(["user", "assistant", "HUMAN", "gpt", None]), some()) for _ in range(rng.randint(1, 4))]
            turns[0] = ("user", "first")  # types of a list are told by its values
            rec = {top: [{role: r, text: t} for r, t in turns]}
            want[i] = [(x.roles.get((r or "").lower(), r or ""), t or "") for r, t in turns]
        else:
            rec = {f: some() for _, f in x.pairs}
            want[i] = [(r, rec[f]) for r, f in x.pairs if rec[f] is not None]
        records.append((i, json.dumps(rec), x.name))
    df = spark.createDataFrame([r[:2] for r in records], "conv_id long, record string")
    got = {r["conv_id"]: r for r in chat.record_turns(df).collect()}
    assert all(got[i]["layout"] == name and [tuple(t) for t in got[i]["turns"]] == want[i] for i, _, name in records)
    rows = spark.createDataFrame([(5, 1, "GPT", None, "x"), (5, 0, "human", "hi", "y")], "id long, index int, from string, value string, turn string")
    assert sorted(map(tuple, chat.table_turns(rows).collect())) == [(5, 0, "user", "hi"), (5, 1, "assistant", "")]
    typed = spark.createDataFrame([(7, [("user", "q"), (None, None)])], "conv_id long, messages array<struct<role: string, content: string>>")
    assert sorted(map(tuple, chat.table_turns(typed).collect())) == [(7, 0, "user", "q"), (7, 1, "", "")]
    with pytest.raises(ValueError, match="no layout"):
        chat.table_turns(df.drop("record"))
    assert chat.conversation_digests(rows.limit(0)).collect() == []


# --- 4 ---


def base_features(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k + d for k in range(len(w) - 2) if n[tuple(w[k : k + 3])] > 1 for d in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_query(spark, sf_dir, docs):
    rows = queries.queries()["op4_quality"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        f = base_features(docs[r["doc_id"]])
        assert tuple(r)[1:6] == f
        assert r["base_failed"] == (f[0] < 50 or 100 * f[4] > 50 * f[0])
        assert not (r["kept"] and r["base_failed"])


def test_quality_em_by_brute_force(spark, sf_dir):
    """The fit over counted patterns against the same rounds in plain Python, document by document, and the posterior in the JVM."""
    slim = stored(quality.with_votes(quality.measured(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))).drop("text"), "votes")
    voted = slim.where(~quality.base_failed())
    model = quality.fit(voted, rounds=4)
    votes = [r[0] for r in voted.select("_votes").collect()]
    names = [r.name for r in quality.RULES]
    start = [[0.003] * 9, *[[0.6 if x in f else 0.2 for x in names] for f in quality.FAMILIES]]
    first = [0.85, 0.05, 0.05, 0.05]

    def chances(v, shares, bad):
        p = [s * math.prod(b if x == -1 else 1 - b if x == 1 else 1 for x, b in zip(v, row, strict=True)) for s, row in zip(shares, bad, strict=True)]
        return [x / sum(p) for x in p]

    shares, bad = first, start
    for _ in range(4):
        p = [chances(v, shares, bad) for v in votes]
        w = [0.01 * len(votes) * x for x in first]
        mass = [sum(q[c] for q in p) for c in range(4)]
        shares = [(mass[c] + w[c]) / (len(votes) + sum(w)) for c in range(4)]
        sums = lambda c, j, kinds: sum(q[c] for q, v in zip(p, votes, strict=True) if v[j] in kinds)  # noqa: E731, B023
        bad = [[min(0.999, max(0.001, (sums(c, j, (-1,)) + w[c] * start[c][j]) / (sums(c, j, (-1, 1)) + w[c]))) for j in range(9)] for c in range(4)]
        bad[0] = [min(x, 0.003) for x in bad[0]]
        bad[1:] = [[max(x, g + 0.001) for x, g in zip(row, bad[0], strict=True)] for row in bad[1:]]
    assert np.allclose(model.shares, shares) and np.allclose(model.bad, bad)
    got = voted.select("_votes", quality.posterior(F.col("_votes"), model).alias("p")).distinct().collect()
    assert all(r["p"] == pytest.approx(chances(r["_votes"], shares, bad)[0], abs=1e-9) for r in got)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01", "sf0.1"])
def test_quality_verdict_by_labels(spark, sf_dir, size):
    """Of labelled documents that pass the base rules: good ones stay, bad ones go, at every size of the table."""
    where = sf_dir.replace("sf0.001", size)
    labels = spark.read.parquet(f"{where}/labels.parquet")
    j = queries.queries()["op4_quality"](spark, where).join(labels, "doc_id").where("NOT base_failed")
    share = {r["quality"]: r["k"] for r in j.groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("k")).collect()}
    assert share[1] >= 0.97 and share[0] <= 0.2


def test_quality_ties_and_clashing_names(spark):
    good = " ".join(["the", "of", "and", "to", "in", *[f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)]])
    rows = [(i, good, "mine", "a", 5) for i in range(4)] + [(9, None, "mine", "b", 6)]
    got = quality.judged(spark.createDataFrame(rows, "doc_id long, text string, _q string, _ string, kept int")).collect()
    assert sorted((r["doc_id"], r["_"], r["kept"]) for r in got) == [*[(i, "a", True) for i in range(4)], (9, "b", False)]


def test_quality_odd(spark):
    rows = quality.judged(odd_docs(spark)).collect()
    assert len(rows) == 10 and not any(r["kept"] for r in rows if r["_q"]["n_words"] == 0)
    assert quality.judged(odd_docs(spark).limit(0)).count() == 0


# --- 5 ---


def brute_spans(x):
    luhn = lambda d: sum(v - 9 if v > 9 else v for v in (int(c) * (1 + i % 2) for i, c in enumerate(d[::-1]))) % 10 == 0
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_pii_base_spans(docs):
    rng = random.Random(3)
    texts = list(docs.values())
    for i in range(8000):
        x = "".join(rng.choices("a1.@+ -()0925\n%é", k=rng.randint(1, 60)))
        texts.append(x if i % 3 else "a@b.c" + x + rng.choice(["1.2.3.4.5", "0001.2.3.255", "256.1.1.1", "a@a@b.c-.d..e", "4785380592391139", "+1 (743) 555-3824"]) + x)
    assert all(pii.base_spans(x) == brute_spans(x) for x in texts)


def test_pii_query(spark, sf_dir, docs):
    rows = queries.queries()["op5_pii"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in brute_spans(docs[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))


def test_pii_model_and_redaction(spark):
    rng = random.Random(4)
    texts = [f'see token = "{rng.getrandbits(160):040x}" and mail ann.{i}@mail.example.com or call +1 (555) 010-{1000 + i}' for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    w = pii.fit(df)
    out = pii.redact(texts[0], w)
    assert "[EMAIL]" in out and "[PHONE]" in out and "[SECRET]" in out and "@" not in out
    odd = odd_docs(spark)
    assert pii.found(odd, pii.fit(odd)).count() == 10
    assert pii.found(odd.limit(0), pii.fit(odd.limit(0))).count() == 0
    for long in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+1" * 100_000, "@" * 200_000, "a@" * 100_000):
        pii.candidates(long)  # in time about proportional to the text


def test_empty_tables_and_clashing_names(spark):
    kind = "doc_id long, text string, spans int, n_ip string, lang string, lang_pred int, score string, pieces int, lossless string, bands int, key string, item_id int, part int"
    none = spark.createDataFrame([], kind)
    text = "write to anna@example.org about the long report of the day"
    one = spark.createDataFrame([(1, text, 7, "x", "en", 3, "s", 4, "l", 5, "k", 6, 8)], kind)
    bench = spark.createDataFrame([(3, "the long report of the day", 1)], "item_id long, text string, part int")
    assert pii.found(none, pii.fit(none)).collect() == [] and pieces.encoded(none).collect() == [] and pieces.encoded_digests(none).collect() == []
    assert langid.identified(none, langid.fit(none)).collect() == [] and decontaminate.contaminated(none, bench).collect() == [] and decontaminate.clean(one, bench.limit(0)).count() == 1
    (r,) = pii.found(one, pii.fit(one)).collect()
    assert (r["n_email"], r["n_ip"], r["n_spans"], r["lang"]) == (1, 0, 1, "en")
    (r,) = langid.identified(one, langid.fit(one)).collect()
    assert r["lang_pred"] == "en" and r["score"] > 0.9 and r["spans"] == 7
    (r,) = pieces.encoded(one).collect()
    assert r["lossless"] is True and r["key"] == "k" and len(r["pieces"]) > 5
    assert decontaminate.clean(one, bench).count() == 0 and decontaminate.clean(one, bench, block_chars=4).count() == 0


# --- 6 ---


def brute_trigrams(text):
    out = []
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        p = "\0" + w + "\0"
        out += [p[i : i + 3] for i in range(len(p) - 2)]
    return collections.Counter(out)


def test_langid_trigrams(docs):
    texts = ["", "a", " ab  c ", *list(docs.values())[:20]]
    codes, begins = langid.trigrams(texts)
    for i, t in enumerate(texts):
        got = collections.Counter("".join(chr(c >> s & 0x1FFFFF) for s in (42, 21, 0)) for c in codes[begins[i] : begins[i + 1]].tolist())
        assert got == brute_trigrams(t)


def test_langid_query(spark, sf_dir, docs):
    """Held-out accuracy, and a brute-force cosine."""
    rows = queries.queries()["op6_langid"](spark, sf_dir).collect()
    table = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(docs) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == table[r["doc_id"]] for r in held) / len(held) > 0.97
    v = langid.Vectors()
    letter = lambda c: v.of_letter(ord(c)).astype(np.int64)
    bundle = lambda text: sum(n * np.roll(letter(g[0]), 2) * np.roll(letter(g[1]), 1) * letter(g[2]) for g, n in brute_trigrams(text).items())
    protos = {}
    for i, t in docs.items():
        if zlib.crc32(str(i).encode()) % 4 != 2:
            protos[table[i]] = protos.get(table[i], 0) + bundle(t)
    for r in rows[:25]:
        x = bundle(docs[r["doc_id"]])
        cos = {k: float(x @ p / np.linalg.norm(x) / np.linalg.norm(p)) for k, p in protos.items()}
        best = max(cos, key=cos.get)
        assert r["lang_pred"] == best and r["score"] == pytest.approx(max(0.0, cos[best]), abs=1e-4)


def test_langid_odd(spark):
    df = odd_docs(spark)
    model = langid.fit(df.select("text", "lang"))
    rows = langid.identified(df, model).collect()
    assert len(rows) == 10 and {r["lang_pred"] for r in rows if not (r["text"] or "").strip()} == {"und"}
    assert {r["lang_pred"] for r in langid.identified(df, ([], np.zeros((0, langid.DIM)))).collect()} == {"und"}
    assert langid.of_a_language(df, model).columns == df.columns


# --- 7 ---


def brute_removal(texts, length):
    seen = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        m = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                m[i : i + length] = True
        m = m[: len(t)]
        out.append((len(t), int(m.sum()), int((np.diff(np.concatenate([[0], m.astype(int)])) == 1).sum()), hashlib.sha256(bytes(b for b, x in zip(t, m, strict=True) if not x)).hexdigest()))
    return out


@pytest.mark.parametrize("block", [1 << 16, 300])
def test_suffixes(spark, block):
    rng = random.Random(5)
    rt = lambda n: "".join(rng.choices("abcdefghij klmnop é\n", k=n))
    passages, texts = [rt(rng.randint(380, 900)) for _ in range(5)], []
    for _ in range(60):
        t = rt(rng.randint(0, 500))
        for _ in range(rng.randint(0, 2)):
            t += rng.choice(passages)[rng.randint(0, 60) :] + rt(rng.randint(0, 200))
        texts.append(t)
    texts += [None, "", "x" * 1500, "ab" * 700, texts[3], texts[3], "y" * 399, "y" * 399]
    df = spark.createDataFrame([(i if i % 9 else None, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("h1", F.lit(0))
    got = sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], r["n_repeated"]) for r in suffixes.deduplicated(df, block=block).collect())
    data = [(t or "").encode() for t in texts]
    assert got == sorted((*x, y[1]) for x, y in zip(brute_removal(data, 400), brute_removal(data, 256), strict=True))


def test_suffixes_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.deduplicated(df).collect() == []
    text = "".join(random.Random(2).choices("abcdefgh ", k=700))
    rows = [(1, text, "x", 0, 0), (2, "zz" + text[:500], "y", 1, 1), (2, "short", None, None, None)]
    got = suffixes.deduplicated(spark.createDataFrame(rows, "doc_id long, text string, cells string, anchor long, parts long")).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(1, 500), (2, 0), (2, 500)]


def test_anchors_do_not_depend_on_slices():
    rng = random.Random(8)
    texts = [bytes(rng.choices(b"ab ", k=rng.randint(256, 3000))) for _ in range(40)]
    parts = [[x.tolist() for x in suffixes.anchors([t])[1:]] for t in texts]
    t, *rest = suffixes.anchors(texts)
    assert [[x[t == i].tolist() for x in rest] for i in range(len(texts))] == parts


def test_two_stage_sorting():
    rng = random.Random(6)
    for _ in range(150):
        data = bytes(rng.choices(b"ab\x00\xff", k=rng.randint(1, 60))) + b"\x00\xff" + bytes(30)
        n = len(data) - 32
        pos = np.array(sorted(rng.sample(range(n), rng.randint(1, n))))
        order = suffixes.two_stage(data, pos, 24)
        keys = [data[i : i + 24] for i in order]
        assert sorted(order) == pos.tolist() and keys == sorted(keys)
        lcp = suffixes.common_prefixes(data, np.array(order), 24)
        assert all(keys[i][:v] == keys[i - 1][:v] and (v == 24 or keys[i][: v + 8] != keys[i - 1][: v + 8]) for i, v in enumerate(lcp.tolist()) if i)


def test_suffixes_query(spark, sf_dir, docs):
    rows = {r["doc_id"]: tuple(r)[1:5] for r in queries.queries()["op7_suffixes"](spark, sf_dir).collect()}
    ids = sorted(docs)
    assert [rows[i] for i in ids] == brute_removal([docs[i].encode() for i in ids], 400)


# --- 8 ---


def test_warc_query_against_sql(spark, sf_dir, duck):
    got = {tuple(r) for r in queries.queries()["op8_warc"](spark, sf_dir).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()}
    assert got == set(duck.execute(queries.oracle_sql()["op8_warc"]).fetchall())


def test_warc_odd_rolls_and_is_deterministic(spark, tmp_path):
    rows = [(1, "http://a/ü x\n", "same", 0), (2, None, "same", 0), (3, "u", None, 0), (4, "u", "", 0), (None, "u", "same", 0), (2, None, "same", 0), (5, "u", "<p>\U0001d11e</p>" * 4000, 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, refers_to long")
    for name in ("a", "b"):
        warc.write(df, f"file://{tmp_path}/{name}", roll_bytes=200)
    files = {n: {p.name: p.read_bytes() for p in (tmp_path / n).iterdir()} for n in "ab"}
    assert files["a"] == files["b"] and len(files["a"]) > 3 and not any("_temporary" in n for n in files["a"])
    got = sorted(((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"], r["html"]) for r in warc.read(spark, f"file://{tmp_path}/a").collect()), key=str)
    want = [(0, "revisit", 2, 4, None), (1, "revisit", 2, 4, None), (2, "response", None, 4, "same"), (2, "response", None, 4, "same"), (3, "revisit", 4, 0, None), (4, "response", None, 0, ""), (5, "response", None, 44000, rows[6][2])]
    assert got == sorted(want, key=str)
    warc.write(df.limit(0), f"file://{tmp_path}/c")
    assert warc.read(spark, f"file://{tmp_path}/c").count() == 0
    warc.write(df, f"file://{tmp_path}/d", least_bytes=5)
    assert {r["record_type"] for r in warc.read(spark, f"file://{tmp_path}/d").collect()} == {"response"}


def test_warc_same_bytes_however_dealt(spark, sf_dir, tmp_path):
    """Many rows a shard, a page that a third of the rows share, other partitions and another order: the same archive."""
    pages = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/pages.parquet").select("page_id", "url", "html")
    hot = F.when(F.col("page_id") % 3 == 0, 7).otherwise(F.col("page_id")).alias("page_id")
    df = pages.union(pages.select(hot, "url", "html")).union(pages.limit(40))
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    for name, n in (("a", 3), ("b", 7)):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        warc.write(df.orderBy(F.xxhash64("url", F.lit(n))).repartition(n), f"file://{tmp_path}/{name}", roll_bytes=60_000, shard_bytes=300_000)
    spark.conf.set("spark.sql.shuffle.partitions", kept)
    a, b = ({x.name: x.read_bytes() for x in (tmp_path / n).iterdir()} for n in "ab")
    assert a == b and len({x[:10] for x in a}) > 4 and len(a) > 8
    entries = json.loads(a["MANIFEST.json"])["files"]
    assert sum(e["records"] for e in entries) == df.count() and max(e["records"] for e in entries) > 50
    pages_in = [[int(re.search(rb"X-Page: (-?\d+)", x)[1]) for x in warc.records(iter([a[e["file"]]]))] for e in entries]
    flat = [x for part in pages_in for x in part]
    assert flat == sorted(flat)


def test_warc_schemes():
    assert store_of("/some/where")[1] == store_of("file:///some/where")[1] == "/some/where"
    assert store_of("dbfs:/x/y")[1] == "/dbfs/x/y"


# --- 9 ---


def slow_alignment(a, b):
    h, top = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            top = max(top, h[i][j])
    return top


def test_alignment():
    rng = random.Random(1)
    for _ in range(150):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 30))] for _ in range(2))
        assert decontaminate.align(np.array(a, np.uint64), np.array(b, np.uint64))[0] == slow_alignment(a, b)


def test_decontamination_query(spark, sf_dir, docs):
    """All pairs by full alignment of the words."""
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    got = {(r["doc_id"], r["item_id"]) for r in queries.queries()["op9_decontaminate"](spark, sf_dir).collect()}
    norm = lambda t: re.findall(r"[^\W_]+", t.lower())
    assert got >= {(d, i) for d, t in docs.items() for i, b in items.items() if f" {' '.join(norm(b))} " in f" {' '.join(norm(t))} "}
    for d, i in got:
        w, b = norm(docs[d]), norm(items[i])
        assert slow_alignment(w, b) >= min(0.8 * len(b), 80)


def test_decontamination_edited_copies(spark):
    rng = random.Random(2)
    vocabulary = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(3000)]
    text = lambda n: rng.choices(vocabulary, k=n)
    items = [text(rng.randint(20, 60)) for _ in range(8)] + [["only", "three", "words"], []]
    docs, leaked = [], set()
    for d in range(80):
        w = text(rng.randint(0, 200))
        if d % 2:
            i = rng.randrange(8)
            copy = [x if rng.random() > 0.12 else rng.choice(vocabulary) for x in items[i] if rng.random() > 0.04]
            w[len(w) // 2 : len(w) // 2] = copy
            leaked.add((d, i))
        docs.append((d, " ".join(w).title() + "."))
    docs += [(80, "well, only three words!"), (81, "only three other words"), (82, None), (83, ""), (None, " ".join(items[0])), (80, "only three words")]
    leaked |= {(80, 8), (None, 0)}
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(10, None)], "item_id long, text string")
    for block_chars in (decontaminate.BLOCK_CHARS, 300):  # more blocks of items, the same result
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(df, bench, block_chars=block_chars).collect()}
        assert got == leaked
    kept = decontaminate.clean(df, bench)
    assert kept.columns == df.columns and kept.count() == len(docs) - len(leaked) - 1
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0 and decontaminate.clean(df.limit(0), bench).count() == 0


# --- 10 ---

PAGE = """<html><head><title>x</title></head><body class="home"><header class="site-header"><h1>Site</h1><a href=#>Home</a></header><div id="cookie-notice">We use cookies to do things. Accept them all now please.</div>
<nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav><main><article><header><h1>Title here</h1></header><p>First para with <b>bold</b>text &amp; more.<p>Second para, it is long enough to be content for sure.
<div class="ad">Buy this product now. It is great.</div><ul><li>item one<li>item two</ul><p>See <a href=x>this link</a></p><script>var p = "<p>no</p>";</script></article></main><aside class=sidebar><h2>Related</h2><p>Another long story that is told here in many words.</p></aside>
<section id="comments"><h2>Comments</h2><article class="comment"><p>I really liked this article, thank you so much for it.</p></article></section><form><label>Name</label><input name=q><p>Subscribe to our list today.</p></form><footer>&copy; 2024 Site</footer></body></html>"""


def test_html_main_text():
    assert html.main_text(PAGE).split("\n") == ["Title here", "First para with boldtext & more.", "Second para, it is long enough to be content for sure.", "item one", "item two", "See this link"]
    assert html.main_text(None) == html.main_text("") == html.main_text("<p") == ""


def test_html_cut_is_minimal():
    rng = random.Random(2)
    for _ in range(150):
        n = rng.randint(1, 9)
        s = [rng.uniform(-2, 2) for _ in range(n)]
        e = [(i, j, rng.uniform(0, 1)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]
        cost = lambda x, s=s, e=e: sum(v if v > 0 and not k else -v if v < 0 and k else 0 for v, k in zip(s, x, strict=True)) + sum(w for i, j, w in e if x[i] != x[j])
        assert cost(html.min_cut(s, e)) <= min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n)) + 1e-6


def test_html_query(spark, sf_dir):
    import html as entities

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.queries()["op10_html"](spark, sf_dir).collect():
        a = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]], re.S)
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>?", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", a[1])] if a else []
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])
    df = spark.createDataFrame([(1, None, None, 1), (None, "u", "", 2), (1, "u", PAGE, 3), (1, "u", PAGE, 3)], "page_id long, url string, html string, text int")
    assert [r["text"] == "" for r in html.extracted(df).collect()] == [True, True, False, False]
    for bad in ('<a "' * 20_000, '<a x="' * 20_000, "<" * 50_000, "<div>" * 20_000, "<p>x" * 20_000, "<!--" * 20_000):
        html.main_text(bad)  # in time about proportional to the page


# --- the pipeline ---


def brute_similar(texts):
    """Least id of each component of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more."""
    low = {i: WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")) for i, t in texts.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in low.items()}
    root = {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(texts), 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {i: top(i) for i in texts}


def test_pipeline(spark, sf_dir, docs):
    import corpus_pipeline as C

    assert [len(s) for s in C.STAGES] == [2] * 5 and C.ORACLE_SQL is None
    out = C.run(spark, sf_dir).collect()
    ids = sorted(docs)
    group = brute_similar({i: docs[i] for i in ids})
    leaks = {r["doc_id"] for r in queries.queries()["op9_decontaminate"](spark, sf_dir).collect()}
    kept = {r["doc_id"] for r in out}
    assert kept == {i for i in ids if group[i] == i and i not in leaks}  # every text here has a language
    assert not any(brute_spans(r["text"]) for r in out) and all(r["lossless"] and r["n_chars"] == len(r["text"]) for r in out)


def test_stages_keep_columns(spark, sf_dir):
    import corpus_pipeline as C

    now = odd_docs(spark)
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, now, sf_dir)
        assert out.columns == now.columns, name
        now = spark.createDataFrame(out.collect(), out.schema)
    assert C.STAGES[-1][1](spark, now, sf_dir).where("NOT lossless").count() <= 1
    empty = odd_docs(spark).limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_pieces_forgotten_words():
    """Samples don't depend on which words the table holds, nor on the texts beside them."""
    from geoloom.llm.pieces import Model, sampled

    texts = [" ".join(f"word{(7 * i + j) % 90}x{j % 11} the" for j in range(40)) for i in range(30)]
    keys = [str(i) for i in range(30)]
    small, large = Model(most_words=60), Model()
    at_once = sampled(large, texts, keys)
    for t, k, (own, drawn) in zip(texts, keys, at_once, strict=True):
        own_again, drawn_again = sampled(small, [t], [k])[0]
        assert own.tolist() == own_again.tolist()
        assert [(i.tolist(), p, g, q) for i, p, g, q in drawn] == [(i.tolist(), p, g, q) for i, p, g, q in drawn_again]
    assert len(small.table) < len(large.table)
