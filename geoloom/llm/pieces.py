"""SentencePiece encoding and decoding, and sampled segmentations (operator 2).

Texts are encoded with a given SentencePiece model and decoded again.  Besides
the model's own segmentation, ``samples`` distinct segmentations are drawn without
replacement from all segmentations of the text, a piece sequence having a
probability in proportion to the product of its pieces' weights (Zipf weights by
the piece's rank, to the power ``theta``).

Sampling is a perturbed A-star search.  A region is a set of segmentations that
share a prefix and deviate from others next; its bound is the Gumbel maximum of
its segmentations, drawn without listing them from the region's probability.
The best region is taken, its best segmentation drawn, and the rest of it split
by where it deviates, with Gumbel values truncated at the bound.  So the
segmentations come in the order of their perturbed log probabilities, which is
sampling without replacement.  The next region's bound is the threshold kappa; a
segmentation's inclusion score is 1 - exp(-exp(log p - kappa)).

The lattice of a text falls apart at word borders, as no piece reaches across
them; the lattices of words are made in numpy for all new words of a batch and
kept in a bounded table.  All random numbers are hashes of the row's key, the
sample and the place in the text: the same for any partitioning and order.

Defined results: a null or empty text has no piece, and its one segmentation has
inclusion score 1; if a text has fewer segmentations than asked for, all come,
with score 1; rows with the same key and text get the same samples; of regions
with equal bounds that of the later path is taken; a null key counts as the text
''; very long texts and words are treated whole; extra columns pass through, but
for those with the names of results, which are replaced; an empty table gives an
empty table.  A text that holds U+2581 decodes with spaces instead (``lossless``
is false), as the model can't tell them apart.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from .common import slices, small_batches

#: Where the model lies on every executor; each function takes another path, or the name of a file shipped with ``spark.files``.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES, THETA = 2, 1.0
#: Words that a worker's table holds, about a kilobyte each: more where the operator has its executors to itself, fewer after a pipeline's other stages.
WORDS, WORDS_STAGE = 300_000, 100_000
SPACE = "▁"
_MULT = 0x9E3779B97F4A7C15
_INV = pow(_MULT, -1, 1 << 64)
_BYTE = 1 << 24  # edge ids from here on: a character written as its bytes


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = x + np.uint64(_MULT)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(seed: np.ndarray, sample: int, place: np.ndarray) -> np.ndarray:
    """Numbers above 0 and below 1 from (row seed, sample, place)."""
    return unit(mix(seed + np.uint64(sample)), place)


def unit(of_row: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The same, from the mixed row seed and sample."""
    h = mix(of_row ^ place.astype(np.uint64))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Places begin, begin + 1, ... of each range, one range after the other."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


class Grown:
    """An array that is added to at its end."""

    def __init__(self, kind) -> None:
        self.data, self.n = np.empty(1 << 12, kind), 0

    def add(self, x: np.ndarray) -> None:
        if self.n + len(x) > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.empty(max(len(x), self.n) + 1024, self.data.dtype)])
        self.data[self.n : self.n + len(x)] = x
        self.n += len(x)

    def __array__(self, dtype=None, copy=None):
        return self.view

    @property
    def view(self) -> np.ndarray:
        return self.data[: self.n]


class Numbers(dict):
    """Numbers of words: a word that is not there yet gets the next one; ``new``: such words since they were last taken."""

    def __init__(self, words: Iterable[str] = ()) -> None:
        super().__init__(zip(words, count()))
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Model:
    """A SentencePiece model with the lattices of the words met so far."""

    def __init__(self, path: str = MODEL, theta: float = THETA, most_words: int = WORDS) -> None:
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.theta, self.most_words = theta, most_words
        sp = self.sp
        self.bytes = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        pieces = [(sp.id_to_piece(i), i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        across = [p for p, _ in pieces if (SPACE in p.lstrip(SPACE)) or "\n" in p]
        if across:
            raise ValueError(f"pieces reach across words: {across[:3]}")
        self.longest = max(len(p) for p, _ in pieces)
        codes = np.array([self._hash(p) for p, _ in pieces], np.uint64)
        order = np.argsort(codes)
        self.codes, self.ids = codes[order], np.array([i for _, i in pieces], np.int32)[order]
        # by 22 bits of a code: 1, if a piece has them, 2, if one may begin a longer piece, and 4, if several pieces have them; and the place of the last such piece
        self.kind, self.slot = np.zeros(1 << 22, np.uint8), np.zeros(1 << 22, np.int32)
        self.slot[self._leading(self.codes)] = np.arange(len(self.codes))
        taken, n = np.unique(self._leading(self.codes), return_counts=True)
        self.kind[taken] = 1 + 4 * (n > 1)
        heads = {p[:k] for p, _ in pieces for k in range(1, len(p))}
        self.kind[self._leading(np.array([self._hash(p) for p in heads], np.uint64))] |= 2
        self.lead = sp.piece_to_id(SPACE)
        line = sp.encode("\n")
        self.line = line[1] if len(line) == 2 and line[0] == self.lead else -1
        self.weight = -theta * np.log(np.arange(sp.get_piece_size()) + 10.0)
        self.size = sp.get_piece_size()
        self._reset()

    @staticmethod
    def _leading(codes: np.ndarray) -> np.ndarray:
        """22 bits by which a code is looked up."""
        return ((codes * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(42)).view(np.int64)

    @staticmethod
    def _hash(p: str) -> int:
        h, f = 0, 1
        for c in p:
            h = (h + (ord(c) + 1) * f) & 0xFFFFFFFFFFFFFFFF
            f = f * _MULT & 0xFFFFFFFFFFFFFFFF
        return h

    def _reset(self) -> None:
        """Forgets all words, so that a worker that goes on to other work holds nothing."""
        self.table = Numbers()
        self.met = Grown(np.int64)  # by word: how often, halved with each forgetting
        self.first, self.chars = Grown(np.int64), Grown(np.int64)  # by word: first node, characters
        self.own_at, self.own_n, self.own = Grown(np.int64), Grown(np.int64), Grown(np.int32)  # by word: the model's pieces
        self.edge_at = Grown(np.int64)  # by node: its first edge
        self.cum, self.len, self.id, self.logq = Grown(np.float32), Grown(np.int16), Grown(np.int32), Grown(np.float64)  # by edge
        self.nodes = 0

    def _forget(self) -> None:
        """Keeps the third of the table that is met most often."""
        keep = np.sort(np.argsort(-self.met.view, kind="stable")[: self.most_words // 3])
        words, chars, own_n = list(self.table), self.chars.view[keep], self.own_n.view[keep]
        self.table = Numbers(words[i] for i in keep.tolist())
        nodes, own = ranges(self.first.view[keep], chars), ranges(self.own_at.view[keep], own_n)
        begin = self.edge_at.view[nodes]
        count = np.append(self.edge_at.view[1:], self.id.n)[nodes] - begin
        edges = ranges(begin, count)
        self.nodes = len(nodes)
        for to, x in (
            (self.met, self.met.view[keep] // 2), (self.first, np.cumsum(chars) - chars), (self.chars, chars), (self.own_at, np.cumsum(own_n) - own_n), (self.own_n, own_n), (self.own, self.own.view[own]),
            (self.edge_at, np.cumsum(count) - count), (self.cum, self.cum.view[edges]), (self.len, self.len.view[edges]), (self.id, self.id.view[edges]), (self.logq, self.logq.view[edges]),
        ):
            to.n = 0
            to.add(x)

    def words_of(self, text: str) -> list[str]:
        """Keys of the words of a text: a word stands for itself after a space; others begin with \\x01 (after a line feed) or \\x02 (as it is)."""
        if not text:
            return []
        if SPACE in text or "\x01" in text or "\x02" in text:
            out, t = [], SPACE + text.replace(" ", SPACE)
            i, n = 0, len(t)
            while i < n:  # a run of spaces and what follows, or a line feed and what follows
                j = i + 1
                if t[i] == SPACE:
                    while j < n and t[j] == SPACE:
                        j += 1
                while j < n and t[j] != SPACE and t[j] != "\n":
                    j += 1
                out.append("\x02" + t[i:j])
                i = j
            return out
        words = text.replace("\n", " \x01").split(" ") if "\n" in text else text.split(" ")
        if "" not in words:
            return words
        out, k = [], 0
        for w in words:
            if not w:
                k += 1
            elif not k:
                out.append(w)
            elif w[0] == "\x01":
                out += ["\x02" + SPACE * k, w]
                k = 0
            else:
                out.append("\x02" + SPACE * (k + 1) + w)
                k = 0
        if k:
            out.append("\x02" + SPACE * k)
        return out

    @staticmethod
    def spelled(word: str) -> str:
        return "\n" + word[1:] if word[0] == "\x01" else word[1:] if word[0] == "\x02" else SPACE + word

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts, and where each text's words begin (one more than texts)."""
        lists = [self.words_of(t) for t in texts]
        if len(self.table) > self.most_words:
            self._forget()
        flat = list(chain.from_iterable(lists))
        try:
            found = np.fromiter(map(self.table.__getitem__, flat), np.int64, len(flat))
            self._learn(self.table.new)
        except BaseException:
            self._reset()  # numbers without lattices
            raise
        self.table.new = []
        self.met.view[:] += np.bincount(found, minlength=self.met.n)
        return found, np.cumsum([0] + [len(ws) for ws in lists])

    def _learn(self, words: list[str]) -> None:
        for i in range(0, len(words), 1 << 12):
            self._lattices(words[i : i + (1 << 12)])

    def _own(self, spelled: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The model's pieces of all words, and how many each has: encoded as lines, 64 a text, as no piece reaches across lines."""
        whole = np.fromiter((s[0] == "\n" for s in spelled), bool, len(spelled))  # line feeds are at words' beginnings only, and here the lines' own
        lines = [s if w else "\n" + s for s, w in zip(spelled, whole.tolist(), strict=True)]
        texts = ["".join(lines[i : i + 64]).replace(SPACE, " ") for i in range(0, len(lines), 64)]
        out = self.sp.encode(texts, num_threads=1)
        ids = np.fromiter(chain.from_iterable(out), np.int32, sum(map(len, out)))
        at = np.flatnonzero(ids == self.line)
        if self.line < 0 or len(at) != len(spelled) or any(x[:2] != [self.lead, self.line] for x in out):
            return self._own_apart(spelled)
        keep = np.ones(len(ids), bool)
        keep[at[::64] - 1] = False  # the space that the model puts before a text
        keep[at[~whole]] = False
        return ids[keep], np.add.reduceat(keep, at, dtype=np.int64)

    def _own_apart(self, spelled: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same, word by word: spaces at a word's beginning are spaces to the model, the first of which it adds itself."""
        plain = [s[1:].replace(SPACE, " ") if s[0] == SPACE else s.replace(SPACE, " ") for s in spelled]
        out = self.sp.encode(plain, num_threads=1)
        for i, s in enumerate(spelled):
            if s[0] != SPACE:
                out[i] = out[i][1:]
            elif not out[i]:
                out[i] = [self.lead]
        counts = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(chain.from_iterable(out), np.int32, int(counts.sum())), counts

    def _lattices(self, words: list[str]) -> None:
        spelled = [self.spelled(w) for w in words]
        own, counts = self._own(spelled)
        self.own_at.add(self.own.n + np.cumsum(counts) - counts)
        self.own_n.add(counts)
        self.own.add(own)
        n = np.fromiter(map(len, spelled), np.int64, len(spelled))
        x = np.frombuffer("".join(spelled).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        total, left = len(x), np.repeat(np.cumsum(n), n) - np.arange(len(x))  # characters to the word's end
        f = np.full(total + 1, _MULT, np.uint64)
        b = np.full(total + 1, _INV, np.uint64)
        f[0] = b[0] = 1
        f, b = np.multiply.accumulate(f), np.multiply.accumulate(b)
        h = np.concatenate([np.zeros(1, np.uint64), np.cumsum((x + np.uint64(1)) * f[:total], dtype=np.uint64)])
        most = min(self.longest, int(n.max()))
        node, size, piece = [], [], []
        single = np.zeros(total, bool)
        every = np.arange(total)
        for k in range(1, most + 1):
            i = every
            code = (h[i + k] - h[i]) * b[i]
            lead = self._leading(code)
            kind = self.kind[lead]
            every = i[(kind & 2 > 0) & (left[i] > k)]  # others begin no longer piece
            hit = np.flatnonzero(kind & 1)
            i, code, lead = i[hit], code[hit], lead[hit]
            at = self.slot[lead]
            sure = self.codes[at] == code
            apart = np.flatnonzero(~sure & (kind[hit] & 4 > 0))
            if len(apart):
                at[apart] = np.minimum(np.searchsorted(self.codes, code[apart]), len(self.codes) - 1)
                sure[apart] = self.codes[at[apart]] == code[apart]
            i, at = i[sure], at[sure]
            node.append(i)
            size.append(np.full(len(i), k, np.int16))
            piece.append(self.ids[at])
            if k == 1:
                single[i] = True
        odd = np.flatnonzero(~single)  # written as bytes
        node.append(odd)
        size.append(np.ones(len(odd), np.int16))
        c = x[odd].astype(np.int32)
        piece.append(np.where(c < 0x80, self.bytes[np.minimum(c, 0x7F)], _BYTE + c))
        # a node's edges side by side: longer pieces are likelier and come first
        edges = np.zeros(total, np.int64)
        for i in node:
            edges[i] += 1
        first = np.concatenate([np.zeros(1, np.int64), np.cumsum(edges)])
        free, sizes, parts = first[:-1].copy(), size[::-1], piece[::-1]
        size, piece = np.empty(int(first[-1]), np.int16), np.empty(int(first[-1]), np.int32)
        for i, k, x_ in zip(node[::-1], sizes, parts, strict=True):
            to = free[i]
            size[to], piece[to] = k, x_
            free[i] = to + 1
        node = np.repeat(np.arange(total), edges)
        score = self.weight[np.minimum(piece, self.size - 1)]
        big = np.flatnonzero(piece >= _BYTE)
        if len(big):
            c = piece[big] - _BYTE
            score[big] = self.weight[self.bytes[0]] * (2 + (c >= 0x800) + (c >= 0x10000))
        # probabilities from the words' ends: all places with the same distance to the end at once
        beta = np.zeros(total + 1)
        by_left = np.argsort(left, kind="stable")
        cut = np.searchsorted(left[by_left], np.arange(1, int(n.max()) + 2))
        after = node + size
        last = np.repeat(np.cumsum(n), n)[node]
        logq = np.empty(len(node))
        for r in range(int(n.max())):
            nodes = by_left[cut[r] : cut[r + 1]]
            lo = first[nodes]
            m = first[nodes + 1] - lo
            begin = np.cumsum(m) - m
            e = ranges(lo, m)
            v = score[e] + np.where(after[e] == last[e], 0.0, beta[np.minimum(after[e], total)])
            top = np.maximum.reduceat(v, begin)
            w = np.exp(v - np.repeat(top, m))
            z = top + np.log(np.add.reduceat(w, begin))
            beta[nodes] = z
            logq[e] = v - np.repeat(z, m)
        q = np.rint(np.exp(logq) * 2.0**30) * 2.0**-30  # sums are exact, and so the same beside any other words
        cum = np.cumsum(q)
        cum -= np.repeat((cum - q)[first[:total]], np.diff(first))
        cum[first[1:] - 1] = 2.0  # the last edge takes what is left
        self.first.add(self.nodes + np.cumsum(n) - n)
        self.chars.add(n)
        self.met.add(np.zeros(len(n), np.int64))
        self.edge_at.add(self.id.n + first[:total])
        self.cum.add(cum)
        self.len.add(size)
        self.id.add(piece)
        self.logq.add(np.minimum(logq, 0.0))
        self.nodes += total

    def drawn(self, words: np.ndarray, of_row: np.ndarray, place: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """One path through each word (from character ``start``): edges word after word, and how many for each; ``of_row``: the mixed row seed and sample."""
        node = self.first.view[words] + (0 if start is None else start)
        end = self.first.view[words] + self.chars.view[words]
        base = place - self.first.view[words]
        live = np.flatnonzero(node < end)
        steps, count = [], np.zeros(len(words), np.int64)
        cum, size, edge_at = self.cum.view, self.len.view, self.edge_at.view
        while len(live):
            at = node[live]
            e, u = edge_at[at], unit(of_row[live], base[live] + at)
            on = np.flatnonzero(cum[e] < u)
            while len(on):
                e[on] += 1
                on = on[cum[e[on]] < u[on]]
            steps.append((live, e))
            count[live] += 1
            node[live] = at + size[e]
            live = live[node[live] < end[live]]
        begins = np.cumsum(count) - count
        edges = np.empty(int(count.sum()), np.int64)
        for k, (who, e) in enumerate(steps):
            edges[begins[who] + k] = e
        return edges, count

    def around(self, edge: int) -> tuple[int, int, int]:
        """The node that an edge leaves, and the range of the node's edges."""
        node = int(np.searchsorted(self.edge_at.view, edge, side="right")) - 1
        return node, int(self.edge_at.view[node]), int(self.edge_at.view[node + 1]) if node + 1 < self.nodes else self.id.n

    def expand(self, edges: np.ndarray) -> np.ndarray:
        """Piece ids of a path; characters without a piece become bytes."""
        ids = self.id.view[edges]
        if len(ids) and ids.max() >= _BYTE:
            parts = [self.bytes[list(chr(i - _BYTE).encode("utf-8", "surrogatepass"))] if i >= _BYTE else [i] for i in ids.tolist()]
            return np.concatenate(parts).astype(np.int32)
        return ids


class _Path:
    """A drawn segmentation of one text: its edges and the word of each, the log probability before each, and the bounds of the regions that leave it there."""

    __slots__ = ("barred", "before", "bound", "edges", "logp", "value", "word_of")

    def __init__(self, edges: np.ndarray, word_of: np.ndarray, logq: np.ndarray, value: float) -> None:
        self.edges, self.word_of, self.value = edges, word_of, value
        total = np.cumsum(logq)
        self.logp = float(total[-1]) if len(total) else 0.0
        self.before = total - logq
        self.bound = np.full(len(edges), -np.inf)
        self.barred: dict[int, list[int]] = {}


def bounded(paths: list[_Path], logqs: list[np.ndarray], seeds: list[int], since: list[int], sample: int) -> None:
    """Draws the bounds of the regions that leave each path from edge ``since`` on, for all paths at once."""
    free = [b + np.flatnonzero(q[b:] < -1e-12) for q, b in zip(logqs, since, strict=True)]  # where there is another way
    count = [len(f) for f in free]
    if not sum(count):
        return
    place, logq = np.concatenate(free), np.concatenate([q[f] for q, f in zip(logqs, free, strict=True)])
    phi = np.concatenate([p.before[f] for p, f in zip(paths, free, strict=True)]) + np.log(-np.expm1(logq))
    value = np.repeat(np.array([p.value for p in paths]), count)
    drawn = truncated(phi, value, unit(np.repeat(mix(np.array(seeds, np.uint64) + np.uint64(1000 + sample)), count), place))
    for p, f, x in zip(paths, free, np.split(drawn, np.cumsum(count)[:-1]), strict=True):
        p.bound[f] = x


def truncated(phi: np.ndarray, most: float | np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values with location ``phi``, given that they are at most ``most``."""
    return -np.logaddexp(-most, np.log(-np.log(u)) - phi)


def sampled(model: Model, texts: list[str], keys: list[str], samples: int = SAMPLES) -> list[tuple[np.ndarray, list[tuple[np.ndarray, float, float, float]]]]:
    """For each text the model's piece ids, and its samples: (piece ids, log p, perturbed log p, inclusion score)."""
    words, begins = model.numbers(texts)
    n_own, at_own = model.own_n.view[words], model.own_at.view[words]
    own_begin = np.cumsum(n_own) - n_own
    own = model.own.view[np.repeat(at_own - own_begin, n_own) + np.arange(int(n_own.sum()))]
    own_cut = np.concatenate([own_begin, [len(own)]])[begins]
    seed = mix(np.fromiter((int.from_bytes(hashlib.blake2b(k.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for k in keys), np.uint64, len(keys)))
    per_text = np.diff(begins)
    chars = model.chars.view[words]
    place = np.cumsum(chars) - chars
    place -= np.repeat(np.concatenate([place, [0]])[begins[:-1]], per_text) if len(place) else 0
    edges, count = model.drawn(words, np.repeat(mix(seed), per_text), place)
    word_cut = np.concatenate([[0], np.cumsum(count)])
    logq = model.logq.view[edges]
    first = -np.log(-np.log(uniform(seed, 999, np.zeros(len(seed), np.int64))))
    word_of = np.repeat(np.arange(len(words)) - np.repeat(begins[:-1], per_text), count)
    paths: list[list[_Path]] = []
    for t in range(len(texts)):
        a, b = int(word_cut[begins[t]]), int(word_cut[begins[t + 1]])
        paths.append([_Path(edges[a:b], word_of[a:b], logq[a:b], float(first[t]))])
    text_cut = word_cut[begins]
    bounded([p for (p,) in paths], [logq[a:b] for a, b in zip(text_cut[:-1], text_cut[1:], strict=True)], seed.tolist(), [0] * len(texts), 0)
    for s in range(1, samples):
        jobs = []  # the best region of each text, and the edge by which the next segmentation leaves
        best = []
        for t, own_paths in enumerate(paths):
            value, k = max((float(p.bound.max(initial=-np.inf)), k) for k, p in enumerate(own_paths))
            if value > -np.inf:
                best.append((t, own_paths[k], value, int(own_paths[k].bound.argmax())))
        which, levels = np.array([t for t, *_ in best], np.int64), np.array([x[-1] for x in best], np.int64)
        by_edge, by_rest = (uniform(seed[which], base + s, levels).tolist() for base in (2000, 3000))
        for (t, p, value, level), u_edge, u_rest in zip(best, by_edge, by_rest, strict=True):
            node, lo, hi = model.around(int(p.edges[level]))
            barred = p.barred.setdefault(level, [int(p.edges[level])])
            q = np.exp(model.logq.view[lo:hi])
            q[np.array(barred) - lo] = 0.0
            c = np.cumsum(q)
            e = lo + int(np.searchsorted(c, u_edge * c[-1]))
            barred.append(e)
            mass = float(c[-1] - q[e - lo])
            # what is left of the region: leaving here by yet another edge
            p.bound[level] = -np.inf if mass < 1e-12 else float(truncated(p.before[level] + np.log(mass), value, u_rest))
            jobs.append((t, p, level, value, e, node + int(model.len.view[e]), int(p.word_of[level])))
        if not jobs:
            break
        # what follows is drawn for all texts at once
        rest = np.concatenate([np.arange(begins[t] + k, begins[t + 1]) for t, _, _, _, _, _, k in jobs])
        lead = np.cumsum([0] + [begins[t + 1] - begins[t] - k for t, _, _, _, _, _, k in jobs])
        inside = np.zeros(len(rest), np.int64)
        inside[lead[:-1]] = np.array([node for *_, node, _ in jobs]) - model.first.view[words[rest[lead[:-1]]]]
        tail, tail_count = model.drawn(words[rest], np.repeat(mix(seed + np.uint64(s)), per_text)[rest], place[rest], inside)
        ends = np.concatenate([[0], np.cumsum(tail_count)])[lead]
        made, logqs = [], []
        for j, (t, p, level, value, e, _, k) in enumerate(jobs):
            n = tail_count[lead[j] : lead[j + 1]]
            path = np.concatenate([p.edges[:level], [e], tail[ends[j] : ends[j + 1]]]).astype(np.int64)
            at = np.concatenate([p.word_of[:level], [k], np.repeat(k + np.arange(len(n)), n)])
            logqs.append(model.logq.view[path])
            made.append(_Path(path, at, logqs[-1], value))
            paths[t].append(made[-1])
        bounded(made, logqs, [int(seed[t]) for t, *_ in jobs], [level + 1 for _, _, level, *_ in jobs], s)
    out = []
    for t, own_paths in enumerate(paths):
        kappa = max(p.bound.max(initial=-np.inf) for p in own_paths)
        drawn = [(model.expand(p.edges), p.logp, p.value, 1.0 if kappa == -np.inf else float(-np.expm1(-np.exp(min(700.0, p.logp - kappa))))) for p in own_paths]
        out.append((own[own_cut[t] : own_cut[t + 1]], drawn))
    return out


def decode(model: Model, ids: list[list[int]]) -> list[str]:
    return model.sp.decode(ids, num_threads=1)


_models: dict[tuple[str, float, int], Model] = {}


def model_of(path: str = MODEL, theta: float = THETA, words: int = WORDS) -> Model:
    """One model for each worker process."""
    if (path, theta, words) not in _models:
        _models[path, theta, words] = Model(path if os.path.isabs(path) else SparkFiles.get(path), theta, words)
    return _models[path, theta, words]


def _digest(ids: np.ndarray) -> str:
    return hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest()


SAMPLE = "n_pieces: bigint, ids_sha256: string, log_prob: double, perturbed: double, inclusion: double"


def _runs(batch: pa.RecordBatch, key: str, text: str, path: str, samples: int, theta: float, most: int = 1 << 18, words: int = WORDS):
    """Texts of a batch in runs of bounded size, with their pieces and samples."""
    model = model_of(path, theta, words)
    texts = [x or "" for x in batch.column(text).to_pylist()]
    keys = ["" if k is None else str(k) for k in batch.column(key).to_pylist()]
    for a, b in slices(texts, most):
        yield model, texts[a:b], sampled(model, texts[a:b], keys[a:b], samples)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    cut = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int32), *parts]), pa.int32()))


def _drawn(made: list[list[tuple]], first: dict[str, pa.Array]) -> pa.ListArray:
    """Samples of each text; ``first``: what stands for their ids."""
    flat = [x for more in made for x in more]
    numbers = {n: pa.array([x[k] for x in flat], pa.float64()) for k, n in ((1, "log_prob"), (2, "perturbed"), (3, "inclusion"))}
    both = first | numbers
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, made)]), pa.int32()), pa.StructArray.from_arrays(list(both.values()), list(both)))


def _kept_schema(docs: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)


def encoded(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = MODEL, samples: int = SAMPLES, theta: float = THETA, words: int = WORDS_STAGE) -> DataFrame:
    """``docs`` with ``pieces`` (ids), ``lossless`` and ``sampled`` (ids, log_prob, perturbed, inclusion), in place of columns of those names."""
    small_batches(docs.sparkSession, 256)
    docs = docs.drop("pieces", "lossless", "sampled")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces, lossless, drawn = [], [], []
            for model, texts, made in _runs(batch, key, text, path, samples, theta, words=words):
                pieces += [own for own, _ in made]
                lossless += [x == y for x, y in zip(decode(model, [own.tolist() for own, _ in made]), texts, strict=True)]
                drawn += [more for _, more in made]
            made = [_lists(pieces), pa.array(lossless, pa.bool_()), _drawn(drawn, {"ids": _lists([x[0] for more in drawn for x in more])})]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "pieces", "lossless", "sampled"])
        model_of(path, theta, words)._reset()

    more = "pieces array<int>, lossless boolean, sampled array<struct<ids: array<int>, log_prob: double, perturbed: double, inclusion: double>>"
    return docs.mapInArrow(run, f"{_kept_schema(docs)}, {more}")


def encoded_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = MODEL, samples: int = SAMPLES, theta: float = THETA) -> DataFrame:
    """Rows (key, n_pieces, ids_sha256, lossless, samples): as ``encoded``, with digests in place of ids."""
    small_batches(docs.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, lossless, drawn, sizes, names = [], [], [], [], [], []
            for model, texts, made in _runs(batch, key, text, path, samples, theta, 1 << 19):
                lossless += [x == y for x, y in zip(decode(model, [own.tolist() for own, _ in made]), texts, strict=True)]
                n += [len(own) for own, _ in made]
                digests += [_digest(own) for own, _ in made]
                drawn += [[(None, *x[1:]) for x in more] for _, more in made]
                sizes += [len(x[0]) for _, more in made for x in more]
                names += [_digest(x[0]) for _, more in made for x in more]
            samples_ = _drawn(drawn, {"n_pieces": pa.array(sizes, pa.int64()), "ids_sha256": pa.array(names, pa.string())})
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(lossless, pa.bool_()), samples_], [key, "n_pieces", "ids_sha256", "lossless", "samples"])
        model_of(path, theta)._reset()

    docs = docs.select(key, text)
    return docs.mapInArrow(run, f"`{key}` {dict(docs.dtypes)[key]}, n_pieces long, ids_sha256 string, lossless boolean, samples array<struct<{SAMPLE}>>")


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the documents with their pieces and sampled segmentations."""
    return encoded(docs)
