"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Each step of the network is a word. Its input joins what a hashed word table and a table of hashed
character n-grams (bytes, with word boundaries; the mean over the word) say of it, so that unseen
word forms share what their characters have in common. The tables hold smoothed log-odds of the
labels. They are cross-fitted: while the network trains on a document, it sees tables made without
that document's fold, or it would learn to trust words that only that document has. Gates are hard
sigmoids, candidate states softsigns: both are cheap where a hundred million steps are taken. A text
is cut into overlapping windows that cover all of it; its score is that of its most toxic window.

Training is multiple-instance: in each epoch a document's currently most toxic window stands for
it. The sample is bounded by ``max_docs`` documents, ``max_windows`` of each and ``window_bytes``
of each window; the rest is untouched by the input's size.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.llm.common import held_out, slices, small_batches

_TRIM = ".,;:!?\"'()[]{}<>*#$%&|/\\-_=+~`^@"
_GRAMS = (4, 8)
_SLICE_WORDS = 100_000
_LANES = 1024
_WORDS_AT_ONCE = 1 << 15


@dataclass(frozen=True)
class Shape:
    window: int = 64
    stride: int = 48
    hidden: int = 12
    attention: int = 8
    word_rows: int = 1 << 18
    gram_rows: int = 1 << 17
    width: int = 1


@dataclass
class Words:
    """Distinct words of some texts, their n-gram rows, and each text's run of word indices."""

    index: np.ndarray  # int32, word of each position, text after text
    counts: np.ndarray  # words of each text
    rows: np.ndarray  # word row of each distinct word
    grams: np.ndarray  # gram rows, word after word
    first: np.ndarray  # where the grams of each distinct word begin
    per_word: np.ndarray  # number of grams of each

    def spots(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the grams of the words in own are, how many each has, and where each one's begin in that list."""
        sizes = self.per_word[own]
        first = np.cumsum(sizes) - sizes
        return np.repeat(self.first[own] - first, sizes) + np.arange(sizes.sum()), sizes, first

    def only(self, begin: np.ndarray, length: np.ndarray) -> tuple["Index", np.ndarray]:
        """The words of some windows, numbered anew, and which they are."""
        hit = np.zeros(len(self.index) + 1, np.int32)
        np.add.at(hit, begin, 1)
        np.add.at(hit, begin + length, -1)
        inside = np.cumsum(hit[:-1]) > 0
        seen = np.zeros(len(self.rows), bool)
        seen[self.index[inside]] = True
        number = np.cumsum(seen) - 1
        return Index(number.astype(np.int32)[self.index], int(seen.sum())), np.flatnonzero(seen)


@dataclass
class Index:
    words: np.ndarray  # word number of each position
    size: int


def split_words(texts: list[str | None], shape: Shape) -> Words:
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pa.array([t or "" for t in texts], pa.large_string())))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(lists)
    empty = pc.equal(pc.binary_length(flat), 0)
    if pc.any(empty).as_py():  # blanks at either end of a text give empty words
        owner = np.repeat(np.arange(len(counts)), counts)
        keep = ~empty.to_numpy(zero_copy_only=False)
        counts = np.bincount(owner[keep], minlength=len(counts))
        flat = flat.filter(pa.array(keep))
    coded = flat.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    words = pc.utf8_trim(coded.dictionary, characters=_TRIM)
    marked = pc.binary_join_element_wise(pa.scalar("\x02", pa.large_string()), words, pa.scalar("\x03", pa.large_string()), pa.scalar("", pa.large_string()))
    marked = marked.combine_chunks() if isinstance(marked, pa.ChunkedArray) else marked
    n = len(marked)
    if not n:
        z = np.zeros(0, np.int64)
        return Words(index, counts, z, z, z, z)
    offsets = np.frombuffer(marked.buffers()[1], np.int64)[marked.offset : marked.offset + n + 1]
    data = np.frombuffer(marked.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64) + np.uint64(1)
    offsets = offsets - offsets[0]
    sizes = np.diff(offsets)
    within = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    powers = np.cumprod(np.full(int(sizes.max()), 0x100000001B3, np.uint64), dtype=np.uint64)
    rows = _mix(np.add.reduceat(data * powers[within], offsets[:-1])) % np.uint64(shape.word_rows)
    left = np.repeat(sizes, sizes) - within
    at, owner = [], []
    whose = np.repeat(np.arange(n), sizes)
    for g in _GRAMS:
        begin = np.flatnonzero(left >= g) if g != _GRAMS[0] else np.flatnonzero((left >= g) | ((within == 0) & (sizes[whose] < g)))
        h = np.full(len(begin), g, np.uint64)
        for k in range(g):
            h = h * np.uint64(0x100000001B3) + data[np.minimum(begin + k, len(data) - 1)]
        at.append((_mix(h) % np.uint64(shape.gram_rows)).astype(np.int32))
        owner.append(whose[begin].astype(np.int32))
    owner, at = np.concatenate(owner), np.concatenate(at)
    order = np.argsort(owner, kind="stable")
    per_word = np.bincount(owner, minlength=n)
    return Words(index, counts, rows.astype(np.int32), at[order], np.cumsum(per_word) - per_word, per_word)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def window_starts(counts: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first position, length) of all windows: every word of every text lies in one at least."""
    per = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - shape.window) // shape.stride)), 0)
    text = np.repeat(np.arange(len(counts)), per)
    step = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    begin = np.cumsum(counts) - counts
    return text, begin[text] + step * shape.stride, np.minimum(shape.window, counts[text] - step * shape.stride)


def _gate(x: np.ndarray) -> np.ndarray:
    return np.clip(0.25 * x + 0.5, 0, 1)


class Network:
    def __init__(self, shape: Shape, seed: int = 7):
        r, s = np.random.default_rng(seed), shape
        normal = lambda scale, *size: r.normal(0, scale, size).astype(np.float32)
        h, d = s.hidden, 2 * s.width
        self.shape = s
        self.p = {
            "word": np.zeros((s.word_rows, s.width), np.float32), "gram": np.zeros((s.gram_rows, s.width), np.float32),
            "wf": normal(0.4, d, 3 * h), "uf": normal(0.2, h, 3 * h), "bf": np.zeros(3 * h, np.float32),
            "wb": normal(0.4, d, 3 * h), "ub": normal(0.2, h, 3 * h), "bb": np.zeros(3 * h, np.float32),
            "wa": normal(0.3, 2 * h, s.attention), "va": normal(0.5, s.attention),
            "wo": normal(0.5, 2 * h), "bo": np.zeros(1, np.float32),
        }
        self.scale, self.shift = 1.0, 0.0

    # forward

    def inputs(self, w: Words, own: np.ndarray) -> np.ndarray:
        """What the tables hold of the distinct words in own, and of their n-grams on average."""
        x = np.empty((len(own), 2 * self.shape.width), np.float32)
        for at in range(0, len(own), _WORDS_AT_ONCE):
            part = own[at : at + _WORDS_AT_ONCE]
            spots, sizes, first = w.spots(part)
            x[at : at + len(part), : self.shape.width] = self.p["word"][w.rows[part]]
            x[at : at + len(part), self.shape.width :] = np.add.reduceat(self.p["gram"][w.grams[spots]], first, axis=0) / sizes[:, None]
        return x

    def project(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pad = np.zeros((1, 3 * self.shape.hidden), np.float32)
        return tuple(np.concatenate([x @ self.p["w" + k] + self.p["b" + k], pad]) for k in "fb")

    def _run(self, proj: np.ndarray, ids: np.ndarray, mask: np.ndarray, which: str, keep: list | None) -> np.ndarray:
        """ids, mask: (steps, lanes). States of all steps, in the order of the text."""
        steps, lanes = ids.shape
        n, u = self.shape.hidden, self.p["u" + which]
        uzr, uc = np.ascontiguousarray(u[:, : 2 * n]), np.ascontiguousarray(u[:, 2 * n :])
        h = np.zeros((lanes, n), np.float32)
        out = np.empty((steps, lanes, n), np.float32)
        for t in range(steps) if which == "f" else range(steps - 1, -1, -1):
            g = proj[ids[t]]
            zr = h @ uzr
            zr += g[:, : 2 * n]
            zr *= 0.25
            zr += 0.5
            np.clip(zr, 0, 1, out=zr)
            z, r = zr[:, :n], zr[:, n:]
            a = (r * h) @ uc
            a += g[:, 2 * n :]
            c = a / (1 + np.abs(a))
            new = h + z * (c - h)
            if which == "b" and mask is not None:
                new *= mask[t][:, None]
            if keep is not None:
                keep.append((t, h, zr, a, c))
            out[t] = h = new
        return out

    def forward(self, projected, ids: np.ndarray, mask: np.ndarray, cache: dict | None = None) -> np.ndarray:
        """Logit of each lane."""
        kf, kb = ([], []) if cache is not None else (None, None)
        full = bool(mask.all())
        states = np.concatenate(
            [self._run(projected[0], ids, None, "f", kf), self._run(projected[1], ids, None if full else mask, "b", kb)], axis=2
        )
        pre = states @ self.p["wa"]
        act = pre / (1 + np.abs(pre))
        e = act @ self.p["va"]
        if not full:
            e = np.where(mask > 0, e, np.float32(-1e9))
        e = np.exp(e - e.max(axis=0))
        att = e / e.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", att, states)
        if cache is not None:
            cache.update(kf=kf, kb=kb, states=states, pre=pre, act=act, att=att, pooled=pooled, ids=ids, mask=mask)
        return pooled @ self.p["wo"] + self.p["bo"][0]

    def lanes(self, index: "Index", begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers, the one past the last where a window has ended, and the mask: (steps, lanes)."""
        steps = np.arange(int(length.max()))[:, None]
        mask = steps < length
        at = np.minimum(begin + steps, len(index.words) - 1)
        return np.where(mask, index.words[at], index.size), mask.astype(np.float32)

    def window_logits(self, w: Words, begin: np.ndarray, length: np.ndarray, inputs: np.ndarray | None = None) -> np.ndarray:
        """Logit of each window. inputs: those of all distinct words, where the tables are not to be asked."""
        out = np.empty(len(begin), np.float32)
        order = np.argsort(-length, kind="stable")
        for at in range(0, len(order), _LANES * 8):
            group = order[at : at + _LANES * 8]
            sub, used = w.only(begin[group], length[group])
            projected = self.project(self.inputs(w, used) if inputs is None else inputs[used])
            for k in range(0, len(group), _LANES):
                own = group[k : k + _LANES]
                out[own] = self.forward(projected, *self.lanes(sub, begin[own], length[own]))
        return out

    # backward

    def _run_back(self, d_out: np.ndarray, keep: list, u_name: str, mask: np.ndarray, grads: dict) -> np.ndarray:
        n, u = self.shape.hidden, self.p["u" + u_name]
        steps, lanes, _ = d_out.shape
        d_proj = np.zeros((steps, lanes, 3 * n), np.float32)
        d_u, d_h = np.zeros_like(u), np.zeros((lanes, n), np.float32)
        for t, h, zr, a, c in reversed(keep):
            d_new = d_out[t] + d_h
            if u_name == "b":
                d_new = d_new * mask[t][:, None]
            z, r = zr[:, :n], zr[:, n:]
            d_c = d_new * z
            d_a = d_c / (1 + np.abs(a)) ** 2
            d_rh = d_a @ u[:, 2 * n :].T
            d_zr = np.concatenate([d_new * (c - h), d_rh * h], axis=1) * (0.25 * ((zr > 0) & (zr < 1)))
            d_proj[t, :, : 2 * n], d_proj[t, :, 2 * n :] = d_zr, d_a
            d_u[:, : 2 * n] += h.T @ d_zr
            d_u[:, 2 * n :] += (r * h).T @ d_a
            d_h = d_new * (1 - z) + d_rh * r + d_zr @ u[:, : 2 * n].T
        grads["u" + u_name] = d_u
        return d_proj

    def backward(self, x: np.ndarray, cache: dict, d_logit: np.ndarray) -> dict:
        """Gradients of all but the tables; the rows of x are the words that the cache's numbers stand for."""
        p, n, g = self.p, self.shape.hidden, {}
        states, att = cache["states"], cache["att"]
        g["wo"], g["bo"] = cache["pooled"].T @ d_logit, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * p["wo"]
        d_states = att[:, :, None] * d_pooled
        d_att = np.einsum("tbh,bh->tb", states, d_pooled)
        d_e = att * (d_att - (att * d_att).sum(axis=0))
        g["va"] = np.einsum("tb,tba->a", d_e, cache["act"])
        d_pre = d_e[:, :, None] * p["va"] / (1 + np.abs(cache["pre"])) ** 2
        g["wa"] = np.einsum("tbh,tba->ha", states, d_pre)
        d_states = d_states + d_pre @ p["wa"].T
        ids = cache["ids"].ravel()
        order = np.argsort(ids, kind="stable")
        kinds, first = np.unique(ids[order], return_index=True)
        real = kinds < len(x)
        for k, part in (("f", d_states[:, :, :n]), ("b", d_states[:, :, n:])):
            d = self._run_back(part, cache["k" + k], k, cache["mask"], g).reshape(-1, 3 * n)
            by_word = np.add.reduceat(d[order], first, axis=0)[real]
            own = kinds[real]
            g["w" + k], g["b" + k] = x[own].T @ by_word, by_word.sum(axis=0)
        return g

    # whole texts

    def text_logits(self, texts: list[str | None]) -> np.ndarray:
        """The largest window logit of each text; -inf for texts without a word."""
        out = np.full(len(texts), -np.inf)
        for at, until in _slices(texts):
            w = split_words(texts[at:until], self.shape)
            text, begin, length = window_starts(w.counts, self.shape)
            if len(text):
                np.maximum.at(out, at + text, self.window_logits(w, begin, length).astype(float))
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """0 to 1; 0.0 for null texts and texts without a word."""
        logits = self.text_logits(texts)
        with np.errstate(over="ignore", invalid="ignore"):
            return np.where(np.isfinite(logits), 1 / (1 + np.exp(-(self.scale * logits + self.shift))), 0.0)


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of texts with about as many words as fit a batch; one long text is a run of its own."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "") // 6
        if size > _SLICE_WORDS:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def cut_windows(text: str | None, shape: Shape, max_windows: int, window_bytes: int) -> list[str]:
    """Windows of a text as the scoring has them; of more than max_windows as many, evenly spaced over the whole text, and none of more bytes."""
    words = (text or "").split()
    starts = range(0, max(1, len(words) - shape.window + shape.stride), shape.stride) if words else ()
    n = min(len(starts), max_windows)
    chosen = (" ".join(words[starts[i * len(starts) // n] :][: shape.window]) for i in range(n))
    return [x for x in chosen if len(x.encode("utf-8", "surrogatepass")) <= window_bytes]


def train(docs: list[str | list[str]], labels: list[int], shape: Shape = Shape(), epochs: int = 12, batch: int = 256, rate: float = 0.01, folds: int = 5, seed: int = 7) -> Network:
    """Fit to documents, given as texts or as windows, with labels 0 and 1. Their scores by tables without their folds set the cut.

    With one label only, or none, the network stays untrained and every score is low.
    """
    net, rng = Network(shape, seed), np.random.default_rng(seed)
    pieces = [cut_windows(own, shape, len(own), len(own) * 4) if isinstance(own, str) else own for own in docs]
    kept = [(own, y) for own, y in zip(pieces, labels) if own]
    if len({y for _, y in kept}) < 2:
        net.scale, net.shift = 0.0, -4.0
        return net
    y_doc = np.array([y for _, y in kept], np.float32)
    w = split_words([x for own, _ in kept for x in own], shape)
    text = np.repeat(np.arange(len(kept)), [len(own) for own, _ in kept])
    length = w.counts
    begin = np.cumsum(length) - length
    some = length > 0
    text, begin, length = text[some], begin[some], np.minimum(length[some], shape.window)
    fold = rng.permutation(len(kept)) % folds
    tables = _log_odds(net, w, text, begin, length, y_doc, fold, folds)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items() if k not in ("word", "gram")}
    steps = 0

    def logits_now() -> np.ndarray:
        out = np.full(len(text), -np.inf)
        for f in range(folds):
            own = np.flatnonzero(fold[text] == f)
            if len(own):
                out[own] = net.window_logits(w, begin[own], length[own], tables[f])
        return out

    for epoch in range(epochs):
        if epoch:
            worst = logits_now()
        else:
            worst = np.array([tables[fold[t]][w.index[b : b + n]].sum(axis=1).max() for t, b, n in zip(text, begin, length)])
        rank = np.lexsort((worst, text))
        top = rank[np.append(np.flatnonzero(np.diff(text[rank])), len(rank) - 1)]
        extra = rng.choice(len(text), min(len(text), len(top)), replace=False)
        chosen = np.unique(np.concatenate([top, extra[y_doc[text[extra]] == 0]]))
        rng.shuffle(chosen)
        positive = max(1.0, y_doc[text[chosen]].sum())
        weight = np.float32(min(4.0, max(1.0, (len(chosen) - positive) / positive)))
        size = min(batch, max(16, len(chosen) // 24))
        pace = rate * (1 if epoch < epochs * 2 // 3 else 0.3)
        by_fold = [chosen[fold[text[chosen]] == f] for f in range(folds)]
        groups = [(f, own[at : at + size]) for f, own in enumerate(by_fold) for at in range(0, len(own), size)]
        for f, own in (groups[i] for i in rng.permutation(len(groups))):
            sub, used = w.only(begin[own], length[own])
            ids, mask = net.lanes(sub, begin[own], length[own])
            x, cache = tables[f][used], {}
            logits = net.forward(net.project(x), ids, mask, cache)
            y = y_doc[text[own]]
            d = (1 / (1 + np.exp(-logits)) - y) * np.where(y > 0, weight, 1) / len(own)
            grads = net.backward(x, cache, d.astype(np.float32))
            steps += 1
            for k, (m, v) in moments.items():
                g = np.clip(grads[k], -1, 1)
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                net.p[k] -= (pace * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-6)).astype(np.float32)
    logits = np.full(len(kept), -np.inf)
    np.maximum.at(logits, text, logits_now())
    net.scale, net.shift = _calibrate(logits, y_doc)
    return net


def _log_odds(net: Network, w: Words, text: np.ndarray, begin: np.ndarray, length: np.ndarray, y: np.ndarray, fold: np.ndarray, folds: int) -> list[np.ndarray]:
    """Fill the tables from all documents: smoothed log-odds, by documents, of words and n-grams.

    Returns for each fold the inputs of all distinct words by tables made without it.
    """
    seen = {"word": np.zeros((folds, 2, net.shape.word_rows), np.float32), "gram": np.zeros((folds, 2, net.shape.gram_rows), np.float32)}
    order = np.argsort(text, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(text[order])) + 1):  # a document at a time
        words = np.unique(np.concatenate([w.index[b : b + n] for b, n in zip(begin[own], length[own])]))
        at = fold[text[own[0]]], int(y[text[own[0]]])
        seen["word"][at][np.unique(w.rows[words])] += 1
        seen["gram"][at][np.unique(w.grams[w.spots(words)[0]])] += 1
    smooth, out = 2.0, []
    for f in [*range(folds), None]:
        use = fold != f if f is not None else np.ones(len(y), bool)
        totals = [((y == 0) & use).sum() + 4.0, ((y == 1) & use).sum() + 4.0]
        neutral = np.log(totals[0] / totals[1])
        for k, counts in seen.items():
            clean, toxic = counts.sum(axis=0) - (counts[f] if f is not None else 0)
            odds = np.log((toxic + smooth) / totals[1]) - np.log((clean + smooth) / totals[0])
            net.p[k][:] = np.where(toxic + clean > 0, np.clip(odds - neutral * smooth / (toxic + clean + smooth), -2, 4), 0)[:, None]
        if f is not None:
            out.append(net.inputs(w, np.arange(len(w.rows))))
    return out


def _calibrate(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift that put the cut with the best F1, halfway to the next score, at 0.3."""
    ok = np.isfinite(logits)
    order = np.argsort(logits[ok])
    s, t = logits[ok][order], y[ok][order]
    caught = np.cumsum(t[::-1])[::-1]  # cut before position i: all from there on are told toxic
    f1 = 2 * caught / (len(s) - np.arange(len(s)) + max(1.0, t.sum()))
    at = int(np.argmax(f1))
    cut = 0.5 * (s[at - 1] + s[at]) if at else s[0] - 1
    return 1.0, float(np.log(0.3 / 0.7) - cut)


def sample(docs: DataFrame, labels: DataFrame, max_docs: int) -> DataFrame | None:
    """(doc_id, text, toxic) of the rows of at most max_docs ids, three tenths of them toxic where there are as many.

    Labels of the held-out fold, null labels, null ids and ids with both labels are left out; the smallest
    hashes of the ids win. None where no label is left.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    one = known.groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").cast("int").alias("other")).where("toxic = other").select("doc_id", "toxic")
    ids = []
    for label in (0, 1):
        ids += one.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs * (3 if label else 7) // 10).collect()
    if not ids:
        return None
    small = docs.sparkSession.createDataFrame(ids, one.schema)  # max_docs ids at most
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(small), "doc_id").where("text is not null")


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 4000, max_windows: int = 128, window_bytes: int = 1024, shape: Shape = Shape(), **options) -> Network:
    """docs(doc_id, text), labels(doc_id, toxic) -> a network trained on a bounded sample.

    Texts are cut into windows where they are read; only windows are shuffled. The training is one task on
    an executor, which is run again if that is lost, and holds max_docs * max_windows * window_bytes at most; the
    driver gets the trained network only. Of rows that repeat an id, the one with the smallest hash of its text counts.
    """
    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            found = [cut_windows(t, shape, max_windows, window_bytes) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), pa.array(found, pa.list_(pa.string()))], ["doc_id", "toxic", "h", "windows"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((h, y, own) for b in batches for h, y, own in zip(*(c.to_pylist() for c in b.columns)))
        net = train([own for _, _, own in rows], [y for _, y, _ in rows], shape, **options)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)], pa.binary())], ["net"])

    chosen = sample(docs, labels, max_docs)
    if chosen is None:
        return train([], [], shape, **options)
    cut_ = chosen.select("doc_id", "text", "toxic", F.xxhash64("text").alias("h")).mapInArrow(windows, f"doc_id {kind}, toxic int, h bigint, windows array<string>")
    one = cut_.groupBy("doc_id").agg(F.min(F.struct("h", "toxic", "windows")).alias("x")).select(F.xxhash64("doc_id").alias("h"), "x.toxic", "x.windows")
    trained = one.repartition(1).mapInArrow(learn, "net binary").first()
    return pickle.loads(trained[0]) if trained else train([], [], shape, **options)


def score(docs: DataFrame, net: Network, threshold: float = 0.3) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, held_out, score, predicted), a row for each row.

    All overlapping windows of the whole text are scored. Null texts and texts without a
    word score 0. Only the text enters the score; other columns are ignored.
    """
    kind = dict(docs.dtypes)["doc_id"]
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            found = model.value.scores(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    out = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, net: Network, threshold: float = 0.3) -> DataFrame:
    """The rows of docs whose score is below the threshold, with all their columns."""
    at = docs.columns.index("text")
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, at):
            yield b.filter(pa.array(model.value.scores(b.column(at).to_pylist()) < threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
