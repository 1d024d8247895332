"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A text's words are lower-case runs of ASCII letters and digits and non-ASCII characters. The
network reads a word vector (for words that MIN_TEXTS texts of the training sample have; others
are known by their characters) and the mean vector of the word's hashed byte runs of 3, 5 and 7
at each step, runs a GRU over the window in either direction, pools the states by attention and
scores the window. Windows of WINDOW words that overlap by all but STRIDE are scored, the last
one ending with the text; a text of fewer words is one window. A document's score is its highest
window's.

Training takes at most SAMPLE labelled rows, those of least doc_id hash, of SAMPLE_CHARS
characters in all (a row that doesn't fit any more is passed over; texts are taken whole). Labels
are weak, as they hold for whole texts, and some are wrong: after a few steps in which each
window takes its text's label, only a toxic text's highest window does; the loss is the
generalized cross entropy (1 - p**ROBUST) / ROBUST, which weighs examples that the network can't
learn ever less; every HOLD-th text is held out, and the weights of least loss on those stay.
Windows of a few clean words said over and over join the clean ones, so that a stutter alone is
no signal. All weights start at random (byte runs' at zero) and everything is seeded, so equal
inputs give equal weights. They are a few hundred kB whatever the corpus and go to the tasks with
the scoring function.

Cases: a text without words (null, empty, punctuation) has score 0 and is never toxic. Labels
without a text, a doc_id or a value are left out; repeated labels count once, the toxic one; of
several texts of a labelled doc_id the least one trains. Without any label, or with labels of
one kind, no text is toxic. A null doc_id is scored like any other. Repeated rows score alike.
Texts are scored whole whatever their length. Other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import map_rows, pieces, released
from leafmill.llm.neardup import minima, shingle_hashes
from leafmill.llm.tokens import Powers, Words, alphanumeric, buffer_of, word_hashes

SAMPLE, SAMPLE_CHARS, WINDOW, STRIDE, HIDDEN, WORD, CHAR, MIN_TEXTS, THRESHOLD = 4000, 24_000_000, 48, 8, 8, 8, 8, 5, 0.5
GRAMS, BUCKET_BITS = (3, 5, 7), 14
WARM_STEPS, STEPS, ROUND, TRAIN_STRIDE, HIGH, LOW, STUTTER, HOLD, ROBUST, RATE, DECAY, SEED = 60, 260, 64, 24, 48, 96, 16, 5, 0.7, 0.02, 0.05, 20240611


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def character_grams(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashed byte runs of GRAMS lengths, a row for each length; a word has one at each of its bytes, counted from a mark before it and cut after one behind it."""
    wide = sizes + 2
    to = np.cumsum(wide) - wide
    inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    chars = np.zeros(wide.sum() + max(GRAMS), dtype=np.uint32)
    chars[np.repeat(to + 1, sizes) + inner] = data[np.repeat(starts, sizes) + inner]
    at, left = np.repeat(to, sizes) + inner, np.repeat(wide, sizes) - inner
    out, value = [], np.zeros(len(at), dtype=np.uint32)
    for j in range(max(GRAMS)):
        value = value * np.uint32(65599) + np.where(j < left, chars[at + j], np.uint32(0)) + np.uint32(1)
        if j + 1 in GRAMS:
            out.append(((value * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int32))
    return np.stack(out)


def summed(rows: np.ndarray, to: np.ndarray, size: int) -> np.ndarray:
    """The rows added up by their numbers below size; a negative number is left out."""
    to = np.where(to >= 0, to, size)
    return np.stack([np.bincount(to, weights=column, minlength=size + 1)[:size] for column in np.ascontiguousarray(rows.T)], axis=1).astype(np.float32)


class Encoded:
    """Distinct words of a batch of texts and the texts' windows as rows of word numbers (-1 pads)."""

    def __init__(self, texts: pa.Array, powers: Powers, stride: int = STRIDE) -> None:
        words = Words(*buffer_of(pc.utf8_lower(texts.cast(pa.large_string()))), alphanumeric())
        hashes = word_hashes(words, powers)
        self.keys, where, number = np.unique(hashes, return_index=True, return_inverse=True)
        starts, sizes = words.starts[where], (words.ends - words.starts)[where]
        self.gram_starts, self.gram_sizes = np.cumsum(sizes) - sizes, sizes
        self.grams = character_grams(words.data, starts, sizes)
        self.counts = np.diff(words.first)
        per = np.where(self.counts > WINDOW, -(-(self.counts - WINDOW) // stride) + 1, np.minimum(self.counts, 1))
        self.text = np.repeat(np.arange(len(per)), per)
        nth = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        count = self.counts[self.text]
        self.start = np.minimum(nth * stride, np.maximum(count - WINDOW, 0))
        self.numbers, first = number.astype(np.int32), words.first[:-1][self.text]
        self.at, number = first + self.start, self.numbers
        self.windows = np.full((len(self.text), WINDOW), -1, dtype=np.int32)
        for j in range(WINDOW):
            inside = self.start + j < count
            self.windows[inside, j] = number[(first + self.start + j)[inside]]


class Network:
    """Weights; a row vector times a matrix throughout. Gates in the order update, reset, candidate."""

    def __init__(self, vocabulary: np.ndarray) -> None:
        rng = np.random.default_rng(SEED)
        self.vocabulary = vocabulary  # sorted word hashes; vector 0 is for other words
        self.p = {
            "word": rng.normal(0, 0.05, (len(vocabulary) + 1, WORD)),
            "char": np.zeros((1 << BUCKET_BITS, CHAR)),  # byte runs that training never meets say nothing
            "v": rng.normal(0, 0.3, 2 * HIDDEN),
            "u": rng.normal(0, 0.3, 2 * HIDDEN),
            "c": np.array([-1.0]),
        }
        self.p["word"][0] = 0
        for d in "fb":
            self.p["x" + d] = rng.normal(0, 0.4, (WORD + CHAR, 3 * HIDDEN))
            self.p["h" + d] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
            self.p["o" + d] = np.zeros(3 * HIDDEN)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def inputs(self, e: Encoded) -> tuple[np.ndarray, np.ndarray]:
        """A vector for each distinct word, and its number in the vocabulary (0: none)."""
        if not len(e.keys):
            return np.zeros((0, WORD + CHAR), dtype=np.float32), np.zeros(0, dtype=np.int64)
        at = np.searchsorted(self.vocabulary, e.keys)
        at[at == len(self.vocabulary)] = 0
        known = np.where(self.vocabulary[at] == e.keys, at + 1, 0) if len(self.vocabulary) else np.zeros(len(e.keys), dtype=np.int64)
        char = sum(np.add.reduceat(self.p["char"][g], e.gram_starts, axis=0) for g in e.grams) / (len(GRAMS) * e.gram_sizes[:, None]).astype(np.float32)
        return np.concatenate([self.p["word"][known], char], axis=1), known

    def inputs_of(self, e: Encoded, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """inputs() for some of the distinct words."""
        part = object.__new__(Encoded)
        sizes = e.gram_sizes[rows]
        at = np.repeat(e.gram_starts[rows], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        part.keys, part.grams, part.gram_starts, part.gram_sizes = e.keys[rows], e.grams[:, at], np.cumsum(sizes) - sizes, sizes
        return self.inputs(part)

    def forward(self, x: np.ndarray, windows: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """Scores before the sigmoid of windows (rows of numbers into x)."""
        p, (n, steps), h = self.p, windows.shape, HIDDEN
        mask = windows >= 0
        states = np.zeros((n, steps, 2 * h), dtype=np.float32)
        trace: dict = {"mask": mask, "f": [], "b": []}
        for d, order, to in (("f", range(steps), slice(0, h)), ("b", range(steps - 1, -1, -1), slice(h, 2 * h))):
            ahead = np.concatenate([x @ p["x" + d] + p["o" + d], np.zeros((1, 3 * h), dtype=np.float32)])  # projected once for each distinct word
            wh, now = p["h" + d], np.zeros((n, h), dtype=np.float32)
            for t in order:
                g, r = ahead[windows[:, t]], now @ wh
                zr = sigmoid(g[:, : 2 * h] + r[:, : 2 * h])
                z, reset = zr[:, :h], zr[:, h:]
                new = np.tanh(g[:, 2 * h :] + reset * r[:, 2 * h :])
                m = mask[:, t, None]
                if keep:
                    trace[d].append((t, now, z, reset, new, r[:, 2 * h :]))
                now = np.where(m, now + z * (new - now), now)
                states[:, t, to] = now
        a = np.tanh(states)
        e = np.where(mask, a @ p["v"], np.float32(-1e9))
        w = np.exp(e - e.max(axis=1, keepdims=True))
        w /= w.sum(axis=1, keepdims=True)
        pooled = np.einsum("nt,nth->nh", w, states)
        trace |= {"states": states, "a": a, "w": w, "pooled": pooled}
        return pooled @ p["u"] + p["c"][0], trace

    def backward(self, x: np.ndarray, windows: np.ndarray, trace: dict, grad: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the weights, and of each distinct word's vector."""
        p, h = self.p, HIDDEN
        states, a, w, pooled, mask = (trace[k] for k in ("states", "a", "w", "pooled", "mask"))
        g = {"u": pooled.T @ grad, "c": np.array([grad.sum()], dtype=np.float32)}
        dp = grad[:, None] * p["u"]
        dw = np.einsum("nh,nth->nt", dp, states)
        de = w * (dw - (w * dw).sum(axis=1, keepdims=True))
        ds = w[:, :, None] * dp[:, None, :] + (de[:, :, None] * p["v"]) * (1 - a * a)
        g["v"] = np.einsum("nt,nth->h", de, a)
        n, steps = windows.shape
        inputs, dx = x[windows], np.zeros((n, steps, x.shape[1]), dtype=x.dtype)
        for d, to in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            dwh, dg = np.zeros_like(p["h" + d]), np.zeros((n, steps, 3 * h), dtype=x.dtype)
            back = np.zeros((n, h), dtype=np.float32)
            for t, now, z, reset, new, rn in reversed(trace[d]):
                m = mask[:, t, None]
                dh = np.where(m, back + ds[:, t, to], 0)
                dn = dh * z * (1 - new * new)
                dz = dh * (new - now) * z * (1 - z)
                dr = dn * rn * reset * (1 - reset)
                dg[:, t] = np.concatenate([dz, dr, dn], axis=1)
                dq = np.concatenate([dz, dr, dn * reset], axis=1)
                dwh += now.T @ dq
                back = np.where(m, dh * (1 - z) + dq @ p["h" + d].T, back)
            flat = dg.reshape(-1, 3 * h)
            g["h" + d], g["x" + d], g["o" + d] = dwh, inputs.reshape(n * steps, -1).T @ flat, flat.sum(axis=0)
            dx += dg @ p["x" + d].T
        dx = summed(dx.reshape(n * steps, -1), windows.reshape(-1), len(x))
        return g, dx

    def projected(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """For either direction, what each distinct word adds to the gates (update and reset negated, candidate doubled)."""
        return {d: (x @ self.p["x" + d] + self.p["o" + d]) * np.repeat(np.array([-1, -1, 2], dtype=np.float32), HIDDEN) for d in "fb"}

    def logits(self, ahead: dict[str, np.ndarray], words: np.ndarray, at: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """forward()'s scores, without a trace, of the windows that begin at words[at]; inside: which of their places hold a word.

        Windows lie along the last axis and exp() is the only function, which numpy is fastest on.
        """
        p, (n, steps), h = self.p, inside.shape, HIDDEN
        mask, states, places = np.ascontiguousarray(inside.T), np.zeros((steps, 2 * h, n), dtype=np.float32), np.minimum(at + np.arange(steps)[:, None], len(words) - 1)
        limit, scale = np.float32(60), np.repeat(np.array([-1, -1, 2], dtype=np.float32), h)[:, None]
        for d, order, to in (("f", range(steps), slice(0, h)), ("b", range(steps - 1, -1, -1), slice(h, 2 * h))):
            wh, now, table = np.ascontiguousarray(p["h" + d].T) * scale, np.zeros((h, n), dtype=np.float32), np.ascontiguousarray(ahead[d][words].T)
            for t in order:
                g, r = np.take(table, places[t], axis=1, mode="wrap"), wh @ now
                gates = g[: 2 * h]
                gates += r[: 2 * h]
                np.exp(np.minimum(gates, limit, out=gates), out=gates)
                gates += 1
                np.reciprocal(gates, out=gates)
                new = np.multiply(gates[h:], r[2 * h :], out=r[2 * h :])
                new += g[2 * h :]
                np.exp(np.minimum(new, limit, out=new), out=new)  # tanh(v) is 1 - 2 / (exp(2 v) + 1)
                new += 1
                np.divide(np.float32(-2), new, out=new)
                new += 1
                new -= now
                new *= gates[:h]
                new *= mask[t]
                now = np.add(now, new, out=states[t, to])
        a = np.exp(np.minimum(states * np.float32(2), limit))
        a += 1
        np.divide(np.float32(-2), a, out=a)
        e = np.where(mask, p["v"] @ a, np.float32(-1e9))  # but for the sum of v, which all steps share
        w = np.exp(e - e.max(axis=0))
        return (w * (p["u"] @ states)).sum(axis=0) / w.sum(axis=0) + p["c"][0]

    def every(self, e: Encoded, block: int = 1024) -> np.ndarray:
        """The score of each window before the sigmoid."""
        ahead, out = self.projected(self.inputs(e)[0]), [np.zeros(0, dtype=np.float32)]
        for i in range(0, len(e.at), block):
            at = e.at[i : i + block]
            out.append(self.logits(ahead, e.numbers[at[0] : at[-1] + WINDOW], at - at[0], e.windows[i : i + block] >= 0))
        return np.concatenate(out)

    def scores(self, e: Encoded) -> np.ndarray:
        """The probability of each window."""
        return sigmoid(self.every(e))

    def gradients(self, e: Encoded, windows: np.ndarray, label: np.ndarray, weight: np.ndarray, robust: float) -> dict:
        """Gradients of the weighted loss over some windows, as rows of e's word numbers."""
        rows, inverse = np.unique(windows, return_inverse=True)  # only the words at hand
        pad = int(rows[0] == -1)
        sub, windows = rows[pad:], inverse.reshape(windows.shape) - pad
        x, known = self.inputs_of(e, sub)
        logit, trace = self.forward(x, windows, keep=True)
        p = sigmoid(logit)
        right = np.where(label > 0, p, 1 - p)
        g, dx = self.backward(x, windows, trace, (weight * right**robust * (p - label) / weight.sum()).astype(np.float32))
        g["word"] = summed(dx[:, :WORD], np.where(known > 0, known, -1), len(self.p["word"]))
        sizes = e.gram_sizes[sub]
        at = np.repeat(e.gram_starts[sub], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        dc = np.repeat(dx[:, WORD:] / (len(GRAMS) * sizes[:, None]), sizes, axis=0).astype(np.float32)
        g["char"] = summed(np.concatenate([dc] * len(GRAMS)), e.grams[:, at].reshape(-1), len(self.p["char"]))
        return g


class Adam:
    """Steps of falling size; vectors of words and byte runs also shrink."""

    def __init__(self, net: Network) -> None:
        self.net, self.step = net, 0
        self.m, self.s = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))

    def take(self, g: dict) -> None:
        self.step += 1
        rate, p = RATE * min(1.0, 2 * (1 - self.step / (STEPS + 1))), self.net.p
        for k, m in self.m.items():
            m += np.float32(0.1) * (g[k] - m)
            self.s[k] += np.float32(0.01) * (g[k] ** 2 - self.s[k])
            move = (m / (1 - 0.9**self.step)) / (np.sqrt(self.s[k] / (1 - 0.99**self.step)) + 1e-6)
            p[k] = (p[k] * (1 - DECAY * rate * (k in ("word", "char"))) - rate * move).astype(np.float32)


def spokesmen(texts: list[str]) -> list[int]:
    """Of near copies among the texts the first alone, so that no single text's words seem frequent; none for texts without words."""
    has, mins, powers = [], [np.zeros((0, 64), dtype=np.uint32)], Powers()
    for i in range(0, len(texts), 64):  # a few texts at a time, to bound memory
        grams, bounds = shingle_hashes(pa.array(texts[i : i + 64], type=pa.large_string()), 3, powers)
        some = np.flatnonzero(np.diff(bounds) > 0)
        if len(some):
            has += (i + some).tolist()
            mins.append(minima(grams, bounds, 64))
    first: dict[tuple, int] = {}
    return [i for i, row in zip(has, np.concatenate(mins)) if min([first.setdefault((j, row[j : j + 3].tobytes()), i) for j in range(0, 63, 3)]) == i]


def frequent_words(e: Encoded, texts: int) -> np.ndarray:
    """Numbers of the words that MIN_TEXTS texts have."""
    among = np.zeros(len(e.keys), dtype=np.int64)
    for i in range(0, texts, 256):
        lo, hi = np.searchsorted(e.text, [i, i + 256])
        key = np.repeat(e.text[lo:hi], WINDOW).reshape(-1, WINDOW) << 32 | np.maximum(e.windows[lo:hi], 0)
        among += np.bincount(np.unique(key[e.windows[lo:hi] >= 0]) & 0xFFFFFFFF, minlength=len(e.keys))
    return np.flatnonzero(among >= MIN_TEXTS)


def stuttered(windows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Windows that say one to three words of each window over and over."""
    out = np.empty_like(windows)
    for i, w in enumerate(windows):
        k = rng.integers(1, 4)
        out[i] = np.repeat(rng.choice(w[w >= 0], k), -(-WINDOW // k))[:WINDOW]
    return out


def highest(e: Encoded, score: np.ndarray) -> np.ndarray:
    """The number of each text's highest window."""
    order = np.lexsort((-score, e.text))
    return order[np.concatenate([[True], np.diff(e.text[order]) > 0])]


def trained(texts: list[str], toxic: list[int]) -> Network | None:
    """The network fitted to texts and their labels; None where there is nothing to tell apart."""
    own = spokesmen(texts)
    texts, y = [texts[i] for i in own], np.array([toxic[i] for i in own], dtype=np.float32)
    if not len(y) or y.min() == y.max():
        return None
    e = Encoded(pa.array(texts, type=pa.large_string()), Powers(), TRAIN_STRIDE)
    net = Network(e.keys[frequent_words(e, len(texts))])
    adam, rng, label = Adam(net), np.random.default_rng(SEED), y[e.text]
    held = np.zeros(len(y), dtype=bool)
    for kind in (0, 1):  # some of either kind, none where one text is all there is
        held[np.flatnonzero(y == kind)[HOLD - 1 :: HOLD]] = True
    held = held[e.text]
    high, clean = np.flatnonzero((label > 0) & ~held), np.flatnonzero((label == 0) & ~held)
    rest, best, kept = clean, np.inf, net.p
    while True:
        if adam.step:
            score = net.every(e)
            top = highest(e, score)
            loss = held_loss(sigmoid(score[top[held[top]]]), label[top[held[top]]])
            if loss < best or not held.any():
                best, kept = loss, dict(net.p)
            if adam.step >= STEPS:
                net.p = kept
                return net
            high = top[(label[top] > 0) & ~held[top]]
            hard = clean[score[clean] > -2]
            hard = rng.permutation(hard)[: max(1, len(clean) // 4)]
            rest = np.concatenate([hard, rng.permutation(clean)[: 6 * len(high)]])
        for _ in range(min(ROUND if adam.step else WARM_STEPS, STEPS - adam.step)):
            a, b = rng.permutation(high)[:HIGH], rng.permutation(rest)[:LOW]
            windows = e.windows[np.concatenate([a, b])]
            windows[-STUTTER:] = stuttered(windows[-STUTTER:], rng) if len(b) >= STUTTER else windows[-STUTTER:]
            weight = np.concatenate([np.full(len(a), 0.5 * len(b) / len(a)), np.ones(len(b))])
            adam.take(net.gradients(e, windows, label[np.concatenate([a, b])], weight, ROBUST if adam.step >= WARM_STEPS else 0.0))


def held_loss(p: np.ndarray, y: np.ndarray) -> float:
    """The loss over held-out texts; toxic ones weigh a quarter of the clean ones in all."""
    weight = np.where(y > 0, 0.25 * (y == 0).sum() / max(1, (y > 0).sum()), 1.0)
    right = np.clip(np.where(y > 0, p, 1 - p), 1e-6, 1.0)
    return float((weight * (1 - right**ROBUST) / ROBUST).sum() / max(1e-9, weight.sum()))


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, characters: int = SAMPLE_CHARS) -> Network | None:
    """The network trained on at most sample labelled rows of docs, of at most so many characters in all."""
    own = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    sizes = texts.groupBy("doc_id").agg(F.max(F.length("text")).alias("size"))
    chosen, room = [], characters
    for r in own.join(sizes, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect():
        if r["size"] <= room:
            chosen.append((r.doc_id, r.toxic))
            room -= r["size"]
    if not chosen:
        return None
    few = docs.sparkSession.createDataFrame(chosen, "doc_id bigint, toxic int")
    # sample rows at most
    rows = texts.join(F.broadcast(few), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy("doc_id").collect()
    return trained([r.text for r in rows], [int(r.toxic > 0) for r in rows])


def window_scorer(net: Network | None, out: Callable) -> Callable:
    """A map over batches; out(part, e, scores) gives the batch to return."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for part in pieces(batches, "text", 1 << 20):
            e = Encoded(part.column("text"), powers)
            scores = net.scores(e) if net else np.zeros(len(e.text), dtype=np.float32)
            yield out(part, e, scores)

    return released(run)


def toxic_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, score, windows, toxic_windows, first_word): each document whose highest window reaches the threshold.

    score is that window's, first_word where it begins, windows and toxic_windows how many were scored and reached it.
    """

    def out(part: pa.RecordBatch, e: Encoded, scores: np.ndarray) -> pa.RecordBatch:
        top = highest(e, scores) if len(scores) else np.zeros(0, dtype=np.int64)  # of equals the first, as the order is stable
        top = top[scores[top] >= threshold]
        text = e.text[top]
        every, high = np.bincount(e.text, minlength=len(part)), np.bincount(e.text[scores >= threshold], minlength=len(part))
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id").take(pa.array(text)), pa.array(scores[top].astype(np.float64)), pa.array(every[text], pa.int64()), pa.array(high[text], pa.int64()), pa.array(e.start[top], pa.int64())],
            names=["doc_id", "score", "windows", "toxic_windows", "first_word"],
        )

    own = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    return own.mapInArrow(window_scorer(fitted(docs, labels, sample), out), "doc_id bigint, score double, windows bigint, toxic_windows bigint, first_word bigint")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """docs without the rows whose highest window reaches the threshold; columns as in docs."""

    def out(part: pa.RecordBatch, e: Encoded, scores: np.ndarray) -> pa.RecordBatch:
        keep = np.ones(len(part), dtype=bool)
        keep[e.text[scores >= threshold]] = False
        return part.filter(pa.array(keep))

    return map_rows(docs, window_scorer(fitted(docs, labels, sample), out))
