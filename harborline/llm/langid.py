"""Language ID by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on a bounded
sample of labelled windows, and labels every byte position; a document's
probabilities are the mean over its positions. Texts are cut into windows so
that all positions of a whole text are labelled, thousands of windows a step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import prepare, whole_row

UNKNOWN = "und"
#: Windows that go through the network together, and bytes of one.
ROWS, WINDOW = 1024, 128
#: Languages that a network may have.
MOST_LABELS = 1000


def logistic(v: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-v)) in place."""
    np.negative(v, out=v)
    np.minimum(v, 80, out=v)
    np.exp(v, out=v)
    v += 1
    return np.reciprocal(v, out=v)


def tanh(v: np.ndarray) -> np.ndarray:
    """tanh in place, by the logistic function, whose exponential numpy does faster."""
    v *= 2
    logistic(v)
    v *= 2
    v -= 1
    return v


@dataclass
class ByteGRU:
    """Weights; axis 0 is the direction. Gates lie one below the other: update, reset, candidate.

    Rows of a batch lie along the last axis, so each gate of all rows is one
    contiguous block.
    """

    langs: list[str]
    x: np.ndarray = field(default=None)  # (2, 3H, 256), bias included
    u: np.ndarray = field(default=None)  # (2, 3H, H)
    out: np.ndarray = field(default=None)  # (C, 2H + 1)

    @classmethod
    def fresh(cls, langs: list[str], hidden: int, seed: int) -> ByteGRU:
        r = np.random.default_rng(seed)
        f = lambda *s, scale: (r.standard_normal(s) * scale).astype(np.float32)
        return cls(langs, f(2, 3 * hidden, 256, scale=0.3), f(2, 3 * hidden, hidden, scale=hidden**-0.5),
            f(len(langs), 2 * hidden + 1, scale=0.1))

    def states(self, data: np.ndarray, keep: list | None = None) -> np.ndarray:
        """(2, T, H, rows): the states that each direction has after each position."""
        rows, steps = data.shape
        hidden = self.u.shape[2]
        x, u = self.x, self.u
        both = np.stack([data.T, data.T[::-1]]).astype(np.intp)
        h = np.zeros((2, hidden, rows), np.float32)
        a, uh = np.empty((2, 3 * hidden, rows), np.float32), np.empty((2, 3 * hidden, rows), np.float32)
        out = np.empty((2, steps, hidden, rows), np.float32)
        for t in range(steps):
            for d in range(2):
                np.take(x[d], both[d, t], axis=1, out=a[d], mode="clip")
                np.matmul(u[d], h[d], out=uh[d])
            zr = a[:, : 2 * hidden] + uh[:, : 2 * hidden]
            logistic(zr)
            z, r = zr[:, :hidden], zr[:, hidden:]
            n = r * uh[:, 2 * hidden :]
            n += a[:, 2 * hidden :]
            tanh(n)
            if keep is not None:
                keep.append((h, z, r, uh[:, 2 * hidden :].copy(), n))
            h = h - n
            h *= z
            h += n
            out[0, t] = h[0]
            out[1, steps - 1 - t] = h[1]
        return out

    def logits(self, states: np.ndarray) -> np.ndarray:
        """(T, C, rows)."""
        hidden = self.u.shape[2]
        e = np.matmul(self.out[:, :hidden], states[0])
        e += np.matmul(self.out[:, hidden:-1], states[1])
        e += self.out[:, -1:]
        return e

    def positions(self, data: np.ndarray) -> np.ndarray:
        """(T, C, rows): probabilities of every position."""
        e = self.logits(self.states(data))
        e -= e.max(1, keepdims=True)
        np.exp(e, out=e)
        e /= e.sum(1, keepdims=True)
        return e

    def gradients(self, data: np.ndarray, label: np.ndarray, mask: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over positions and its gradients, backwards through all steps."""
        keep: list = []
        states = self.states(data, keep)
        _, steps, hidden, rows = states.shape
        e = self.logits(states)
        e -= e.max(1, keepdims=True)
        p = np.exp(e)
        p /= p.sum(1, keepdims=True)
        weight = mask.T / mask.sum()
        at = np.arange(rows)
        loss = -(np.log(p[:, label, at] + 1e-9) * weight).sum()
        p[:, label, at] -= 1
        p *= weight[:, None]
        gout = np.concatenate([*[np.tensordot(p, s, ([0, 2], [0, 2])) for s in states], p.sum((0, 2))[:, None]], 1)
        down = [np.matmul(self.out[:, :hidden].T, p), np.matmul(self.out[:, hidden:-1].T, p)]
        gu, inputs = np.zeros_like(self.u), np.empty((2, steps, 3 * hidden, rows), np.float32)
        dh = np.zeros((2, hidden, rows), np.float32)
        for t in range(steps - 1, -1, -1):
            h, z, r, un, n = keep[t]
            dh = dh + np.stack([down[0][t], down[1][steps - 1 - t]])
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            inputs[:, t] = np.concatenate([dz, dr, dn], 1)
            du = np.concatenate([dz, dr, dn * r], 1)
            gu += du @ h.transpose(0, 2, 1)
            dh = dh * z + self.u.transpose(0, 2, 1) @ du
        gx = np.empty_like(self.x)
        for d, order in enumerate((data.T, data.T[::-1])):
            hot = np.zeros((steps * rows, 256), np.float32)
            hot[np.arange(steps * rows), order.reshape(-1)] = 1
            gx[d] = inputs[d].transpose(1, 0, 2).reshape(3 * hidden, -1) @ hot
        return float(loss), [gx, gu, gout.astype(np.float32)]

    def fit(self, data: np.ndarray, label: np.ndarray, mask: np.ndarray, steps: int, batch: int, rate: float,
        seed: int) -> ByteGRU:
        """Adam over random batches; the rate falls to zero."""
        r = np.random.default_rng(seed)
        weights = [self.x, self.u, self.out]
        m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        for step in range(1, steps + 1):
            i = r.integers(0, len(data), min(batch, len(data)))
            _, grads = self.gradients(data[i], label[i], mask[i])
            now = rate * (1 - (step - 1) / steps)
            for w, g, a, b in zip(weights, grads, m, v, strict=True):
                np.clip(g, -1, 1, out=g)
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= (now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """(texts, C): mean probabilities over all positions of each text."""
        sums = np.zeros((len(texts), len(self.langs)))
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        count = -(-length // WINDOW)
        owner = np.repeat(np.arange(len(texts)), count)
        data = np.zeros((int(count.sum()), WINDOW), np.uint8)
        flat, at = data.reshape(-1), (np.cumsum(count) - count) * WINDOW
        for a, t in zip(at.tolist(), texts, strict=True):
            flat[a : a + len(t)] = np.frombuffer(t, np.uint8)
        used = np.minimum(WINDOW, length[owner] - (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count,
            count)) * WINDOW)
        for a in range(0, len(data), ROWS):
            n = used[a : a + ROWS]
            p = self.positions(data[a : a + ROWS])
            p *= (np.arange(WINDOW)[:, None] < n)[:, None]
            for c, s in enumerate(p.sum(0, dtype=np.float64)):
                sums[:, c] += np.bincount(owner[a : a + ROWS], s, len(texts))
        return sums / np.maximum(length, 1)[:, None]


def held_out(id_col: str) -> Column:
    """Whether the row's id is set aside: crc32 of its text form mod 3 is 1. Null ids aren't."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, per_lang: int = 800, windows: int | None = 3, steps: int = 320, hidden: int = 8, seed: int = 7,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteGRU | None:
    """Fit on labelled rows that aren't held out; None if there is none.

    The sample is bounded: of each label the ``per_lang`` documents of least
    hash, ``windows`` windows of each at places set by the hash anywhere in the
    text; None takes whole texts, in windows one after another, all of which the
    driver then holds. A label's count sets a limit on the hash below which about four times
    that many documents lie; only those are moved and ranked, so neither grows
    with the input. There is a row for each label in what is broadcast, and an
    output of the network, so labels must be few: over ``MOST_LABELS`` is an error.
    """
    seedling = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 31))
    has_letter = F.rlike(F.col(text_col), F.lit(r"\p{L}"))
    usable = docs.where(F.col(lang_col).isNotNull() & ~held_out(id_col) & has_letter)
    places = F.array(
        *[(F.pmod(F.xxhash64(F.col(id_col), F.lit(seed + 1 + k)),
            F.greatest(F.length(text_col) - WINDOW + 1, F.lit(1))) + 1).cast("int") for k in range(windows or 0)]
    )
    if windows is None:
        places = F.sequence(F.lit(1), F.greatest(F.length(text_col), F.lit(1)), F.lit(WINDOW))
    cut = F.transform(places, lambda p: F.substring(F.col(text_col), p, WINDOW))
    counts = usable.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")).limit(MOST_LABELS
        + 1).collect()
    if not counts:
        return None
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    limits = docs.sparkSession.createDataFrame([(r["lang"], 4.0 * per_lang * (1 << 31) / r["n"]) for r in counts],
        "lang string, below double")
    ranked = W.partitionBy("lang").orderBy("h", "id")
    sample = (
        usable.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), seedling.alias("h"), cut.alias("cut"))
        .join(F.broadcast(limits), "lang")  # MOST_LABELS rows at most
        .where(F.col("h") < F.col("below"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= per_lang)
        .orderBy("lang", "rank")
        .select("lang", "cut")
        .collect()
    )
    if not sample:
        return None
    langs = sorted({r["lang"] for r in sample})
    pieces = [(c.encode("utf-8", "replace")[:WINDOW], langs.index(r["lang"])) for r in sample for c in r["cut"]]
    data, mask = np.zeros((len(pieces), WINDOW), np.uint8), np.zeros((len(pieces), WINDOW), np.float32)
    for i, (b, _) in enumerate(pieces):
        data[i, : len(b)] = np.frombuffer(b, np.uint8)
        mask[i, : len(b)] = 1
    label = np.array([k for _, k in pieces])
    return ByteGRU.fresh(langs, hidden, seed).fit(data, label, mask, steps, 96, 0.02, seed)


def predict(docs: DataFrame, model: ByteGRU | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(kept columns of ``docs``, lang_pred, score).

    Only the text is an input. ``score`` is the mean probability of the
    language over all positions. Null texts, texts without a letter and all
    texts if there is no model are ``und`` with score 0.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        net = shared.value
        for texts in batches:
            best, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            raw = [t.encode("utf-8", "replace") if t else b"" for t in texts]
            known = np.flatnonzero([len(t) > 0 for t in raw]) if net else []
            at = 0
            while at < len(known):
                to, size = at, 0
                while to < len(known) and (to == at or size + len(raw[known[to]]) < 1 << 23):
                    size += len(raw[known[to]])
                    to += 1
                p = net.documents([raw[i] for i in known[at:to]])
                top = p.argmax(1)
                best[known[at:to]] = np.array(net.langs, object)[top]
                score[known[at:to]] = np.clip(p[np.arange(len(top)), top], 0, 1)
                at = to
            yield pd.DataFrame({"lang_pred": best, "score": score})

    text = F.when(F.rlike(F.col(text_col), F.lit(r"\p{L}")), F.col(text_col))
    return docs.select(*(keep or docs.columns), label(text).alias("_p")).select(*(keep or docs.columns), "_p.lang_pred",
        "_p.score")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    **how) -> DataFrame:
    """(doc, held_out, lang_pred, score): every row of ``docs``, whole texts.

    Null and blank texts and those without a letter are ``und``. A text of any
    length is read whole, 8 MB of texts at a time or one longer text. Repeated
    rows and null ids stay; an empty table gives an empty table. Other columns,
    whatever their names, are kept in ``doc``. ``how`` goes to ``train``.
    """
    model = train(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, **how)
    rows = docs.select(whole_row(docs).alias("doc"), held_out(id_col).alias("held_out"), F.col(text_col).alias("body"))
    return predict(rows, model, "body", keep=["doc", "held_out"])
