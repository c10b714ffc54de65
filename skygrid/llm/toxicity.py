"""Toxicity scores from a bidirectional gated recurrent network.

Words enter by their characters (a recurrent encoder with attention pooling)
and by an embedding of the words known from training.  A second such layer
runs over windows of words that overlap by half; all windows of the whole text
are scored, and the text's score follows its highest window.

The network is trained in numpy on a bounded sample of labelled texts: the
character encoder first learns to tell how much likelier a word is in texts
labelled 1; then the highest windows of each text are trained on the text's
label.  Scores are calibrated to the share of labels.

Cases
-----
* null or empty text, a text without words: the score of a window without
  words;
* words are runs of letters and digits in lower case, longer ones are cut
  into pieces of WORD_CHARS characters that all count;
* a text of fewer words than a window has one window; texts of any length are
  scored whole;
* repeated rows: each row is scored, alike; several labels of one id count as
  the highest; null labels teach nothing;
* no usable labels, or of one kind only: every score is the share of label 1
  (0 without labels); empty table: empty result;
* other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.llm import recurrent
from skygrid.llm.common import map_batches, text_slices
from skygrid.llm.decontam import Hasher

# The training sample: about this many whole texts of either label.  Where a
# label's would hold more than about this many characters, fewer of its longest.
TEXTS_PER_LABEL = 1200
SAMPLE_CHARS = 12 << 20
WINDOW, STRIDE = 16, 8
WORD_CHARS = 24
HIDDEN, CHAR_DIM, WORD_DIM = 8, 8, 8
EPOCHS = 6
SLICE_BYTES = 2 << 20
_CHARS = 1024
_ROWS = 2048        # rows a layer runs over at once


class _Words:
    """The words of some texts: each one's index among the distinct words."""

    def __init__(self, texts: list[str], hasher: Hasher):
        points, starts, ends, owner = Hasher.spans(texts)
        pieces = -(-(ends - starts) // WORD_CHARS)
        if len(pieces) and pieces.max() > 1:       # cut long words
            first = np.repeat(np.cumsum(pieces) - pieces, pieces)
            at = np.repeat(starts, pieces) + (np.arange(pieces.sum()) - first) * WORD_CHARS
            ends, owner = np.minimum(at + WORD_CHARS, np.repeat(ends, pieces)), np.repeat(owner, pieces)
            starts = at
        self.hash, where, self.index = np.unique(hasher.hashes(points, starts, ends),
                                                 return_index=True, return_inverse=True)
        self.owner, self.n_texts = owner, len(texts)
        starts, self.length = starts[where], (ends - starts)[where]
        columns = np.arange(WORD_CHARS)
        codes = points[np.minimum(starts[:, None] + columns, max(0, len(points) - 1))] if len(starts) else \
            np.zeros((0, WORD_CHARS), np.uint32)
        codes = np.where(codes < 768, codes, 768 + codes % 256)
        self.chars = np.where(columns < self.length[:, None], codes, 0).astype(np.int32)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """``(word index or -1 by window and place, text number)``; a text without words has one, empty."""
        counts = np.bincount(self.owner, minlength=self.n_texts)
        n = 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE))
        text = np.repeat(np.arange(self.n_texts), n)
        begin = np.cumsum(counts) - counts
        number = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        at = (begin[text] + number * STRIDE)[:, None] + np.arange(WINDOW)
        inside = at < (begin + counts)[text][:, None]
        if not len(self.index):
            return np.full(at.shape, -1, np.int64), text
        return np.where(inside, self.index[np.minimum(at, len(self.index) - 1)], -1), text


class Network:
    """Parameters, vocabulary and calibration."""

    def __init__(self, vocabulary: np.ndarray, odds: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.vocabulary = vocabulary               # sorted word hashes; embedding row 0 is for the others
        embedding = (rng.standard_normal((len(vocabulary) + 1, WORD_DIM)) * 0.05).astype(np.float32)
        embedding[0] = 0
        embedding[1:, 0] = 0.5 * odds
        self.p = {"Ec": (rng.standard_normal((_CHARS, CHAR_DIM)) * 0.5).astype(np.float32), "Ew": embedding,
                  "o": (rng.standard_normal(2 * HIDDEN) * 0.3).astype(np.float32), "c": np.zeros(1, np.float32),
                  "ho": (rng.standard_normal(2 * HIDDEN) * 0.3).astype(np.float32), "hc": np.zeros(1, np.float32)}
        for name, inputs in (("c.", CHAR_DIM), ("w.", 2 * HIDDEN + WORD_DIM)):
            self.p |= {name + k: v for k, v in recurrent.init_layer(rng, inputs, HIDDEN, HIDDEN).items()}
        self.scale, self.shift = 1.0, 0.0

    def layer(self, name: str) -> dict[str, np.ndarray]:
        return {k[2:]: v for k, v in self.p.items() if k.startswith(name)}

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """The embedding rows of words."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    # -- forward and backward, with what training needs --------------------

    def encode(self, chars: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """The character encoding of words."""
        p, steps = self.layer("c."), int(lengths.max(initial=1))
        chars = chars[:, :steps]
        mask = (np.arange(steps)[:, None] < lengths).astype(np.float32)
        f, b = recurrent.project(p, self.p["Ec"])
        pooled, cache = recurrent.pool(p, lambda t: f[chars[:, t]], lambda t: b[chars[:, t]], mask, keep)
        return pooled, (chars, cache)

    def encode_back(self, cache, grad: np.ndarray) -> dict[str, np.ndarray]:
        chars, inner = cache
        p = self.layer("c.")
        g, df, db = recurrent.pool_back(p, inner, grad)
        out = {}
        table = np.zeros_like(self.p["Ec"])
        for way, parts in (("f", df), ("b", db)):
            gates = np.zeros((_CHARS, 3 * HIDDEN), np.float32)
            for t, part in enumerate(parts):
                np.add.at(gates, chars[:, t], part)
            g["W" + way], g["c" + way] = self.p["Ec"].T @ gates, gates.sum(axis=0)
            table += gates @ p["W" + way].T
        out["Ec"] = table
        return out | {"c." + k: v for k, v in g.items()}

    def word_vectors(self, words: _Words) -> np.ndarray:
        """Character encodings and embeddings of the distinct words (inference)."""
        order = np.argsort(words.length, kind="stable")
        pooled = np.zeros((len(order), 2 * HIDDEN), np.float32)
        for at in range(0, len(order), _ROWS):
            some = order[at:at + _ROWS]
            pooled[some] = self.encode(words.chars[some], words.length[some])[0]
        return np.concatenate((pooled, self.p["Ew"][self.rows(words.hash)]), axis=1)

    def window_logits(self, words: _Words, windows: np.ndarray) -> np.ndarray:
        """The logit of every window (inference)."""
        p = self.layer("w.")
        f, b = recurrent.project(p, self.word_vectors(words))
        if not len(f):
            f = b = np.zeros((1, 3 * HIDDEN), np.float32)
        out = np.zeros(len(windows), np.float32)
        for at in range(0, len(windows), _ROWS):
            some = windows[at:at + _ROWS]
            mask = (some.T >= 0).astype(np.float32)
            pooled, _ = recurrent.pool(p, lambda t, some=some: f[some[:, t]], lambda t, some=some: b[some[:, t]], mask)
            out[at:at + _ROWS] = pooled @ self.p["o"] + self.p["c"]
        return out

    def text_logits(self, texts: list[str], hasher: Hasher) -> np.ndarray:
        """The highest window logit of every text."""
        words = _Words(texts, hasher)
        windows, owner = words.windows()
        out = np.full(len(texts), -np.inf, np.float32)
        np.maximum.at(out, owner, self.window_logits(words, windows))
        return out

    def scores(self, texts: list[str], hasher: Hasher) -> np.ndarray:
        logit = self.scale * self.text_logits(texts, hasher).astype(np.float64) + self.shift
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -500, 500)))

    # -- training ----------------------------------------------------------

    def _pretrain(self, words: _Words, target: np.ndarray, rng, steps: int = 900, size: int = 256) -> None:
        """The character encoder learns the words' log odds."""
        adam = recurrent.Adam(self.p, 0.01)
        marked = np.flatnonzero(target > 1.0)
        for step in range(steps):
            adam.rate = 0.01 * (1 - 0.9 * step / steps)
            pick = rng.integers(0, len(target), size // 2)
            more = rng.choice(marked, size - len(pick)) if len(marked) else rng.integers(0, len(target), size // 2)
            pick = np.concatenate((pick, more))
            pooled, cache = self.encode(words.chars[pick], words.length[pick], keep=True)
            error = (pooled @ self.p["ho"] + self.p["hc"] - target[pick])[:, None] / size
            grads = self.encode_back(cache, error * self.p["ho"])
            grads |= {"ho": (error * pooled).sum(axis=0), "hc": error.sum(axis=0)}
            adam.step(grads)

    def _train_windows(self, words: _Words, windows: np.ndarray, label: np.ndarray, weight: np.ndarray,
                       adam: recurrent.Adam, rng, size: int = 64) -> None:
        order = rng.permutation(len(windows))
        for at in range(0, len(order), size):
            pick = order[at:at + size]
            some = windows[pick]
            distinct, back = np.unique(some, return_inverse=True)
            back = back.reshape(some.shape)
            chars = np.where(distinct[:, None] >= 0, words.chars[distinct], 0)
            lengths = np.where(distinct >= 0, words.length[distinct], 0)
            pooled_c, cache_c = self.encode(chars, lengths, keep=True)
            rows = np.where(distinct >= 0, self.rows(words.hash[distinct]), 0)
            vectors = np.concatenate((pooled_c, self.p["Ew"][rows]), axis=1)
            p = self.layer("w.")
            f, b = recurrent.project(p, vectors)
            mask = (some.T >= 0).astype(np.float32)
            pooled, cache = recurrent.pool(p, lambda t, f=f, back=back: f[back[:, t]],
                                           lambda t, b=b, back=back: b[back[:, t]], mask, keep=True)
            logit = pooled @ self.p["o"] + self.p["c"]
            error = ((1 / (1 + np.exp(-logit)) - label[pick]) * weight[pick])[:, None] / size
            g, df, db = recurrent.pool_back(p, cache, error * self.p["o"])
            dvectors = np.zeros_like(vectors)
            for way, parts in (("f", df), ("b", db)):
                gates = np.zeros((len(distinct), 3 * HIDDEN), np.float32)
                for t, part in enumerate(parts):
                    np.add.at(gates, back[:, t], part)
                g["W" + way], g["c" + way] = vectors.T @ gates, gates.sum(axis=0)
                dvectors += gates @ p["W" + way].T
            grads = {"w." + k: v for k, v in g.items()}
            grads |= self.encode_back(cache_c, dvectors[:, :2 * HIDDEN])
            embedding = np.zeros_like(self.p["Ew"])
            np.add.at(embedding, rows, dvectors[:, 2 * HIDDEN:])
            embedding[0] = 0
            grads |= {"Ew": embedding, "o": (error * pooled).sum(axis=0), "c": error.sum(axis=0)}
            adam.step(grads)

    def calibrate(self, logit: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
        """Scale and shift that fit the weighted labels best (logistic regression)."""
        a, b = 1.0, 0.0
        x = logit.astype(np.float64)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -500, 500)))
            e, w = weight * (p - label), weight * p * (1 - p)
            h = np.array([[(w * x * x).sum() + 1.0, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
            da, db = np.linalg.solve(h, [(e * x).sum() + (a - 1.0), e.sum()])
            a, b = max(0.05, a - np.clip(da, -1, 1)), b - np.clip(db, -2, 2)
        self.scale, self.shift = float(a), float(b)


class Constant:
    """For samples that teach no difference: one score for all."""

    def __init__(self, score: float):
        self.score = score

    def scores(self, texts: list[str], hasher: Hasher) -> np.ndarray:
        return np.full(len(texts), self.score)


def train(texts: list[str], labels: np.ndarray, share: float, epochs: int = EPOCHS, seed: int = 5):
    """A network of a sample; ``share`` of label 1 among all labelled texts."""
    labels = np.asarray(labels, np.float32)
    if not len(labels) or labels.min() == labels.max():
        return Constant(share)
    rng, words = np.random.default_rng(seed), _Words(texts, Hasher())
    windows, owner = words.windows()
    # Word odds: in how many texts of either label a word stands.
    seen = np.unique(words.index * np.int64(len(texts)) + words.owner)
    word, text = seen // len(texts), seen % len(texts)
    one = np.bincount(word, labels[text], len(words.hash))
    zero = np.bincount(word, 1 - labels[text], len(words.hash))
    n1, n0 = labels.sum(), (1 - labels).sum()
    odds = np.log((one + 0.5) / (n1 + 1)) - np.log((zero + 0.5) / (n0 + 1))
    odds *= (one + zero) / (one + zero + 2)
    frequent = np.flatnonzero(one + zero >= 3)
    net = Network(words.hash[frequent], odds[frequent].astype(np.float32), seed)
    net._pretrain(words, odds.astype(np.float32), rng)
    adam = recurrent.Adam(net.p, 0.004)
    weight = np.where(labels == 1, 0.5 / n1, 0.5 / n0) * len(labels)
    for epoch in range(epochs):
        adam.rate = 0.004 * (1 - 0.8 * epoch / epochs)
        logits = net.window_logits(words, windows) if epoch else \
            np.where(windows >= 0, odds[windows], 0).max(axis=1) + 0.0
        # Each text's two highest windows bear its label, a random one of a text of label 0 too.
        order = np.lexsort((-logits, owner))
        first = np.flatnonzero(np.diff(owner[order], prepend=-1))
        second = np.minimum(first + 1, len(order) - 1)
        chosen = [order[first], order[second][(owner[order[second]] == owner[order[first]]) & (labels == 0)],
                  rng.permutation(np.flatnonzero(labels[owner] == 0))[:len(texts)]]
        pick = np.concatenate(chosen)
        net._train_windows(words, windows[pick], labels[owner[pick]],
                           weight[owner[pick]].astype(np.float32), adam, rng)
    top = np.full(len(texts), -np.inf, np.float32)
    np.maximum.at(top, owner, net.window_logits(words, windows))
    net.calibrate(top, labels, np.where(labels == 1, share / n1, (1 - share) / n0) * len(labels))
    return net


def shares(classes: list[tuple[int, int, int, int]], texts: int, chars: int) -> dict[tuple[int, int], float]:
    """The share to draw of each ``(label, class)``, from its ``(label, class, rows, characters)``.

    A label's rows have one share, ``texts`` of all of them, as long as they keep
    within ``chars``.  Else the classes, the smallest demand first, each get what
    they ask for or an even part of what is left.
    """
    out = {}
    for label in sorted({c[0] for c in classes}):
        own = [c for c in classes if c[0] == label]
        even = min(1.0, texts / sum(c[2] for c in own))
        left = float(chars)
        for k, (_, at, _, total) in enumerate(sorted(own, key=lambda c: (c[3], c[1]))):
            given = min(even * total, left / (len(own) - k))
            out[label, at] = given / total if total else even
            left -= given
    return out


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", texts_per_label: int = TEXTS_PER_LABEL):
    """Train on a bounded, hash-chosen sample of the labelled rows of ``docs``.

    The bound is one of rows: a chosen text is learned whole, as its label is
    the whole text's.  Rows are drawn by classes of length (a power of two
    characters each), so that very long texts take no short one's place.
    """
    marks = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
             .where("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.max("label").alias("label")))
    # Choose by id; the texts themselves are not shuffled.
    known = docs.select(F.col(id_col).alias("id"), F.coalesce(F.length(text_col), F.lit(0)).alias("chars")).join(marks, "id")
    size = F.ceil(F.log2(F.col("chars") + F.lit(1))).cast("int")
    classes = known.groupBy("label", size.alias("size")).agg(
        F.count("*").alias("n"), F.sum(F.col("chars").cast("long")).alias("chars")).collect()    # at most 2 * 32
    counts: dict[int, int] = {}
    for r in classes:
        counts[r["label"]] = counts.get(r["label"], 0) + r["n"]
    if not counts:
        return Constant(0.0)
    share = F.lit(0.0)
    for (label, at), p in shares([(r["label"], r["size"], r["n"], r["chars"]) for r in classes],
                                 texts_per_label, SAMPLE_CHARS).items():
        share = F.when((F.col("label") == label) & (size == at), p).otherwise(share)
    draw = F.pmod(F.xxhash64("id", F.lit(13)), F.lit(1 << 32)) / float(1 << 32)
    chosen = F.broadcast(known.where(draw < share).select("id", "label").distinct())      # about 2 * texts_per_label rows
    sample = sorted((r["text"], r["label"]) for r in docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .join(chosen, "id").select("text", "label").collect())
    return train([t for t, _ in sample], np.array([y for _, y in sample]),
                 counts.get(1, 0) / sum(counts.values()))


def score(docs: DataFrame, model, id_cols: list[Column], text_col: str = "text") -> DataFrame:
    """``id_cols`` plus ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) per row."""
    keyed = docs.select(*id_cols, F.col(text_col).alias("__text"))
    n = len(id_cols)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ids = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields[:n])

    def run(batch: pa.RecordBatch, hasher=Hasher()):     # noqa: B008 one per task
        for part in text_slices(batch, n, SLICE_BYTES):
            scores = shared.value.scores([t or "" for t in part.column(n).to_pylist()], hasher)
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(n)]
                + [pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))],
                names=[*batch.schema.names[:n], "score", "predicted"])

    return map_batches(keyed, run, ids + ", score double, predicted int")
