"""Language identification by a bidirectional gated recurrent network over bytes.

Two recurrent layers read a text's UTF-8 bytes forwards and backwards. At each position their states
give a distribution over the languages, and a document's probabilities are the mean over all its
positions. Training is backpropagation through time in numpy, where each position's target is its
document's language. Texts are cut into segments of ``SEGMENT`` bytes, which start from a zero
state, so that long and short texts run in one batch and any length takes bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_of_id, session, ship

SEGMENT = 96
HIDDEN = 12
#: Documents of each language, at most, that the network is trained on, and of all (of more languages, each gives fewer).
PER_LANGUAGE, SAMPLE = 1_000, 100_000
#: Characters taken of each, from a place anywhere in its text.
TRAIN_CHARS = 384
#: The code of "no byte" at the end of a last segment.
PAD = 256
BATCH = 4096
UNKNOWN = "und"
#: A character of category L; ``\w`` takes fractions and circled numbers for letters, too.
_LETTER = regex.compile(r"\p{L}")


@dataclass
class Network:
    """For each direction: input table (257, 3H), recurrent weights (3H, H), output weights (C, H); and the output's constants."""

    languages: list[str]
    table: list[np.ndarray]
    inner: list[np.ndarray]
    outer: list[np.ndarray]
    constant: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [*self.table, *self.inner, *self.outer, self.constant]


def new_network(languages: list[str], hidden: int = HIDDEN, seed: int = 1) -> Network:
    rng, c = np.random.default_rng(seed), len(languages)
    draw = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
    return Network(languages, [draw(257, 3 * hidden, s=0.3) for _ in range(2)], [draw(3 * hidden, hidden, s=0.3) for _ in range(2)], [draw(c, hidden, s=0.3) for _ in range(2)], np.zeros((c, 1), np.float32))


def segments(data: list[bytes], length: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """Codes (segments, length), padded, and the number in ``data`` that each segment belongs to."""
    counts = np.array([-(-len(d) // length) for d in data], np.int64)
    out = np.full((int(counts.sum()), length), PAD, np.int16)
    at = 0
    for d, n in zip(data, counts.tolist()):
        out[at : at + n].reshape(-1)[: len(d)] = np.frombuffer(d, np.uint8)
        at += n
    return out, np.repeat(np.arange(len(data)), counts)


def _run(table: np.ndarray, inner: np.ndarray, codes: np.ndarray, order: range, keep: bool) -> Iterator[tuple]:
    """States (H, B) after each position of ``order``; with ``keep``, what the way back needs too."""
    hidden = inner.shape[1]
    state = np.zeros((hidden, codes.shape[0]), np.float32)
    for t in order:
        g = np.ascontiguousarray(np.take(table, codes[:, t], axis=0).T)
        u = inner @ state
        gates = g[: 2 * hidden]
        gates += u[: 2 * hidden]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        z, r = gates[:hidden], gates[hidden:]
        n = r * u[2 * hidden :]
        n += g[2 * hidden :]
        np.tanh(n, out=n)
        before = state
        state = before - n
        state *= z
        state += n
        yield (t, state, before, z, r, n, u[2 * hidden :]) if keep else (t, state)


def positions(net: Network, codes: np.ndarray) -> np.ndarray:
    """Probabilities (length, C, segments) at every position."""
    length, n = codes.shape[1], codes.shape[0]
    logits = np.empty((length, len(net.languages), n), np.float32)
    for t, state in _run(net.table[0], net.inner[0], codes, range(length), False):
        logits[t] = net.outer[0] @ state + net.constant
    for t, state in _run(net.table[1], net.inner[1], codes, range(length - 1, -1, -1), False):
        logits[t] += net.outer[1] @ state
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def document_probabilities(net: Network, data: list[bytes]) -> np.ndarray:
    """Mean over a document's positions (documents, C); even for no bytes."""
    out = np.zeros((len(data), len(net.languages)))
    n_bytes = np.array([len(d) for d in data], float)
    codes, owner = segments(data)
    for at in range(0, len(codes), BATCH):
        block = codes[at : at + BATCH]
        found = positions(net, block)
        if (block[:, -1] == PAD).any():
            found *= (block.T != PAD)[:, None, :]
        np.add.at(out, owner[at : at + BATCH], found.sum(axis=0).T)
    out[n_bytes == 0] = 1 / max(len(net.languages), 1)
    return out / np.maximum(n_bytes, 1)[:, None]


def gradients(net: Network, codes: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over positions and its gradients, by backpropagation through time."""
    n, length = codes.shape
    valid = (codes.T != PAD).astype(np.float32)
    total = max(float(valid.sum()), 1.0)
    steps = [list(_run(net.table[d], net.inner[d], codes, range(length) if d == 0 else range(length - 1, -1, -1), True)) for d in range(2)]
    ahead, back = ([s[1] for s in steps[0]], [s[1] for s in reversed(steps[1])])
    delta, loss = [], 0.0
    d_outer, d_constant = [np.zeros_like(o) for o in net.outer], np.zeros_like(net.constant)
    for t in range(length):
        logits = net.outer[0] @ ahead[t] + net.outer[1] @ back[t] + net.constant
        logits -= logits.max(axis=0)
        p = np.exp(logits)
        p /= p.sum(axis=0)
        loss -= float((np.log(np.maximum(p[target, np.arange(n)], 1e-12)) * valid[t]).sum())
        p[target, np.arange(n)] -= 1
        p *= valid[t] / total
        delta.append(p)
        d_outer[0] += p @ ahead[t].T
        d_outer[1] += p @ back[t].T
        d_constant += p.sum(axis=1, keepdims=True)
    d_table, d_inner = [np.zeros_like(x) for x in net.table], [np.zeros_like(x) for x in net.inner]
    for d in range(2):
        d_state = np.zeros((net.inner[d].shape[1], n), np.float32)
        for t, _, before, z, r, cand, inner_n in reversed(steps[d]):
            d_state = d_state + net.outer[d].T @ delta[t]
            d_cand = d_state * (1 - z) * (1 - cand * cand)
            d_z = d_state * (before - cand) * z * (1 - z)
            d_r = d_cand * inner_n * r * (1 - r)
            d_u = np.concatenate([d_z, d_r, d_cand * r])
            d_g = np.concatenate([d_z, d_r, d_cand])
            d_inner[d] += d_u @ before.T
            np.add.at(d_table[d], codes[:, t], d_g.T)
            d_state = d_state * z + net.inner[d].T @ d_u
    return loss / total, [*d_table, *d_inner, *d_outer, d_constant]


def train_network(texts: list[str], labels: list[str], *, hidden: int = HIDDEN, epochs: int = 8, rate: float = 0.01, batch: int = 128, seed: int = 1) -> Network:
    """Adam over shuffled segments; classes weigh alike as each epoch draws alike from them."""
    languages = sorted(set(labels))
    net = new_network(languages, hidden, seed)
    if len(languages) < 2:
        return net
    codes, owner = segments([t.encode("utf-8", "surrogatepass") for t in texts])
    target = np.array([languages.index(x) for x in labels])[owner]
    rng = np.random.default_rng(seed)
    params = net.arrays()
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    groups = [np.nonzero(target == c)[0] for c in range(len(languages))]
    size = int(np.median([len(g) for g in groups])) + 1
    for epoch in range(epochs):
        drawn = np.concatenate([rng.permutation(np.resize(rng.permutation(g), size)) for g in groups if len(g)])
        drawn = rng.permutation(drawn)
        for at in range(0, len(drawn), batch):
            own = drawn[at : at + batch]
            step += 1
            _, grads = gradients(net, codes[own], target[own])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            now = rate * (1 - epoch / epochs) * min(1.0, 1.0 / max(norm, 1e-9))
            for p, g, a, b in zip(params, grads, m, v):
                a *= 0.9
                a += 0.1 * g
                b *= 0.999
                b += 0.001 * g * g
                p -= now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return net


def train(docs: DataFrame, *, modulus: int = 5, per_language: int = PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> Network:
    """Train on text and language of documents whose crc32 of the id, modulo ``modulus``, is not 0.

    Each language gives at most ``per_language`` documents, spread over all of its own by a hash of
    the id, and of each ``TRAIN_CHARS`` characters from a place in the whole text by that hash. Every language
    is learned, however many there are. Rows with a null id, text or language teach nothing, nor does a
    piece without a letter. Ids may be of any type.
    """
    known = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    known = known.where((crc_of_id("doc_id", modulus) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()  # a row for each language
    if not counts:
        return new_network([])
    # a share of each language that makes enough of them, all if they are few; then no more than that
    per_language = max(1, min(per_language, SAMPLE // len(counts)))
    shares = session(docs).createDataFrame([(lang, min(1.0, 1.2 * per_language / n + 20.0 / n)) for lang, n in counts], "s_lang string, share double")
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)).cast("double") / float(1 << 30)
    place = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.greatest(F.length("text") - TRAIN_CHARS, F.lit(0)) + 1) + 1
    near = known.withColumn("draw", draw).join(shares, F.col("lang") == F.col("s_lang")).where("draw < share")
    drawn = near.select("lang", "doc_id", F.substring("text", place.cast("int"), F.lit(TRAIN_CHARS)).alias("text"), "draw").orderBy("draw", "doc_id", "text")
    texts: list[str] = []
    labels: list[str] = []
    had: dict[str, int] = {}
    for row in drawn.collect():  # about 1.2 * per_language rows of each language
        if had.get(row.lang, 0) >= per_language or not _LETTER.search(row.text):
            continue
        had[row.lang] = had.get(row.lang, 0) + 1
        texts.append(row.text)
        labels.append(row.lang)
    return train_network(texts, labels, **options)


def predict(docs: DataFrame, net: Network, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score): the likeliest language of the whole text and its pooled probability.

    A null text, one without a letter, or a network without languages gives ``und`` and 0. A very long
    text is read whole, a bounded number of its segments at a time. Repeated rows each give a row; an
    empty table gives none; other columns are not read; ids may be of any type.
    """
    spark = session(docs)
    ship(spark)
    sent = spark.sparkContext.broadcast(net)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts = batch.column(1)
            at = 0
            while at < batch.num_rows:
                data: list[bytes] = []
                size, first = 0, at
                while at < batch.num_rows and size < BATCH * SEGMENT:
                    text = texts[at].as_py()
                    fit = text is not None and model.languages and _LETTER.search(text)
                    data.append(text.encode("utf-8", "surrogatepass") if fit else b"")
                    size += len(data[-1])
                    at += 1
                if model.languages:
                    p = document_probabilities(model, data)
                    best = p.argmax(axis=1)
                    names = [model.languages[b] if d else UNKNOWN for b, d in zip(best.tolist(), data)]
                    scores = [min(1.0, float(p[i, b])) if d else 0.0 for i, (b, d) in enumerate(zip(best.tolist(), data))]
                else:
                    names, scores = [UNKNOWN] * len(data), [0.0] * len(data)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, at - first), pa.array(names), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    chosen = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return chosen.mapInArrow(work, f"doc_id {dict(chosen.dtypes)['doc_id']}, lang_pred string, score double")
