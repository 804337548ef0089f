"""Document quality from a linear-chain conditional random field over the lines.

Every line of a text is good or bad.  The field's node scores come from features
of the line and of its neighbours, its edge scores from pairs of labels that
follow each other.  Forward-backward gives each line's marginal of being good;
their mean, weighted by line length, is the quality of the text, and a sigmoid
turns it into the share of good documents at that quality.

The field is fitted on documents whose quality is known as a whole.  At first
all lines have their document's label.  After a first fit the lines of bad documents
that look good are relabelled, the worst line of each excepted, and the field is
fitted again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .compression_rules import repeated_words
from .labelled import fit_sigmoid
from .texts import per_text, text_bytes

N_LINE = 13  # features of a line
N_NODE = 3 * N_LINE  # those of the line, of the one before and of the one after
BLOCK = 256  # texts whose lines are laid side by side, at most
CELLS = 1 << 16  # lines of a block, with those that pad its shorter texts
LONG_LINES = 2048  # a text of more lines is a chain by itself
SEGMENT = 1 << 14  # lines whose features are held together
SLICE_BYTES = 1 << 18  # texts that are scored together, up to the one that passes it
MAX_FIT_LINES = 256
FIT_RUN = 64  # lines that are taken together from a longer text

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)


def _features(lines: list[bytes], seen: set[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(lines x N_LINE, line lengths) of lines that come after those in ``seen``, which takes them in."""
    out = np.zeros((len(lines), N_LINE), np.float32)
    size = np.zeros(len(lines), np.float64)
    for k, line in enumerate(lines):
        f, n = out[k], len(line)
        words = line.split()
        w = len(words)
        size[k] = n + 1
        f[0] = 1
        f[1] = np.log1p(n) / 8
        if not w:
            f[11] = 1
            continue
        at = np.bincount(np.frombuffer(line, np.uint8), minlength=128)
        f[2] = min(1.0, 5 * at[_SYMBOLS].sum() / n)
        f[3] = at[65:91].sum() / max(1, at[65:91].sum() + at[97:123].sum())
        f[4] = min(1.0, 5 * at[33] / n)
        f[5] = min(1.0, 5 * at[124] / n)
        f[6] = at[48:58].sum() / n
        f[7] = len(set(words)) / w
        f[8] = sum(a == b for a, b in zip(words, words[1:])) / w
        f[9] = min(2.0, n / w / 10)
        f[10] = line in seen
        f[12] = repeated_words(words) / w if w >= 6 else 0
        seen.add(line)
    return out, size


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(lines x N_LINE, line lengths); a text without lines has one empty line."""
    return _features(text.split(b"\n"), set())


def _beside(own: np.ndarray, after: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Node scores (... x lines): each line's own part, what the line before
    gives to the one after it, and what the line after gives to the one before."""
    out = own.copy()
    out[..., 1:] += after[..., :-1]
    out[..., :-1] += before[..., 1:]
    return out


def node_scores(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Scores (... x lines) of features (... x lines x N_LINE) under N_NODE
    weights: N_LINE for the line itself, for the line before it and for the one
    after it, which count nothing beyond the ends."""
    return _beside(*np.moveaxis(features @ weights.reshape(3, N_LINE).T, -1, 0))


def text_scores(text: bytes, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node scores, line lengths) of a text; the features of SEGMENT lines are held at a time."""
    lines, seen, w = text.split(b"\n"), set(), weights.reshape(3, N_LINE).T
    parts, size = np.zeros((3, len(lines))), np.zeros(len(lines))
    for at in range(0, len(lines), SEGMENT):
        f, size[at:at + SEGMENT] = _features(lines[at:at + SEGMENT], seen)
        parts[:, at:at + SEGMENT] = (f @ w).T
    return _beside(*parts), size


def forward_backward(node: np.ndarray, lengths: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of chains side by side (chains x steps node scores of label 1 against 0,
    their lengths, 2 x 2 edge scores): the marginals of label 1 (chains x steps),
    those of label pairs summed over the steps (chains x 2 x 2), log partitions."""
    n, steps = node.shape
    # scores up to their larger one, which is added back to the partition
    top = np.maximum(node, 0)
    psi = np.exp(np.stack([-top, node - top], 2))
    trans = np.exp(edge)
    alpha, beta = np.zeros((n, steps, 2)), np.ones((n, steps, 2))
    a, log_z = np.ones((n, 2)), np.zeros(n)
    for t in range(steps):
        on = t < lengths
        nxt = (a @ trans if t else a) * psi[:, t]
        total = nxt.sum(1)
        log_z += np.where(on, np.log(total) + top[:, t], 0)
        a = np.where(on[:, None], nxt / total[:, None], a)
        alpha[:, t] = a
    pairs = np.zeros((n, 2, 2))
    b = np.ones((n, 2))
    for t in range(steps - 1, 0, -1):
        on = t < lengths
        back = psi[:, t] * b
        p = alpha[:, t - 1, :, None] * trans * back[:, None, :]
        pairs += np.where(on[:, None, None], p / p.sum((1, 2), keepdims=True), 0)
        nb = back @ trans.T
        b = np.where(on[:, None], nb / nb.sum(1, keepdims=True), b)
        beta[:, t - 1] = b
    both = alpha * beta
    good = both[:, :, 1] / both.sum(2)
    return np.where(np.arange(steps) < lengths[:, None], good, 0), pairs, log_z


def chain_marginals(node: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """The marginals of label 1 along one chain, as ``forward_backward`` gives
    them, in two passes over plain numbers; four doubles a step are held."""
    n = len(node)
    top = np.maximum(node, 0)
    psi0, psi1 = np.exp(-top), np.exp(node - top)
    (t00, t01), (t10, t11) = np.exp(edge).tolist()
    alpha, out = np.zeros((n, 2)), np.zeros(n)
    a0 = a1 = None
    for at in range(0, n, SEGMENT):
        got = []
        for p0, p1 in zip(psi0[at:at + SEGMENT].tolist(), psi1[at:at + SEGMENT].tolist(), strict=True):
            n0, n1 = (p0, p1) if a0 is None else ((a0 * t00 + a1 * t10) * p0, (a0 * t01 + a1 * t11) * p1)
            a0, a1 = n0 / (n0 + n1), n1 / (n0 + n1)
            got.append((a0, a1))
        alpha[at:at + SEGMENT] = got
    b0 = b1 = 1.0
    for at in range((n - 1) // SEGMENT * SEGMENT, -1, -SEGMENT):
        got = []
        for p0, p1, (a0, a1) in zip(psi0[at:at + SEGMENT][::-1].tolist(), psi1[at:at + SEGMENT][::-1].tolist(),
                                    alpha[at:at + SEGMENT][::-1].tolist(), strict=True):
            got.append(a1 * b1 / (a0 * b0 + a1 * b1))
            p0, p1 = p0 * b0, p1 * b1
            n0, n1 = p0 * t00 + p1 * t01, p0 * t10 + p1 * t11
            b0, b1 = n0 / (n0 + n1), n1 / (n0 + n1)
        out[at:at + SEGMENT] = got[::-1]
    return out


@dataclass(frozen=True)
class Field:
    """Node weights, edge scores, and slope and offset of the last sigmoid."""

    node: tuple[float, ...]
    edge: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))
    slope: float = 1.0
    offset: float = 0.0


def _blocks(lengths: np.ndarray):
    """Indexes of chains of about equal length, block by block: at most BLOCK
    chains and, if there are several, CELLS lines with the padding."""
    block: list[int] = []
    for k in np.argsort(lengths, kind="stable").tolist():
        if block and (len(block) == BLOCK or (len(block) + 1) * lengths[k] > CELLS):
            yield np.array(block)
            block = []
        block.append(k)
    if block:
        yield np.array(block)


def _padded(rows: list[np.ndarray], steps: int) -> np.ndarray:
    out = np.zeros((len(rows), steps, *rows[0].shape[1:]), rows[0].dtype)
    for k, r in enumerate(rows):
        out[k, :len(r)] = r
    return out


def marginals(field: Field, node: list[np.ndarray]) -> list[np.ndarray]:
    """For each text's node scores, the marginals of its lines being good."""
    edge = np.array(field.edge)
    lengths = np.array([len(x) for x in node])
    out: list = [chain_marginals(x, edge) if len(x) > LONG_LINES else None for x in node]
    short = np.flatnonzero(lengths <= LONG_LINES)
    for b in _blocks(lengths[short]):
        block = short[b]
        good, _, _ = forward_backward(_padded([node[k] for k in block], int(lengths[block].max())), lengths[block], edge)
        for k, g in zip(block, good, strict=True):
            out[k] = g[:lengths[k]].copy()
    return out


def goodness(field: Field, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The length-weighted mean marginal of each text (its node scores, its line lengths)."""
    got = marginals(field, [x for x, _ in texts])
    return np.array([float(np.average(g, weights=s)) for g, (_, s) in zip(got, texts, strict=True)])


def _logit(q: np.ndarray) -> np.ndarray:
    q = np.clip(q, 1e-6, 1 - 1e-6)
    return np.log(q / (1 - q))


def fit_field(features: list[np.ndarray], labels: list[np.ndarray], rounds: int = 120, ridge: float = 1e-3) -> Field:
    """The field that makes the line labels likeliest, by Adam steps on the exact gradient."""
    lengths = np.array([len(x) for x in features])
    data = [(b, _padded([features[k] for k in b], int(lengths[b].max())),
             _padded([labels[k] for k in b], int(lengths[b].max()))) for b in _blocks(lengths)]
    total = lengths.sum()
    theta = np.zeros(N_NODE + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        grad = ridge * theta
        w, edge = theta[:N_NODE], theta[N_NODE:].reshape(2, 2)
        for b, x, y in data:
            good, pairs, _ = forward_backward(node_scores(x, w), lengths[b], edge)
            off = good - y
            for k, (part, of) in enumerate(((x, off), (x[:, :-1], off[:, 1:]), (x[:, 1:], off[:, :-1]))):
                grad[k * N_LINE:(k + 1) * N_LINE] += np.einsum("ctf,ct->f", part, of) / total
            inside = np.arange(1, y.shape[1]) < lengths[b][:, None]
            y0, y1 = y[:, :-1], y[:, 1:]
            for i in range(2):
                for j in range(2):
                    seen = ((y0 == i) & (y1 == j) & inside).sum()
                    grad[N_NODE + 2 * i + j] += (pairs[:, i, j].sum() - seen) / total
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta -= 0.2 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    e = theta[N_NODE:].reshape(2, 2).tolist()
    return Field(tuple(theta[:N_NODE].tolist()), (tuple(e[0]), tuple(e[1])))


def _fit_lines(lines: int) -> np.ndarray:
    """The lines of a text to learn from: all, or of more than MAX_FIT_LINES
    that many in runs of FIT_RUN, spread evenly from the first line to the last."""
    if lines <= MAX_FIT_LINES:
        return np.arange(lines)
    starts = np.linspace(0, lines - FIT_RUN, MAX_FIT_LINES // FIT_RUN).astype(int)
    return (starts[:, None] + np.arange(FIT_RUN)).ravel()


def learn(labelled: DataFrame, rounds: int = 120) -> Field | None:
    """The field learned from ``labelled`` (text, label 0 or 1, weight: the
    documents that a row stands for); nothing if one label is missing.

    The features of at most MAX_FIT_LINES lines of each text, taken over the
    whole of it, go through the driver, so the caller bounds the rows."""
    def setup():
        def each(texts):
            got = [(f[at], s[at]) for f, s in map(line_features, texts) for at in [_fit_lines(len(f))]]
            return pa.StructArray.from_arrays(
                [pa.array([f.tobytes() for f, _ in got], pa.binary()), pa.array([s.tobytes() for _, s in got], pa.binary())],
                ["f", "s"])
        return each

    feats = per_text(setup, "f binary, s binary")(text_bytes(F.col("text")))
    got = labelled.where("text is not null").select("label", "weight", feats.alias("x")).select("label", "weight", "x.f", "x.s").toArrow().to_pylist()
    texts = [(np.frombuffer(r["f"], np.float32).reshape(-1, N_LINE), np.frombuffer(r["s"])) for r in got]
    y, weight = (np.array([r[c] for r in got]) for c in ("label", "weight"))
    if len(set(y.tolist())) < 2:
        return None
    labels = [np.full(len(f), v, float) for (f, _), v in zip(texts, y, strict=True)]
    first = fit_field([f for f, _ in texts], labels, rounds)
    for lab, good, v in zip(labels, marginals(first, [node_scores(f, np.array(first.node)) for f, _ in texts]), y, strict=True):
        if v == 0:
            lab[:] = good > 0.5
            lab[np.argmin(good)] = 0
    field = fit_field([f for f, _ in texts], labels, rounds)
    w = np.array(field.node)
    slope, offset = fit_sigmoid(_logit(goodness(field, [(node_scores(f, w), s) for f, s in texts])), y, weight / weight.sum())
    return Field(field.node, field.edge, slope, offset)


RESULT = "score double, goodness double, n_lines long"


def _setup(field: Field):
    w = np.array(field.node)

    def each(texts: list[bytes]) -> pa.Array:
        good, lines = [], []
        part, held = [], 0
        for k, t in enumerate(texts):
            part.append(text_scores(t, w))
            held += len(t)
            if held > SLICE_BYTES or k == len(texts) - 1:
                good.append(goodness(field, part))
                lines += [len(x) for x, _ in part]
                part, held = [], 0
        q = np.concatenate(good) if good else np.zeros(0)
        score = 1 / (1 + np.exp(-(field.slope * _logit(q) + field.offset)))
        return pa.StructArray.from_arrays([pa.array(score), pa.array(q), pa.array(lines, pa.int64())],
                                          ["score", "goodness", "n_lines"])
    return each


def quality(text: Column, field: Field) -> Column:
    """Struct ``RESULT`` of a text; null and empty texts are one empty line.
    What a task holds beyond its texts is some 40 bytes for each line of the longest."""
    return per_text(lambda: _setup(field), RESULT)(text_bytes(text))


def score(docs: DataFrame, field: Field, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted, goodness and n_lines of every document, one row
    per input row; other columns are ignored."""
    return (docs.select("doc_id", quality(F.col("text"), field).alias("_q"))
            .select("doc_id", F.col("_q.score").alias("score"), (F.col("_q.score") >= threshold).cast("int").alias("predicted"),
                    F.col("_q.goodness").alias("goodness"), F.col("_q.n_lines").alias("n_lines")))
