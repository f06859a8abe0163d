"""Document quality by co-training of two views.

View A reads the text: style (case, punctuation, repetition and the like) and
words that tell good from bad. View B reads metadata only: language, source,
length. Each view is a logistic regression. In every round each view labels
all documents without a label that it is sure of, by probabilities calibrated
on held-out labels, and hands them to the other view; then both are fitted
again. In the end a third regression, on the held-out labels, combines the two
calibrated views. Only the labelled documents are a sample. Sketches of it and
of all documents without a label are written once; a pass over them adds up
losses and gradients, and coefficients alone reach the driver. Scoring is one
pass over all documents, in place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.llm.decontaminate import _Lookup as Lookup
from paymart.llm.decontaminate import plain_words
from paymart.llm.shared import broadcast_if_small, filtered_in_arrow, staged
from paymart.llm.words import hash_words, mix, utf8_column

LABELLED_ROWS = 12_000  # most labelled documents that the views are fitted on
ROUNDS = 3
SURE = 0.95
WORDS = 512  # telling words in view A
BINS = 8
HASHED = 64  # slots for languages and sources

SKETCH = "doc_id long, good double, held boolean, style binary, words binary, lang string, source string, n_chars long"
KINDS = ("good", "bad", "handed_good", "handed_bad")
FEATURES = (
    "doc_id long, good double, held boolean, train boolean, y_a double, y_b double,"
    " at_a binary, value_a binary, at_b binary, value_b binary"
)
FEATURE_NAMES = [c.split()[0] for c in FEATURES.split(",")]
SCORES = "doc_id long, p_content double, p_metadata double, p_good double, keep boolean"
UPPER, LOWER, DIGIT, PUNCT, SPACE = (np.zeros(256, bool) for _ in range(5))
UPPER[65:91] = LOWER[97:123] = DIGIT[48:58] = True
PUNCT[33:48] = PUNCT[58:65] = PUNCT[91:97] = PUNCT[123:127] = True
SPACE[[32, *range(9, 14)]] = True
RARE_MARKS = np.zeros(256, bool)  # punctuation that prose has little of
RARE_MARKS[[ord(c) for c in "#$%&*+/<=>@\\^_|~!"]] = True


def style(column) -> np.ndarray:
    """Shares and means that describe how each text is written."""
    data, offsets = utf8_column(column)
    sizes = np.diff(offsets)
    words = hash_words(data, offsets)
    n, cuts = words.counts, words.offsets
    per = np.maximum(sizes, 1)

    def share(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[data])])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / per

    upper, lower = share(UPPER), share(LOWER)
    same = np.zeros(len(words.hashes), bool)  # equal to the word before
    same[1:] = words.hashes[1:] == words.hashes[:-1]
    same[cuts[:-1][n > 0]] = False
    sums = np.concatenate([[0], np.cumsum(same)])
    again = (sums[cuts[1:]] - sums[cuts[:-1]]) / np.maximum(n, 1)
    distinct, top, triples = np.ones(len(n)), np.zeros(len(n)), np.ones(len(n))
    three, inside = words.windows(3)
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if b > a:
            _, counts = np.unique(words.hashes[a:b], return_counts=True)
            distinct[i], top[i] = len(counts) / (b - a), counts.max() / (b - a)
            windows = three[a:b][inside[a:b]]
            if len(windows):
                triples[i] = len(np.unique(windows)) / len(windows)
    newline = np.zeros(256, bool)
    newline[10] = True
    return np.column_stack(
        [
            upper / np.maximum(upper + lower, 1e-9), share(DIGIT), share(PUNCT), share(RARE_MARKS), share(SPACE),
            np.log1p(n), sizes / np.maximum(n, 1), again, distinct, top, triples, share(newline), np.sqrt(np.maximum(n, 1)) * distinct,
        ]
    ).astype(np.float32)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Style and distinct plain words of documents; a fifth of the labelled ids is held out."""
    for batch in _pieces(batches):
        words = plain_words(batch.column("text"))
        cuts = words.offsets
        distinct = [np.unique(words.hashes[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        fold = mix(batch.column("doc_id").fill_null(0).to_numpy().astype(np.int64).view(np.uint64)) % np.uint64(5)
        known = batch.column("good").is_valid().to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("good"),
                pa.array(known & (fold == 0)),
                pa.array([x.tobytes() for x in style(batch.column("text"))], pa.binary()),
                pa.array(distinct, pa.binary()),
                batch.column("lang"),
                batch.column("source"),
                batch.column("n_chars"),
            ],
            ["doc_id", "good", "held", "style", "words", "lang", "source", "n_chars"],
        )


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Coefficients (the last is the intercept) by Newton's method."""
    x = np.column_stack([x, np.ones(len(x), x.dtype)])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        gradient, hessian = penalty * beta, np.diag(penalty)
        for first in range(0, len(x), 2048):  # in pieces, as copies of the whole matrix are large
            part = slice(first, first + 2048)
            xs = x[part].astype(np.float64)
            p = sigmoid(xs @ beta)
            gradient = gradient + xs.T @ (weight[part] * (p - y[part]))
            hessian = hessian + (xs * (weight[part] * p * (1 - p))[:, None]).T @ xs
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def _bins(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """One column per bin and feature."""
    out = []
    for column, edges in zip(values.T, borders, strict=True):
        out.append(np.searchsorted(edges, column, "right")[:, None] == np.arange(BINS)[None, :])
    return np.hstack(out).astype(np.float32)


def _slots(column) -> np.ndarray:
    """A one-hot column of hashed strings; null is an empty string."""
    data, offsets = utf8_column(column)
    out = np.zeros((len(offsets) - 1, HASHED))
    for i in range(len(out)):
        h = hash_words(np.where(data[offsets[i] : offsets[i + 1]] == 32, 95, data[offsets[i] : offsets[i + 1]]), np.array([0, offsets[i + 1] - offsets[i]]))
        key = h.hashes[0] if len(h.hashes) else np.uint64(0)
        out[i, int(mix(np.array([key], np.uint64))[0] % np.uint64(HASHED))] = 1.0
    return out


class _SlotCache:
    """Slots of strings that come again and again."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, values: list[str | None]) -> np.ndarray:
        for value in dict.fromkeys(v or "" for v in values):
            if value not in self.known:
                self.known[value] = int(_slots(pa.array([value], pa.string())).argmax())
        out = np.zeros((len(values), HASHED))
        out[np.arange(len(values)), [self.known[v or ""] for v in values]] = 1.0
        return out


@dataclass
class CoTrained:
    """Both views, their calibration and their combination."""

    share: float  # of good documents among the labelled
    threshold: float = 0.5
    fitted: bool = False
    style_borders: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    style_scale: np.ndarray = field(default_factory=lambda: np.zeros((2, 0)))
    length_borders: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    content: np.ndarray = field(default_factory=lambda: np.zeros(0))
    metadata: np.ndarray = field(default_factory=lambda: np.zeros(0))
    calibration: tuple[np.ndarray, np.ndarray] = (np.zeros(2), np.zeros(2))
    combination: np.ndarray = field(default_factory=lambda: np.zeros(3))

    def content_matrix(self, styles: np.ndarray, present: np.ndarray) -> np.ndarray:
        scaled = np.clip((styles - self.style_scale[0]) / self.style_scale[1], -5, 5)
        return np.hstack([scaled.astype(np.float32), _bins(styles, self.style_borders), present])

    def metadata_matrix(self, lang: list, source: list, n_chars: list, slots: _SlotCache) -> np.ndarray:
        length = np.log1p(np.array([[max(n or 0, 0)] for n in n_chars], np.float64).reshape(-1, 1))
        missing = np.array([[n is None] for n in n_chars], np.float64).reshape(-1, 1)
        return np.hstack([_bins(length, self.length_borders), length / 10, missing, slots(lang), slots(source)])

    def views(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated log odds of both views."""
        out = []
        for x, beta, (slope, shift) in zip((a, b), (self.content, self.metadata), self.calibration, strict=True):
            out.append(slope * (x @ beta[:-1] + beta[-1]) + shift)
        return out[0], out[1]

    def combined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.combination[0] * a + self.combination[1] * b + self.combination[2]


def _words_present(words: list[bytes], chosen: np.ndarray) -> np.ndarray:
    """Which of the chosen words each document of a sketch holds."""
    keys = np.frombuffer(b"".join(words), np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) // 8 for w in words])
    out = np.zeros((len(words), len(chosen)), np.float32)
    at, number = Lookup(chosen).find(keys)
    out[owner[at], number] = 1.0
    return out


def _matrices(batch: pa.RecordBatch, model: CoTrained, slots: _SlotCache) -> tuple[np.ndarray, np.ndarray]:
    """Both views of sketched documents."""
    styles = np.frombuffer(b"".join(batch.column("style").to_pylist()), np.float32).reshape(batch.num_rows, -1)
    a = model.content_matrix(styles.astype(np.float64), _words_present(batch.column("words").to_pylist(), model.words))
    return a, model.metadata_matrix(*(batch.column(c).to_pylist() for c in ("lang", "source", "n_chars")), slots)


def _targets(batch: pa.RecordBatch, history: list[CoTrained], slots: _SlotCache) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows train, and the label each row has for view A and for view B (nan for none).

    A pool document has the first label that the other view was sure of in the
    rounds so far, so nothing but the fitted views passes from round to round.
    """
    good = batch.column("good").to_numpy(zero_copy_only=False).astype(np.float64)
    held = batch.column("held").to_numpy(zero_copy_only=False)
    known = ~np.isnan(good)
    train = known & ~held
    labels = [np.where(train, good, np.nan) for _ in range(2)]
    for model in history:
        sure = [sigmoid(v) for v in model.views(*_matrices(batch, model, slots))]
        for giver, taker in ((0, 1), (1, 0)):
            free = ~known & np.isnan(labels[taker])
            labels[taker][free & (sure[giver] >= SURE)] = 1.0
            labels[taker][free & (1 - sure[giver] >= SURE)] = 0.0
    return train, labels[0], labels[1]


def _word_counts(history: list[CoTrained]):
    """Documents of each word (null: of all) by kind: labelled good and bad, handed good and bad."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _SlotCache()
        for batch in _pieces(batches, 2048):
            train, target, _ = _targets(batch, history, slots)
            use = ~np.isnan(target)
            kind = 2 * ~train[use] + (target[use] == 0)
            words = [w for w, u in zip(batch.column("words").to_pylist(), use, strict=True) if u]
            keys, number = np.unique(np.frombuffer(b"".join(words), np.uint64), return_inverse=True)
            owner = np.repeat(kind, [len(w) // 8 for w in words]).astype(np.int64)
            counts = np.bincount(number * 4 + owner, minlength=4 * len(keys)).reshape(-1, 4)
            counts = np.vstack([counts, np.bincount(kind, minlength=4)[None, :]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([*keys.view(np.int64).tolist(), None], pa.int64()), *(pa.array(c.astype(np.int64)) for c in counts.T)],
                ["word", *KINDS],
            )

    return run


def handed_weights(counts: list[int]) -> np.ndarray:
    """Weights of handed good and bad labels: a half each, and together at most half of the labelled of the kind.

    So all of them count, whatever their number, and the share of good ones stays as labelled.
    """
    labelled, handed = np.array(counts[:2], np.float64), np.array(counts[2:], np.float64)
    return np.minimum(0.5, 0.5 * labelled / np.maximum(handed, 1))


def telling_words(sketch: DataFrame, history: list[CoTrained], most: int = WORDS) -> np.ndarray:
    """Words whose share of documents differs most surely between good and bad ones, among all documents with a label."""
    counts = sketch.mapInArrow(_word_counts(history), f"word long, {', '.join(f'{k} long' for k in KINDS)}")
    counts = staged(counts.groupBy("word").agg(*(F.sum(k).alias(k) for k in KINDS)), "word-counts")
    total = counts.where("word IS NULL").first()
    weights = handed_weights([total[k] for k in KINDS])
    n_good, n_bad = (total[KINDS[i]] + float(weights[i]) * total[KINDS[2 + i]] for i in (0, 1))
    good, bad = (F.col(KINDS[i]) + F.lit(float(weights[i])) * F.col(KINDS[2 + i]) for i in (0, 1))
    both = (good + bad + 1) / (n_good + n_bad + 2)
    z = (good / max(n_good, 1) - bad / max(n_bad, 1)) / F.sqrt(both * (1 - both) * (1 / max(n_good, 1) + 1 / max(n_bad, 1)))
    sure = counts.where("word IS NOT NULL").select("word", (good + bad).alias("n"), F.abs(z).alias("z")).where("n >= 8 AND z > 4")
    rows = sure.orderBy(F.desc("z"), "word").limit(most).collect()
    return np.sort(np.array([r["word"] for r in rows], np.int64).view(np.uint64))


def _features(model: CoTrained, history: list[CoTrained]):
    """Rows with a label for a view or held out, each view as its entries that are not zero."""

    def sparse(x: np.ndarray) -> list[pa.Array]:
        row, column = np.nonzero(x)
        values, column = x[row, column].astype(np.float32), column.astype(np.uint16)
        cuts = np.searchsorted(row, np.arange(len(x) + 1))
        return [pa.array([part[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()) for part in (column, values)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _SlotCache()
        for batch in _pieces(batches, 1024):
            train, *labels = _targets(batch, history, slots)
            held = batch.column("held").to_numpy(zero_copy_only=False)
            use = pa.array(held | ~np.isnan(labels[0]) | ~np.isnan(labels[1]))
            a, b = _matrices(batch, model, slots)
            columns = [batch.column("doc_id"), batch.column("good"), batch.column("held"), pa.array(train)]
            columns += [pa.array(y, from_pandas=True) for y in labels] + sparse(a) + sparse(b)
            yield pa.RecordBatch.from_arrays(columns, FEATURE_NAMES).filter(use)

    return run


def _entries(batch: pa.RecordBatch, view: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of a view's entries."""
    parts = batch.column(f"at_{view}").to_pylist()
    row = np.repeat(np.arange(len(parts)), [len(x) // 2 for x in parts])
    values = np.frombuffer(b"".join(batch.column(f"value_{view}").to_pylist()), np.float32).astype(np.float64)
    return row, np.frombuffer(b"".join(parts), np.uint16).astype(np.int64), values


def _margins(entries: tuple, n: int, beta: np.ndarray) -> np.ndarray:
    row, column, value = entries
    return np.bincount(row, weights=beta[column] * value, minlength=n) + beta[-1]


def _even(x: np.ndarray) -> np.ndarray:
    """Multiples of 2^-24: their sums are exact and do not depend on the order of rows and tasks."""
    return np.rint(x * 16777216.0) / 16777216.0


def _losses(betas: list[np.ndarray], weights: list[np.ndarray]):
    """Each view's loss, gradient and bound of the Hessian's diagonal over the rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(1 + 2 * len(beta)) for beta in betas]
        for batch in _pieces(batches, 4096):
            train = batch.column("train").to_numpy(zero_copy_only=False)
            for view, beta, handed, total in zip("ab", betas, weights, sums, strict=True):
                y = batch.column(f"y_{view}").to_numpy(zero_copy_only=False).astype(np.float64)
                use, k = ~np.isnan(y), len(beta)
                y = np.nan_to_num(y)
                weight = np.where(use, np.where(train, 1.0, np.where(y == 1, handed[0], handed[1])), 0.0)
                entries = row, column, value = _entries(batch, view)
                margin = _margins(entries, len(y), beta)
                error = weight * (sigmoid(margin) - y)
                total[0] += _even(weight * (np.logaddexp(0, margin) - y * margin)).sum()
                total[1:k] += np.bincount(column, weights=_even(error[row] * value), minlength=k - 1)
                total[k] += _even(error).sum()
                total[k + 1 : -1] += np.bincount(column, weights=_even(weight[row] * value * value / 4), minlength=k - 1)
                total[-1] += _even(weight / 4).sum()
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in sums], ["a", "b"])

    return run


def _descend(beta: np.ndarray, ridge: float = 1.0, steps: int = 30, memory: int = 10):
    """Asks for sums of ``_losses`` at coefficients, by limited-memory BFGS; returns the best coefficients."""
    k = len(beta)
    penalty = np.full(k, ridge)
    penalty[-1] = 1e-6

    def with_penalty(sums: np.ndarray, at: np.ndarray) -> tuple[float, np.ndarray]:
        return sums[0] + (penalty * at * at).sum() / 2, sums[1 : k + 1] + penalty * at

    sums = yield beta
    loss, gradient = with_penalty(sums, beta)
    diagonal, pairs = sums[k + 1 :] + penalty, []
    for _ in range(steps):
        step, factors = gradient.copy(), []
        for s, d, r in reversed(pairs):
            factors.append(r * (s @ step))
            step -= factors[-1] * d
        step /= diagonal
        for (s, d, r), f in zip(pairs, reversed(factors), strict=True):
            step += s * (f - r * (d @ step))
        gain = gradient @ step
        if gain < 1e-5 * (1 + abs(loss)):
            break
        size = 1.0
        while True:
            new = beta - size * step
            new_loss, new_gradient = with_penalty((yield new), new)
            if new_loss <= loss - 1e-4 * size * gain:
                break
            size /= 2
            if size < 1e-3:
                return beta
        s, d = new - beta, new_gradient - gradient
        if s @ d > 1e-12:
            pairs = [*pairs, (s, d, 1 / (s @ d))][-memory:]
        beta, loss, gradient = new, new_loss, new_gradient
    return beta


def fit_views(features: DataFrame, starts: list[np.ndarray], weights: list[np.ndarray]) -> list[np.ndarray]:
    """Logistic regressions of both views over all rows; one pass serves both."""
    fits = [_descend(start) for start in starts]
    asked, done = [next(fit) for fit in fits], [None, None]
    while any(d is None for d in done):
        rows = features.mapInArrow(_losses(asked, weights), "a binary, b binary").collect()
        for i, fit in enumerate(fits):
            if done[i] is None:
                try:
                    sums = sum((np.frombuffer(r[i], np.float64) for r in rows), np.zeros(1 + 2 * len(asked[i])))
                    asked[i] = fit.send(sums)
                except StopIteration as end:
                    done[i] = asked[i] = end.value
    return done


def _held_scores(betas: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, 4096):
            raw = [pa.array(_margins(_entries(batch, v), batch.num_rows, b)) for v, b in zip("ab", betas, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("good"), *raw], ["doc_id", "good", "a", "b"])

    return run


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often values of each style feature and of the length fall into slots of 1/128 of their size."""
    for batch in _pieces(batches, 4096):
        styles = np.frombuffer(b"".join(batch.column("style").to_pylist()), np.float32).reshape(batch.num_rows, -1)
        length = np.log1p(np.array([max(n or 0, 0) for n in batch.column("n_chars").to_pylist()], np.float32))
        for i, values in enumerate([*styles.T, length]):
            slots, counts = np.unique(np.ascontiguousarray(values).view(np.uint32) >> np.uint32(16), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * len(slots), pa.int32()), pa.array(slots.astype(np.int32)), pa.array(counts)], ["feature", "slot", "n"]
            )


def _scales(model: CoTrained, sketch: DataFrame) -> None:
    """Bin borders, means and deviations over all sketched documents."""
    counted = sketch.mapInArrow(_histogram, "feature int, slot int, n long").groupBy("feature", "slot").agg(F.sum("n").alias("n"))
    found: dict[int, list[tuple[int, int]]] = {}
    for r in counted.collect():
        found.setdefault(r["feature"], []).append((r["slot"], r["n"]))
    borders, means, deviations = [], [], []
    for i in sorted(found):
        slots, n = np.array(sorted(found[i])).T
        values = (slots.astype(np.uint32) << np.uint32(16)).view(np.float32).astype(np.float64)
        share = np.cumsum(n) / n.sum()
        borders.append(values[np.minimum(np.searchsorted(share, np.arange(1, BINS) / BINS), len(values) - 1)])
        means.append((values * n).sum() / n.sum())
        deviations.append(np.sqrt((n * (values - means[-1]) ** 2).sum() / n.sum()))
    model.style_borders, model.length_borders = np.array(borders[:-1]), np.array(borders[-1:])
    model.style_scale = np.stack([means[:-1], np.array(deviations[:-1]) + 1e-6])


def co_train(sketch: DataFrame, rounds: int = ROUNDS) -> CoTrained:
    """Fits both views on sketched rows (``good`` is 1.0, 0.0 or null for the pool), with every label that a view is sure of."""
    counted = sketch.where("good IS NOT NULL").groupBy("held", "good").count().collect()
    n = {(r["held"], r["good"]): r["count"] for r in counted}
    total = sum(n.values())
    model = CoTrained(sum(c for (_, good), c in n.items() if good == 1.0) / total if total else 1.0)
    if len(n) < 4:
        return model  # too few labels to tell apart
    _scales(model, sketch)
    history: list[CoTrained] = []
    for _ in range(rounds):
        model = replace(model, words=telling_words(sketch, history))
        features = staged(sketch.mapInArrow(_features(model, history), FEATURES), "features")
        weights = []
        for y in ("y_a", "y_b"):
            kinds = {(r["train"], r[y]): r["count"] for r in features.where(f"{y} IS NOT NULL").groupBy("train", y).count().collect()}
            weights.append(handed_weights([kinds.get((train, kind), 0) for train in (True, False) for kind in (1.0, 0.0)]))
        sizes = model.style_scale.shape[1] + model.style_borders.shape[0] * BINS + len(model.words), BINS + 2 + 2 * HASHED
        model.content, model.metadata = fit_views(features, [np.zeros(k + 1) for k in sizes], weights)
        held = features.where("held").mapInArrow(_held_scores([model.content, model.metadata]), "doc_id long, good double, a double, b double")
        rows = np.array(sorted(tuple(r) for r in held.groupBy("doc_id", "good", "a", "b").count().collect()), np.float64)
        y, raw, weight = rows[:, 1], rows[:, 2:4].T, rows[:, 4]
        calibration = []
        for score in raw:
            slope, shift = fit_logistic(score[:, None], y, weight, ridge=1e-3)
            calibration.append(np.array([max(slope, 0.0), shift]))
        model.calibration = tuple(calibration)
        history.append(model)
    views = np.column_stack([slope * score + shift for score, (slope, shift) in zip(raw, model.calibration, strict=True)])
    model.combination = fit_logistic(views, y, weight, ridge=1e-2)
    model.threshold = best_threshold(sigmoid(model.combined(*views.T)), y)
    model.fitted = True
    return model


def best_threshold(p: np.ndarray, y: np.ndarray, least_kept: float = 0.99) -> float:
    """Where the mean of both kinds' hit rates is largest, with enough good ones kept; in the middle between two values."""
    order = np.argsort(p, kind="stable")
    p, y = p[order], y[order]
    below = np.cumsum(1 - y) / (1 - y).sum()  # bad ones rejected
    above = 1 - np.cumsum(y) / y.sum()  # good ones kept
    rate = np.where(np.append(p[1:] > p[:-1], False) & (above >= least_kept), below + above, -1.0)
    best = int(rate.argmax())
    if rate[best] < 0:
        return float(p[0])
    return float((p[best] + p[min(best + 1, len(p) - 1)]) / 2)


def is_good() -> Column:
    """Of good quality and not toxic; null where both are unknown."""
    return (F.coalesce("quality", F.lit(1)) == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.coalesce("quality", "toxic").isNotNull()


def _clean(docs: DataFrame) -> DataFrame:
    """doc_id, text, lang, source, n_chars; what is missing is null."""
    kinds = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}
    return docs.select(*[(F.col(c) if c in docs.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])


def train(
    docs: DataFrame, labels: DataFrame, good: Column, labelled_rows: int = LABELLED_ROWS, pool_rows: int | None = None
) -> CoTrained:
    """Fits on at most so many labelled documents, the first by a hash of the id, and on all without a label.

    ``labels`` has doc_id and what ``good`` needs. A label without a document,
    an id or a value is not used; of several labels for one id the worst counts.
    ``pool_rows`` bounds the ids without a label, for trials; rows without an
    id are left out then.
    """
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), good.cast("double").alias("good")).dropna()
    ids = staged(ids.groupBy("doc_id").agg(F.min("good").alias("good")), "labels")
    clean = _clean(docs)
    order = F.xxhash64("doc_id")
    some = staged(ids.orderBy(order, "doc_id").limit(labelled_rows), "sampled")
    known = ids.join(F.broadcast(some.select("doc_id", F.lit(True).alias("chosen"))), "doc_id", "left")
    rows = clean.join(broadcast_if_small(known, 17), "doc_id", "left").where("good IS NULL OR chosen")
    if pool_rows is not None:
        pool = clean.select("doc_id").dropna().distinct().join(broadcast_if_small(ids, 16), "doc_id", "left_anti")
        pool = pool.orderBy(order, "doc_id").limit(pool_rows)
        rows = rows.join(broadcast_if_small(some.select("doc_id").unionByName(pool), 16), "doc_id", "left_semi")
    rows = rows.select("doc_id", "good", "text", "lang", "source", "n_chars")
    return co_train(staged(rows.mapInArrow(_sketch, SKETCH), "sketch"))


def _scorer(model: CoTrained):
    """p_content, p_metadata and p_good of record batches with the clean columns."""
    slots = _SlotCache()

    def score(text, lang, source, n_chars) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(text)
        if not model.fitted or not n:
            same = np.full(n, model.share)
            return same, same, same
        words, lookup = plain_words(text), Lookup(model.words)
        present = np.zeros((n, len(model.words)))
        at, number = lookup.find(words.hashes)
        present[words.owner()[at], number] = 1.0
        a = model.content_matrix(style(text).astype(np.float64), present)
        b = model.metadata_matrix(lang.to_pylist(), source.to_pylist(), n_chars.to_pylist(), slots)
        views = model.views(a, b)
        return sigmoid(views[0]), sigmoid(views[1]), sigmoid(model.combined(*views))

    return score


def _least(model: CoTrained, least: float | None) -> float:
    if least is not None:
        return least
    return model.threshold if model.fitted else 0.0  # unfitted: nothing is rejected


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def score_documents(docs: DataFrame, model: CoTrained, least: float | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, p_content, p_metadata, p_good, keep (p_good of at least ``least``).

    ``least`` is by default where the held-out labels were told apart best.
    Null texts are empty; null or missing metadata are a kind of their own.
    Without enough labels every document has the share of good labels, or 1
    without any. Extra columns are not read. An empty table gives no rows.
    """
    least = _least(model, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(model)
        for batch in _pieces(batches):
            content, metadata, p = score(*(batch.column(c) for c in ("text", "lang", "source", "n_chars")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(content), pa.array(metadata), pa.array(p), pa.array(p >= least)],
                ["doc_id", "p_content", "p_metadata", "p_good", "keep"],
            )

    return _clean(docs).mapInArrow(run, SCORES)


def kept(docs: DataFrame, model: CoTrained, least: float | None = None) -> DataFrame:
    """The rows of ``docs`` that ``score_documents`` keeps, with all their columns, whatever their names.

    Each row is judged by itself, also where rows repeat, share an id or have
    none; nulls, empty and very long texts as in ``score_documents``. An empty
    table gives no rows.
    """
    least = _least(model, least)
    names = docs.columns
    kinds = {"text": pa.string(), "lang": pa.string(), "source": pa.string(), "n_chars": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(model)
        for batch in _pieces(batches):
            columns = [
                batch.column(names.index(c)).cast(k) if c in names else pa.nulls(batch.num_rows, k) for c, k in kinds.items()
            ]
            yield batch.filter(pa.array(score(*columns)[2] >= least))

    return filtered_in_arrow(docs, run)
