"""Causal self-attention language model on subword ids, trained in numpy, scored in overlapping windows.

A text is the lower-cased words between white space and one end. Each word becomes
subword ids by the first ``VOCABULARY`` ranks of a public byte-level vocabulary.

The model: one layer of masked attention with a bias per distance; its output, the current id and the
one before make a hidden layer, and that the logits of the next id. Logits start from the counted shares of
id pairs within the words of all training texts. The softmax has two steps, a group of ids and an id of the group, so it is
normalised over the vocabulary and costs about twice the root of its size.

What is learned covers every training text: counts of its words, summed per task and then by a shuffle, from
them counts of pairs of ids, and the weights. These start from a fit on a sample, training texts in the order of a hash, ``FIT_TEXTS``
and ``FIT_IDS`` at most. From there every task trains a copy on all training texts it reads, each id once, and
the copies are averaged by the number of their ids; parts of the weights meet in a shuffle, and the driver sees one sum of each.

Scoring: windows of ``CONTEXT + STRIDE`` ids, ``STRIDE`` apart; every id is scored once, from at
least ``CONTEXT`` ids before it (all of them at the start). The unigram base score looks up
frequent words, by their share of all, in a broadcast table; all others are joined by a shuffle.

Defined cases: a null or empty text is the end alone; repeated rows are scored one by one, and
counted as often as they come; without training texts counts are zero and the model is the uniform
one; null ids are training rows; an empty table gives an empty result. The result has the columns listed
at ``score_texts``; others of the input are dropped.
"""

from __future__ import annotations

import base64
import math
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from pledgeflow.llm.common import as_batch, parts, stored, words

VOCABULARY = 2048
#: Ids of a group; ids before a stretch, ids of a stretch, width of attention, of the hidden layer.
GROUP = 45
CONTEXT, STRIDE, WIDTH, HIDDEN = 8, 32, 16, 32
#: Texts and ids that the start of the weights is fitted on; numbers of the weights that are averaged together.
FIT_TEXTS, FIT_IDS = 2_000, 2_000_000
PART_WEIGHTS = 1 << 13
STEPS, BATCH, RATE = 1500, 192, 0.02
#: First rate of the pass over all training texts, which starts from the weights fitted on the sample.
LESSON_RATE = 0.004
#: A word with one of so many parts of all words is frequent; its probability is broadcast. So many words at most
#: can be, of as many bytes as they have on average in the texts; in natural text it is a twentieth of that.
FREQUENT_SHARE = 4_000_000
#: Words besides the frequent ones that a Python worker keeps the ids of; distinct words a task counts before it passes them on;
#: words scored at a time, windows of ids at a time; scores of texts that are kept.
CACHE_WORDS, FLUSH_WORDS, BLOCK_WORDS, PART_WINDOWS, KEPT_SCORES = 200_000, 250_000, 60_000, 48, 20_000
#: Windows whose targets are put in the order of groups at a time.
SOME_WINDOWS = 1024
#: Bytes of the largest block that a process keeps when it is freed.
KEPT_BLOCK = 8 << 20
#: Stands for the end among words.
END = b""


class Subwords:
    """Ids of words; ``end`` is the id after the last word and before the first."""

    def __init__(self, path: str, pattern: str, size: int = VOCABULARY):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        ranks = {token: n for token, n in ranks.items() if n < size}
        self.encoding = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.begins = np.zeros(size, bool)
        self.begins[[n for token, n in ranks.items() if token.startswith(b" ")]] = True
        self.end, self.size = size, size + 1

    def each(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some words, and how many each has.

        All words go to the tokenizer in one call; an id that begins with a space begins a word.
        """
        texts = [" " + w.decode("utf-8", "replace") for w in found]
        ids = np.array(self.encoding.encode_ordinary("".join(texts)), np.uint16)
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) == len(found):
            return ids, np.diff(starts, append=len(ids))
        made = [self.encoding.encode_ordinary(text) for text in texts]
        return np.array([i for one in made for i in one], np.uint16), np.array([len(one) for one in made])

    def __call__(self, found: list[bytes]) -> np.ndarray:
        """The ids of a text with the end."""
        return np.append(self.each(found)[0], np.uint16(self.end)).astype(np.int32)


class Lexicon:
    """Words by number, with ids and base score of each; the frequent words first, then those met lately.

    ``score`` is not a number for a word that is not among the frequent ones.
    """

    def __init__(self, subwords: Subwords, frequent: list[bytes], score: np.ndarray, known: np.ndarray):
        self.subwords, self.frequent = subwords, len(frequent)
        self.numbers = {w: n for n, w in enumerate(frequent)}
        if END not in self.numbers:
            frequent, score, known = [*frequent, END], np.append(score, np.nan), np.append(known, 0)
            self.numbers[END] = self.frequent
            self.frequent += 1
        ids, lengths = subwords.each([w for w in frequent if w != END])
        place = self.numbers[END]
        ids = np.insert(ids, lengths[:place].sum(), subwords.end)
        lengths = np.insert(lengths, place, 1)
        self.ids, self.used = np.resize(ids, max(1024, 2 * len(ids))), len(ids)
        room = self.frequent + CACHE_WORDS + 1
        self.length = np.zeros(room, np.int64)
        self.start = np.zeros(room, np.int64)
        self.length[: self.frequent] = lengths
        self.start[: self.frequent] = np.cumsum(lengths) - lengths
        self.score, self.known = np.full(room, np.nan), np.zeros(room, np.int64)
        self.score[: self.frequent], self.known[: self.frequent] = score, known
        self.first_used, self.usual = self.used, dict(self.numbers)

    def of(self, found: list[bytes]) -> np.ndarray:
        """The number of each word."""
        at = np.fromiter(map(self.numbers.get, found, repeat(-1)), np.int64, len(found))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            words_missing = list(map(found.__getitem__, missing.tolist()))
            new = list(dict.fromkeys(words_missing))
            if len(self.numbers) + len(new) > self.frequent + CACHE_WORDS:
                self.numbers, self.used = dict(self.usual), self.first_used
                at = np.fromiter(map(self.numbers.get, found, repeat(-1)), np.int64, len(found))
                missing = np.flatnonzero(at < 0)
                words_missing = list(map(found.__getitem__, missing.tolist()))
                new = list(dict.fromkeys(words_missing))
            self._learn(new)
            at[missing] = list(map(self.numbers.__getitem__, words_missing))
        return at

    def _learn(self, new: list[bytes]) -> None:
        ids, lengths = self.subwords.each(new)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (self.used + len(ids)))
        first = len(self.numbers)
        if first + len(new) > len(self.length):  # one text with more new words than are kept
            more = first + len(new) - len(self.length)
            self.length, self.start, self.known = (np.append(x, np.zeros(more, np.int64)) for x in (self.length, self.start, self.known))
            self.score = np.append(self.score, np.full(more, np.nan))
        self.numbers.update(zip(new, range(first, first + len(new))))
        self.length[first : first + len(new)] = lengths
        self.start[first : first + len(new)] = self.used + np.cumsum(lengths) - lengths
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def text_ids(self, at: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """The ids of texts, of whose numbered words the last ones stand before ``ends``; END has the id of the end."""
        lengths = self.length[at]
        stops = np.cumsum(lengths)
        ids = self.ids[np.arange(stops[-1]) + np.repeat(self.start[at] - stops + lengths, lengths)].astype(np.int32)
        return np.split(ids, stops[ends[:-1] - 1])


_KEPT: dict[str, tuple[str, object]] = {}


def _kept(kind: str, key: str, make: Callable[[], object]):
    """One object of each kind per Python worker, kept between its tasks until one with another key is asked for."""
    if kind not in _KEPT or _KEPT[kind][0] != key:
        _KEPT.pop(kind, None)
        _KEPT[kind] = key, make()
    return _KEPT[kind][1]


def _keep_memory() -> None:
    """From here on this process keeps freed blocks for the next arrays.

    The allocator keeps what is no larger than the largest block that was freed before, and gives back the rest. A step of
    training would fault all its pages in again, which took about a third of its time.
    """
    np.empty(KEPT_BLOCK, np.uint8)


# --- the model -------------------------------------------------------------------


@dataclass
class Counted:
    """Log shares in the corpus: of the next id's group by the id before, of the id within its group, and pads."""

    group: np.ndarray
    by_group: np.ndarray  # (group, id before, id of the group), so that the rows in use at a time lie together

    @property
    def inside(self) -> np.ndarray:
        return self.by_group.transpose(1, 0, 2)

    @classmethod
    def of(cls, counts: np.ndarray, some: float = 5.0) -> Counted:
        """From counts (id before, id), smoothed with the shares of ids."""
        size = len(counts)
        usual = (counts.sum(axis=0) + 0.5) / (counts.sum() + 0.5 * size)
        shares = (counts + some * usual) / (counts.sum(axis=1, keepdims=True) + some)
        padded = np.zeros((size, -(-size // GROUP), GROUP), np.float64)
        padded.reshape(size, -1)[:, :size] = shares
        group = padded.sum(axis=2)
        inside = np.full(padded.shape, -1e9, np.float32)
        np.log(padded / group[:, :, None], out=inside, where=padded > 0, casting="unsafe")
        return cls(np.log(group).astype(np.float32), np.ascontiguousarray(inside.transpose(1, 0, 2)))


@dataclass
class Weights:
    """Trained parameters, and what was counted."""

    embedding: np.ndarray
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    distance: np.ndarray
    hidden: np.ndarray
    hidden_before: np.ndarray
    attended: np.ndarray
    hidden_bias: np.ndarray
    group: np.ndarray
    inside: np.ndarray
    counted: Counted

    @property
    def trained(self) -> list[np.ndarray]:
        return [v for k, v in vars(self).items() if k != "counted"]


def fresh(counted: Counted, seed: int = 11) -> Weights:
    """Weights before training: the model that only knows what was counted."""
    random = np.random.default_rng(seed)
    size, groups = counted.group.shape

    def some(*shape: int) -> np.ndarray:
        return (random.standard_normal(shape) / math.sqrt(shape[0])).astype(np.float32)

    return Weights(
        some(size, WIDTH) * np.float32(math.sqrt(size) / 2),
        some(WIDTH, WIDTH), some(WIDTH, WIDTH), some(WIDTH, WIDTH),
        np.linspace(0, -1, CONTEXT + STRIDE).astype(np.float32),
        some(WIDTH, HIDDEN), some(WIDTH, HIDDEN), some(WIDTH, HIDDEN), np.zeros(HIDDEN, np.float32),
        np.zeros((HIDDEN + 1, groups), np.float32), np.zeros((groups, HIDDEN + 1, GROUP), np.float32), counted,
    )


def _masked(distance: np.ndarray, rows: int, first: bool) -> np.ndarray:
    """Bias of each query and key: by distance, and minus infinity for later keys and, in a first window, for none."""
    gap = np.arange(CONTEXT, CONTEXT + rows)[:, None] - np.arange(CONTEXT + rows)[None, :]
    out = np.where(gap >= 0, distance[np.maximum(gap, 0)], np.float32(-1e9))
    if first:
        out[:, :CONTEXT] = -1e9
    return out.astype(np.float32)


def _powers(x: np.ndarray) -> np.ndarray:
    """Gives the sums of the powers of e that ``x`` becomes, each row's by a factor of its own where they would be too large or small."""
    ones = np.ones(x.shape[-1], np.float32)
    out = np.exp(x)
    sums = out @ ones
    if not np.isfinite(sums).all() or sums.min(initial=1) < 1e-30:
        out = np.exp(x - x.max(axis=-1, keepdims=True))
        sums = out @ ones
    x[:] = out
    return sums


def _missed(logits: np.ndarray, which: np.ndarray) -> float:
    """Loss of one column per row, added up; ``logits`` become its mean's gradients."""
    many = np.float32(len(logits))
    sums = _powers(logits)
    at = np.arange(0, logits.size, logits.shape[1]) + which
    flat = logits.reshape(-1)
    loss = np.log(sums).sum(dtype=float) - np.log(flat[at]).sum(dtype=float)
    logits *= (1 / (sums * many))[:, None]
    flat[at] -= 1 / many
    return float(loss)


def _sums(index: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Rows added up by index."""
    order = np.argsort(index.astype(np.uint16), kind="stable")
    n = np.bincount(index, minlength=size)
    found = np.flatnonzero(n)
    out = np.zeros((size, rows.shape[1]), np.float32)
    out[found] = np.add.reduceat(np.take(rows, order, axis=0), (np.cumsum(n) - n)[found], axis=0)
    return out


def _gradients(w: Weights, inputs: np.ndarray, targets: np.ndarray, first: bool) -> tuple[float, list[np.ndarray]]:
    """Mean loss (nats) and its gradients for windows (B, CONTEXT + STRIDE) and targets (B, STRIDE; -1: none)."""
    reach = inputs.shape[1]
    x = np.take(w.embedding, inputs, axis=0)
    own, previous = x[:, CONTEXT:], x[:, CONTEXT - 1 : -1]
    scale = np.float32(1 / math.sqrt(WIDTH))
    q, k, v = own @ w.query * scale, x @ w.key, x @ w.value
    scores = q @ k.transpose(0, 2, 1)
    scores += _masked(w.distance, STRIDE, first)
    sums = _powers(scores)
    shares = np.divide(scores, sums[:, :, None], out=scores)
    seen = shares @ v
    before = own @ w.hidden
    before += previous @ w.hidden_before
    before += seen @ w.attended
    before += w.hidden_bias
    # targets in the order of their groups
    places = np.flatnonzero(targets.ravel() >= 0)
    group, of = np.divmod(targets.ravel()[places], GROUP)
    order = np.argsort(group.astype(np.int16), kind="stable")
    places, group, of = places[order], group[order], of[order]
    at, many = inputs[:, CONTEXT:].ravel()[places], len(places)
    hidden = np.ones((many, HIDDEN + 1), np.float32)
    np.maximum(np.take(before.reshape(-1, HIDDEN), places, axis=0), 0, out=hidden[:, :HIDDEN])
    d_group = hidden @ w.group
    d_group += np.take(w.counted.group, at, axis=0)
    loss = _missed(d_group, group)
    d_hidden = d_group @ w.group[:HIDDEN].T
    ends = np.cumsum(np.bincount(group)).tolist()
    used = [(n, a, b) for n, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]
    d_of = np.empty((many, GROUP), np.float32)
    for n, a, b in used:
        np.matmul(hidden[a:b], w.inside[n], out=d_of[a:b])
        d_of[a:b] += np.take(w.counted.by_group[n], at[a:b], axis=0)
    loss += _missed(d_of, of)
    d_inside = np.zeros_like(w.inside)
    for n, a, b in used:
        np.matmul(hidden[a:b].T, d_of[a:b], out=d_inside[n])
        d_hidden[a:b] += d_of[a:b] @ w.inside[n, :HIDDEN].T
    d_hidden *= hidden[:, :HIDDEN] > 0
    d_before = np.zeros_like(before)
    d_before.reshape(-1, HIDDEN)[places] = d_hidden
    d_seen = d_before @ w.attended.T
    d_scores = d_seen @ v.transpose(0, 2, 1)
    d_scores -= np.einsum("bqk,bqk->bq", d_scores, shares)[:, :, None]
    d_scores *= shares
    gap = np.arange(CONTEXT, reach)[:, None] - np.arange(reach)[None, :]
    d_distance = np.bincount(np.maximum(gap, 0).ravel(), (d_scores.sum(axis=0) * (gap >= 0)).ravel(), reach)
    d_q, d_k, d_v = d_scores @ k * scale, d_scores.transpose(0, 2, 1) @ q, shares.transpose(0, 2, 1) @ d_seen
    d_x = d_k @ w.key.T
    d_x += d_v @ w.value.T
    d_x[:, CONTEXT:] += d_q @ w.query.T
    d_x[:, CONTEXT:] += d_before @ w.hidden.T
    d_x[:, CONTEXT - 1 : -1] += d_before @ w.hidden_before.T
    flat, flat_before = (-1, WIDTH), d_before.reshape(-1, HIDDEN)
    return loss / many, [
        _sums(inputs.ravel(), d_x.reshape(flat), len(w.embedding)),
        own.reshape(flat).T @ d_q.reshape(flat),
        x.reshape(flat).T @ d_k.reshape(flat),
        x.reshape(flat).T @ d_v.reshape(flat),
        d_distance.astype(np.float32),
        own.reshape(flat).T @ flat_before,
        previous.reshape(flat).T @ flat_before,
        seen.reshape(flat).T @ flat_before,
        flat_before.sum(axis=0),
        hidden.T @ d_group,
        d_inside,
    ]


def windows(texts: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (n, CONTEXT + STRIDE), targets (n, STRIDE; -1 behind a text), the text of each window, whether it is its first.

    The input before the first id of a text is ``end``.
    """
    counts = np.array([-(-len(t) // STRIDE) for t in texts])
    starts = np.concatenate(([0], np.cumsum(counts * STRIDE + CONTEXT)))
    inputs = np.full(starts[-1], end, np.int32)
    targets = np.full(starts[-1], -1, np.int32)
    for a, t in zip(starts + CONTEXT, texts):
        inputs[a + 1 : a + len(t)] = t[:-1]
        targets[a : a + len(t)] = t
    of = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = starts[of] + nth * STRIDE
    inside = at[:, None] + np.arange(CONTEXT + STRIDE)
    return inputs[inside], targets[inside[:, CONTEXT:]], of, nth == 0


class Adam:
    """Moves weights in place."""

    def __init__(self, w: Weights):
        self.w, self.step = w, 0
        self.mean, self.square = ([np.zeros_like(v) for v in w.trained] for _ in range(2))

    def __call__(self, gradients: list[np.ndarray], rate: float) -> None:
        self.step += 1
        for value, d, m, s in zip(self.w.trained, gradients, self.mean, self.square):
            m += 0.1 * (d - m)
            s += 0.01 * (d * d - s)
            value -= rate * (m / (1 - 0.9**self.step)) / (np.sqrt(s / (1 - 0.99**self.step)) + 1e-7)


def fit(texts: list[np.ndarray], w: Weights, end: int, steps: int = STEPS, seed: int = 5) -> Weights:
    """Adam on batches of windows; the first windows of texts and the others in turn."""
    if not texts:
        return w
    inputs, targets, _, first = windows(texts, end)
    pools = [(np.flatnonzero(first), True), (np.flatnonzero(~first), False)]
    random = np.random.default_rng(seed)
    move = Adam(w)
    _keep_memory()
    for step in range(1, steps + 1):
        pool, start = pools[step % 8 > 0 and len(pools[1][0]) > 0]
        batch = random.choice(pool, BATCH)
        _, steps_of = _gradients(w, inputs[batch], targets[batch], start)
        rate = RATE * min(1, step / 50) * (1 - step / (steps + 1)) + 1e-5
        move(steps_of, rate)
    return w


class Lesson:
    """Trains a copy of weights on all ids of the texts that it is given; every id is a target in one batch."""

    def __init__(self, w: Weights, end: int, seed: int = 7):
        self.w = Weights(*(v.copy() for v in w.trained), w.counted)
        self.end, self.ids, self.move, self.random = end, 0, Adam(self.w), np.random.default_rng(seed)
        none = np.zeros((0, CONTEXT + STRIDE), np.int32), np.zeros((0, STRIDE), np.int32)
        self.waiting = {True: none, False: none}

    def __call__(self, texts: list[np.ndarray]) -> None:
        *made, _, first = windows(texts, self.end)
        for start, held in self.waiting.items():
            rows = self.random.permutation(np.flatnonzero(first == start))
            inputs, targets = (np.concatenate((a, b[rows])) for a, b in zip(held, made))
            whole = len(inputs) // BATCH * BATCH
            for a in range(0, whole, BATCH):
                self._step(inputs[a : a + BATCH], targets[a : a + BATCH], start)
            self.waiting[start] = inputs[whole:], targets[whole:]

    def rest(self) -> None:
        """The batches that are not full."""
        for start, (inputs, targets) in self.waiting.items():
            if len(inputs):
                self._step(inputs, targets, start)
                self.waiting[start] = inputs[:0], targets[:0]

    def _step(self, inputs: np.ndarray, targets: np.ndarray, start: bool) -> None:
        _, steps_of = _gradients(self.w, inputs, targets, start)
        step = self.move.step + 1
        self.move(steps_of, LESSON_RATE * min(1, step / 50) / math.sqrt(1 + step / 200))
        self.ids += int(np.count_nonzero(targets >= 0))


def _exp(x: np.ndarray) -> float:
    """In place; gives what was taken off before."""
    np.exp(x, out=x)
    return 0.0


def _safe_exp(x: np.ndarray) -> np.ndarray:
    """The same for numbers of any size."""
    most = x.max(axis=-1, keepdims=True)
    x -= most
    np.exp(x, out=x)
    return most[..., 0]


class Scorer:
    """Scores texts with tables made once from the weights."""

    def __init__(self, w: Weights):
        self.w, self.lately = w, {}
        self.query = w.embedding @ w.query / np.float32(math.sqrt(WIDTH))
        one = np.ones((len(w.embedding), 1), np.float32)
        self.key_value = np.concatenate((w.embedding @ w.key, w.embedding @ w.value, one), axis=1)
        self.hidden, self.previous = w.embedding @ w.hidden + w.hidden_bias, w.embedding @ w.hidden_before
        self.group, self.inside = w.group[:HIDDEN], w.inside[:, :HIDDEN]
        self.group_logits = w.counted.group + w.group[HIDDEN]
        self.inside_logits = w.counted.by_group + w.inside[:, None, HIDDEN]
        self.bias = {first: _masked(w.distance, STRIDE, first) for first in (True, False)}

    def __call__(self, texts: list[np.ndarray], end: int) -> np.ndarray:
        """log10 probability of each text's ids."""
        if not texts:
            return np.zeros(0)
        inputs, targets, of, first = windows(texts, end)
        out = np.zeros(len(texts))
        for start in (True, False):
            all_rows = np.flatnonzero(first == start)
            for a in range(0, len(all_rows), SOME_WINDOWS):
                rows = all_rows[a : a + SOME_WINDOWS]
                out += self._windows(inputs[rows], targets[rows], start, of[rows], len(texts))
        return out / math.log(10)

    def once(self, texts: list[np.ndarray], end: int) -> list[float]:
        """The same, where copies of a text met lately are looked up."""
        marks = [xxhash.xxh3_128_digest(t) for t in texts]
        if len(self.lately) > KEPT_SCORES:
            self.lately.clear()
        new = {m: t for m, t in zip(marks, texts) if m not in self.lately}
        self.lately.update(zip(new, self(list(new.values()), end).tolist()))
        return [self.lately[m] for m in marks]

    def _windows(self, inputs: np.ndarray, targets: np.ndarray, first: bool, of: np.ndarray, texts: int) -> np.ndarray:
        log_p, order = self._log_shares(inputs, targets, first, _exp)
        if not np.isfinite(log_p).all():
            log_p, order = self._log_shares(inputs, targets, first, _safe_exp)
        return np.bincount(np.repeat(of, STRIDE)[order], log_p, texts)

    def _log_shares(self, inputs: np.ndarray, targets: np.ndarray, first: bool, exp) -> tuple[np.ndarray, np.ndarray]:
        """Of each target that is one, in the order of their groups; and that order."""
        to, at = targets.ravel(), inputs[:, CONTEXT:].ravel()
        group, inside = np.divmod(np.maximum(to, 0), GROUP)
        hidden = np.empty((len(to), HIDDEN), np.float32)
        group_p = np.empty(len(to))
        for a in range(0, len(inputs), PART_WINDOWS):  # parts whose numbers stay in the cache
            part, rows = inputs[a : a + PART_WINDOWS], slice(a * STRIDE, (a + PART_WINDOWS) * STRIDE)
            both = np.take(self.key_value, part, axis=0)
            scores = np.matmul(np.take(self.query, part[:, CONTEXT:], axis=0), both[:, :, :WIDTH].transpose(0, 2, 1))
            scores += self.bias[first]
            exp(scores)
            seen = np.matmul(scores, both[:, :, WIDTH:]).reshape(-1, WIDTH + 1)
            own = np.matmul(seen[:, :WIDTH] / seen[:, WIDTH:], self.w.attended, out=hidden[rows])
            own += np.take(self.hidden, at[rows], axis=0)
            own += np.take(self.previous, part[:, CONTEXT - 1 : -1].ravel(), axis=0)
            np.maximum(own, 0, out=own)
            group_p[rows] = self._chosen(own, self.group, np.take(self.group_logits, at[rows], axis=0), group[rows], exp)
        none = np.count_nonzero(to < 0)
        order = np.argsort(np.where(to < 0, -1, group).astype(np.int16), kind="stable")[none:]
        hidden, log_p, inside = np.take(hidden, order, axis=0), group_p[order], inside[order]
        at = at[order]
        ends = np.cumsum(np.bincount(group[order]))
        for n, (a, b) in enumerate(zip([0, *ends], ends)):
            if a < b:
                logits = np.take(self.inside_logits[n], at[a:b], axis=0)
                log_p[a:b] += self._chosen(hidden[a:b], self.inside[n], logits, inside[a:b], exp)
        return log_p, order

    @staticmethod
    def _chosen(hidden: np.ndarray, weights: np.ndarray, logits: np.ndarray, which: np.ndarray, exp) -> np.ndarray:
        """Log share of one column per row; ``logits``, which the weights add to, are used up."""
        logits += hidden @ weights
        at = np.arange(0, logits.size, logits.shape[1]) + which
        chosen = logits.ravel()[at] - exp(logits)
        return chosen - np.log(logits @ np.ones(logits.shape[1], np.float32))


# --- what is gathered from the corpus ----------------------------------------------


def word_counts(docs: DataFrame, text: str = "text", held_out: str = "held_out") -> DataFrame:
    """(word, n, n_train): how often each word, and END for the end, occurs in all and in training texts."""
    schema = StructType(
        [StructField("word", BinaryType()), StructField("n", LongType()), StructField("n_train", LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(schema)
        counts = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            seen = list(counts[0].keys() | counts[1].keys())
            train = [counts[0][w] for w in seen]
            n = [t + counts[1][w] for t, w in zip(train, seen)]
            for c in counts:
                c.clear()
            return as_batch({"word": seen, "n": n, "n_train": train}, target)

        for batch in parts(batches):
            for value, out in zip(batch.column(text).to_pylist(), batch.column(held_out).to_pylist()):
                counts[bool(out)].update(words(value))
                counts[bool(out)][END] += 1
                if len(counts[0]) + len(counts[1]) > FLUSH_WORDS:
                    yield flush()
        yield flush()

    summed = docs.select(text, held_out).mapInArrow(run, schema)
    return summed.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train"))


def pair_counts(of_words: DataFrame, subwords: Callable[[], Subwords]) -> DataFrame:
    """(pair, n): ids that follow each other within the words of all training texts, from their counts.

    A pair is the id before times the number of ids, plus the id. What precedes a word, or the end, counts as the end id;
    what follows the last id of a word too.
    """
    schema = StructType([StructField("pair", IntegerType()), StructField("n", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, target = subwords(), to_arrow_schema(schema)
        pairs = np.zeros(ids_of.size**2)
        for batch in batches:
            found, times = batch.column("word").to_pylist(), batch.column("n_train").to_numpy()
            for a in range(0, len(found), 10_000):
                some = found[a : a + 10_000]
                ids, lengths = ids_of.each(some)
                ids, ends = ids.astype(np.int64), np.cumsum(lengths)
                before = np.concatenate(([ids_of.end], ids[:-1]))
                before[ends - lengths] = ids_of.end
                codes = np.concatenate((before * ids_of.size + ids, ids[ends - 1] * ids_of.size + ids_of.end))
                n = np.concatenate((np.repeat(times[a : a + 10_000], lengths), times[a : a + 10_000]))
                pairs += np.bincount(codes, n, len(pairs))
        at = np.flatnonzero(pairs).astype(np.int32)
        yield as_batch({"pair": pa.array(at), "n": pa.array(pairs[at].astype(np.int64))}, target)

    trained = of_words.filter((F.col("n_train") > 0) & (F.col("word") != F.lit(END)))
    return trained.select("word", "n_train").mapInArrow(run, schema).groupBy("pair").agg(F.sum("n").alias("n"))


def counted(pairs: pa.Table, texts: int, size: int) -> Counted:
    """Shares from counts of pairs and the number of training texts.

    After the last id of a word comes the first of another one, as often as words begin with it, or the end.
    """
    counts = np.zeros((size, size), np.float64)
    counts.ravel()[pairs.column("pair").to_numpy()] = pairs.column("n").to_numpy()
    end = size - 1
    first = counts[end].copy()
    first[end] = texts
    ended = counts[:, end].copy()
    ended[end] = first.sum()
    counts[:, end] = 0
    counts[end] = 0
    counts += ended[:, None] * (first / max(1.0, first.sum()))
    return Counted.of(counts)


# --- training on the corpus ----------------------------------------------------------


def _blocks(texts: list[str | None]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The words of some texts at a time, an END behind each, and where each text ends."""
    found, ends = [], []
    for text in texts:
        found += words(text)
        found.append(END)
        ends.append(len(found))
        if len(found) >= BLOCK_WORDS:
            yield found, np.array(ends)
            found, ends = [], []
    if ends:
        yield found, np.array(ends)


_PARTS = StructType(
    [StructField("part", IntegerType()), StructField("task", IntegerType()), StructField("ids", LongType()), StructField("numbers", BinaryType())]
)


def learned(texts: DataFrame, start: Weights, subwords: Callable[[], Subwords], shared, key: str) -> tuple[Weights, int]:
    """Weights after a pass over all ``texts`` from ``start``, which ``shared`` has with the words, and the number of ids in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, *known = shared.value
        lexicon = _kept("lexicon", key, lambda: Lexicon(subwords(), *known))
        lesson = Lesson(begin, lexicon.subwords.end)
        _keep_memory()
        for batch in parts(batches):
            for found, ends in _blocks(batch.column("text").to_pylist()):
                lesson(lexicon.text_ids(lexicon.of(found), ends))
        lesson.rest()
        if lesson.ids:
            numbers = np.concatenate([v.ravel() for v in lesson.w.trained])
            rows = [numbers[a : a + PART_WEIGHTS].tobytes() for a in range(0, len(numbers), PART_WEIGHTS)]
            task = TaskContext.get().partitionId()
            values = {"part": list(range(len(rows))), "task": [task] * len(rows), "ids": [lesson.ids] * len(rows), "numbers": rows}
            yield as_batch(values, to_arrow_schema(_PARTS))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        seen: Counter = Counter()
        for batch in batches:
            for part, n, numbers in zip(*(batch.column(c).to_pylist() for c in ("part", "ids", "numbers"))):
                sums[part] = sums.get(part, 0) + np.frombuffer(numbers, np.float32).astype(float) * n
                seen[part] += n
        values = {"part": list(sums), "task": [None] * len(sums), "ids": [seen[p] for p in sums]}
        yield as_batch(values | {"numbers": [v.tobytes() for v in sums.values()]}, to_arrow_schema(_PARTS))

    copies = texts.select("text").mapInArrow(run, _PARTS)
    # in the order of tasks, so that the same sums come out again
    means = copies.repartition("part").sortWithinPartitions("part", "task").mapInArrow(added, _PARTS).collect()
    if not means:
        return start, 0
    means = [np.frombuffer(r["numbers"]) / r["ids"] for r in sorted(means, key=lambda r: r["part"])], means[0]["ids"]
    numbers, shapes = np.concatenate(means[0]).astype(np.float32), [v.shape for v in start.trained]
    cuts = np.cumsum([math.prod(s) for s in shapes])
    return Weights(*(v.reshape(s) for v, s in zip(np.split(numbers, cuts[:-1]), shapes)), start.counted), means[1]


# --- scoring -----------------------------------------------------------------------


def score_texts(
    docs: DataFrame, held_out: Column, path: str, pattern: str, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10 of the text's probability).

    Gathers the counts, trains and scores when called; ``held_out`` marks the rows that are not learned from.
    """
    spark = docs.sparkSession
    key = uuid.uuid4().hex

    def subwords() -> Subwords:
        return _kept("subwords", f"{path} {pattern}", lambda: Subwords(path, pattern))

    rows = docs.select(F.col(id), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    of_words = stored(word_counts(rows), "word-counts")
    everything, n, distinct = of_words.agg(F.sum("n"), F.sum("n_train"), F.count_if(F.col("n_train") > 0)).first()
    total, floor = n or 0, (n or 0) + (distinct or 0) + 1
    hot = of_words.filter(F.col("n") * FREQUENT_SHARE >= (everything or 0)).select("word", "n_train").toArrow()
    frequent, times = hot.column("word").to_pylist(), hot.column("n_train").to_numpy()
    ids_of = subwords()
    trained_texts = of_words.filter(F.col("word") == F.lit(END)).agg(F.sum("n_train")).first()[0] or 0
    shares = counted(pair_counts(of_words, subwords).toArrow(), trained_texts, ids_of.size)
    mark = F.xxhash64(F.col(id).cast("string"), "text")
    part = min(1 << 32, (2 * FIT_TEXTS << 32) // max(1, trained_texts))  # about twice the texts that are taken
    sample = (
        rows.filter(~F.col("held_out")).select("text", mark.alias("h")).filter(F.pmod("h", F.lit(1 << 32)) < part)
        .select("h", F.length(F.coalesce("text", F.lit(""))).alias("n")).orderBy("h").limit(FIT_TEXTS).collect()
    )
    chosen, held = set(), 0
    for r in sample:
        if held + r["n"] <= 4 * FIT_IDS:
            chosen.add(r["h"])
            held += r["n"]
    wanted = spark.createDataFrame([(h,) for h in sorted(chosen)], "h long")
    texts = rows.withColumn("h", F.xxhash64(F.col(id).cast("string"), "text")).join(F.broadcast(wanted), "h")
    picked = {r["h"]: r["text"] for r in texts.select("h", "text").collect()}
    first, held = [], 0
    for h in sorted(picked):
        ids = ids_of(words(picked[h]))
        if held + len(ids) <= FIT_IDS:
            first.append(ids)
            held += len(ids)
    weights = fit(first, fresh(shares), ids_of.end)
    shared = spark.sparkContext.broadcast((weights, frequent, np.log10((times + 1) / floor), times > 0))
    weights, _ = learned(rows.filter(~F.col("held_out")), weights, subwords, shared, key)
    trained = spark.sparkContext.broadcast(weights.trained)
    scored = stored(_scored(rows, id, subwords, shared, trained, key), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare_words", "rare_counts")).alias("r"))
    rare = rare.select("row", F.col("r.rare_words").alias("word"), F.col("r.rare_counts").alias("times"))
    seen = F.coalesce("n_train", F.lit(0))
    sums = (
        rare.join(of_words.select("word", "n_train"), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10((seen + 1) / F.lit(float(floor)))).alias("rare_score"),
            F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )
    return scored.join(sums, "row", "left").select(
        id,
        "held_out",
        "n_tokens",
        (F.col("hot_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("hot_score") + F.coalesce("rare_score", F.lit(0.0))).alias("base_score"),
        "score",
    )


def _scored(rows: DataFrame, id: str, subwords: Callable[[], Subwords], shared, trained, key: str) -> DataFrame:
    names = {
        "row": LongType(), "held_out": BooleanType(), "n_tokens": LongType(), "hot_known": LongType(),
        "hot_score": DoubleType(), "rare_words": ArrayType(BinaryType()), "rare_counts": ArrayType(LongType()),
        "score": DoubleType(),
    }
    schema = StructType([rows.schema[id], *(StructField(n, t) for n, t in names.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(schema)
        begin, *known = shared.value
        lexicon = _kept("lexicon", key, lambda: Lexicon(subwords(), *known))
        scorer = _kept("scorer", key, lambda: Scorer(Weights(*trained.value, begin.counted)))
        row = TaskContext.get().partitionId() << 33
        _keep_memory()
        for batch in parts(batches):
            texts = batch.column("text").to_pylist()
            out: dict[str, list] = {n: [] for n in ("row", "n_tokens", "hot_known", "hot_score", "rare_words", "rare_counts", "score")}
            for found, ends in _blocks(texts):
                for name, values in _scored_block(found, ends, lexicon, scorer).items():
                    out[name] += values
            out["row"] = list(range(row, row + len(texts)))
            row += len(texts)
            yield as_batch({id: batch.column(id), "held_out": batch.column("held_out")} | out, target)

    return rows.mapInArrow(run, schema)


def _scored_block(found: list[bytes], ends: np.ndarray, lexicon: Lexicon, scorer: Scorer) -> dict[str, list]:
    """Scores and counts of texts whose words, each text's with the END, stand one after the other."""
    at = lexicon.of(found)
    starts = np.concatenate(([0], ends[:-1]))
    base = lexicon.score[at]
    rare = np.flatnonzero(np.isnan(base))
    base[rare] = 0
    # each text's rare words: once, with their number
    room = int(at.max()) + 1
    pairs, which, times = np.unique(
        np.repeat(np.arange(len(ends)), ends - starts)[rare] * room + at[rare], return_index=True, return_counts=True
    )
    names = list(map(found.__getitem__, rare[which].tolist()))
    cuts = np.searchsorted(pairs, np.arange(len(ends) + 1) * room).tolist()
    times = times.tolist()
    return {
        "n_tokens": (ends - starts).tolist(),
        "hot_known": np.add.reduceat(lexicon.known[at], starts).tolist(),
        "hot_score": np.add.reduceat(base, starts).tolist(),
        "rare_words": [names[a:b] for a, b in zip(cuts, cuts[1:])],
        "rare_counts": [times[a:b] for a, b in zip(cuts, cuts[1:])],
        "score": scorer.once(lexicon.text_ids(at, ends), lexicon.subwords.end),
    }
