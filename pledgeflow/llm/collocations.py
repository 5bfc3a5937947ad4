"""Phrase collocations from weighted acyclic automata that map n-grams to their counts.

A task reads texts until it has a shard of words, sorts the shard's n-grams (1 to 3 words) and builds from them, run after run in
their order, a count transducer: a path of words ends in an arc that carries the count of the phrase read so far, and states
with the same arcs are stored once. Shards are cut at borders of prefix ranges, which are phrases themselves, so a word or pair
that starts a third of all phrases is cut too. Per range the transducers are united: their labels are brought to common
words and the weights of equal paths summed up. Phrases of a count below ``min_count`` can neither be candidates nor
parts of one and end there. The parts of the candidates are looked up by composing the transducer of a range with the
parts asked of it; the answers are joined to the candidates. Everything is per language.

The driver sees one border per range. A range holds about ``RANGE_ENTRIES`` entries of shards, whatever the corpus; borders are the
quantiles of a sample of every shard's phrases and decide nothing but the balance of tasks. Ranking cuts each task's rows
before they are shuffled.

Counts are exact: words are told apart as bytes, never by hash, and scores are computed in decimals of 38 digits: counts up
to 10**16 do. Defined cases: a null or empty text has no words; a null language is ``und``; repeated rows count as often as
they come; equal scores are ranked by count and phrase; an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from pledgeflow.llm.common import FEW_BYTES, as_batch, encoded, parts, schema_of, stored
from pledgeflow.session import settings

MIN_COUNT, SHARE, TOP, UNKNOWN, SLICES = 10, 50, 2_000, "und", 16
#: Words of a shard, entries of a range of phrases, every so many entries one is a sample.
SHARD_WORDS, RANGE_ENTRIES, SAMPLE = 2_000_000, 1 << 20, 1 << 13
#: Bits of a word's number: three of them make one sort key.
BITS = 21
_MASK = (1 << BITS) - 1
#: A-Z in lower case, signs that end a piece as a full stop, a tab as a space.
_MAP = bytes(
    b + 32 if 65 <= b <= 90 else 46 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)
)
_SHARD = schema_of(lang="string", n="long", entries="long", sample=["string"], data="binary")
_SLICE = schema_of(range="int", lang="string", data="binary")
_CUTS = schema_of(lang="string", phrase="string", size="int", a="long", k="int", left="string", right="string")
_PARTS = schema_of(range="int", lang="string", part="string")
_FOUND = schema_of(lang="string", part="string", f="long")
Grams = list[tuple[np.ndarray, np.ndarray]]  # per size: keys in order, counts


# --- automata -----------------------------------------------------------------------


class Level:
    """States and their arcs; state s has the arcs from ``start[s]`` to ``start[s + 1]``. A target of -1 is the end."""

    NAMES = ("start", "label", "weight", "target")

    def __init__(self, start, label, weight, target):
        self.start, self.label, self.weight, self.target = start, label, weight, target


class _Register:
    """The states of one level, each different one once."""

    def __init__(self):
        self.known: dict[int | bytes, int] = {}
        self.count = 0
        self.sizes: list[np.ndarray] = []
        self.arcs: list[np.ndarray] = []

    def states(self, starts: np.ndarray, arcs: np.ndarray, last: bool) -> np.ndarray:
        """The state of each group of arcs (label, weight, target) that begins at one of ``starts``.

        States of one arc are told apart by numbers, all together; those of several by their bytes. After the ``last``
        groups nothing needs to be known any more.
        """
        if not len(starts):
            return np.empty(0, np.int64)
        ends = np.append(starts[1:], len(arcs))
        out = np.empty(len(starts), np.int64)
        label, weight, target = arcs[starts].T
        single = (ends - starts == 1) & (weight < 1 << 20) & (target < (1 << 22) - 1)
        one = np.flatnonzero(single)
        if len(one):
            keys = label[one] << 42 | weight[one] << 22 | (target[one] + 1)
            keys, first, of = np.unique(keys, return_index=True, return_inverse=True)
            numbers = np.full(len(keys), -1, np.int64)
            if self.known:
                numbers[:] = [self.known.get(k, -1) for k in keys.tolist()]
            new = np.flatnonzero(numbers < 0)
            numbers[new] = np.arange(self.count, self.count + len(new))
            self._keep(arcs[starts[one[first[new]]]], np.ones(len(new), np.int64))
            if not last:
                self.known.update(zip(keys[new].tolist(), numbers[new].tolist()))
            out[one] = numbers[of]
        other = np.flatnonzero(~single)
        if len(other):
            raw, row, a, b = arcs.tobytes(), arcs[:1].nbytes, starts[other], ends[other]
            rows = list(map(raw.__getitem__, map(slice, (a * row).tolist(), (b * row).tolist())))
            places = dict(zip(reversed(rows), range(len(rows) - 1, -1, -1)))  # the first of each
            new = sorted(place for one, place in places.items() if one not in self.known)
            self.known.update(zip(map(rows.__getitem__, new), range(self.count, self.count + len(new))))
            out[other] = list(map(self.known.__getitem__, rows))
            if new:
                first, sizes = a[new], (b - a)[new]
                at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                self._keep(arcs[at], sizes)
        return out

    def _keep(self, arcs: np.ndarray, sizes: np.ndarray) -> None:
        self.arcs.append(arcs)
        self.sizes.append(sizes)
        self.count += len(sizes)

    def level(self) -> Level:
        arcs = np.concatenate(self.arcs) if self.arcs else np.empty((0, 3), np.int64)
        sizes = np.concatenate(self.sizes) if self.sizes else np.empty(0, np.int64)
        return Level(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), *arcs.T)


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All different numbers of two arrays that are in order, in order."""
    both = np.sort(np.concatenate((a, b)), kind="stable")  # merges the two
    return both[np.append(True, both[1:] != both[:-1])] if len(both) else both


class Builder:
    """Builds a transducer from n-grams in ascending order, one run of first words after the other.

    What lies below a first word is closed when its run is added: its states are looked up in the registers, so only
    states that differ from all before are kept.
    """

    def __init__(self, words: list[bytes]):
        self.words, self.levels, self.roots = words, [_Register(), _Register()], []

    def add(self, grams: Grams, last: bool = False) -> None:
        """The n-grams of first words that come behind those added already; a key packs up to three words' numbers from 1 on."""
        keys = [k for k, _ in grams]
        nodes = [None, _merged(keys[1], keys[2] >> BITS), keys[2]]
        nodes[0] = _merged(keys[0], nodes[1] >> BITS)
        below = np.full(len(nodes[2]), -1, np.int64)
        for level in (2, 1, 0):
            weight = np.zeros(len(nodes[level]), np.int64)
            weight[np.searchsorted(nodes[level], keys[level])] = grams[level][1]
            arcs = np.stack([nodes[level] & _MASK, weight, below], axis=1)
            if not level:
                self.roots.append(arcs)
                return
            above = nodes[level] >> BITS
            starts = np.flatnonzero(np.r_[True, above[1:] != above[:-1]]) if len(above) else np.empty(0, np.int64)
            states = self.levels[level - 1].states(starts, arcs, last)
            below = np.full(len(nodes[level - 1]), -1, np.int64)
            below[np.searchsorted(nodes[level - 1], above[starts])] = states

    def finish(self) -> Automaton:
        arcs = np.concatenate(self.roots) if self.roots else np.empty((0, 3), np.int64)
        return Automaton(self.words, [Level(np.array([0, len(arcs)]), *arcs.T), *(r.level() for r in self.levels)])


class Automaton:
    """A weighted acyclic automaton of up to three words; labels are the numbers of its words, from 1 on. A weight of 0 is no entry."""

    RUN = 1 << 17

    def __init__(self, words: list[bytes], levels: list[Level]):
        self.words, self.levels = words, levels

    @classmethod
    def of(cls, words: list[bytes], grams: Grams) -> Automaton:
        """From all n-grams of ``words``, which are sorted, in runs of whole first words."""
        built = Builder(words)
        firsts = [keys >> (BITS * size) for size, (keys, _) in enumerate(grams)]
        at = 0
        while at <= len(words):
            # the run ends where the longest phrases have RUN more entries
            begin = np.searchsorted(firsts[2], at)
            end = int(firsts[2][begin + cls.RUN]) + 1 if begin + cls.RUN < len(firsts[2]) else len(words) + 1
            built.add([tuple(x[slice(*np.searchsorted(f, (at, end)))] for x in g) for f, g in zip(firsts, grams)], end > len(words))
            at = end
        return built.finish()

    def grams(self) -> Grams:
        """All entries again, in order."""
        out, prefix, state = [], np.zeros(1, np.int64), np.zeros(1, np.int64)
        for level in self.levels:
            counts = np.where(state >= 0, level.start[state + 1] - level.start[state], 0)
            arcs = np.repeat(level.start[state] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            prefix = np.repeat(prefix, counts) << BITS | level.label[arcs]
            weight, state = level.weight[arcs], level.target[arcs]
            out.append((prefix[weight > 0], weight[weight > 0]))
        return out

    def compose(self, phrases: list[tuple[bytes, ...]]) -> np.ndarray:
        """The weights of the paths of ``phrases``, 0 without a path; all phrases take one step at a time."""
        number = {w: n for n, w in enumerate(self.words, 1)}
        state, weight = np.zeros(len(phrases), np.int64), np.zeros(len(phrases), np.int64)
        for step, level in enumerate(self.levels):
            here = np.array([n for n, p in enumerate(phrases) if len(p) > step], np.int64)
            label = np.array([number.get(phrases[n][step], 0) for n in here], np.int64)
            arc_keys = np.repeat(np.arange(len(level.start) - 1), np.diff(level.start)) << BITS | level.label
            keys = np.where((state[here] >= 0) & (label > 0), state[here] << BITS | label, -1)
            at = np.searchsorted(arc_keys, keys)
            met = np.append(arc_keys, -2)[at] == keys
            state[here] = np.where(met, np.append(level.target, -1)[at], -1)
            weight[here] = np.where(met, np.append(level.weight, 0)[at], 0)
        return weight

    def phrases(self, keys: np.ndarray, size: int) -> list[tuple[bytes, ...]]:
        columns = [keys >> BITS * (size - 1 - i) & _MASK for i in range(size)]
        words = self.words
        return list(zip(*([words[n - 1] for n in c.tolist()] for c in columns)))

    def to_bytes(self) -> bytes:
        """Words one per line (no word has a line break), then each array in the narrowest numbers that hold it."""
        out = [b"\n".join(self.words)]
        sizes = [len(out[0]), len(self.words)]
        for level in self.levels:
            for name in Level.NAMES:
                array = getattr(level, name) + (name == "target")
                kind = np.min_scalar_type(int(array.max(initial=0)))
                out.append(array.astype(kind).tobytes())
                sizes += [len(array), kind.itemsize]
        return struct.pack("<26q", *sizes) + b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> Automaton:
        sizes = struct.unpack_from("<26q", data)
        at = 26 * 8 + sizes[0]
        words = data[26 * 8 : at].split(b"\n") if sizes[1] else []
        arrays = []
        for n, width in zip(sizes[2::2], sizes[3::2]):
            arrays.append(np.frombuffer(data, f"<u{width}", n, at).astype(np.int64))
            at += n * width
        return cls(words, [Level(*a, t - 1) for *a, t in (arrays[i : i + 4] for i in range(0, 12, 4))])


_NO_GRAMS = np.empty(0, np.int64), np.empty(0, np.int64)


class _Stored:
    """The transducers of stored rows, one at a time, as often as they are asked for."""

    def __init__(self, data: pa.ChunkedArray):
        self.data = data

    def __iter__(self) -> Iterator[Automaton]:
        return (Automaton.from_bytes(d.as_py()) for d in self.data)


def united(slices: Iterable[Automaton], min_count: int = 1) -> Automaton:
    """The sum of transducers; entries below ``min_count`` and words without entries are left out.

    They are read one at a time, and once more where their words are too many.
    """
    # in the order they are met: most words have no entry in the sum, so only the words of those that stay are sorted
    number: dict[bytes, int] = {}
    found: list[list] = [[], [], []]
    for s in slices:
        to = np.array([0, *(number.setdefault(w, len(number) + 1) for w in s.words)], np.int64)
        if len(number) > _MASK:
            del found, number
            return _united_by_words(slices, min_count)
        for size, (keys, counts) in enumerate(s.grams()):
            found[size].append((_renumbered(keys, size, to), counts))
    words = list(number)
    sums = [_summed(*map(np.concatenate, zip(*pairs)), min_count) if pairs else _NO_GRAMS for pairs in found]
    used = _used(len(words), sums)
    some = sorted(np.flatnonzero(used).tolist(), key=lambda n: words[n - 1])
    rank = np.zeros(len(words) + 1, np.int64)
    rank[some] = np.arange(1, len(some) + 1)
    grams = []
    for size, (keys, counts) in enumerate(sums):
        keys = _renumbered(keys, size, rank)
        order = np.argsort(keys)
        grams.append((keys[order], counts[order]))
    return Automaton.of([words[n - 1] for n in some], grams)


def _summed(keys: np.ndarray, counts: np.ndarray, min_count: int) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order with their sums of at least ``min_count``."""
    if not len(keys):
        return _NO_GRAMS
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sums = np.add.reduceat(counts[order], first)
    kept = sums >= min_count
    return keys[first[kept]], sums[kept]


def _renumbered(keys: np.ndarray, size: int, to: np.ndarray) -> np.ndarray:
    """Keys of ``size`` words and one with other numbers for the words."""
    out = to[keys & _MASK]
    for i in range(1, size + 1):
        out |= to[keys >> BITS * i & _MASK] << BITS * i
    return out


def _used(words: int, grams: Grams) -> np.ndarray:
    """Whether each of the words, from number 1 on, is in an entry."""
    used = np.zeros(words + 1, bool)
    for size, (keys, _) in enumerate(grams):
        for i in range(size + 1):
            used[keys >> BITS * i & _MASK] = True
    return used


def _compact(words: list[bytes], grams: Grams) -> Automaton:
    """Only the words that the entries use, numbered anew."""
    if sum(len(keys) for keys, _ in grams) * 8 < len(words):  # a small slice is not charged for all words of its shard
        used = np.unique(np.concatenate([keys >> BITS * i & _MASK for size, (keys, _) in enumerate(grams) for i in range(size + 1)]))
    else:
        used = np.flatnonzero(_used(len(words), grams))
    to = np.empty(len(words) + 1, np.int64)
    to[used] = np.arange(1, len(used) + 1)
    made = [(_renumbered(keys, size, to), counts) for size, (keys, counts) in enumerate(grams)]
    return Automaton.of([words[n - 1] for n in used.tolist()], made)


def _united_by_words(slices: Iterable[Automaton], min_count: int) -> Automaton:
    """The same for more words than keys can number, with the phrases themselves as keys."""
    sums: Counter[tuple[bytes, ...]] = Counter()
    for s in slices:
        for size, (keys, counts) in enumerate(s.grams(), 1):
            for phrase, n in zip(s.phrases(keys, size), counts.tolist()):
                sums[phrase] += n
    kept = sorted((p, n) for p, n in sums.items() if n >= min_count)
    words = sorted(set(chain.from_iterable(p for p, _ in kept)))
    number = {w: n for n, w in enumerate(words, 1)}
    grams = []
    for size in (1, 2, 3):
        own = [(p, n) for p, n in kept if len(p) == size]
        keys = [sum(number[w] << BITS * (size - 1 - i) for i, w in enumerate(p)) for p, _ in own]
        grams.append((np.array(keys, np.int64), np.array([n for _, n in own], np.int64)))
    return Automaton.of(words, grams)


# --- shards -------------------------------------------------------------------------


class _Ids(dict):
    """A new word gets the next number; 0 is the border of a piece."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def counted(ids: _Ids, runs: list[np.ndarray]) -> Automaton:
    """The transducer of a shard's words."""
    words = sorted(ids)
    words.remove(b".")
    rank = np.zeros(len(ids), np.int64)
    rank[[ids[w] for w in words]] = np.arange(1, len(ids))
    r = rank[np.concatenate(runs)]
    grams = []
    for size in (1, 2, 3):
        n = max(0, len(r) - size + 1)
        inside, keys = np.ones(n, bool), np.zeros(n, np.int64)
        for i in range(size):
            inside &= r[i : i + n] > 0
            keys = keys << BITS | r[i : i + n]
        grams.append(np.unique(keys[inside], return_counts=True))
    return Automaton.of(words, grams)


def pieces(text: str | None) -> list[bytes]:
    """Words of a text, pieces parted by full stops."""
    return encoded(text).translate(_MAP).replace(b".", b" . ").split()


def shards(docs: DataFrame, text: str = "text", lang: str = "lang", shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, n words, entries, sample of phrases, transducer), several rows per task."""
    limit = min(shard_words, (1 << BITS) // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(_SHARD)
        ids: dict[str, _Ids] = defaultdict(lambda: _Ids({b".": 0}))
        runs: dict[str, list[np.ndarray]] = defaultdict(list)
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for name in list(runs):
                made = counted(ids.pop(name), runs.pop(name))
                grams = made.grams()
                sample = []
                for n, (keys, _) in enumerate(grams, 1):
                    # an offset of its own for each shard, so that borders of shards do not fall together
                    first = (len(keys) * 0x9E3779B1 >> 7) % SAMPLE if len(keys) > SAMPLE else len(keys) // 2
                    sample += map(b" ".join, made.phrases(keys[first::SAMPLE], n))
                row = {"lang": [name], "n": [int(grams[0][1].sum())], "entries": [sum(len(k) for k, _ in grams)]}
                yield as_batch(row | {"sample": [[s.decode() for s in sample]], "data": [made.to_bytes()]}, target)

        for batch in parts(batches, 500):
            for name, value in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                own = pieces(value)
                # a text of more words than the shard has room for is cut at the border of a piece
                while own:
                    room = max(3, shard_words - size)
                    some, known = own[:room], ids[name]
                    if len(own) > room:
                        some, own = _cut(own, room)
                    else:
                        own = []
                    some.append(b".")
                    runs[name].append(np.fromiter(map(known.__getitem__, some), np.int32, len(some)))
                    size += len(some)
                    if size >= shard_words or len(known) > limit:
                        yield from flush()
                        size = 0
        yield from flush()

    return docs.select(F.coalesce(lang, F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text")).mapInArrow(run, _SHARD)


def _cut(words: list[bytes], room: int) -> tuple[list[bytes], list[bytes]]:
    """The words up to the last border of a piece within ``room``; the whole first piece where it is longer."""
    for at in range(room, 0, -1):
        if words[at - 1] == b".":
            return words[:at], words[at:]
    try:
        at = words.index(b".", room) + 1
    except ValueError:
        at = len(words)
    return words[:at], words[at:]


# --- ranges ----------------------------------------------------------------------------

Border = tuple[str, tuple[bytes, ...]]


def _key(words: list[bytes], phrase: tuple[bytes, ...]) -> int:
    """Where a border lies among the keys of three words."""
    key = 0
    for i in range(3):
        at = bisect_left(words, phrase[i]) + 1 if i < len(phrase) else 0
        key = key << BITS | at
        if at and (at > len(words) or words[at - 1] != phrase[i]):
            return key << BITS * (2 - i)
    return key


def sliced(made: Automaton, lang: str, borders: list[Border]) -> Iterator[tuple[int, Automaton]]:
    """The parts of a transducer that lie in each range."""
    low, high = bisect_left(borders, (lang,)), bisect_right(borders, lang, key=lambda b: b[0])
    cuts = np.array([_key(made.words, phrase) for _, phrase in borders[low:high]], np.int64)
    grams = made.grams()
    places = [np.searchsorted(cuts, keys << BITS * (2 - size), side="right") for size, (keys, _) in enumerate(grams)]
    for n in range(high - low + 1):
        own = [tuple(x[slice(*np.searchsorted(p, (n, n + 1)))] for x in g) for p, g in zip(places, grams)]
        if any(len(k) for k, _ in own):
            yield low + n, _compact(made.words, own)


def _borders(made: DataFrame, ranges: int) -> list[Border]:
    """Phrases that cut all entries into about so many equal ranges; one row per range comes to the driver."""
    if ranges < 2:
        return []
    sample = made.select("lang", F.explode("sample").alias("phrase"))
    least = (
        sample.repartitionByRange(ranges, "lang", "phrase").groupBy(F.spark_partition_id().alias("p"))
        .agg(F.min(F.struct("lang", "phrase")).alias("b"))
    )
    found = {(r["b"]["lang"], tuple(encoded(r["b"]["phrase"]).split(b" "))) for r in least.collect()}
    return sorted(found)


def count_phrases(made: DataFrame, borders: list[Border], min_count: int = MIN_COUNT) -> DataFrame:
    """(range, lang, transducer): the counts of all phrases of ``min_count`` or more occurrences."""
    shared = made.sparkSession.sparkContext.broadcast(borders)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(_SLICE)
        for batch in batches:
            for lang, data in zip(batch.column("lang").to_pylist(), batch.column("data")):
                made = [(n, part.to_bytes()) for n, part in sliced(Automaton.from_bytes(data.as_py()), lang, shared.value)]
                if made:
                    ranges, slices = zip(*made)
                    yield as_batch({"range": ranges, "lang": [lang] * len(made), "data": slices}, target)

    def unite(group: pa.Table) -> pa.Table:
        total = united(_Stored(group.column("data")), min_count)
        rows = {"range": group.column("range")[:1], "lang": group.column("lang")[:1], "data": [total.to_bytes()]}
        return pa.Table.from_batches([as_batch(rows, to_arrow_schema(_SLICE))])

    return made.select("lang", "data").mapInArrow(cut, _SLICE).groupBy("range", "lang").applyInArrow(unite, _SLICE)


# --- candidates ---------------------------------------------------------------------------


def _cuts(counts: DataFrame) -> DataFrame:
    """A row for each way to cut each phrase of two or three words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(_CUTS)
        for batch in batches:
            for lang, data in zip(batch.column("lang").to_pylist(), batch.column("data")):
                made = Automaton.from_bytes(data.as_py())
                rows = []
                for size, (keys, weights) in enumerate(made.grams()[1:], 2):
                    for p, a in zip(made.phrases(keys, size), weights.tolist()):
                        rows += [(lang, b" ".join(p), size, a, k, b" ".join(p[:k]), b" ".join(p[k:])) for k in range(1, size)]
                if rows:
                    yield as_batch(dict(zip(target.names, zip(*rows))), target)

    return counts.mapInArrow(run, _CUTS)


def _looked_up(cuts: DataFrame, counts: DataFrame, borders: list[Border]) -> DataFrame:
    """(lang, part, f) of every different part, asked of the range it lies in."""
    shared = cuts.sparkSession.sparkContext.broadcast(borders)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(_PARTS)
        for batch in batches:
            langs, asked = batch.column("lang"), batch.column("part")
            pairs = zip(langs.to_pylist(), asked.to_pylist())
            ranges = [bisect_right(shared.value, (lang, tuple(encoded(part).split(b" ")))) for lang, part in pairs]
            yield as_batch({"range": ranges, "lang": langs, "part": asked}, target)

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        target = to_arrow_schema(_FOUND)
        if not asked.num_rows or not known.num_rows:
            return target.empty_table()
        made = Automaton.from_bytes(known.column("data")[0].as_py())
        found = made.compose([tuple(encoded(p).split(b" ")) for p in asked.column("part").to_pylist()])
        rows = {"lang": asked.column("lang"), "part": asked.column("part"), "f": pa.array(found)}
        return pa.Table.from_batches([as_batch(rows, target)])

    wanted = cuts.select("lang", F.explode(F.array("left", "right")).alias("part")).distinct().mapInArrow(place, _PARTS)
    return wanted.groupBy("range", "lang").cogroup(counts.groupBy("range", "lang")).applyInArrow(answer, _FOUND)


def find_collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    share: int = SHARE,
    top: int = TOP,
    range_entries: int = RANGE_ENTRIES,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: the ``top`` phrases of each language.

    a is the count of the phrase, l and r those of its two parts at the weaker cut, n the words of the language. A
    phrase goes that lies within a longer one with at least ``share`` hundredths of its count.
    Shards, counts and candidates are stored when this is called.
    """
    spark = docs.sparkSession
    made = stored(shards(docs, text, lang, shard_words), "phrase-shards", large_rows=True)
    cores = spark.sparkContext.defaultParallelism
    entries = made.agg(F.sum("entries")).first()[0] or 0
    borders = _borders(made, max(-(-entries // range_entries), min(-(-entries // 4096), 4 * cores)))
    with settings(spark, FEW_BYTES):
        counts = stored(count_phrases(made, borders, min_count), "phrase-counts", large_rows=True)
        cuts = stored(_cuts(counts), "phrase-cuts")
        found = stored(_looked_up(cuts, counts, borders), "phrase-parts")

    wide = lambda c: F.col(c).cast("decimal(19,0)")
    both = (
        cuts.join(found.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        .join(found.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    )
    million = F.lit(1_000_000).cast("decimal(7,0)")
    scored = both.withColumn("score", F.call_function("div", million * wide("a") * wide("a"), wide("l") * wide("r")))
    weakest = (
        scored.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")
    )
    longer = (
        cuts.filter("size = 3 and k = 1").select("lang", F.col("a").alias("f"), F.split("phrase", " ").alias("w"))
        .select("lang", "f", F.explode(F.array(*(F.concat_ws(" ", F.col("w")[i], F.col("w")[i + 1]) for i in (0, 1)))).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    )
    kept = weakest.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("f") < share * F.col("a"), F.lit(True)))
    # ranked in slices first, so that the last ranking sees SLICES times top rows at most, however many tasks there are
    sliced_by = F.pmod(F.xxhash64("phrase"), F.lit(SLICES))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    in_slice = F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))
    best = kept.withColumn("slice", sliced_by).withColumn("rank", in_slice).filter(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    sizes = made.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
