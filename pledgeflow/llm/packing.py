"""Concatenate and cut: all documents end to end, cut into windows of equal length.

Pass one tokenizes and stores, per document, its ids and where it begins within
its partition. The totals of the partitions, one number each, are summed up on
the driver; with them pass two knows every document's place in the whole and
cuts it at the window boundaries. Nothing is sorted or shuffled, and only the
last window has padding.

Ids are looked up per piece of text between white space; the tokenizer sees a
piece only when the worker's dictionary does not have it. That gives the same ids,
since this kind of tokenizer drops white space and never joins across it (tests
compare with whole texts).

Defined cases: a null or empty text is the end id alone; repeated rows are packed
as often as they come; an empty table gives no pieces. The order of documents in
the sequences is that of the stored partitions and is not promised otherwise.
The result has the columns listed at ``pack``; others of the input are dropped.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import accumulate, chain, compress, count, pairwise, repeat
from operator import not_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from pledgeflow.llm.common import LOWER, as_batch, encoded, kept_in_worker, parts, stored

LENGTH, END_ID = 4096, 2
#: Pieces of text in each of the two generations of a worker's dictionary, 150 bytes each.
CACHE_PIECES = 250_000
#: White space; signs; those that may be parted from the letter before them, which an apostrophe may belong to.
_SPACE, _SIGN = (np.isin(np.arange(256), list(some)) for some in (b" \t\n\r\x0b\x0c", b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))
_PARTED = _SIGN & (np.arange(256) != ord("'"))
#: Bytes that such signs do not follow: white space, control characters, signs and those outside ASCII.
_KEPT_WITH = _SIGN | (np.arange(256) < 33) | (np.arange(256) > 126)
#: Second bytes of the letters \u00df to \u00ff, which signs are parted from as well.
_LATIN = np.isin(np.arange(256), [*range(0x9F, 0xB7), *range(0xB8, 0xC0)])
#: Letters that stay one letter when lower-cased.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")
#: Ids of a document that leave a task in one batch, about.
BATCH_IDS = 4_000_000
#: Texts that are Python objects at a time; bytes of texts whose new pieces are learned in one call.
BATCH_TEXTS, LEARN_BYTES = 500, 300_000


def _partings(codes: np.ndarray) -> np.ndarray:
    """Where the signs begin that a piece ends with, and that follow neither a sign, a control character nor a letter outside
    ASCII other than \u00df to \u00ff. The bytes begin and end with white space."""
    signs = _PARTED[codes]
    edges = np.flatnonzero(signs[1:] != signs[:-1]) + 1
    first, end = edges[::2], edges[1::2]
    first = first[_SPACE[codes[end]]]
    last = codes[first - 1]
    return first[~_KEPT_WITH[last] | (codes[first - 2] == 0xC3) & _LATIN[last]]


class PieceIds:
    """Ids of a text as little-endian unsigned 16- or 32-bit numbers, piece by piece.

    For a tokenizer that lower-cases, drops white space, splits letters from signs and marks
    the last id of every word. Signs after a letter and before white space are a piece of their own,
    so that words are known with and without them. New words of letters alone skip what the tokenizer does to
    whole texts: they are lower-cased here and go in one text to its merges, and the marks tell their ids
    apart; other new pieces go through the whole tokenizer one by one.

    A dictionary keeps the pieces seen. When it is full it becomes the older of two, whose pieces come back
    once they are met again, also when it makes room itself; so words in frequent use are not learned anew.
    """

    def __init__(self, path: str, keep: int = CACHE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        size = 1 + max(vocabulary.values())
        self.type = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.ends = np.zeros(size, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # the letters that stand for bytes: printable ones for themselves, the others from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = (b for b in range(256) if b not in plain)
        self.letters = {b: b for b in plain} | {b: 256 + n for n, b in enumerate(other)} | {32: 32}
        self.keep, self.known, self.older = keep, {}, {}

    def __call__(self, text: str | None) -> bytes:
        return self.each([text])[0]

    def each(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; new pieces of several texts are learned together."""
        out: list[bytes] = []
        held: list[bytes] = []
        size = 0
        for text in texts:
            held.append(encoded(text))
            size += len(held[-1])
            if size >= LEARN_BYTES:
                out += self._together(held)
                held, size = [], 0
        return out + self._together(held)

    def _together(self, texts: list[bytes]) -> list[bytes]:
        pieces, ends = self._pieces(texts)
        made = self._ids(pieces)
        return [b"".join(made[a:b]) for a, b in pairwise(ends)]

    def _pieces(self, texts: list[bytes]) -> tuple[list[bytes], list[int]]:
        """The pieces of some texts, and where each text begins and ends among them."""
        whole = b"\n".join([b"", *texts, b""])
        low = whole.translate(LOWER)
        if any(s in low for s in self.special):
            found = [t.split() if any(s in t.translate(LOWER) for s in self.special) else self._pieces([t])[0] for t in texts]
            return list(chain.from_iterable(found)), list(accumulate(map(len, found), initial=0))
        codes = np.frombuffer(low, np.uint8)
        at = _partings(codes)
        codes = np.insert(codes, at, 32)
        space = _SPACE[codes]
        stops = np.cumsum([1, *(len(t) + 1 for t in texts)])
        begins = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        return codes.tobytes().split(), np.searchsorted(begins, stops + np.searchsorted(at, stops)).tolist()

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece. A piece that is not found has none at first, as has one that the tokenizer drops."""
        made = list(map(self.known.get, pieces, repeat(b"")))
        places = list(compress(count(), map(not_, made)))
        if places:
            missing = list(map(pieces.__getitem__, places))
            new = set(missing).difference(self.known)
            back = {p: self.older[p] for p in new if p in self.older}
            if len(self.known) + len(new) > self.keep:
                # those missing and known without ids come along
                back |= {p: self.known[p] for p in missing if p in self.known}
                self.known, self.older = {}, self.known
            self.known.update(back)
            self._learn(list(new.difference(back)))
            for place, ids in zip(places, map(self.known.__getitem__, missing)):
                made[place] = ids
        return made

    def _learn(self, new: list[bytes]) -> None:
        plain = list(filter(bytes.isalpha, new))
        joined = b" ".join(plain).decode().lower()
        other = {p: p.decode("utf-8", "replace") for p in new if not p.isalpha()}
        if letters := [p for p, text in other.items() if _LETTERS.fullmatch(text)]:
            more = " ".join(map(other.__getitem__, letters)).lower().encode().decode("latin-1").translate(self.letters)
            joined = f"{joined} {more}" if plain else more
            plain += letters
        made = np.array(self.merges.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.type)
        cuts = (np.flatnonzero(self.ends[made]) + 1) * self.type.itemsize
        if len(cuts) == len(plain):
            cuts = cuts.tolist()
            self.known.update(zip(plain, map(made.tobytes().__getitem__, map(slice, [0, *cuts], cuts))))
        rest = [p for p in new if p not in self.known]
        texts = [p.decode("utf-8", "replace") for p in rest]
        for piece, one in zip(rest, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            self.known[piece] = np.array(one.ids, self.type).tobytes()


def piece_ids(path: str, keep: int = CACHE_PIECES) -> PieceIds:
    """The dictionary of a Python worker, kept between its tasks."""
    return kept_in_worker("pieces", (path, keep), lambda: PieceIds(path, keep))


def tokenized(
    docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", end_id: int = END_ID, keep: int = CACHE_PIECES
) -> DataFrame:
    """(id, part, first, n_tokens, ids): a document's ids with the end id, and the ids before it in its partition."""
    schema = StructType(
        [
            StructField(id, docs.schema[id].dataType),
            StructField("part", IntegerType()),
            StructField("first", LongType()),
            StructField("n_tokens", LongType()),
            StructField("ids", BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = piece_ids(path, keep)
        end = np.array([end_id], ids_of.type).tobytes()
        part, done, target = TaskContext.get().partitionId(), 0, to_arrow_schema(schema)
        for batch in parts(batches, BATCH_TEXTS):
            ids, first, lengths = [], [], []
            for made in ids_of.each(batch.column(text).to_pylist()):
                ids.append(made + end)
                first.append(done)
                lengths.append(len(ids[-1]) // ids_of.type.itemsize)
                done += lengths[-1]
            rows = {id: batch.column(id), "part": [part] * len(ids), "first": first, "n_tokens": lengths, "ids": ids}
            yield as_batch(rows, target)

    return docs.select(id, text).mapInArrow(run, schema)


def padded_length(filled: int, length: int = LENGTH) -> int:
    """A sequence is padded to full length, unless what it holds is a power of two."""
    return filled if filled & (filled - 1) == 0 else length


def pack(
    docs: DataFrame,
    path: str,
    id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    keep: int = CACHE_PIECES,
) -> DataFrame:
    """One row per piece of a document that lies in one sequence.

    id, start (the document's ids before the piece), length, ids (little-endian
    unsigned 32-bit numbers), doc_tokens, sequence_id, offset (in the sequence), sequence_length (padded).
    Tokenizes and stores the documents when called; ``keep`` pieces of text are in each generation of a worker's dictionary.
    """
    spark = docs.sparkSession
    whole = stored(tokenized(docs, path, id, text, end_id, keep), "token-ids")
    totals = dict(whole.groupBy("part").agg(F.max(F.col("first") + F.col("n_tokens"))).collect())
    parts = sorted(totals)
    before = dict(zip(parts, accumulate([0, *(totals[p] for p in parts)])))
    begins = spark.sparkContext.broadcast((before, sum(totals.values())))
    return whole.mapInArrow(_cutter(id, length, begins), _pieces(docs, id))


def _pieces(docs: DataFrame, id: str) -> StructType:
    names = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_length")
    kinds = {"ids": BinaryType()}
    return StructType(
        [StructField(id, docs.schema[id].dataType), *(StructField(n, kinds.get(n, LongType())) for n in names)]
    )


def _cutter(id: str, length: int, begins) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, total = begins.value
        last, rest = total // length, total % length
        for batch in batches:
            target = pa.schema([batch.schema.field(id), *(pa.field(n, pa.binary() if n == "ids" else pa.int64()) for n in names)])
            rows: dict[str, list] = {n: [] for n in (id, *names)}
            held = 0
            columns = (batch.column(n).to_pylist() for n in (id, "part", "first", "n_tokens", "ids"))
            for key, part, first, n, ids in zip(*columns):
                wide = np.frombuffer(ids, f"<u{len(ids) // n}").astype("<u4")
                at = before[part] + first
                cut = 0
                while cut < n:
                    sequence, offset = divmod(at + cut, length)
                    size = min(length - offset, n - cut)
                    filled = rest if sequence == last else length
                    values = (key, cut, size, wide[cut : cut + size].tobytes(), n, sequence, offset, padded_length(filled, length))
                    for name, value in zip((id, *names), values):
                        rows[name].append(value)
                    cut += size
                held += n
                if held >= BATCH_IDS:
                    yield as_batch(rows, target)
                    rows, held = {n: [] for n in (id, *names)}, 0
            yield as_batch(rows, target)

    return run
