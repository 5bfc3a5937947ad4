"""Token files: exact round trips, damage, and documents against the tokenizer."""

import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pledgeflow.llm import token_files as T
from tests.llm.cases import docs_of, empty, frame, prose, rows

PATH = public_tokenizers.path("word_bpe_49k.json")


def table_of(ids):
    return T.Frequencies.of(*np.unique(ids, return_counts=True))


@pytest.mark.parametrize("n", [1, 2, 63, 64, 130, 5_000, 300_000])
@pytest.mark.parametrize("spread", [1, 3, 40_000])
def test_blocks_come_back(n, spread):
    ids = (np.random.default_rng(n).pareto(0.6, n) * 3).astype(np.int64) % spread + 7
    table = table_of(ids)
    assert table.share.sum() == 1 << T.SCALE and (table.share[np.unique(ids)] > 0).all()
    block = T.encode(ids, table)
    assert (T.decode(block, table) == ids).all()
    for first, last in ((0, 1), (n // 3, n // 2), (n - 1, n), (n // 2, n + 5), (5, 5)):
        assert (T.decode(block, table, first, last) == ids[first:last]).all()
    if n == 300_000:
        shares = table.share[ids] / (1 << T.SCALE)
        least = -np.log2(shares).sum() / 8
        assert len(block) < 1.01 * least + 3 * 8 * T.LANES + 200


def test_a_stretch_is_decoded_from_its_checkpoint_alone(monkeypatch):
    ids = np.random.default_rng(1).integers(0, 500, 1 << 20)
    table = table_of(ids)
    block = bytearray(T.encode(ids, table))
    block[-4:] = b"\1\2\3\4"  # words of the last stretch
    block[28:32] = crc32(block[32:]).to_bytes(4, "little")
    stretch = T.LANES * T.CHECK_ROWS
    assert (T.decode(bytes(block), table, 10, stretch) == ids[10:stretch]).all()
    with pytest.raises(T.Damaged, match="ids differ"):
        T.decode(bytes(block), table, len(ids) - 5)


def test_damage_is_told():
    ids = np.arange(1000) % 17
    table, other = table_of(ids), table_of(ids % 5)
    block = T.encode(ids, table)
    for bad in (block[:10], block[:-1], b"x" + block[1:], block[:200] + b"\xff" + block[201:]):
        with pytest.raises(T.Damaged):
            T.decode(bad, table)
    with pytest.raises(T.Damaged, match="frequencies"):
        T.decode(block, other)


def test_shares_of_large_counts():
    table = T.Frequencies.of(np.array([0, 5, 9]), np.array([1, 1 << 50, (1 << 62) - 1]))
    assert table.share.sum() == 1 << T.SCALE and table.share[0] == 1 and len(table.owner) == 1 << T.SCALE
    with pytest.raises(ValueError, match="too many"):
        T.Frequencies.of(np.arange(1 << 20), np.ones(1 << 20, np.int64))


def test_checksums_of_pieces():
    r = random.Random(3)
    data = r.randbytes(5000)
    cuts = [0, 1, 17, 900, 900, 4999, 5000]
    whole = 0
    for a, b in zip(cuts, cuts[1:]):
        whole ^= T.moved(crc32(data[a:b]), len(data) - b)
    assert whole == crc32(data)


def test_documents(spark, tmp_path):
    tokenizer = Tokenizer.from_file(PATH)
    docs = frame(spark).repartition(3)
    folder = T.write(docs, PATH, str(tmp_path / "files"))
    got = sorted(map(tuple, T.read_documents(spark, folder).collect()), key=lambda r: r[1])
    want = sorted(((i, text) for i, text, *_ in rows()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r[0] for r in got] == [i for i, _ in want]
    ids_of = lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
    at = 0
    for key, start, n, _ in got:
        assert start == at and n > 0
        at += n
    digest = lambda ids: (len(ids), crc32(np.array(ids, "<u4").tobytes()))
    order = lambda xs: sorted(xs, key=str)
    assert order((i, n, c) for i, _, n, c in got) == order((i, *digest(ids_of(t))) for i, t in want)
    pieces = {}
    for r in sorted(T.read_ids(spark, folder).collect(), key=lambda r: r["piece_start"]):
        assert len(pieces.setdefault(r["start"], [])) == r["piece_start"]
        pieces[r["start"]] += r["ids"]
    assert {start: digest(ids) for start, ids in pieces.items()} == {start: (n, c) for _, start, n, c in got}


def test_small_blocks_cut_documents(monkeypatch):
    import pyarrow as pa
    from pyspark.sql.types import LongType

    monkeypatch.setattr(T, "BLOCK_IDS", 50)
    monkeypatch.setattr(T.TaskContext, "get", staticmethod(lambda: type("C", (), {"partitionId": lambda self: 4})()))
    lengths, r = [1, 49, 50, 51, 170, 3, 3, 200], np.random.default_rng(5)
    ids = [r.integers(0, 90, n).astype("<u2") for n in lengths]
    table = table_of(np.concatenate(ids))
    shared = "a test", type("B", (), {"value": table.share})()
    schema = T._blocks_schema(LongType())
    batch = pa.RecordBatch.from_pydict({"doc_id": [None, *range(7)], "n_tokens": lengths, "ids": [i.tobytes() for i in ids]})
    made = [b.to_pylist()[0] for b in T._encoder("doc_id", schema, shared)(iter([batch]))]
    assert [b["block"] for b in made] == list(range(len(made))) and {b["part"] for b in made} == {4}
    done, whole, crcs = 0, {}, {}
    for b in made:
        assert b["first"] == done and b["n_ids"] <= 50
        done += b["n_ids"]
        found, at = T.decode(b["data"], table), 0
        for place, start, n, behind in zip(b["places"], b["starts"], b["lengths"], b["behind"]):
            assert start == len(whole.setdefault(place, []))
            whole[place] += found[at : at + n].tolist()
            crcs[place] = crcs.get(place, 0) ^ T.moved(crc32(found[at : at + n].tobytes()), 4 * behind)
            at += n
    assert done == sum(lengths) and list(whole.values()) == [i.tolist() for i in ids]
    assert list(crcs.values()) == [crc32(i.astype("<u4").tobytes()) for i in ids]


def test_empty_tables_and_hot_ids(spark):
    assert T.read_documents(spark, T.write(empty(spark), PATH)).count() == 0
    hot = docs_of(spark, [(7, prose(1, 30))] * 40 + [(i, prose(i, 9)) for i in range(20)]).repartition(5)
    got = sorted(map(tuple, T.read_documents(spark, T.write(hot, PATH)).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted([7] * 40 + list(range(20)))
