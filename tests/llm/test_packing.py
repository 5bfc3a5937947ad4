"""Packing against tokenizing whole texts; every id in exactly one piece."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pledgeflow.llm import packing
from tests.llm.cases import docs_of, empty, frame, prose, rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize(
    "text",
    ["", "It's i'LL don't. Stop.. a.,b x. ", "ΟΔΥΣΣΕΥΣ ſ K İ ŉ ²½ ´", "a\x1c\x85b c ́x. é.", "<|endoftext|>. a<|endoftext|>B <|ENDOFTEXT|>",
     "<|ENDOFTEXT|>", "a<|ENDOFTEXT|>b Ép. é!! x'!! y--\tz=~ ß; ö(#) a÷. a×!",
     "١٢ 12.5, 3. ñ. ß, 가 👍🏽.", prose(8, 500), "x" * 5000],
)
def test_pieces_give_the_ids_of_the_whole_text(tokenizer, text):
    made = np.frombuffer(packing.PieceIds(PATH)(text), "<u2").tolist()
    assert made == tokenizer.encode(text, add_special_tokens=False).ids


def test_a_full_dictionary_starts_afresh(tokenizer):
    ids_of = packing.PieceIds(PATH, keep=5)
    for text in (prose(1, 50), prose(2, 50), prose(1, 50)):
        assert np.frombuffer(ids_of(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("length", [16, 4096])
def test_every_id_lies_in_one_piece(spark, tokenizer, length):
    docs = frame(spark).repartition(3)
    pieces = packing.pack(docs, PATH, length=length).collect()
    total = 0
    by_sequence = {}
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] > 0
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        total += p["length"]
    for n, spans in by_sequence.items():
        at = 0
        for offset, size in sorted(spans):
            assert offset == at
            at += size
        assert at == (length if n < len(by_sequence) - 1 else total - length * n)
    assert sorted(by_sequence) == list(range(-(-total // length)))
    by_doc, want = {}, {}
    for i, text in ((r[0], r[1]) for r in rows() if r[0] not in (None, 5, 9)):
        want[i] = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
    for p in sorted(pieces, key=lambda p: p["start"]):
        if p["doc_id"] in want:
            assert p["start"] == len(by_doc.setdefault(p["doc_id"], []))
            by_doc[p["doc_id"]] += np.frombuffer(p["ids"], "<u4").tolist()
            assert p["doc_tokens"] == len(want[p["doc_id"]])
    assert by_doc == want


def test_padding_and_empty_tables(spark):
    assert [packing.padded_length(n, 16) for n in (1, 3, 8, 15, 16)] == [1, 16, 8, 16, 16]
    assert packing.pack(empty(spark), PATH).count() == 0
    one = packing.pack(docs_of(spark, [(1, None)]), PATH).first()
    assert (one["length"], one["sequence_length"], one["ids"]) == (1, 1, bytes([2, 0, 0, 0]))


def test_texts_learn_their_new_pieces_together(monkeypatch):
    ids_of, calls = packing.PieceIds(PATH), []
    learn = ids_of._learn
    monkeypatch.setattr(ids_of, "_learn", lambda new: calls.append(len(new)) or learn(new))
    found = ["one two", None, "", "two three!", "Three \u00e9t\u00e9 2024"]
    made = ids_of.each(found)
    assert len(calls) == 1
    assert made == [packing.PieceIds(PATH)(t) for t in found]


def test_pieces_met_again_while_the_dictionary_makes_room_are_not_learned_anew(monkeypatch):
    ids_of, learned = packing.PieceIds(PATH, keep=3), []
    learn = ids_of._learn
    monkeypatch.setattr(ids_of, "_learn", lambda new: learned.append(sorted(new)) or learn(new))
    texts = ["a b c", "d e", "a f", "a f d"]
    assert [ids_of(text) for text in texts] == [packing.PieceIds(PATH)(text) for text in texts]
    assert [one for one in learned if one] == [[b"a", b"b", b"c"], [b"d", b"e"], [b"f"]]


def test_control_characters_stay_with_the_signs_behind_them(tokenizer):
    for text in ("a\x7f! b", "x\x1c<. y", "\x00; z"):
        assert np.frombuffer(packing.PieceIds(PATH)(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_signs_of_several_texts_are_parted_at_once():
    found = ["one, two.", None, "\u00e9t\u00e9! it's', x...", "", ". a", "<|endoftext|>, B.", "three;"]
    ids_of = packing.PieceIds(PATH)
    pieces, ends = ids_of._pieces([packing.encoded(t) for t in found])
    parted = [pieces[a:b] for a, b in zip(ends, ends[1:])]
    assert parted[0] == [b"one", b",", b"two", b"."] and parted[1] == parted[3] == []
    assert parted[2] == ["\u00e9t\u00e9".encode(), b"!", b"it's',", b"x", b"..."]
    assert parted[4:] == [[b".", b"a"], [b"<|endoftext|>,", b"B."], [b"three", b";"]]
    plain = found[:5]
    pieces, ends = ids_of._pieces([packing.encoded(t) for t in plain])
    assert [pieces[a:b] for a, b in zip(ends, ends[1:])] == parted[:5]
    assert ids_of.each(found) == [packing.PieceIds(PATH)(t) for t in found]
