import random

import numpy as np
import pytest
import sentencepiece as library
from sentencepiece import sentencepiece_model_pb2 as pb

from tessera.llm import sentencepiece as sp

from .util import ODD_TEXTS, docs

TEXTS = ["", " ", "the", "Hello  world\n a", " x ", "日本語 テスト 😀", "ab\n\ncd", "a\u2581b c", "é" * 9, "x" * 300, "a\x00b\x7f"]


@pytest.fixture(scope="module")
def pieces():
    return sp.load()


def plain_viterbi(pieces, text):
    """Largest score over whole texts, character by character, without a trie."""
    if not text:
        return 0.0
    t = sp.MARKER + text.replace(" ", sp.MARKER)
    known = {pieces_surface: s for pieces_surface, s in pieces}
    least = min(known.values())
    longest = max(map(len, known))
    best = [0.0] + [float("-inf")] * len(t)
    for e in range(1, len(t) + 1):
        for s in range(max(0, e - longest), e):
            if t[s:e] in known:
                best[e] = max(best[e], best[s] + known[t[s:e]])
        if t[e - 1] not in known:
            best[e] = max(best[e], best[e - 1] + least - sp.UNKNOWN_COST)
    return best[-1]


def toy():
    spec = [("<unk>", 0.0, sp.UNKNOWN), ("<s>", 0.0, sp.CONTROL)] + [(f"<0x{b:02X}>", 0.0, sp.BYTE) for b in range(256)]
    rng = random.Random(5)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randrange(1, 5))) for _ in range(30)}
    words |= {sp.MARKER + w for w in list(words)[:12]} | {sp.MARKER, sp.MARKER * 2, "a", "b"}
    return spec + [(w, -rng.random() * 9, sp.NORMAL) for w in sorted(words)]


def total(p, spec, ids):
    """The score of an encoding: byte pieces belong to characters without a piece."""
    out, run = 0.0, b""
    for i in ids:
        if spec[i][2] == sp.BYTE:
            run += p.surfaces[i]
        else:
            out += spec[i][1]
    return out + len(run.decode()) * p.unknown_score


def test_score_is_the_best_one():
    spec = toy()
    p = sp.from_pieces(spec)
    known = [(w, s) for w, s, t in spec if t == sp.NORMAL]
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcé  z日\n") for _ in range(rng.randrange(0, 30))) for _ in range(200)]
    ids, ends = sp.encode_texts(p, texts)
    for t, own in zip(texts, np.split(ids, ends[:-1])):
        assert total(p, spec, own.tolist()) == pytest.approx(plain_viterbi(known, t)), t
        assert sp.decode_ids(p, own.tolist()) == t


def test_long_and_short_segments_agree(pieces):
    for t in ["aéx日b" * 9, "theonandhe" * 12, "😀a" * 20]:
        raw = t.encode()
        ids, first, size = sp.encode_segments(pieces, [t])
        piece, start = sp._walk_one(pieces, raw)
        many = sp._walk_many(pieces, np.frombuffer(raw, np.uint8)[None, :], np.array([len(raw)]))
        assert many[0][0].tolist() == piece and many[1][0].tolist() == start


def test_trie_holds_exactly_the_pieces(pieces):
    proto = pb.ModelProto()
    proto.ParseFromString(open(sp.MODEL, "rb").read())
    for i, piece in list(enumerate(proto.pieces))[300:32000:37]:
        state = 0
        for b in piece.piece.encode():
            nxt = pieces.base[state] + b
            assert pieces.check[nxt] == state
            state = nxt
        assert pieces.value[state] == i
    assert (pieces.value >= 0).sum() == sum(p.type == sp.NORMAL for p in proto.pieces)


def test_agrees_with_the_library_lattice(pieces):
    proto = pb.ModelProto()
    proto.ParseFromString(open(sp.MODEL, "rb").read())
    proto.trainer_spec.model_type = 1
    other = library.SentencePieceProcessor(model_proto=proto.SerializeToString())
    for t in ["the", "that is the one", "Hello world, here", "ndonre the.", "other things and more of it"]:
        ids, _ = sp.encode_texts(pieces, [t])
        assert ids.tolist() == other.nbest_encode(t, nbest_size=2)[0]
    for t in TEXTS:
        ids = other.encode(t)
        assert sp.decode_ids(pieces, ids) == other.decode(ids)
    assert sp.decode_ids(pieces, [int(pieces.byte_ids[0xC3])]) == other.decode([int(pieces.byte_ids[0xC3])])


def test_round_trip_and_edge_cases(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS + ODD_TEXTS)] + [(None, "the"), (3, "again"), (3, "again")]
    df = docs(spark, rows).selectExpr("*", "1 AS ids", "2 AS n_pieces")
    coded = sp.encode(df)
    back = {(r.doc_id, r.text) for r in sp.decode(coded).collect()}
    assert back == {(i, (t or "").replace("\u2581", " ")) for i, t in rows}
    for r in coded.collect():
        assert r.n_pieces == len(r.ids)
    flags = {r.doc_id: r.round_trip for r in coded.collect() if r.doc_id != 3}
    assert all(ok != ("\u2581" in (dict(rows)[i] or "")) for i, ok in flags.items() if i is not None)
    assert sp.encode(docs(spark, [])).count() == 0
