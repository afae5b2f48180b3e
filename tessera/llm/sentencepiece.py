"""SentencePiece encoding and decoding: a unigram Viterbi over a double-array trie.

Spaces become the marker U+2581, one marker is put in front, and the pieces with the
largest sum of log scores that spell the text are its encoding; of equally good ones the
one whose last piece is longer, at the last place where they differ. A character that no
piece covers costs the least score minus 10 and is written as the pieces of its UTF-8
bytes. Decoding joins pieces, turns byte pieces into bytes (invalid ones into U+FFFD),
markers into spaces, and drops the space in front.

No piece of a usual model has a marker after another character, so an encoding never
joins what stands before a marker with what follows: texts are cut there, and each
distinct segment is encoded once a batch. Tasks run the trie and the Viterbi over many
segments at a time, one byte position of all of them together; a segment much longer than
others is walked alone. Memory follows the longest single text.

The model file is read on the driver; its trie goes to the tasks. Tokenizers are never
trained here.

Edge cases: null and empty texts have no ids and decode to the empty text; a text that holds
U+2581 itself decodes with spaces in its place; rows are independent, ids may be null
or repeated; an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from ._batch import coded, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN_COST = 10.0
# fixed values: the piece types of the model format
NORMAL, UNKNOWN, CONTROL, USER, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
_ALONE = 192  # bytes from which a segment is walked alone
_CELLS = 1 << 18  # (segments x bytes) of one matrix


@dataclass
class Pieces:
    """The pieces of a model with their double-array trie: state s goes on byte c to
    ``base[s] + c`` if ``check`` there is s; ``value`` is the piece that ends in a state."""
    surfaces: list[bytes]
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown_id: int
    unknown_score: float
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    cut: re.Pattern


def build_trie(keys: list[bytes], values: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value) of the double array for distinct keys."""
    children: list[dict[int, int]] = [{}]
    ends = {}
    for key, v in zip(keys, values, strict=True):
        node = 0
        for c in key:
            nxt = children[node].get(c)
            if nxt is None:
                nxt = children[node][c] = len(children)
                children.append({})
            node = nxt
        ends[node] = v
    size = 2 * len(children) + 1024
    base, check, value = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    used = np.zeros(size, bool)
    used[0] = True
    todo, first = [(0, 0)], 1
    for node, state in todo:
        if node in ends:
            value[state] = ends[node]
        if not children[node]:
            continue
        codes = np.array(sorted(children[node]), np.int64)
        while used[first]:
            first += 1
        begin, at, look = first, -1, 64
        while at < 0:  # the lowest place where all children are free, more places at a time
            if begin + look + 256 > len(used):
                more = len(used) + 4096
                used = np.concatenate([used, np.zeros(more, bool)])
                base = np.concatenate([base, np.zeros(more, np.int64)])
                check, value = (np.concatenate([x, np.full(more, -1)]) for x in (check, value))
            places = np.nonzero(~used[begin:begin + look])[0] + begin - codes[0]
            places = places[places > 0]
            fits = np.nonzero(~used[places[:, None] + codes[None, :]].any(1))[0]
            at = int(places[fits[0]]) if len(fits) else -1
            begin, look = begin + look, min(2 * look, 4096)
        base[state] = at
        used[at + codes] = True
        if at > first and used[first:at].mean() > 0.9:  # what is free below is too scattered
            first = at
        check[at + codes] = state
        todo += [(children[node][int(c)], at + int(c)) for c in codes]
    pad = 256
    return (np.concatenate([base, np.zeros(pad, np.int64)]), np.concatenate([check, np.full(pad, -1)]),
            np.concatenate([value, np.full(pad, -1)]))


def load(path: str = MODEL) -> Pieces:
    """The pieces of a SentencePiece model file."""
    proto = model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    return from_pieces([(p.piece, p.score, p.type) for p in proto.pieces])


def from_pieces(pieces: list[tuple[str, float, int]]) -> Pieces:
    normal = [s for _, s, t in pieces if t == NORMAL]
    best, least = max(normal, default=0.0), min(normal, default=0.0)
    scores = np.array([len(p.encode()) * best - 0.1 if t == USER else s for p, s, t in pieces])
    surfaces, byte_ids, unknown = [], np.full(256, -1, np.int64), 0
    for i, (p, _, t) in enumerate(pieces):
        if t == BYTE:
            byte_ids[int(p[3:5], 16)] = i
            surfaces.append(bytes([int(p[3:5], 16)]))
        elif t == CONTROL:
            surfaces.append(b"")
        else:
            surfaces.append(p.replace(MARKER, " ").encode() if t != UNKNOWN else " ⁇ ".encode())
        unknown = i if t == UNKNOWN else unknown
    in_trie = [i for i, (p, _, t) in enumerate(pieces) if t in (NORMAL, USER) and p]
    texts = [pieces[i][0] for i in in_trie]
    if any(MARKER in p.lstrip(MARKER) for p in texts):
        raise ValueError("a piece has a marker after another character")
    line = "\n" if not any("\n" in p and p != "\n" for p in texts) else ""
    cut = re.compile(f"{line}|{MARKER}+[^{MARKER}{line}]*|[^{MARKER}{line}]+" if line else f"{MARKER}+[^{MARKER}]*|[^{MARKER}]+")
    return Pieces(surfaces, scores, byte_ids, unknown, least - UNKNOWN_COST,
                  *build_trie([t.encode() for t in texts], in_trie), cut)


def _char_sizes(b: np.ndarray) -> np.ndarray:
    """Bytes of the character that begins with each byte; 0 inside a character."""
    return np.select([b < 0x80, b < 0xC0, b < 0xE0, b < 0xF0], [1, 0, 2, 3], 4)


def _walk_many(p: Pieces, text: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best last piece (-1: a character without one) and its start for every prefix of the
    segments in the rows of ``text`` (bytes, padded with 0)."""
    n, width = text.shape
    chars = _char_sizes(text)
    best = np.full((n, width + 1), -np.inf)
    best[:, 0] = 0
    piece, start = np.full((n, width + 1), -2, np.int32), np.zeros((n, width + 1), np.int32)
    for s in range(width):
        rows = np.nonzero((best[:, s] > -np.inf) & (s < size))[0]
        single = np.zeros(n, bool)
        at, state, e = rows, np.zeros(len(rows), np.int64), s
        while len(at) and e < width:
            nxt = p.base[state] + text[at, e]
            ok = (p.check[nxt] == state) & (e < size[at])
            at, state, e = at[ok], nxt[ok], e + 1
            v = p.value[state]
            end = v >= 0
            if end.any():
                i, v = at[end], v[end]
                single[i[chars[i, s] == e - s]] = True
                total = best[i, s] + p.scores[v]
                better = total > best[i, e]
                i, v, total = i[better], v[better], total[better]
                best[i, e], piece[i, e], start[i, e] = total, v, s
        left = rows[~single[rows]]
        e = s + chars[left, s]
        total = best[left, s] + p.unknown_score
        better = total > best[left, e]
        left, e = left[better], e[better]
        best[left, e], piece[left, e], start[left, e] = total[better], -1, s
    return piece, start


def _walk_one(p: Pieces, text: bytes, step: int = 1 << 16) -> tuple[list[int], list[int]]:
    """The same for one segment of any length, as lists."""
    n, neg = len(text), float("-inf")
    best, piece, start = [neg] * (n + 1), [-2] * (n + 1), [0] * (n + 1)
    best[0] = 0.0
    base, check, value, scores = p.base.tolist(), p.check.tolist(), p.value.tolist(), p.scores.tolist()
    for s in range(n):
        here = best[s]
        if here == neg:
            continue
        b = text[s]
        size = 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
        state, single = 0, False
        for e in range(s, n):
            nxt = base[state] + text[e]
            if check[nxt] != state:
                break
            state = nxt
            v = value[state]
            if v >= 0:
                single |= e + 1 - s == size
                if here + scores[v] > best[e + 1]:
                    best[e + 1], piece[e + 1], start[e + 1] = here + scores[v], v, s
        if not single and here + p.unknown_score > best[s + size]:
            best[s + size], piece[s + size], start[s + size] = here + p.unknown_score, -1, s
    return piece, start


def encode_segments(p: Pieces, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, first, size): the ids of segment i are the ``size[i]`` ones from ``first[i]``."""
    raw = [s.encode() for s in segments]
    length = np.fromiter(map(len, raw), np.int64, len(raw))
    order = np.argsort(length, kind="stable")
    parts, size, done = [], np.zeros(len(raw), np.int64), 0
    while done < len(order) and length[order[done]] <= _ALONE:
        n = max(1, min(len(order) - done, _CELLS // (int(length[order[done]]) + 1)))
        some = order[done:done + n]
        some = some[length[some] <= min(_ALONE, 2 * length[some[0]] + 4)]
        text = np.frombuffer(b"".join(raw[i].ljust(int(length[some[-1]]), b"\0") for i in some), np.uint8)
        ids, size[some] = _spelled(p, text.reshape(len(some), -1), length[some])
        parts.append(ids)
        done += len(some)
    for i in order[done:]:
        piece, start = _walk_one(p, raw[i])
        at, out = len(raw[i]), []
        while at > 0:
            own = [piece[at]] if piece[at] >= 0 else _bytes_of(p, np.frombuffer(raw[i][start[at]:at], np.uint8))[::-1]
            out.extend(own)
            at = start[at]
        size[i] = len(out)
        parts.append(np.array(out[::-1], np.int64))
    first = np.zeros(len(raw), np.int64)
    first[order] = np.cumsum(size[order]) - size[order]
    return np.concatenate([*parts, np.zeros(0, np.int64)]), first, size


def _spelled(p: Pieces, text: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, number of ids) of the segments in the rows of ``text``, one after the other."""
    piece, start = _walk_many(p, text, size)
    at, ids, rows = size.copy(), [], []
    while (live := np.nonzero(at > 0)[0]).size:  # from the end, one piece of every segment at a time
        v, s = piece[live, at[live]], start[live, at[live]]
        known = v >= 0
        ids.append(v[known].astype(np.int64))
        rows.append(live[known])
        for r, a, b in zip(live[~known].tolist(), s[~known].tolist(), at[live[~known]].tolist(), strict=True):
            own = _bytes_of(p, text[r, a:b])[::-1]
            ids.append(own)
            rows.append(np.full(len(own), r))
        at[live] = s
    ids, rows = np.concatenate(ids)[::-1], np.concatenate(rows)[::-1]
    return ids[np.argsort(rows, kind="stable")], np.bincount(rows, minlength=len(text))


def _bytes_of(p: Pieces, char: np.ndarray) -> np.ndarray:
    """The byte pieces of a character, or the unknown piece in a model without them."""
    ids = p.byte_ids[char]
    return ids if (ids >= 0).all() else np.array([p.unknown_id], np.int64)


def encode_texts(p: Pieces, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ends) of whole texts."""
    def segments(t: str) -> list[str]:
        return p.cut.findall(MARKER + t.replace(" ", MARKER)) if t else []

    vocabulary, codes, ends = coded(texts, segments)
    ids, first, size = encode_segments(p, vocabulary)
    n = size[codes]
    stop = np.cumsum(n)
    at = np.repeat(first[codes] - (stop - n), n) + np.arange(int(stop[-1]) if len(stop) else 0)
    return ids[at].astype(np.int32), np.concatenate([[0], stop])[ends]


def decode_ids(p: Pieces, ids: list[int]) -> str:
    """The text of an encoding."""
    return decode_bytes(b"".join(map(p.surfaces.__getitem__, ids)))


def decode_bytes(joined: bytes) -> str:
    text = joined.decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """(id, ids array<int>, n_pieces, n_byte_pieces, round_trip): ``round_trip`` says whether the
    ids decode to the text."""
    p = load(model)
    is_byte = np.zeros(len(p.surfaces), bool)
    is_byte[p.byte_ids[p.byte_ids >= 0]] = True
    docs = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    names = [id_col, "ids", "n_pieces", "n_byte_pieces", "round_trip"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for some in slices(t.as_py() for t in b.column("text")):
                ids, ends = encode_texts(p, some)
                starts = np.concatenate([[0], ends[:-1]])
                same = [decode_ids(p, ids[i:j].tolist()) == t for i, j, t in zip(starts, ends, some, strict=True)]
                n_bytes = np.concatenate([[0], np.cumsum(is_byte[ids])])
                yield pa.RecordBatch.from_arrays(
                    [b.column(id_col).slice(at, len(some)),
                     pa.ListArray.from_arrays(pa.array(np.append(starts[:1], ends), pa.int32()), pa.array(ids, pa.int32())),
                     pa.array(ends - starts, pa.int64()), pa.array(n_bytes[ends] - n_bytes[starts], pa.int64()),
                     pa.array(same, pa.bool_())], names)
                at += len(some)

    return docs.mapInArrow(run, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, ids array<int>, "
                                "n_pieces long, n_byte_pieces long, round_trip boolean")


def decode(coded_docs: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """(id, text) of encoded documents; null ids decode to the empty text."""
    p = load(model)
    docs = coded_docs.select(F.col(id_col), F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [decode_ids(p, x.as_py() or []) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([b.column(id_col), pa.array(texts, pa.string())], [id_col, "text"])

    return docs.mapInArrow(run, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, text string")
