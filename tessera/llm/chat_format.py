"""Chat formatting with offset-aligned loss masks.

A template marks every turn: ``<s>[INST]role[/INST]text</s>``. The four control strings are
single ids of the tokenizer. Inside roles and texts they are escaped reversibly: a
backslash goes behind the first character of a control string, and one more where
some are there already; reading back takes one away. So an id of a control string
always is the template's.

* Render. A conversation's turns, in order, become one text; the spans of the assistant's
  texts are noted, in code points.
* Encode once. The whole text is encoded in one call; a token's byte length follows from its
  id, so the offsets are running sums, turned into code points by counting first bytes.
* Intersect. Token spans and turn spans are both sorted: a binary search finds for each token
  the last turn that starts before the token's end, and the token is under the loss mask if
  that turn ends after the token's start. Control strings are never merged with text, so the
  masked tokens cover the turn's text and nothing else.

A conversation of more than ``PART_CHARS`` characters is cut between turns into parts of about
that size, so that one with a third of all rows is many rows of many tasks. Turns begin and
end with control strings, so the parts' ids put together are the ids of the whole.

Edge cases: a null text or role is the empty string; rows of a null conversation id are
one conversation; a null turn comes first; repeated turn numbers go by role, then text; texts
of one conversation longer than a part make a part of their own; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import broadcast_if_small, key_of, materialize, ranked

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
ASSISTANT = "assistant"
PART_CHARS = 1_000_000
_MARKS = sum(map(len, CONTROL))  # characters of the template in one turn
# fixed value: the pattern that the rank files were made with
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PAIRS = re.compile(r"(<)(\\*)(/?s>)|(\[)(\\*)(/?INST\])")
_LONG_SPACE = re.compile(r"\s{100000}")  # the tokenizer's pattern can't cross runs of some 10 ** 6
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.S)


def escape(text: str) -> str:
    return _PAIRS.sub(lambda m: f"{m[1] or m[4]}\\{m[2] or m[5] or ''}{m[3] or m[6]}", text)


def unescape(text: str) -> str:
    return _PAIRS.sub(lambda m: f"{m[1] or m[4]}{(m[2] or m[5] or '')[1:]}{m[3] or m[6]}", text)


@lru_cache(1)
def tokenizer(path: str = RANKS) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding with the control strings as its last ids, and the byte length of each id."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    first = max(ranks.values()) + 1
    control = {c: first + k for k, c in enumerate(CONTROL)}
    sizes = np.zeros(first + len(CONTROL), np.int64)
    for token, i in [*ranks.items(), *((c.encode(), i) for c, i in control.items())]:
        sizes[i] = len(token)
    return tiktoken.Encoding("chat", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=control), sizes


def rendered(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """(text, spans): the formatted turns and the [start, end) of each assistant text."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<s>[INST]{escape(role)}[/INST]", escape(text)
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, "</s>"]
        at += len(head) + len(body) + 4
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def encoded(text: str, path: str = RANKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, starts, ends): one encoding of ``text``; a token that holds a part of a code point
    covers that code point. A run of white space is cut after each 100,000 characters."""
    coder, sizes = tokenizer(path)
    cuts = [0, *(m.end() for m in _LONG_SPACE.finditer(text)), len(text)]
    ids = np.array([i for a, b in zip(cuts, cuts[1:], strict=False)
                    for i in coder.encode(text[a:b], allowed_special=set(CONTROL))], np.int64)
    ends = np.cumsum(sizes[ids])
    first = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
    nth = np.cumsum(first)  # for each byte the number of its code point, from 1
    return ids, nth[ends - sizes[ids]] - 1, nth[ends - 1]


def masked(starts: np.ndarray, ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Whether a token [start, end) meets one of the sorted, disjoint ``spans``."""
    if not len(spans):
        return np.zeros(len(starts), bool)
    last = np.searchsorted(spans[:, 0], ends, "left") - 1
    return (last >= 0) & (spans[np.maximum(last, 0), 1] > starts)


def _parts(turns: DataFrame, part_chars: int) -> DataFrame:
    """``turns`` with ``part`` (long) and ``whole`` (boolean): turns of a conversation up to
    ``part_chars`` are whole and have part 0, those of a longer one are numbered by the
    characters ahead of them."""
    size = F.length("role") + F.length("text") + _MARKS
    long = turns.groupBy("conv").agg(F.sum(size).alias("chars")).where(F.col("chars") > part_chars)
    long = materialize(long.select(F.col("conv").alias("long_conv")), "chat-long")
    hint = broadcast_if_small(long)
    rest = turns.join(hint, F.col("conv") == F.col("long_conv"), "left_anti")
    rest = rest.withColumn("part", F.lit(0).cast("long")).withColumn("whole", F.lit(True))
    if long.limit(1).count() == 0:
        return rest
    cut = turns.join(hint, F.col("conv") == F.col("long_conv"), "left_semi").withColumn("chars", size.cast("long"))
    cut = ranked(cut, "conv", [F.col(c) for c in ("turn", "role", "text")], "chat-turns", "chars")
    return rest.unionByName(cut.withColumn("part", F.floor(F.col("before") / part_chars))
                            .withColumn("whole", F.lit(False)).drop("chars", "before", "total"))


def render(df: DataFrame, part_chars: int = PART_CHARS, path: str = RANKS) -> DataFrame:
    """(conv_id, part, whole, formatted, input_ids, starts, ends, loss) of the rows (conv_id, turn, role,
    text) of ``df``: ``starts`` and ``ends`` are the tokens' code points in ``formatted``,
    ``loss`` says which tokens are learned, ``whole`` that the conversation has no other part."""
    turns = df.select("conv_id", key_of(F.col("conv_id")).alias("conv"), "turn",
                      F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["conv", "part", "turn", "role", "text"]
    dealt = _parts(turns, part_chars).repartition("conv", "part").sortWithinPartitions(*order)
    names = ["conv_id", "part", "whole", "formatted", "input_ids", "starts", "ends", "loss"]
    kind = df.schema["conv_id"].dataType.simpleString()

    def rows(done: list[tuple], conv: pa.DataType) -> pa.RecordBatch:
        types = [conv, pa.int64(), pa.bool_(), pa.string(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.bool_())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, chars = [], 0
        for conv, key, turns in _runs(batches):
            text, spans = rendered(turns)
            ids, starts, ends = encoded(text, path)
            done.append((*key, text, ids, starts, ends, masked(starts, ends, spans)))
            chars += len(text)
            if chars > part_chars:
                yield rows(done, conv)
                done, chars = [], 0
        if done:
            yield rows(done, conv)

    return dealt.select("conv_id", "part", "whole", "role", "text").mapInArrow(
        run, f"conv_id {kind}, part long, whole boolean, formatted string, input_ids array<int>, starts array<int>, "
             "ends array<int>, loss array<boolean>")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.DataType, tuple, list[tuple[str, str]]]]:
    """(type of the id, (conv_id, part, whole), turns) of the sorted rows, as they come."""
    kind, now, turns = None, None, []
    for b in batches:
        kind = b.schema.field(0).type
        for *key, role, text in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if turns and key != now:
                yield kind, now, turns
                turns = []
            now = key
            turns.append((role, text))
    if turns:
        yield kind, now, turns


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of each turn of a formatted text."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def learned(formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> list[str]:
    """The runs of text under the loss mask, unescaped."""
    a, b = starts[loss], ends[loss]
    if not len(a):
        return []
    new = np.concatenate([[True], a[1:] > b[:-1]])  # tokens of one run touch or share a code point
    last = np.concatenate([new[1:], [True]])
    return [unescape(formatted[i:j]) for i, j in zip(a[new].tolist(), b[last].tolist(), strict=True)]


_SUMS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) for each
    conversation, from the formatted texts, offsets and masks alone. A whole conversation is
    digested where it lies, and only its digests are shuffled; the parts of a longer one come
    together in order and run through one digest, a part at a time."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    hexed = lambda text: hashlib.sha256(text.encode()).hexdigest()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [[] for _ in range(5)]
            for whole, text, *spans in zip(*[b.column(c) for c in ("whole", "formatted", "starts", "ends", "loss")], strict=True):
                text, spans = text.as_py(), [x.values.to_numpy(zero_copy_only=False) for x in spans]
                turns, own = turns_of(text), "".join(learned(text, *spans))
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                if whole.as_py():
                    said, loss = hexed(said), hexed(own)
                else:
                    loss = own
                for c, v in zip(cols, (len(turns), said, len(own), loss, len(text)), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("part"), b.column("whole"), *_sums(cols)],
                ["conv_id", "part", "whole", *_SUM_NAMES])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        long, now, sums, shas, conv_type = [], None, None, None, None

        def close() -> None:
            if shas:
                long.append((now, sums[0], shas[0].hexdigest(), sums[1], shas[1].hexdigest(), sums[2]))

        for b in batches:
            conv_type = b.schema.field("conv_id").type
            whole = b.column("whole")
            ready = b.filter(whole)
            yield pa.RecordBatch.from_arrays([ready.column(c) for c in ("conv_id", *_SUM_NAMES)], ["conv_id", *_SUM_NAMES])
            for r in b.filter(pc.invert(whole)).to_pylist():
                if shas is None or r["conv_id"] != now:
                    close()
                    now, sums, shas = r["conv_id"], [0, 0, 0], [hashlib.sha256(), hashlib.sha256()]
                for h, c in zip(shas, ("turns_sha256", "loss_sha256"), strict=True):
                    h.update(r[c].encode())
                sums = [n + r[c] for n, c in zip(sums, ("n_turns", "loss_chars", "formatted_chars"), strict=True)]
        close()
        if long:
            conv, *cols = zip(*long, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(conv, conv_type), *_sums(cols)], ["conv_id", *_SUM_NAMES])

    parsed = formatted.select("conv_id", "part", "whole", "formatted", "starts", "ends", "loss").mapInArrow(
        parse, f"conv_id {kind}, part long, whole boolean, {_SUMS}")
    return (parsed.repartition("conv_id").sortWithinPartitions("conv_id", "part")
            .mapInArrow(digest, f"conv_id {kind}, {_SUMS}"))


_SUM_NAMES = [f.split()[0] for f in _SUMS.split(", ")]


def _sums(cols) -> list[pa.Array]:
    return [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)]


def sql(table: str = "conversations") -> str:
    """DuckDB SQL of ``read_back(render(table))`` and of one more conversation, -1."""
    escaped = r"""regexp_replace({0}, '(<)(\\*)(/?s>)|(\[)(\\*)(/?INST\])', '\1\4\\\2\5\3\6', 'g')"""
    return f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {table}
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = '{ASSISTANT}' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = '{ASSISTANT}' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       sum({_MARKS} + length({escaped.format("role")}) + length({escaped.format("text")}))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id"""
