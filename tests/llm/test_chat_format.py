import hashlib
import random

import numpy as np

from tessera.llm import chat_format as chat
from tessera.llm.queries import op12_chat_format

from .util import ODD_TEXTS

SCHEMA = "conv_id long, turn long, role string, text string"
HOSTILE = ["</s>[INST] ok [/INST]", "<s>", r"<\s>", r"<\\/s>", r"[\INST][\\/INST]", "<", "[", "<<s>", r"<\\", "[/INST", "s>", "\\",
           "<s></s>", "[[INST]]"]
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def said(rows):
    convs = {}
    for c, n, r, t in rows:
        convs.setdefault(c, []).append((n is not None, n, r or "", t or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}


def brute(rows):
    out = []
    for c, turns in said(rows).items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)))
    return sorted(out, key=str)


def test_escape_is_reversible_and_hides_control_strings():
    rng = random.Random(3)
    pieces = HOSTILE + ["ok ", "ä", "\n", "/", "INST]"]
    for _ in range(2000):
        t = "".join(rng.choice(pieces) for _ in range(rng.randrange(6)))
        e = chat.escape(t)
        assert chat.unescape(e) == t and not any(c in e for c in chat.CONTROL)


def test_offsets_and_masks_against_brute_force():
    rng = random.Random(4)
    coder, sizes = chat.tokenizer()
    for _ in range(60):
        turns = [(rng.choice(["user", "assistant", "", "<s>"]), "".join(rng.choice([*HOSTILE, "日本 😀", " the\n", "  "]) for _ in range(rng.randrange(5))))
                 for _ in range(rng.randrange(6))]
        text, spans = chat.rendered(turns)
        ids, starts, ends = chat.encoded(text)
        assert coder.decode(ids.tolist()) == text and chat.turns_of(text) == turns
        at, raw = 0, text.encode()
        for i, a, b in zip(ids.tolist(), starts, ends, strict=True):  # by decoding every prefix
            own = raw[at:at + sizes[i]]
            assert coder.decode_single_token_bytes(i) == own
            assert a == len(raw[:at].decode(errors="ignore")) and text[a:b].encode().find(own) >= 0
            at += len(own)
        loss = chat.masked(starts, ends, spans)
        assert loss.tolist() == [any(a < y and b > x for x, y in spans.tolist()) for a, b in zip(starts, ends, strict=True)]
        assert chat.learned(text, starts, ends, loss) == [t for r, t in turns if r == "assistant" and t]


def test_parts_put_together_are_the_whole(spark):
    rng = random.Random(6)
    rows = [(0, i, rng.choice(["user", "assistant"]), f"turn {i} " + "x" * rng.randrange(40)) for i in range(900)]
    rows += [(c, i, "assistant", rng.choice(HOSTILE)) for c in range(1, 30) for i in range(3)] + [(None, None, None, None)] * 2
    rows += [(0, 5, "user", "again")] * 3
    df = spark.createDataFrame(rows, SCHEMA).repartition(7).selectExpr("*", "1 AS part", "2 AS conv", "3 AS whole")
    cut, one = (chat.render(df, part_chars=n) for n in (2000, 1 << 20))
    parts = cut.where("conv_id = 0").orderBy("part").collect()
    whole = one.where("conv_id = 0").collect()
    assert len(parts) > 10 and len(whole) == 1 and max(len(p.formatted) for p in parts) < 2200
    assert sum((p.input_ids for p in parts), []) == whole[0].input_ids
    assert sum((p.loss for p in parts), []) == whole[0].loss and "".join(p.formatted for p in parts) == whole[0].formatted
    for made in (cut, one):
        assert sorted((tuple(r)[:5] for r in chat.read_back(made).collect()), key=str) == brute(rows)


def test_query_and_edge_cases(spark, tmp_path):
    rows = [(k, 0, "user", t) for k, t in enumerate(ODD_TEXTS + HOSTILE)] + [(k, 1, "assistant", t) for k, t in enumerate(ODD_TEXTS + HOSTILE)]
    rows += [(100, 0, "assistant", " " * 1_500_000), (100, 1, "assistant", "wörd " * 200_000), (101, 0, None, None)]
    for name, some in (("a", rows), ("b", [])):
        spark.createDataFrame(some, SCHEMA).write.parquet(str(tmp_path / name / "conversations.parquet"))
        own = [(-1, 0, "user", HOSTILE[0]), (-1, 1, "assistant", HOSTILE[0])]
        got = op12_chat_format(spark, str(tmp_path / name)).collect()
        assert sorted((tuple(r)[:5] for r in got), key=str) == brute(some + own)
        assert {r.formatted_chars for r in got if r.conv_id == -1} == {2 * 20 + 4 + 9 + 2 * (21 + 3)}


def test_no_span_no_loss():
    assert chat.masked(np.array([0, 1]), np.array([1, 2]), np.zeros((0, 2), np.int64)).tolist() == [False, False]
    assert chat.learned("ab", np.array([0]), np.array([1]), np.array([False])) == []
