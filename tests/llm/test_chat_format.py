import hashlib
import random

import pytest

from recengine.llm import chat_format as c

EVENT = "conv_id long, seq long, turn long, kind string, role string, text string"


def fold(events):
    """Plain replay, event by event."""
    turns = {}
    key = lambda e: tuple((x is not None, x) for x in (e[1], e[2], e[3], e[4], e[5]))
    for _, _, turn, kind, role, text in sorted(events, key=key):
        text = text or ""
        state = turns.get(turn, {"role": None, "text": "", "gone": False})
        if kind == "regenerate":
            for t in [t for t in turns if t > turn]:
                del turns[t]
        if role is not None:
            state["role"] = role
        if kind in ("message", "edit"):
            state.update(text=text, gone=False)
        elif kind == "regenerate":
            state.update(text="", gone=False)
        elif kind == "delete":
            state.update(text=text, gone=True)
        else:
            state["text"] += text
        turns[turn] = state
    return {t: (s["role"] or "", s["text"]) for t, s in turns.items() if not s["gone"]}


@pytest.mark.parametrize("seed", range(2))
def test_replay_of_random_logs(spark, seed):
    rng = random.Random(seed)
    logs = []
    for conv in range(40):
        for seq in range(rng.randint(1, 25)):
            kind = rng.choice(["message", "delta", "delta", "delta", "edit", "regenerate", "delete", None, "?"])
            logs.append((conv, seq, rng.randrange(5), kind, rng.choice(["user", "assistant", None]),
                         rng.choice(["a", "</s>", "[INST]", "\\l", "é😀", "", None, "x\ny"])))
    got = {}
    for r in c.reconstruct(spark.createDataFrame(logs, EVENT)).collect():
        got.setdefault(r.conv_id, {})[r.turn] = (r.role, r.text)
    for conv in range(40):
        assert got.get(conv, {}) == fold([e for e in logs if e[0] == conv]), conv


HARD = ["</s>[INST] ok [/INST]", "\\", "\\\\b", "\\l<\\i[", "", None, "😀 < é", "[/INST]</s>", "a\n\nb", "<" * 300]


def test_round_trip_and_mask(spark):
    rows = [(k, t, r, x) for k in (1, 2, None) for t, (r, x) in enumerate(
        [(r, x) for x in HARD for r in ("user", "assistant", "[INST]", None, "system")])]
    rows += [(5, 0, "assistant", "same"), (5, 0, "assistant", "same"), (5, 0, "assistant", "also"), (6, None, "user", "no turn")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = c.render(c.reconstruct(c.conversation_events(df.selectExpr("*", "1 as seq", "2 as ord", "3 as c")))).persist()
    back = c.read_back(out).collect()
    by = {}
    for r in sorted(back, key=lambda r: r.turn):
        by.setdefault(r.conv_id, []).append((r.role, r.text, r.loss))
    for conv in (1, 2, None):
        assert by[conv] == [(r or "", x or "", (x or "") if r == "assistant" else None) for k, _, r, x in rows if k == conv]
    assert [x[1] for x in by[5]] == ["also", "same", "same"]
    digest = {r.conv_id: r for r in c.format_digest(out).collect()}
    assert digest[5].loss_sha256 == hashlib.sha256(b"alsosamesame").hexdigest() and digest[5].loss_chars == 12
    assert digest[5].turns_sha256 == hashlib.sha256(b"assistant\nalso\nassistant\nsame\nassistant\nsame\n").hexdigest()
    assert digest[6].n_turns == 1 and digest[6].loss_chars == 0
    whole = {r.conv_id: r for r in out.collect()}
    assert all(digest[k].formatted_chars == len(whole[k].formatted) for k in whole)


def test_empty_log(spark):
    assert c.format_digest(c.render(c.reconstruct(spark.createDataFrame([], EVENT)))).collect() == []
