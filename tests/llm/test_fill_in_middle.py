import hashlib
import random
import re

import pytest

from llm_helpers import documents
from recengine.llm import fill_in_middle as f

MARKS = tuple(s.encode() for s in f.SENTINELS)


def brute(doc_id, text):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(s in text for s in f.SENTINELS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def texts():
    rng = random.Random(3)
    pieces = ["abc", "Z", " ", "\n", "é", "漢字", "😀", "<", "P>", "<S", ">", "<M", "0", "\t", "don't"]
    out = ["".join(rng.choice(pieces) for _ in range(rng.randrange(60))) for _ in range(400)]
    return out + ["", "a", "é", "<", "<P", "has <M> inside", "<S>", "word " * 60_000, "漢" * 50_000, "x" * 300_000]


def test_equal_to_the_definition_and_restored(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "no id here"), (7, None), (3, "again"), (3, "again")]
    df = documents(spark, rows).selectExpr("*", "1 as output", "2 as form", "3 as restored", "4 as n")
    got = sorted((tuple(r) for r in f.restored(f.fill_in_middle(df)).collect()), key=str)
    want = sorted(((i, *brute(i, t or ""), t or "") for i, t in rows), key=str)
    assert got == want
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_restored_keeps_other_columns(spark):
    done = f.fill_in_middle(documents(spark, [(1, "one two three")])).selectExpr("*", "'x' as `my col`", "5 as restored")
    row = f.restored(done).first()
    assert row["my col"] == "x" and row["restored"] == "one two three"


def test_empty_table(spark):
    assert f.restored(f.fill_in_middle(documents(spark, []))).collect() == []


@pytest.mark.parametrize("swap", [1, 3, 1 << 16])
def test_rotation_in_place(swap, monkeypatch):
    monkeypatch.setattr(f, "SWAP", swap)
    rng = random.Random(swap)
    for _ in range(300):
        data = bytes(rng.randrange(256) for _ in range(rng.randrange(40)))
        i, j, k = sorted(rng.randrange(len(data) + 1) for _ in range(3))
        buf = bytearray(data)
        f.rotate(buf, i, j, k)
        assert bytes(buf) == data[:i] + data[j:k] + data[i:j] + data[k:]
        f.rotate(buf, i, i + k - j, k)
        assert bytes(buf) == data


def test_other_parameters(spark):
    rows = [(i, f"text {i} of some words") for i in range(300)]
    out = f.fill_in_middle(documents(spark, rows), seed="9", sentinels=("[[p]]", "[s]", "<|m|>"), fim_percent=100, spm_percent=50)
    got = f.restored(out, ("[[p]]", "[s]", "<|m|>")).collect()
    assert all(r.restored == f"text {r.doc_id} of some words" for r in got)
    assert min(sum(r.form == k for r in got) for k in ("psm", "spm")) > 100


def test_one_row_equals_the_inverse_of_its_parts():
    for doc_id, text in enumerate(texts()[:200]):
        n, form, _, _, output = f.transform(text.encode(), doc_id, "1", MARKS, 100, 20)
        assert f.restore(output, form, MARKS) == text.encode()
