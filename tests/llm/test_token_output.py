import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from llm_helpers import SF_SMALL, documents
from recengine.llm import token_output as t


def direct(rows, escape=False):
    tk = Tokenizer.from_file(t.default_tokenizer())
    tk.encode_special_tokens = escape
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array(tk.encode(text or "", add_special_tokens=False).ids + [t.END_ID], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_whole_table_equals_direct_encoding(spark):
    rows = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = direct(sorted((r["doc_id"], r["text"]) for r in rows))
    got = sorted(map(tuple, t.op3_token_output(spark, SF_SMALL).collect()))
    assert got == want


ODD = ["", None, "a", " a", "a ", "a  b", "a \nb", "a\n b", "it's we'll", "x<|endoftext|>y", " a 　 b c", "a\tb c\r\n\r\n d",
       "é ü ß 12 345 ... !?", "😀 😀a 😀", "a\x1c b", "\x85 a b", "a" * 5000, "wo rd " * 4000, "x'S 'S 're y"]


def test_added_tokens_are_the_librarys(spark):
    encode = t.ChunkEncoder(t.default_tokenizer())
    ids = lambda x, e=encode: np.frombuffer(e(x), e.dtype).tolist()
    assert ids("hi <|endoftext|> there") == [5303, 220, 50256, 612]
    escaped = t.ChunkEncoder(t.default_tokenizer(), escape=True)
    assert len(ids("hi <|endoftext|> there", escaped)) == 9
    rows = [(1, "hi <|endoftext|> there"), (2, "<|endoftext|>"), (3, "a <|endoftext|"), (4, "x <|endoftext|><|endoftext|>  y z")]
    for escape in (False, True):
        got = sorted(map(tuple, t.token_output(documents(spark, rows), escape=escape).collect()))
        assert got == direct(rows, escape)


def test_odd_texts_ties_and_extra_columns(spark):
    rows = [(i, x) for i, x in enumerate(ODD)] + [(3, "tie b"), (3, "tie a"), (3, "tie a"), (-5, "first")]
    df = documents(spark, rows).selectExpr("*", "1 as start", "2 as n_tokens", "3 as ids")
    got = sorted(map(tuple, t.token_output(df).collect()), key=lambda r: r[1])
    assert got == direct(sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or "")))


def test_many_files_and_random_access(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(t, "CHARS_PER_FILE", 4000)
    rows = [(i, f"word{i} " * (i % 97)) for i in range(400)]
    folder = f"file://{tmp_path}/set"
    manifest = t.write_tokens(documents(spark, rows), folder, seq_len=16).persist()
    got = sorted(map(tuple, t.read_documents(manifest).collect()))
    want = direct(rows)
    assert got == want and manifest.count() > 3
    first = manifest.orderBy("part").first()
    reader = t.open_ipc(first.file)
    ids, mask = t.sequence(reader, first.n_rows - 1)
    assert len(ids) == 16 and not ids.flags.owndata
    assert mask.to_pylist() == [i < (first.file_tokens - 1) % 16 + 1 for i in range(16)]
    flat = np.concatenate([t.sequence(reader, r)[0] for r in range(first.n_rows)])[:first.file_tokens]
    assert zlib.crc32(flat[want[1][1]:want[1][1] + want[1][2]].astype("<u4").tobytes()) == want[1][3]


def test_null_ids_and_empty_table(spark):
    got = sorted(map(tuple, t.token_output(documents(spark, [(None, "b"), (1, "a")])).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1]
    assert t.token_output(documents(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_chunks_give_the_same_ids(seed):
    rng = np.random.default_rng(seed)
    parts = [" ", "  ", "\n", "a", "B", "é", "1", "'s", "'S", "!", " ", "\t", "ab", "😀", "_", "\x1f", "ﬁ", "²"]
    enc = t.ChunkEncoder(t.default_tokenizer())
    for _ in range(2000):
        text = "".join(rng.choice(parts, rng.integers(1, 14)))
        assert enc(text) == enc.whole(text), repr(text)


def test_other_kinds_of_tokenizer_and_wide_ids(spark, monkeypatch):
    import public_tokenizers
    other = public_tokenizers.path("word_bpe_49k.json")
    enc = t.ChunkEncoder(other)
    assert not enc.by_piece and enc("Hello  world") == enc.whole("Hello  world") != b""
    monkeypatch.setattr(t, "id_type", lambda n: np.dtype("<u4"))
    assert t.ChunkEncoder(t.default_tokenizer())("Hello world") == t.ChunkEncoder(t.default_tokenizer()).whole("Hello world")
