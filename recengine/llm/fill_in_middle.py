"""Fill-in-middle transformation (operator 12): in-place block rotation, and its exact inverse.

A text is cut into units (``[A-Za-z]+`` or one other code point). A hash of the document's id draws the form and two cuts. The three
sentinels go into a bytearray of the text before the prefix, the middle and the suffix; the segments change places by a rotation
made of three reversals, each of which swaps bytes inside the buffer:

  psm   [prefix][<M>middle][<S>suffix]   rotates the last two      ->  <P>prefix<S>suffix<M>middle
  spm   [<P>prefix<M>middle][<S>suffix]  rotates the whole         ->  <S>suffix<P>prefix<M>middle

The inverse finds the sentinels, rotates back and takes them out. Texts that contain a sentinel stay plain, so in any other output each
sentinel occurs once: it can't begin inside a segment, whose text would have to contain its first characters up to the next one's "<".

Null text is empty; empty texts stay plain, with n = 0. A null doc_id is hashed as the empty text. Repeated rows give equal results. A
document is handled by itself, inside its row: nothing is shuffled, and a task holds a few hundred texts at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recengine.llm.common import batches_of, table, utf8

SENTINELS = ("<P>", "<S>", "<M>")
SEED = "1"
FIM_PERCENT, SPM_PERCENT = 90, 20
#: Bytes that a reversal swaps at once, and rows that a task holds.
SWAP, ROWS = 1 << 16, 256


def draws(seed: str, doc_id: int | None) -> list[int]:
    """The first four 8-digit groups of the sha256 of 'seed:doc_id'."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    return [int.from_bytes(hashlib.sha256(text.encode()).digest()[i:i + 4]) for i in (0, 4, 8, 12)]


def unit_starts(text: bytes) -> np.ndarray:
    """Byte positions where the units of a UTF-8 text begin."""
    b = np.frombuffer(text, np.uint8)
    letter = ((b | 32) >= 97) & ((b | 32) <= 122)
    inside = letter.copy()
    inside[1:] &= letter[:-1]
    inside[:1] = False
    return np.flatnonzero(~inside & ((b & 0xC0) != 0x80))


def code_points(text: bytes, start: int, end: int) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8)[start:end] & 0xC0) != 0x80))


def reverse(buf: bytearray, start: int, end: int) -> None:
    """Reverses buf[start:end] by swapping pieces from both ends."""
    while end - start > 1:
        k = min(SWAP, (end - start) // 2)
        head, tail = buf[start:start + k], buf[end - k:end]
        buf[start:start + k], buf[end - k:end] = tail[::-1], head[::-1]
        start, end = start + k, end - k


def rotate(buf: bytearray, start: int, mid: int, end: int) -> None:
    """Exchanges the neighbouring blocks buf[start:mid] and buf[mid:end]."""
    reverse(buf, start, mid)
    reverse(buf, mid, end)
    reverse(buf, start, end)


def transform(text: bytes, doc_id: int | None, seed: str, sentinels: tuple[bytes, ...], fim: int, spm: int):
    """(n, form, prefix_chars, middle_chars, output) of a text."""
    h1, h2, h3, h4 = draws(seed, doc_id)
    starts = unit_starts(text)
    n = len(starts)
    if not text or h3 % 100 >= fim or any(s in text for s in sentinels):
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (len(text) if k == n else int(starts[k]) for k in (low, high))
    p, s, m = sentinels
    buf = bytearray(text)
    for at, mark in ((b, s), (a, m), (0, p)):  # from the back, so that the earlier cuts hold
        buf[at:at] = mark
    second, third = len(p) + a, len(p) + a + len(m) + (b - a)
    form = "spm" if h4 % 100 < spm else "psm"
    rotate(buf, 0 if form == "spm" else second, third, len(buf))
    return n, form, code_points(text, 0, a), code_points(text, a, b), bytes(buf)


def restore(output: bytes, form: str, sentinels: tuple[bytes, ...]) -> bytes:
    """The text, from an output and its form."""
    if form == "plain":
        return output
    p, s, m = sentinels
    buf = bytearray(output)
    if form == "spm":  # [<S>suffix][<P>prefix<M>middle]
        rotate(buf, 0, buf.index(p), len(buf))
    else:  # <P>prefix[<S>suffix][<M>middle]
        rotate(buf, buf.index(s), buf.index(m), len(buf))
    for mark in (s, m, p):
        at = buf.index(mark)
        del buf[at:at + len(mark)]
    return bytes(buf)


def fill_in_middle(docs: DataFrame, seed: str = SEED, sentinels: tuple[str, str, str] = SENTINELS, fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) per row of ``docs`` (doc_id, text): n units; output is the transformed text.

    ``fim_percent`` of the documents are transformed, ``spm_percent`` of these with the suffix first."""
    marks = tuple(s.encode() for s in sentinels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, ROWS):
            out = [transform(t, i, seed, marks, fim_percent, spm_percent) for i, t in zip(b["doc_id"].to_pylist(), utf8(b["text"]))]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([b["doc_id"], *(pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds))],
                                             names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    done = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
    return done.withColumn("output", F.col("output").cast("string"))


def restored(done: DataFrame, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """Adds ``restored``, the text rebuilt from the columns output and form; all other columns stay."""
    marks = tuple(s.encode() for s in sentinels)
    names = [c for c in done.columns if c != "restored"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, ROWS):
            texts = [restore(t, form, marks) for t, form in zip(utf8(b["output"]), b["form"].to_pylist())]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in names), pa.array(texts, pa.binary())], names=[*names, "restored"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in done.schema.fields if f.name in names)
    return done.select(*names).mapInArrow(run, f"{schema}, restored binary").withColumn("restored", F.col("restored").cast("string"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return restored(fill_in_middle(table(spark, sf_dir, "documents"))).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


OP12_SQL = """
with d as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
                  sha256('1:' || doc_id) as h from documents),
 r as (select *, len(u)::bigint as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3,
              ('0x' || h[25:32])::bigint as h4 from d),
 c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
              case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
                   when h4 % 100 < 20 then 'spm' else 'psm' end as form from r),
 s as (select *, array_to_string(u[1:a], '') as pre, array_to_string(u[a + 1:b], '') as mid, array_to_string(u[b + 1:n], '') as suf from c),
 o as (select *, case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
                   else '<S>' || suf || '<P>' || pre || '<M>' || mid end as output from s)
select doc_id, n, form, case when form <> 'plain' then length(pre)::bigint end as prefix_chars,
       case when form <> 'plain' then length(mid)::bigint end as middle_chars, sha256(output) as output_sha256, sha256(text) as restored_sha256
from o
"""
