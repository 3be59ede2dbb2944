"""Fill-in-the-middle by a piece table: texts and sentinels stay in immutable buffers, and only descriptors move.

A document begins as one descriptor over its UTF-8 bytes. Cutting splits descriptors, an arrangement lists them in another
order between descriptors of sentinels, the inverse permutation puts a parsed output back in the order of the text, and
hashes are fed descriptor by descriptor. Documents are independent, so the work is one map without a shuffle.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import only_cache

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
TEXT, MARK = 0, 1
#: The order of an output: sentinels by name, sections of the text by number (0 prefix, 1 middle, 2 suffix).
ARRANGED = {"psm": (PREFIX, 0, SUFFIX, 2, MIDDLE, 1), "spm": (SUFFIX, 2, PREFIX, 0, MIDDLE, 1)}
OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


@dataclass(frozen=True)
class Piece:
    buffer: int
    begin: int
    size: int


class PieceTable:
    """Pieces over buffers that never change."""

    def __init__(self, buffers: tuple[bytes, ...], pieces: list[Piece]):
        self.buffers, self.pieces = buffers, pieces

    @classmethod
    def of(cls, raw: bytes) -> PieceTable:
        return cls((raw, SENTINELS), [Piece(TEXT, 0, len(raw))])

    def cut(self, at: int) -> tuple[PieceTable, PieceTable]:
        """The pieces before and from a byte position; the piece across it is split."""
        left, right = [], []
        for p in self.pieces:
            here = min(max(at, 0), p.size)
            left.append(Piece(p.buffer, p.begin, here))
            right.append(Piece(p.buffer, p.begin + here, p.size - here))
            at -= p.size
        return PieceTable(self.buffers, [p for p in left if p.size]), PieceTable(self.buffers, [p for p in right if p.size])

    def views(self):
        for p in self.pieces:
            yield memoryview(self.buffers[p.buffer])[p.begin : p.begin + p.size]

    def sha256(self) -> str:
        h = hashlib.sha256()
        for view in self.views():
            h.update(view)
        return h.hexdigest()

    def joined(self) -> bytes:
        return b"".join(self.views())


def arrange(sections: list[PieceTable], form: str) -> PieceTable:
    """Sections in the order of a form, between its sentinels."""
    pieces: list[Piece] = []
    for item in ARRANGED[form]:
        pieces += sections[item].pieces if isinstance(item, int) else [Piece(MARK, SENTINELS.index(item), len(item))]
    return PieceTable(sections[0].buffers, pieces)


def restore(output: bytes, form: str) -> PieceTable:
    """The text as pieces of an output: its sections found between the sentinels and put back by the inverse permutation.
    The text holds no sentinel, and none can arise where a section meets one, so that the first of each is the one."""
    if form == "plain":
        return PieceTable.of(output)
    order = ARRANGED[form]
    begins, at = [], 0
    for mark in order[::2]:
        at = output.index(mark, at) + len(mark)
        begins.append(at)
    ends = [b - len(SENTINELS) // 3 for b in begins[1:]] + [len(output)]
    found = {number: Piece(TEXT, b, e - b) for number, b, e in zip(order[1::2], begins, ends, strict=True)}
    return PieceTable((output, SENTINELS), [found[number] for number in sorted(found)])


def unit_starts(raw: bytes) -> np.ndarray:
    """Marks each byte at which a unit begins: a run of ASCII letters, or any other single code point."""
    a = np.frombuffer(raw, np.uint8)
    letter = ((a | 32) - np.uint8(97)) < 26
    starts = (a & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    return starts


def position(starts: np.ndarray, unit: int, block: int = 1 << 20) -> int:
    """The byte at which the unit of this number begins (the end of the text after the last one)."""
    for at in range(0, len(starts), block):
        here = int(np.count_nonzero(starts[at : at + block]))
        if unit < here:
            return at + int(np.flatnonzero(starts[at : at + block])[unit])
        unit -= here
    return len(starts)


def code_points(raw: bytes | memoryview) -> int:
    return int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))


def transform(doc_id: int | None, text: str, plain_pct: int = 10, spm_pct: int = 20) -> tuple:
    """(n, form, prefix_chars, middle_chars, output, restored): output and restored are piece tables."""
    raw = text.encode("utf-8")
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    starts = unit_starts(raw)
    n = int(np.count_nonzero(starts))
    whole = PieceTable.of(raw)
    if not raw or any(m in raw for m in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= 100 - plain_pct:
        return n, "plain", None, None, whole, restore(raw, "plain")
    form = "spm" if h[3] % 100 < spm_pct else "psm"
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = position(starts, first), position(starts, second)
    prefix, rest = whole.cut(a)
    middle, suffix = rest.cut(b - a)
    output = arrange([prefix, middle, suffix], form)
    return n, form, code_points(raw[:a]), code_points(raw[a:b]), output, restore(output.joined(), form)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plain_pct: int = 10, spm_pct: int = 20, with_text: bool = False) -> DataFrame:
    """docs -> one row each: units n, form, lengths of prefix and middle in code points, hashes of the output and of the text
    rebuilt from it; with_text=True adds the output itself as `output`.

    Whole texts; null counts as empty, and an empty text is plain with n of 0. A null id stays null and draws as an empty
    one. Equal rows give equal rows, each stays. Other columns are ignored whatever their names; an empty table gives none.
    """

    def run(batches):
        only_cache("fim", lambda: None)
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["id"], pdf["text"], strict=True):
                n, form, before, middle, output, restored = transform(None if pd.isna(doc) else int(doc), text, plain_pct, spm_pct)
                row = (doc, n, form, before, middle, output.sha256(), restored.sha256())
                rows.append((*row, output.joined().decode("utf-8")) if with_text else row)
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
            yield out.astype({"doc_id": "Int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    schema = f"{OUT}, output string" if with_text else OUT
    # ids go as text: pandas would make doubles of whole numbers beside a null, and lose digits of large ones
    plain = docs.select(F.col(id_col).cast("long").cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return plain.mapInPandas(run, schema)


def op11_fim(spark, sf_dir: str) -> DataFrame:
    return fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = """WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS g FROM documents),
h AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units, ('0x' || g[1:8])::BIGINT AS h1, ('0x' || g[9:16])::BIGINT AS h2,
  ('0x' || g[17:24])::BIGINT AS h3, ('0x' || g[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
s AS (SELECT *, array_to_string(units[:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:], '') AS x FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m ELSE '<S>' || x || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(p || m || x) AS restored_sha256 FROM s"""
