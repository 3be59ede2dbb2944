"""Bounded-space online packing of token sequences: a fixed number of open windows per partition, best fit, cut freely.

Each task reads its documents once and keeps at most `open_windows` windows. What a document has beyond whole windows goes
to the open window that it fits best; if it fits none and no more may be opened, the fullest is filled up with a first
part of it and emitted. At the end of a partition the open windows are merged into full ones, and less than one window
is left over. Leftovers of all partitions are laid end to end (only one length for each partition goes to the driver) and
cut again at whole windows; the very last ones are cut at powers of two, where no padding is due.
"""

from __future__ import annotations

import json
import zlib
from array import array
from bisect import bisect_left, insort
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm.bpe import WORD, Cutter, byte_symbols, vocabulary
from ledgerline.llm.common import freeing, only_cache, short_batches, stored

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
LEFT = f"{PIECES}, part int, at long, ids binary"
#: Sequence numbers of merged leftovers begin here, above any partition's own.
MERGED_FROM = 1 << 62


class Recent(dict):
    """What was made for each key, as long as the key is met: when there are `most` entries, renew() lets go of those that were
    not met since the last time. A key that is not there is made on the spot."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, key):
        own = self.before.get(key)
        self[key] = own = self.make(key) if own is None else own
        return own

    def renew(self) -> None:
        if len(self) > self.most:
            self.before = dict(self)
            self.clear()

    def forget(self) -> None:
        self.before = {}
        self.clear()


class LibraryEncoder(Cutter):
    """Ids of whole texts by the tokenizers library's own model, asked once for each word while the word is known."""

    def __init__(self, path: str, most_kept: int):
        with open(path, encoding="utf-8") as f:
            super().__init__(json.load(f))
        self.model = Tokenizer.from_file(path).model
        self.bytes_as = dict(enumerate(byte_symbols()))
        self.words = Recent(self.ids_of_word, most_kept)
        self.pieces = Recent(self.ids_of, most_kept)

    def ids_of_word(self, word: str) -> bytes:
        plain = word if word.isascii() else word.encode("utf-8", "replace").decode("latin-1").translate(self.bytes_as)
        return array("I", [t.id for t in self.model.tokenize(plain)]).tobytes()

    def ids_of(self, piece: str | int) -> bytes:
        if isinstance(piece, int):
            return piece.to_bytes(4, "little")
        words = WORD.findall(piece)
        return self.words[words[0]] if len(words) == 1 else b"".join(map(self.words.__getitem__, words))

    def encode(self, texts: list[str]):
        """For each text its ids as little-endian 32-bit bytes."""
        known = self.pieces.__getitem__
        for text in texts:
            yield b"".join(map(known, self.cut(text or "")))
            self.pieces.renew()
            self.words.renew()

    def forget(self) -> None:
        self.pieces.forget()
        self.words.forget()


@lru_cache(maxsize=1)
def _encoder(path: str, most_kept: int) -> LibraryEncoder:
    return LibraryEncoder(path, most_kept)


def encoder(path: str, most_kept: int) -> LibraryEncoder:
    """One encoder for each worker process."""
    only_cache("packing", _encoder.cache_clear)
    return _encoder(path, most_kept)


class Windows:
    """The open windows of one partition; emits rows of full windows. A piece: (doc_id, start, ids as bytes, doc_tokens)."""

    def __init__(self, part: int, size: int, open_windows: int):
        self.part, self.size, self.most = part, size, open_windows
        self.open: list[tuple[int, int]] = []  # (room, key), sorted
        self.pieces: dict[int, list[tuple]] = {}
        self.made = self.keys = 0
        self.rows: list[tuple] = []

    def emit(self, pieces: list[tuple]) -> None:
        number, offset = (self.part << 32) | self.made, 0
        self.made += 1
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, number, offset, None, None, None))
            offset += n

    def place(self, doc, start: int, ids: bytes, total: int) -> None:
        n = len(ids) // 4
        at = bisect_left(self.open, (n, -1))
        if at < len(self.open):
            room, key = self.open.pop(at)
            self.pieces[key].append((doc, start, ids, total))
            if room == n:
                self.emit(self.pieces.pop(key))
            else:
                insort(self.open, (room - n, key))
        elif len(self.open) < self.most:
            self.keys += 1
            self.pieces[self.keys] = [(doc, start, ids, total)]
            insort(self.open, (self.size - n, self.keys))
        else:
            room, key = self.open.pop(0)
            self.emit(self.pieces.pop(key) + [(doc, start, ids[: 4 * room], total)])
            self.place(doc, start + room, ids[4 * room :], total)

    def add(self, doc, ids: bytes) -> None:
        total = len(ids) // 4
        whole = total - total % self.size
        for start in range(0, whole, self.size):
            self.emit([(doc, start, ids[4 * start : 4 * (start + self.size)], total)])
        if whole < total:
            self.place(doc, whole, ids[4 * whole :], total)

    def close(self) -> None:
        """Merge the open windows; what fills no window becomes this partition's leftover, with its ids."""
        held: list[tuple] = []
        room = self.size
        for _, key in self.open:
            for doc, start, ids, total in self.pieces[key]:
                while len(ids) // 4 >= room:
                    self.emit([*held, (doc, start, ids[: 4 * room], total)])
                    start, ids, held, room = start + room, ids[4 * room :], [], self.size
                if ids:
                    held.append((doc, start, ids, total))
                    room -= len(ids) // 4
        at = 0
        for doc, start, ids, total in held:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, None, None, self.part, at, ids))
            at += n

    def take(self) -> pd.DataFrame:
        rows, self.rows = self.rows, []
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in LEFT.split(", ")])
        return out.astype({"doc_id": "Int64", "sequence_id": "Int64", "offset": "Int64", "part": "Int32", "at": "Int64"})


def last_cuts(total: int, size: int) -> list[tuple[int, int]]:
    """(begin, end) of the last sequences: what whole windows leave of `total`, cut at powers of two, largest first."""
    begin, out = total - total % size, []
    while begin < total:
        n = 1 << ((total - begin).bit_length() - 1)
        out.append((begin, begin + n))
        begin += n
    return out


def pack(docs: DataFrame, path: str, size: int = 4096, open_windows: int = 64, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", most_kept: int = 250_000) -> DataFrame:
    """docs -> one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its whole text's ids and then end_id; a null or empty text is end_id alone. Every id lies in exactly one
    piece, pieces of a sequence follow each other from offset 0 without a gap, and every sequence has `size` ids except
    the very last ones, whose lengths are powers of two. Repeated rows are packed as often as they are given; a null id
    stays null; other columns are ignored; no rows give no rows. No window, document or leftover is dropped. most_kept
    bounds each of the encoder's tables of known words, which only save work.
    """
    end = end_id.to_bytes(4, "little")

    def run(batches):
        enc = encoder(path, most_kept)
        windows = Windows(TaskContext.get().partitionId(), size, open_windows)
        for pdf in batches:
            ids = [None if pd.isna(i) else int(i) for i in pdf["doc_id"]]
            for doc, raw in zip(ids, enc.encode(pdf["text"].tolist()), strict=True):
                windows.add(doc, raw + end)
            if windows.rows:
                yield windows.take()
        windows.close()
        if windows.rows:
            yield windows.take()

    with short_batches(docs.sparkSession):
        rows = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInPandas(freeing(run, lambda: encoder(path, most_kept).forget()), LEFT))
    left = rows.filter(F.col("sequence_id").isNull())
    bases, total = {}, 0
    for part, n in sorted(left.groupBy("part").agg(F.sum("length")).collect()):
        bases[part], total = total, total + n
    final = last_cuts(total, size)

    def merge(batches):
        whole = total // size
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                begin, raw, start = bases[r.part] + r.at, r.ids, r.start
                while raw:
                    number = begin // size
                    to, first = (number + 1) * size, number * size
                    if number == whole:
                        k = next(k for k, (a, b) in enumerate(final) if a <= begin < b)
                        number, (first, to) = number + k, final[k]
                    n = min(len(raw) // 4, to - begin)
                    out.append((None if pd.isna(r.doc_id) else int(r.doc_id), start, n, zlib.crc32(raw[: 4 * n]), r.doc_tokens, MERGED_FROM + number, begin - first))
                    begin, start, raw = begin + n, start + n, raw[4 * n :]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")]).astype({"doc_id": "Int64"})

    names = [c.split()[0] for c in PIECES.split(", ")]
    return rows.filter(F.col("sequence_id").isNotNull()).select(names).unionByName(left.select("doc_id", "start", "doc_tokens", "part", "at", "ids").mapInPandas(merge, PIECES))


def op6_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary())
