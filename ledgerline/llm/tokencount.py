"""Token counts of whole texts; huge documents are counted in overlapping chunks that are spliced where they agree.

A byte-level vocabulary cuts a text into pieces from left to right, and where a piece begins depends on nothing before it.
So where two overlapping chunks share a boundary of pieces, and the earlier one is right up to there, the later one is right
from there on. A chunk's boundaries are proven up to a margin before its end, in which the following text could still
change a piece. Chunks carry offsets and running counts of their boundaries in both overlaps; neighbours meet in a join,
and the first common boundary is the splice. Where two neighbours have none, their overlap is widened to the whole of the
later chunk: runs of such chunks become one, are encoded again, and are aligned anew until every pair has a splice.
"""

from __future__ import annotations

import json
from functools import lru_cache
from itertools import accumulate

import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm.bpe import byte_symbols
from ledgerline.llm.common import only_cache, short_batches, stored
from ledgerline.llm.packing import Recent

#: Fixed value: the published pattern of the byte-level pre-tokenizer.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: So many characters may follow a piece's end at most that decide where it ends.
AHEAD = 3
CUT = "row long, doc_id string, n_bytes long, n_tokens long, part long, begin long, last boolean, text string"
ENDS = "row long, part long, upto long, total long, head array<long>, head_tokens array<long>, tail array<long>, tail_tokens array<long>"


class PieceCounter:
    """Tokens of each piece by the tokenizers library's own model, asked once for each piece while it is known."""

    def __init__(self, path: str, most_kept: int):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("a byte-level vocabulary without a normaliser and without a prefix space is needed")
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.margin = AHEAD + max(map(len, self.special), default=0)
        self.model = Tokenizer.from_file(path).model
        self.bytes_as = dict(enumerate(byte_symbols()))
        self.known = Recent(self.tokens_of, most_kept)

    def tokens_of(self, piece: str) -> int:
        return len(self.model.tokenize(piece.encode("utf-8").decode("latin-1").translate(self.bytes_as)))

    def pieces(self, text: str):
        """(piece, number of its tokens or None) in order; a special string is one token."""
        for i, part in enumerate(self.special_at.split(text) if self.special_at and any(s in text for s in self.special) else [text]):
            if i % 2:
                yield part, 1
            else:
                for piece in PIECE.findall(part):
                    yield piece, None

    def count(self, text: str) -> int:
        if self.special_at is not None and any(s in text for s in self.special):
            return sum(self.known[p] if n is None else n for p, n in self.pieces(text))
        return sum(map(self.known.__getitem__, PIECE.findall(text)))

    def boundaries(self, text: str, begin: int) -> tuple[list[int], list[int]]:
        """Where pieces begin, and the end, as offsets in the document; and the tokens before each."""
        found = list(self.pieces(text))
        at = accumulate((len(p) for p, _ in found), initial=begin)
        return list(at), list(accumulate((self.known[p] if n is None else n for p, n in found), initial=0))


@lru_cache(maxsize=1)
def _counter(path: str, most_kept: int) -> PieceCounter:
    return PieceCounter(path, most_kept)


def counter(path: str, most_kept: int) -> PieceCounter:
    """One counter for each worker process."""
    only_cache("tokencount", _counter.cache_clear)
    return _counter(path, most_kept)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _first_pass(docs: DataFrame, path: str, most_kept: int, stride: int, overlap: int) -> DataFrame:
    """docs (row, id, text) -> one counted row for each text of up to stride + overlap characters, else its chunks."""

    def run(batches):
        count = counter(path, most_kept)
        for pdf in batches:
            out = []
            for row, doc, text in zip(pdf["row"], pdf["id"], pdf["text"], strict=True):
                size = len(text.encode("utf-8"))
                if len(text) <= stride + overlap:
                    out.append((row, doc, size, count.count(text), None, None, None, None))
                    count.known.renew()
                    continue
                begins = range(0, len(text) - overlap, stride)  # the last chunk holds more than the overlap
                out += [(row, doc, size, None, i, b, i + 1 == len(begins), text[b : b + stride + overlap]) for i, b in enumerate(begins)]
            yield pd.DataFrame(out, columns=_names(CUT)).astype({"n_tokens": "Int64", "part": "Int64", "begin": "Int64", "last": "boolean"})

    return docs.mapInPandas(run, CUT)


def _ends(chunks: DataFrame, path: str, most_kept: int, overlap: int) -> DataFrame:
    """Encode chunks (row, part, upto, begin, last, texts: one chunk or a run of chunks); what their neighbours need to know."""

    def run(batches):
        count = counter(path, most_kept)
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                text = r.texts[0] + "".join(t[overlap:] for t in r.texts[1:])
                at, before = count.boundaries(text, r.begin)
                end = r.begin + len(text)
                head = [i for i, x in enumerate(at) if x <= r.begin + overlap - count.margin] if r.part else []
                tail = [] if r.last else [i for i, x in enumerate(at) if end - overlap <= x <= end - count.margin]
                out.append((r.row, r.part, r.upto, before[-1], [at[i] for i in head], [before[i] for i in head], [at[i] for i in tail], [before[i] for i in tail]))
                count.known.renew()
            yield pd.DataFrame(out, columns=_names(ENDS))

    return chunks.mapInPandas(run, ENDS)


def _spliced(ends: DataFrame) -> DataFrame:
    """Each chunk with the one before it: the first boundary that both have, and what both count beyond it or before it."""
    earlier = ends.select("row", (F.col("upto") + 1).alias("part"), F.col("total").alias("_total"), F.col("tail").alias("_tail"), F.col("tail_tokens").alias("_tokens"))
    both = ends.join(earlier, ["row", "part"], "left").withColumn("splice", F.array_min(F.array_intersect("_tail", "head")))
    twice = F.expr("_total - element_at(_tokens, CAST(array_position(_tail, splice) AS INT)) + element_at(head_tokens, CAST(array_position(head, splice) AS INT))")
    return both.select("row", "part", "upto", "total", "splice", twice.alias("twice"))


def _count_chunks(chunks: DataFrame, path: str, most_kept: int, overlap: int) -> DataFrame:
    """chunks (row, part, begin, last, text) of huge documents -> (row, n_tokens). Each round leaves fewer chunks, so that it ends."""
    single = chunks.select("row", "part", F.col("part").alias("upto"), "begin", "last", F.array("text").alias("texts"))
    with short_batches(chunks.sparkSession, 16):
        ends = stored(_ends(single.repartition("row", "part"), path, most_kept, overlap))
        while True:
            pairs = stored(_spliced(ends))
            if pairs.filter("part > 0 AND splice IS NULL").isEmpty():
                return pairs.groupBy("row").agg((F.sum("total") - F.sum(F.coalesce("twice", F.lit(0)))).alias("n_tokens"))
            along = Window.partitionBy("row").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)  # numbers of one document's chunks
            lead = F.last(F.when(F.col("splice").isNotNull() | (F.col("part") == 0), F.col("part")), ignorenulls=True).over(along)
            runs = pairs.select("row", lead.alias("lead"), "upto").groupBy("row", "lead").agg(F.max("upto").alias("upto"), F.count(F.lit(1)).alias("n"))
            widened = stored(runs.filter("n > 1").select("row", F.explode(F.sequence("lead", "upto")).alias("part"), "lead", "upto"))
            texts = widened.join(chunks, ["row", "part"]).groupBy("row", "lead", "upto").agg(F.sort_array(F.collect_list(F.struct("part", "begin", "last", "text"))).alias("c"))
            again = texts.select("row", F.col("lead").alias("part"), "upto", F.col("c")[0]["begin"].alias("begin"), F.element_at("c", -1)["last"].alias("last"), F.col("c.text").alias("texts"))
            ends = stored(ends.join(widened, ["row", "part"], "left_anti").unionByName(_ends(again, path, most_kept, overlap)))


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, stride: int = 61_440, overlap: int = 4_096, most_kept: int = 250_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs -> (doc_id, n_bytes, n_tokens, over_limit): tokens of whole texts as the tokenizers library counts them with
    add_special_tokens=False; a special string inside a text is one token, as is that library's default.

    A text of more than stride + overlap characters is counted in chunks by as many tasks. Null counts as empty, with no bytes
    and no tokens. Null ids stay null, repeated rows stay, other columns are ignored whatever their names, an empty table
    gives no rows. A piece of any length, such as a run of letters longer than all overlaps, is one piece and is encoded whole.
    most_kept bounds a table of recent pieces in each worker, which only saves work.
    """
    if overlap * 2 > stride:
        raise ValueError("an overlap is at most half a stride, so that splices of one chunk come in order")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    with short_batches(docs.sparkSession):
        done = stored(_first_pass(rows, path, most_kept, stride, overlap))
    whole = done.filter("part IS NULL").select("doc_id", "n_bytes", "n_tokens")
    chunks = done.filter("part IS NOT NULL").select("row", "part", "begin", "last", "text")
    if not chunks.isEmpty():
        huge = done.filter("part = 0").select("row", "doc_id", "n_bytes").join(_count_chunks(chunks, path, most_kept, overlap), "row")
        whole = whole.unionByName(huge.select("doc_id", "n_bytes", "n_tokens"))
    return whole.select(F.col("doc_id").cast("long").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op12_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary())
