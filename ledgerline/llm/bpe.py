"""Byte-pair encoding and decoding of whole texts by prefix-sharing trie traversal.

The vocabulary file marks a word's last symbol with a suffix, so a word is a path of byte symbols and a closing edge.
The distinct words that a batch brings are put into a trie in sorted order and walked depth first: each node keeps the
last token of the encoding of its prefix, which together with the node that token begins at is the whole encoding of the
prefix. A node's token is the only vocabulary entry ending there that either begins at the root or follows its
predecessor's last token without a merge across the border. Prefixes shared by words are so encoded once. Results are
kept by word and by white-space-delimited piece in bounded tables that only save work.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import only_cache

#: Fixed values of the vocabulary file's own pre-tokenizer: what is a word, and which white space is dropped.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
SPACE = regex.compile(r"\p{White_Space}+")
#: Characters at which str.split() cuts although they are not white space to the tokenizer.
ODD_SPACE = regex.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary, by the published rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class Cutter:
    """What the vocabulary file says of texts: special tokens, normalisation, and where white space cuts pieces."""

    def __init__(self, spec: dict):
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def cut(self, text: str) -> list[str | int]:
        """White-space-delimited pieces, normalised, and the ids of special tokens that the text spells out."""
        if self.special_at is not None and any(s in text for s in self.special):
            out: list[str | int] = []
            for part in self.special_at.split(text):
                out += [self.special[part]] if part in self.special else self.cut_plain(part)
            return out
        return self.cut_plain(text)

    def cut_plain(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # each character alone in lower case
        text = text.lower()
        return SPACE.split(text) if ODD_SPACE.search(text) else text.split()


class WordEncoder(Cutter):
    """Encodes words by the trie walk. most_kept bounds each of the two tables."""

    def __init__(self, path: str, most_kept: int = 600_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] is None or model["dropout"] or model["ignore_merges"]:
            raise ValueError("a BPE vocabulary with an end-of-word suffix is needed")
        self.suffix = model["end_of_word_suffix"]
        vocab = model["vocab"]
        self.symbols = byte_symbols()
        back = {c: b for b, c in enumerate(self.symbols)}
        self.text = {i: t for t, i in vocab.items()}
        self.inner: dict[bytes, int] = {}
        self.closing: dict[bytes, int] = {}
        self.parts: dict[int, tuple[bytes, bool]] = {}
        for token, i in vocab.items():
            ends = token.endswith(self.suffix)
            body = token[: -len(self.suffix)] if ends else token
            if body and all(c in back for c in body):
                raw = bytes(back[c] for c in body)
                (self.closing if ends else self.inner)[raw] = i
                self.parts[i] = (raw, ends)
        self.merges = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = (vocab[x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            whole = vocab[self.text[left] + self.text[right]]
            self.merges[left, right] = (rank, whole)
            self.halves[whole] = (left, right, rank)
        super().__init__(spec)
        self.text |= {i: t for t, i in self.special.items()}
        self.valid: dict[int, bool] = {}
        self.borders: dict[tuple[int, bool], list[tuple[int, float]]] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.most_kept = most_kept
        self.words: dict[str, tuple[int, ...]] = {}
        self.ids_of: dict[str | int, bytes] = {}
        self.text_of: dict[str | int, bytes] = {}
        self._suffixes()

    def _suffixes(self) -> None:
        """A matching automaton over the vocabulary's byte strings: self.ends[state] lists the inner tokens that end
        there, self.shuts[state] the closing ones, each with its length; self.steps follows a byte from a state."""
        steps: dict[tuple[int, int], int] = {}
        depth, ends, shuts, fail = [0], [[]], [[]], [0]
        for table, kind in ((self.inner, ends), (self.closing, shuts)):
            for raw, token in table.items():
                at = 0
                for byte in raw:
                    to = steps.get((at, byte))
                    if to is None:
                        to = steps[at, byte] = len(depth)
                        depth.append(depth[at] + 1)
                        ends.append([])
                        shuts.append([])
                        fail.append(0)
                    at = to
                kind[at].append((len(raw), token))
        self.steps, self.fail = steps, fail
        for (at, byte), to in sorted(steps.items(), key=lambda x: depth[x[1]]):
            if at:
                fail[to] = self.step(fail[at], byte)
            ends[to] += ends[fail[to]]
            shuts[to] += shuts[fail[to]]
        self.ends, self.shuts = ends, shuts

    def step(self, state: int, byte: int) -> int:
        at, to = state, self.steps.get((state, byte))
        while to is None:
            if not at:
                return 0
            at = self.fail[at]
            to = self.steps.get((at, byte))
        return to

    def merged(self, ids: list[int]) -> list[int]:
        """Plain merging by rank, leftmost first; used once for each token that is met."""
        while True:
            best = min(((self.merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merges), default=None)
            if best is None:
                return ids
            i = best[1]
            ids[i : i + 2] = [self.merges[ids[i], ids[i + 1]][1]]

    def border(self, token: int, right: bool) -> list[tuple[int, float]]:
        """What stands at one end of a token while it is being merged: symbols in order of time, each with the rank of
        the merge that ends it."""
        known = self.borders.get((token, right))
        if known is None:
            known = [(token, float("inf"))]
            while known[0][0] in self.halves:
                left_half, right_half, rank = self.halves[known[0][0]]
                known.insert(0, (right_half if right else left_half, rank))
            self.borders[token, right] = known
        return known

    def stands(self, before: int, token: int) -> bool:
        """Whether the encoding of the two tokens' bytes is the two tokens (before is -1 at the start of a word): the
        token alone must be its own encoding, and at no time may the symbols at the border be the next to merge."""
        ok = self.valid.get(token)
        if ok is None:
            raw, ends = self.parts[token]
            own = [self.inner[raw[i : i + 1]] for i in range(len(raw) - ends)] + ([self.closing[raw[-1:]]] if ends else [])
            ok = self.valid[token] = self.merged(own) == [token]
        if ok and before >= 0:
            a, b = self.border(before, True), self.border(token, False)
            i = j = 0
            while ok:
                (x, x_end), (y, y_end) = a[i], b[j]
                joins = self.merges.get((x, y))
                if joins is not None and joins[0] < x_end and joins[0] <= y_end:
                    ok = False
                elif x_end == y_end == float("inf"):
                    break
                elif x_end <= y_end:
                    i += 1
                else:
                    j += 1
        if len(self.fits) > 1_000_000:
            self.fits.clear()
        self.fits[before, token] = ok
        return ok

    def encode_words(self, words: set[str]) -> None:
        """Walk the trie of the words that are not yet known, depth first; results go to self.words."""
        fits, stands, steps, step, ends, shuts = self.fits, self.stands, self.steps, self.step, self.ends, self.shuts
        known = self.words
        last: list[int] = [-1]  # last token of each prefix on the path
        came: list[int] = [0]  # where that token begins
        states: list[int] = [0]
        path = b""
        for raw, word in sorted([(w.encode("utf-8", "replace"), w) for w in words]):
            shared, n = 0, min(len(raw) - 1, len(path))
            while shared < n and raw[shared] == path[shared]:
                shared += 1
            shared = min(shared, len(last) - 1)
            del last[shared + 1 :], came[shared + 1 :], states[shared + 1 :]
            path = raw
            state = states[-1]
            for end in range(shared + 1, len(raw)):
                byte = raw[end - 1]
                state = steps.get((state, byte)) or step(state, byte)
                for size, token in ends[state]:
                    before = last[end - size]
                    ok = fits.get((before, token))
                    if ok or ok is None and stands(before, token):
                        last.append(token)
                        came.append(end - size)
                        states.append(state)
                        break
                else:
                    raise ValueError("no encoding of a prefix")
            end = len(raw)
            for size, token in shuts[step(state, raw[-1])]:
                begin = end - size
                before = last[begin]
                ok = fits.get((before, token))
                if ok or ok is None and stands(before, token):
                    break
            else:
                raise ValueError("no encoding of a word")
            ids = [token]
            while begin:
                ids.append(last[begin])
                begin = came[begin]
            ids.reverse()
            known[word] = tuple(ids)

    def learn(self, new: set[str | int], decode: bool) -> None:
        """Make these pieces known."""
        cut = {p: [str(p)] if isinstance(p, int) else WORD.findall(p) for p in new}
        want = {w for p, words in cut.items() if not isinstance(p, int) for w in words}
        if len(self.words) + len(want) > self.most_kept:
            self.words.clear()
        self.encode_words(want.difference(self.words))
        text, of = self.text, self.words
        for p, words in cut.items():
            ids = (p,) if isinstance(p, int) else of[words[0]] if len(words) == 1 else [i for w in words for i in of[w]]
            self.ids_of[p] = array("I", ids).tobytes()
            if decode:
                self.text_of[p] = " ".join([text[i] for i in ids]).encode("utf-8")

    def encode(self, texts: list[str], decode: bool = False):
        """For each text its ids as little-endian 32-bit bytes, and with decode=True also the decoded text's bytes."""
        for at in range(0, len(texts), 256):
            batch = [self.cut(t or "") for t in texts[at : at + 256]]
            if len(self.ids_of) > self.most_kept:
                self.ids_of.clear()
                self.text_of.clear()
            new: set[str | int] = set()
            for pieces in batch:
                new |= set(pieces).difference(self.text_of if decode else self.ids_of)
            self.learn(new, decode)
            ids_of, text_of = self.ids_of.__getitem__, self.text_of.__getitem__
            for pieces in batch:
                if decode:
                    yield b"".join(map(ids_of, pieces)), b" ".join(filter(None, map(text_of, pieces)))
                else:
                    yield b"".join(map(ids_of, pieces))


@lru_cache(maxsize=1)
def _encoder(path: str, most_kept: int) -> WordEncoder:
    return WordEncoder(path, most_kept)


def encoder(path: str, most_kept: int = 600_000) -> WordEncoder:
    """One encoder for each worker process."""
    only_cache("bpe", _encoder.cache_clear)
    return _encoder(path, most_kept)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs -> (id, ids array<int>, decoded string): whole texts, as the tokenizers library encodes them with
    add_special_tokens=False and decodes with skip_special_tokens=False.

    A null text counts as empty and gives no ids and an empty decoded text. Nulls in the id stay null, repeated rows stay,
    other columns are ignored, an empty table gives no rows. A piece without white space of any length is one entry.
    """

    def run(batches):
        import numpy as np

        enc = encoder(path)
        for pdf in batches:
            got = list(enc.encode(pdf["text"].tolist(), decode=True))
            yield pd.DataFrame({"id": pdf["id"], "ids": [np.frombuffer(i, "<u4").astype("int32") for i, _ in got], "decoded": [d.decode("utf-8") for _, d in got]})

    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInPandas(run, "id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same encoding, with hashes of ids and decoded text in place of the texts (nothing long leaves the worker)."""

    def run(batches):
        enc = encoder(path)
        for pdf in batches:
            got = [(len(i) // 4, hashlib.sha256(i).hexdigest(), hashlib.sha256(d).hexdigest()) for i, d in enc.encode(pdf["text"].tolist(), decode=True)]
            yield pd.DataFrame(got, columns=["n_tokens", "ids_sha256", "decoded_sha256"]).assign(doc_id=pdf["id"].to_numpy())[["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]]

    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary())
