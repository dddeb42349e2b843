"""BPE encoding and decoding with batched numpy merge rounds.

The words of a batch that were not met before lie as symbols in one flat array. In each round the key of every adjacent
pair is looked up by binary search in the sorted keys of the merge table, the lowest rank in each word is taken, and all
places of that pair in that word are merged at once, left to right. Merging all places at once equals merging them one by
one if no pair that holds the new symbol has a lower rank; where a table breaks this, only the leftmost place is merged.
Words that have no pair left leave the array.

Defined results: a null text is an empty one and gives no ids; equal texts give equal rows; the strings of special tokens
in a text are those tokens, as in the tokenizers library; an empty table gives no rows; only `doc_id` and `text` are read.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces

SUFFIX = "</w>"
#: Words that a task remembers before it starts anew. It forgets them at its end, as its worker goes on to other work.
REMEMBER = 400_000
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Word pattern of the vocabulary file, with white space spelled out.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is printable, else one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordBpe:
    """A vocabulary file with word-end suffix, as its merge table in sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        pairs = [x.split(" ") if isinstance(x, str) else x for x in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        new = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.none = len(pairs)
        order = np.argsort(left << 20 | right, kind="stable")
        self.keys, self.ranks, self.new = (left << 20 | right)[order], order.astype(np.int64), new
        least = np.full(max(self.token) + 1, self.none, dtype=np.int64)
        np.minimum.at(least, left, np.arange(self.none))
        np.minimum.at(least, right, np.arange(self.none))
        self.safe = np.append(least[new] > np.arange(self.none), True)
        symbols = byte_symbols()
        self.first = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self.last = np.array([vocab[s + SUFFIX] for s in symbols], dtype=np.int64)
        self.bytes_of = {s: i for i, s in enumerate(symbols)}
        self.words = regex.compile(PATTERN)
        self.parts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def pretokens(self, text: str) -> list[str]:
        """Words and special tokens of a text, in order. A special token keeps a leading NUL mark, which no word begins with alone."""
        if self.parts is not None and "<|" in text:
            out = []
            for i, part in enumerate(self.parts.split(text)):
                out += ["\0" + part] if i % 2 else self.plain(part)
            return out
        return self.plain(text)

    def plain(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # lower case character by character: no final form
            text = text.replace("Σ", "σ")
        return self.words.findall(text.lower())

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word, by merge rounds over all of them together."""
        raw = [w.encode("utf-8") for w in words]
        sizes = np.array([len(x) for x in raw], dtype=np.int64)
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
        symbols = self.first[flat]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[flat[ends]]
        word = np.repeat(np.arange(len(words)), sizes)
        out: list = [None] * len(words)
        while len(symbols):
            rank = np.full(len(symbols), self.none, dtype=np.int64)
            if len(symbols) > 1:
                keys = symbols[:-1] << 20 | symbols[1:]
                at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
                rank[:-1] = np.where((self.keys[at] == keys) & (word[:-1] == word[1:]), self.ranks[at], self.none)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            counts = np.diff(np.append(starts, len(word)))
            best = np.minimum.reduceat(rank, starts)
            done = best == self.none
            if done.any():
                for s, n in zip(starts[done].tolist(), counts[done].tolist()):
                    out[word[s]] = symbols[s : s + n].tolist()
                keep = np.repeat(~done, counts)
                symbols, word, rank = symbols[keep], word[keep], rank[keep]
                best, counts = best[~done], counts[~done]
                if not len(symbols):
                    break
            of_word = np.repeat(best, counts)
            merge = rank == of_word
            places = np.flatnonzero(merge)
            safe = self.safe[of_word[places]]
            # of places that touch (equal symbols in a row) every second one; of unsafe pairs the first in the word
            run = np.append(True, places[1:] != places[:-1] + 1)
            began = np.maximum.accumulate(np.where(run, places, 0))
            first = np.append(True, word[places[1:]] != word[places[:-1]])
            places = places[((places - began) % 2 == 0) & (safe | first)]
            symbols[places] = self.new[rank[places]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[places + 1] = False
            symbols, word = symbols[keep], word[keep]
        return out

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by spaces: the file names no decoder."""
        return " ".join(self.token[i] for i in ids)

    def text_of(self, ids: list[int]) -> str:
        """The text behind the ids: word ends become spaces, byte symbols bytes."""
        joined = "".join(self.token[i] for i in ids).replace(SUFFIX, " ")
        return b"".join(bytes([self.bytes_of[c]]) if c in self.bytes_of else c.encode() for c in joined).decode("utf-8", "replace").rstrip(" ")


class Encoder:
    """Remembers, for each word, its ids, their text and their decoding."""

    def __init__(self, path: str):
        self.bpe = WordBpe(path)
        self.ids: dict[str, str] = {}
        self.decoded: dict[str, str] = {}

    def forget(self) -> None:
        self.ids.clear()
        self.decoded.clear()

    def learn(self, words: set[str]) -> None:
        if len(self.ids) > REMEMBER:
            self.forget()
        new = [w for w in words if w not in self.ids]
        plain = [w for w in new if w[0] != "\0" or w[1:] not in self.bpe.special]
        for w in new:
            if w[0] == "\0" and w[1:] in self.bpe.special:
                self.ids[w], self.decoded[w] = str(self.bpe.special[w[1:]]), w[1:]
        for w, ids in zip(plain, self.bpe.encode_words(plain) if plain else []):
            self.ids[w], self.decoded[w] = " ".join(map(str, ids)), self.bpe.decode(ids)

    def encode(self, texts: list[str | None]):
        """(ids joined by spaces, decoding) of each text."""
        for i in range(0, len(texts), 200):
            split = [self.bpe.pretokens(t) if t else [] for t in texts[i : i + 200]]
            self.learn(set().union(*split))
            for words in split:
                yield " ".join(map(self.ids.__getitem__, words)), " ".join(map(self.decoded.__getitem__, words))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each Python worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, decoded: the ids of each whole text and their decoding."""

    def run(batches):
        e = encoder(path)
        for b in pieces(batches):
            ids, decoded = [], []
            for i, d in e.encode(b.column(1).to_pylist()):
                ids.append([int(x) for x in i.split()])
                decoded.append(d)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])
        e.forget()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and their decoding, by the same encoder."""

    def run(batches):
        e = encoder(path)
        for b in pieces(batches):
            n, ids_sha, decoded_sha = [], [], []
            for i, d in e.encode(b.column(1).to_pylist()):
                n.append(i.count(" ") + 1 if i else 0)
                ids_sha.append(hashlib.sha256(i.encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(d.encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        e.forget()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4(spark, sf_dir) -> DataFrame:
    return encode_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_path())
