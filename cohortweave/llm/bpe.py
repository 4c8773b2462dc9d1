"""BPE encoding and decoding: merges in order of rank over an index of the pairs' positions."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortweave.llm.common import rows_of

#: Characters of text whose new words are merged together.
HELD_CHARS = 8_000_000
#: Encoded words that a task keeps, and the most bytes that a kept word has.
KEPT, KEPT_BYTES = 400_000, 256
#: Parts that are cut into words with one call.
JOINED = 2_000


def default_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable Latin-1 itself, others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class PairIndex:
    """Which pairs of symbols merge, in which order, and into what."""

    def __init__(self, merges: list[tuple[int, int, int]]):
        """merges: (left, right, made), by ascending rank."""
        self.left, self.right, self.made = np.array(merges, np.int64).reshape(-1, 3).T
        first = {made: rank for rank, (_, _, made) in reversed(list(enumerate(merges)))}
        if len(first) < len(merges) or any(first.get(x, -1) >= r for r, (a, b, _) in enumerate(merges) for x in (a, b)):
            raise ValueError("a symbol is made after, or twice before, a merge that uses it: ranks do not order the merges")
        keys = self.left << 32 | self.right
        self.rank = np.argsort(keys)
        self.keys = keys[self.rank]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it does not merge."""
        if not len(self.keys):
            return np.full(len(left), -1)
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.rank[at], -1)

    def merge(self, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All symbols after all merges, and where each word now ends.

        `symbols` holds the words one after the other, `ends` the place after each word's last
        symbol. An index maps every rank to the places of its pair; ranks are taken in
        ascending order, a pair's places from left to right, and each merge enters the pairs
        that it makes with its neighbours. A made symbol takes part in later ranks only (see
        `__init__`), so one rising pass is the same as always merging the lowest rank of a word.
        """
        n = len(symbols)
        sym = np.append(symbols.astype(np.int64), -1)  # place n: no neighbour
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        starts = np.append(0, ends[:-1]) if len(ends) else ends
        after[ends - 1], before[starts] = n, n
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            ranks = self.ranks(sym[at], sym[after[at]])
            at, ranks = at[ranks >= 0], ranks[ranks >= 0]
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for rank, group in zip(ranks[np.append(0, cuts)].tolist() if len(ranks) else [], np.split(at, cuts)):
                if rank not in places:
                    places[rank] = []
                    heapq.heappush(active, rank)
                places[rank].append(group)

        enter(np.arange(n))
        while active:
            rank = heapq.heappop(active)
            groups = places.pop(rank)
            at = np.unique(np.concatenate(groups)) if len(groups) > 1 else groups[0]
            at = at[(sym[at] == self.left[rank]) & (sym[after[at]] == self.right[rank])]
            if self.left[rank] == self.right[rank] and len(at) > 1:
                new_run = np.append(True, after[at[:-1]] != at[1:])
                run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            sym[at], sym[gone] = self.made[rank], -1
            after[at] = after[gone]
            before[after[at]] = at
            neighbours = before[at]
            enter(np.unique(np.concatenate([neighbours[neighbours < n], at])))
        kept = sym[:n] >= 0
        return sym[:n][kept], np.append(0, np.cumsum(kept))[ends]


class BytePairCoder:
    """Encodes and decodes as the tokenizers library does with a file of byte symbols and word ends.

    Texts are split at added tokens, then at ASCII white space, which no word of such a file
    holds; the file's own normalizer and pre-tokenizer make the words of each distinct part.
    """

    def __init__(self, tokenizer_path: str):
        with open(tokenizer_path, encoding="utf-8") as file:
            told = json.load(file)
        model, end = told["model"], told["model"].get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.index = PairIndex([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges])
        symbols = byte_symbols()
        self.inner = {c: vocab[c] for c in symbols}
        self.final = {c: vocab[c + end] for c in symbols}
        self.added = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.marks = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})") if self.added else None
        tokenizer = Tokenizer.from_file(tokenizer_path)
        self.normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        if not plain or told["decoder"] or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in told["added_tokens"]):
            raise ValueError(f"{tokenizer_path} asks for more than byte symbols, merges and plain added tokens")
        if self.words("a b\n c") != [*self.words("a"), *self.words("b"), *self.words("c")]:
            raise ValueError(f"{tokenizer_path} keeps white space in its words")
        self.names = [""] * (1 + max([*vocab.values(), *self.added.values()]))
        for name, number in [*vocab.items(), *self.added.items()]:
            self.names[number] = name
        self.known: dict[bytes, bytes] = {}
        self.known_words: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        return [w for w, _ in self.split(self.normalize(text))]

    def words_of_parts(self, parts: list[bytes]) -> list[list[str]]:
        """The words of each part; parts without any white space many at a time, a space between them."""
        texts = [p.decode() for p in parts]
        plain = [i for i, t in enumerate(texts) if t.split() == [t]]
        found: list[list[str]] = [[] for _ in parts]
        for lot in (plain[i : i + JOINED] for i in range(0, len(plain), JOINED)):
            text = self.normalize(" ".join(map(texts.__getitem__, lot)))
            ends = np.cumsum([len(t) + 1 for t in text.split(" ")])
            words = self.split(text)
            for at, (word, _) in zip(np.searchsorted(ends, [start for _, (start, _) in words], side="right").tolist(), words):
                found[lot[at]].append(word)
        for i in set(range(len(parts))).difference(plain):
            found[i] = self.words(texts[i])
        return found

    def learn(self, parts: set[bytes]) -> dict[bytes, bytes]:
        """The ids of each part, as little-endian unsigned 32-bit numbers."""
        order = list(parts)
        words = self.words_of_parts(order)
        fresh = list({w for ws in words for w in ws}.difference(self.known_words))
        symbols: list[int] = []
        for word in fresh:
            symbols.extend(map(self.inner.__getitem__, word))
            symbols[-1] = self.final[word[-1]]
        ends = np.cumsum([len(w) for w in fresh], dtype=np.int64)
        ids, ends = self.index.merge(np.array(symbols, np.int64), ends)
        flat, cuts = ids.astype("<u4").tobytes(), (4 * ends).tolist()
        self.known_words.update(zip(fresh, (flat[a:b] for a, b in zip([0, *cuts], cuts))))
        made = {part: b"".join(map(self.known_words.__getitem__, ws)) for part, ws in zip(order, words, strict=True)}
        for word in fresh:
            if len(word) > KEPT_BYTES:
                del self.known_words[word]
        return made

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit numbers."""
        pieces = [self.marks.split(t) if self.marks else [t] for t in texts]
        cut = [[p if i % 2 else p.encode().split() for i, p in enumerate(ps)] for ps in pieces]
        fresh = {w for ps in cut for p in ps[::2] for w in p}.difference(self.known)
        if len(self.known) + len(fresh) > KEPT:
            self.known, self.known_words = {}, {}
            fresh = {w for ps in cut for p in ps[::2] for w in p}
        self.known.update(self.learn(fresh))
        added = {t: np.array([n], "<u4").tobytes() for t, n in self.added.items()}
        ids = [b"".join(added[p] if i % 2 else b"".join(map(self.known.__getitem__, p)) for i, p in enumerate(ps)) for ps in cut]
        for part in fresh:
            if len(part) > KEPT_BYTES:
                del self.known[part]
        return ids

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids, joined by one space each, as a file without a decoder has it."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of several batches at a time, so that their new words are merged together."""
    keys, texts, chars = [], [], 0
    for ids, found in rows_of(batches):
        for key, text in zip(ids, found, strict=True):
            keys.append(key)
            texts.append(text or "")
            chars += len(texts[-1])
            if chars >= HELD_CHARS:
                yield keys, texts
                keys, texts, chars = [], [], 0
    if keys:
        yield keys, texts


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, ids): the ids of every whole text; none for a null or empty one.

    One row per row of docs, whatever repeats or is null; no other column is read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = BytePairCoder(tokenizer_path)
        for keys, texts in _held(batches):
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in coder.encode(texts)]
            offsets = np.append(0, np.cumsum([len(x) for x in ids])).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), lists], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, text): what the ids of `encode_documents` stand for; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = BytePairCoder(tokenizer_path)
        for keys, lists in rows_of(batches):
            texts = [coder.decode(np.array(ids or [], "<u4").tobytes()) for ids in lists]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, encoded and decoded.

    The ids stay in the task: digests are all that leaves it. Nulls and repeats as in
    `encode_documents`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = BytePairCoder(tokenizer_path)
        for keys, texts in _held(batches):
            ids = coder.encode(texts)
            columns = (
                pa.array(keys, pa.int64()),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                pa.array([hashlib.sha256(coder.decode(x).encode()).hexdigest() for x in ids]),
            )
            yield pa.RecordBatch.from_arrays(list(columns), names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
