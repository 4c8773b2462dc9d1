"""Best-fit packing planned over a histogram of lengths."""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.common import first_after, ranked_within, rows_of, slots_frame, written

#: Tokens of a sequence.
CAPACITY = 1024
#: The id that ends every document.
END_ID = 2
#: A task keeps the ids of words it has met, as many as this, to encode a word once.
KEPT_WORDS = 400_000


def default_tokenizer() -> str:
    """The installed byte-level BPE as ranks; any such file that all executors can open will do."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens(tokenizer_path: str) -> dict[str, int]:
    """The added tokens in the vocabulary's file for the tokenizers library, which lies beside the ranks; none without that file."""
    beside = Path(tokenizer_path).with_suffix(".json")
    if not beside.exists():
        return {}
    found = json.loads(beside.read_text(encoding="utf-8")).get("added_tokens", [])
    odd = [t["content"] for t in found if t["single_word"] or t["lstrip"] or t["rstrip"]]
    if odd:
        raise ValueError(f"added tokens that take spaces or whole words only are not supported: {odd}")
    return {t["content"]: t["id"] for t in found}


def encoder(tokenizer_path: str) -> Callable[[list[str]], list[bytes]]:
    """Encodes texts to little-endian unsigned 32-bit ids, by a vocabulary given as ranks.

    The ids are those of the same vocabulary's file for the tokenizers library (a test holds
    one against the other): each added token found in a text is one id, and the parts between
    are encoded by the ranks. The pre-tokenizer always cuts before a single space between two
    characters that are not white space, so a text is the sum of its space-separated words
    there and a word that was met before need not be encoded again. Texts with any other use
    of spaces are encoded whole.
    """
    import public_tokenizers
    import tiktoken

    with open(tokenizer_path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    model = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    added = added_tokens(tokenizer_path)
    marks = re.compile(f"({'|'.join(map(re.escape, sorted(added, key=len, reverse=True)))})")
    odd = re.compile(r" (?:(?!\S)|(?<!\S ))")
    known: dict[str, bytes] = {}
    between = ranks[b"\n"]

    def ids_of(text: str) -> np.ndarray:
        return np.array(model.encode_ordinary(text), "<u4")

    def learn(words: set[str]) -> None:
        """Encodes new words in one call, with line breaks between those without white space.

        A line break before a space or a letter is a token of its own, so it marks the ends.
        """
        plain = [w for w in words if len(w.split()) == 1 and not w[-1].isspace() and (w[0] == " " or not w[0].isspace())]
        ids = ids_of("\n".join(plain))
        ends = [*np.flatnonzero(ids == between).tolist(), len(ids)]
        if len(ends) != len(plain):
            plain, ends = [], []
        start, flat = 0, ids.tobytes()
        for word, end in zip(plain, ends, strict=True):
            known[word] = flat[4 * start : 4 * end]
            start = end + 1
        for word in words.difference(plain):
            known[word] = ids_of(word).tobytes()

    def encode(texts: list[str]) -> list[bytes]:
        held = [i for i, t in enumerate(texts) if any(x in t for x in added)]
        if not held:
            return encode_parts(texts)
        pieces = {i: [x for x in marks.split(texts[i]) if x] for i in held}
        parts = iter(encode_parts([x for i, t in enumerate(texts) for x in pieces.get(i, [t]) if i not in pieces or x not in added]))
        tokens = {t: np.array([n], "<u4").tobytes() for t, n in added.items()}
        return [b"".join(tokens[x] if x in added else next(parts) for x in pieces[i]) if i in pieces else next(parts) for i in range(len(texts))]

    def encode_parts(texts: list[str]) -> list[bytes]:
        cut = [None if odd.search(t) or "\0" in t else t.replace(" ", "\0 ").split("\0") for t in texts]
        words = set().union(*(c for c in cut if c))
        fresh = words.difference(known)
        if fresh:
            if len(known) + len(fresh) > KEPT_WORDS:
                known.clear()
                fresh = words
            learn(fresh)
        return [ids_of(t).tobytes() if c is None else b"".join(map(known.__getitem__, c)) for t, c in zip(texts, cut, strict=True)]

    return encode


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document cut to pieces that fit.

    A document of more than `capacity` ids becomes pieces of `capacity`; only the first may
    be shorter. A null or empty text is the end id alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        end = np.asarray([end_id], "<u4").tobytes()
        for doc_ids, texts in rows_of(batches):
            out = ([], [], [], [], [])
            encoded = (x for i in range(0, len(texts), 64) for x in encode([t or "" for t in texts[i : i + 64]]))
            for doc_id, ids in zip(doc_ids, encoded, strict=True):
                ids += end
                total = len(ids) // 4
                cuts = [0, *range(total % capacity or min(total, capacity), total + 1, capacity)]
                view = memoryview(ids)
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    for column, value in zip(out, (doc_id, piece, a, b - a, zlib.crc32(view[4 * a : 4 * b])), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    return narrow.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], capacity: int) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """length -> [(end rank, start rank, first sequence, pieces per sequence, offset)].

    Best fit, longest lengths first, over counts: all pieces of a length go to the fullest
    sequences that still hold them, as many to each as fit, then to new ones. Sequences with
    equal room are kept as ranges, so the plan's size depends on the capacity alone.
    """
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free tokens -> (first sequence, sequences)
    out: dict[int, list[tuple[int, int, int, int, int]]] = defaultdict(list)
    opened = 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        for free in [*(f for f in range(length, capacity) if room.get(f)), capacity]:
            each = free // length
            while left and (free == capacity or room[free]):
                if free == capacity:
                    first, n = opened, -(-left // each)
                    opened += n
                else:
                    first, n = room[free].pop()
                put = min(left, n * each)
                out[length].append((rank + put, rank, first, each, capacity - free))
                full, rest = divmod(put, each)
                for a, b, now in ((first, full, free - each * length), (first + full, 1 if rest else 0, free - rest * length), (first + full + (rest > 0), n - full - (rest > 0), free)):
                    if b and now:
                        room[now].append((a, b))
                rank, left = rank + put, left - put
            if not left:
                break
    return out


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces with a `length` of 1 to `capacity`.

    The histogram of lengths (at most `capacity` counts) is planned on the driver; a piece
    then finds its slot by its rank among the pieces of its length. Repeated rows are pieces
    of their own; an empty table gives an empty result.
    """
    spark = pieces.sparkSession
    kept = written(pieces.withColumn("_tie", F.monotonically_increasing_id()).withColumn("_len", F.col("length").cast("int")), "pieces")
    counts = {r["_len"]: r["n"] for r in kept.groupBy("_len").agg(F.count("*").alias("n")).collect()}
    runs = slots_frame(
        spark,
        [(k, [tuple(x) for x in v]) for k, v in plan(counts, capacity).items()],
        "_len int, _runs array<struct<upto:long,since:long,first:long,each:long,at:long>>",
    )
    ranked = ranked_within(kept, "_len", "_tie", counts, "_rank")
    run, inside = F.col("_run"), F.col("_rank") - F.col("_run")["since"]
    return (
        ranked.join(runs, "_len")
        .withColumn("_run", first_after(F.col("_runs"), "upto", F.col("_rank")))
        .withColumn("sequence_id", run["first"] + F.floor(inside / run["each"]))
        .withColumn("offset", run["at"] + F.pmod(inside, run["each"]) * F.col("length"))
        .drop("_len", "_runs", "_run", "_rank", "_tie")
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every document tokenized, cut and packed: see `token_pieces` and `pack_pieces`.

    Documents with a null doc_id or repeated rows are packed like any other; columns beside
    doc_id and text are not read.
    """
    return pack_pieces(token_pieces(docs, tokenizer_path, capacity), capacity)
