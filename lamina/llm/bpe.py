"""BPE encoding and decoding over a public vocabulary file.

``encode`` adds the token ids of whole texts, ``decode`` turns ids back into text.  Each white-space separated chunk of a text is
normalised, cut into words and merged on its own; a bounded memo per Python worker keeps chunks that come again.  The merge of a
short word holds its parts and the ranks of adjacent pairs in two contiguous arrays: the smallest rank is found by a scan, the
boundary behind it is deleted and the two neighbouring ranks are refreshed.  Words above ``SHORT`` symbols (long runs without any
white space) merge with a heap instead, with the same result, so one huge word doesn't cost the square of its length.

The vocabulary file is read on the driver and broadcast; its size is bounded by the vocabulary, not by the data.  No shuffle: rows
stay where they are read, and a lost executor only repeats its own input splits.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.common import Memo, adds, beside_text, blocks, quoted

BLOCK_BYTES = 1_000_000  # text or ids worked on at once by a Python worker
ROOM = 400_000  # chunks a Python worker remembers
SHORT = 96  # symbols up to which a word is merged by scanning
NONE = 1 << 30  # the rank of a pair that never merges


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: printable bytes for themselves, others from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


@dataclass
class Vocabulary:
    """What the tasks need of a tokenizer file; ``end`` is the mark of a word's last symbol ('' where words have none)."""

    tokens: list[str]
    ranks: dict[int, int]  # left id << 20 | right id -> rank
    merged: list[int]  # rank -> id
    first: list[int]  # byte -> id
    last: list[int]  # byte -> id when it ends its word
    special: dict[str, int] = field(default_factory=dict)
    end: str = ""

    @staticmethod
    def load(path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        ids: dict[str, int] = model["vocab"]
        special = {a["content"]: a["id"] for a in file["added_tokens"]}
        tokens = [""] * (1 + max([*ids.values(), *special.values()]))
        for t, i in [*ids.items(), *special.items()]:
            tokens[i] = t
        end = model.get("end_of_word_suffix") or ""
        ranks, merged = {}, []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            ranks[ids[a] << 20 | ids[b]] = rank
            merged.append(ids[a + b])
        letters = byte_letters()
        return Vocabulary(tokens, ranks, merged, [ids[c] for c in letters], [ids[c + end] for c in letters], special, end)

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word."""
        parts = [self.first[b] for b in word]
        parts[-1] = self.last[word[-1]]
        return self.merge_short(parts) if len(parts) <= SHORT else self.merge_long(parts)

    def merge_short(self, parts: list[int]) -> list[int]:
        """Contiguous rank array: ``around[i]`` is the rank of parts i and i + 1."""
        get, merged = self.ranks.get, self.merged
        around = [get(a << 20 | b, NONE) for a, b in zip(parts, parts[1:])]
        while around:
            rank = min(around)
            if rank == NONE:
                break
            i = around.index(rank)
            parts[i] = merged[rank]
            del parts[i + 1], around[i]
            if i < len(around):
                around[i] = get(parts[i] << 20 | parts[i + 1], NONE)
            if i:
                around[i - 1] = get(parts[i - 1] << 20 | parts[i], NONE)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in the same order (lowest rank, then leftmost) with a heap over a linked list."""
        n, get = len(parts), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := get(a << 20 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else n
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = self.merged[rank], None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := get(parts[k] << 20 | parts[after[k]])) is not None:
                    heapq.heappush(heap, (r, k, parts[k], parts[after[k]]))
        return [p for p in parts if p is not None]


# The word pattern of the vocabulary with word ends.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Python's split() takes these for white space, the pattern doesn't.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


class WordEncoder:
    """Encodes texts with a vocabulary that has word ends: canonical composition, one-to-one lower case, white space dropped."""

    def __init__(self, vocabulary: Vocabulary, pattern: str = WORDS, room: int = ROOM):
        self.vocabulary, self.pattern, self.space = vocabulary, regex.compile(pattern), regex.compile(r"\s+")
        self.specials = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(vocabulary.special, key=len, reverse=True)) + ")") if vocabulary.special else None
        self.memo = Memo(self._chunk, room=room)

    def _chunk(self, chunk: str) -> bytes:
        # lower case letter by letter: a sigma that ends a word has no form of its own
        plain = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        ids: list[int] = []
        for word in self.pattern.findall(plain):
            ids += self.vocabulary.merge(word.encode())
        return np.array(ids, dtype=np.int32).tobytes()

    def _plain(self, text: str) -> bytes:
        chunks = self.space.split(text) if any(s in text for s in SEPARATORS) else text.split()
        return b"".join(map(self.memo.__getitem__, chunks))

    def encode(self, text: str | None) -> bytes:
        """Packed 32-bit ids; special strings inside a text are their special tokens."""
        if not text:
            return b""
        if self.specials is None or not any(s in text for s in self.vocabulary.special):
            return self._plain(text)
        return b"".join(np.int32(self.vocabulary.special[p]).tobytes() if i % 2 else self._plain(p) for i, p in enumerate(self.specials.split(text)))


def _lists(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), dtype=np.int32)))


def _with(part: pa.RecordBatch, kept: list[str], values: pa.Array, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), values], names=[*kept, name])


def encode(df: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids", room: int = ROOM) -> DataFrame:
    """``df`` with the token ids of ``text`` as array<int> ``ids`` (in place of a column of that name).

    Null, empty and blank texts have no tokens (an empty array); whole texts are encoded whatever their length; repeated rows stay;
    an empty table gives an empty result.  Other columns pass unchanged.  A worker remembers up to ``room`` chunks: fewer take
    less memory and more time.
    """
    shared = df.sparkSession.sparkContext.broadcast(vars(Vocabulary.load(vocabulary_path)))
    kept = adds(df, ids)
    given, words = beside_text(df, kept, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(Vocabulary(**shared.value), room=room)
        for batch in batches:
            for part, texts in blocks(batch, words, BLOCK_BYTES):
                yield _with(part, kept, _lists([encoder.encode(t) for t in texts]), ids)

    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return given.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text of the token ids as ``decoded``: the token strings joined by a space, special tokens included, as the
    vocabulary file defines no decoder of its own.  A null array gives an empty text."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary_path).tokens)
    kept = adds(df, decoded)
    given = df.select(*quoted(kept), F.col(quoted([ids])[0]).alias("__ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in batches:
            for part, lists in blocks(batch, "__ids", BLOCK_BYTES):
                ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).tolist()
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                texts = [" ".join(map(token, flat[i:j].tolist())) for i, j in zip([0, *ends], ends)]
                yield _with(part, kept, pa.array(texts, type=pa.string()), decoded)

    return given.mapInArrow(run, T.StructType([*(df.schema[c] for c in kept), T.StructField(decoded, T.StringType())]))
