"""Token counts with a whole-token shortcut.

``whole_tokens`` proves once, on the driver, which vocabulary strings encode alone as one token: the string has to be a single
pre-token of the pattern, and merging its bytes has to end in one part.  Tasks count such pre-tokens as one by a set lookup and
merge only the rest.  Counts are kept per space-separated piece of a text in a bounded memo, so most pieces cost one lookup.

The set and the merge table are broadcast; both are bounded by the vocabulary.  No shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lamina.llm.bpe import Vocabulary, byte_letters
from lamina.llm.common import Memo, adds, beside_text, blocks

# The pre-token pattern of the byte-level vocabulary.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE = 1_000_000  # letters of a text without usable spaces that are cut at once


def whole_tokens(vocabulary: Vocabulary, pattern: str = PRETOKENS) -> frozenset[str]:
    """Vocabulary strings (as text) that are one pre-token and merge into one token."""
    back, cut, found = {c: b for b, c in enumerate(byte_letters())}, regex.compile(pattern), []
    for token in vocabulary.tokens:
        if not token or token in vocabulary.special:
            continue
        raw = bytes(back[c] for c in token)
        try:
            text = raw.decode()
        except UnicodeDecodeError:  # a part of a letter is no pre-token
            continue
        if cut.findall(text) == [text] and len(vocabulary.merge(raw)) == 1:
            found.append(text)
    return frozenset(found)


@dataclass
class Counter:
    """Counts tokens of texts; made once per task."""

    vocabulary: Vocabulary
    whole: frozenset[str]
    pattern: str = PRETOKENS

    def __post_init__(self):
        self.cut, self.edge = regex.compile(self.pattern), regex.compile(r"(?<=\S)(?=\s)")
        self.memo = Memo(self._piece)
        self.specials = regex.compile("|".join(regex.escape(s) for s in sorted(self.vocabulary.special, key=len, reverse=True))) if self.vocabulary.special else None

    def pretoken(self, text: str) -> int:
        return 1 if text in self.whole else len(self.vocabulary.merge(text.encode()))

    def _piece(self, piece: str) -> int | None:
        """Tokens of a space and ``piece``; None where a run of white space could reach beyond the piece."""
        if not piece or piece[0].isspace():
            return None
        return sum(map(self.pretoken, self.cut.findall(" " + piece)))

    def _by_pattern(self, text: str) -> int:
        """Any text, cut before the first white space behind each ``PIECE`` letters: no pre-token crosses that place."""
        count, at = 0, 0
        while at < len(text):
            m = self.edge.search(text, at + PIECE) if at + PIECE < len(text) else None
            end = m.start() if m else len(text)
            count += sum(map(self.pretoken, self.cut.findall(text[at:end])))
            at = end
        return count

    def _plain(self, text: str) -> int:
        if not text:
            return 0
        head, *rest = text.split(" ")
        if head and not head[0].isspace():
            try:
                return sum(map(self.pretoken, self.cut.findall(head))) + sum(map(self.memo.__getitem__, rest))
            except TypeError:  # a piece said None
                pass
        return self._by_pattern(text)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.specials is None or not any(s in text for s in self.vocabulary.special):
            return self._plain(text)
        plain = self.specials.split(text)
        return len(plain) - 1 + sum(map(self._plain, plain))


def count_tokens(df: DataFrame, vocabulary_path: str, text: str = "text", n_tokens: str = "n_tokens") -> DataFrame:
    """``df`` with the number of tokens of ``text`` as long ``n_tokens`` (in place of a column of that name).

    Null and empty texts have 0 tokens; special strings inside a text count as one token each; whole texts of any length are
    counted; repeated rows stay; an empty table gives an empty result.
    """
    vocabulary = Vocabulary.load(vocabulary_path)
    shared = df.sparkSession.sparkContext.broadcast((vars(vocabulary), whole_tokens(vocabulary)))
    kept = adds(df, n_tokens)
    given, own_text = beside_text(df, kept, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, whole = shared.value
        counter = Counter(Vocabulary(**fields), whole)
        for batch in batches:
            for part, texts in blocks(batch, own_text):
                values = pa.array([counter.count(t) for t in texts], type=pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), values], names=[*kept, n_tokens])

    return given.mapInArrow(run, T.StructType([*(df.schema[c] for c in kept), T.StructField(n_tokens, T.LongType())]))
