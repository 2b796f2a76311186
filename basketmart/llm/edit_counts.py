"""Edit-aware token counts.

A document is a row of leaves, runs of whole pre-tokens that end with white space, under a segment tree of two sums,
characters and tokens. An edit finds its leaves from the sums, applies the change to their text, takes in the next leaf
where the changed text no longer ends with white space, encodes these leaves anew and updates the sums above them. The
tokenizer never joins across white space, so leaves are counted on their own.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketmart.llm.text import by_batch, read_table
from basketmart.llm.wordbpe import WordIds, word_ids

LEAF = 256  # characters, more where a word is longer
GROWN = 8  # a leaf that grows beyond so many times LEAF is cut again

_BLANKS = " \t\n\v\f\r"
_BLANK = re.compile(r"[\x20\x09-\x0D]+")


def cut(text: str) -> list[str]:
    """Pieces of about LEAF characters, each but the last ending with white space and followed by none."""
    out, start = [], 0
    while len(text) - start > LEAF:
        blank = _BLANK.search(text, start + LEAF)
        if not blank or blank.end() == len(text):
            break
        out.append(text[start : blank.end()])
        start = blank.end()
    out.append(text[start:])
    return out


class CountedText:
    """A text under edits; ``encoded`` is the number of characters encoded so far."""

    def __init__(self, text: str, encoder: WordIds):
        self.encoder, self.encoded = encoder, 0
        self._build([(leaf, self._count(leaf)) for leaf in cut(text)])

    def _count(self, leaf: str) -> int:
        self.encoded += len(leaf)
        return len(self.encoder.encode([leaf.encode("utf-8", "replace")])[0]) // 4

    def _build(self, leaves: list[tuple[str, int]]) -> None:
        self.size = 1 << max(0, len(leaves) - 1).bit_length()
        self.leaves = leaves + [("", 0)] * (self.size - len(leaves))
        self.chars = [0] * self.size + [len(text) for text, _ in self.leaves]
        self.tokens = [0] * self.size + [n for _, n in self.leaves]
        for at in range(self.size - 1, 0, -1):
            self.chars[at] = self.chars[2 * at] + self.chars[2 * at + 1]
            self.tokens[at] = self.tokens[2 * at] + self.tokens[2 * at + 1]

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = (text, tokens)
        at = self.size + leaf
        self.chars[at], self.tokens[at] = len(text), tokens
        while at > 1:
            at //= 2
            self.chars[at] = self.chars[2 * at] + self.chars[2 * at + 1]
            self.tokens[at] = self.tokens[2 * at] + self.tokens[2 * at + 1]

    def _leaf_at(self, offset: int) -> tuple[int, int]:
        """The leaf that holds character ``offset`` (the last one with text for the end), and where it starts."""
        offset = min(offset, max(0, self.chars[1] - 1))
        at, start = 1, 0
        while at < self.size:
            at *= 2
            if offset - start >= self.chars[at]:
                start += self.chars[at]
                at += 1
        return at - self.size, start

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(text for text, _ in self.leaves)

    def edit(self, start: int, length: int, replacement: str) -> None:
        """Replace ``length`` characters from ``start``; both are cut to the text."""
        start = max(0, min(start, self.n_chars))
        end = min(start + max(0, length), self.n_chars)
        first, offset = self._leaf_at(start)
        last, _ = self._leaf_at(max(start, end - 1))
        old = "".join(text for text, _ in self.leaves[first : last + 1])
        new = old[: start - offset] + replacement + old[end - offset :]
        while last + 1 < self.size and (not new or new[-1] not in _BLANKS):
            last += 1
            new += self.leaves[last][0]
        pieces = cut(new)
        room = last - first + 1
        if len(pieces) > room:
            if len(new) <= GROWN * LEAF * room:  # the last leaf takes what doesn't fit
                pieces = pieces[: room - 1] + ["".join(pieces[room - 1 :])]
            else:  # cut anew: the sums are rebuilt, other leaves keep their counts
                counted = [(piece, self._count(piece)) for piece in pieces]
                self._build([x for x in self.leaves[:first] + counted + self.leaves[last + 1 :] if x[0]])
                return
        for leaf in range(first, last + 1):
            piece = pieces[leaf - first] if leaf - first < len(pieces) else ""
            if piece != self.leaves[leaf][0]:
                self._set(leaf, piece, self._count(piece) if piece else 0)


_SCHEMA = "doc_id long, edit int, n_tokens long, n_chars long, encoded_chars long"


def count_edits(docs: DataFrame, edits: str = "edits", path: str | None = None) -> DataFrame:
    """For each row its count before any edit (``edit`` 0) and after each of its edits, in their order.

    ``edits`` is an array of (start, length, replacement) in code points of the text as the edits before have left it; null
    is none, a null start or length is 0 and a null replacement is empty. Null texts are empty. ``encoded_chars`` is what
    was encoded for that row of the result. Ids are those of the word BPE file at ``path``. Repeated rows are counted each.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col(edits).alias("edits")
    )

    def work(columns):
        encoder = word_ids(path)
        out = [[], [], [], [], []]
        for doc_id, text, changes in zip(*columns):
            known, before = CountedText(text, encoder), 0
            for n, change in enumerate([None, *(changes or [])]):
                if n:
                    known.edit(change["start"] or 0, change["length"] or 0, change["replacement"] or "")
                for column, value in zip(out, (doc_id, n, known.n_tokens, known.n_chars, known.encoded - before)):
                    column.append(value)
                before = known.encoded
        return out

    return by_batch(rows, work, _SCHEMA, ["doc_id", "text", "edits"])


def _derived_edits():
    """Three edits of each document: a word put in at a third, twenty characters taken out at the middle, and ten
    characters at two thirds replaced by their reverse in capitals."""
    n = F.length(F.coalesce("text", F.lit("")))
    third, middle, two_thirds = (n / 3).cast("int"), (n / 2).cast("int"), (n * 2 / 3).cast("int")
    part = F.upper(F.reverse(F.substring(F.coalesce("text", F.lit("")), two_thirds + 1, F.lit(10))))
    return F.array(
        F.struct(third.alias("start"), F.lit(0).alias("length"), F.lit("revised ").alias("replacement")),
        F.struct(middle.alias("start"), F.lit(20).alias("length"), F.lit("").alias("replacement")),
        F.struct(two_thirds.alias("start"), F.lit(10).alias("length"), part.alias("replacement")),
    )


def op7_edit_aware_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return count_edits(docs.select("doc_id", "text", _derived_edits().alias("edits")))
