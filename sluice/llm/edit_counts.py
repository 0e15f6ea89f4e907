"""Token counts that follow edits: a segment tree of pre-tokens per document.

A byte-level BPE never merges across pre-tokens (the pieces of ``PATTERN``), so
a text's token count is the sum over its pre-tokens. A document's leaves are
runs of about ``LEAF`` pre-tokens with their characters and tokens; inner nodes
hold the sums of their subtrees. An edit

1. finds the leaves it touches by descending along character sums, and takes the
   leaf before along if the edit begins within ``CONTEXT`` characters of a leaf,
   as far as the pattern looks ahead;
2. splits the edited text of these leaves into pre-tokens, with the text behind
   as context, and takes further leaves along until a pre-token ends where the
   next leaf begins: from there on nothing has changed;
3. encodes the pre-tokens of these leaves only and updates the sums above them.

Trees are plain columns (characters and tokens of the leaves), so they can be
stored beside the documents and edited later without encoding the rest again.
Documents are independent of each other: no shuffle.

Edits are applied in their order, each to the text as the ones before left it;
positions are code points, cut to the text, and a start behind its end is
exchanged with it. Defined cases: null text counts as empty and has no tokens; a
null edit list or null edits change nothing; a null replacement deletes; a tree
that is null or of another length than its text is built anew; repeated rows are counted each; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from itertools import accumulate

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The pre-token pattern that belongs to this vocabulary; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF = 24
CONTEXT = 3
CACHE = 200_000

TREE = "struct<chars:array<int>,tokens:array<int>>"
EDITS = "array<struct<start:int,end:int,text:string>>"


class Counter:
    """Tokens of pre-tokens, remembered up to ``CACHE`` of them."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.split = regex.compile(pattern).findall
        self.known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        known, out = self.known, []
        for piece in pieces:
            n = known.get(piece)
            if n is None:
                n = len(self.encoding.encode_ordinary(piece))
                if len(known) >= CACHE:
                    known.clear()
                if len(piece) <= 64:
                    known[piece] = n
            out.append(n)
        return out


class TokenTree:
    """Leaves with their texts, and character and token sums in two implicit binary trees of one shape.

    Texts are kept by leaf, so an edit moves the characters of the leaves it
    touches and no others. A leaf may hold up to twice ``LEAF`` pre-tokens, and
    empty places lie between the leaves, so most edits change sums only.
    """

    def __init__(self, text: str, chars: list[int], tokens: list[int], counter: Counter):
        self.counter, self.encoded = counter, 0
        self._grow(_slices(text, chars), tokens)

    @classmethod
    def build(cls, text: str, counter: Counter) -> TokenTree:
        tree = cls(text, *leaves_of(text, counter), counter)
        tree.encoded = len(text)
        return tree

    def _grow(self, texts: list[str], tokens: list[int]) -> None:
        self.width = 1 << (max(1, 2 * len(texts)) - 1).bit_length()
        self.texts, held = [""] * self.width, [0] * self.width
        self.texts[: 2 * len(texts) : 2], held[: 2 * len(texts) : 2] = texts, tokens
        self.chars = [0] * self.width + list(map(len, self.texts))
        self.tokens = [0] * self.width + held
        for k in range(self.width - 1, 0, -1):
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
            self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    @property
    def text(self) -> str:
        return "".join(self.texts)

    @property
    def total(self) -> int:
        return self.tokens[1]

    def leaves(self) -> tuple[list[int], list[int]]:
        """Characters and tokens of the leaves that have text."""
        there = [k for k in range(self.width, 2 * self.width) if self.chars[k]]
        return [self.chars[k] for k in there], [self.tokens[k] for k in there]

    def _find(self, at: int) -> tuple[int, int]:
        """``(leaf, its begin)`` of the leaf that holds a character, the last one with text at the end of the text."""
        at = min(at, max(0, self.chars[1] - 1))
        k, begin = 1, 0
        while k < self.width:
            k *= 2
            if at >= begin + self.chars[k]:
                begin += self.chars[k]
                k += 1
        return k - self.width, begin

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.texts[leaf] = text
        k = leaf + self.width
        more, rise = len(text) - self.chars[k], tokens - self.tokens[k]
        while k and (more or rise):
            self.chars[k] += more
            self.tokens[k] += rise
            k //= 2

    def _behind(self, at: int, size: int) -> str:
        """The ``size`` characters from a place on, fewer at the end of the text."""
        found = ""
        while len(found) < size and at < self.chars[1]:
            leaf, begin = self._find(at)
            found += self.texts[leaf][at - begin : at - begin + size - len(found)]
            at = begin + len(self.texts[leaf])
        return found

    def edit(self, start: int, end: int, replacement: str) -> None:
        size = self.chars[1]
        start, end = sorted((min(max(start, 0), size), min(max(end, 0), size)))
        first, begin = self._find(max(0, start - CONTEXT))
        last, last_begin = self._find(max(start, end - 1))
        stop = last_begin + len(self.texts[last])
        held = "".join(self.texts[first : last + 1])
        region = held[: start - begin] + replacement + held[end - begin :]
        while True:
            context = self._behind(stop, CONTEXT + 1)
            pieces = self.counter.split(region + context)
            if not context:
                break
            ends = list(accumulate(map(len, pieces)))
            if len(region) in ends or not region:
                pieces = pieces[: ends.index(len(region)) + 1] if region else []
                break
            last, last_begin = self._find(stop)
            stop = last_begin + len(self.texts[last])
            region += self.texts[last]
        self.encoded += len(region)
        place = last + 1
        while place < self.width and place - first < len(pieces) / LEAF and not self.texts[place]:
            place += 1
        room = place - first
        if len(pieces) <= 2 * LEAF * room:
            chars, tokens = _leaves(pieces, self.counter, max(LEAF, -(-len(pieces) // room)))
            texts = _slices(region, chars)
            for k in range(room):
                if k < len(texts):
                    self._set(first + k, texts[k], tokens[k])
                elif self.texts[first + k]:
                    self._set(first + k, "", 0)
        else:
            chars, tokens = _leaves(pieces, self.counter)
            self._spread(first, last, _slices(region, chars), tokens)

    def _spread(self, first: int, last: int, texts: list[str], tokens: list[int]) -> None:
        """Put leaves in the place of ``first`` to ``last``, for which there is no room; nothing is encoded for it.

        The smallest subtree around them that is not too full deals its leaves
        evenly over its places: wholly full ones are allowed at the leaves,
        half full ones at the root. So even if all edits hit one place, few of
        them move many leaves. A tree too full is laid out at twice the width.
        """
        size = 1
        while size < self.width:
            size *= 2
            low = first // size * size
            high = low + size
            if high <= last:
                continue
            before = [k for k in range(low, first) if self.texts[k]]
            behind = [k for k in range(last + 1, high) if self.texts[k]]
            n = len(before) + len(texts) + len(behind)
            if n <= size * (1 - 0.5 * size.bit_length() / self.width.bit_length()):
                break
        else:
            before = [k for k in range(first) if self.texts[k]]
            behind = [k for k in range(last + 1, self.width) if self.texts[k]]
            low, size = 0, 0
        counts = self.tokens
        tokens = [counts[self.width + k] for k in before] + tokens + [counts[self.width + k] for k in behind]
        texts = [self.texts[k] for k in before] + texts + [self.texts[k] for k in behind]
        if not size:
            self._grow(texts, tokens)
            return
        top = (self.width + low) // size
        was = self.chars[top], self.tokens[top]
        begin, end = self.width + low, self.width + low + size
        self.texts[low : low + size] = [""] * size
        self.chars[begin:end] = self.tokens[begin:end] = [0] * size
        for k in range(n):
            at = low + k * size // n
            self.texts[at], self.chars[self.width + at], self.tokens[self.width + at] = texts[k], len(texts[k]), tokens[k]
        while end - begin > 1:
            begin, end = begin // 2, end // 2
            for k in range(begin, end):
                self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
                self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]
        more, rise = self.chars[top] - was[0], self.tokens[top] - was[1]
        top //= 2
        while top:
            self.chars[top] += more
            self.tokens[top] += rise
            top //= 2


def _leaves(pieces: list[str], counter: Counter, size: int = LEAF) -> tuple[list[int], list[int]]:
    counts = counter.counts(pieces)
    sizes = list(map(len, pieces))
    cuts = range(0, len(pieces), size)
    return [sum(sizes[k : k + size]) for k in cuts], [sum(counts[k : k + size]) for k in cuts]


def _slices(text: str, sizes: list[int]) -> list[str]:
    return [text[end - size : end] for size, end in zip(sizes, accumulate(sizes), strict=True)]


def leaves_of(text: str, counter: Counter) -> tuple[list[int], list[int]]:
    """Characters and tokens of the leaves of a whole text."""
    return _leaves(counter.split(text), counter)


class EditCounts:
    """Column functions over one tokenizer, whose file is read once, on the driver."""

    def __init__(self, spark: SparkSession, path: str = TOKENIZER, pattern: str = PATTERN):
        with open(path, "rb") as f:
            ranks = f.read()
        held = spark.sparkContext.broadcast(ranks)  # as large as the tokenizer's file, whatever the corpus

        made: list[Counter] = []

        def counter() -> Counter:
            if not made:
                made.append(Counter(held.value, pattern))
            return made[0]

        self._counter: Callable[[], Counter] = counter

    def build(self, text: str | Column) -> Column:
        """The tree of a text column: ``TREE``."""
        counter = self._counter

        @F.arrow_udf(TREE)
        def of(texts: pa.Array) -> pa.Array:
            found = [leaves_of(x or "", counter()) for x in texts.to_pylist()]
            return _tree_array(found)

        return of.asNondeterministic()(text if isinstance(text, Column) else F.col(text))

    def edit(self, text: str | Column, tree: str | Column, edits: str | Column, with_text: bool = True) -> Column:
        """``struct<text, tree, n_tokens, encoded_chars>`` after the edits (``EDITS``), from the tree before.

        ``encoded_chars`` says how much was encoded for them. The edited text is null if not wanted.
        """
        counter = self._counter

        @F.arrow_udf(f"struct<text:string,tree:{TREE},n_tokens:long,encoded_chars:long>")
        def of(texts: pa.Array, trees: pa.Array, edits: pa.Array) -> pa.Array:
            out, leaves = [], []
            for x, tree, changes in zip(texts.to_pylist(), trees.to_pylist(), edits.to_pylist(), strict=True):
                x = x or ""
                fits = tree is not None and sum(tree["chars"]) == len(x)
                held = TokenTree(x, tree["chars"], tree["tokens"], counter()) if fits else TokenTree.build(x, counter())
                for change in changes or []:
                    if change is not None and change["start"] is not None and change["end"] is not None:
                        held.edit(change["start"], change["end"], change["text"] or "")
                leaves.append(held.leaves())
                out.append((held.text if with_text else None, held.total, held.encoded))
            kinds = (pa.string(), pa.int64(), pa.int64())
            columns = [pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)]
            return pa.StructArray.from_arrays(
                [columns[0], _tree_array(leaves), columns[1], columns[2]], ["text", "tree", "n_tokens", "encoded_chars"]
            )

        columns = [c if isinstance(c, Column) else F.col(c) for c in (text, tree, edits)]
        return of.asNondeterministic()(*columns)


def _tree_array(found: list[tuple[list[int], list[int]]]) -> pa.Array:
    columns = [pa.array([x[k] for x in found], pa.list_(pa.int32())) for k in range(2)]
    return pa.StructArray.from_arrays(columns, ["chars", "tokens"])


_PRIVATE = (
    ("<email>", regex.compile(r"[\w.+-]++@[\w-]++(?:\.[\w-]++)++")),
    ("<ip>", regex.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])")),
    ("<key>", regex.compile(r"\b[0-9a-f]{32,64}\b")),
    ("<number>", regex.compile(r"(?<!\w)\+?\d[\d ()-]{7,}\d\b")),
)


def redactions_of(text: str) -> list[tuple[int, int, str]]:
    """Edits that replace addresses, keys and long numbers by names; from the end, so positions stay valid."""
    found: list[tuple[int, int, str]] = []
    for name, pattern in _PRIVATE:
        if name == "<email>" and "@" not in text:
            continue
        found.extend((m.start(), m.end(), name) for m in pattern.finditer(text))
    found.sort()
    kept, upto = [], 0
    for start, end, name in found:
        if start >= upto:
            kept.append((start, end, name))
            upto = end
    return kept[::-1]


def redactions(text: str | Column) -> Column:
    """:func:`redactions_of` as a column of ``EDITS``."""

    @F.arrow_udf(EDITS)
    def of(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))
        return pa.array([[{"start": a, "end": b, "text": t} for a, b, t in redactions_of(x or "")] for x in texts.to_pylist()], kind)

    return of.asNondeterministic()(text if isinstance(text, Column) else F.col(text))
