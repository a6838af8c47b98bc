"""A byte-level BPE vocabulary, and texts cut into the pieces that are merged on their own."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from functools import lru_cache
from pathlib import Path

import public_tokenizers
import regex
from pyspark import Broadcast
from pyspark.sql import SparkSession

DEFAULT = public_tokenizers.path("byte_bpe_50k.json")


def shipped(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file as a broadcast: about 2 MB, whatever the input, and executors open no local file."""
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def printable_bytes() -> dict[str, int]:
    """The characters byte-level vocabularies write for bytes: printable ones stand for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Characters on whose class this module's pattern and the tokenizer library agree in any version; other texts
# are cut by the library.
UNSURE = re.compile("[^\x00-՗ -⁯₠-₿]")


class Vocabulary:
    """Merges by pair with rank and result, the id of every byte and the bytes of every id."""

    def __init__(self, data: bytes) -> None:
        parsed = json.loads(data)
        model, to_byte = parsed["model"], printable_bytes()
        self.data = data
        self.specials = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        ids = model["vocab"]
        self.bytes_of = {i: bytes(to_byte[c] for c in token) for token, i in ids.items() if token not in self.specials}
        self.id_of_byte = [0] * 256
        for token, i in ids.items():
            if len(token) == 1:
                self.id_of_byte[to_byte[token]] = i
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.merges[ids[a], ids[b]] = rank, ids[a + b]
        self._cut = None

    def pieces(self, text: str) -> list[str]:
        if UNSURE.search(text) is None:
            return PIECES.findall(text)
        if self._cut is None:
            from tokenizers import pre_tokenizers

            self._cut = pre_tokenizers.ByteLevel(add_prefix_space=False)
        return [text[a:b] for _, (a, b) in self._cut.pre_tokenize_str(text)]

    def stretches(self, text: str) -> list[str]:
        """Text between special tokens, the tokens themselves included at odd places."""
        if not any(s in text for s in self.specials):
            return [text]
        return re.split("(" + "|".join(map(re.escape, self.specials)) + ")", text)


@lru_cache(2)
def loaded(data: bytes) -> Vocabulary:
    return Vocabulary(data)


class _Words(dict):
    """Holders by word; one made for a new word waits in ``new`` to be filled."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> list | None:
        if word and not word[0].isspace() and not word[-1].isspace():
            holder: list | None = [None]
            self.new.append(word)
        else:
            holder = None  # its blanks may belong to a run that goes on in the next word
        self[word] = holder
        return holder


class Coder:
    """Values of texts put together from values of their pieces, each distinct piece of a batch solved once.

    Texts are cut at single spaces first: between two characters that are no blanks, a space always belongs
    to the piece after it, so the pieces of the text are those of its words. A text with a space beside
    another blank is cut into pieces directly. Words are remembered between batches, ``limit`` at most; a text
    with more distinct words than that still works, as only what stands between two batches is bounded.
    """

    def __init__(self, vocabulary: Vocabulary, solve: Callable[[list[str]], list], add: Callable[[list], object], special: Callable[[int], object], limit: int = 500_000) -> None:
        self.vocabulary, self.solve, self.add, self.special, self.limit = vocabulary, solve, add, special, limit
        self.inner, self.bare = _Words(), _Words()

    def code(self, texts: Iterable[str | None]) -> list[list]:
        """The values of the pieces or words of every text, in order."""
        if len(self.inner) + len(self.bare) > self.limit:
            self.inner, self.bare = _Words(), _Words()
        parts = [[(s, bool(i % 2)) for i, s in enumerate(self.vocabulary.stretches(t or ""))] for t in texts]
        held = [[s if special else self._holders(s) for s, special in p] for p in parts]
        self._fill()
        out, slow = [], []
        for row, part in zip(held, parts):
            values: list = []
            for holders, (stretch, special) in zip(row, part):
                if special:
                    values.append(self.special(self.vocabulary.specials[holders]))
                else:
                    try:
                        values += [h[0] for h in holders]
                    except TypeError:
                        slow.append((len(out), len(values), stretch))
            out.append(values)
        if slow:
            cuts = [self.vocabulary.pieces(stretch) for _, _, stretch in slow]
            solved = self._solved({p for pieces in cuts for p in pieces})
            for (row, at, _), pieces in reversed(list(zip(slow, cuts))):
                out[row][at:at] = [solved[p] for p in pieces]
        return out

    def _holders(self, stretch: str) -> list:
        if not stretch:
            return []
        first, *rest = stretch.split(" ")
        return [self.bare[first], *map(self.inner.__getitem__, rest)]

    def _solved(self, pieces: Iterable[str]) -> dict:
        pieces = sorted(pieces)
        return dict(zip(pieces, self.solve(pieces)))

    def _fill(self) -> None:
        todo = []
        for words, lead in ((self.inner, " "), (self.bare, "")):
            todo += [(words[w], self.vocabulary.pieces(lead + w)) for w in words.new]
            words.new = []
        solved = self._solved({p for _, pieces in todo for p in pieces})
        for holder, pieces in todo:
            holder[0] = solved[pieces[0]] if len(pieces) == 1 else self.add([solved[p] for p in pieces])
