"""Token ids of whole texts, by the tokenizers library.

A tokenizer that splits text before merging gives a word the same ids wherever it stands. So
each worker encodes a word once and keeps its ids; a word of printable ASCII and Latin letters is
put together from the pieces (letters, digits, punctuation) that the tokenizer would cut it into, of
which there are far fewer, and only the vocabulary's merges are asked for a piece. Texts whose white space could make a split depend on its surroundings, and those
with the name of a special token, are encoded as a whole. All ways give the same ids.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array
from itertools import islice

import numpy as np

KEPT_WORDS = 700_000  # a worker forgets the later half of its words when it has so many
_JOINED = 4_000  # new words encoded at once

# How the two kinds of vocabularies cut, as their files state it, and the same for
# printable ASCII and Latin letters that are one code point in either case, composed or not.
_LETTERS_FIRST = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_LATIN = "À-ÖØ-öø-įĲ-ňŊ-ž"
_LOWER_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^a-z0-9{_LATIN}]+")
_BYTE_PIECES = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z{_LATIN}]+| ?[0-9]+| ?[^ A-Za-z0-9{_LATIN}]+"
)
_PRINTABLE = re.compile(f" ?[!-~{_LATIN}]+")

# A byte-level vocabulary writes a visible byte as the character of that number, and the others, in
# order, as the characters from 256 on.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_NAMES = dict(
    zip(sorted(set(range(256)) - set(_VISIBLE)), map(chr, range(256, 512)), strict=False)
)

# White space other than space and line feed, in any common reading of the term.
_RARE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")


class Encoder:
    """Ids of texts as the bytes of little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        # names without "<" would need a look at every text
        names = [t["content"].lower() for t in kind.get("added_tokens", [])]
        self.special = [n for n in names if "<" in n]
        odd = len(self.special) < len(names)
        before = kind.get("pre_tokenizer") or {}
        plain = kind.get("normalizer") is None and not odd
        # ids of words, and of pieces, which have the same ids where they are a whole word
        self.words: dict[str, bytes] = {}
        self.split = self.pieces = None
        self.lower = False
        if plain and before.get("type") == "ByteLevel" and before.get("use_regex"):
            if not before.get("add_prefix_space"):  # a word takes the space before it along
                self.split, self.glue, self.spaced = re.compile("\n| ?[^ \n]+"), "\n", True
                self.pieces = _BYTE_PIECES
        elif not odd and (kind.get("normalizer") or {}).get("type") == "Sequence" and any(
            n.get("pattern") == {"Regex": "\\s+"} for n in kind["normalizer"]["normalizers"]
        ):  # white space only separates
            if [p.get("behavior") for p in before.get("pretokenizers", [])][:1] == ["Removed"]:
                self.split, self.glue, self.spaced = re.compile("[^ \n]+"), " \x01 ", False
                if before["pretokenizers"][0].get("pattern") == {"Regex": _LETTERS_FIRST}:
                    self.pieces, self.lower = _LOWER_PIECES, True
        if self.split is not None:
            mark = self._whole(self.glue)
            self.mark = int(mark[0]) if len(mark) == 1 else None
            if self.spaced:
                self.words["\n"] = mark.tobytes()

    def _whole(self, text: str) -> np.ndarray:
        made = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(made[0].ids, dtype="<u4")

    def _piece(self, piece: str) -> bytes:
        """Ids of what the tokenizer's split would hand to the merges."""
        if piece.isascii():  # the space is the only byte of a piece that has another name
            name = piece.replace(" ", _BYTE_NAMES[32])
        else:
            name = piece.encode().decode("latin-1").translate(_BYTE_NAMES)
        return array("I", [t.id for t in self.model.tokenize(name)]).tobytes()

    def _learn(self, new: list[str], forget: bool = True) -> None:
        if forget and len(self.words) + len(new) > KEPT_WORDS:
            # frequent words are met early: the first ones stay
            self.words = dict(islice(self.words.items(), max(1, KEPT_WORDS // 2)))
        whole, cut = [], []
        for word in new:
            if self.pieces is not None and _PRINTABLE.fullmatch(word):
                cut.append((word, self.pieces.findall(word.lower() if self.lower else word)))
            else:
                whole.append(word)
        known = self.words
        fresh = list(dict.fromkeys(p for _, pieces in cut for p in pieces if p not in known))
        known.update((p, self._piece(p)) for p in fresh)
        for word, pieces in cut:
            known[word] = b"".join([known[p] for p in pieces])
        self.words.update(zip(whole, self._encode_many(whole), strict=True))

    def _encode_many(self, new: list[str]) -> list[bytes]:
        """Ids of words, many encoded at once with a mark between them."""
        sep = self.glue.strip(" ")
        made: list[bytes] = []
        for at in range(0, len(new), _JOINED):
            some = new[at : at + _JOINED]
            joined = None
            if self.mark is not None and not any(sep in w for w in some):
                ids = self._whole(self.glue.join(some))
                cuts = np.flatnonzero(ids == self.mark)
                if len(cuts) == len(some) - 1:
                    raw, ends = ids.tobytes(), (cuts * 4).tolist()
                    starts = [0, *(e + 4 for e in ends)]
                    joined = [raw[a:b] for a, b in zip(starts, [*ends, len(raw)], strict=True)]
            made.extend(joined or [self._whole(w).tobytes() for w in some])
        return made

    def _alone(self, text: str) -> bool:
        """Whether the words of `text` can't be encoded one by one."""
        if self.split is None:
            return True
        if "<" in text and any(name in text.lower() for name in self.special):
            return True
        if not self.spaced:
            return False
        return (
            "  " in text
            or " \n" in text
            or "\n " in text
            or "\n\n" in text
            or text[-1:] in (" ", "\n")
            or text[:1] in (" ", "\n")
            or _RARE.search(text) is not None
        )

    def encode(self, text: str) -> bytes:
        if self._alone(text):
            return self._whole(text).tobytes()
        found = self.split.findall(text)
        try:
            return b"".join(map(self.words.__getitem__, found))
        except KeyError:
            known = self.words
            self._learn([w for w in dict.fromkeys(found) if w not in known])
            if self.words is not known:  # forgotten meanwhile
                self._learn([w for w in dict.fromkeys(found) if w not in self.words], forget=False)
            return b"".join(map(self.words.__getitem__, found))

    def encode_batch(self, some: list[str]) -> list[bytes]:
        """As `encode`; new words of all texts are learned together.

        The many short lists made here hold no cycles, so the collector needn't walk them.
        """
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._encode_batch(some)
        finally:
            if collects:
                gc.enable()

    def _encode_batch(self, some: list[str]) -> list[bytes]:
        split = [None if self._alone(t) else self.split.findall(t) for t in some]
        known = self.words
        new: set[str] = set()
        for words in split:
            if words:
                new |= set(words).difference(known)
        if new:
            self._learn(list(new))
        whole = self.words is known
        return [
            self._whole(t).tobytes()
            if w is None
            else b"".join(map(self.words.__getitem__, w))
            if whole
            else self.encode(t)
            for t, w in zip(some, split, strict=True)
        ]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder of a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
