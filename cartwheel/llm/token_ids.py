"""Token ids of whole texts by the tokenizers library, a unit at a time.

A text is cut where the tokenizer's own pre-tokenizer always cuts, at blanks and
between Latin letters and ASCII punctuation, so the ids of the units in a row are the
ids of the text. Units met are given to the library once and kept in a bounded table
of two generations: when the young one is full it becomes the old one, and units that
are met again move up. A text that holds one of the tokenizer's added tokens goes to
the library whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

from .common import ship

ship(__name__)

# Fixed value: Unicode White_Space, as the pre-tokenizers' \s has it (regex escapes).
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
# Latin letters (but U+0130, whose lower case has a mark) with no other letter or digit after them.
_WORD = f"[{_LETTERS}]+(?=[{_WS}!-/:-@\\[-`{{-~]|\\Z)"
END_ID = 1


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet, for bytes read as Latin-1: printable bytes stand for
    themselves, the others for the letters from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


def describe(path: str) -> dict:
    """What tasks need of a tokenizer file (a vocabulary, so its size is bounded):
    its text, added tokens, and the kind of units its pre-tokenizer allows."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    conf = json.loads(text)
    lower = False
    if conf["normalizer"] is None and conf["pre_tokenizer"]["type"] == "ByteLevel" and not conf["pre_tokenizer"]["add_prefix_space"]:
        units = f" ?{_WORD}| ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
    elif conf["pre_tokenizer"]["type"] == "Sequence" and conf["model"]["end_of_word_suffix"] \
            and [n["type"] for n in conf["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]:
        units, lower = f"{_WORD}|[^{_WS}]+", True
    else:
        raise ValueError(f"no unit rule for the pre-tokenizer of {path}")
    size = len(conf["model"]["vocab"]) + len(conf["added_tokens"])
    return {"text": text, "added": [t["content"] for t in conf["added_tokens"]], "units": units, "lower": lower,
            "dtype": "<u2" if size <= 1 << 16 else "<u4"}


class UnitTable(dict):
    """unit -> ids; a unit that is missing comes from the older generation or is made."""

    LONG = 200              # longer units are not kept

    def __init__(self, make, old: dict):
        super().__init__()
        self.make, self.old = make, old

    def __missing__(self, unit: str) -> bytes:
        raw = self.old.get(unit)
        if raw is None:
            raw = self.make(unit)
        if len(unit) <= self.LONG:
            self[unit] = raw
        return raw


class UnitEncoder:
    GENERATION = 450_000

    def __init__(self, description: dict):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description["text"])
        self.model = self.tokenizer.model
        self.units = re.compile(description["units"]).findall
        self.one_word = re.compile(f" ?[{_LETTERS}]+").fullmatch
        self.lower = description["lower"]
        self.letters = byte_letters()
        self.blank = self.letters[32]
        self.added = description["added"]
        self.dtype = np.dtype(description["dtype"])
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]       # native order is little-endian on Spark's hosts
        self.end = np.array([END_ID], self.dtype).tobytes()
        self.table = UnitTable(self._make, {})

    def _make(self, unit: str) -> bytes:
        if not self.one_word(unit):
            return array(self.code, self.tokenizer.encode(unit, add_special_tokens=False).ids).tobytes()
        # one word: only the library's merge model is left to apply
        written = unit.lower() if self.lower else unit
        if written.isascii():
            written = written.replace(" ", self.blank)
        else:
            written = written.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(written)]).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text and the end id, as little-endian numbers of ``dtype``."""
        if len(self.table) > self.GENERATION:
            self.table = UnitTable(self._make, dict(self.table))
        get, units, out = self.table.__getitem__, self.units, []
        for text in texts:
            text = text or ""
            if any(a in text for a in self.added):
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                out.append(array(self.code, ids).tobytes() + self.end)
            else:
                out.append(b"".join(map(get, units(text))) + self.end)
        return out


def encoder(shared) -> UnitEncoder:
    """The worker's encoder, kept with the broadcast description."""
    kept = shared.value
    if "encoder" not in kept:
        kept["encoder"] = UnitEncoder(kept)
    return kept["encoder"]
