r"""Operator 11, byte-level BPE encoding and decoding by longest matches and backtracking.

Bytes are written as Latin-1 characters, so that one pyahocorasick trie of all tokens runs over any
bytes. For each place in a piece of text that is reached it gives the longest token there; a table
leads from a token to the next shorter one with the same start. A split of a piece is the one that
the merges make exactly when each of its tokens is what merging that token's bytes gives, and each
adjacent pair is what merging the pair's joined bytes gives. The second is seen by undoing the
pair's merges, last one first: it fails if at some time the two parts at the border would have
been joined before either was joined away from it. The answers are kept. From the piece's start,
the longest token that fits its left neighbour is taken; where none fits, the place is dead and
the last token taken gives way to a shorter one. What stands left of a place is the merges' own
split of these bytes, so it is one and the same whenever the place is reached; a place dies once
and each token at it is tried once. A token's length is bounded by the vocabulary, so time is
linear in the piece, whatever it holds (merging it directly takes the square of its length).
Short pieces that are not known take these steps together, as arrays (``Batch``); long ones one by one.

Pieces are the matches of a pattern. The regex module and the tiktoken library know different
Unicode versions. ``library_pattern`` asks the library which code points it counts to ``\p{L}`` and
``\p{N}``; text with one on which the two differ is cut by a pattern with narrowed classes. A space
before a character that is no white space always starts a piece, so texts are first cut there.

``encode`` and ``decode`` are columns in, columns out; the digests of the query come from them.

Scale: no shuffle. The vocabulary is broadcast with the two tokens that each is merged from, so that
a worker need not merge them again (its size is the file's). A worker keeps the ids of short strings,
in two generations of at most ``MEMO`` each, of which the older is dropped when the newer is full,
and the answers for at most ``PAIRS`` pairs and for ``SLOTS`` in arrays; this changes speed only. Strings
that are put together from kept ones (a word and a mark, two words around a line break) are not kept
themselves. Each different string of some ``TOGETHER`` characters of texts is looked up once. A piece
takes some ten bytes of memory a byte while it is split alone and some 200 with others, a text's ids
four bytes each.

Defined cases: null text counts as empty (no ids); null ids decode to no bytes; ids outside of
the vocabulary are an error; strings of special tokens inside texts are ordinary text; repeated
rows each keep their row; other columns pass through ``encode`` and ``decode`` unless they bear
the name of the column made, which is replaced; an empty table gives an empty result. A text is
worked on whole, however long; its ids and its bytes must fit into one Arrow value (2 GiB).
"""

from __future__ import annotations

import base64
import re
import sys
from array import array
from collections.abc import Iterator
from itertools import chain, compress, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, ship, slices

ship(__name__)

MEMO = 55_000      # strings, of some 200 bytes each; a worker has four such tables
PAIRS = 200_000    # pairs, of some 100 bytes each; one table
SLOTS = 1 << 19    # pairs' answers in arrays, of nine bytes each
SHORT = 64         # characters of a string whose ids are kept; bytes of a piece that is split with others
FEW = 40           # pieces that are not worth arrays
BLOCK = 1 << 20    # characters of a text that are cut into pieces at a time
TOGETHER = 1 << 19     # characters of texts whose strings are looked up together
_CUT = re.compile(r" (?=\S)")
_WIDE = re.compile(r" \s")
_MARKS = frozenset(",.;:!?)")     # neither letters, numbers nor white space, and in no contraction


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank, from lines of a base64 token and its rank."""
    with open(path, "rb") as f:
        ranks = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in f if line.strip())}
    tokens = [ranks.get(i, b"") for i in range(max(ranks) + 1)]
    missing = set(range(256)) - {t[0] for t in tokens if len(t) == 1}
    if missing or len(set(tokens)) < len(tokens):
        raise ValueError(f"ranks need every byte, no gaps and no repeats; bytes missing: {sorted(missing)[:5]}")
    return tokens


def library_pattern(pattern: str) -> tuple[str, str, set[str]]:
    """``pattern``, the same with letters and numbers as the tiktoken library has them, and the
    characters on which the two differ. For the regex module, version 1."""
    import regex
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    single = {bytes([i]): i for i in range(256)}
    narrow, odd = pattern, set()
    for kind in (r"\p{L}", r"\p{N}"):
        library = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=single, special_tokens={})
        other = sorted(map(ord, set(regex.findall(kind, every)) - set(bytes(library.encode_ordinary(every)).decode())))
        first = [c for c, before in zip(other, [None, *other]) if before != c - 1]
        last = [c for c, after in zip(other, [*other[1:], None]) if after != c + 1]
        if other:
            ranges = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first, last))
            narrow = narrow.replace(kind, f"[{kind}--[{ranges}]]")
            odd.update(map(chr, other))
    return pattern, narrow, odd


def _one_word(string: str) -> bool:
    return string[-1:] not in _MARKS and "\n" not in string


class _Known(dict):
    """``known[string]`` makes the ids, as bytes, and keeps those of short strings worth ``keeping``."""

    def __init__(self, make, keeping=lambda string: True):
        super().__init__()
        self.make, self.keeping, self.older = make, keeping, {}

    def __missing__(self, string: str) -> bytes:
        ids = self.older.get(string)
        if ids is None:
            ids = self.make(string)
        self.keep({string: ids})
        return ids

    def keep(self, made: dict[str, bytes]) -> None:
        kept = [string for string in made if len(string) <= SHORT and self.keeping(string)]
        while kept:
            if len(self) >= MEMO:
                self.older = dict(self)
                self.clear()
            now, kept = kept[:MEMO - len(self)], kept[MEMO - len(self):]
            self.update(zip(now, map(made.__getitem__, now)))

    def table(self, strings: dict[str, None], make_all) -> dict[str, bytes]:
        """The ids of each of ``strings``; ``make_all`` gives those of the ones that are not kept."""
        table = dict(zip(strings, map(self.get, strings)))
        missing = [string for string, ids in table.items() if ids is None]
        older = dict(zip(missing, map(self.older.get, missing)))
        made = make_all([string for string, ids in older.items() if ids is None])
        older.update(made)
        self.keep(older)
        table.update(older)
        return table


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    """Places of whole numbers in a table of 2 ** ``bits``."""
    return ((keys.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype("int64")


class Batch:
    """``Codec.split`` for many short pieces, a step of all of them at a time.

    The trie is a hash table from a node and the next byte to the next node, with linear probing; 256
    stands for the end of a piece and leads nowhere."""

    def __init__(self, codec: Codec):
        self.codec, self.size, self.shorter = codec, np.array(codec.size), np.array(codec.shorter)
        node = {prefix: i for i, prefix in enumerate(codec.best)}
        self.longest = np.array(list(codec.best.values()))
        self.bits = max(8, (4 * len(node)).bit_length())
        self.keys, self.to = np.full(1 << self.bits, -1), np.full(1 << self.bits, -1, "int32")
        keys = np.array([node[prefix[:-1]] * 257 + ord(prefix[-1]) for prefix in node if len(prefix) > 1], "int64")
        to = np.array([i for prefix, i in node.items() if len(prefix) > 1], "int64")
        slots = _slots(keys, self.bits)
        while len(keys):
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[free]
            won = self.keys[slots] == keys
            self.to[slots[won]] = to[won]
            keys, to, slots = keys[~won], to[~won], (slots[~won] + 1) % len(self.keys)
        self.first = np.array([node[chr(byte)] for byte in range(256)])
        self.second = self.child(np.repeat(self.first, 257), np.tile(np.arange(257), 256))      # node after two bytes
        self.pairs, self.answers = np.full(SLOTS, -1), np.zeros(SLOTS, bool)

    def child(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The next nodes; -1 where there is none."""
        keys = nodes * 257 + letters
        slots = _slots(keys, self.bits)
        found = self.keys[slots]
        out = np.where(found == keys, self.to[slots], -1).astype("int64")
        rest = np.flatnonzero((found != keys) & (found >= 0))
        while len(rest):
            slots[rest] = (slots[rest] + 1) % len(self.keys)
            found = self.keys[slots[rest]]
            same = found == keys[rest]
            out[rest[same]] = self.to[slots[rest[same]]]
            rest = rest[~same & (found >= 0)]
        return out

    def fits(self, pairs: np.ndarray) -> np.ndarray:
        slots = _slots(pairs, SLOTS.bit_length() - 1)
        out = self.answers[slots]
        unknown = np.flatnonzero(self.pairs[slots] != pairs)
        if len(unknown):
            some, where = np.unique(pairs[unknown], return_inverse=True)
            answers = np.fromiter(map(self.codec._fits, some.tolist()), bool, len(some))
            out[unknown] = answers[where]
            # of pairs that share a slot one is written, in both tables
            slots, one = np.unique(_slots(some, SLOTS.bit_length() - 1), return_index=True)
            self.pairs[slots], self.answers[slots] = some[one], answers[one]
        return out

    def longest_at(self, letters: np.ndarray) -> np.ndarray:
        """The longest token at each place; at the end of a piece -1."""
        at = np.flatnonzero(letters < 256)
        out = np.full(len(letters), -1)
        out[at] = self.longest[self.first[letters[at]]]
        node, far = self.second[letters[at] * 257 + letters[at + 1]], 2
        while True:
            on = node >= 0
            at, node = at[on], node[on]
            if not len(at):
                return out
            out[at] = self.longest[node]
            node = self.child(node, letters[at + far])
            far += 1

    def split(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pieces of at least one byte, as bytes."""
        size, shorter, n_tokens = self.size, self.shorter, len(self.codec.tokens)
        ends = np.cumsum([len(piece) + 1 for piece in pieces]) - 1
        letters = np.frombuffer(b"\0".join(pieces) + b"\0", "uint8").astype("int64")
        letters[ends] = 256
        starts = np.concatenate([[0], ends[:-1] + 1])
        best = self.longest_at(letters)
        stack, stops = np.zeros(len(letters), "int32"), starts.copy()       # a piece's tokens stand from its start on
        dead = np.zeros(len(letters), bool)
        piece, first, at, top = np.arange(len(pieces)), starts, starts.copy(), starts.copy()
        token, last = best[at], np.full(len(pieces), -1)
        while len(piece) > FEW:
            out = np.flatnonzero(token < 0)
            if len(out):        # the place is dead
                dead[at[out]] = True
                top[out] -= 1
                gone = stack[top[out]]
                at[out] -= size[gone]
                last[out] = np.where(top[out] > first[out], stack[top[out] - 1], -1)
                token[out] = shorter[gone]
            on = np.flatnonzero(token >= 0)
            to = at[on] + size[token[on]]
            good = ~dead[to]
            ask = np.flatnonzero(good & (last[on] >= 0))
            good[ask] = self.fits(last[on[ask]] * n_tokens + token[on[ask]])
            bad, on, to = on[~good], on[good], to[good]
            token[bad] = shorter[token[bad]]
            last[on] = stack[top[on]] = token[on]
            top[on] += 1
            at[on] = to
            token[on] = best[to]
            over = letters[at] == 256
            if over.any():
                stops[piece[over]] = top[over]
                piece, first, at, top, token, last = (x[~over] for x in (piece, first, at, top, token, last))
        ids = stack.tobytes()
        made = [ids[a:b] for a, b in zip((starts * 4).tolist(), (stops * 4).tolist())]
        for i in piece.tolist():
            made[i] = self.codec.split(pieces[i]).tobytes()
        return made


class Codec:
    """Splits and joins by a list of tokens whose index is the id and the merge rank."""

    def __init__(self, tokens: list[bytes], pattern: tuple[str, str, set[str]], halves: list[tuple[int, ...] | None] | None = None):
        import ahocorasick
        import regex

        self.tokens, self.rank = tokens, {t: i for i, t in enumerate(tokens)}
        self.pieces, self.narrow, self.odd = *(regex.compile(p, regex.V1) for p in pattern[:2]), frozenset(pattern[2])
        self.size = [len(t) for t in tokens]
        #: the two tokens that a token is merged from; () for a byte; None if merging doesn't make it (only a whole piece can be it)
        self.halves = self.merged_from() if halves is None else halves
        self.trie, self.most = ahocorasick.Automaton(), max(self.size)
        whole = {t.decode("latin-1"): i for i, t in enumerate(tokens) if self.halves[i] is not None}
        #: node of the trie, as its letters -> the longest token on the way to it
        self.best: dict[str, int] = {}
        for t in whole:
            self.trie.add_word(t, whole[t])
            for k in range(1, len(t) + 1):
                if t[:k] not in self.best:
                    self.best[t[:k]] = whole.get(t[:k], self.best.get(t[:k - 1], -1))
        self.trie.make_automaton()
        self.shorter = [self.best.get(t[:-1].decode("latin-1"), -1) for t in tokens]
        self.fits = Memo(self._fits, PAIRS)
        self.known = _Known(lambda piece: self.split(piece.encode()).tobytes())
        self.after_space = _Known(self._after_space, _one_word)
        self.batch: Batch | None = None

    def merge(self, word: bytes, below: int | None = None) -> list[bytes]:
        """Join the adjacent pair of lowest rank, leftmost first, as long as one has a rank (``below`` the given one)."""
        parts = [word[i:i + 1] for i in range(len(word))]
        end = len(self.tokens) if below is None else below
        while len(parts) > 1:
            rank, i = min((self.rank.get(a + b, end), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= end:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def merged_from(self) -> list[tuple[int, ...] | None]:
        halves: list[tuple[int, ...] | None] = []
        for i, t in enumerate(self.tokens):
            parts = tuple(self.rank[p] for p in self.merge(t, i))
            halves.append(() if len(t) == 1 else parts if len(parts) == 2 else None)
            if len(parts) == 2 and any(len(self.tokens[p]) > 1 and p > i for p in parts):
                raise ValueError(f"token {i} is merged from later ones")
        return halves

    def _fits(self, pair: int) -> bool:
        """Whether merging the joined bytes of two tokens, as one number, gives the two back."""
        tokens, halves, never = self.tokens, self.halves, len(self.tokens)
        (left, right), left_goes, right_goes = divmod(pair, never), never, never    # when each is joined away from the border
        while True:
            joined = self.rank.get(tokens[left] + tokens[right], never)
            if joined < left_goes and joined <= right_goes and joined < never:
                return False
            if halves[left] and not (halves[right] and right >= left):
                left, left_goes = halves[left][1], left
            elif halves[right]:
                right, right_goes = halves[right][0], right
            else:
                return True

    def split(self, piece: bytes) -> array:
        """The ids of one piece."""
        whole = self.rank.get(piece)
        if whole is not None:
            return array("i", [whole])
        fits, n_tokens, letters = self.fits, len(self.tokens), piece.decode("latin-1")
        out = [token for _, token in self.trie.iter_long(letters)]     # longest after longest
        last = out[0]
        for good in range(1, len(out)):
            if not fits[last * n_tokens + out[good]]:
                break
            last = out[good]
        else:
            return array("i", out)
        size, shorter, best, reach, most, n = self.size, self.shorter, self.best, self.trie.longest_prefix, self.most, len(piece)
        token, new, out = shorter[out[good]], False, out[:good]
        dead, at = bytearray(n + 1), sum([size[t] for t in out])
        while at < n:
            if new:     # the longest token here
                token, new = best[letters[at:at + reach(letters[at:at + most])]], False
            if token < 0:
                dead[at] = 1
                token = out.pop()
                at -= size[token]
                last = out[-1] if out else -1
                token = shorter[token]
            elif not dead[at + size[token]] and (last < 0 or fits[last * n_tokens + token]):
                out.append(token)
                at += size[token]
                last, new = token, True
            else:
                token = shorter[token]
        return array("i", out)

    def _pieces(self, text: str):
        """The pattern that cuts the text as the library does."""
        return self.pieces if text.isascii() or self.odd.isdisjoint(text) else self.narrow

    def _cut(self, text: str) -> bytes:
        """The ids of a text by its pieces."""
        known, pieces = self.known.__getitem__, self._pieces(text)
        if len(text) <= BLOCK:
            return b"".join(map(known, pieces.findall(text)))
        found, blocks = (m[0] for m in pieces.finditer(text)), []
        while block := b"".join(map(known, islice(found, BLOCK))):
            blocks.append(block)
        return b"".join(blocks)

    def _after_space(self, rest: str) -> bytes:
        """The ids of a space and ``rest``, which has no other space before a character."""
        if rest.isalpha():      # one piece
            return self.split((" " + rest).encode()).tobytes()
        word, mark = rest[:-1], rest[-1:]
        if mark in _MARKS and word.isalpha():      # the mark is a piece of its own
            return self.after_space[word] + self.known[mark]
        return self._cut(" " + rest)

    def split_all(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of each of some pieces, as bytes."""
        coded = [piece.encode() for piece in pieces]
        short = [len(piece) <= SHORT and piece not in self.rank for piece in coded]
        alone = coded if sum(short) <= FEW else [piece for piece, with_others in zip(coded, short) if not with_others]
        if len(alone) == len(coded):
            return dict(zip(pieces, [self.split(piece).tobytes() for piece in coded]))
        if self.batch is None:
            self.batch = Batch(self)
        together = self.batch.split(list(compress(coded, short)))
        if not alone:
            return dict(zip(pieces, together))
        made = dict(zip(compress(pieces, short), together))
        made.update((piece.decode(), self.split(piece).tobytes()) for piece in alone)
        return made

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """The ids of a space and each word of letters."""
        pieces = [" " + word for word in words]
        return dict(zip(words, map(self.split_all(pieces).__getitem__, pieces)))

    def _all_after_space(self, strings: list[str]) -> dict[str, bytes]:
        """``_after_space`` of each."""
        made = self._words([rest for rest in strings if rest.isalpha()])
        others = [rest for rest in strings if rest not in made]
        marked = [rest for rest in others if rest[-1:] in _MARKS and rest[:-1].isalpha()]
        new = [word for word in dict.fromkeys([rest[:-1] for rest in marked]) if word not in made]
        words = self.after_space.table(dict.fromkeys(new), self._words)
        for rest in marked:
            made[rest] = (made.get(rest[:-1]) or words[rest[:-1]]) + self.known[rest[-1]]
        cut = {rest: self._pieces(" " + rest).findall(" " + rest) for rest in others if rest not in made and len(rest) < BLOCK}
        ids = self.known.table(dict.fromkeys(chain.from_iterable(cut.values())), self.split_all).__getitem__
        for rest in others:
            if rest not in made:
                made[rest] = b"".join(map(ids, cut[rest])) if rest in cut else self._cut(" " + rest)
        return made

    def _parts(self, text: str) -> Iterator[tuple[str | None, list[str]]]:
        """The text's beginning, if it is in this part, and strings behind a space each."""
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > BLOCK and (cut := _CUT.search(text, at + BLOCK)):
                end = cut.start()
            part = text[at:end]
            first, *rest = _CUT.split(part) if _WIDE.search(part) else part.split(" ")
            yield (first, rest) if at == 0 else (None, [first, *rest])
            at = end + 1

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        blocks: list[list[bytes]] = [[] for _ in texts]
        waiting, size = [], 0

        def finish():
            found = dict.fromkeys(chain.from_iterable(rest for _, rest in waiting))
            ids = self.after_space.table(found, self._all_after_space).__getitem__
            for i, rest in waiting:
                blocks[i].append(b"".join(map(ids, rest)))

        for i, text in enumerate(texts):
            for first, rest in self._parts(text):
                if first is not None:
                    blocks[i].append(self._cut(first))
                waiting.append((i, rest))
                size += sum(map(len, rest)) + len(rest)
                if size >= TOGETHER:
                    finish()
                    waiting, size = [], 0
        finish()
        return [np.frombuffer(b"".join(b), "int32") for b in blocks]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


def join(tokens: list[bytes], ids: list[int]) -> bytes:
    """The bytes that ids stand for."""
    if ids and min(ids) < 0:
        raise ValueError(f"no such id: {min(ids)}")
    return b"".join(map(tokens.__getitem__, ids))


def join_all(vocabulary: pa.Array, ids: pa.Array, ends: np.ndarray) -> pa.Array:
    """The bytes of the ids between each two of ``ends``, of which the first is 0; a slice of rows at once."""
    if len(ids) and ids.to_numpy().min() < 0:
        raise ValueError(f"no such id: {ids.to_numpy().min()}")
    found = vocabulary.take(ids)
    _, offsets, values = found.buffers()
    ends = np.frombuffer(offsets, "int32")[found.offset + ends] if len(ids) else np.zeros(len(ends), "int32")
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype("int32").tobytes()), values])


def _vocabulary(shared) -> pa.Array:
    """The tokens as an array, kept with the broadcast."""
    kept = shared.value
    if "vocabulary" not in kept:
        kept["vocabulary"] = pa.array(kept["tokens"], pa.binary())
    return kept["vocabulary"]


def _codec(shared) -> Codec:
    """The worker's codec, kept with the broadcast."""
    kept = shared.value
    if "codec" not in kept:
        kept["codec"] = Codec(kept["tokens"], kept["pattern"], kept["halves"])
    return kept["codec"]


def _mapped(df: DataFrame, source, name: str, kind: str, make) -> DataFrame:
    """``df`` with the column ``name`` of Spark type ``kind``, which ``make`` computes from the
    expression ``source``, a slice of rows at a time. ``source`` is put last for the way through Python."""
    from pyspark.sql.types import StructField, StructType

    df = df.withColumn(name, source)
    at = [c.lower() for c in df.columns].index(name.lower())
    made = StructField(df.columns[at], StructType.fromDDL(f"x {kind}")[0].dataType)

    def run(batches):
        for part in slices(batches, 500):
            columns = list(part.columns)
            columns[at] = make(columns[at])
            yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return df.mapInArrow(run, StructType([*df.schema.fields[:at], made, *df.schema.fields[at + 1:]]))


def share(spark, tokens: list[bytes], pattern: str):
    """The vocabulary and pattern for ``encode`` and ``decode``; bounded by the vocabulary file."""
    known = library_pattern(pattern)
    return spark.sparkContext.broadcast({"tokens": tokens, "pattern": known, "halves": Codec(tokens, known).halves})


def encode(docs: DataFrame, shared, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the column ``ids`` (array<int>) of the texts' token ids."""
    def make(texts):
        codec = _codec(shared)
        coded = codec.encode_all([t or "" for t in texts.to_pylist()])
        ends = np.cumsum([0, *map(len, coded)]).astype("int32")
        values = np.concatenate([np.empty(0, "int32"), *coded])
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))

    return _mapped(docs, F.col(f"`{text}`"), ids, "array<int>", make)


def decode(coded: DataFrame, shared, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``coded`` with the column ``decoded`` (binary) of the bytes that the ids stand for."""
    def make(lists):
        ids, lengths = lists.flatten(), np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False))
        return join_all(_vocabulary(shared), ids, np.cumsum([0, *lengths]).astype("int64"))

    return _mapped(coded, F.col(f"`{ids}`"), decoded, "binary", make)


def digests(docs: DataFrame, tokens: list[bytes], pattern: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256 (of the ids decoded again)."""
    shared = share(docs.sparkSession, tokens, pattern)
    both = decode(encode(docs.select("doc_id", "text"), shared, ids="ids").select("doc_id", "ids"), shared)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
