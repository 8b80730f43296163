"""Byte-pair encoding and decoding with forced boundaries.

A merge can only join two bytes that stand side by side inside some token of the vocabulary.
Where two neighbouring bytes never do, every encoding has a cut.  Two kinds of such places are
used:

* a space after a character that is no white space.  The vocabulary is searched once for a pair
  of a space after a byte that ends no white space; where there is none, the text falls into
  fragments, one word with its leading space each, which are encoded on their own, once for all
  texts of a group.  (A byte that may end a white space character can also end a letter; there the
  pre-tokenizer, which starts a piece at the first space after a letter, makes the cut certain);
* inside one piece of the pre-tokenizer, any pair of bytes that no token holds.

The merge rules are then applied to all different fragments of a group of texts at once, as arrays;
a piece of more than 40 bytes goes to the merge model of the tokenizers library.  Fragments of Latin
letters, ASCII digits and signs are split at the changes between these three; the others are split
by the pattern of the pre-tokenizer and remembered.  The ids of a text are the concatenation of
those of its pieces.

Texts that are null count as empty.  A text of any length is held once, its ids next to it.

Empty texts have no ids.  Rows that repeat are encoded each on its own, there are no ties.  An empty table
gives an empty result.  Other columns, whatever their names, are passed by or dropped, never read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from ledgerloop.llm.common import process_state, read_table

#: Fixed: the pattern by which byte-level pre-tokenizers cut a text.
PIECES = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)

#: Bytes of texts that are encoded together, one text at least.
GROUP_BYTES = 4_000_000
#: Fragments split by the pattern lately whose ids a worker remembers, and as many split before;
#: about 160 bytes each.
REMEMBERED = 100_000

_FRAGMENT = re.compile(r"\s*\S+|\s+")
_SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace()]
_NO_KEY = np.uint64(2**64 - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a piece up to which merges are applied to many pieces at once.
_SHORT = 40
#: Bits for a place in such a piece, and the rank of a pair without a rule.
_PLACES = 6
_NO_RULE = (1 << 31 - _PLACES) - 1
#: Characters below this one are the same letters, digits and spaces in every Unicode version.
_LATIN_END = "ɐ"


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 bytes
    stand for themselves, the others, in order, for the letters from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


def _plain_kinds(openers: Iterable[str]) -> np.ndarray:
    """Of each byte: 1 in Latin letters, 2 in ASCII digits, 3 in ASCII signs, 0 in all else, among it the
    apostrophe and what tokens that are not merged open with."""
    kinds = np.zeros(256, dtype=np.uint8)
    kinds[33:127] = 3
    kinds[ord("0") : ord("9") + 1] = 2
    for a, z in ("AZ", "az"):
        kinds[ord(a) : ord(z) + 1] = 1
    # The letters from U+00C0 to U+017F: one of three first bytes, any second one.
    kinds[0xC3:0xC6] = 1
    kinds[0x80:0xC0] = 1
    kinds[ord("'")] = 0
    kinds[[first for opener in openers for first in opener.encode()[:1]]] = 0
    return kinds


class _Merges:
    """The merge rules as arrays, applied to many short runs of bytes at once.

    Runs of one size form a matrix, one run per column.  In each round the best pair of every run is
    merged, so that all that go on lose one row.  A rule that uses a merged token always comes after
    the rule that makes it, so rounds give the order of the rules.
    """

    _BITS = 18

    def __init__(self, vocabulary: dict[str, int], merges: list, letters: list[str]):
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        left = np.array([vocabulary[a] for a, _ in pairs], dtype=np.uint64)
        right = np.array([vocabulary[b] for _, b in pairs], dtype=np.uint64)
        self._made = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.uint32)
        self._of_byte = np.array([vocabulary.get(x, 0) for x in letters], dtype=np.uint32)
        while len(pairs) > 1 << self._BITS - 1:
            self._BITS += 1
        size = 1 << self._BITS
        # Open addressing: a rule lies at its slot or, if that is taken, behind it.
        self._keys = np.full(size + 1, _NO_KEY)
        self._ranks = np.full(size + 1, _NO_RULE, dtype=np.int32)
        keys = left << np.uint64(32) | right
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self._slots(keys).tolist())):
            while self._keys[slot] != _NO_KEY:
                slot = (slot + 1) % size
            self._keys[slot], self._ranks[slot] = key, rank
        of_byte = self._of_byte
        self._of_bytes = self._rank(np.repeat(of_byte, 256), np.tile(of_byte, 256))

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _ODD >> np.uint64(64 - self._BITS)).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of the rules for pairs of ids."""
        keys = left.astype(np.uint64) << np.uint64(32) | right
        at = self._slots(keys)
        there = self._keys[at]
        open_ = np.flatnonzero((there != keys) & (there != _NO_KEY))
        while len(open_):
            at[open_] = (at[open_] + 1) % (1 << self._BITS)
            there = self._keys[at[open_]]
            open_ = open_[(there != keys[open_]) & (there != _NO_KEY)]
        return self._ranks[at]

    def apply(
        self, data: np.ndarray, begin: np.ndarray, size: np.ndarray, out: np.ndarray
    ) -> np.ndarray:
        """Of runs of bytes, up to _SHORT each: writes the ids of a run to `out` from the place where
        the run begins, and returns their numbers."""
        count = np.zeros(len(begin), dtype=np.int64)
        order = np.argsort(size, kind="stable")
        sizes, first = np.unique(size[order], return_index=True)
        for width, runs in zip(sizes.tolist(), np.split(order, first[1:])):
            at = begin[runs]
            own = data[at + np.arange(width)[:, None]]
            ids = self._of_byte[own]
            pair = own[:-1].astype(np.int32) << 8 | own[1:]
            # Rank and place of each pair: the least is the first of the best.
            spots = np.arange(width - 1, dtype=np.int32)[:, None]
            pairs = self._of_bytes[pair] << _PLACES | spots
            while len(runs):
                least = np.minimum.reduce(pairs, axis=0, initial=_NO_RULE << _PLACES)
                over = least >> _PLACES == _NO_RULE
                if over.any():
                    out[at[over] + np.arange(width)[:, None]] = ids[:, over]
                    count[runs[over]] = width
                    on = ~over
                    runs, at, least = runs[on], at[on], least[on]
                    ids, pairs = ids[:, on], pairs[:, on]
                if len(runs):
                    ids, pairs = self._merged(ids, pairs, least)
                    width -= 1
        return count

    def _merged(self, ids: np.ndarray, pairs: np.ndarray, least: np.ndarray):
        """The matrices after the least pair of each column is merged."""
        spot = least & (1 << _PLACES) - 1
        later = np.arange(len(ids) - 1, dtype=np.int32)[:, None] > spot
        ids = np.where(later, ids[1:], ids[:-1])
        made = self._made[least >> _PLACES]
        column = np.arange(len(spot))
        ids[spot, column] = made
        pairs = np.where(later[:-1], pairs[1:] - 1, pairs[:-1])
        has = np.flatnonzero(spot > 0)
        before = spot[has] - 1
        pairs[before, has] = self._rank(ids[before, has], made[has]) << _PLACES | before
        has = np.flatnonzero(spot < len(ids) - 1)
        here = spot[has]
        pairs[here, has] = self._rank(made[has], ids[here + 1, has]) << _PLACES | here
        return ids, pairs


class Codec:
    """Encodes and decodes with one tokenizer definition of the tokenizers library."""

    def __init__(self, definition: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        spec = json.loads(definition)
        self._check(spec)
        tokenizer = Tokenizer.from_str(definition)
        self._model, self._pre_tokenizer = tokenizer.model, tokenizer.pre_tokenizer
        letters = byte_letters()
        self._to_letters = {b: letter for b, letter in enumerate(letters)}
        self._to_byte = to_byte = {letter: b for b, letter in enumerate(letters)}
        self._added = added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocabulary = spec["model"]["vocab"]
        self.size = max([*vocabulary.values(), *added.values()], default=-1) + 1
        self._bytes = [b""] * self.size
        for token, number in vocabulary.items():
            self._bytes[number] = bytes(to_byte[c] for c in token)
        for token, number in added.items():
            self._bytes[number] = token.encode()
        self._added_pattern = (
            re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
            if added
            else None
        )
        self._merges = _Merges(vocabulary, spec["model"]["merges"], letters)
        #: Whether two bytes stand side by side in any token; if not, there is always a cut.
        self.joined = np.zeros((256, 256), dtype=bool)
        for token in vocabulary:
            own = [to_byte[c] for c in token]
            self.joined[own[:-1], own[1:]] = True
        blanks = [c.encode()[-1] for c in _SPACES]
        self._cut_at_spaces = not np.delete(self.joined[:, 32], blanks).any() and not any(
            c.isspace() for token in added for c in token
        )
        self._kinds = _plain_kinds(token[:1] for token in added)
        self._most = remembered
        #: Ids of pieces with the space before them: those met lately, and those met before.
        self._after_space: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    @staticmethod
    def _check(spec: dict) -> None:
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if (
            model["type"] != "BPE"
            or spec["normalizer"]
            or pre.get("type") != "ByteLevel"
            or pre.get("add_prefix_space")
            or not pre.get("use_regex", True)
            or any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback"))
            or any(
                t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
                for t in spec["added_tokens"]
            )
        ):
            raise ValueError("forced boundaries are proven for plain byte-level BPE only")

    def _split(self, part: str) -> list[bytes]:
        """The pieces of the pre-tokenizer."""
        if max(part) < _LATIN_END:
            return [piece.encode() for piece in PIECES.findall(part)]
        found = self._pre_tokenizer.pre_tokenize_str(part)
        return [bytes(map(self._to_byte.__getitem__, letters)) for letters, _ in found]

    def fragment_ids(self, fragments: list[str]) -> list[bytes]:
        """The ids of each fragment, which is encoded on its own."""
        if self._added_pattern and self._added_pattern.search("\n".join(fragments)):
            return [self._with_added(fragment) for fragment in fragments]
        return self._plain_ids(fragments)

    def _with_added(self, fragment: str) -> bytes:
        parts = self._added_pattern.split(fragment)
        plain = self._plain_ids(parts[::2])
        added = [self._added[token].to_bytes(4, "little") for token in parts[1::2]] + [b""]
        return b"".join(ids for pair in zip(plain, added) for ids in pair)

    def _plain_ids(self, fragments: list[str]) -> list[bytes]:
        pieces: list[bytes] = []
        ends = [0]
        for fragment in fragments:
            if fragment:
                pieces += self._split(fragment)
            ends.append(len(pieces))
        sizes = np.cumsum([0, *map(len, pieces)])
        return self._ids_of_pieces(pieces, sizes[ends])

    def _ids_of_pieces(self, pieces: list[bytes], ends: np.ndarray) -> list[bytes]:
        """Of pieces one after the other, the ids of what lies between these bytes, which are ends
        of pieces."""
        if not pieces:
            return [b""] * (len(ends) - 1)
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        starts = np.zeros(len(data), dtype=bool)
        starts[np.cumsum([0, *map(len, pieces[:-1])])] = True
        ids, at = self._ids_between(data, starts, ends)
        packed = ids.tobytes()
        at = (4 * at).tolist()
        return [packed[a:b] for a, b in zip(at, at[1:])]

    def _ids_between(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Of bytes, with the places where pieces start: all ids, and how many of them lie before
        each of these bytes, which are ends of pieces."""
        starts[1:] |= ~self.joined[data[:-1], data[1:]]  # the forced boundaries
        begin = np.flatnonzero(starts)
        size = np.diff(begin, append=len(data))
        ids = np.zeros(len(data), dtype="<u4")  # of each run, from where it begins
        count = np.zeros(len(begin), dtype=np.int64)
        short = size <= _SHORT
        count[short] = self._merges.apply(data, begin[short], size[short], ids)
        for k in np.flatnonzero(~short).tolist():
            letters = bytes(data[begin[k] : begin[k] + size[k]]).decode("latin-1")
            tokens = self._model.tokenize(letters.translate(self._to_letters))
            ids[begin[k] : begin[k] + len(tokens)] = [token.id for token in tokens]
            count[k] = len(tokens)
        used = np.arange(len(data)) < np.repeat(begin + count, size)
        before = np.append(0, np.cumsum(count))
        return ids[used], before[np.searchsorted(begin, ends)]

    def _plain_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words are of plain bytes alone; the ids of these with the space before them, one
        after the other, and their numbers.

        Such a word has no white space, contraction or unmerged token, so that a piece starts
        wherever the kind of its bytes changes."""
        _, offsets, data = words.buffers()
        edges = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
        if edges[-1] == edges[0]:
            return np.zeros(len(words), dtype=bool), np.zeros(0, dtype="<u4"), edges[:0]
        data = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]]
        edges = edges - edges[0]
        kinds = self._kinds[data]
        # Two signs stand among the letters.
        sign = (data[1:] == 0x97) | (data[1:] == 0xB7)
        kinds[1:][sign & (data[:-1] == 0xC3)] = 0
        size = np.diff(edges)
        before = np.append(0, np.cumsum(kinds == 0, dtype=np.int64))
        plain = (before[edges[1:]] == before[edges[:-1]]) & (size > 0)
        size = size[plain]
        if not len(size):
            return plain, np.zeros(0, dtype="<u4"), size
        if len(size) < len(plain):
            own = np.repeat(plain, np.diff(edges))
            data, kinds = data[own], kinds[own]
        first = np.cumsum(size) - size
        spaced = np.insert(data, first, 32)
        kinds = np.insert(kinds, first, kinds[first])
        first = first + np.arange(len(first))
        starts = np.append(True, kinds[1:] != kinds[:-1])
        starts[first] = True
        ids, at = self._ids_between(spaced, starts, np.append(first, len(spaced)))
        return plain, ids, np.diff(at)

    def _learn(self, new: list[str]) -> None:
        """Remembers the ids of pieces with a space before them.  No ids: white space ends the piece,
        so that the cut behind it is uncertain."""
        older = self._older
        found = [older.get(w) for w in new]
        known = self._after_space
        known.update((w, x) for w, x in zip(new, found) if x is not None)
        new = [w for w, x in zip(new, found) if x is None]
        known.update(dict.fromkeys(new, b""))
        certain = [p for p in new if p and not p[-1].isspace()]
        if not certain:
            return
        text = " " + " ".join(certain)
        if max(text) >= _LATIN_END or (self._added_pattern and self._added_pattern.search(text)):
            plain = [p for p in certain if max(p) < _LATIN_END and "<" not in p]
            other = set(certain) - set(plain)
            known.update(zip(other, self.fragment_ids([" " + p for p in other])))
            certain, text = plain, " " + " ".join(plain)
        if certain:
            # The cuts between the pieces being certain, all are split by one search.
            pieces = list(map(str.encode, PIECES.findall(text)))
            sizes = [len(p) + 1 for p in map(str.encode, certain)]
            known.update(zip(certain, self._ids_of_pieces(pieces, np.cumsum([0, *sizes]))))

    def encode_array(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self._cut_at_spaces:
            return self.fragment_ids(texts.to_pylist())
        encoded: list[bytes] = []
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(texts):
            base = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, base + GROUP_BYTES, side="right")))
            encoded += self._encode_group(texts.slice(start, stop - start))
            start = stop
        return encoded

    def _encode_group(self, texts: pa.Array) -> list[bytes]:
        split = pc.split_pattern(texts, pattern=" ")
        offsets = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        index = np.array(coded.indices, dtype=np.int32)
        words = coded.dictionary
        plain, plain_ids, plain_length = self._plain_words(words)
        other = words.filter(pa.array(~plain)).to_pylist()
        known = self._after_space
        ids = list(map(known.get, other))
        new = [w for w, x in zip(other, ids) if x is None]
        if new:
            self._learn(new)
            ids = list(map(known.__getitem__, other))
            if len(known) > self._most:
                self._older, self._after_space = known, {}
        # The first piece of a text has no space before it: an entry of its own.
        first = offsets[:-1] - offsets[0]
        openers, opener = np.unique(index[first], return_inverse=True)
        opening = words.take(pa.array(openers)).to_pylist()
        empty = np.array([w == "" for w in opening], dtype=bool)[opener]
        opening = self.fragment_ids(opening)
        # Plain words come first, then the others, then those that open a text.
        place = np.empty(len(words), dtype=np.int32)
        place[plain] = np.arange(len(plain_length), dtype=np.int32)
        place[~plain] = np.arange(len(plain_length), len(words), dtype=np.int32)
        index = place[index]
        more = np.array(list(map(len, ids + opening)), dtype=np.int32) // 4
        length = np.append(plain_length.astype(np.int32), more)
        doubtful = length[index] == 0
        doubtful[first] &= ~empty
        in_text = np.add.reduceat(doubtful.astype(np.int32), first)
        index[first] = len(words) + opener
        begin = np.cumsum(length, dtype=np.int32) - length
        flat = np.append(plain_ids, np.frombuffer(b"".join(ids + opening), dtype="<u4"))
        n = length[index]
        ends = np.cumsum(n, dtype=np.int32)
        at = np.repeat(begin[index] - (ends - n), n) + np.arange(ends[-1], dtype=np.int32)
        out = flat[at].tobytes()
        edges = (4 * np.append(0, ends).astype(np.int64)[np.append(first, len(index))]).tolist()
        encoded = [out[a:b] for a, b in zip(edges, edges[1:])]
        # An uncertain cut: the text is only cut before runs of white space.
        for k in np.flatnonzero(in_text).tolist():
            encoded[k] = b"".join(self.fragment_ids(_FRAGMENT.findall(texts[k].as_py())))
        return encoded

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        return self.encode_array(pa.array(texts, pa.string()))

    def encode(self, text: str | None) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 are replaced."""
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        return b"".join(map(self._bytes.__getitem__, numbers)).decode("utf-8", "replace")


def read_definition(path: str) -> str:
    """A tokenizer file, read on the driver; a few megabytes, whatever the corpus."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def codec_of(definition: str) -> Codec:
    """The codec of a definition, built once in each worker process."""
    state = process_state("codecs")
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in state:
        state.clear()
        state[key] = Codec(definition)
    return state[key]


def encode_documents(
    docs: DataFrame, definition: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Encodes and decodes every whole text.

    Returns the id column (null ids stay null, repeated rows give repeated results), n_tokens,
    ids (array of int), ids_sha256 and decoded_sha256.  A null text counts as empty: no ids and
    the digests of no bytes.  Other columns of `docs`, whatever their names, take no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    source = docs.select(docs[id_column].alias("key"), docs[text_column].alias("text"))
    kind = source.schema["key"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for batch in batches:
            encoded = codec.encode_array(batch.column("text"))
            offsets = np.zeros(len(encoded) + 1, dtype=np.int32)
            np.cumsum([len(e) // 4 for e in encoded], out=offsets[1:])
            values = np.frombuffer(b"".join(encoded), dtype="<i4")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(np.diff(offsets).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                    pa.array([hashlib.sha256(e).hexdigest() for e in encoded]),
                    pa.array(
                        [hashlib.sha256(codec.decode(e).encode()).hexdigest() for e in encoded]
                    ),
                ],
                names=["key", "n_tokens", "ids", "ids_sha256", "decoded_sha256"],
            )

    return source.mapInArrow(
        run,
        f"key {kind}, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string",
    ).withColumnRenamed("key", id_column)


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """The definition in the file of this name among the public tokenizers."""
    import public_tokenizers

    return read_definition(public_tokenizers.path(name))


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = encode_documents(read_table(spark, folder, "documents"), vocabulary())
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The ids of every text, with the digests that show that they decode to it."""
    return encode_documents(docs, vocabulary())
