"""Token ids of whole texts by a public tokenizer, word by word where that gives the same ids."""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Characters on which normalization, lower-casing and splitting are the same for the tokenizer and here, and whose lower case has two
#: bytes at most.
PLAIN = "^[\\t\\n\\r -~\u00a1-\u012f\u0131-\u0239\u023b-\u023d\u023f-\u024f]*$"
#: Among these, numbers and what is neither a letter nor a number nor white space.
NUMBERS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
MARKS = "!-/:-@\\[-`{-~\u00a1-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u00d7\u00f7"
SPACE, LETTER, NUMBER, MARK = range(4)


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand for themselves, the others follow
    from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()


def _kind(char: str) -> int:
    return SPACE if char in "\t\n\r " else NUMBER if re.match(f"[{NUMBERS}]", char) else MARK if re.match(f"[{MARKS}]", char) else LETTER


#: The kinds of ASCII characters; all bytes of others count as letters at first.
KINDS = np.array([_kind(chr(b)) if b < 0x80 else LETTER for b in range(256)], np.uint8)
#: Those of U+0080 to U+00FF, which begin with the bytes C2 and C3; from U+0100 on, PLAIN has letters only.
LATIN_KINDS = np.array([_kind(chr(c)) for c in range(0x80, 0x100)], np.uint8)


def strings(kind: pa.DataType, ends: np.ndarray, data: np.ndarray) -> pa.Array:
    """The array of strings (or bytes) that end at these places of data."""
    offsets = np.zeros(len(ends) + 1, np.int32)
    offsets[1:] = ends
    return pa.Array.from_buffers(kind, len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def places(of: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where strings begin, and the last ends, in their bytes; and these bytes."""
    _, offsets, data = of.buffers()
    at = np.frombuffer(offsets, np.int32)[of.offset : of.offset + len(of) + 1] if len(of) else np.zeros(1, np.int32)
    return at - at[0], np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]]


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of PLAIN texts in lower case, as the pattern
    's|'t|'re|'ve|'m|'ll|'d|[letters]+|[number]|[what is neither, nor white space]+
    finds them, and how many are before each text and in all."""
    at, raw = places(texts)
    if not len(raw):
        return pa.array([], pa.string()), np.zeros(len(texts) + 1, np.int64)
    kinds = KINDS[raw]
    two = np.flatnonzero((raw == 0xC2) | (raw == 0xC3))
    kinds[two] = kinds[two + 1] = LATIN_KINDS[(raw[two] - 0xC2) * 64 + (raw[two + 1] & 0x3F)]
    begins = np.concatenate([[True], kinds[1:] != kinds[:-1]])
    begins |= (kinds == NUMBER) & (raw & 0xC0 != 0x80)
    begins[at[:-1][at[:-1] < len(raw)]] = True
    # An apostrophe that begins a run of marks takes one of these endings with it, if its text goes on so far.
    quotes = np.flatnonzero(raw == ord("'"))
    quotes = quotes[begins[quotes]]
    left = at[np.searchsorted(at, quotes, "right")] - quotes
    first, second = raw[np.minimum(quotes + 1, len(raw) - 1)], raw[np.minimum(quotes + 2, len(raw) - 1)]
    pairs = first.astype(np.int64) << 8 | second
    long = (left > 2) & np.isin(pairs, [ord(a) << 8 | ord(b) for a, b in ("re", "ve", "ll")])
    short = (left > 1) & np.isin(first, np.frombuffer(b"stmd", np.uint8))
    for which, length in ((short, 2), (long, 3)):
        begins[quotes[which] + 1] = False
        after = quotes[which] + length
        begins[after[after < len(raw)]] = True
    starts = np.flatnonzero(begins).astype(np.int32)
    sizes, filled = np.diff(starts, append=np.int32(len(raw))), kinds[starts] != SPACE
    return strings(pa.string(), np.cumsum(sizes[filled], dtype=np.int32), raw[kinds != SPACE]), np.searchsorted(starts[filled], at.astype(np.int32))


class WordTokenizer:
    """Ids of a tokenizer that lower-cases, splits texts into words by a pattern, and encodes each word's bytes by itself. So
    each distinct word of many texts is encoded once; the ids of up to most_words words are kept.

    Texts with other characters than PLAIN, or with the opening of a control string, are given to the tokenizer whole.
    Vocabularies of more than 65,536 ids are refused.
    """

    def __init__(self, path: str, most_words: int = 400_000):
        self.tokenizer, self.most_words = Tokenizer.from_file(path), most_words
        if self.tokenizer.get_vocab_size() > 2**16:
            raise ValueError(f"{path}: ids are kept in 16 bits; it has {self.tokenizer.get_vocab_size()}")
        self.words, self.ids = pa.array([], pa.string()), pa.array([], pa.binary())

    def _encoded(self, words: pa.Array) -> pa.Array:
        tokenize, ids, ends = self.tokenizer.model.tokenize, array("H"), array("i")
        for at in range(0, len(words), 10_000):
            for word in words[at : at + 10_000].to_pylist():
                written = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS)
                ids.extend([t.id for t in tokenize(written)])
                ends.append(2 * len(ids))
        return strings(pa.binary(), np.frombuffer(ends, np.int32), np.frombuffer(ids, np.uint8))

    def _ids_of(self, words: pa.Array) -> pa.Array:
        """The ids of each of these distinct words."""
        found = pc.index_in(words, value_set=self.words)
        fresh = words.filter(found.is_null())
        at = found.fill_null(0).to_numpy().copy()
        at[found.is_null().to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(fresh))
        known = pa.concat_arrays([self.ids, self._encoded(fresh)])
        ids = known.take(pa.array(at))
        if len(known) <= self.most_words:
            self.words, self.ids = pa.concat_arrays([self.words, fresh]), known
        else:  # words that these texts do not have are forgotten
            self.words, self.ids = words[: self.most_words], ids[: self.most_words]
        return ids

    def encode(self, texts: pa.Array) -> pa.Array:
        """For each text, none of them null, its ids as unsigned 16-bit numbers in this machine's order."""
        plain = pc.and_not(pc.match_substring_regex(texts, PLAIN), pc.match_substring(texts, "<|"))
        words, before = words_of(pc.utf8_lower(texts.filter(plain)))
        distinct = words.dictionary_encode()
        ends, ids = places(self._ids_of(distinct.dictionary).take(distinct.indices))
        out = strings(pa.binary(), ends[before[1:]], ids)
        if len(out) == len(texts):
            return out
        others = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in texts.filter(pc.invert(plain)).to_pylist()]
        out = pa.concat_arrays([out, pa.array([array("H", x).tobytes() for x in others], pa.binary())])
        plain = plain.to_numpy(zero_copy_only=False)
        return out.take(pa.array(np.where(plain, np.cumsum(plain), plain.sum() + np.cumsum(~plain)) - 1))
