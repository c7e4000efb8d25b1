"""Fast exact encoding with two public vocabularies.

Both tokenizers cut a text at white space before anything else looks at it, so an
encoding is the row of the encodings of its chunks.  Chunks repeat: a worker encodes each
distinct chunk once, and a text costs one split and one look-up a word, in Arrow and NumPy.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken

from ratebook.llm.common import ragged

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

#: Distinct chunks that a worker keeps.
KEPT_CHUNKS = 300_000

#: How the vocabulary file's tokenizer cuts a chunk into words.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SUFFIX = "</w>"

_ENCODERS: dict[tuple[type, str], object] = {}


def encoder(kind: type, path: str):
    """One encoder a worker process."""
    if (kind, path) not in _ENCODERS:
        _ENCODERS[kind, path] = kind(path)
    return _ENCODERS[kind, path]


def library(path: str) -> Tokenizer:
    """The public library's own tokenizer, without truncation or padding."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in shown}
    hidden = (b for b in range(256) if b not in set(shown))
    return table | {chr(256 + k): b for k, b in enumerate(hidden)}


class Chunks:
    """Token ids of chunks, kept; subclasses say how chunks are cut and encoded."""

    def __init__(self) -> None:
        self._clear()

    def _clear(self) -> None:
        self.places: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 12, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)
        self.filled = 0

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids one after the other, and how many each chunk has."""
        raise NotImplementedError

    def cut(self, texts: pa.Array) -> pa.ListArray:
        raise NotImplementedError

    def _learn(self, chunks: list[str]) -> None:
        ids, lengths = self.encode_chunks(chunks)
        known, need = len(self.places), self.filled + len(ids)
        while need > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while known + len(chunks) > len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
            self.lengths = np.concatenate((self.lengths, np.zeros_like(self.lengths)))
        self.ids[self.filled : need] = ids
        self.starts[known : known + len(chunks)] = self.filled + np.cumsum(lengths) - lengths
        self.lengths[known : known + len(chunks)] = lengths
        self.places.update(zip(chunks, range(known, known + len(chunks))))
        self.filled = need

    def encode(self, texts: pa.Array, count_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text after the other, and how many each text has."""
        if len(self.places) > KEPT_CHUNKS:
            self._clear()
        lists = self.cut(texts)
        coded = pc.dictionary_encode(lists.flatten())
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.places.get, chunks))
        if None in found:
            self._learn([c for c, place in zip(chunks, found) if place is None])
            found = list(map(self.places.get, chunks))
        at = np.array(found, np.int64)[np.asarray(coded.indices)] if chunks else np.zeros(0, int)
        lengths = self.lengths[at]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        counts = np.diff(ends[offsets])
        ids = np.zeros(0, np.uint32) if count_only else self.ids[ragged(self.starts[at], lengths)]
        return ids, counts


class WordBpe(Chunks):
    """A vocabulary of word pieces with word ends (lower case, white space dropped).

    Words go through a faster BPE that joins any two neighbours whose text is a token.  The
    library joins only the pairs it lists, so each pair of neighbouring tokens is checked
    with `bpe` once: a row of tokens is the encoding of its text exactly if every two
    neighbours are the encoding of theirs.  Anything else is left to the library.
    """

    #: Longer words are left to the library (or to the operator for long unsplit text).
    LONG = 200
    _END = "\x01"

    def __init__(self, path: str) -> None:
        super().__init__()
        self.library = library(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.names = {i: t for t, i in self.library.get_vocab(with_added_tokens=True).items()}
        self.bytes_of = byte_characters()
        self.shown = {b: c for c, b in self.bytes_of.items()}
        end = self._END.encode()
        ranks: dict[bytes, int] = {}
        ids: list[int] = []

        def add(token: bytes, name: str) -> None:
            if token not in ranks:
                ranks[token] = len(ids)
                ids.append(self.vocabulary[name])

        for b in range(256):
            add(bytes([b]) + end, self.shown[b] + _SUFFIX)
        for left, right in pairs:
            name = left + right
            word = name.removesuffix(_SUFFIX)
            add(bytes(map(self.bytes_of.__getitem__, word)) + end * (name != word), name)
        for b in range(256):
            add(bytes([b]), self.shown[b])
        self._id = np.array(ids, np.uint32)
        self._last = np.zeros(len(ids), bool)
        for token, rank in ranks.items():
            self._last[rank] = token.endswith(end)
        self._fast = tiktoken.Encoding(
            "words", pat_str=r"[^\x01]+\x01", mergeable_ranks=ranks, special_tokens={}
        )
        self._ends = np.zeros(max(self.vocabulary.values()) + 1, bool)
        for token, i in self.vocabulary.items():
            self._ends[i] = token.endswith(_SUFFIX)
        self._right: set[int] = set()
        self._wrong: set[int] = set()
        self._split = regex.compile(_WORDS)
        self._plain = regex.compile(r"[\x03-ɏ]*")
        self._shown_bytes = {b: c for b, c in self.shown.items() if b != ord(" ")}

    def bpe(self, symbols: list[str]) -> list[str]:
        """Join the listed pair of lowest rank, leftmost first, until none is left."""
        while len(symbols) > 1:
            ranked = [
                (self.ranks[pair], k)
                for k, pair in enumerate(zip(symbols, symbols[1:]))
                if pair in self.ranks
            ]
            if not ranked:
                break
            k = min(ranked)[1]
            symbols = [*symbols[:k], symbols[k] + symbols[k + 1], *symbols[k + 2 :]]
        return symbols

    def shown_words(self, text: str) -> str:
        """The words of a text as the vocabulary writes them, a blank between two."""
        if self._plain.fullmatch(text):
            words = " ".join(self._split.findall(text.lower()))
            return words.encode().decode("latin-1").translate(self._shown_bytes)
        shown = self.library.normalizer.normalize_str(text)
        return " ".join(w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(shown))

    def _pair_holds(self, left: int, right: int) -> bool:
        a, b = self.names[left], self.names[right]
        word = b.removesuffix(_SUFFIX)
        symbols = [*a, *word]
        if word != b:
            symbols[-1] += _SUFFIX
        return self.bpe(symbols) == [a, b]

    def cut(self, texts: pa.Array) -> pa.ListArray:
        for blank in ("\n", "\t", "\r"):
            texts = pc.replace_substring(texts, blank, " ")
        return pc.split_pattern(texts, " ")

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty words without end marks, and how many each has."""
        end = self._END
        ranks = np.array(self._fast.encode_ordinary(end.join(words) + end), np.int64)
        ids = self._id[ranks]
        ends = np.flatnonzero(self._last[ranks]) + 1
        lengths = np.diff(ends, prepend=0)
        inner = np.ones(len(ids), bool)
        inner[ends - 1] = False
        at = np.flatnonzero(inner)
        codes = ids[at].astype(np.int64) << 32 | ids[at + 1]
        for code in np.unique(codes).tolist():
            if code not in self._right and code not in self._wrong:
                holds = self._pair_holds(code >> 32, code & 0xFFFFFFFF)
                (self._right if holds else self._wrong).add(code)
        if self._wrong:
            bad = np.isin(codes, np.fromiter(self._wrong, np.int64))
            which = np.unique(np.searchsorted(ends, at[bad], side="right"))
            if len(which):
                parts = np.split(ids, ends[:-1])
                for k in which:
                    shown = [self.shown[b] for b in words[k].encode()]
                    shown[-1] += _SUFFIX
                    parts[k] = np.array(
                        [self.vocabulary[t] for t in self.bpe(shown)], np.uint32
                    )
                return np.concatenate(parts), np.array([len(p) for p in parts])
        return ids, lengths

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words: list[str] = []
        counts = np.zeros(len(chunks), np.int64)
        slow: list[int] = []
        for k, chunk in enumerate(chunks):
            if len(chunk) > self.LONG or "<|" in chunk or not self._plain.fullmatch(chunk):
                slow.append(k)
            else:
                own = self._split.findall(chunk.lower())
                counts[k] = len(own)
                words += own
        ids, lengths = self._encode_words(words) if words else (np.zeros(0, np.uint32),) * 2
        ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
        last = np.cumsum(counts)
        totals = ends[last] - ends[last - counts]
        if not slow:
            return ids, totals
        parts = np.split(ids, np.cumsum(totals)[:-1])
        for k in slow:
            parts[k] = np.array(
                self.library.encode(chunks[k], add_special_tokens=False).ids, np.uint32
            )
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


class ByteBpe(Chunks):
    """Byte-level BPE; a space belongs to the word after it.

    A text is cut before every single space between two characters that are not white
    space: the tokenizer always starts a new piece there, and what follows does not depend
    on what went before.
    """

    _SPACE = regex.compile(r"(?<=\S) (?=\S)")
    _BLANKS = r"^[\s\pZ\x{85}\x1c-\x1f\x0b]|[\s\pZ\x{85}\x1c-\x1f\x0b]{2}|[\s\pZ\x{85}\x1c-\x1f\x0b]$"

    def __init__(self, path: str) -> None:
        super().__init__()
        self.library = library(path)

    def cut(self, texts: pa.Array) -> pa.ListArray:
        # A mark that no text holds goes before every such space; Arrow then cuts there.
        code = 0
        while pc.any(pc.match_substring(texts, chr(code))).as_py():
            code += 1
        mark = chr(code)
        odd = pc.match_substring_regex(texts, self._BLANKS)
        marked = pc.replace_substring(texts, " ", mark + " ")
        if pc.any(odd).as_py():
            by_hand = [
                self._SPACE.sub(mark + " ", t) if o else None
                for t, o in zip(texts.to_pylist(), odd.to_pylist())
            ]
            marked = pc.coalesce(pa.array(by_hand, texts.type), marked)
        return pc.split_pattern(marked, mark)

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.library.encode_batch_fast(chunks, add_special_tokens=False)
        lengths = np.array([len(e) for e in found], np.int64)
        ids = np.fromiter((i for e in found for i in e.ids), np.uint32, int(lengths.sum()))
        return ids, lengths
