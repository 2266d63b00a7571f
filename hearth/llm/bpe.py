"""BPE encoding and decoding with a public word-end vocabulary (operator 3).

A first pass counts the words of all documents in Spark and picks the
frequent ones. They are compiled, with their token ids as outputs, into a
minimal acyclic transducer (``lexicon``), which Spark distributes as a file
and every Python worker memory-maps. The second pass splits each text into
words, looks its new words up in the transducer, and merges those it doesn't
hold exactly by the ranks of the vocabulary.

Both passes split texts that are in Latin-1 many at once, by the classes of
their bytes, and treat their words as arrays of bytes; other texts, and those
with special strings, go through the pattern of the vocabulary.
"""

from __future__ import annotations

import atexit
import gc
import json
import os
import re
import shutil
import tempfile
import unicodedata
import uuid
from collections import Counter
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from tokenizers import normalizers

from hearth.llm import lexicon
from hearth.llm.common import stage, text_or_empty

PIECE_CHARS = 1 << 20       # texts are worked on in pieces of about this size
CACHE_CHUNKS = 250_000      # chunks (words with their punctuation) a worker remembers: about 50 MB; an executor
                            # with c cores may have 2c such workers, as those that pack are taken for encoding too
CACHE_WORDS = 250_000       # words of Latin-1 texts a worker remembers, as arrays: about 20 MB
NO_MERGE = 1 << 40
SEPARATORS = re.compile("[\x1c-\x1f]")
UNSETTLED = regex.compile(r"[\p{M}\p{Cn}]").search     # marks, and code points without a meaning yet
CLIP_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LONGEST_CUT = 2048          # texts with longer words are split by regular expression
TOO_LONG = re.compile(rb"[^\t-\r \x85\xa0]{%d}" % (LONGEST_CUT + 1)).search
LATIN_SPACE, LATIN_LETTERS, LATIN_NUMBERS = r"\t-\r \x85\xa0", "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + k)
    return [out[b] for b in range(256)]


class Cut:
    """The distinct words of some texts in Latin-1, by rising hash: where they
    first stand in ``buf``, their ``lengths``, ``hashes`` and ``counts``. ``number``
    is the word of each occurrence, ``limits`` each text's first occurrence."""

    def __init__(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray, limits: np.ndarray):
        self.buf, self.limits = buf, limits
        hashes = hash_words(buf, starts, lengths)
        order = np.argsort(hashes)
        ordered = hashes[order]
        new = np.ones(len(order), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        heads = np.flatnonzero(new)
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.cumsum(new) - 1
        self.counts = np.diff(heads, append=len(order))
        head = order[heads]
        self.starts, self.lengths, self.hashes = starts[head], lengths[head], ordered[heads]
        same = head[self.number]
        #: no two words share a hash
        self.exact = equal_words(buf, starts, lengths, buf, starts[same], lengths[same])


def eights(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of a buffer."""
    return np.ndarray(len(buf) - 7, "<u8", buf, strides=(1,))


def hash_words(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    x = eights(buf)
    h = x[starts] & MASKS[np.minimum(lengths, 8)]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + lengths.astype(np.uint64)
    long, at = np.flatnonzero(lengths > 8), 8
    while len(long):
        part = x[starts[long] + at] & MASKS[np.minimum(lengths[long] - at, 8)]
        h[long] = ((h[long] ^ (h[long] >> np.uint64(31))) + part) * np.uint64(0xD6E8FEB86659FD93)
        at += 8
        long = long[lengths[long] > at]
    return h


def equal_words(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
                buf2: np.ndarray, starts2: np.ndarray, lengths2: np.ndarray) -> bool:
    """Whether all words are equal, byte by byte, to their partners."""
    if (lengths != lengths2).any():
        return False
    x, y = eights(buf), eights(buf2)
    if ((x[starts] ^ y[starts2]) & MASKS[np.minimum(lengths, 8)]).any():
        return False
    long, at = np.flatnonzero(lengths > 8), 8
    while len(long):
        if ((x[starts[long] + at] ^ y[starts2[long] + at]) & MASKS[np.minimum(lengths[long] - at, 8)]).any():
            return False
        at += 8
        long = long[lengths[long] > at]
    return True


class WordTable:
    """Distinct words in Latin-1, numbered as they come; found by their hashes,
    which are kept sorted, and compared byte by byte."""

    def __init__(self):
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.starts, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.pool, self.used = np.zeros(1 << 16, np.uint8), 0

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, cut: Cut) -> tuple[np.ndarray, np.ndarray] | None:
        """Where each of the cut's words would stand among the hashes, and which
        are new; None if one shares its hash with a different word."""
        at = np.searchsorted(self.hashes, cut.hashes)
        new = np.ones(len(at), bool)
        inside = np.flatnonzero(at < len(self.hashes))
        new[inside] = self.hashes[at[inside]] != cut.hashes[inside]
        old = np.flatnonzero(~new)
        k = self.numbers[at[old]]
        same = equal_words(cut.buf, cut.starts[old], cut.lengths[old], self.pool, self.starts[k], self.lengths[k])
        return (at, new) if same else None

    def add(self, cut: Cut, at: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Take the new words in; the number of each of the cut's words."""
        which = np.flatnonzero(new)
        n = len(self)
        data, lengths = gather(cut.buf, cut.starts[which], cut.lengths[which])
        while self.used + len(data) + 8 > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + len(data)] = data
        self.starts = np.concatenate([self.starts, (self.used + np.cumsum(lengths) - lengths).astype(np.int32)])
        self.lengths = np.concatenate([self.lengths, lengths.astype(np.int32)])
        self.used += len(data)
        numbers = np.empty(len(new), np.int64)
        numbers[which] = np.arange(n, n + len(which))
        numbers[~new] = self.numbers[at[~new]]
        self.hashes = np.insert(self.hashes, at[which], cut.hashes[which])
        self.numbers = np.insert(self.numbers, at[which], numbers[which])
        return numbers

    def utf8(self, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all words from a number on, in UTF-8, and where they end."""
        lengths = self.lengths[first:].astype(np.int64)
        data = self.pool[self.starts[first]:self.used] if len(lengths) else self.pool[:0]
        ends = np.cumsum(lengths)
        wider = np.cumsum(data > 127)
        return (np.frombuffer(data.tobytes().decode("latin-1").encode(), np.uint8),
                ends + wider[ends - 1] if len(ends) else ends)


MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)     # the first k of eight bytes


def latin(text: str) -> bytes | None:
    """The text in Latin-1, if it has such letters only, and no special string
    (Latin-1 is composed already)."""
    if "<|" in text or len(text) > PIECE_CHARS:
        return None
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        return None


def sort_out(vocab: Vocabulary, texts: list[str]) -> tuple[Cut | None, list[int], list[int]]:
    """The words of the texts that ``cut`` takes, the numbers of these texts,
    and those of the others."""
    raw = [latin(t) if vocab.cuts else None for t in texts]
    taken = [k for k, x in enumerate(raw) if x is not None]
    cut = vocab.cut([raw[k] for k in taken]) if taken else None
    if cut is None and taken:
        raw = [None if x is None or TOO_LONG(x) else x for x in raw]
        taken = [k for k, x in enumerate(raw) if x is not None]
        cut = vocab.cut([raw[k] for k in taken]) if taken else None
    if cut is None or not cut.exact:
        return None, [], list(range(len(texts)))
    return cut, taken, [k for k, x in enumerate(raw) if x is None]


class Vocabulary:
    """The files' rules: word split, byte symbols, merge ranks, special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab = model["vocab"]
        chars = _byte_chars()
        self.inner = [vocab[c] for c in chars]
        self.last = [vocab[c + self.suffix] for c in chars]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b])
                       for rank, (a, b) in enumerate(model["merges"])}
        self._inner, self._last = np.array(self.inner), np.array(self.last)
        self._n = len(vocab) + len(spec["added_tokens"])
        pairs = np.array([a * self._n + b for a, b in self.merges], np.int64)
        order = np.argsort(pairs)
        self._pairs, self._pair_ranks = pairs[order], order
        self._merged = np.array([m for _, m in self.merges.values()], np.int64)  # by rank
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        n = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * n
        for t, k in [*vocab.items(), *self.special.items()]:
            self.tokens[k] = t
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # the same pattern for texts in Latin-1 only: classes of bytes, or a plain pattern
        self.cuts = split == CLIP_SPLIT
        self._lower = bytes(ord(chr(b).lower()) for b in range(256))
        self._class = bytes(0 if re.match(f"[{LATIN_SPACE}]", chr(b)) else 1 if re.match(f"[{LATIN_LETTERS}]", chr(b))
                            else 2 if re.match(f"[{LATIN_NUMBERS}]", chr(b)) else 3 for b in range(256))
        self._latin = re.compile(split.replace(r"[^\s\p{L}\p{N}]", f"[^{LATIN_SPACE}{LATIN_LETTERS}{LATIN_NUMBERS}]")
                                 .replace(r"\p{L}", LATIN_LETTERS).replace(r"[\p{N}]", f"[{LATIN_NUMBERS}]")).findall
        # \s of the file is the Unicode property
        self._words = regex.compile(split.replace(r"\s", r"\p{White_Space}")).findall
        split = (split.replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]||[{NEWER_CLASS}]]")
                 .replace(r"[\p{L}]", rf"[\p{{L}}--[{NEWER_CLASS}]]")
                 .replace(r"[\p{N}]", rf"[\p{{N}}--[{NEWER_CLASS}]]"))
        self._words_newer = regex.compile(split.replace(r"\s", r"\p{White_Space}"), regex.V1).findall
        self._nfc = normalizers.NFC().normalize_str
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")

    def normalise(self, text: str) -> str:
        # the library's tables decide where Python's may be of another Unicode version
        if not text.isascii() and (UNSETTLED(text) or not unicodedata.is_normalized("NFC", text)):
            text = self._nfc(text)
        return text.replace("Σ", "σ").lower()  # characters one by one: no final sigma

    def words(self, chunk: str) -> list[str]:
        if chunk.isascii():
            return self._words(chunk)
        chunk = chunk.translate(NEWER_LOWER)
        return self._words_newer(chunk) if HAS_NEWER(chunk) else self._words(chunk)

    def units(self, piece: str) -> list[str]:
        """The normalised piece's words; where it holds more than Latin letters,
        what stands between white space, for ``words`` to split further."""
        try:
            piece.encode("latin-1")
        except UnicodeEncodeError:
            # str.split() also splits at these four, which are symbols here
            return self.words(piece) if SEPARATORS.search(piece) else piece.split()
        return self._latin(piece)

    def cut(self, texts: list[bytes]) -> Cut | None:
        """The normalised words of texts given in Latin-1, all texts at once.
        None if one is very long."""
        joined = b"\n".join(texts).translate(self._lower)
        buf = np.frombuffer(joined + bytes(8), np.uint8)
        kind = np.frombuffer(b"\0" + joined.translate(self._class) + b"\0", np.uint8)
        edges = np.flatnonzero((kind[1:] != kind[:-1]) | (kind[1:] == 2))
        starts, ends = edges[:-1], edges[1:]
        kinds = kind[1:][starts]
        # a single apostrophe takes the letters of its contraction
        at = np.flatnonzero((kinds == 3) & (ends - starts == 1))
        at = at[buf[starts[at]] == ord("'")]
        at = at[kind[ends[at] + 1] == 1]
        if len(at):
            starts, ends = starts.copy(), ends.copy()
            a, b, left = buf[ends[at]], buf[ends[at] + 1], ends[at + 1] - starts[at + 1]
            pair = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
            take = np.where(np.isin(a, np.frombuffer(b"stmd", np.uint8)), 1, np.where(pair & (left > 1), 2, 0))
            ends[at] += take
            starts[at + 1] += take
        words = np.flatnonzero((kinds > 0) & (ends > starts))
        starts, lengths = starts[words], (ends - starts)[words]
        limits = np.cumsum([0, *[len(t) + 1 for t in texts]])
        if len(starts) and lengths.max() > LONGEST_CUT:
            return None
        return Cut(buf, starts, lengths, np.searchsorted(starts, limits))

    def merge(self, word: bytes) -> list[int]:
        """Merge the lowest-ranked pair, the leftmost of equals, until none is left."""
        inner, merges = self.inner, self.merges
        ids = [inner[b] for b in word]
        ids[-1] = self.last[word[-1]]
        if len(ids) > 64:
            return self._merge_long(ids)
        none = (1 << 60, 0)
        pairs = [merges.get(p, none) for p in zip(ids, ids[1:])]
        while pairs:
            best = min(pairs)
            if best is none:
                break
            k = pairs.index(best)
            ids[k:k + 2] = [best[1]]
            del pairs[k]
            if k:
                pairs[k - 1] = merges.get((ids[k - 1], ids[k]), none)
            if k < len(pairs):
                pairs[k] = merges.get((ids[k], ids[k + 1]), none)
        return ids

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` of many words at once: all ids in a row, and their number by
        word. Every round merges one pair of each word that still has one."""
        lengths = np.array([len(w) for w in words], np.int64)
        out = [None] * len(words)
        for k in np.flatnonzero(lengths > 32):
            out[k] = np.array(self.merge(words[k]), np.uint32)
        for lo, hi in ((1, 8), (9, 12), (13, 20), (21, 32)):
            rows = np.flatnonzero((lengths >= lo) & (lengths <= hi))
            if not len(rows):
                continue
            n, width = lengths[rows], hi + 1      # the last column stays empty
            flat = np.frombuffer(b"".join(words[k] for k in rows), np.uint8)
            fill = np.arange(width) < n[:, None]
            ids = np.full((len(rows), width), -1, np.int64)
            ids[fill] = self._inner[flat]
            ends = np.arange(len(rows)), n - 1
            ids[ends] = self._last[flat[np.cumsum(n) - 1]]
            rank = self._ranks(ids[:, :-1], ids[:, 1:])
            active = np.arange(len(rows))
            cols = np.arange(width - 1)
            while len(active):
                best = rank[active].argmin(axis=1)       # the leftmost of the lowest
                low = rank[active, best]
                go = low < NO_MERGE
                active, best, low = active[go], best[go], low[go]
                if not len(active):
                    break
                x, r = ids[active], rank[active]
                x[np.arange(len(x)), best] = self._merged[low]
                # what follows the pair moves one place to the left
                move = cols + (cols > best[:, None])
                x[:, :-1] = np.take_along_axis(x, move, 1)
                x[:, -1] = -1
                r[:, :-1] = np.take_along_axis(r, cols[:-1] + (cols[:-1] > best[:, None]), 1)
                r[:, -1] = NO_MERGE
                at = np.arange(len(x))
                r[at, best] = self._ranks(x[at, best], x[at, best + 1])
                left = np.flatnonzero(best > 0)
                r[left, best[left] - 1] = self._ranks(x[left, best[left] - 1], x[left, best[left]])
                ids[active], rank[active] = x, r
            for k, row, m in zip(rows, ids.astype(np.uint32), (ids >= 0).sum(axis=1)):
                out[k] = row[:m]
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), np.array([len(x) for x in out], np.int64)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = np.where(b >= 0, a * self._n + b, -1)
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        return np.where(self._pairs[at] == key, self._pair_ranks[at], NO_MERGE)

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for very long words, with a heap over linked symbols."""
        import heapq
        n, merges = len(ids), self.merges
        left, right, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
        heap = [(*merges[p], k) for k, p in enumerate(zip(ids, ids[1:])) if p in merges]
        heap = [(rank, k, ids[k], ids[k + 1]) for rank, _, k in heap]
        heapq.heapify(heap)
        while heap:
            rank, k, a, b = heapq.heappop(heap)
            r = right[k] if alive[k] else -1
            if r < 0 or ids[k] != a or ids[r] != b:
                continue
            ids[k], alive[r], right[k] = merges[a, b][1], False, right[r]
            if right[k] >= 0:
                left[right[k]] = k
            for x in (left[k], k):
                if x >= 0 and right[x] >= 0 and (p := (ids[x], ids[right[x]])) in merges:
                    heapq.heappush(heap, (merges[p][0], x, *p))
        return [x for k, x in enumerate(ids) if alive[k]]


# Lower case of the letters that Unicode 16 and 17 added, which the
# vocabulary's library maps and Python's tables don't hold yet.
NEWER_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3,
               0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
               **{0x10D50 + k: 0x10D70 + k for k in range(22)}, **{0x16EA0 + k: 0x16EBB + k for k in range(25)}}


# Letters and numbers of Unicode 17, which ``regex`` knows and the
# vocabulary's library takes for symbols.
NEWER = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2,
    0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F)]
NEWER_CLASS = "".join(f"{chr(a)}-{chr(b)}" for a, b in NEWER)
HAS_NEWER = re.compile(f"[{NEWER_CLASS}]").search


def pieces(text: str, size: int = PIECE_CHARS):
    """Cut a text before spaces or line ends, where no word is cut."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(" ", at, at + size), text.rfind("\n", at, at + size))
        if cut <= at:
            cut = min((k for k in (text.find(" ", at + size), text.find("\n", at + size)) if k > 0),
                      default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def split_chunks(vocab: Vocabulary, text: str):
    """Lists of words, or of chunks in which words lie whole; a special string
    is a list with its id."""
    parts = vocab.specials.split(text) if "<|" in text else [text]
    for part in parts:
        if part in vocab.special:
            yield [vocab.special[part]]
        else:
            for piece in pieces(part):
                yield vocab.units(vocab.normalise(piece))


class Encoder:
    """Word by word encoding with a bounded memory of the words seen."""

    def __init__(self, vocab: Vocabulary, lex: dict | None):
        self.vocab, self.lex = vocab, lex
        self.clear()
        self.clear_words()

    def clear(self):
        self.index: dict = {}
        self.start, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.pool, self.used = np.zeros(1 << 18, np.uint32), 0

    def clear_words(self):
        self.table = WordTable()
        self.word_start, self.word_ids = np.zeros(1, np.int64), np.zeros(1 << 18, np.uint32)

    def _add(self, words: list, ids: np.ndarray, lengths: np.ndarray):
        n, at = len(words), len(self.index)
        while at + n > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + len(ids)] = ids
        self.length[at:at + n] = lengths
        self.start[at:at + n] = self.used + np.cumsum(lengths) - lengths
        self.used += len(ids)
        self.index.update(zip(words, range(at, at + n)))

    def learn(self, chunks: list):
        """Split new chunks into words; look these up in the transducer and
        merge those it doesn't hold."""
        special = [c for c in chunks if isinstance(c, int)]
        chunks = [c for c in chunks if not isinstance(c, int)]
        if special:
            self._add(special, np.array(special, np.uint32), np.ones(len(special), np.int64))
        if not chunks:
            return
        parts = [[c] if c.isalpha() else self.vocab.words(c) for c in chunks]
        number = {w: k for k, w in enumerate(set().union(*parts))}
        pool, length = self.ids_of([w.encode() for w in number])
        start = np.cumsum(length) - length
        words = np.fromiter((number[w] for p in parts for w in p), np.int64)
        ids, lengths = gather(pool, start[words], length[words])
        first = np.cumsum([0] + [len(p) for p in parts[:-1]])
        self._add(chunks, ids, np.add.reduceat(lengths, first))

    def ids_of(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after the other, and their number by word."""
        rank = lexicon.ranks(self.lex, raw) if self.lex else np.full(len(raw), -1)
        rest = np.flatnonzero(rank < 0)
        length = np.zeros(len(raw), np.int64)
        start = np.zeros(len(raw), np.int64)
        pool, length[rest] = self.vocab.merge_all([raw[k] for k in rest])
        start[rest] = np.cumsum(length[rest]) - length[rest]
        known = np.flatnonzero(rank >= 0)
        if not len(known):
            return pool, length
        at, to = self.lex["starts"][rank[known]], self.lex["starts"][rank[known] + 1]
        length[known] = to - at
        start[known] = len(pool) + np.cumsum(to - at) - (to - at)
        pool = np.concatenate([pool, gather(self.lex["ids"], at, to - at)[0]])
        return gather(pool, start, length)

    def learn_words(self, cut: Cut) -> np.ndarray | None:
        """The numbers of the cut's words, new ones being learnt; None if a hash
        is shared."""
        found = self.table.find(cut)
        if found is not None and len(self.table) + int(found[1].sum()) > CACHE_WORDS and len(self.table):
            self.clear_words()
            found = self.table.find(cut)
        if found is None:
            return None
        n = len(self.table)
        numbers = self.table.add(cut, *found)
        if len(self.table) > n:
            data, ends = self.table.utf8(n)
            data, ends = data.tobytes(), ends.tolist()
            ids, lengths = self.ids_of([data[a:b] for a, b in zip([0, *ends], ends)])
            used = int(self.word_start[-1])
            while used + len(ids) > len(self.word_ids):
                self.word_ids = np.concatenate([self.word_ids, np.zeros_like(self.word_ids)])
            self.word_ids[used:used + len(ids)] = ids
            self.word_start = np.concatenate([self.word_start, used + np.cumsum(lengths)])
        return numbers

    def _numbers(self, used) -> None:
        """Make sure that the index holds all of ``used``."""
        new = set(used).difference(self.index)
        if len(self.index) + len(new) > CACHE_CHUNKS and self.index:
            self.clear()
            new = set(used)
        if new:
            self.learn(list(new))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        cut, taken, others = sort_out(self.vocab, texts)
        numbers = self.learn_words(cut) if cut is not None else None
        if numbers is None:
            others = range(len(texts))
        else:
            at = numbers[cut.number]
            starts = self.word_start[at]
            ids, lengths = gather(self.word_ids, starts, self.word_start[at + 1] - starts)
            limits = np.concatenate([[0], np.cumsum(lengths)])[cut.limits].tolist()
            for k, a, b in zip(taken, limits, limits[1:]):
                out[k] = ids[a:b]
        split = [list(split_chunks(self.vocab, texts[k])) for k in others]
        self._numbers(set().union(*(w for t in split for w in t)))
        for k, t in zip(others, split):
            parts = [np.array(itemgetter(*w)(self.index) if len(w) > 1 else [self.index[x] for x in w], np.int64) for w in t]
            at = parts[0] if len(parts) == 1 else np.concatenate(parts)
            out[k] = gather(self.pool, self.start[at], self.length[at])[0]
        return out


def gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """The pool's slices one after the other, and their lengths."""
    ends = np.cumsum(lengths)
    n = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts - ends + lengths, lengths) + np.arange(n)
    return pool[at], lengths


class Decoder:
    """Tokens' strings joined by one space, as the vocabulary names no decoder."""

    def __init__(self, vocab: Vocabulary):
        raw = [t.encode() + b" " for t in vocab.tokens]
        self.length = np.array([len(x) for x in raw], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.pool = np.frombuffer(b"".join(raw), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(gather(self.pool, self.start[x], self.length[x])[0].tobytes()
                        for x in np.array_split(ids, len(ids) // 200_000 + 1))[:-1].decode()


_VOCABULARIES: dict[str, Vocabulary] = {}
_ENCODERS: dict[tuple, Encoder] = {}


def _vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
        gc.freeze()     # the vocabulary's objects stay; no need to visit them again
    return _VOCABULARIES[path]


def _chunks(column: pa.Array, size: int = 1 << 19):
    """The texts of index ranges of about ``size`` bytes, and the ranges; the
    texts of one range are held at a time."""
    at = n = 0
    for k, length in enumerate(pc.binary_length(column).to_pylist(), 1):
        n += length
        if n >= size or k == len(column):
            yield at, k, column.slice(at, k - at).to_pylist()
            at, n = k, 0


def _count_words(path: str, max_chunks: int = 300_000):
    def run(batches):
        vocab, counts = _vocabulary(path), Counter()
        table, totals = WordTable(), np.zeros(0, np.int64)

        def flush():
            words: Counter = Counter()
            for chunk, n in counts.items():
                for w in [chunk] if chunk.isalpha() else vocab.words(chunk):
                    words[w] += n
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"])

        def flush_table():
            nonlocal table, totals
            data, ends = table.utf8()
            offsets = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32).tobytes())
            words = pa.StringArray.from_buffers(len(table), offsets, pa.py_buffer(data.tobytes()))
            out = pa.RecordBatch.from_arrays([words, pa.array(totals, pa.int64())], ["word", "n"])
            table, totals = WordTable(), np.zeros(0, np.int64)
            return out
        for batch in batches:
            for _, _, texts in _chunks(batch.column(0)):
                cut, _, others = sort_out(vocab, texts)
                found = table.find(cut) if cut is not None else None
                if found is not None:
                    numbers = table.add(cut, *found)
                    totals = np.concatenate([totals, np.zeros(len(table) - len(totals), np.int64)])
                    totals[numbers] += cut.counts
                    if len(table) > max_chunks:
                        yield flush_table()
                else:
                    others = range(len(texts))
                for k in others:
                    for chunks in split_chunks(vocab, texts[k]):
                        if chunks and isinstance(chunks[0], str):
                            counts.update(chunks)
                    if len(counts) > max_chunks:
                        yield flush()
        if len(table):
            yield flush_table()
        if counts:
            yield flush()
    return run


def _merge_words(path: str):
    def run(batches):
        vocab = _vocabulary(path)
        for batch in batches:
            words = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([vocab.merge(w.encode()) for w in words], pa.list_(pa.int32()))],
                ["word", "ids"])
    return run


def frequent_words(docs: DataFrame, text_col: str, path: str, lexicon_words: int) -> DataFrame:
    """The most frequent words (word, ids): all those whose count is over a
    bound, the lowest that leaves at most ``lexicon_words``. Counts cover all
    documents; the bound is a power of 2 ** (1/8)."""
    counts = stage(docs.select(text_or_empty(f"`{text_col}`").alias("t")).mapInArrow(_count_words(path), "word string, n long")
                   .filter(F.octet_length("word") <= lexicon.MAX_BYTES)
                   .groupBy("word").agg(F.sum("n").alias("n"))
                   .withColumn("level", F.floor(F.log2("n") * 8).cast("int")), "bpe-counts")
    total, level = 0, None
    for lv, n in sorted(counts.groupBy("level").count().collect(), reverse=True):  # at most 8 x 64 rows
        total += n
        if total > lexicon_words:
            break
        level = lv
    rows = counts.filter(F.col("level") >= level) if level is not None else counts.limit(0)
    return rows.select("word").mapInArrow(_merge_words(path), "word string, ids array<int>")


def compile_lexicon(docs: DataFrame, text_col: str, path: str, lexicon_words: int) -> tuple[str, list]:
    """Build the transducer on the driver (its size is bounded by
    ``lexicon_words``), and let Spark distribute the file to the workers."""
    found = frequent_words(docs, text_col, path, lexicon_words).toArrow().combine_chunks()
    found = found.set_column(0, "word", found["word"].cast(pa.binary())).sort_by("word")
    arrays = lexicon.build(found["word"].to_pylist())
    ids = found["ids"].combine_chunks()
    arrays["ids"] = ids.flatten().to_numpy().astype(np.uint32)
    arrays["starts"] = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())]).astype(np.int64)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    # the driver's file server hands this copy out until the application ends
    folder = os.path.realpath(tempfile.mkdtemp(prefix="hearth-lexicon-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    local = os.path.join(folder, name)
    layout = lexicon.save(local, arrays)
    docs.sparkSession.sparkContext.addFile(local)
    return name, layout


def _encode_batches(path: str, name: str, layout: list, decode: bool):
    def run(batches):
        vocab = _vocabulary(path)
        if (path, name) not in _ENCODERS:   # a worker keeps it from task to task
            _ENCODERS.clear()
            _ENCODERS[path, name] = Encoder(vocab, lexicon.load(SparkFiles.get(name), layout))
        encoder, decoder = _ENCODERS[path, name], Decoder(vocab)
        for batch in batches:
            for a, b, texts in _chunks(batch.column("t")):
                ids = encoder.encode(texts)
                cols = [batch.column("row").slice(a, b - a),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())]
                names = ["row", "n_tokens", "ids"]
                if decode:
                    cols.append(pa.array([decoder.decode(x) for x in ids], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(cols, names)
    return run


def encode(docs: DataFrame, id_cols: list[str] | None = None, text_col: str = "text",
           path: str | None = None, lexicon_words: int = 400_000, decoded: bool = False) -> DataFrame:
    """One row per input row: ``row`` (the columns ``id_cols``, by default all
    but the text), ``n_tokens``, ``ids`` (little-endian unsigned 32-bit
    integers) and, if ``decoded``, the text ``decode`` gives back.

    Null texts count as empty and give no ids; the strings of special tokens
    in a text become those tokens; texts of any length are encoded whole, in
    pieces that end between words. Repeated rows and clashing names do no
    harm, as the other columns travel inside ``row``. An empty table gives an
    empty result.
    """
    path = path or vocabulary_path()
    name, layout = compile_lexicon(docs, text_col, path, lexicon_words)
    cols = [c for c in docs.columns if c != text_col] if id_cols is None else id_cols
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"),
                      text_or_empty(f"`{text_col}`").alias("t"))
    kind = src.schema["row"].dataType.simpleString()
    return src.mapInArrow(_encode_batches(path, name, layout, decoded),
                          f"row {kind}, n_tokens long, ids binary" + ", decoded string" * decoded)


def decode(encoded: DataFrame, ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """Add ``decoded`` to rows with ``ids`` as ``encode`` gives them; null ids
    decode to an empty text."""
    path = path or vocabulary_path()
    out = StructType([*encoded.schema.fields, StructField("decoded", StringType())])

    def run(batches):
        decoder = Decoder(_vocabulary(path))
        for batch in batches:
            texts = [decoder.decode(np.frombuffer(x or b"", "<u4")) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             [*batch.schema.names, "decoded"])
    return encoded.mapInArrow(run, out)
