"""Byte-level BPE over whole texts: exact ids by distinct words, and array merging.

A text is cut into words at places where the tokenizer's own pattern always cuts,
so the ids of a text are the ids of its words in order.  The words of a batch are
told apart by Arrow; only distinct ones that a worker has not met yet reach the
tokenizer, and ids are put together again by one gather.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: One optional white-space character with the word after it, or the white
#: space before that.  GPT-2's pattern cuts at each of these borders.
_CHUNK = re.compile(r"\s?\S+|\s+(?!\S)")
#: Characters that Python counts as white space and the tokenizer does not.
_UNSAFE = re.compile("[\x1c-\x1f]")
#: White space of the tokenizer, in Arrow's regular expressions.
_SPACE = r"[\t-\r\x85\p{Z}]"
#: The same without the line end.
_BLANK = r"[\t\x0b-\r\x85\p{Z}]"
#: ASCII marks that may end a word.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Ends in what has been a letter or digit in every version of Unicode.
_SURE = "[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]$"
#: Distinct words of one of the two generations of a cache.
_CACHE_LIMIT = 300_000
#: Bytes of text that are taken apart at once.
_SLICE = 8 << 20


def _slices(texts: pa.Array) -> Iterable[pa.Array]:
    """Runs of rows of about ``_SLICE`` bytes; a longer row is a run of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + _SLICE, side="right")))
        yield texts.slice(first, last - first)
        first = last


class Words:
    """The words of a run of texts: distinct stems and tails, their numbers in text order, and the texts that need another way.

    A word is parted by one space or one line end; the former is left out, the latter
    kept in front.  The first word of a text has a line end in front, too.  ASCII marks
    behind a letter or digit are the tail of a word, what stands before them its stem:
    the pattern always cuts there.  Texts with other white space at a border, or with a
    special string, are ``odd``; the numbers leave them out.
    """

    def __init__(self, texts: pa.Array, special: list[str]):
        marked = pc.binary_join_element_wise(pa.scalar("\n", texts.type), pc.replace_substring(texts, "\n", " \n"), pa.scalar("", texts.type))
        parts = pc.split_pattern(marked, " ")
        found = parts.flatten().dictionary_encode()
        words, codes = found.dictionary, found.indices.to_numpy()
        starts = parts.offsets.to_numpy()[:-1] - parts.offsets[0].as_py()
        odd = rf"^\n?$|^{_BLANK}|^\n{_SPACE}|{_SPACE}$"
        for text in special:
            # a special string with a space or line end in it would span words
            odd += "|" + re.escape(re.split(r"[ \n]", text)[0])
        strange = pc.match_substring_regex(words, odd).to_numpy(zero_copy_only=False)
        self.odd = np.logical_or.reduceat(strange[codes], starts) if len(texts) else np.empty(0, dtype=bool)
        sizes = np.diff(np.append(starts, codes.size))
        if self.odd.any():
            codes, sizes = codes[np.repeat(~self.odd, sizes)], sizes[~self.odd]
        #: words of each text, and the place of its first word
        self.sizes, self.firsts = sizes, np.cumsum(sizes) - sizes
        # words of odd texts alone are never asked for, so nothing must be learned of them
        words = pc.if_else(pa.array(strange), pa.scalar("\n.", words.type), words)
        stems = pc.ascii_rtrim(words, _MARKS)
        stems = pc.if_else(pc.match_substring_regex(stems, _SURE), stems, words)
        tails = self._tails(words, pc.binary_length(stems).to_numpy())
        stems, tails = stems.dictionary_encode(), tails.dictionary_encode()
        self.stems, self.tails = (x.dictionary.to_numpy(zero_copy_only=False).tolist() for x in (stems, tails))
        #: numbers of the stem and the tail of each word of the texts that are not odd, in order
        self.stem_of, self.tail_of = stems.indices.to_numpy()[codes], tails.indices.to_numpy()[codes]

    @staticmethod
    def _tails(words: pa.Array, cut: np.ndarray) -> pa.Array:
        """What stands behind the first ``cut`` bytes of each word."""
        words = words.cast(pa.large_string())
        _, ends, data = words.buffers()
        ends = np.frombuffer(ends, dtype=np.int64)[words.offset : words.offset + len(words) + 1]
        size = np.diff(ends) - cut
        raw = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, dtype=np.uint8)
        raw = raw[_gather(ends[:-1] + cut, size)]
        return pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(np.append(0, np.cumsum(size))), pa.py_buffer(raw.tobytes()))


class TwoGenerations:
    """A bounded cache: when the young half is full it becomes the old half, and the old half is dropped."""

    def __init__(self, limit: int = _CACHE_LIMIT):
        self.young: dict = {}
        self.old: dict = {}
        self.limit = limit

    def look(self, keys: list, learn) -> list:
        """Values of distinct keys; ``learn`` gives those of keys that are not held."""
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
        values = list(map(self.young.get, keys))
        missed = [i for i, v in enumerate(values) if v is None]
        if missed:
            sought = [keys[i] for i in missed]
            held = list(map(self.old.get, sought)) if self.old else [None] * len(sought)
            learned = iter(learn([k for k, v in zip(sought, held) if v is None]))
            found = [next(learned) if v is None else v for v in held]
            self.young.update(zip(sought, found))
            for i, v in zip(missed, found):
                values[i] = v
        return values


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1 ... of every run, one run after the other."""
    ends = np.cumsum(sizes, dtype=starts.dtype)
    places = np.repeat(starts - (ends - sizes), sizes)
    places += np.arange(places.size, dtype=starts.dtype)
    return places


class ChunkEncoder:
    """Ids of texts as the tokenizers library gives them, without added tokens.

    Texts that hold a special string, or all texts of a tokenizer that is not
    plain byte-level BPE, go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.chunked = (
            spec.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
        )
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special_rx = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        # bytes that each id stands for, to find the words again in joined ids
        letters = {c: b for b, c in _byte_letters().items()}
        vocab = spec["model"].get("vocab", {}) if self.chunked else {}
        self.width = np.zeros(1 + max(vocab.values(), default=0), dtype=np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token) if all(c in letters for c in token) else 0
        self.stems, self.tails, self.chunks = TwoGenerations(), TwoGenerations(), TwoGenerations()
        self.line_ids = len(self._whole(["\n"])[0]) // 4

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in found]

    def _learn(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks.

        Chunks of one white-space character and a word keep their borders when they
        are joined, so they go to the library as one text and are told apart by
        their lengths in bytes; others go one by one.
        """
        found: list[bytes] = [b""] * len(chunks)
        tied = [i for i, c in enumerate(chunks) if len(c) > 1 and c[0].isspace() and not c[1].isspace() and not c[-1].isspace()]
        alone = sorted(set(range(len(chunks))).difference(tied))
        for i, ids in zip(alone, self._whole([chunks[i] for i in alone])):
            found[i] = ids
        for k in range(0, len(tied), 20_000):
            some = tied[k : k + 20_000]
            for i, ids in zip(some, self._joined([chunks[i] for i in some])):
                found[i] = ids
        return found

    def _joined(self, chunks: list[str]) -> list[bytes]:
        raw = self._whole(["".join(chunks)])[0]
        ends = np.cumsum(self.width[np.frombuffer(raw, dtype="<u4")])
        want = np.cumsum(pc.binary_length(pa.array(chunks, pa.large_string())).to_numpy())
        cuts = np.searchsorted(ends, want)
        if chunks and not np.array_equal(ends[cuts], want):
            raise ValueError("a chunk border is no token border")
        cuts = [0, *(4 * (cuts + 1)).tolist()]
        return [raw[x:y] for x, y in zip(cuts, cuts[1:])]

    def _learn_stems(self, stems: list[str]) -> list[bytes]:
        """Ids of words; a space stands before each that has no line end there."""
        chunks = [w if w[0] == "\n" else " " + w for w in stems]
        return [ids for k in range(0, len(chunks), 50_000) for ids in self._joined(chunks[k : k + 50_000])]

    def encode_flat(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of ids of each; null is empty.

        ``end_id`` is put behind every text.
        """
        texts = pc.fill_null(texts, "")
        flats, counts = [], []
        for part in _slices(texts):
            if self.chunked:
                flat, count = self._encode_slice(part)
            else:
                raw = self._whole(part.to_pylist())
                flat, count = np.frombuffer(b"".join(raw), dtype="<u4"), np.array([len(r) // 4 for r in raw], dtype=np.int64)
            if end_id is not None:
                flat, count = np.insert(flat, np.cumsum(count), np.uint32(end_id)), count + 1
            flats.append(flat)
            counts.append(count)
        # Arrow keeps what the words of a slice took, and a worker lives on for other tasks
        pa.default_memory_pool().release_unused()
        if not flats:
            return np.empty(0, dtype="<u4"), np.empty(0, dtype=np.int64)
        return np.concatenate(flats), np.concatenate(counts)

    def _encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        own = Words(texts, self.special)
        ids = [*self.stems.look(own.stems, self._learn_stems), *self.tails.look(own.tails, self._whole)]
        length = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids)) // 4
        begin = np.cumsum(length, dtype=np.int32) - length
        # stem, tail, stem, tail ...
        pieces = np.empty((own.stem_of.size, 2), dtype=np.int32)
        pieces[:, 0], pieces[:, 1] = own.stem_of, own.tail_of + np.int32(len(own.stems))
        size, start = length[pieces], begin[pieces]
        # the line end that was set before the first word goes again
        size[own.firsts, 0] -= self.line_ids
        start[own.firsts, 0] += self.line_ids
        flat = np.frombuffer(b"".join(ids), dtype="<u4")[_gather(start.ravel(), size.ravel())]
        count = np.zeros(len(texts), dtype=np.int64)
        if own.sizes.size:
            count[~own.odd] = np.add.reduceat(size.sum(axis=1), own.firsts)
        if not own.odd.any():
            return flat, count
        odd = self._encode_odd(texts.take(pa.array(np.flatnonzero(own.odd))).to_pylist())
        count[own.odd] = [len(r) // 4 for r in odd]
        out = np.empty(int(count.sum()), dtype="<u4")
        from_odd = np.repeat(own.odd, count)
        out[from_odd] = np.frombuffer(b"".join(odd), dtype="<u4")
        out[~from_odd] = flat
        return out, count

    def _encode_odd(self, texts: list[str]) -> list[bytes]:
        """Texts with other white space by chunks, and what no chunk rule covers whole."""
        out: list[bytes] = [b""] * len(texts)
        whole, split = [], []
        for i, t in enumerate(texts):
            if _UNSAFE.search(t) or self.special_rx and self.special_rx.search(t):
                whole.append(i)
            else:
                split.append((i, _CHUNK.findall(t)))
        for i, ids in zip(whole, self._whole([texts[i] for i in whole])):
            out[i] = ids
        distinct = list(dict.fromkeys(c for _, chunks in split for c in chunks))
        known = dict(zip(distinct, self.chunks.look(distinct, self._learn)))
        for i, chunks in split:
            out[i] = b"".join(map(known.__getitem__, chunks))
        return out

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        flat, count = self.encode_flat(pa.array(list(texts), pa.string()))
        ends = np.cumsum(count)
        raw = flat.astype("<u4").tobytes()
        return [raw[4 * (e - c) : 4 * e] for e, c in zip(ends.tolist(), count.tolist())]


class ArrayMerger:
    """Counts BPE symbols by merging many pre-tokens at once in ragged arrays.

    The symbols of a batch of pre-tokens lie in one flat array with the number of
    their sequence beside them.  Every round finds each sequence's lowest-rank
    adjacent pair and merges all its occurrences, left to right without overlap,
    in all sequences at the same time; what is left when no pair has a rank are
    the tokens.
    """

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") is not None or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
            raise ValueError("array merging needs a plain byte-level BPE tokenizer")
        vocab = spec["model"]["vocab"]
        letters = _byte_letters()
        self.byte_ids = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special_rx = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        # the published pattern of the vocabulary (a fixed value)
        self.pattern = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            .replace(r"\s", r"\p{White_Space}")
            .replace(r"\S", r"\P{White_Space}")
        )
        self.stems, self.tails, self.chunks = TwoGenerations(), TwoGenerations(), TwoGenerations()
        self.line_tokens = self._count_chunks(["\n"])[0]

    def _merge(self, pieces: list[bytes]) -> np.ndarray:
        """Number of symbols left of each piece; no piece is empty."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        symbols = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        counts = lengths.copy()
        top = len(self.keys)
        while symbols.size > 1:
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), top - 1)
            rank = np.where((self.keys[at] == key) & (owner[:-1] == owner[1:]), self.ranks[at], top)
            rank = np.append(rank, top)
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            low = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, symbols.size))
            # sequences without a ranked pair are done and leave the arrays
            live = np.repeat(low < top, size)
            symbols, owner, rank = symbols[live], owner[live], rank[live]
            if not symbols.size:
                break
            low, size = low[low < top], size[low < top]
            hit = rank == np.repeat(low, size)
            place = np.flatnonzero(hit)
            # in a run of overlapping hits (a a a) only every second one merges
            run = np.append(True, np.diff(place) > 1)
            begin = np.maximum.accumulate(np.where(run, np.arange(place.size), 0))
            place = place[(np.arange(place.size) - begin) % 2 == 0]
            symbols[place] = self.made[rank[place]]
            np.subtract.at(counts, owner[place], 1)
            keep = np.ones(symbols.size, dtype=bool)
            keep[place + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return counts

    def _count_chunks(self, chunks: list[str]) -> list[int]:
        found = [self.pattern.findall(c) for c in chunks]
        pieces = list(dict.fromkeys(p for f in found for p in f))
        if not pieces:
            return [0] * len(chunks)
        number = dict(zip(pieces, self._merge([p.encode("utf-8") for p in pieces]).tolist()))
        return [sum(map(number.__getitem__, f)) for f in found]

    def count(self, texts: pa.Array) -> np.ndarray:
        """Number of tokens of each whole text; null counts as empty."""
        texts = pc.fill_null(texts, "")
        return np.concatenate([np.empty(0, dtype=np.int64), *map(self._count_slice, _slices(texts))])

    def _count_stems(self, stems: list[str]) -> list[int]:
        """Tokens of words; a space stands before each that has no line end there."""
        chunks = [w if w[0] == "\n" else " " + w for w in stems]
        return [n for k in range(0, len(chunks), 100_000) for n in self._count_chunks(chunks[k : k + 100_000])]

    def _count_slice(self, texts: pa.Array) -> np.ndarray:
        own = Words(texts, self.special)
        stems = np.array(self.stems.look(own.stems, self._count_stems), dtype=np.int64)
        tails = np.array(self.tails.look(own.tails, self._count_chunks), dtype=np.int64)
        out = np.zeros(len(texts), dtype=np.int64)
        if own.sizes.size:
            # the line end before the first word is no part of the text
            out[~own.odd] = np.add.reduceat(stems[own.stem_of] + tails[own.tail_of], own.firsts) - self.line_tokens
        odd = []
        for t in texts.take(pa.array(np.flatnonzero(own.odd))).to_pylist():
            segments = self.special_rx.split(t) if self.special_rx else [t]
            # a chunk border may only be trusted where both views of white space agree
            odd.append((len(segments) - 1, [c for s in segments for c in ([s] if _UNSAFE.search(s) else _CHUNK.findall(s)) if c]))
        distinct = list(dict.fromkeys(c for _, chunks in odd for c in chunks))
        known = dict(zip(distinct, self.chunks.look(distinct, self._count_chunks)))
        out[own.odd] = [extra + sum(map(known.__getitem__, chunks)) for extra, chunks in odd]
        return out


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {b: chr(b) for b in plain}
    shown.update({b: chr(0x100 + k) for k, b in enumerate(b for b in range(256) if b not in shown)})
    return shown
