"""Token ids of whole texts by the tokenizers library, each distinct chunk of a text encoded once.

The pre-tokenisers of the tables in use never join a character to white space that follows it, so a text splits before
any white space into chunks that are encoded alone. Chunks are cut at blank, tab, line feed and carriage return; a text
with any other white space goes to the library whole, since a run of mixed white space must stay together. They also end a
run of letters at the mark that follows it, so a word is one chunk whatever mark it has behind it.

Texts that are encoded together are one Arrow buffer: NumPy finds the cuts in it, Arrow tells the distinct chunks and puts
their ids in the order of the texts, and only distinct chunks become Python strings.
"""

from __future__ import annotations

import os
import re
from itertools import compress, filterfalse, islice

import numpy as np
import pyarrow as pa

CHUNK = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
#: The other characters that some Unicode version counts as white space.
OTHER_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -‍    ⁠　﻿]")
#: Letters that stay one letter in lower case and in composed form, and marks that never combine with one.
LETTERS, MARKS = "[A-Za-zÀ-ÖØ-öø-ÿŒœ]", "[.,;:!?]"
PLAIN = re.compile(rf" {LETTERS}+")
TOGETHER = 200
#: Chunks that a worker remembers, some 120 bytes each. Those met first are the frequent ones, so more save little time.
KNOWN_CHUNKS = 500_000
LONG_CHUNK = 200
GROUP_CHARS = 600_000

_encoders: dict[str, LibraryEncoder] = {}


def _bytes(letters: str) -> np.ndarray:
    return np.isin(np.arange(256), list(letters.encode("latin-1")))


_SPACE, _MARK, _ASCII_LETTER = _bytes(" \t\n\r"), _bytes(".,;:!?"), _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
#: Second bytes of LETTERS beyond ASCII after C3 (without those of the signs × and ÷) and after C5.
_AFTER_C3, _AFTER_C5 = ~_bytes("\x97\xb7"), _bytes("\x92\x93")


def chunk_starts(data: np.ndarray, starts: np.ndarray, marks: bool) -> np.ndarray:
    """Where chunks begin in the UTF-8 bytes of texts that follow each other; ``starts``: where the texts do, none empty.

    A chunk begins with a text and with white space behind other characters; with ``marks`` also at the mark that ends a
    run of LETTERS which begins a text or follows white space.
    """
    space = _SPACE[data]
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[starts] = True
    if marks:
        letter = _ASCII_LETTER[data]
        for lead, second in ((0xC3, _AFTER_C3), (0xC5, _AFTER_C5)):
            at = np.flatnonzero(data == lead)
            at = at[second[data[at + 1]]]
            letter[at] = letter[at + 1] = True
        edge = ~letter
        edge[starts] = True
        at = np.flatnonzero(edge)  # what is no letter, and the first of each text
        before, at = at[:-1], at[1:]
        begins[at[_MARK[data[at]] & (letter[before] | (space[before] & (at > before + 1)))]] = True
    return np.flatnonzero(begins)


class ChunkEncoder:
    """``encode`` gives a text's ids as little-endian unsigned 32-bit integers. Chunks are remembered up to a bound."""

    def __init__(self, most: int | None = None):
        self.known: dict[str, bytes] = {}
        self.most = most or KNOWN_CHUNKS

    def chunks(self, texts: list[str]) -> list[bytes]:
        raise NotImplementedError

    def forget(self) -> None:
        """Where too many are remembered: the chunks met first are the frequent ones; half of the bound, met last, go."""
        if len(self.known) > self.most:
            for c in list(islice(reversed(self.known), self.most // 2)):
                del self.known[c]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if OTHER_SPACE.search(text):
            return self.chunks([text])[0]
        parts = CHUNK.findall(text)
        known = self.known
        new = list(set(filterfalse(known.__contains__, parts)))
        if new and len(known) > self.most:
            self.forget()
            new = list(set(filterfalse(known.__contains__, parts)))
        if new:
            known.update(zip(new, self.chunks(new)))
        found = b"".join(map(known.__getitem__, parts))
        for c in new:
            if len(c) > LONG_CHUNK:
                del known[c]
        return found


class LibraryEncoder(ChunkEncoder):
    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        special = [(t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special]
        self.between = special[-1] if special else None
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = not any(re.search(LETTERS + MARKS, t) for t in added)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """``encode`` of each text, in groups of about GROUP_CHARS characters: a group's new chunks go to the library together."""
        found, group, size = [], [], 0
        for text in texts:
            group.append(text)
            size += len(text or "")
            if size >= GROUP_CHARS:
                found += self._encode_group(group)
                group, size = [], 0
        return found + self._encode_group(group)

    def _encode_group(self, texts: list[str | None]) -> list[bytes]:
        whole = [i for i, t in enumerate(texts) if t and OTHER_SPACE.search(t)]
        found = dict(zip(whole, self.chunks([texts[i] for i in whole]))) if whole else {}
        places = [i for i, t in enumerate(texts) if t and i not in found]
        if places:
            found.update(zip(places, self._encode_buffer(pa.array([texts[i] for i in places], pa.large_string()))))
        return [found.get(i, b"") for i in range(len(texts))]

    def _encode_buffer(self, texts: pa.Array) -> list[bytes]:
        _, at, data = texts.buffers()
        at = np.frombuffer(at, np.int64)[: len(texts) + 1]
        begins = chunk_starts(np.frombuffer(data, np.uint8)[: at[-1]], at[:-1], self.marks)
        ends = np.append(begins, at[-1])
        chunks = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(ends), data).dictionary_encode()
        self.forget()
        known, met = self.known, chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(known.get, met))
        new = [i for i, x in enumerate(ids) if x is None]
        if new:
            words = [met[i] for i in new]
            for i, c, x in zip(new, words, self.chunks(words)):
                ids[i] = x
                if len(c) <= LONG_CHUNK:
                    known[c] = x
        _, ends, data = pa.array(ids, pa.large_binary()).take(chunks.indices).buffers()
        ends = np.frombuffer(ends, np.int64)[np.append(np.searchsorted(begins, at[:-1]), len(begins))].tolist()
        data = memoryview(data)
        return [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]

    def _alone(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def chunks(self, texts: list[str]) -> list[bytes]:
        """Chunks of a blank and letters go in one text as they are, the others with a special token between them: the library
        cuts there before all else."""
        plain = [bool(PLAIN.fullmatch(t)) for t in texts]
        words = iter(self._plain(list(compress(texts, plain))))
        others = iter(self._apart([t for t, p in zip(texts, plain) if not p]))
        return [next(words if p else others) for p in plain]

    def _plain(self, texts: list[str]) -> list[bytes]:
        """As chunks are encoded alone and each holds a word at least, as many words as chunks are one word for each."""
        found = []
        for i in range(0, len(texts), TOGETHER):
            part = texts[i : i + TOGETHER]
            encoded = self.tokenizer.encode("".join(part), add_special_tokens=False)  # the fast form tells no words
            cuts = np.flatnonzero(np.diff(np.array(encoded.word_ids, np.float64))) + 1
            if len(cuts) + 1 != len(part):
                found += self._alone(part)
                continue
            data, at = np.array(encoded.ids, "<u4").tobytes(), 0
            for end in [*(4 * cuts).tolist(), len(data)]:
                found.append(data[at:end])
                at = end
        return found

    def _apart(self, texts: list[str]) -> list[bytes]:
        if self.between is None or len(texts) < 3 or any(self.between[0] in t for t in texts):
            return self._alone(texts)
        token, cut = self.between
        found = []
        for i in range(0, len(texts), TOGETHER):
            part = texts[i : i + TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast([token.join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = [*np.flatnonzero(ids == cut).tolist(), len(ids)]
            if len(ends) != len(part):
                found += self._alone(part)
                continue
            data, at = ids.tobytes(), 0
            for end in ends:
                found.append(data[4 * at : 4 * end])
                at = end + 1
        return found


def library_encoder(path: str) -> LibraryEncoder:
    """One encoder for a worker process, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = LibraryEncoder(path)
    return _encoders[path]
