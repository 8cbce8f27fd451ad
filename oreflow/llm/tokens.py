"""Token ids of whole texts by the tokenizers library, at the pace of a dictionary.

Words repeat, so a task encodes each distinct chunk of text once and looks the
rest up.  A chunk ends where the tokenizer's own pre-tokenizer must end a word;
the ids of a text are therefore the ids of its chunks in a row.  The memory of
known chunks is bounded and starts anew when it is full.

Strings that look like special tokens are ordinary text here: a document must
not be able to write control tokens.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from itertools import chain, compress, islice

import numpy as np

#: Distinct chunks, and characters of them, that an encoder remembers.
KNOWN_CHUNKS = 500_000
KNOWN_CHARS = 16_000_000
#: So many new chunks are encoded in one string.
TOGETHER = 256
#: Longer texts are cut into runs of about so many characters, at ends of chunks.
RUN_CHARS = 1 << 19

#: A blank between two characters that are no white space: there a word ends in either scheme.
_BETWEEN = re.compile(r" (?=\S)(?<=\S )")
#: A blank beside other white space, and white space beyond ASCII.
_SPACES = " \t\n\v\f\r\x1c\x1d\x1e\x1f"
_WIDE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Stands between chunks that are encoded in one string; chunks that hold it are encoded alone.
_MARK = "\x01"
_PLAIN = re.compile(r" ?[^\s\x01](?:[^\x01]*[^\s\x01])?\Z")
#: A blank and a word: where blanks open words, such chunks in a row need nothing between them.
_OPENED = re.compile(r" \S+\Z")
#: How byte-level vocabularies write a blank.
_BLANK = "\u0120"


def blank_chunks(text: str) -> list[str]:
    """For tokenizers that drop white space: what stands between blanks and line ends."""
    return text.replace("\n", " ").split(" ")


#: A mark between a plain letter and a blank: a word ends before it in any scheme that tells marks from letters.
_MARK_BEHIND = re.compile(r"[,.;:!?](?<=[a-z].)(?=[ \n])")


def word_chunks(text: str) -> list[str]:
    """For tokenizers that also lower-case: as blank_chunks, A-Z lower-cased and marks behind words apart.

    There are fewer distinct ones.
    """
    text = text.encode().lower().decode()  # of bytes only A-Z are letters
    return _MARK_BEHIND.sub(r" \g<0>", text).replace("\n", " ").split(" ")


def spaced_chunks(text: str) -> list[str]:
    """For byte-level pre-tokenizers, where one blank opens the word behind it."""
    touching = any(f" {c}" in text or f"{c} " in text for c in _SPACES if c in text)
    alone = not touching and (text.isascii() or not _WIDE.search(text))
    if alone and text[:1] != " " and text[-1:] != " ":  # each blank is between two words
        if "\0" not in text:
            return text.replace(" ", "\0 ").split("\0")
        first, *rest = text.split(" ")
    else:
        first, *rest = _BETWEEN.split(text)
    return [first, *[f" {word}" for word in rest]]


def runs(text: str, chars: int = RUN_CHARS) -> list[str]:
    """The text in runs; each but the first begins with a blank between two words."""
    if len(text) <= chars:
        return [text]
    out, start = [], 0
    while len(text) - start > chars:
        cut = _BETWEEN.search(text, start + chars)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    return [*out, text[start:]]


class _Numbered(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array with room for ``size`` values, copied only now and then."""
    if len(array) >= size:
        return array
    out = np.zeros(max(size, 2 * len(array)), array.dtype)
    out[: len(array)] = array
    return out


class ChunkEncoder:
    """Encodes lists of texts; equal chunks are encoded once."""

    def __init__(self, path: str, chunks: Callable[[str], list[str]]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._chunks = chunks
        vocabulary = self._tokenizer.get_vocab()
        self.largest_id = max(vocabulary.values())
        #: Ids that begin with a blank; none where white space is dropped.
        self._opens = np.zeros(self.largest_id + 1, bool)
        if chunks is spaced_chunks:
            self._opens[[number for token, number in vocabulary.items() if token.startswith(_BLANK)]] = True
        self._in_rows = bool(self._opens.any())
        line_end, mark, *_ = *self._plain(["\n"]), *self._plain([_MARK])
        #: Ids of a line end beside the mark (none where white space is dropped), and the mark's id.
        self._ends, self._mark = len(line_end), int(mark[0])
        self._forget()

    def _forget(self) -> None:
        self._known = _Numbered()
        self._chars = 0
        #: By number of a chunk: where its ids are, how many, how often it came.  With room to grow.
        self._starts = np.zeros(0, np.int64)
        self._sizes = np.zeros(0, np.int64)
        self._uses = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)
        self._filled = 0

    def _thin(self) -> None:
        """Forget the chunks that came once; all of them, if that frees little."""
        kept = np.flatnonzero(self._uses[: len(self._known)] > 1)
        names = list(self._known)
        names = [names[at] for at in kept.tolist()]
        chars = sum(map(len, names))
        if len(kept) > KNOWN_CHUNKS // 2 or chars > KNOWN_CHARS // 2:
            self._forget()
            return
        self._known = _Numbered(zip(names, range(len(names)), strict=True))
        self._chars, self._uses = chars, np.zeros(len(names), np.int64)
        sizes = self._sizes[kept]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        where = np.arange(total) + np.repeat(self._starts[kept] - ends + sizes, sizes)
        self._ids, self._sizes, self._starts = self._ids[where], sizes, ends - sizes
        self._filled = total

    def _plain(self, strings: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _learn(self, fresh: list[str]) -> None:
        """Encode new chunks: plain words many in one string, the others alone.

        Words that a blank opens stand side by side: their first ids begin with it.
        Between two others the mark is a word of its own, and so are the line ends
        around it where the tokenizer keeps them.  The ids stay as they come, marks
        and all; only their places are noted.
        """
        if self._in_rows:
            opened = [at for at, chunk in enumerate(fresh) if _OPENED.match(chunk)]
            rows = [opened[i : i + TOGETHER] for i in range(0, len(opened), TOGETHER)]
            row_ids = self._plain(["".join(map(fresh.__getitem__, row)) for row in rows])
            row_starts = [np.flatnonzero(self._opens[ids]) for ids in row_ids]
            # were a vocabulary to write a blank otherwise, marks would tell
            told = [len(row) == len(starts) for row, starts in zip(rows, row_starts, strict=True)]
            rows, row_ids, row_starts = (list(compress(x, told)) for x in (rows, row_ids, row_starts))
        else:
            rows, row_ids, row_starts = [], [], []
        in_rows = set(chain.from_iterable(rows))
        left = [at for at in range(len(fresh)) if at not in in_rows]
        joined = [at for at in left if _PLAIN.match(fresh[at])]
        alone = sorted(set(left).difference(joined))
        groups = [joined[i : i + TOGETHER] for i in range(0, len(joined), TOGETHER)]
        border = f"\n{_MARK}\n"
        strings = [border.join(["", *map(fresh.__getitem__, group), ""]) for group in groups]
        parts = [*self._plain([*strings, *map(fresh.__getitem__, alone)]), *row_ids]
        count, total = len(self._known), sum(map(len, parts))
        self._starts, self._sizes, self._uses = (
            _grown(array, count) for array in (self._starts, self._sizes, self._uses)
        )
        self._ids = _grown(self._ids, self._filled + total)
        self._ids[self._filled : self._filled + total] = np.concatenate(parts)
        begun = self._filled + np.cumsum([0, *map(len, parts)])
        numbers = count - len(fresh)
        for group, ids, at in zip(groups, parts, begun.tolist(), strict=False):
            marks = np.flatnonzero(ids == self._mark)
            own = np.array(group) + numbers
            self._starts[own] = at + marks[:-1] + 1 + self._ends
            self._sizes[own] = marks[1:] - marks[:-1] - 1 - 2 * self._ends
        if alone:
            own, behind = np.array(alone) + numbers, len(groups) + len(alone)
            self._starts[own] = begun[len(groups) : behind]
            self._sizes[own] = [len(ids) for ids in parts[len(groups) : behind]]
        for row, ids, starts, at in zip(rows, row_ids, row_starts, begun[len(groups) + len(alone) :].tolist(), strict=False):
            own = np.array(row) + numbers
            self._starts[own] = at + starts
            self._sizes[own] = np.diff(starts, append=len(ids))
        self._filled += total
        self._chars += sum(map(len, fresh))

    def _run(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self._known) > KNOWN_CHUNKS or self._chars > KNOWN_CHARS:
            self._thin()
        before = len(self._known)
        pieces = [self._chunks(text) for text in texts]
        counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
        known = np.fromiter(
            map(self._known.__getitem__, chain.from_iterable(pieces)), np.int64, int(counts.sum())
        )
        if len(self._known) > before:
            self._learn(list(islice(self._known, before, None)))
        np.add.at(self._uses, known, 1)
        sizes = self._sizes[known]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        where = np.arange(total) + np.repeat(self._starts[known] - ends + sizes, sizes)
        upto = np.concatenate([[0], ends])
        return self._ids[where], upto[np.concatenate([[0], np.cumsum(counts)])]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, unsigned 32-bit."""
        out: list[np.ndarray] = []
        group: list[str] = []
        size = 0
        for text in texts:
            if len(text) > RUN_CHARS:
                out += self._several(group)
                group, size = [], 0
                out.append(np.concatenate([self._run([part])[0] for part in runs(text)]))
                continue
            group.append(text)
            size += len(text)
            if size > RUN_CHARS:
                out += self._several(group)
                group, size = [], 0
        return out + self._several(group)

    def _several(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        ids, ends = self._run(texts)
        return [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]


_ENCODERS: dict[tuple[str, str], ChunkEncoder] = {}


def encoder(path: str, chunks: Callable[[str], list[str]]) -> ChunkEncoder:
    """The encoder of this Python worker; later tasks find it warm."""
    key = (path, chunks.__name__)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, chunks)
    return _ENCODERS[key]
