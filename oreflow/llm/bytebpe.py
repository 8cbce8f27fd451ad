"""Byte-level BPE by a finite-state transducer, and streaming decode.

The merges of a rank file decide, for any two tokens, whether BPE leaves them side
by side; a row of tokens is the encoding of its bytes exactly if all neighbours may
stand so.  Hence each prefix of a word has one encoding, and a reader that goes
byte by byte has to keep few of them in mind: those whose end a longer token could
still swallow.  What all of these share is output.  A state is therefore the last
token put out and the bytes behind it, at most about a token's length; states and
transitions are worked out when a text first needs them and kept in a table.

Decoding takes tokens in any portions: a state machine over the bytes holds back a
character until its last byte is there.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame

from oreflow.llm.common import slices

#: Bounds of what a worker keeps: transitions, distinct words, characters of them.
TRANSITIONS = 700_000
KNOWN_WORDS = 400_000
KNOWN_CHARS = 12_000_000
#: Texts are worked on in portions of about so many characters.
PORTION = 1 << 19


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with pafs.LocalFileSystem().open_input_stream(path) as stream:
        lines = stream.read().split(b"\n")
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line)}


class Merges:
    """What the ranks say about two tokens side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        #: What some longer token begins with.
        self.openings = {token[:i] for token in ranks for i in range(1, len(token))}
        self._halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self._beside: dict[tuple[bytes, bytes], bool] = {}

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge is this one; None if no merges lead to it."""
        if token not in self._halves:
            parts = [token[i : i + 1] for i in range(len(token))]
            own = self.ranks[token]
            while len(parts) > 2:
                rank, at = min(
                    (self.ranks.get(a + b, own), i)
                    for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
                )
                if rank >= own:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def beside(self, left: bytes, right: bytes) -> bool:
        """Whether BPE leaves the two side by side.

        The merges that made them are undone, the latest first.  Whenever the two
        at the border could have become one before the merge just undone, it would
        have come to that.  Of equal ranks the leftmost goes first.
        """
        pair = (left, right)
        known = self._beside.get(pair)
        if known is not None:
            return known
        if len(self._beside) > TRANSITIONS // 2:
            self._beside.clear()
        ranks, before, stays = self.ranks, len(self.ranks) << 1, True
        while True:
            joint = ranks.get(left + right)
            if joint is not None and joint < before:
                stays = False
                break
            of_left = ranks[left] if len(left) > 1 else -1
            of_right = ranks[right] if len(right) > 1 else -1
            if of_left == of_right == -1:
                break
            if of_left > of_right:
                before, left = of_left, self.halves(left)[1]
            else:
                before, right = of_right + 1, self.halves(right)[0]
        self._beside[pair] = stays
        return stays

    def reachable(self, token: bytes) -> bool:
        return token in self.ranks and (len(token) == 1 or self.halves(token) is not None)


class Transducer:
    """Reads bytes of one word, puts out token ids; states are made when first met."""

    def __init__(self, ranks: dict[bytes, int]):
        if max(map(len, ranks)) > 255:
            raise ValueError("tokens of more than 255 bytes")
        self.merges = Merges(ranks)
        self._forget()

    def _forget(self) -> None:
        #: States are numbered as they are met.  A state's key: length of the last token
        #: put out, that token, the bytes behind it.
        self._numbers: dict[bytes, int] = {}
        #: By number: key; for each place behind, where the token that ends there begins;
        #: the places where a longer token may begin.  Places are kept as bytes if they fit.
        self._states: list[tuple[bytes, bytes | tuple, bytes | tuple]] = []
        #: state << 8 | byte -> number of what is put out << 32 | next state
        self._moves: dict[int, int] = {}
        self._outs: list[tuple[int, ...]] = [()]
        self._out_number: dict[tuple[int, ...], int] = {(): 0}
        self._ends: dict[int, tuple[int, ...]] = {}
        self._number(b"", b"", [0], [])

    def _thin(self) -> None:
        """Forget the later half of the states: those met first are met most often."""
        most = len(self._states) // 2
        if len(self._outs) > TRANSITIONS:
            self._forget()
            return
        for key, _, _ in self._states[most:]:
            del self._numbers[key]
        del self._states[most:]
        self._moves = {k: m for k, m in self._moves.items() if k >> 8 < most and m & 0xFFFFFFFF < most}
        self._ends = {state: ids for state, ids in self._ends.items() if state < most}
        if len(self._moves) > TRANSITIONS * 3 // 4:
            self._forget()

    def _number(self, last: bytes, behind: bytes, begins: list[int], live: list[int]) -> int:
        key = bytes((len(last),)) + last + behind
        number = self._numbers.get(key)
        if number is None:
            number = self._numbers[key] = len(self._states)
            small = bytes if len(begins) < 256 else tuple
            self._states.append((key, small(begins), small(live)))
        return number

    def _ids(self, behind: bytes, begins: Sequence[int], end: int) -> tuple[int, ...]:
        """The tokens of the bytes up to ``end``."""
        out, ranks = [], self.merges.ranks
        while end:
            begin = begins[end]
            out.append(ranks[behind[begin:end]])
            end = begin
        return tuple(out[::-1])

    def _make(self, state: int, byte: int) -> int:
        key, begins, live = self._states[state]
        cut = 1 + key[0]
        last, behind = key[1:cut], key[cut:] + bytes((byte,))
        merges, size = self.merges, len(behind)
        ranks, openings = merges.ranks, merges.openings
        tails = [(at, behind[at:]) for at in live]
        tails.append((size - 1, behind[size - 1 :]))
        # one token ends here that its neighbour lets stand
        for at, token in tails:
            if token in ranks and merges.reachable(token):
                before = behind[begins[at] : at] if at else last
                if not before or merges.beside(before, token):
                    break
        begins = [*begins, at]
        live = [at for at, tail in tails if tail in openings]
        # what the encodings up to each live place and to the end have in common is sure
        cut = size
        if live:
            places = {size, *live}
            while len(places) > 1:
                furthest = max(places)
                places.remove(furthest)
                places.add(begins[furthest])
            cut = places.pop()
        out = self._ids(behind, begins, cut) if cut else ()
        if cut:
            last, behind = behind[begins[cut] : cut], behind[cut:]
            # places that no live encoding passes may begin before the cut; nothing asks them
            begins = [0, *[max(at - cut, 0) for at in begins[cut + 1 :]]]
            live = [at - cut for at in live]
        number = self._out_number.setdefault(out, len(self._outs))
        if number == len(self._outs):
            self._outs.append(out)
        move = number << 32 | self._number(last, behind, begins, live)
        self._moves[state << 8 | byte] = move
        return move

    def encode(self, word: bytes) -> list[int]:
        rank = self.merges.ranks.get(word)
        if rank is not None:
            return [rank]
        if len(self._moves) > TRANSITIONS:
            self._thin()
        out: list[int] = []
        state, find, outs = 0, self._moves.get, self._outs
        for byte in word:
            move = find(state << 8 | byte)
            if move is None:
                move = self._make(state, byte)
            state = move & 0xFFFFFFFF
            if move > state:
                out += outs[move >> 32]
        rest = self._ends.get(state)
        if rest is None:
            key, begins, _ = self._states[state]
            behind = key[1 + key[0] :]
            rest = self._ends[state] = self._ids(behind, begins, len(behind))
        out += rest
        return out


class Utf8Stream:
    """Bytes in any portions to text; bytes that are no UTF-8 become U+FFFD.

    Each longest part of a character that breaks off gives one U+FFFD.
    """

    def __init__(self) -> None:
        self._held = b""  # the beginning of a character
        self._wanted = 0  # bytes it still lacks
        self._low, self._high = 0x80, 0xBF  # where the next one must lie

    @property
    def between(self) -> bool:
        """No character has begun and not ended."""
        return not self._wanted

    def feed(self, portion: bytes) -> str:
        out: list[str] = []
        for byte in portion:
            if self._wanted:
                if self._low <= byte <= self._high:
                    self._held += bytes((byte,))
                    self._wanted -= 1
                    self._low, self._high = 0x80, 0xBF
                    if not self._wanted:
                        out.append(self._held.decode())
                        self._held = b""
                    continue
                out.append(self.end())
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xF4:
                self._held = bytes((byte,))
                self._wanted = 1 + (byte >= 0xE0) + (byte >= 0xF0)
                # no overlong forms, no surrogates, nothing above U+10FFFF
                self._low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
                self._high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        """What is left when no more comes."""
        held, self._held, self._wanted = self._held, b"", 0
        self._low, self._high = 0x80, 0xBF
        return "�" if held else ""


def _whole(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


class Decoder:
    """Token ids to bytes and text."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        #: Tokens that begin and end with a character.
        self._whole = np.array([_whole(token) for token in self.tokens])

    def bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))

    def stream(self, portions: Iterable[np.ndarray]) -> Iterator[str]:
        """Text as it comes, of ids that come in portions."""
        state = Utf8Stream()
        for ids in portions:
            if state.between and self._whole[ids].all():
                yield self.bytes(ids).decode()
                continue
            split = np.flatnonzero(~self._whole[ids])
            text, at = [], 0
            while at < len(ids):
                if state.between:
                    nth = int(np.searchsorted(split, at))
                    until = int(split[nth]) if nth < len(split) else len(ids)
                    text.append(self.bytes(ids[at:until]).decode())
                    at = until
                else:
                    text.append(state.feed(self.tokens[ids[at]]))
                    at += 1
                if at < len(ids) and state.between and nth < len(split):
                    text.append(state.feed(self.tokens[ids[at]]))
                    at += 1
            yield "".join(text)
        yield state.end()


class _Words(dict):
    """Numbers words as they are first met, and notes the new ones."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number


class Codec:
    """Encodes texts, word by word of the pattern; a worker keeps words it has met."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks = read_ranks(path)
        self.transducer = Transducer(self.ranks)
        self.decoder = Decoder(self.ranks)
        self._pattern = regex.compile(pattern)
        self._forget()

    def _forget(self) -> None:
        self._words, self._chars = _Words(), 0
        self._starts = np.zeros(0, np.int64)
        self._sizes = np.zeros(0, np.int64)
        self._flat = np.zeros(0, np.int64)
        self._decimals: list[str] = []
        self._uses = np.zeros(0, np.int64)

    def _thin(self) -> None:
        """Keep the words that came most often, half of what fits at most."""
        names = list(self._words)
        lengths = np.fromiter(map(len, names), np.int64, len(names))
        order = np.argsort(-self._uses, kind="stable")
        order = order[self._uses[order] > 1][: KNOWN_WORDS // 2]
        kept = np.sort(order[np.cumsum(lengths[order]) <= KNOWN_CHARS // 2])
        names = [names[i] for i in kept.tolist()]
        self._words = _Words()
        self._words.update(zip(names, range(len(names)), strict=True))
        self._starts, self._sizes = self._starts[kept], self._sizes[kept]
        ends = np.cumsum(self._sizes)
        total = int(ends[-1]) if len(ends) else 0
        where = np.arange(total) + np.repeat(self._starts - ends + self._sizes, self._sizes)
        self._flat, self._starts = self._flat[where], ends - self._sizes
        self._decimals = [self._decimals[i] for i in kept.tolist()]
        # what was frequent long ago counts less and less
        self._uses = self._uses[kept] // 2
        self._chars = sum(map(len, names))

    def _learn(self) -> None:
        words, self._words.fresh = self._words.fresh, []
        found = [self.transducer.encode(word.encode()) for word in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self._starts = np.concatenate([self._starts, len(self._flat) + np.cumsum(sizes) - sizes])
        self._sizes = np.concatenate([self._sizes, sizes])
        flat = np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))
        self._flat = np.concatenate([self._flat, flat])
        self._decimals += [" ".join(map(str, ids)) for ids in found]
        self._chars += sum(map(len, words))

    def _several(self, lists: list[list[str]]) -> list[tuple[str, np.ndarray]]:
        """(ids as decimals joined by a blank, ids) of each list of words."""
        if len(self._words) > KNOWN_WORDS or self._chars > KNOWN_CHARS:
            self._thin()
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        lookup = map(self._words.__getitem__, chain.from_iterable(lists))
        known = np.fromiter(lookup, np.int64, int(counts.sum()))
        if self._words.fresh:
            self._learn()
        uses = np.bincount(known, minlength=len(self._words))
        uses[: len(self._uses)] += self._uses
        self._uses = uses
        sizes = self._sizes[known]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        where = np.arange(total) + np.repeat(self._starts[known] - ends + sizes, sizes)
        ids = self._flat[where]
        decimals = list(map(self._decimals.__getitem__, known.tolist()))
        words = np.concatenate([[0], np.cumsum(counts)])
        tokens = np.concatenate([[0], ends])[words].tolist()
        words = words.tolist()
        return [
            (" ".join(decimals[words[i] : words[i + 1]]), ids[tokens[i] : tokens[i + 1]])
            for i in range(len(lists))
        ]

    def portions(self, texts: list[str]) -> Iterator[tuple[int, str, np.ndarray]]:
        """(number of the text, decimals, ids): a long text in portions, short ones together."""
        group: list[int] = []
        size = 0
        for at, text in enumerate(texts):
            long_one = len(text) > PORTION
            if group and (long_one or size > PORTION):
                found = self._several([self._pattern.findall(texts[i]) for i in group])
                yield from ((i, *x) for i, x in zip(group, found, strict=True))
                group, size = [], 0
            if long_one:
                words = self._pattern.finditer(text)
                while portion := [m.group() for m in islice(words, PORTION // 4)]:
                    yield at, *self._several([portion])[0]
            else:
                group.append(at)
                size += len(text)
        found = self._several([self._pattern.findall(texts[i]) for i in group])
        yield from ((i, *x) for i, x in zip(group, found, strict=True))

    def encode(self, text: str) -> np.ndarray:
        parts = (ids for _, _, ids in self.portions([text]))
        return np.concatenate([np.zeros(0, np.int64), *parts])

    def decode(self, ids: np.ndarray, portion: int = 1 << 16) -> str:
        return "".join(self.decoder.stream(ids[i : i + portion] for i in range(0, len(ids), portion)))

    def round_trips(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """Tokens, SHA-256 of the ids, SHA-256 of what streaming decode makes of them."""
        found = groupby(self.portions(texts), key=itemgetter(0))
        for _, portions in found:
            of_ids, of_text, counts = hashlib.sha256(), hashlib.sha256(), []

            def read(portions=portions, of_ids=of_ids, counts=counts) -> Iterator[np.ndarray]:
                for _, decimals, ids in portions:
                    of_ids.update(f" {decimals}".encode() if counts else decimals.encode())
                    counts.append(len(ids))
                    yield ids

            for part in self.decoder.stream(read()):
                of_text.update(part.encode())
            yield sum(counts), of_ids.hexdigest(), of_text.hexdigest()


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of this Python worker; later tasks find its tables filled."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encode_documents(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids: the token ids of each whole text.  Null text is empty: no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for first, texts in slices(batch, "text", PORTION):
                ids = pa.array([own.encode(t) for t in texts], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(texts)), ids], names=["doc_id", "ids"]
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, text of rows of ids, by streaming decode.  Null ids give null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            texts = [
                None if ids is None else own.decode(np.array(ids, np.int64))
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each whole text, encoded and decoded.

    One pass, no shuffle.  Null and empty texts have no tokens and the digests of
    nothing.  Each row is its own, also where rows repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for first, texts in slices(batch, "text", PORTION):
                n, of_ids, of_text = zip(*own.round_trips(texts), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(texts)),
                        pa.array(n, pa.int64()),
                        pa.array(of_ids),
                        pa.array(of_text),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
