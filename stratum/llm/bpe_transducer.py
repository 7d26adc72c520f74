"""Byte-level BPE as a lazily determinised finite-state transducer, and its streaming decoder (operator 12).

Encoding.  Merging by rank gives every prefix of a match one encoding, and
that of a prefix is the encoding of a shorter prefix and one more token which
may stand after its last one (two tokens may stand together if merging their
joined bytes gives just these two; the parts that each has at the border
while it is merged are listed once a token and tell).  So a state needs no more than the places
where a token can still be under way: for each, the node of its bytes in the
trie of the vocabulary, and the last token before it.  Reading a byte moves
every place on, drops those that leave the trie, and opens one new place
behind the one token that fits.  A place lives no longer than the longest
token, so the lookahead is bounded: every ``LOOK`` bytes, and at the end, the
tokens that the encodings before all places have in common go out.  States
and moves are made when a text first needs them and kept up to
``max_states``; ids do not depend on that.

Matches of the pattern are encoded separately.  A text is first cut before
each white space that follows something else, where no match can go on, and
the ids of such chunks, and of the matches in those of several, are kept up to
``max_cache``; a text with white space beyond ASCII is matched whole.

Decoding.  A token that is valid UTF-8 by itself is passed on as it is; any
other goes byte by byte through the UTF-8 state machine, whose state (the
bytes of an unfinished character) stays between calls of ``feed``.  Bytes
that are no character give U+FFFD, for each longest start of a character one.

``encoded_documents`` returns a row for each document: ``doc_id``,
``n_tokens``, ``ids_sha256`` (of the ids as little-endian unsigned 32-bit
numbers), ``decoded_sha256`` (of the bytes decoded from the ids).  A null
text counts as empty; an empty one has no tokens; a null or repeated
``doc_id`` is returned as it is, a row for each; an empty table gives no
rows; other columns are not read, of whatever names.  One narrow map: nothing
is shuffled, and a lost executor repeats its own files only.
"""

from __future__ import annotations

import base64
import hashlib
import re
import string
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate, islice
from operator import getitem

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Chunks: white space and what follows it, cut where white space follows something else.
_CHUNK = re.compile(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: White space of the pattern beyond ASCII.
_WIDE_SPACE = re.compile("[" + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]")

#: Marks that are cached apart behind a letter, where a match ends, so that a word before them goes through the transducer once.
_MARKS = string.punctuation.encode()

REPLACEMENT = chr(0xFFFD)
LOOK = 64
#: Above all ranks.
NEVER = 1 << 62
BLOCK = 8192


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Node(dict):
    """A node of the trie: byte -> node behind it, the token that ends here, and how many bytes it has."""

    __slots__ = ("token", "depth")
    __hash__, __eq__ = object.__hash__, object.__eq__

    def __init__(self, depth: int):
        self.token, self.depth = None, depth


class State(dict):
    """Its places, the latest last: (node in the trie, last token before the place).  Moves (byte -> state) are made once and kept."""

    __slots__ = ("transducer", "places", "last", "length")

    def __missing__(self, byte: int) -> State:
        move = self[byte] = self.transducer._move(self, byte)
        return move


class Transducer:
    """Bytes of one match -> ids."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 200_000):
        self.ranks = ranks
        self.max_states = max_states
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.root = Node(0)
        for token, rank in ranks.items():
            node = self.root
            for depth, b in enumerate(token, 1):
                child = node.get(b)
                if child is None:
                    child = node[b] = Node(depth)
                node = child
            node.token = rank
        self.ends: dict[int, tuple[list, list] | None] = {}
        self.states: dict[tuple, State] = {}
        self._start_anew()

    def _start_anew(self) -> None:
        for state in self.states.values():
            state.clear()  # states refer to each other
        self.states = {}
        self.start = self._state(((self.root, None),))

    def _state(self, places: tuple) -> State:
        state = self.states.get(places)
        if state is None:
            state = self.states[places] = State()
            state.transducer, state.places, state.last = self, places, places[-1][1]
            state.length = 0 if state.last is None else len(self.bytes_of[state.last])
        return state

    def _may_follow(self, before: int | None, token: int) -> bool:
        """Whether merging the joined bytes of the two gives just the two.

        Until something is merged across their border each is merged as if it stood alone, the lower rank of
        the next merges in both first, the left one of equals; so only the parts at the border are looked at.
        """
        right = self.ends[token] if token in self.ends else self._ends(token)
        if right is None or before is None:
            return right is not None
        left = self.ends[before] if before in self.ends else self._ends(before)
        if left is None:
            return False
        rank_of, lefts, rights = self.ranks.get, iter(left[1]), iter(right[0])
        (a, next_left), (b, next_right) = next(lefts), next(rights)
        while True:
            across = rank_of(a + b)
            if across is not None and across < next_left and across <= next_right:
                return False
            if next_left <= next_right:
                if next_left == NEVER:
                    return True
                a, next_left = next(lefts)
            else:
                b, next_right = next(rights)

    def _ends(self, token: int) -> tuple[list, list] | None:
        """The first parts, and the last parts, that a token has while its bytes are merged, each with the rank of the merge that ends it.

        None if merging does not give the token.  Where a later merge has a lower rank than an earlier one, every merge is listed.
        """
        whole, firsts, lasts, merges = self.bytes_of[token], [], [], []
        cuts = list(range(len(whole) + 1))
        while len(cuts) > 2:
            rank, at = min((self.ranks.get(whole[cuts[i] : cuts[i + 2]], NEVER), i + 1) for i in range(len(cuts) - 2))
            if rank == NEVER:
                self.ends[token] = None
                return None
            firsts.append((whole[: cuts[1]], rank, at == 1))
            lasts.append((whole[cuts[-2] :], rank, at == len(cuts) - 2))
            merges.append(rank)
            del cuts[at]
        rising = all(x <= y for x, y in zip(merges, merges[1:]))
        ends = tuple([(part, rank) for part, rank, changes in side if changes or not rising] + [(whole, NEVER)] for side in (firsts, lasts))
        self.ends[token] = ends
        return ends

    def _move(self, state: State, byte: int) -> State:
        places, fitting = [], None
        for node, before in state.places:
            child = node.get(byte)
            if child is None:
                continue
            if child:
                places.append((child, before))
            if fitting is None and child.token is not None and self._may_follow(before, child.token):
                fitting = child.token
        if fitting is None:
            raise ValueError("the vocabulary lacks a single byte")
        places.append((self.root, fitting))
        return self._state(tuple(places))

    @staticmethod
    def _back(path: list[State], place: int, to: int) -> list[tuple[int, int]]:
        """(start, token) of the tokens between two places, the last first.  ``path``: the state at each place."""
        out = []
        while place > to:
            state = path[place]
            place -= state.length
            out.append((place, state.last))
        return out

    def encode(self, match: bytes) -> list[int]:
        if len(self.states) > self.max_states:
            self._start_anew()
        if len(match) < LOOK:
            path, out, place = list(accumulate(match, getitem, initial=self.start)), [], len(match)
            while place:
                state = path[place]
                out.append(state.last)
                place -= state.length
            out.reverse()
            return out
        out, path = [], [self.start]  # path[i]: state at the place i bytes behind the start of what has not gone out
        for at in range(0, len(match), LOOK):
            block = match[at : at + LOOK]
            path += islice(accumulate(block, getitem, initial=path[-1]), 1, None)
            if len(block) == LOOK:
                # what the encodings before all places have in common goes out
                n = len(path) - 1
                places = path[-1].places
                ways = [self._back(path, n - node.depth, 0) for node, _ in places]
                common = set.intersection(*({n - node.depth, *(x for x, _ in way)} for way, (node, _) in zip(ways, places, strict=True)))
                if cut := max(common, default=0):
                    out += [token for start, token in reversed(ways[-1]) if start < cut]
                    path = path[cut:]
                if len(self.states) > 2 * self.max_states:  # within one very long match
                    self._start_anew()
                    path[-1] = self._state(places)
        out += [token for _, token in reversed(self._back(path, len(path) - 1, 0))]
        return out


class Encoder(dict):
    """Whole texts -> ids, four bytes each; a cache chunk -> ids that fills itself.

    What was used since the cache was last full, and what was used in the
    round before, is kept (``max_cache`` chunks each).
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_cache: int = 300_000, longest: int = 64):
        import regex

        self.transducer = Transducer(ranks)
        self.matches = regex.compile(pattern).findall
        self.max_cache = max_cache
        self.longest = longest  # longer chunks are not kept
        self.before: dict[bytes, bytes] = {}

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.before.get(chunk)
        if ids is None:
            stem = chunk.rstrip(_MARKS)
            if len(stem) < len(chunk) and stem[-1:].isalpha():
                ids = self[stem] + self[chunk[len(stem) :]]  # a match ends between a letter and such marks
            elif stem[1:].isalpha() and (stem[0] == 32 or stem[:1].isalpha()):
                ids = self._transduced(chunk)  # one match: letters, perhaps behind a space
            else:
                matches = self.matches(chunk.decode("utf-8"))
                ids = self._transduced(chunk) if len(matches) == 1 else self._joined(matches)
        if len(chunk) <= self.longest:
            if len(self) >= self.max_cache:
                self.before = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def _transduced(self, match: bytes) -> bytes:
        return array("I", self.transducer.encode(match)).tobytes()

    def _joined(self, matches: list[str]) -> bytes:
        """Each match by itself is one match, too, so the cache has its ids."""
        return b"".join([self[m.encode("utf-8")] for m in matches])

    def encode(self, text: str) -> bytes:
        data = text.encode("utf-8", "replace")
        if not text.isascii() and _WIDE_SPACE.search(text):
            return self._joined(self.matches(data.decode("utf-8")))
        return b"".join(map(self.__getitem__, _CHUNK.findall(data)))


def _lead(byte: int) -> tuple[int, int, int] | None:
    """Of a character's first byte: how many bytes follow, and the bounds of the next; none if no character starts so."""
    if byte < 0x80:
        return 0, 0, 0
    if 0xC2 <= byte < 0xE0:
        return 1, 0x80, 0xBF
    if 0xE0 <= byte < 0xF0:
        return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
    if 0xF0 <= byte < 0xF5:
        return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
    return None


class Vocabulary:
    """Bytes of each id, and which of them are valid UTF-8 by themselves."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.whole = np.array([_is_whole(t) for t in self.bytes_of])


def _is_whole(token: bytes) -> bool:
    try:
        token.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


class StreamingDecoder:
    """``feed`` ids in any portions; ``finish`` ends the text."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.held = bytearray()  # of an unfinished character
        self.wanted, self.least, self.most = 0, 0, 0

    def feed(self, ids: np.ndarray) -> str:
        bytes_of, out, at = self.vocabulary.bytes_of, [], 0
        odd = np.flatnonzero(~self.vocabulary.whole[ids]).tolist()
        if not odd and not self.held:
            return b"".join(map(bytes_of.__getitem__, ids.tolist())).decode("utf-8")
        if self.held:
            odd = [0, *odd] if len(ids) and odd[:1] != [0] else odd
        for first in odd:
            if first < at:
                continue
            out.append(b"".join(map(bytes_of.__getitem__, ids[at:first].tolist())).decode("utf-8"))
            at = first
            while at < len(ids) and (at == first or self.held):  # until a character ends with a token
                out.append(self._step(bytes_of[ids[at]]))
                at += 1
        out.append(b"".join(map(bytes_of.__getitem__, ids[at:].tolist())).decode("utf-8"))
        return "".join(out)

    def _step(self, data: bytes) -> str:
        out = []
        for byte in data:
            if self.held:
                if self.least <= byte <= self.most:
                    self.held.append(byte)
                    self.wanted, self.least, self.most = self.wanted - 1, 0x80, 0xBF
                    if not self.wanted:
                        out.append(self.held.decode("utf-8"))
                        self.held.clear()
                    continue
                out.append(REPLACEMENT)
                self.held.clear()
            lead = _lead(byte)
            if lead is None:
                out.append(REPLACEMENT)
            elif lead[0]:
                self.held.append(byte)
                self.wanted, self.least, self.most = lead
            else:
                out.append(chr(byte))
        return "".join(out)

    def finish(self) -> str:
        left, self.held = bool(self.held), bytearray()
        return REPLACEMENT * left


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@lru_cache(maxsize=2)
def codec(path: str) -> tuple[Encoder, Vocabulary]:
    """One encoder, and so one set of states, for each worker process."""
    import public_tokenizers

    ranks = read_ranks(path)
    return Encoder(ranks, public_tokenizers.PATTERN), Vocabulary(ranks)


def decoded_parts(ids: np.ndarray, vocabulary: Vocabulary, block: int = BLOCK) -> Iterator[str]:
    """The text of the ids, decoded in portions of ``block`` ids."""
    decoder = StreamingDecoder(vocabulary)
    for at in range(0, len(ids), block):
        yield decoder.feed(ids[at : at + block])
    yield decoder.finish()


def encoded_texts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id`` and its ``ids`` (array of int) for each row."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                packed = [encoder.encode(t or "") for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
                ids = np.frombuffer(b"".join(packed), dtype="<i4")
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encoded_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Digests of each document's ids and of what they decode to; see the module's docstring."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, words = codec(path)
        for batch in batches:
            counts, digests, texts = [], [], []
            for text in batch.column(1):
                packed = encoder.encode(text.as_py() or "")
                ids, decoded = np.frombuffer(packed, dtype="<u4"), hashlib.sha256()
                for part in decoded_parts(ids, words):
                    decoded.update(part.encode("utf-8"))
                counts.append(len(ids))
                digests.append(hashlib.sha256(packed).hexdigest())
                texts.append(decoded.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, RESULT)
