"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

A prefix of a piece has exactly one encoding, and its last token is the one token that ends
there and may follow the encoding of what stands before it: two tokens may be neighbours when
encoding their joined bytes gives them back. The transducer reads bytes; its state is the set
of positions from which a token may still run on, each with the token that ends there. An arc gives the token
that ends behind its byte. Tokens up to the position that all open ones go back to are settled and leave; the
lookahead is bounded by the longest token. States and arcs are made when first met and kept.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import pieces as pieces_of

MOST_ARCS = 500_000
#: Stretches in each of two generations; what is not met while one fills up is forgotten.
MOST_PIECES = 200_000
CHUNK = 1 << 16
#: Tokens take the lower bits of an arc or an open position, nodes and states those above.
SHIFT = 24
LOW = (1 << SHIFT) - 1

# White space as Unicode defines it.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Stretches no piece of the public pattern crosses: letters and digits up to white space, comma or
#: full stop, a run of other characters, each with the one space before it, or white space. Equal
#: stretches have equal tokens, so they are split only once.
STRETCHES = rf" ?[^\W_]+(?=[,.{_SPACE}]|\Z)| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file of a byte-level vocabulary: base64 of the token's bytes, a space, the rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.next: dict[int, int] = {}
        self.token, self.depth = [-1], [0]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                step = node << 8 | byte
                child = self.next.get(step, 0)
                if not child:
                    child = self.next[step] = len(self.token)
                    self.token.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = child
            self.token[node] = rank
        if max(len(self.token), max(self.bytes, default=0) + 2) > LOW:
            raise ValueError("the vocabulary is too large")
        #: Nodes from which a token goes on.
        self.inner = {step >> 8 for step in self.next}
        self._pairs: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._reset()

    def _reset(self) -> None:
        # The root, with no token before it.
        start = (0,)
        self.states = [start]
        self.numbers = {start: 0}
        self.arcs: dict[int, int] = {}

    def merged(self, piece: bytes, until: int = 1) -> list[int]:
        """Plain merging, lowest rank first, down to ``until`` parts; for the few bytes of a token or two."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > until:
            best, where = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, where = rank, i
            if best is None:
                break
            parts[where:where + 2] = [parts[where] + parts[where + 1]]
        return [self.ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens merged last into ``token``; None for a single byte, or if merging does not arrive at it."""
        known = self._halves.get(token, 0)
        if known == 0:
            whole = self.bytes[token]
            parts = self.merged(whole, 2) if len(whole) > 1 else []
            known = self._halves[token] = tuple(parts) if len(parts) == 2 else None
        return known

    def may_follow(self, before: int, token: int) -> bool:
        key = (before + 1) << SHIFT | token
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) > MOST_ARCS:
                self._pairs.clear()
            known = self._pairs[key] = self._reached(token) and (before < 0 or self._stay_apart(before, token))
        return known

    def _reached(self, token: int) -> bool:
        return self.length[token] == 1 or self.halves(token) is not None

    def _stay_apart(self, left: int, right: int) -> bool:
        """No merge across the border comes before those that make up ``left`` and ``right``.

        The last tokens to appear at the border are taken apart first, the one with the higher rank, at equal ranks the
        right one; a merge of the two that stood there before must have come later than what was taken apart. Merging
        takes equal ranks from the left, so a merge across the border at the rank of a merge right of it comes first.
        """
        ranks, names = self.ranks, self.bytes
        limit = LOW
        while True:
            joined = ranks.get(names[left] + names[right])
            if joined is not None and joined < limit:
                return False
            parts_left, parts_right = self.halves(left), self.halves(right)
            if parts_left is not None and (parts_right is None or left > right):
                limit, left = left, parts_left[1]
            elif parts_right is not None:
                limit, right = right + 1, parts_right[0]
            else:
                return True

    def _arc(self, state: int, byte: int) -> int:
        grown, ending = [], -1
        step, token_of, inner = self.next.get, self.token, self.inner
        for place in self.states[state]:
            node = step(place >> SHIFT << 8 | byte)
            if node:
                if ending < 0 and token_of[node] >= 0 and self.may_follow((place & LOW) - 1, token_of[node]):
                    ending = token_of[node]
                if node in inner:
                    grown.append(node << SHIFT | place & LOW)
        if ending < 0:
            raise ValueError("a byte is missing in the vocabulary")
        grown.append(ending + 1)
        after = tuple(grown)
        number = self.numbers.get(after)
        if number is None:
            number = self.numbers[after] = len(self.states)
            self.states.append(after)
        found = self.arcs[state << 8 | byte] = number << SHIFT | ending
        return found

    def _back(self, ends: list[int], at: int) -> list[int]:
        """The tokens up to a position, from those that end at each."""
        found, length = [], self.length
        while at:
            token = ends[at - 1]
            found.append(token)
            at -= length[token]
        found.reverse()
        return found

    def _settled(self, ends: list[int], state: int) -> int:
        """The position that all open ones go back to."""
        open_ = {len(ends) - self.depth[place >> SHIFT] for place in self.states[state]}
        while len(open_) > 1:
            last = max(open_)
            open_.remove(last)
            open_.add(last - self.length[ends[last - 1]])
        return open_.pop()

    def encode(self, piece: bytes) -> list[int]:
        """The tokens of one piece."""
        if len(self.arcs) > MOST_ARCS:
            self._reset()
        arcs = self.arcs
        state, tokens, ends = 0, [], []
        for byte in piece:
            found = arcs.get(state << 8 | byte)
            if found is None:
                if len(arcs) > 2 * MOST_ARCS:  # within one very long piece: keep only where we are
                    here = self.states[state]
                    self._reset()
                    arcs = self.arcs
                    state = self.numbers.setdefault(here, len(self.states))
                    if state == len(self.states):
                        self.states.append(here)
                found = self._arc(state, byte)
            state = found >> SHIFT
            ends.append(found & LOW)
            if len(ends) >= CHUNK:
                at = self._settled(ends, state)
                tokens += self._back(ends, at)
                del ends[:at]
        return tokens + self._back(ends, len(ends))


class Utf8Stream:
    """Token bytes in, bytes of complete characters out; the state is the unfinished character.

    What can never become valid UTF-8 is passed on as it is: the output's bytes are the input's.
    """

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many bytes at the end begin a character that more bytes may complete."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                need = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4 if byte < 0xF8 else 1
                return back if need > back else 0
            if byte < 0x80:
                return 0
        return 0

    def decode(self, chunks: Iterable[list[int]]) -> Iterator[bytes]:
        state = b""
        for ids in chunks:
            data = state + b"".join(map(self.tokens.__getitem__, ids))
            cut = len(data) - self.unfinished(data)
            state = data[cut:]
            yield data[:cut]
        yield state


class Kept(dict):
    """Packed tokens of stretches met lately; clearing keeps one older generation."""

    def __init__(self):
        super().__init__()
        self.old: dict[str, bytes] = {}

    def clear(self) -> None:
        self.old = dict(self)
        super().clear()


class Vocabulary:
    """Ranks to broadcast. What a worker process builds of them lives as long as its copy."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __getstate__(self) -> dict:
        return {"ranks": self.ranks}

    @cached_property
    def machine(self) -> Transducer:
        return Transducer(self.ranks)

    @cached_property
    def stream(self) -> Utf8Stream:
        return Utf8Stream({rank: token for token, rank in self.ranks.items()})

    @cached_property
    def kept(self) -> Kept:
        return Kept()


def packed(machine: Transducer, stretches, pieces, kept: dict[str, bytes], text: str) -> bytes:
    """Token ids of a text as little-endian unsigned 32-bit integers."""
    out = []
    for stretch in stretches(text):
        found = kept.get(stretch)
        if found is None:
            found = kept.old.get(stretch) if isinstance(kept, Kept) else None
            if found is None:
                ids = [i for piece in pieces(stretch) for i in machine.encode(piece.encode())]
                found = array("I", ids).tobytes()
            if len(stretch) < 64:
                if len(kept) >= MOST_PIECES:
                    kept.clear()
                kept[stretch] = found
        out.append(found)
    return b"".join(out)


def chunks(ids: bytes) -> Iterator[list[int]]:
    """Packed ids as lists of bounded length."""
    view = np.frombuffer(ids, "<u4")
    for at in range(0, len(view), CHUNK):
        yield view[at:at + CHUNK].tolist()


def _decode(stream: Utf8Stream, ids: bytes | None) -> bytes | None:
    return None if ids is None else b"".join(stream.decode(chunks(ids)))


def _encoded(vocabulary, pattern: str, stretches: str | None, names: list[str], both: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        pieces = regex.compile(pattern).findall
        whole = re.compile(stretches).findall if stretches else pieces
        for batch in pieces_of(batches, "text"):
            ids = [packed(known.machine, whole, pieces, known.kept, t.as_py() or "") for t in batch.column("text")]
            columns = [*(batch.column(n) for n in names), pa.array(ids, pa.binary())]
            if both:
                columns.append(pa.array([_decode(known.stream, x) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, [*names, "ids", "decoded"][:len(columns)])

    return run


def _decoded(vocabulary, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = vocabulary.value.stream
        for batch in pieces_of(batches, "ids"):
            texts = [_decode(stream, x.as_py()) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.binary())],
                                             [*names, "decoded"])

    return run


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def encode(df: DataFrame, vocabulary, pattern: str, stretches: str | None = STRETCHES, text: str = "text",
           keep: tuple[str, ...] = (), decoded: bool = False) -> DataFrame:
    """The columns ``keep`` and ``ids``: the token ids as little-endian unsigned 32-bit integers.

    ``vocabulary`` is a broadcast of a :class:`Vocabulary`, whose size its file bounds. Each
    match of ``pattern`` is encoded by itself. ``stretches`` finds parts of a text that matches
    never cross (None: do without). With ``decoded`` the ids are decoded again in the same pass,
    as :func:`decode` does. NULL is encoded as the empty text, without tokens. Repeated rows
    stay; an empty table gives an empty result; only ``keep`` is carried along, under its own
    names.
    """
    kept = df.select(*(F.col(f"`{c}`") for c in keep))
    rows = df.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)), F.col(f"`{text}`").alias("text"))
    names = [f"c{i}" for i in range(len(keep))]
    made = ["ids", "decoded"] if decoded else ["ids"]
    schema = ", ".join([f"{n} {f.dataType.simpleString()}" for n, f in zip(names, kept.schema.fields)]
                       + [f"{n} binary" for n in made])
    out = rows.mapInArrow(_encoded(vocabulary, pattern, stretches, names, decoded), schema)
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), *made)


def decode(df: DataFrame, vocabulary, ids: str = "ids") -> DataFrame:
    """All columns and ``decoded``, the bytes of the ids; NULL ids give NULL."""
    rest = [c for c in df.columns if c not in (ids, "decoded")]
    names = [f"c{i}" for i in range(len(rest))] + ["ids"]
    rows = df.select(*(F.col(f"`{c}`").alias(n) for c, n in zip([*rest, ids], names)))
    out = rows.mapInArrow(_decoded(vocabulary, names), _ddl(rows) + ", decoded binary")
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, [*rest, ids])), "decoded")
