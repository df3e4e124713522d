"""Byte-level BPE encoding and decoding with finite-state machines.

Encoding. A sequence of tokens is the BPE encoding of its bytes exactly if every neighbouring pair is *stable*: merging the
bytes of the two alone gives the two back. So encoding is a path through a transducer whose states are "last token, part of the
next one". Read as it stands that transducer is non-deterministic; `MergeTransducer` determinises it lazily: a state is the set
of live hypotheses. Every prefix of a text has one encoding, so one token at most can end at each byte. No hypothesis outlives the
longest token, which bounds the lookahead: tokens are put out once all live hypotheses agree on them. States and transitions are
made when text first needs them, up to a fixed number; a pre-token that leads beyond those is finished by searching the transducer itself.
What a task remembers is bounded in bytes, whatever the script of the text: Spark keeps its Python workers, and they keep it.

Decoding. `Utf8Decoder` is the UTF-8 automaton, run over whole tokens: the transition of (state, token) is worked out byte by byte
once and remembered. Its input may be cut anywhere between tokens.

Defined results. A null text counts as empty: no ids, empty text. Ids outside the vocabulary raise an error, and so does a null
id. Bytes that are not UTF-8 decode to U+FFFD (one per maximal bad part); the bytes of an encoded text always are. Repeated rows and equal texts
are encoded alike; an empty table gives an empty table. Extra columns are carried along unless they have the name of an output
column: that raises an error.
"""

from __future__ import annotations

import base64
import gc
import re
from array import array
from collections.abc import Iterable, Iterator
from pathlib import Path
from sys import getsizeof

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from barloom.llm.common import map_batches, strings

#: Fixed value: a usual pre-tokenising pattern. In text without characters above 127 it means the second one, which the standard
#: module matches faster.
USUAL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"

_MACHINES: dict[str, MergeTransducer] = {}
_DECODERS: dict[str, Utf8Decoder] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with one `base64 rank` pair a line."""
    pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class MergeTransducer:
    """Lazily determinised transducer from bytes to token ids. ``max_states``, ``max_words`` and ``max_bytes`` bound its memory, not its
    results: states, and pre-tokens remembered in one of two generations, by their number and by the bytes of their objects.
    """

    #: Bytes of one pre-token after which the tokens that are certain are put out.
    FLUSH = 4096

    def __init__(self, ranks: dict[bytes, int], max_states: int = 10_000, max_words: int = 250_000, max_bytes: int = 40 << 20) -> None:
        self.ranks, self.max_states, self.max_words, self.max_bytes = ranks, max_states, max_words, max_bytes
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self._compile()
        #: Prefixes of tokens: the token that is the whole prefix, if it can come out of merging, else -1.
        self.trie = {token[:n]: -1 for token in ranks for n in range(1, len(token) + 1)}
        self.trie |= {token: rank for token, rank in ranks.items() if rank in self.left_edge}
        self.words: dict[str, bytes] = _Memo(self)
        self.fits: dict[int, bool] = {}
        self.states: dict[tuple, int] = {}
        self.open: list[tuple] = []
        self.steps: dict[int, tuple[int, int]] = {}
        self._state(((-1, b""),))

    def _compile(self) -> None:
        """Which pairs merge, and for each token what stands at its two edges while its own bytes are being merged."""
        self.pairs: dict[int, int] = {}
        self.left_edge: dict[int, tuple[tuple[int, float], ...]] = {}
        self.right_edge: dict[int, tuple[tuple[int, float], ...]] = {}
        ranks, never = self.ranks, float("inf")
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            for n in range(1, len(token)):
                left, right = ranks.get(token[:n]), ranks.get(token[n:])
                if left is not None and right is not None:
                    self.pairs[left << 32 | right] = rank
            whole = (rank, never)
            if len(token) == 1:
                self.left_edge[rank] = self.right_edge[rank] = (whole,)
                continue
            # A token's last merge joins two tokens of lower rank that are stable side by side; there is one such pair or none.
            for n in range(1, len(token)):
                left, right = ranks.get(token[:n], rank), ranks.get(token[n:], rank)
                if left < rank and right < rank and left in self.left_edge and right in self.left_edge:
                    if self._stable(left, right, rank):
                        self.left_edge[rank] = (*self.left_edge[left][:-1], (left, rank), whole)
                        self.right_edge[rank] = (*self.right_edge[right][:-1], (right, rank), whole)
                        break

    def _stable(self, left: int, right: int, before: float = float("inf")) -> bool:
        """Whether no merge of rank below ``before`` crosses the border between two tokens while each of them grows.

        An edge lists what stands at the border and the rank of the merge that replaces it. Of two merges of one rank the left
        one comes first.
        """
        ours, theirs, i, j = self.right_edge[left], self.left_edge[right], 0, 0
        while True:
            (x, until_x), (y, until_y) = ours[i], theirs[j]
            crossing = self.pairs.get(x << 32 | y)
            if crossing is not None and crossing < until_x and crossing <= until_y and crossing < before:
                return False
            if until_x <= until_y:
                if i + 1 == len(ours):
                    return True
                i += 1
            else:
                j += 1

    def _state(self, live: tuple) -> int:
        """Number of the state that stands for a set of (last whole token, bytes of the next one so far), longest first."""
        number = self.states.get(live)
        if number is None:
            number = self.states[live] = len(self.open)
            self.open.append(live)
        return number

    def _fits(self, last: int, token: int) -> bool:
        """Whether a token may follow another one (-1: the beginning)."""
        if last < 0:
            return True
        pair = last << 32 | token
        fit = self.fits.get(pair)
        if fit is None:
            if len(self.fits) >= self.max_states * 20:
                self.fits.clear()
            fit = self.fits[pair] = self._stable(last, token)
        return fit

    def _step(self, state: int, byte: bytes) -> tuple[int, int]:
        """The state after one more byte, and the one token that can end there."""
        live, ended = [], -1
        for last, part in self.open[state]:
            part += byte
            token = self.trie.get(part)
            if token is None:
                continue
            live.append((last, part))
            if token >= 0 and ended < 0 and self._fits(last, token):
                ended = token
        live.append((ended, b""))
        return self._state(tuple(live)), ended

    def _search(self, piece: bytes, at: int, last: int) -> list[int]:
        """The path from ``at`` to the end, longest tokens first. A place is left for good once nothing leads on from it."""
        trie, fits, size, dead = self.trie, self.fits, self.size, set()
        path: list[tuple[int, int, list[int]]] = []
        begin, end = at, len(piece)
        while True:
            choices = []
            for stop in range(at + 1, end + 1):
                token = trie.get(piece[at:stop])
                if token is None:
                    break
                if token >= 0:
                    choices.append(token)
            while True:
                if choices:
                    token = choices.pop()
                    to = at + size[token]
                    if to not in dead:
                        fit = last < 0 or fits.get(last << 32 | token)
                        if fit or fit is None and self._fits(last, token):
                            break
                elif at == begin:
                    raise ValueError("the vocabulary does not cover all bytes")
                else:
                    dead.add(at)
                    at, last, choices = path.pop()
            path.append((at, last, choices))
            if to == end:
                return [*(token for _, token, _ in path[1:]), token]
            at, last = to, token

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        out: list[int] = []
        ends: list[int] = []  # ends[i]: the token that ends after byte i of what is not put out yet
        state, steps, flush = 0, self.steps, self.FLUSH
        for at, byte in enumerate(piece):
            step = steps.get(state << 8 | byte)
            if step is None:
                if len(self.open) >= self.max_states:
                    done = at - len(ends)
                    return out + self._search(piece, done, out[-1] if out else -1)
                step = steps[state << 8 | byte] = self._step(state, bytes((byte,)))
            state, end = step
            ends.append(end)
            if at >= flush and len(ends) >= flush:
                out += self._certain(ends, [len(part) for _, part in self.open[state]])
        return out + self._back(ends, len(ends))

    def _back(self, ends: list[int], at: int) -> list[int]:
        found = []
        while at:
            found.append(ends[at - 1])
            at -= self.size[found[-1]]
        return found[::-1]

    def _certain(self, ends: list[int], open_bytes: list[int]) -> list[int]:
        """Take off ``ends`` the tokens on which all live hypotheses agree."""
        paths = [self._back(ends, len(ends) - n) for n in open_bytes]
        agreed = 0
        while agreed < min(map(len, paths)) and len({path[agreed] for path in paths}) == 1:
            agreed += 1
        del ends[: sum(self.size[token] for token in paths[0][:agreed])]
        return paths[0][:agreed]


class _Memo(dict):
    """Ids (as packed integers) of pre-tokens met before, in two generations: what is not asked for again while a
    generation fills is forgotten. A word is in one generation at a time.
    """

    #: Bytes of a word's place in the table.
    PLACE = 48

    def __init__(self, machine: MergeTransducer) -> None:
        super().__init__()
        self.machine = machine
        self.older: dict[str, bytes] = {}
        self.held = 0

    def __missing__(self, word: str) -> bytes:
        ids = self.older.pop(word, None)
        if ids is None:
            ids = array("i", self.machine.encode(word.encode())).tobytes()
        if len(word) <= 64:
            if len(self) >= self.machine.max_words or self.held >= self.machine.max_bytes:
                self.older = dict(self)
                self.clear()
                self.held = 0
            self[word] = ids
            self.held += getsizeof(word) + getsizeof(ids) + self.PLACE
        return ids


def _next_state(state: tuple[int, int, int], byte: int) -> tuple[int, int, int] | None:
    """One step of the UTF-8 automaton. State: continuation bytes missing, least and greatest value of the next byte."""
    missing, low, high = state
    if missing:
        return (missing - 1, 0x80, 0xBF) if low <= byte <= high else None
    if byte < 0x80:
        return (0, 0, 0)
    if 0xC2 <= byte <= 0xDF:
        return (1, 0x80, 0xBF)
    if 0xE0 <= byte <= 0xEF:
        return (2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF)
    if 0xF0 <= byte <= 0xF4:
        return (3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF)
    return None


class Utf8Decoder:
    """Incremental decoder of token ids; between tokens it keeps at most three bytes of an unfinished character."""

    START = (0, 0, 0)

    def __init__(self, tokens: dict[int, bytes], max_steps: int = 400_000) -> None:
        self.tokens, self.max_steps = tokens, max_steps
        self.steps: dict[tuple, tuple[tuple, str]] = {}
        #: Text of the tokens that begin and end between characters; None for the others.
        self.whole: list[str | None] = [None] * (max(tokens, default=-1) + 1)
        for token in tokens:
            (state, pending), text = self._step((self.START, b""), token)
            if state == self.START and not pending and "�" not in text:
                self.whole[token] = text
        self.whole_array = pa.array(self.whole, pa.string())

    def _step(self, at: tuple, token: int) -> tuple[tuple, str]:
        state, pending = at
        out: list[str] = []
        for byte in self.tokens[token]:
            following = _next_state(state, byte)
            if following is None and pending:  # the unfinished character is bad; this byte may begin another
                out.append("�")
                pending, following = b"", _next_state(self.START, byte)
            if following is None:
                out.append("�")
                state, pending = self.START, b""
                continue
            state, pending = following, pending + bytes((byte,))
            if not state[0]:
                out.append(pending.decode())
                state, pending = self.START, b""
        return (state, pending), "".join(out)

    def stream(self, chunks: Iterable[Iterable[int]]) -> Iterator[str]:
        """Text of each chunk of ids as far as its characters are finished, and at last what was left unfinished."""
        clean: tuple = (self.START, b"")
        at, whole = clean, self.whole
        for chunk in chunks:
            out = []
            for token in chunk:
                text = whole[token] if at is clean and token >= 0 else None
                if text is not None:
                    out.append(text)
                    continue
                step = self.steps.get((at, token))
                if step is None:
                    if len(self.steps) >= self.max_steps:
                        self.steps.clear()
                    step = self.steps[at, token] = self._step(at, token)
                at = clean if step[0] == clean else step[0]
                out.append(step[1])
            yield "".join(out)
        if at[1]:
            yield "�"

    def decode(self, ids: list[int]) -> str:
        if ids and min(ids) < 0:
            raise ValueError(f"not a token id: {min(ids)}")
        whole = self.whole
        try:
            return "".join([whole[i] for i in ids])
        except TypeError:  # a character is spread over tokens
            return "".join(self.stream((ids,)))


    def decode_all(self, lists: pa.ListArray) -> list[str]:
        """Texts of many sequences (null: empty). Those of whole tokens alone are put together at once; the others are streamed."""
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())).astype(np.int32)), lists.flatten())
        values, bounds = lists.values, lists.offsets.to_numpy()
        if values.null_count:
            raise ValueError("a token id is null")
        pieces = self.whole_array.take(values)  # raises for an id that the vocabulary lacks
        spread = np.append(0, np.cumsum(pieces.is_null().to_numpy(zero_copy_only=False)))[bounds]
        joined = pieces.cast(pa.large_binary())
        ends = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
        data = memoryview(joined.buffers()[2] or b"")
        out = []
        for i in range(len(bounds) - 1):
            if spread[i + 1] > spread[i]:
                out.append("".join(self.stream((values[bounds[i] : bounds[i + 1]].to_pylist(),))))
            else:
                out.append(str(data[ends[bounds[i]] : ends[bounds[i + 1]]], "utf-8"))
        return out


def white_space(pattern: str) -> str:
    """White space by its Unicode property, as in the pattern's own dialect; the module's own class has more characters."""
    return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


def machine(ranks_path: str) -> MergeTransducer:
    if ranks_path not in _MACHINES:
        _MACHINES[ranks_path] = MergeTransducer(read_ranks(ranks_path))
        gc.freeze()  # millions of small objects that stay need not be searched for cycles again and again
    return _MACHINES[ranks_path]


def decoder(ranks_path: str) -> Utf8Decoder:
    if ranks_path not in _DECODERS:
        _DECODERS[ranks_path] = Utf8Decoder({rank: token for token, rank in read_ranks(ranks_path).items()})
    return _DECODERS[ranks_path]


def _added(df: DataFrame, name: str, kind: T.DataType, drop: tuple[str, ...] = ()) -> T.StructType:
    kept = [field for field in df.schema.fields if field.name not in drop]
    if any(field.name.lower() == name.lower() for field in kept):
        raise ValueError(f"the table already has a column {name}")
    return T.StructType([*kept, T.StructField(name, kind)])


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "ids", keep_text: bool = True
) -> DataFrame:
    """Add the token ids of ``text``, every match of ``pattern`` encoded by itself."""
    drop = () if keep_text else (text,)
    schema = _added(docs, out, T.ArrayType(T.IntegerType(), False), drop)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coded = _encode_texts(strings(batch.column(batch.schema.get_field_index(text))), ranks_path, pattern)
        kept = [n for n in batch.schema.names if n not in drop]
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), coded], names=[*kept, out])

    return map_batches(docs, run, schema)


def _encode_texts(texts: list[str], ranks_path: str, pattern: str) -> pa.ListArray:
    ids_of = machine(ranks_path).words.__getitem__
    split = regex.compile(white_space(pattern))
    split_ascii = re.compile(ASCII_PATTERN, re.ASCII) if pattern == USUAL_PATTERN else split
    parts, sizes = [], [0]
    for value in texts:
        found = (split_ascii if value.isascii() else split).findall(value)
        parts.append(b"".join(map(ids_of, found)))
        sizes.append(len(parts[-1]) // 4)
    values = np.frombuffer(b"".join(parts), np.int32)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), pa.array(values))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep``, ``ids`` and ``decoded``: encoding and decoding in one pass, a few documents at a time."""
    schema = _added(docs.select(*keep), "ids", T.ArrayType(T.IntegerType(), False)).add("decoded", T.StringType())
    names, slice_rows = schema.names, 500

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        back = decoder(ranks_path)
        for part in (batch.slice(i, slice_rows) for i in range(0, batch.num_rows, slice_rows)):
            coded = _encode_texts(strings(part.column(len(keep))), ranks_path, pattern)
            decoded = pa.array(back.decode_all(coded), pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], coded, decoded], names=names)

    return map_batches(docs.select(*keep, text), run, schema)


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text that the ids stand for."""
    schema = _added(encoded, out, T.StringType())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine_ = decoder(ranks_path)
        texts = machine_.decode_all(batch.column(batch.schema.get_field_index(ids)))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out]
        )

    return map_batches(encoded, run, schema)
