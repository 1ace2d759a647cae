"""Byte-level BPE with a lazily determinised transducer.

``Transducer`` compiles the merges once per Python worker. Reading a piece byte
by byte, it keeps the *open boundaries*: positions at which a token may still
start that reaches beyond the bytes read, each as (place in the token trie,
token that ends there). The tuple of open boundaries is the state; states and
transitions are interned when first met, so that encoding is one lookup a byte.
Each step also gives the one token that ends at this byte in the encoding of
the bytes so far: the candidate whose seam with the token before it no merge
would cross. Tokens are emitted as soon as all open boundaries agree on them.

``StreamDecoder`` gives the text of ids as they come, with an incremental UTF-8
state machine that holds back at most three bytes.

Null and empty texts have no tokens. Columns other than the id and the text are
not looked at; repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_RANK = 1 << 62
OPEN = -1
#: Bounds of the tables that a task fills; full ones start afresh, and all are emptied at its end.
MAX_STATES = 1 << 18
MAX_SEAMS = 1 << 18
MAX_PIECES = 1 << 17
#: Pieces of more bytes are emitted in parts.
PART_BYTES = 1 << 14


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_all(data: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Plain BPE: merge the pair of lowest rank, leftmost first, until none is left."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], NO_RANK), i) for i in range(len(parts) - 1))
        if rank == NO_RANK:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        #: Tokens' last merge, edges and trie; a token that merging never makes can only be a whole piece.
        self.left: dict[int, tuple[int, ...]] = {}
        self.right: dict[int, tuple[int, ...]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.trie: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        self.ordered = True
        for t, r in sorted(ranks.items(), key=lambda x: len(x[0])):
            if len(t) > 1:
                made = self._last_merge(t)
                if made is None:
                    continue
                a, b = made
                self.ordered &= a < r and b < r
                self.merged[a, b] = r
                self.left[r], self.right[r] = (*self.left[a], r), (*self.right[b], r)
            else:
                self.left[r] = self.right[r] = (r,)
            node = 0
            for c in t:
                if c not in self.trie[node]:
                    self.trie[node][c] = len(self.trie)
                    self.trie.append({})
                    self.ends.append(-1)
                node = self.trie[node][c]
            self.ends[node] = r
        self._seams: dict[tuple[int, int], bool] = {}
        self._depths: list[int] = []
        self._reset()

    def _last_merge(self, t: bytes) -> tuple[int, int] | None:
        """The two tokens whose merge completes ``t``, or None if merging its bytes ends otherwise."""
        ranks = self.ranks
        parts = [t[i : i + 1] for i in range(len(t))]
        while len(parts) > 2:
            rank, i = min((ranks.get(parts[i] + parts[i + 1], NO_RANK), i) for i in range(len(parts) - 1))
            if rank == NO_RANK:
                return None
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return (ranks[parts[0]], ranks[parts[1]])

    def _reset(self) -> None:
        #: A state maps bytes to (next state, token that ends here, its size); at OPEN it has its open boundaries.
        self.start: dict = {OPEN: ((0, -1),)}
        self.states: dict[tuple, dict] = {self.start[OPEN]: self.start}

    def forget(self) -> None:
        self._seams.clear()
        self._reset()

    def seam(self, a: int, b: int) -> bool:
        """Whether merging the bytes of ``a`` and ``b`` leaves just these two tokens.

        Follows the edges of both tokens in the order of their merges: the seam
        fails if the two tokens at it would merge before either grows.
        """
        known = self._seams.get((a, b))
        if known is None:
            if len(self._seams) >= MAX_SEAMS:
                self._seams.clear()
            known = self._seams[a, b] = self._seam(a, b) if self.ordered else merge_all(self.token[a] + self.token[b], self.ranks) == [self.token[a], self.token[b]]
        return known

    def _seam(self, a: int, b: int) -> bool:
        xs, ys = self.right[a], self.left[b]
        i = j = 0
        while True:
            across = self.merged.get((xs[i], ys[j]), NO_RANK)
            x = xs[i + 1] if i + 1 < len(xs) else NO_RANK
            y = ys[j + 1] if j + 1 < len(ys) else NO_RANK
            if across < x and across <= y:
                return False
            if x == y == NO_RANK:
                return True
            if x <= y:  # of equal ranks the left pair merges first
                i += 1
            else:
                j += 1

    def _step(self, state: dict, byte: int) -> tuple[dict, int, int]:
        """Next state, the token that ends here, and its number of bytes; kept in the state."""
        found, after = -1, []
        trie, ends = self.trie, self.ends
        for node, last in state[OPEN]:
            to = trie[node].get(byte)
            if to is None:
                continue
            if trie[to]:
                after.append((to, last))
            t = ends[to]
            if t >= 0 and found < 0 and (last < 0 or self.seam(last, t)):
                found = t
        after.append((0, found))
        key = tuple(after)
        to_state = self.states.get(key)
        if to_state is None:
            if len(self.states) >= MAX_STATES:
                self._reset()  # states in use live on until the piece ends
            to_state = self.states[key] = {OPEN: key}
        step = state[byte] = (to_state, found, len(self.token[found]))
        return step

    def _short(self, data: bytes) -> list[int]:
        """The tokens of a piece of few bytes, last first."""
        state, tokens, sizes = self.start, [], []
        for byte in data:
            step = state.get(byte)
            state, token, size = step if step is not None else self._step(state, byte)
            tokens.append(token)
            sizes.append(size)
        out, end = [], len(tokens)
        while end:
            out.append(tokens[end - 1])
            end -= sizes[end - 1]
        return out

    def _long(self, data: bytes) -> Iterator[list[int]]:
        """The tokens of one piece in parts, each as soon as it is settled."""
        state, tokens, sizes = self.start, [], []
        for byte in data:
            step = state.get(byte)
            state, token, size = step if step is not None else self._step(state, byte)
            tokens.append(token)
            sizes.append(size)
            if len(tokens) >= PART_BYTES:
                cut = self._agreed(state, sizes)
                if cut:
                    yield self._back(tokens, sizes, cut)
                    del tokens[:cut], sizes[:cut]
        yield self._back(tokens, sizes, len(tokens))

    def _agreed(self, state: dict, sizes: list[int]) -> int:
        """The last position that the tokens before every open boundary share."""
        open_at = {len(sizes) - self._depth(node) for node, _ in state[OPEN]}
        while len(open_at) > 1:
            p = max(open_at)
            open_at.remove(p)
            open_at.add(p - sizes[p - 1])
        return open_at.pop()

    def _depth(self, node: int) -> int:
        if not self._depths:
            self._depths = [0] * len(self.trie)
            for n, kids in enumerate(self.trie):
                for k in kids.values():
                    self._depths[k] = self._depths[n] + 1
        return self._depths[node]

    @staticmethod
    def _back(tokens: list[int], sizes: list[int], end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(tokens[end - 1])
            end -= sizes[end - 1]
        out.reverse()
        return out

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) < PART_BYTES:
            return self._short(data)[::-1]
        return [t for part in self._long(data) for t in part]


class Encoder(dict):
    """Texts to ids, as little-endian unsigned 32-bit integers; keeps the ids of pieces met before."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        self.transducer = Transducer(load_ranks(path))
        self.packed = {r: r.to_bytes(4, "little") for r in self.transducer.token}
        self.pieces = regex.compile(pattern).findall

    def __missing__(self, piece: str) -> bytes:
        packed = self.packed
        ids = b"".join([packed[t] for t in self.transducer.encode_piece(piece.encode())])
        if len(piece) <= 64:
            if len(self) >= MAX_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def forget(self) -> None:
        """Empties the tables: a worker that waits for its next task holds the merges only."""
        self.clear()
        self.transducer.forget()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pieces(text)))


class StreamDecoder:
    """Text of ids as they come; undecodable bytes become U+FFFD."""

    def __init__(self, token: dict[int, bytes]):
        self.token = token
        self.held = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """How many bytes at the end begin a character without finishing it."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:
                continue
            need = 2 if byte >> 5 == 0b110 else 3 if byte >> 4 == 0b1110 else 4 if byte >> 3 == 0b11110 else 1
            return back if need > back else 0
        return 0

    def feed(self, ids: Iterable[int]) -> str:
        data = self.held + b"".join(map(self.token.__getitem__, ids))
        keep = self._unfinished(data)
        self.held = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def finish(self) -> str:
        out, self.held = self.held.decode("utf-8", "replace"), b""
        return out


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder for these ranks, compiled once."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


#: Ids decoded at a time.
FEED = 8192


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Ids of every whole text, and the digests of the ids and of their decoded bytes.

    Returns id, n_tokens, ids (array<int>, unless ``with_ids`` is false),
    ids_sha256 and decoded_sha256, one row per input row.
    """

    def run(batches):
        enc = encoder(path, pattern)
        for batch in batches:
            n, ids, a, b = [], [], [], []
            for text in batch.column(1).to_pylist():
                packed = enc.encode(text or "")
                array = np.frombuffer(packed, "<u4")
                out, sha = StreamDecoder(enc.transducer.token), hashlib.sha256()
                for at in range(0, len(array), FEED):
                    sha.update(out.feed(array[at : at + FEED].tolist()).encode())
                sha.update(out.finish().encode())
                n.append(len(array))
                a.append(hashlib.sha256(packed).hexdigest())
                b.append(sha.hexdigest())
                if with_ids:
                    ids.append(array.astype(np.int32))
            columns = {"doc": batch.column(0), "n_tokens": pa.array(n, pa.int64())}
            if with_ids:
                columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns | {"ids_sha256": a, "decoded_sha256": b})
        encoder(path, pattern).forget()

    kind = dict(docs.dtypes)[id_col]
    schema = f"doc {kind}, n_tokens bigint, {'ids array<int>, ' if with_ids else ''}ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("doc", id_col)
