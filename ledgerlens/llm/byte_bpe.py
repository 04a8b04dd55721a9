"""Byte-level BPE encoding and decoding.

Texts are cut into pieces without a regex: code points become classes, the
cutting rule is a small automaton over classes, and its state at every
position comes from an associative scan over transition functions (blocks of
text are composed side by side, block functions are scanned by doubling, and
each block is then run from its own start state). A piece is a slice between
two boundaries; slices are looked up in a bounded cache and only new ones go
through pair merging. Token end offsets are kept next to the ids, so any run of
tokens maps back to bytes.

Defined cases: null text counts as empty; an empty text has no tokens; an
empty table gives an empty result; repeated rows and repeated ids are encoded
row by row; extra columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import chunks, id_text, id_type

CACHE_PIECES = 150_000   # pieces kept per worker
CHUNK = 512 << 10         # bytes of text encoded at once (its arrays take some fifty times that)
LONG_PIECE = 256         # longer pieces are merged with a heap, one by one
BLOCK = 256              # code points per block of the scan
DECODE_ROWS = 256        # rows decoded at a time


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


# ---------------------------------------------------------------- classes
# Symbols of the automaton. Letters that can end a contraction have their own.
LETTER, STMD, RV, E, LL, NUMBER, QUOTE, OTHER, SPACE, WHITE, CUT = range(11)
N_SYM = 11


@lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    """Symbol of every code point. Membership of \\p{L}, \\p{N} and \\s is asked
    once from the tokenizer library itself, so its Unicode version counts."""
    import tiktoken
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    one_byte = {bytes([i]): i for i in range(256)}
    for pattern, symbol in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        enc = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=one_byte, special_tokens={})
        members = bytes(enc.encode_ordinary(every)).decode()
        table[np.frombuffer(members.encode("utf-32-le"), np.uint32)] = symbol
    for chars, symbol in (("stmd", STMD), ("rv", RV), ("e", E), ("l", LL), ("'", QUOTE), (" ", SPACE)):
        for c in chars:
            table[ord(c)] = symbol
    return table


# -------------------------------------------------------------- automaton
# State after a code point: start, inside a letter / number / other run, last
# was a space / other white space, a quote that begins a piece, the end of a
# contraction, and the first letter of a two-letter contraction.
(START, IN_L, IN_N, IN_O, IN_SP, IN_WS, IN_Q, DONE, SAW_RV, SAW_L) = range(10)
N_STATE = 10


def _next_state(state: int, symbol: int) -> int:
    if symbol == CUT:
        return START
    if symbol == SPACE:
        return IN_SP
    if symbol == WHITE:
        return IN_WS
    if symbol == NUMBER:
        return IN_N
    if symbol == OTHER:
        return IN_O
    if symbol == QUOTE:  # begins a piece unless a space or another mark takes it in
        return IN_O if state in (IN_O, IN_SP, IN_Q) else IN_Q
    if state == IN_Q:
        return {STMD: DONE, RV: SAW_RV, LL: SAW_L}.get(symbol, IN_L)
    if (state, symbol) in ((SAW_RV, E), (SAW_L, LL)):
        return DONE
    return IN_L


_LETTERS = (IN_L, SAW_RV, SAW_L)


def _is_start(prev: int, cur: int, nxt: int) -> bool:
    """Does a piece start at a code point, given the states before it, at it
    and after it? (START after it: the text ends.)"""
    if cur == START or prev == START:
        return True
    if cur in (IN_SP, IN_WS):
        if prev not in (IN_SP, IN_WS):
            return True
        return nxt not in (IN_SP, IN_WS, START)  # the last white space before a word stands apart
    if prev == IN_SP:
        return False  # the space already began this piece
    if prev in (IN_WS, DONE) or cur == IN_Q:
        return True
    if prev == IN_Q:
        if cur in (SAW_RV, SAW_L):
            return nxt != DONE
        return cur not in (DONE, IN_O)
    if cur == DONE:
        return False
    if prev in _LETTERS:
        return cur not in _LETTERS
    return prev != cur


@lru_cache(maxsize=1)
def _tables():
    """Transition table, the finite monoid of its functions with composition,
    and the boundary table."""
    step = np.array([[_next_state(s, y) for y in range(N_SYM)] for s in range(N_STATE)], np.uint8)
    gens = [tuple(step[:, y]) for y in range(N_SYM)]
    funcs = [tuple(range(N_STATE))]
    index = {funcs[0]: 0}
    extend = []
    i = 0
    while i < len(funcs):
        row = []
        for g in gens:
            f = tuple(g[s] for s in funcs[i])
            if f not in index:
                index[f] = len(funcs)
                funcs.append(f)
            row.append(index[f])
        extend.append(row)
        i += 1
    apply = np.array(funcs, np.uint8)
    compose = np.array([[index[tuple(g[s] for s in f)] for g in funcs] for f in funcs], np.uint16)
    starts = np.array([_is_start(p, c, n) for p in range(N_STATE) for c in range(N_STATE)
                       for n in range(N_STATE)], bool)
    return step, np.array(extend, np.uint16), apply, compose, starts


def states(symbols: np.ndarray) -> np.ndarray:
    """Automaton state after each symbol, by the two-level scan."""
    step, extend, apply, compose, _ = _tables()
    n = len(symbols)
    blocks = -(-n // BLOCK)
    grid = np.full(blocks * BLOCK, CUT, np.uint16)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T)
    flat = (extend * N_SYM).ravel().astype(np.uint16)
    f = np.zeros(blocks, np.uint16)
    for row in grid:  # the function of each block
        f = flat[f + row]
    f //= N_SYM
    shift = 1
    while shift < blocks:  # inclusive scan by doubling
        f[shift:] = compose[f[:-shift], f[shift:]]
        shift *= 2
    s = np.empty(blocks, np.uint16)
    s[0] = START
    s[1:] = apply[f[:-1], START]
    s *= N_SYM
    flat = (step.astype(np.uint16) * N_SYM).ravel()
    out = np.empty((BLOCK, blocks), np.uint8)
    for i, row in enumerate(grid):
        s = flat[s + row]
        out[i] = s // N_SYM
    return out.T.reshape(-1)[:n]


def piece_starts(symbols: np.ndarray) -> np.ndarray:
    """Positions where a piece starts; a CUT symbol is a piece of its own."""
    st = states(symbols).astype(np.uint16)
    prev = np.empty_like(st)
    nxt = np.empty_like(st)
    prev[:1], prev[1:] = START, st[:-1]
    nxt[-1:], nxt[:-1] = START, st[1:]
    return np.flatnonzero(_tables()[4][(prev * N_STATE + st) * N_STATE + nxt])


def pieces_of(texts: list[str]) -> tuple[list[str], str]:
    """Pieces of all texts in order (separators left out), and the joined text."""
    joined = "\n".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    symbols = symbol_table()[points]
    cuts = np.cumsum([len(t) + 1 for t in texts])[:-1] - 1
    symbols[cuts] = CUT
    at = piece_starts(symbols)
    keep = symbols[at] != CUT
    ends = np.append(at[1:], len(points))
    return [joined[a:b] for a, b in zip(at[keep].tolist(), ends[keep].tolist())], joined


# ---------------------------------------------------------------- merging
class Vocabulary:
    """Ranks of a rank file, with a sorted table of all mergeable id pairs."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.size = max(self.ranks.values()) + 1
        self.tokens = [b""] * self.size
        for t, r in self.ranks.items():
            self.tokens[r] = t
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        get = self.ranks.get
        pairs = sorted((a * self.size + b, r) for t, r in self.ranks.items() for i in range(1, len(t))
                       if (a := get(t[:i])) is not None and (b := get(t[i:])) is not None)
        self.pair_keys = np.array([k for k, _ in pairs], np.int64)
        self.pair_ids = np.array([r for _, r in pairs], np.int64)
        self.cache: dict[str, bytes] = {}

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == key, self.pair_ids[at], self.size)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian int32) of each piece: repeatedly merge the
        leftmost pair of lowest rank, all pieces side by side."""
        out: list[bytes | None] = [None] * len(pieces)
        work = []
        for i, p in enumerate(pieces):
            if (r := self.ranks.get(p)) is not None:
                out[i] = np.int32(r).tobytes()
            elif len(p) > LONG_PIECE:
                out[i] = self._merge_long(p)
            else:
                work.append(i)
        if not work:
            return out
        size = np.array([len(pieces[i]) for i in work])
        tok = self.byte_ids[np.frombuffer(b"".join(pieces[i] for i in work), np.uint8)]
        who = np.arange(len(work))
        done_tok, done_who = [], []
        while len(who):
            first = np.cumsum(size) - size
            last = first + size - 1
            rank = np.full(len(tok), self.size)
            rank[:-1] = self._pair_rank(tok[:-1], tok[1:])
            rank[last] = self.size
            best = np.minimum.reduceat(rank, first)
            live = best < self.size
            hit = np.flatnonzero(rank == np.repeat(np.where(live, best, -1), size))
            owner = np.repeat(np.arange(len(who)), size)[hit]
            hit = hit[np.append(True, owner[1:] != owner[:-1])] if len(hit) else hit
            tok[hit] = rank[hit]
            keep = np.ones(len(tok), bool)
            keep[hit + 1] = False
            of_live = np.repeat(live, size)
            done_tok.append(tok[~of_live])
            done_who.append(np.repeat(who[~live], size[~live]))
            tok = tok[keep & of_live]
            who, size = who[live], size[live] - 1
        tok, owner = np.concatenate(done_tok), np.concatenate(done_who)
        order = np.argsort(owner, kind="stable")
        flat = tok[order].astype("<i4").tobytes()
        ends = np.cumsum(np.bincount(owner, minlength=len(work))).tolist()
        a = 0
        for i, b in zip(work, ends):
            out[i] = flat[4 * a:4 * b]
            a = b
        return out

    def _merge_long(self, piece: bytes) -> bytes:
        """The same rule with a heap of (rank, position): n log n for a piece of n bytes."""
        get, n = self.ranks.get, len(piece)
        start = list(range(n + 1))  # token i covers piece[start[i]:start[next[i]]]
        nxt, prv = list(range(1, n + 2)), list(range(-1, n))
        alive = [True] * n
        heap = [(r, i) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)

        def rank(i):
            j = nxt[i]
            return get(piece[start[i]:start[nxt[j]]]) if j < n else None

        while heap:
            r, i = heapq.heappop(heap)
            if not alive[i] or rank(i) != r:
                continue
            j = nxt[i]
            alive[j] = False
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for k in (prv[i], i):
                if k >= 0 and (r := rank(k)) is not None:
                    heapq.heappush(heap, (r, k))
        ids, i = [], 0
        while i < n:
            ids.append(get(piece[start[i]:start[nxt[i]]]))
            i = nxt[i]
        return np.array(ids, "<i4").tobytes()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, their byte end within the joined texts, and the
        number of tokens of each text."""
        pieces, _ = pieces_of(texts)
        distinct = set(pieces)
        new = [p for p in distinct if p not in self.cache]
        if len(self.cache) + len(new) > CACHE_PIECES:
            self.cache = dict(islice(self.cache.items(), len(self.cache) // 2, None))  # the older half goes
            new = [p for p in distinct if p not in self.cache]
        self.cache.update(zip(new, self.merge([p.encode() for p in new])))
        ids = np.frombuffer(b"".join(map(self.cache.__getitem__, pieces)), "<i4")
        ends = np.cumsum(self.lengths[ids])
        doc_ends = np.cumsum([len(t.encode()) for t in texts])
        counts = np.diff(np.searchsorted(ends, doc_ends, side="right"), prepend=0)
        return ids, ends, counts


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker process."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


# -------------------------------------------------------------- operators
def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(values, pa.int32()))


def _encoded(vocab: Vocabulary, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
    """Ids and token ends of each text."""
    ids, ends, counts = vocab.encode(texts)
    sizes = [len(t.encode()) for t in texts]
    base = np.repeat(np.cumsum([0, *sizes[:-1]]), counts)
    return _lists(ids, counts), _lists(ends - base, counts)


def _decoded(vocab: Vocabulary, ids: pa.ListArray, ends: pa.ListArray) -> Iterator[bytes]:
    """Bytes of each row of ids. The token ends must agree with them: if not,
    the ids are not of this vocabulary."""
    token = vocab.tokens.__getitem__
    for i in range(len(ids)):
        row = ids[i].values.to_numpy()
        data = b"".join(map(token, row.tolist()))
        if len(row) and ends[i].values[len(row) - 1].as_py() != len(data):
            raise ValueError("token ends do not fit the decoded bytes")
        yield data


def encode(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>, ends array<int>) of every row of ``docs``:
    token ids of the whole text, and the byte offset at which each token ends
    in the UTF-8 text. ``ranks``: path of the rank file on the workers."""
    path = ranks or default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for doc, text in chunks(batches, CHUNK):
            yield pa.RecordBatch.from_arrays([doc, *_encoded(vocab, text.to_pylist())], names=["doc_id", "ids", "ends"])

    return id_text(docs).mapInArrow(run, f"doc_id {id_type(docs)}, ids array<int>, ends array<int>")


def decode(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """(doc_id, decoded): the bytes of the ids of each row, in order."""
    path = ranks or default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for b in batches:
            for a in range(0, b.num_rows, DECODE_ROWS):
                part = b.slice(a, DECODE_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(_decoded(vocab, part.column(1), part.column(2)), pa.binary())],
                    names=["doc_id", "decoded"])

    return (encoded.select("doc_id", "ids", "ends")
            .mapInArrow(run, f"doc_id {id_type(encoded)}, decoded binary"))


def roundtrip(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """Encode every text and decode its ids, in one pass of a task: doc_id,
    n_tokens, and digests of the ids in decimal and of the decoded bytes."""
    path = ranks or default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for doc, text in chunks(batches, CHUNK):
            ids, ends = _encoded(vocab, text.to_pylist())
            yield pa.RecordBatch.from_arrays([doc, ids, pa.array(_decoded(vocab, ids, ends), pa.binary())],
                                             names=["doc_id", "ids", "decoded"])

    both = id_text(docs).mapInArrow(run, f"doc_id {id_type(docs)}, ids array<int>, decoded binary")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
